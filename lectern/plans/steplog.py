"""What steps did and how long they took."""

from __future__ import annotations

import logging
import time
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field

_LOG = logging.getLogger("lectern")


@dataclass
class StepLog:
    """Seconds of each step in order; quiet: nothing is logged."""

    quiet: bool = False
    seconds: list[tuple[str, float]] = field(default_factory=list)

    @contextmanager
    def step(self, name: str) -> Iterator[None]:
        start = time.monotonic()
        try:
            yield
        finally:
            self.seconds.append((name, time.monotonic() - start))
            if not self.quiet:
                _LOG.info("%s: %.1f s", *self.seconds[-1])

    def total(self) -> float:
        return sum(s for _, s in self.seconds)
