"""What belongs to a language: letters, tag classes, fixed segmentations; read from an ini text. And the corpora that names stand for."""

from __future__ import annotations

import configparser
import re
from dataclasses import dataclass, field


@dataclass(frozen=True)
class Profile:
    """Settings of a language. pos_classes: a tag to the class it counts as; regex_tok: patterns of whole forms with their segmentation; allowed: places at which boundaries may be."""

    base_letters: str = ""
    vowels: str = ""
    diacritics: str = ""
    pos_classes: dict[str, str] = field(default_factory=dict)
    regex_tok: tuple[tuple[str, str], ...] = ()
    allowed: tuple[int, ...] = ()
    unused: tuple[str, ...] = ()

    def segment_by_pattern(self, word: str) -> str | None:
        """What the first pattern that covers the word says; null if none does."""
        for pattern, by in self.regex_tok:
            if re.fullmatch(pattern, word):
                return re.sub(pattern, by, word)
        return None


def read_profile(text: str) -> Profile:
    """From lines 'name=value' (a section head is optional): pos_classes as 'N<-NPROP|NUM;V<-VBD', regex_tok as 'pattern TAB replacement' lines, lists parted by commas. Unknown names are errors."""
    parser = configparser.ConfigParser(delimiters=("=",), interpolation=None, strict=True)
    parser.optionxform = str
    parser.read_string(text if text.lstrip().startswith("[") else f"[profile]\n{text}")
    values = {k: v for s in parser.sections() for k, v in parser.items(s)}
    if unknown := sorted(set(values) - set(Profile.__dataclass_fields__)):
        raise ValueError(f"unknown settings: {unknown}")
    classes = {tag.strip(): part.split("<-")[0].strip() for part in values.get("pos_classes", "").split(";") if "<-" in part for tag in part.split("<-")[1].split("|")}
    rules = tuple(tuple(line.split("\t", 1)) for line in values.get("regex_tok", "").splitlines() if "\t" in line)
    return Profile(
        base_letters=values.get("base_letters", ""), vowels=values.get("vowels", ""), diacritics=values.get("diacritics", ""), pos_classes=classes, regex_tok=rules,
        allowed=tuple(int(x) for x in values.get("allowed", "").split(",") if x.strip()), unused=tuple(x.strip() for x in values.get("unused", "").split(",") if x.strip()),
    )


def resolve_corpora(alias: str, corpora: list[str]) -> list[str]:
    """The corpora that an alias names: parts joined by '+' are united, parts behind '-' taken out.

    A part is a corpus's name, or its begin: of several that begin so the shortest, and all of equal length. What names nothing is an error.
    """

    def one(part: str) -> list[str]:
        if part in corpora:
            return [part]
        found = sorted(c for c in corpora if c.startswith(part))
        if not found:
            raise ValueError(f"no corpus is named {part!r}; there are {sorted(corpora)}")
        return [c for c in found if len(c) == min(map(len, found))]

    out: list[str] = []
    for sign, part in re.findall(r"(^|[+-])([^+-]+)", alias):
        if sign == "-":
            out = [c for c in out if c not in one(part)]
        else:
            out += [c for c in one(part) if c not in out]
    return out


def output_path(name: str, extension: str, folder: str | None = None, many: bool = False) -> str | None:
    """Where a document's result goes: into the folder if one is given, beside the document if there are many, nowhere (None: standard output) for one; '.out' keeps it from replacing its source."""
    if folder is None and not many:
        return None
    stem, _, have = name.rpartition(".")
    stem = stem or name
    file = f"{stem}.out.{extension}" if have == extension and folder is None else f"{stem}.{extension}"
    return file if folder is None else f"{folder.rstrip('/')}/{file.rpartition('/')[2]}"
