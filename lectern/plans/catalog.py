"""All registered queries of the annotation operators, with their SQL."""

from __future__ import annotations

import importlib

from lectern.plans.queries import ORACLE_SQL, QUERIES

for _name in ("sgml_queries", "conll_queries", "entity_queries", "eval_queries", "norm_queries", "seg_queries", "model_queries", "api_queries", "more_queries"):
    importlib.import_module(f"lectern.plans.{_name}")

__all__ = ["ORACLE_SQL", "QUERIES"]
