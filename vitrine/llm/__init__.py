"""Operations of a training-data pipeline, each with a query over the whole given tables."""

from __future__ import annotations

import importlib

MODULES = (
    "op1_licenses", "op2_mixing", "op3_classifier", "op4_language_model", "op5_sharding",
    "op6_warc", "op7_minhash", "op8_decontaminate", "op9_rules", "op10_simple8b", "op11_importance",
    "op12_negatives", "op13_html", "pipeline",
)


def all_queries() -> dict:
    return {name: fn for m in MODULES for name, fn in importlib.import_module(f"vitrine.llm.{m}").QUERIES.items()}


def all_oracles() -> dict:
    return {name: sql for m in MODULES for name, sql in importlib.import_module(f"vitrine.llm.{m}").ORACLES.items()}
