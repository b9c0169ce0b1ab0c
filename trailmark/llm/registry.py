"""Queries of this subpackage, the pipeline included, and their oracle SQL."""

from __future__ import annotations

import importlib

from trailmark.llm import stages

MODULES = (
    "mixing",
    "quality",
    "substrings",
    "toxicity",
    "exact_dedup",
    "byte_bpe",
    "simhash_dedup",
    "html_extract",
    "language_id",
    "fingerprints",
)


def _modules():
    return [importlib.import_module(f"trailmark.llm.{name}") for name in MODULES]


def queries():
    return {m.QUERY: m.query for m in _modules()} | {"pipeline": stages.run}


def oracle_sql():
    return {m.QUERY: m.ORACLE_SQL for m in _modules() if m.ORACLE_SQL is not None}
