"""Operators for large training corpora. Nothing else in the library imports this package."""

from __future__ import annotations

from . import decontam, licenses, paragraph_dedup, quality_pu, quality_rules, simhash, sp_dropout, token_counts, toxicity, warc_store

_MODULES = [simhash, licenses, decontam, quality_rules, sp_dropout, toxicity, token_counts, quality_pu, paragraph_dedup, warc_store]


def queries() -> dict:
    """The queries of all operators by name, in the operators' order."""
    return {name: f for m in _MODULES for name, f in vars(m).items() if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL by query name, for operators that SQL can express."""
    return {k: v for m in _MODULES for k, v in getattr(m, "ORACLE_SQL", {}).items()}
