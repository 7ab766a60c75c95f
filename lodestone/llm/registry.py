"""The package's queries and their SQL, for the driver's entry."""

from __future__ import annotations

from importlib import import_module

#: query -> (module of this package, name of its SQL or None)
QUERIES = {
    "op1_token_counts": ("token_counts", None),
    "op2_ann_search": ("ann_search", None),
    "op3_ngram_jaccard": ("ngram_jaccard", None),
    "op4_decontaminate": ("decontaminate", "OP4_SQL"),
    "op5_line_dedup": ("line_dedup", "OP5_SQL"),
    "op6_quality": ("quality", None),
    "op7_url_filter": ("url_filter", None),
    "op8_substring_dedup": ("substring_dedup", None),
    "op9_mix": ("mixing", "OP9_SQL"),
    "op10_license_scan": ("license_scan", None),
}


def queries() -> dict:
    return {name: getattr(import_module(f"lodestone.llm.{module}"), name) for name, (module, _) in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: getattr(import_module(f"lodestone.llm.{module}"), sql) for name, (module, sql) in QUERIES.items() if sql}
