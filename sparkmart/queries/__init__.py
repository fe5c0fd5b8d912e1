"""Registered queries over the provided tables, each with its DuckDB oracle SQL.

Each query re-aims one or more operators of the mart at the provided tables (see
``loanbook.py`` for the loan-book mapping).  ``REGISTRY[name] = (fn, sql_or_None)``;
``fn(spark, sf_dir) -> DataFrame``.
"""

from __future__ import annotations

from sparkmart.queries.registry import REGISTRY, query  # noqa: F401
from sparkmart.queries import (  # noqa: F401  (import registers the queries)
    marts, calendar_q, filters_q, schema_q, clean_q, features_q, encode_q, joins_q,
    profile_q, model_q, io_q, feature_mart_q, loanbook_q, loanbook_rows_q,
)
