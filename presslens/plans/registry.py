"""The registered queries of the core and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslens.operators import lateness, timestamps
from presslens.plans import core_queries, time_sql
from presslens.plans import curation_queries, pass_queries, portable_queries  # noqa: F401  (register their queries)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to a callable of (spark, sf_dir)."""
    return core_queries.Q | {
        "p2_found": lateness.p2_found,
        "p2_revisions": lateness.p2_revisions,
        "p6_found": timestamps.p6_found,
        "p6_notations": timestamps.p6_notations,
    }


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL over the same tables."""
    return core_queries.SQL | time_sql.SQL
