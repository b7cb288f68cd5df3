"""Problem 2, late and out-of-order events: an event-day by arrival-hour triangle, in SQL only.

A cell counts the distinct items of one day of publication by their period of arrival: all arrivals before the day
closes, ``CLOSE_HOURS`` after its end, are period 0, each hour from then on is one more, and all that come
``CUTOFF_HOURS`` after the day's end or later share the last. Cumulative sums over the arrivals give every corrected
revision of a day's count; arrivals beyond the cut-off are filtered from them. Each cell has the effect of its arrivals
on the period (``on_time``, ``late``, ``dropped``); the cases are the items of the cells that came too late.

Items without a readable time of publication or of first sight are no cases; an empty table gives no rows; repeated
deliveries count once. The triangle has at most ``CUTOFF_HOURS`` cells a day, aggregated on the map side, so a day of
many items makes no hot group.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.operators.timestamps import with_utc
from presslens.session import table

CLOSE_HOURS = 6
CUTOFF_HOURS = 72

_PLACED = """
    SELECT id, published_at_us AS event_us, first_seen_at_us AS seen_us,
           timestamp_micros(published_at_us) AS event_ts,
           (published_at_us div 86400000000 + 1 - if(published_at_us % 86400000000 < 0, 1, 0)) * 86400000000 AS day_end_us
    FROM {items}
    WHERE published_at_us IS NOT NULL AND first_seen_at_us IS NOT NULL
"""

#: Every item in its cell.
PLACED = f"""
    SELECT id, day_end_us, CASE WHEN behind < {{close}} * 3600000000 THEN 0
                                ELSE 1 + (least(behind, {{cutoff}} * 3600000000) - {{close}} * 3600000000) div 3600000000 END AS arrival_hour
    FROM (SELECT *, seen_us - day_end_us AS behind FROM ({_PLACED}))
"""

#: The triangle: one row per day of publication and period of arrival, with the sum up to it.
CELLS = """
    SELECT day_end_us, arrival_hour, n_items, sum(n_items) OVER (PARTITION BY day_end_us ORDER BY arrival_hour ROWS UNBOUNDED PRECEDING) AS n_corrected,
           CASE WHEN arrival_hour = 0 THEN 'on_time' WHEN arrival_hour <= {cutoff} - {close} THEN 'late' ELSE 'dropped' END AS effect,
           date_format(date_add(DATE'1970-01-01', CAST(day_end_us div 86400000000 - 1 AS INT)), 'yyyy-MM-dd') AS period
    FROM (SELECT day_end_us, arrival_hour, count(DISTINCT id) AS n_items FROM {placed} GROUP BY 1, 2)
"""

REVISIONS = """
    SELECT period, arrival_hour, n_items, n_corrected,
           row_number() OVER (PARTITION BY day_end_us ORDER BY arrival_hour) - 1 AS revision,
           lead(arrival_hour) OVER (PARTITION BY day_end_us ORDER BY arrival_hour) IS NULL AS is_latest
    FROM {cells} WHERE effect <> 'dropped'
"""

FOUND = """
    SELECT DISTINCT p.id, c.period, c.effect
    FROM {placed} p JOIN {cells} c ON p.day_end_us = c.day_end_us AND p.arrival_hour = c.arrival_hour WHERE c.effect <> 'on_time'
"""


def _triangle(spark: SparkSession, items: DataFrame, close: int, cutoff: int) -> tuple[DataFrame, DataFrame]:
    placed = spark.sql(PLACED, items=items, close=close, cutoff=cutoff)
    return placed, spark.sql(CELLS, placed=placed, close=close, cutoff=cutoff)


def late_cases(spark: SparkSession, items: DataFrame, close: int = CLOSE_HOURS, cutoff: int = CUTOFF_HOURS) -> DataFrame:
    """(id, period, effect) of every item of the triangle's cells that came after their period closed."""
    placed, cells = _triangle(spark, items, close, cutoff)
    return spark.sql(FOUND, placed=placed, cells=cells)


def revisions(spark: SparkSession, items: DataFrame, close: int = CLOSE_HOURS, cutoff: int = CUTOFF_HOURS) -> DataFrame:
    """Every revision of every period's count, in order of arrival; beyond the cut-off nothing counts."""
    return spark.sql(REVISIONS, cells=_triangle(spark, items, close, cutoff)[1])


def _timed(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = table(spark, sf_dir, "items").select("id", "published_at", "first_seen_at", "country")
    return with_utc(items, table(spark, sf_dir, "markets"), ["published_at", "first_seen_at"], "country", "country")


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late and dropped items of the whole items table."""
    return late_cases(spark, _timed(spark, sf_dir))


def p2_revisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All corrected daily counts of the whole items table."""
    return revisions(spark, _timed(spark, sf_dir))
