"""The job ledger and its reports: outcomes of every query per run, who was starved, what yields nothing.

The test tables hold no ledger of their own, so ``ledger`` derives one from the items: one row per run and query with
the number of items it delivered. Every report takes any DataFrame of that shape.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import table


def items(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Distinct items, pruned to the columns asked for."""
    rows = table(spark, sf_dir, "items")
    return rows.select("id", *columns).dropDuplicates(["id"])


def matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matches, the last one per item and name winning (repeated deliveries are equal)."""
    return table(spark, sf_dir, "matches").dropDuplicates(["item_id", "name_id"])


def ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(run_id, route, source, ok, items, error, names): a query is ok if any item of it passed the screen."""
    i = items(spark, sf_dir, "run_id", "route", "query", "status", "screen_reason")
    return i.groupBy("run_id", "route", F.col("query").alias("source")).agg(
        F.bool_or(F.col("status") != "screened").alias("ok"),
        F.count_if(F.col("status") == "candidate").alias("items"),
        F.coalesce(F.max(F.when(F.col("status") == "screened", F.concat(F.lit("refused upstream: "), F.col("screen_reason")))), F.lit("")).alias("error"),
    )


def since(ledger_rows: DataFrame, runs: DataFrame, hours: int) -> DataFrame:
    """Ledger rows of runs that started within the last hours before the newest run."""
    last = runs.agg(F.max("started_at").alias("last"))
    recent = runs.join(F.broadcast(last)).where(F.col("started_at") >= F.col("last") - F.make_dt_interval(hours=F.lit(hours))).select(F.col("id").alias("run_id"))
    return ledger_rows.join(recent, "run_id", "left_semi")


def last_attempts(rows: DataFrame) -> DataFrame:
    """The last run that sent each query of a route; skipped ones don't count."""
    return rows.where(~F.startswith("error", F.lit("skipped:"))).groupBy("route", "source").agg(F.max("run_id").alias("last_run"))


def zero_yield(rows: DataFrame, least: int = 3) -> DataFrame:
    """Queries that were sent at least ``least`` times and never returned an item."""
    sent = rows.where(~F.startswith("error", F.lit("skipped:"))).groupBy("route", "source").agg(F.count(F.lit(1)).alias("sends"), F.sum("items").alias("total_items"))
    return sent.where((F.col("sends") >= least) & (F.col("total_items") == 0))


def outcomes(rows: DataFrame) -> DataFrame:
    """Answered and attempted per query."""
    return rows.groupBy("source").agg(F.count_if("ok").alias("n_ok"), F.count(F.lit(1)).alias("n_jobs"))


def starved(rows: DataFrame) -> DataFrame:
    """Queries that were attempted and never once answered."""
    return rows.groupBy("route", "source").agg(F.count(F.lit(1)).alias("n_runs"), F.sum("items").alias("n_items"), F.max("error").alias("last_error"), F.bool_or("ok").alias("any_ok")).where(~F.col("any_ok")).drop("any_ok")


def silent_watchers(rows: DataFrame, routes: tuple[str, ...] = ("page", "rss")) -> DataFrame:
    """Watchers and feeds that answered but never returned an item."""
    agg = rows.where(F.col("route").isin(*routes)).groupBy("route", "source").agg(F.count_if("ok").alias("ok_runs"), F.count(F.lit(1)).alias("n_runs"), F.sum("items").alias("n_items"))
    return agg.where((F.col("ok_runs") > 0) & (F.col("n_items") == 0))


def health(rows: DataFrame, runs: DataFrame, last_runs: int = 4) -> DataFrame:
    """Outcome of every query over the last runs."""
    newest = runs.select(F.col("id").alias("run_id")).distinct().orderBy(F.desc("run_id")).limit(last_runs)
    return rows.join(newest, "run_id", "left_semi").groupBy("route", "source").agg(
        F.count_if("ok").alias("ok_runs"), F.count(F.lit(1)).alias("n_runs"), F.sum("items").alias("n_items"), F.max(F.when(~F.col("ok"), F.col("error")).otherwise("")).alias("last_error")
    )


def error_class() -> F.Column:
    """Ordered classification of an error text."""
    e = F.lower(F.col("error"))
    out = F.when(e == "", "none")
    for name, pattern in (("budget", "budget"), ("deferred", "rotation"), ("refused", "refused upstream|cooling down"), ("tripped", "tripped"), ("rate_limit", "http 429"), ("no_feed", "no feed"), ("http", "http [45]")):
        out = out.when(e.rlike(pattern), name)
    return out.otherwise("other")
