"""Scheduling of queries: rotation under a cap, circuit breakers, chunking and round-robin, all as window plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def rotate(jobs: DataFrame, cap: int, name_share: int, dormant_slots: int) -> DataFrame:
    """Jobs kept this cycle: (label, kept).

    ``jobs`` is (label, name_id, tier, waited, prio, ord, dormant); name_id is null for jobs of several names. Live
    jobs go first up to the cap less the reserve, then dormant ones; within a name only the first ``name_share`` count,
    carried over from live to dormant. Both ranks are windows; the cap itself needs one global order of the jobs,
    which are thousands, not documents.
    """
    key = ["tier", "waited", "prio", "ord"]
    n_all, n_dormant = jobs.agg(F.count(F.lit(1)), F.count_if("dormant")).head()
    if cap <= 0 or n_all <= cap:
        return jobs.select("label", F.lit(True).alias("kept"))
    reserve = min(max(0, dormant_slots), n_dormant, max(0, cap - 1))
    by_name = F.row_number().over(Window.partitionBy("name_id", "dormant").orderBy(*key))
    live = jobs.withColumn("in_name", F.when(F.col("name_id").isNotNull() & F.lit(name_share > 0), by_name).otherwise(0))
    first = live.where("NOT dormant").where(F.col("in_name") <= (name_share if name_share > 0 else 0))
    first = first.orderBy(*key).limit(cap - reserve).select("label", "name_id")
    taken = first.where(F.col("name_id").isNotNull()).groupBy("name_id").agg(F.count(F.lit(1)).alias("taken"))
    second = live.where("dormant").join(taken, "name_id", "left")
    room = F.col("in_name") + F.when(F.col("name_id").isNotNull(), F.coalesce("taken", F.lit(0))).otherwise(0)
    if name_share > 0:
        second = second.where(room <= name_share)
    second = second.orderBy(*key).limit(cap - first.count()).select("label", "name_id")
    kept = first.unionByName(second).select("label", F.lit(True).alias("k"))
    return jobs.join(kept, "label", "left").select("label", F.coalesce("k", F.lit(False)).alias("kept"))


def trips(results: DataFrame, after: int, resets: Column) -> DataFrame:
    """First place at which each route has ``after`` consecutive results that don't reset: gaps and islands.

    ``results`` is (route, run_id, seq, ...); one run of one route is a group.
    """
    order = Window.partitionBy("route", "run_id").orderBy("seq")
    islands = results.withColumn("island", F.sum(resets.cast("int")).over(order)).withColumn("bad", ~resets)
    streak = islands.withColumn("streak", F.count_if("bad").over(Window.partitionBy("route", "run_id", "island").orderBy("seq")))
    return streak.where(F.col("streak") >= after).groupBy("route", "run_id").agg(F.min("seq").alias("tripped_at"))


def chunks(rows: DataFrame, size: int) -> DataFrame:
    """Rows (market, heavy, name_id) with the ordinal of their group: light names first, heavy ones among themselves."""
    place = F.row_number().over(Window.partitionBy("market", "heavy").orderBy("name_id")) - 1
    light = F.ceil(F.count_if(~F.col("heavy")).over(Window.partitionBy("market")) / size)
    return rows.withColumn("group_no", F.floor(place / size) + F.when(F.col("heavy"), light).otherwise(0))


def phase(name_id: Column) -> Column:
    """Byte sum of an id, the phase of its round-robin."""
    return F.aggregate(F.transform(F.sequence(F.lit(1), F.greatest(F.length(name_id), F.lit(1))), lambda i: F.ascii(F.substring(name_id, i, F.lit(1)))), F.lit(0), lambda acc, x: acc + x)


def due(every: Column, run: Column, phase_: Column) -> Column:
    """Whether a query with a cadence is due in a run."""
    return (every <= 1) | (F.pmod(run + phase_, F.greatest(every, F.lit(1))) == 0)


def quota(outcomes: DataFrame, start: int, floor: int, ceiling: int, down: float, step: int) -> DataFrame:
    """Cap after each run in order: cut by ``down`` after a refusal, raised by ``step`` after an answer; an ordered fold."""
    folded = outcomes.groupBy("route").agg(F.array_sort(F.collect_list(F.struct("run_id", "refused"))).alias("h"))
    path = F.aggregate(
        "h",
        F.array(F.struct(F.lit(0).cast("bigint").alias("run_id"), F.lit(start).alias("cap"))),
        lambda acc, x: F.concat(
            acc,
            F.array(
                F.struct(
                    x["run_id"].alias("run_id"),
                    F.when(x["refused"], F.greatest(F.lit(floor), F.floor(F.element_at(acc, -1)["cap"] * down).cast("int"))).otherwise(F.least(F.lit(ceiling), F.element_at(acc, -1)["cap"] + step)).alias("cap"),
                )
            ),
        ),
    )
    return folded.select("route", F.explode(F.slice(path, 2, F.size("h"))).alias("x")).select("route", "x.run_id", "x.cap")
