"""Queries of the curation pass over the test tables: each run is a batch, its start the time of the pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions import titles as T
from presslens.operators import curation, ledger
from presslens.plans.core_queries import _CANON, _DATED, _DM, _PATH, HOSTS, ITEMS, LEXICON, RULES, _runs, query
from presslens.session import table

_CLEAN_TIME = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$"


def _mentions(spark: SparkSession, sf: str) -> DataFrame:
    """Items as raw mentions; only normal times are taken, as the sources of a pass give instants."""
    i = ledger.items(spark, sf, "title", "canonical_url", "route", "query", "summary", "published_at", "source_name", "source_domain", "lang", "run_id")
    at = F.when(F.col("published_at").rlike(_CLEAN_TIME), F.to_timestamp(F.left("published_at", F.lit(19)), "yyyy-MM-dd'T'HH:mm:ss"))
    runs = _runs(spark, sf).select(F.col("id").alias("run_id"), F.col("started_at").cast("timestamp").alias("now"))
    named = table(spark, sf, "matches").groupBy(F.col("item_id").alias("id")).agg(F.sort_array(F.collect_set("name_id")).alias("name_ids"))
    return i.join(runs, "run_id").join(named, "id", "left").withColumn("published_at", at).withColumn("name_ids", F.coalesce("name_ids", F.array().cast("array<string>"))).withColumnRenamed("canonical_url", "link")


_YEAR = f"list_min(list_filter(list_transform(regexp_extract_all({_PATH}, '(^|[-/_.])((19|20)[0-9][0-9])([-/_.]|$)', 2), lambda x: CAST(x AS INTEGER)), lambda y: y BETWEEN 1990 AND 2100))"
_AGED = f"""
    WITH {ITEMS}, u AS ({_CANON.replace('raw_link', 'canonical_url')}), c AS ({_DATED}), e AS (SELECT id, form, regexp_replace(x, '[^0-9]', '', 'g') AS d FROM c),
    b AS (SELECT id, min(TRY_CAST(CASE form WHEN 'ymd' THEN d[1:4] || '-' || d[5:6] || '-' || d[7:8] ELSE d[5:8] || '-' || d[3:4] || '-' || d[1:2] END AS DATE)) AS day FROM e GROUP BY 1),
    r AS (SELECT DISTINCT id AS run_id, started_at AS now, started_at - INTERVAL 72 HOUR AS cutoff FROM runs),
    x AS (SELECT i.id, i.title, i.canonical_url, i.route, r.cutoff, b.day, {_YEAR} AS y, {_DM.format(2)} || '-' || {_DM.format(1)} AS md,
          CASE WHEN regexp_full_match(published_at, '[0-9]{{4}}-[0-9][0-9]-[0-9][0-9]T[0-9][0-9]:[0-9][0-9]:[0-9][0-9]\\+00:00') THEN TRY_CAST(left(published_at, 19) AS TIMESTAMP) END AS p FROM i JOIN r USING (run_id) LEFT JOIN b ON b.id = i.id),
    z AS (SELECT *, CAST(p AS DATE) AS pd, CASE WHEN TRY_CAST(year(p) || '-' || md AS DATE) <= CAST(p AS DATE) THEN TRY_CAST(year(p) || '-' || md AS DATE) WHEN TRY_CAST((year(p) - 1) || '-' || md AS DATE) <= CAST(p AS DATE) THEN TRY_CAST((year(p) - 1) || '-' || md AS DATE) END AS tail FROM x),
    a AS (SELECT id, canonical_url, CASE WHEN coalesce(title, '') = '' OR coalesce(canonical_url, '') = '' THEN 'empty' WHEN p < cutoff THEN 'stale_date' WHEN p IS NULL AND route IN ('googlenews', 'bingnews', 'gdelt') THEN 'stale_undated'
          WHEN y < year(cutoff) THEN 'stale_year' WHEN (p IS NULL AND day < CAST(cutoff AS DATE)) OR (p IS NOT NULL AND (coalesce(day < pd - 14, false) OR coalesce(tail < pd - 14, false))) THEN 'stale_redated' END AS outcome FROM z)
"""


@query("c2_staleness", _AGED + " SELECT id, coalesce(outcome, 'fresh') AS outcome FROM a")
def c2_staleness(spark, sf):
    """Every mention's age against the start of its run: claimed date, missing date, year and date in the address, headline."""
    return curation.arrivals(_mentions(spark, sf), 72, hosts=HOSTS).select("id", F.coalesce("outcome", F.lit("fresh")).alias("outcome"))


@query("c8_first_of_page", _AGED + " SELECT id, original FROM (SELECT a.id, min(a.id) OVER (PARTITION BY u.url) AS original FROM a JOIN u ON u.id = a.id WHERE a.outcome IS NULL) t WHERE id <> original")
def c8(spark, sf):
    """Mentions of a page that an earlier fresh mention brought in, with that one."""
    rows = curation.arrivals(_mentions(spark, sf), 72, hosts=HOSTS)
    nothing = spark.createDataFrame([], "id bigint, canonical_url string")
    return curation.duplicates(rows, nothing)[1].select("id", "original")


@query("c_pass_outcomes")
def c_pass(spark, sf):
    """The whole pass: the newer half of the runs against the older one as the store, with the outcome of every mention."""
    rows = _mentions(spark, sf)
    half = _runs(spark, sf).agg(F.expr("CAST(max(id) / 2 AS BIGINT)").alias("half"))
    split = rows.join(F.broadcast(half))
    old = split.where("run_id <= half").select(
        "id", F.col("link").alias("canonical_url"), "title", T.title_key(F.col("title"), F.col("source_name")).alias("title_key"), "summary", "source_name", "source_domain",
        "published_at", F.unix_seconds("now").alias("at"), F.lit("candidate").alias("status"), F.array().cast("array<string>").alias("also_routes"),
    )
    rules = spark.createDataFrame(RULES, "ordinal int, kind string, pattern string")
    names = table(spark, sf, "names").select("id", "kind", "watch", "aliases")
    done = curation.curate(split.where("run_id > half").drop("half"), old, table(spark, sf, "matches").select("item_id", "name_id"), names, rules, LEXICON, hosts=HOSTS)
    return done.outcomes.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))
