"""Queries of the reporting, matching, scheduling and curation operators over the test tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.functions import titles as T
from presslens.functions import urls as U
from presslens.operators import clusters, ledger, matching, scheduling
from presslens.session import table

# DuckDB views that the SQL below starts from: distinct items and matches, and the derived ledger.
ITEMS = "i AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id) AS rn_ FROM items) WHERE rn_ = 1)"
MATCHES = "m AS (SELECT DISTINCT item_id, name_id, alias, where_, confidence FROM matches)"
LEDGER = ITEMS + """, l AS (SELECT run_id, route, query AS source, bool_or(status <> 'screened') AS ok, count(*) FILTER (WHERE status = 'candidate') AS items,
    coalesce(max(CASE WHEN status = 'screened' THEN 'refused upstream: ' || screen_reason END), '') AS error FROM i GROUP BY 1, 2, 3)"""
RECENT = "recent AS (SELECT id FROM runs WHERE started_at >= (SELECT max(started_at) FROM runs) - INTERVAL {h} HOUR)"

LEXICON = {"bid": r"(?i)\b(bid|takeover|opa|acquisition|aquisição|rachat|Übernahme|bud|ostotarjous)\b", "loans": r"(?i)\b(loans?|lån|kredite|crédits|préstamos|prestiti|lainat)\b", "court": r"(?i)\b(court|gericht|tribunal|tribunale|domstol|oikeus|rechter|sąd)\b", "rating": r"(?i)\b(downgraded|dégradée|declassato|rebaixada|stuft)\b"}
RULES = [(1, "domain", "mevapress.example"), (2, "domain", "gola.example"), (3, "url", "/story.php"), (4, "title", r"(?i)\b(video|updated)\b"), (5, "title", r"(?i)^live:")]

#: Redirect hosts of the test tables beside the usual ones.
HOSTS = [*U.REDIRECT_HOSTS, "search.example"]

Q: dict = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a callable of (spark, sf_dir) and its DuckDB SQL."""

    def add(f):
        Q[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _runs(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "runs").dropDuplicates(["id"])


# ---- scalar functions -------------------------------------------------------------------------------------------

_AUTH = r"lower(regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_HOST = f"regexp_replace(regexp_replace({_AUTH}, '^.*@', ''), ':.*$', '')"


@query("fn_domain_of", f"WITH {ITEMS} SELECT id, regexp_replace(regexp_replace(regexp_replace(regexp_replace({_HOST}, '^www\\.', ''), '^m\\.', ''), '^amp\\.', ''), '^mobile\\.', '') AS domain FROM (SELECT id, raw_link AS u FROM i)")
def fn_domain_of(spark, sf):
    """Domain of every raw link."""
    return ledger.items(spark, sf, "raw_link").select("id", U.domain_of(F.col("raw_link")).alias("domain"))


_TARGET = "url_decode(substr(list_filter(string_split(regexp_extract(u, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: starts_with(x, 'url='))[1], 5))"
_UNWRAPPED = f"CASE WHEN ends_with({_AUTH}, 'search.example') AND starts_with({_TARGET}, 'http') THEN {_TARGET} ELSE u END"
_TRACK = ", ".join(f"'{p}'" for p in U.TRACKING_PARAMS)
_CANON = f"""
    WITH {ITEMS}, w AS (SELECT id, {_UNWRAPPED} AS u FROM (SELECT id, trim(raw_link) AS u FROM i)),
    p AS (SELECT id, u, regexp_extract(u, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1) AS path, regexp_replace({_AUTH}, '^www\\.', '') AS host,
          lower(regexp_extract(u, '^([A-Za-z][A-Za-z0-9+.-]*)://', 1)) AS scheme,
          list_sort(list_filter(string_split(regexp_extract(u, '^[^?#]*\\?([^#]*)', 1), '&'), lambda x: x <> '' AND NOT starts_with(lower(string_split(x, '=')[1]), 'utm_') AND lower(string_split(x, '=')[1]) NOT IN ({_TRACK}))) AS raw FROM w),
    k AS (SELECT *, list_transform(list_sort(list_transform(raw, lambda x: {{'k': url_decode(replace(string_split(x, '=')[1], '+', ' ')), 'v': url_decode(replace(CASE WHEN contains(x, '=') THEN substr(x, strpos(x, '=') + 1) ELSE '' END, '+', ' '))}})),
          lambda x: replace(url_encode(x.k), '%20', '+') || '=' || replace(url_encode(x.v), '%20', '+')) AS keep FROM p),
    q AS (SELECT *, regexp_replace(regexp_replace(regexp_replace(regexp_replace(path, '/+', '/', 'g'), '/index\\.html?$', '/'), '(.)/$', '\\1'), '/amp/?$', '') AS tidy FROM k)
    SELECT id, scheme || '://' || host || CASE WHEN tidy = '' THEN '/' ELSE tidy END || CASE WHEN len(keep) > 0 THEN '?' || array_to_string(keep, '&') ELSE '' END AS url FROM q"""


@query("fn_unwrap_redirect", f"WITH {ITEMS} SELECT id, {_UNWRAPPED} AS url FROM (SELECT id, raw_link AS u FROM i)")
def fn_unwrap_redirect(spark, sf):
    """Target of every raw link."""
    return ledger.items(spark, sf, "raw_link").select("id", U.unwrap_redirect(F.col("raw_link"), HOSTS).alias("url"))


@query("fn_canonical_url", _CANON)
def fn_canonical_url(spark, sf):
    """Canonical address of every raw link."""
    return ledger.items(spark, sf, "raw_link").select("id", U.canonical_url(F.col("raw_link"), HOSTS).alias("url"))


_PATH = "regexp_extract(canonical_url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1)"


@query("fn_url_year", f"WITH {ITEMS} SELECT id, CAST(list_min(list_filter(list_transform(regexp_extract_all({_PATH}, '(^|[-/_.])((19|20)[0-9][0-9])([-/_.]|$)', 2), lambda x: CAST(x AS INTEGER)), lambda y: y BETWEEN 1990 AND 2100)) AS INTEGER) AS year FROM i")
def fn_url_year(spark, sf):
    """Publication year written into every address."""
    return ledger.items(spark, sf, "canonical_url").select("id", U.url_year(F.col("canonical_url")).alias("year"))


_DATED = " UNION ALL ".join(
    f"SELECT id, unnest(regexp_extract_all(p, '{pattern}')) AS x, '{form}' AS form FROM (SELECT id, {_PATH} AS p FROM i)"
    for pattern, form in (("(^|[-/_.])(19|20)[0-9]{2}[-/_.][0-9]{2}[-/_.][0-9]{2}([-/_.]|$)", "ymd"), ("(^|[-/_])[0-9]{2}[.][0-9]{2}[.](19|20)[0-9]{2}([-/_.]|$)", "dmy"), ("(^|[-/_])(19|20)[0-9]{6}([-/_]|$)", "ymd"))
)


@query("fn_url_date", f"WITH {ITEMS}, c AS ({_DATED}), e AS (SELECT id, form, regexp_replace(x, '[^0-9]', '', 'g') AS d FROM c), b AS (SELECT id, min(TRY_CAST(CASE form WHEN 'ymd' THEN d[1:4] || '-' || d[5:6] || '-' || d[7:8] ELSE d[5:8] || '-' || d[3:4] || '-' || d[1:2] END AS DATE)) AS day FROM e GROUP BY 1) SELECT i.id, b.day FROM i LEFT JOIN b ON b.id = i.id")
def fn_url_date(spark, sf):
    """Publication date written into every address."""
    return ledger.items(spark, sf, "canonical_url").select("id", U.url_date(F.col("canonical_url")).alias("day"))


@query("fn_title_key")
def fn_title_key(spark, sf):
    """Key of every title, without its source's name."""
    return ledger.items(spark, sf, "title", "source_name").select("id", T.title_key(F.col("title"), F.col("source_name")).alias("key"))


_STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)


@query("fn_tokens", f"WITH {ITEMS} SELECT id, list_sort(list_distinct(list_filter(string_split(title_key, ' '), lambda w: length(w) > 2 AND w NOT IN ({_STOP})))) AS tokens FROM i")
def fn_tokens(spark, sf):
    """Telling words of every key, sorted."""
    return ledger.items(spark, sf, "title_key").select("id", F.array_sort(T.tokens(F.col("title_key"))).alias("tokens"))


@query("fn_strip_html", f"WITH {ITEMS} SELECT id, trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(coalesce(summary, ''), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&quot;', '\"'), '&#39;|&apos;', chr(39), 'g'), '[ \\t\\n\\r\\f\\x0b]+', ' ', 'g'), ' ') AS text FROM i")
def fn_strip_html(spark, sf):
    """Summaries without markup."""
    return ledger.items(spark, sf, "summary").select("id", T.strip_html(F.col("summary")).alias("text"))


_DM = r"regexp_extract(title, '\s[-–]\s(0[1-9]|[12][0-9]|3[01])/(0[1-9]|1[0-2])\s*$', {})"


@query("fn_trailing_date", f"WITH {ITEMS}, r AS (SELECT DISTINCT id AS run_id, started_at FROM runs), t AS (SELECT i.id, CAST(started_at AS DATE) AS p, {_DM.format(2)} || '-' || {_DM.format(1)} AS md FROM i JOIN r USING (run_id)), u AS (SELECT id, p, TRY_CAST(year(p) || '-' || md AS DATE) AS a, TRY_CAST((year(p) - 1) || '-' || md AS DATE) AS b FROM t) SELECT id, CASE WHEN a <= p THEN a WHEN b <= p THEN b END AS day FROM u")
def fn_trailing_date(spark, sf):
    """Date at the end of a headline, against the start of its run."""
    runs = _runs(spark, sf).select(F.col("id").alias("run_id"), "started_at")
    return ledger.items(spark, sf, "title", "run_id").join(runs, "run_id").select("id", T.trailing_date(F.col("title"), F.col("started_at")).alias("day"))


@query("fn_on_domains", f"WITH {ITEMS}, o AS (SELECT DISTINCT regexp_extract(homepage, '//([^/]*)', 1) AS d FROM outlets WHERE tier <= 1) SELECT id, EXISTS (SELECT 1 FROM o WHERE source_domain = d OR ends_with(source_domain, '.' || d)) AS on_first_tier FROM i")
def fn_on_domains(spark, sf):
    """Whether the item's domain is one of, or below, a first-tier outlet's: a join on all suffixes of the domain."""
    o = table(spark, sf, "outlets").where("tier <= 1").select(U.domain_of(F.col("homepage")).alias("d")).distinct()
    parts = F.split("source_domain", r"\.")
    suffix = F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, k, F.size(parts)), ".")))
    i = ledger.items(spark, sf, "source_domain")
    hit = i.select("id", suffix.alias("d")).join(o, "d", "left_semi").select("id", F.lit(True).alias("h")).distinct()
    return i.join(hit, "id", "left").select("id", F.coalesce("h", F.lit(False)).alias("on_first_tier"))


@query("fn_article_links", f"WITH {ITEMS} SELECT id, {_AUTH.replace('u,', 'raw_link,')} = {_AUTH.replace('u,', 'canonical_url,')} AND length(rtrim(regexp_extract(raw_link, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/')) >= 12 AND length(coalesce(title, '')) >= 20 AS is_article FROM i")
def fn_article_links(spark, sf):
    """Whether each raw link looks like an article of the page's own host."""
    i = ledger.items(spark, sf, "raw_link", "canonical_url", "title")
    return i.select("id", U.looks_like_article(F.col("raw_link"), F.coalesce("title", F.lit("")), F.col("canonical_url")).alias("is_article"))


@query("fn_week_key", "SELECT DISTINCT id, strftime(started_at, '%G-W%V') AS week FROM runs")
def fn_week_key(spark, sf):
    """ISO week of every run, the key of the once-a-week guard."""
    return _runs(spark, sf).select("id", F.concat(F.extract(F.lit("YEAROFWEEK"), F.col("started_at")), F.lit("-W"), F.lpad(F.weekofyear("started_at").cast("string"), 2, "0")).alias("week"))


# ---- ledger reports ---------------------------------------------------------------------------------------------


@query("a1_last_attempts", f"WITH {LEDGER} SELECT route, source, max(run_id) AS last_run FROM l WHERE NOT starts_with(error, 'skipped:') GROUP BY 1, 2")
def a1(spark, sf):
    """Last run that sent each query."""
    return ledger.last_attempts(ledger.ledger(spark, sf))


@query("a2_zero_yield", f"WITH {LEDGER} SELECT route, source, count(*) AS sends, sum(items) AS total_items FROM l WHERE NOT starts_with(error, 'skipped:') GROUP BY 1, 2 HAVING count(*) >= 3 AND sum(items) = 0")
def a2(spark, sf):
    """Queries that never yield."""
    return ledger.zero_yield(ledger.ledger(spark, sf))


@query("a3_source_outcomes", f"WITH {LEDGER}, {RECENT.format(h=168)} SELECT source, count(*) FILTER (WHERE ok) AS n_ok, count(*) AS n_jobs FROM l WHERE run_id IN (SELECT id FROM recent) GROUP BY 1")
def a3(spark, sf):
    """Outcomes of the last week by query."""
    return ledger.outcomes(ledger.since(ledger.ledger(spark, sf), _runs(spark, sf), 168))


@query("a4_name_domain_last_seen", f"WITH {ITEMS}, {MATCHES} SELECT m.name_id, i.source_domain, max(r.started_at)::VARCHAR AS latest FROM m JOIN i ON i.id = m.item_id JOIN (SELECT DISTINCT * FROM runs) r ON r.id = i.run_id GROUP BY 1, 2")
def a4(spark, sf):
    """Newest run that brought each name from each domain."""
    i, r = ledger.items(spark, sf, "source_domain", "run_id"), _runs(spark, sf).select(F.col("id").alias("run_id"), "started_at")
    m = ledger.matches(spark, sf).select(F.col("item_id").alias("id"), "name_id")
    return m.join(i, "id").join(r, "run_id").groupBy("name_id", "source_domain").agg(F.max("started_at").cast("string").alias("latest"))


@query("a5_name_mentions", f"WITH {ITEMS}, {MATCHES}, {RECENT.format(h=168)} SELECT m.name_id, count(*) AS total, count(*) FILTER (WHERE i.run_id IN (SELECT id FROM recent)) AS recent, max(i.run_id) AS latest_run FROM m JOIN i ON i.id = m.item_id GROUP BY 1")
def a5(spark, sf):
    """Mentions of each name in all and in the last week."""
    m = ledger.matches(spark, sf).select(F.col("item_id").alias("id"), "name_id")
    runs = _runs(spark, sf)
    recent = runs.join(F.broadcast(runs.agg(F.max("started_at").alias("last")))).where(F.col("started_at") >= F.col("last") - F.expr("INTERVAL 168 HOURS")).select(F.col("id").alias("run_id"), F.lit(True).alias("is_recent"))
    j = m.join(ledger.items(spark, sf, "run_id"), "id").join(recent, "run_id", "left")
    return j.groupBy("name_id").agg(F.count(F.lit(1)).alias("total"), F.count("is_recent").alias("recent"), F.max("run_id").alias("latest_run"))


@query("a6_starved", f"WITH {LEDGER} SELECT route, source, count(*) AS n_runs, sum(items) AS n_items, max(error) AS last_error FROM l GROUP BY 1, 2 HAVING NOT bool_or(ok)")
def a6(spark, sf):
    """Queries that never answered."""
    return ledger.starved(ledger.ledger(spark, sf))


@query("a7_silent_watchers", f"WITH {LEDGER} SELECT route, source, count(*) FILTER (WHERE ok) AS ok_runs, count(*) AS n_runs, sum(items) AS n_items FROM l WHERE route IN ('page', 'rss') GROUP BY 1, 2 HAVING bool_or(ok) AND sum(items) = 0")
def a7(spark, sf):
    """Watchers that answer and bring nothing."""
    return ledger.silent_watchers(ledger.ledger(spark, sf))


@query("a8_source_health", f"WITH {LEDGER} SELECT route, source, count(*) FILTER (WHERE ok) AS ok_runs, count(*) AS n_runs, sum(items) AS n_items, max(CASE WHEN NOT ok THEN error ELSE '' END) AS last_error FROM l WHERE run_id IN (SELECT DISTINCT id FROM runs ORDER BY id DESC LIMIT 4) GROUP BY 1, 2")
def a8(spark, sf):
    """Health over the last four runs."""
    return ledger.health(ledger.ledger(spark, sf), _runs(spark, sf))


@query("a9_unnotified_alerts", f"WITH {ITEMS}, {MATCHES} SELECT i.id, string_agg(DISTINCT m.name_id, ',' ORDER BY m.name_id) AS name_ids FROM i JOIN m ON m.item_id = i.id WHERE i.alert_candidate AND i.notified_at IS NULL AND i.status = 'candidate' GROUP BY 1")
def a9(spark, sf):
    """Alerts still to be sent, with their names."""
    i = ledger.items(spark, sf, "alert_candidate", "notified_at", "status").where("alert_candidate AND notified_at IS NULL AND status = 'candidate'")
    return i.join(ledger.matches(spark, sf).withColumnRenamed("item_id", "id"), "id").groupBy("id").agg(F.array_join(F.array_sort(F.collect_set("name_id")), ",").alias("name_ids"))


@query("a10_stats", f"WITH {ITEMS}, {MATCHES} SELECT (SELECT count(*) FROM i) AS n_items, (SELECT count(*) FROM i WHERE status = 'candidate') AS n_candidates, (SELECT count(*) FROM i WHERE status = 'screened') AS n_screened, (SELECT count(*) FROM (SELECT DISTINCT item_id, name_id FROM m)) AS n_matches, (SELECT count(DISTINCT id) FROM runs) AS n_runs, (SELECT count(DISTINCT source_domain) FROM i) AS n_domains")
def a10(spark, sf):
    """Counts of the store, one pass per table."""
    i = ledger.items(spark, sf, "status", "source_domain").agg(F.count(F.lit(1)).alias("n_items"), F.count_if(F.col("status") == "candidate").alias("n_candidates"), F.count_if(F.col("status") == "screened").alias("n_screened"), F.countDistinct("source_domain").alias("n_domains"))
    return i.join(ledger.matches(spark, sf).agg(F.count(F.lit(1)).alias("n_matches"))).join(_runs(spark, sf).agg(F.count(F.lit(1)).alias("n_runs")))


@query("a12_cluster_rollup", f"""WITH {ITEMS}, {MATCHES}, x AS (SELECT m.name_id, coalesce(i.cluster_id, -i.id) AS cluster, i.*, m.alias, m.confidence FROM i JOIN (SELECT item_id, name_id, min(alias) AS alias, max(confidence) AS confidence FROM m GROUP BY 1, 2) m ON m.item_id = i.id WHERE i.status = 'candidate'),
    r AS (SELECT *, row_number() OVER (PARTITION BY name_id, cluster ORDER BY coalesce(tier_hint, 9), id) AS rk FROM x)
    SELECT name_id, cluster, max(CASE WHEN rk = 1 THEN id END) AS primary_id, count(*) AS n_items, count(DISTINCT source_domain) AS n_sources, bool_or(alert_candidate) AS is_alert, max(confidence) AS max_confidence, list_sort(list(DISTINCT alias)) AS aliases, coalesce(list_sort(list(DISTINCT country) FILTER (WHERE country IS NOT NULL)), []) AS countries, coalesce(list_sort(list(id) FILTER (WHERE rk BETWEEN 2 AND 11)), []) AS also FROM r GROUP BY 1, 2""")
def a12(spark, sf):
    """Every cluster of every name with its primary item, up to ten others and its distinct attributes."""
    m = ledger.matches(spark, sf)
    m = table(spark, sf, "matches").groupBy(F.col("item_id").alias("id"), "name_id").agg(F.min("alias").alias("alias"), F.max("confidence").alias("confidence"))
    i = ledger.items(spark, sf, "cluster_id", "tier_hint", "source_domain", "alert_candidate", "country", "status").where("status = 'candidate'")
    x = i.join(m, "id").withColumn("cluster", F.coalesce("cluster_id", -F.col("id")))
    x = x.withColumn("rk", F.row_number().over(Window.partitionBy("name_id", "cluster").orderBy(F.coalesce("tier_hint", F.lit(9)), "id")))
    return x.groupBy("name_id", "cluster").agg(
        F.max(F.when(F.col("rk") == 1, F.col("id"))).alias("primary_id"), F.count(F.lit(1)).alias("n_items"), F.countDistinct("source_domain").alias("n_sources"), F.bool_or("alert_candidate").alias("is_alert"),
        F.max("confidence").alias("max_confidence"), F.array_sort(F.collect_set("alias")).alias("aliases"), F.array_sort(F.collect_set("country")).alias("countries"), F.array_sort(F.collect_list(F.when(F.col("rk").between(2, 11), F.col("id")))).alias("also"),
    )


@query("a13_screen_reasons", f"WITH {ITEMS} SELECT string_split(screen_reason, ':')[1] AS reason, count(*) AS n FROM i WHERE status = 'screened' GROUP BY 1")
def a13(spark, sf):
    """Histogram of screening reasons."""
    return ledger.items(spark, sf, "status", "screen_reason").where("status = 'screened'").groupBy(F.get(F.split("screen_reason", ":"), F.lit(0)).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


@query("a14_name_headers", f"WITH {ITEMS}, {MATCHES} SELECT n.id AS name_id, n.kind, count(DISTINCT i.id) AS n_items, count(DISTINCT CASE WHEN i.status = 'candidate' THEN i.id END) AS n_candidates, count(DISTINCT CASE WHEN i.alert_candidate THEN i.id END) AS n_alerts, count(DISTINCT i.cluster_id) AS n_clusters FROM names n LEFT JOIN m ON m.name_id = n.id LEFT JOIN i ON i.id = m.item_id GROUP BY 1, 2")
def a14(spark, sf):
    """Counts of each name, names without items included."""
    n = table(spark, sf, "names").select(F.col("id").alias("name_id"), "kind")
    m = ledger.matches(spark, sf).select(F.col("item_id").alias("id"), "name_id")
    j = n.join(m.join(ledger.items(spark, sf, "status", "alert_candidate", "cluster_id"), "id"), "name_id", "left")
    return j.groupBy("name_id", "kind").agg(F.count("id").alias("n_items"), F.count_if(F.col("status") == "candidate").alias("n_candidates"), F.count_if("alert_candidate").alias("n_alerts"), F.countDistinct("cluster_id").alias("n_clusters"))


_COVER = f"WITH {LEDGER}, {MATCHES}, per AS (SELECT DISTINCT i.run_id, i.route, i.query AS source, m.name_id FROM i JOIN m ON m.item_id = i.id), c AS (SELECT n.id AS name_id, count(l.run_id) AS jobs, count(*) FILTER (WHERE l.ok) AS n_ok, count(*) FILTER (WHERE NOT l.ok AND l.error LIKE '%refused upstream%') AS n_refused, count(*) FILTER (WHERE NOT l.ok AND l.error NOT LIKE '%refused upstream%') AS n_failed FROM names n LEFT JOIN per p ON p.name_id = n.id LEFT JOIN l ON l.run_id = p.run_id AND l.route = p.route AND l.source = p.source GROUP BY 1)"


@query("a15_coverage", _COVER + " SELECT * FROM c")
def a15(spark, sf):
    """Outcomes of the queries that swept each name."""
    i = ledger.items(spark, sf, "run_id", "route", "query").withColumnRenamed("query", "source")
    per = i.join(ledger.matches(spark, sf).select(F.col("item_id").alias("id"), "name_id"), "id").select("run_id", "route", "source", "name_id").distinct()
    j = table(spark, sf, "names").select(F.col("id").alias("name_id")).join(per.join(ledger.ledger(spark, sf), ["run_id", "route", "source"]), "name_id", "left")
    refused = F.contains("error", F.lit("refused upstream"))
    return j.groupBy("name_id").agg(F.count("run_id").alias("jobs"), F.count_if("ok").alias("n_ok"), F.count_if(~F.col("ok") & refused).alias("n_refused"), F.count_if(~F.col("ok") & ~refused).alias("n_failed"))


@query("a16_coverage_state", _COVER + " SELECT name_id, CASE WHEN jobs = 0 THEN 'NO_QUERIES' WHEN n_ok = 0 THEN 'STARVED' ELSE 'ok' END AS state FROM c")
def a16(spark, sf):
    """State of each name from its coverage."""
    return a15(spark, sf).select("name_id", F.when(F.col("jobs") == 0, "NO_QUERIES").when(F.col("n_ok") == 0, "STARVED").otherwise("ok").alias("state"))


@query("a24_country_audit", f"WITH {ITEMS}, o AS (SELECT country, count(*) AS n_outlets, count(*) FILTER (WHERE feed_url IS NOT NULL AND enabled) AS n_feeds FROM outlets GROUP BY 1), c AS (SELECT country, count(*) AS n_items, count(DISTINCT source_domain) AS n_domains FROM i WHERE country <> '' GROUP BY 1) SELECT k.country, coalesce(n_outlets, 0) AS n_outlets, coalesce(n_feeds, 0) AS n_feeds, coalesce(n_items, 0) AS n_items, coalesce(n_domains, 0) AS n_domains FROM markets k LEFT JOIN o ON o.country = k.country LEFT JOIN c ON c.country = k.country")
def a24(spark, sf):
    """Outlets, feeds and items of each market."""
    o = table(spark, sf, "outlets").groupBy("country").agg(F.count(F.lit(1)).alias("n_outlets"), F.count_if(F.col("feed_url").isNotNull() & F.col("enabled")).alias("n_feeds"))
    c = ledger.items(spark, sf, "country", "source_domain").where("country <> ''").groupBy("country").agg(F.count(F.lit(1)).alias("n_items"), F.countDistinct("source_domain").alias("n_domains"))
    j = table(spark, sf, "markets").select("country").join(o, "country", "left").join(c, "country", "left")
    return j.select("country", *(F.coalesce(x, F.lit(0)).alias(x) for x in ("n_outlets", "n_feeds", "n_items", "n_domains")))


@query("a18_upper_median", "SELECT r.route, list_sort(list(r.n))[len(list(r.n)) // 2 + 1] AS upper_median, count(*) AS n_runs FROM (SELECT route, run_id, count(DISTINCT id) AS n FROM items GROUP BY 1, 2) r GROUP BY 1")
def a18(spark, sf):
    """Upper median of the items a run brings by route, from ranks rather than collected lists."""
    r = ledger.items(spark, sf, "route", "run_id").groupBy("route", "run_id").agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy("route")
    ranked = r.withColumn("rn", F.row_number().over(w.orderBy("n", "run_id"))).withColumn("n_runs", F.count(F.lit(1)).over(w))
    return ranked.where(F.col("rn") == F.floor(F.col("n_runs") / 2) + 1).select("route", F.col("n").alias("upper_median"), "n_runs")


@query("a26_top_names", f"WITH {MATCHES}, c AS (SELECT name_id, count(DISTINCT item_id) AS n FROM m GROUP BY 1), k AS (SELECT *, row_number() OVER (ORDER BY n DESC, name_id) AS rk FROM c) SELECT CASE WHEN rk <= 8 THEN name_id ELSE 'others' END AS name_id, CAST(sum(n) AS BIGINT) AS n FROM k GROUP BY 1")
def a26(spark, sf):
    """The eight most mentioned names and the rest in one row; the ranking sees one row per name."""
    c = ledger.matches(spark, sf).groupBy("name_id").agg(F.count(F.lit(1)).alias("n"))
    top = c.orderBy(F.desc("n"), "name_id").limit(8).select("name_id", F.lit(True).alias("top"))
    return c.join(top, "name_id", "left").groupBy(F.when(F.col("top"), F.col("name_id")).otherwise("others").alias("name_id")).agg(F.sum("n").alias("n"))
