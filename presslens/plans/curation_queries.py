"""Queries of the joins, windows, set operations, sources, sinks and stateful operators over the test tables."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import Window
from pyspark.sql import functions as F

from presslens.functions import titles as T
from presslens.functions import urls as U
from presslens.operators import clusters, ledger, matching, scheduling
from presslens.plans.core_queries import HOSTS, ITEMS, LEDGER, LEXICON, MATCHES, RECENT, RULES, _runs, query
from presslens.session import cut, ensure_checkpoint_dir, table
from presslens.sources import feeds, store
from presslens.streaming import incremental

_CLEAN = r"trim(regexp_replace(regexp_replace(replace(replace(replace(regexp_replace(coalesce({c}, ''), '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&amp;', '&'), '&quot;', '\"'), '&#39;|&apos;', chr(39), 'g'), '[ \t\n\r\f\x0b]+', ' ', 'g'), ' ')"


def _link_page(spark, sf):
    """A page per outlet and run with links to its items: an article link, a feed by name, a declared feed and a mail link."""
    i = ledger.items(spark, sf, "source_domain", "canonical_url", "title")
    anchor = F.concat(F.lit('<a href="'), _xml("canonical_url"), F.lit('">'), _xml("title"), F.lit("</a>"))
    more = F.lit('<a href="/news/rss.xml">RSS</a><a href="mailto:a@b.test">feed</a><link rel="alternate" type="application/atom+xml" href="/atom">')
    return i.where("canonical_url IS NOT NULL AND title IS NOT NULL").select(F.concat(F.lit("https://"), "source_domain", F.lit("/?i="), "id").alias("page_url"), F.concat(anchor, more).alias("html"))


# ---- sources ----------------------------------------------------------------------------------------------------


def _xml(c: str):
    out = F.coalesce(F.col(c), F.lit(""))
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(a), F.lit(b))
    return out


@query("s4_rss", f"WITH {ITEMS} SELECT id, run_id, {_CLEAN.format(c='title')} AS title, raw_link AS link FROM (SELECT id, run_id, title, {{t}} AS raw_link FROM i)".replace("{t}", "CASE WHEN contains(raw_link, 'search.example/redirect?url=') THEN url_decode(regexp_extract(raw_link, 'url=([^&#]*)', 1)) ELSE raw_link END"))
def s4(spark, sf):
    """Every item written as a feed entry and parsed back."""
    i = ledger.items(spark, sf, "run_id", "title", "raw_link", "summary")
    entry = F.concat(F.lit("<rss><channel><title>f</title><item><title>"), _xml("title"), F.lit("</title><link>"), _xml("raw_link"), F.lit("</link><description>"), _xml("summary"), F.lit("</description></item></channel></rss>"))
    return feeds.parse_rss(i.select("id", "run_id", entry.alias("doc")), hosts=HOSTS).select("id", "run_id", "title", "link")


@query("s6_articles", f"SELECT DISTINCT gdelt_id, {_CLEAN.format(c='title')} AS title, url AS link, left(lower(language), 12) AS lang, sourcecountry AS country FROM gdelt")
def s6(spark, sf):
    """Every article row written as an API answer and parsed back."""
    g = table(spark, sf, "gdelt").dropDuplicates(["gdelt_id"])
    doc = F.to_json(F.struct(F.array(F.struct("url", "url_mobile", "title", "seendate", "domain", "language", "sourcecountry")).alias("articles")))
    return feeds.parse_articles(g.select("gdelt_id", doc.alias("doc"))).select("gdelt_id", "title", "link", "lang", "country")


@query("s8_page_links", f"WITH {ITEMS} SELECT 'https://' || source_domain || '/' AS page_url, canonical_url AS link, count(*) AS n FROM (SELECT source_domain, string_split(canonical_url, '#')[1] AS canonical_url FROM i) GROUP BY 1, 2")
def s8(spark, sf):
    """Every item as a link on a page of its source, extracted again."""
    i = ledger.items(spark, sf, "source_domain", "canonical_url", "title")
    html = F.concat(F.lit('<html><body><a href="'), _xml("canonical_url"), F.lit('">'), _xml("title"), F.lit('</a><a href="mailto:x">m</a></body></html>'))
    pages = i.select(F.concat(F.lit("https://"), "source_domain", F.lit("/")).alias("page_url"), html.alias("html"))
    return feeds.extract_links(pages).groupBy("page_url", "link").agg(F.count(F.lit(1)).alias("n"))


@query("s1_search_urls", "SELECT n.id AS name_id, k.country, 'https://news.example/rss/search?q=' || replace(url_encode(n.name || ' when:1d'), '%20', '+') || '&hl=' || k.lang || '&gl=' || k.country || '&ceid=' || k.country || ':' || k.lang AS url FROM names n JOIN markets k ON k.country = n.home_country")
def s1(spark, sf):
    """Search address of every name in its home market."""
    n = table(spark, sf, "names").select(F.col("id").alias("name_id"), "name", F.col("home_country").alias("country"))
    return n.join(table(spark, sf, "markets"), "country").select("name_id", "country", feeds.search_url(F.col("name"), F.col("lang"), F.col("country")).alias("url"))


@query("s17_store_scan", f"WITH {ITEMS} SELECT id, canonical_url, status FROM i WHERE run_id BETWEEN 10 AND 60 AND status = 'candidate'")
def s17(spark, sf):
    """Range scan of the store; filter and columns reach the Parquet reader."""
    return table(spark, sf, "items").where("run_id BETWEEN 10 AND 60 AND status = 'candidate'").select("id", "canonical_url", "status").distinct()


@query("s17_store_span", f"WITH {ITEMS}, b AS (SELECT min(started_at) AS lo, max(started_at) - min(started_at) AS span FROM runs) SELECT id, canonical_url, i.status FROM i WHERE i.status = 'candidate' AND run_id IN (SELECT r.id FROM runs r, b WHERE r.started_at >= b.lo + b.span / 4 AND r.started_at <= b.lo + b.span / 2)")
def s17_span(spark, sf):
    """Scan of the store over the second quarter of the runs' time; status and columns reach the Parquet reader."""
    runs = _runs(spark, sf).select(F.col("id").alias("run_id"), F.unix_micros(F.col("started_at").cast("timestamp")).alias("at"))
    bounds = runs.agg(F.min("at").alias("lo"), (F.max("at") - F.min("at")).alias("span"))
    wanted = runs.join(F.broadcast(bounds)).where("at >= lo + span / 4 AND at <= lo + span / 2").select("run_id")
    items = table(spark, sf, "items").where("status = 'candidate'").select("id", "canonical_url", "status", "run_id")
    return items.join(wanted, "run_id", "left_semi").select("id", "canonical_url", "status").distinct()


@query("s20_newest_copy", "SELECT route, max_by(run_id, (n, run_id)) AS run_id FROM (SELECT route, run_id, count(DISTINCT id) AS n FROM items GROUP BY 1, 2) GROUP BY 1".replace("max_by(run_id, (n, run_id))", "arg_max(run_id, n * 1000000 + run_id)"))
def s20(spark, sf):
    """Copy of highest rank, rank compared field by field."""
    c = ledger.items(spark, sf, "route", "run_id").groupBy("route", "run_id").agg(F.count(F.lit(1)).alias("n"))
    return c.groupBy("route").agg(F.max_by("run_id", F.struct("n", "run_id")).alias("run_id"))


# ---- sinks as transformations -----------------------------------------------------------------------------------


@query("k2_upsert", f"WITH {ITEMS}, s AS (SELECT source_domain, id, status, row_number() OVER (PARTITION BY source_domain, status ORDER BY id DESC) AS r FROM i) SELECT source_domain, status, id FROM s WHERE r = 1")
def k2(spark, sf):
    """Last write per source and status wins, over the older half of the runs."""
    i = ledger.items(spark, sf, "source_domain", "status", "run_id")
    cols = ["source_domain", "status", "id"]
    half = _runs(spark, sf).agg((F.max("id") / 2).cast("bigint").alias("half"))
    j = i.join(F.broadcast(half))
    older, newer = j.where("run_id <= half").select(*cols), j.where("run_id > half").select(*cols)
    first = store.upsert(spark.createDataFrame([], older.schema), older, ["source_domain", "status"], "id")
    return store.upsert(first, newer, ["source_domain", "status"], "id")


@query("k3_insert_absent", f"WITH {ITEMS}, half AS (SELECT CAST(max(id) / 2 AS BIGINT) AS h FROM runs) SELECT DISTINCT canonical_url FROM i WHERE run_id > (SELECT h FROM half) AND canonical_url NOT IN (SELECT canonical_url FROM i WHERE run_id <= (SELECT h FROM half))")
def k3(spark, sf):
    """Addresses that the newer half of the runs brings and the older half has not."""
    j = ledger.items(spark, sf, "canonical_url", "run_id").join(F.broadcast(_runs(spark, sf).agg(F.round(F.max("id") / 2).cast("bigint").alias("h"))))
    return store.insert_absent(j.where("run_id <= h").select("canonical_url"), j.where("run_id > h").select("canonical_url"), ["canonical_url"])


@query("k5_fill_only", f"WITH {ITEMS}, o AS (SELECT regexp_extract(homepage, '//([^/]*)', 1) AS d, min(nullif(name, '')) AS name FROM outlets GROUP BY 1) SELECT i.id, coalesce(nullif(i.source_name, ''), o.name, i.source_name) AS source_name FROM i LEFT JOIN o ON o.d = i.source_domain")
def k5(spark, sf):
    """Empty source names filled from the outlets, set ones kept."""
    i = ledger.items(spark, sf, "source_domain", "source_name")
    o = table(spark, sf, "outlets").select(U.domain_of(F.col("homepage")).alias("source_domain"), F.col("name").alias("source_name"))
    return store.fill_only(i, o, "source_domain", ["source_name"]).select("id", "source_name")


@query("k6_provenance", f"WITH {ITEMS}, s AS (SELECT canonical_url, list_sort(list(DISTINCT route || ':' || query)) AS v FROM i GROUP BY 1) SELECT i.id, list_sort(list_distinct(list_concat(coalesce(i.also_routes, []), coalesce(s.v, [])))) AS routes FROM i LEFT JOIN s USING (canonical_url)")
def k6(spark, sf):
    """Routes of each item with all ways its page was delivered."""
    i = ledger.items(spark, sf, "canonical_url", "also_routes", "route", "query")
    seen = i.select("canonical_url", F.concat_ws(":", "route", "query").alias("via"))
    return store.add_provenance(i, seen, "canonical_url").select("id", F.array_sort("also_routes").alias("routes"))


@query("k8_retention", f"WITH {LEDGER} SELECT run_id, count(*) AS n FROM l WHERE run_id NOT IN (SELECT id FROM runs WHERE started_at < (SELECT max(started_at) FROM runs) - INTERVAL 30 DAY) GROUP BY 1")
def k8(spark, sf):
    """Ledger rows that survive thirty days."""
    return store.retain(ledger.ledger(spark, sf), _runs(spark, sf), 30).groupBy("run_id").agg(F.count(F.lit(1)).alias("n"))


# ---- joins ------------------------------------------------------------------------------------------------------


_WORDS = "' ' || lower(regexp_replace(coalesce({c}, ''), '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g')) || ' '"


@query("j1_alias_match", f"WITH {ITEMS}, w AS (SELECT id, {_WORDS.format(c='title')} AS t, {_WORDS.format(c='summary')} AS s FROM i), a AS (SELECT id AS name_id, unnest(aliases) AS alias, unnest(range(len(aliases))) AS ord FROM names), h AS (SELECT w.id AS item_id, a.name_id, a.alias, a.ord, CASE WHEN contains(w.t, ' ' || lower(a.alias) || ' ') THEN 'title' ELSE 'summary' END AS where_ FROM w JOIN a ON contains(w.t, ' ' || lower(a.alias) || ' ') OR contains(w.s, ' ' || lower(a.alias) || ' ')), k AS (SELECT *, row_number() OVER (PARTITION BY item_id, name_id ORDER BY where_ = 'summary', ord) AS rk FROM h) SELECT item_id, name_id, alias, where_ AS \"where\", CASE WHEN where_ = 'title' THEN 1.0 ELSE 0.7 END AS confidence FROM k WHERE rk = 1")
def j1(spark, sf):
    """Best alias of every item and name."""
    return matching.match_aliases(ledger.items(spark, sf, "title", "summary"), matching.alias_table(table(spark, sf, "names")))


@query("j3_screen", f"WITH {ITEMS}, h AS (SELECT id, CASE WHEN source_domain = 'mevapress.example' OR ends_with(source_domain, '.mevapress.example') THEN 'noise_domain:mevapress.example' WHEN source_domain = 'gola.example' THEN 'noise_domain:gola.example' WHEN contains(canonical_url, '/story.php') THEN 'noise_url:/story.php' WHEN regexp_matches(title, '(?i)\\b(video|updated)\\b') THEN 'noise_title:(?i)\\b(video|updated)\\b' WHEN regexp_matches(title, '(?i)^live:') THEN 'noise_title:(?i)^live:' END AS reason FROM i) SELECT id, reason FROM h WHERE reason IS NOT NULL")
def j3(spark, sf):
    """First screening rule that hits each item."""
    rules = spark.createDataFrame(RULES, "ordinal int, kind string, pattern string")
    return matching.screen(ledger.items(spark, sf, "source_domain", "canonical_url", "title"), rules)


_HIT = ", ".join(f"CASE WHEN regexp_matches(coalesce({{c}}, ''), '{p}') THEN '{c}' END" for c, p in LEXICON.items())


@query("j4_categories")
def j4(spark, sf):
    """Categories and alert of every item."""
    cats, alert = matching.flag_categories(F.col("title"), F.col("summary"), LEXICON)
    return ledger.items(spark, sf, "title", "summary").select("id", cats.alias("categories"), alert.alias("is_alert"))


@query("j5_known_pages", f"WITH {ITEMS} SELECT a.id FROM i a WHERE EXISTS (SELECT 1 FROM i b WHERE b.canonical_url = a.canonical_url AND b.run_id < a.run_id)")
def j5(spark, sf):
    """Items whose address an earlier run had already stored: a window, not a self-join."""
    i = ledger.items(spark, sf, "canonical_url", "run_id")
    return i.withColumn("first", F.min("run_id").over(Window.partitionBy("canonical_url"))).where("run_id > first").select("id")


@query("j6_candidates", f"WITH {ITEMS}, {MATCHES}, {RECENT.format(h=24)} SELECT DISTINCT m.name_id, i.id, i.title, m.confidence FROM i JOIN m ON m.item_id = i.id WHERE i.run_id IN (SELECT id FROM recent)")
def j6(spark, sf):
    """Items of the last day by name."""
    i = ledger.since(ledger.items(spark, sf, "title", "run_id"), _runs(spark, sf), 24)
    return i.join(table(spark, sf, "matches").withColumnRenamed("item_id", "id"), "id").select("name_id", "id", "title", "confidence").distinct()


@query("j8_unseen_links", f"WITH {ITEMS} SELECT DISTINCT g.url FROM gdelt g WHERE g.url NOT IN (SELECT raw_link FROM i WHERE raw_link IS NOT NULL) AND g.url IS NOT NULL")
def j8(spark, sf):
    """Article addresses never seen as a raw link."""
    return table(spark, sf, "gdelt").select("url").where("url IS NOT NULL").distinct().join(table(spark, sf, "items").select(F.col("raw_link").alias("url")), "url", "left_anti")


@query("j9_served_again", f"WITH {ITEMS}, {MATCHES}, r AS (SELECT DISTINCT id, epoch_us(started_at) // 1000000 AS at FROM runs), x AS (SELECT DISTINCT m.name_id, i.id, i.title_key, i.source_domain, i.source_name, r.at FROM i JOIN m ON m.item_id = i.id JOIN r ON r.id = i.run_id WHERE i.title_key <> '') SELECT a.id, max(b.id) AS original FROM x a JOIN x b ON a.name_id = b.name_id AND a.title_key = b.title_key AND b.at <= a.at - 3600 AND ((a.source_domain = b.source_domain AND a.source_domain <> '') OR (a.source_name = b.source_name AND a.source_name <> '')) GROUP BY 1")
def j9(spark, sf):
    """Copies an outlet serves again at least an hour later, with the original."""
    i = ledger.items(spark, sf, "title_key", "source_domain", "source_name", "run_id")
    r = _runs(spark, sf).select(F.col("id").alias("run_id"), F.unix_seconds(F.col("started_at").cast("timestamp")).alias("at"))
    m = ledger.matches(spark, sf).select(F.col("item_id").alias("id"), "name_id")
    return clusters.served_again(m.join(i, "id").join(r, "run_id").select("name_id", "id", "title_key", "source_domain", "source_name", "at"))


@query("j13_outlet_hits", f"WITH {ITEMS}, o AS (SELECT regexp_extract(homepage, '//([^/]*)', 1) AS domain, country FROM outlets) SELECT o.domain, o.country, count(i.id) AS n_items, max(i.run_id) AS last_run FROM o LEFT JOIN i ON i.source_domain = o.domain GROUP BY 1, 2")
def j13(spark, sf):
    """Items and last run of every outlet; items are counted before the join, so a large outlet is one row in it."""
    o = table(spark, sf, "outlets").select(U.domain_of(F.col("homepage")).alias("domain"), "country")
    c = ledger.items(spark, sf, "source_domain", "run_id").groupBy(F.col("source_domain").alias("domain")).agg(F.count(F.lit(1)).alias("n"), F.max("run_id").alias("last_run"))
    return o.join(c, "domain", "left").select("domain", "country", F.coalesce("n", F.lit(0)).alias("n_items"), "last_run")


@query("j14_focus_comps", "SELECT comp, min(id) AS focus_id FROM (SELECT id, unnest(comps) AS comp FROM names WHERE focus = 'name') WHERE comp NOT IN (SELECT id FROM names WHERE focus = 'name') GROUP BY 1")
def j14(spark, sf):
    """First focus name of every comp that isn't in focus itself."""
    n = table(spark, sf, "names").where("focus = 'name'")
    comps = n.select("id", F.explode("comps").alias("comp"))
    return comps.join(n.select(F.col("id").alias("comp")), "comp", "left_anti").groupBy("comp").agg(F.min("id").alias("focus_id"))


@query("j14_comp_reach", "WITH RECURSIVE r(root, id, depth) AS (SELECT id, id, 0 FROM names WHERE focus = 'name' UNION SELECT r.root, c.comp, r.depth + 1 FROM r JOIN (SELECT id, unnest(comps) AS comp FROM names) c ON c.id = r.id WHERE r.depth < 2) SELECT root, id, min(depth) AS depth FROM r GROUP BY 1, 2")
def j14b(spark, sf):
    """Names within two comp steps of each focus name."""
    n = table(spark, sf, "names")
    edges = n.select(F.col("id").alias("at"), F.explode("comps").alias("id"))
    level = n.where("focus = 'name'").select(F.col("id").alias("root"), "id", F.lit(0).alias("depth"))
    out = level
    for d in (1, 2):
        level = level.select("root", F.col("id").alias("at")).join(edges, "at").select("root", "id", F.lit(d).alias("depth")).distinct()
        out = out.unionByName(level)
    return out.groupBy("root", "id").agg(F.min("depth").alias("depth"))


@query("j21_market_names", "SELECT k.country, count(n.id) AS n_names, list_sort(list(n.id) FILTER (WHERE n.id IS NOT NULL AND n.watch)) AS watched FROM markets k LEFT JOIN names n ON n.home_country = k.country GROUP BY 1".replace("list_sort(list(n.id) FILTER (WHERE n.id IS NOT NULL AND n.watch))", "coalesce(list_sort(list(n.id) FILTER (WHERE n.id IS NOT NULL AND n.watch)), [])"))
def j21(spark, sf):
    """Names of every market."""
    n = table(spark, sf, "names").select(F.col("home_country").alias("country"), "id", "watch")
    return table(spark, sf, "markets").select("country").join(n, "country", "left").groupBy("country").agg(F.count("id").alias("n_names"), F.array_sort(F.collect_list(F.when(F.col("watch"), F.col("id")))).alias("watched"))


@query("j12_golden", f"WITH {ITEMS}, {MATCHES}, g AS (SELECT id AS name_id, name, lower(split_part(name, ' ', 1)) AS word FROM names WHERE watch), h AS (SELECT g.name_id, min(i.run_id * 10000000 + i.id) AS k FROM g JOIN m ON m.name_id = g.name_id JOIN i ON i.id = m.item_id AND contains(lower(coalesce(i.title, '')), g.word) GROUP BY 1) SELECT g.name_id, h.k IS NOT NULL AS hit, h.k % 10000000 AS first_item FROM g LEFT JOIN h USING (name_id)")
def j12(spark, sf):
    """Earliest item that proves each watched event, misses included."""
    g = table(spark, sf, "names").where("watch").select(F.col("id").alias("name_id"), F.lower(F.get(F.split("name", " "), F.lit(0))).alias("word"))
    m = ledger.matches(spark, sf).select(F.col("item_id").alias("id"), "name_id")
    seen = g.join(m, "name_id").join(ledger.items(spark, sf, "title", "run_id"), "id").where(F.contains(F.lower(F.coalesce("title", F.lit(""))), F.col("word")))
    first = seen.groupBy("name_id").agg(F.min_by("id", F.struct("run_id", "id")).alias("first_item"))
    return g.join(first, "name_id", "left").select("name_id", F.col("first_item").isNotNull().alias("hit"), "first_item")


# ---- windows, scheduling, sets ----------------------------------------------------------------------------------


@query("w2_primary_name", f"WITH {MATCHES}, r AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY confidence DESC, name_id) AS k FROM (SELECT item_id, name_id, max(confidence) AS confidence FROM m GROUP BY 1, 2)) SELECT item_id, name_id, confidence FROM r WHERE k = 1")
def w2(spark, sf):
    """Primary name of every item."""
    return matching.primary_name(table(spark, sf, "matches").groupBy("item_id", "name_id").agg(F.max("confidence").alias("confidence")))


@query("w3_cluster_primary", f"WITH {ITEMS}, r AS (SELECT cluster_id, id, row_number() OVER (PARTITION BY cluster_id ORDER BY coalesce(tier_hint, 9), route, id) AS k FROM i WHERE cluster_id IS NOT NULL) SELECT cluster_id, id FROM r WHERE k = 1")
def w3(spark, sf):
    """First item of every cluster by tier, route and id, as an aggregate without a sort."""
    i = ledger.items(spark, sf, "cluster_id", "tier_hint", "route").where("cluster_id IS NOT NULL")
    return i.groupBy("cluster_id").agg(F.min_by("id", F.struct(F.coalesce("tier_hint", F.lit(9)), "route", "id")).alias("id"))


def _jobs(spark, sf):
    last = ledger.last_attempts(ledger.ledger(spark, sf)).where("route = 'googlenews'")
    dormant = ledger.zero_yield(ledger.ledger(spark, sf)).where("route = 'googlenews'").select("source", F.lit(True).alias("dormant"))
    now = last.agg((F.max("last_run") + 1).alias("now"))
    n = table(spark, sf, "names")
    jobs = n.select(F.col("name").alias("label"), F.get(F.col("aliases"), F.lit(0)).alias("source"), F.col("id").alias("name_id"), F.when(F.col("focus") == "name", 0).when(F.col("kind") == "comp", 2).otherwise(3).alias("tier"), F.when(F.col("watch"), 1).otherwise(3).alias("prio"))
    j = jobs.join(F.broadcast(now)).join(last.select("source", "last_run"), "source", "left").join(dormant, "source", "left")
    return j.select("label", "name_id", "tier", (-(F.col("now") - F.coalesce("last_run", -9 * F.col("now"))) / F.when(F.col("prio") == 1, 1.0).otherwise(1.8)).alias("waited"), "prio", F.col("label").alias("ord"), F.coalesce("dormant", F.lit(False)).alias("dormant"))


@query("w4_rotation")
def w4(spark, sf):
    """Queries kept under a cap of 80 with a share of two per name and ten dormant ones."""
    return scheduling.rotate(_jobs(spark, sf), 80, 2, 10)


@query("w5_due", "SELECT n.id AS name_id, r.id AS run_id FROM (SELECT id, list_sum(list_transform(string_split(id, ''), lambda c: ascii(c))) AS phase FROM names) n, (SELECT DISTINCT id FROM runs ORDER BY id DESC LIMIT 10) r WHERE (r.id + n.phase) % 4 = 0")
def w5(spark, sf):
    """Names whose turn of four it is, in each of the last ten runs: every run asks its own residue, by an equi-join."""
    n = table(spark, sf, "names").select(F.col("id").alias("name_id"), F.pmod(scheduling.phase(F.col("id")), F.lit(4)).alias("r"))
    runs = _runs(spark, sf).orderBy(F.desc("id")).limit(10).select(F.col("id").alias("run_id"), F.pmod(F.lit(4) - F.pmod("id", F.lit(4)), F.lit(4)).alias("r"))
    return n.join(runs, "r").select("name_id", "run_id")


@query("w5_due_runs", "SELECT n.id AS name_id, r.id AS run_id FROM (SELECT id, list_sum(list_transform(string_split(id, ''), lambda c: ascii(c))) AS phase FROM names) n, (SELECT DISTINCT id FROM runs) r WHERE (r.id + n.phase) % 4 = 0")
def w5_runs(spark, sf):
    """Names whose turn of four it is, in every run, by an equi-join."""
    n = table(spark, sf, "names").select(F.col("id").alias("name_id"), F.pmod(scheduling.phase(F.col("id")), F.lit(4)).alias("r"))
    runs = _runs(spark, sf).select(F.col("id").alias("run_id"), F.pmod(F.lit(4) - F.pmod("id", F.lit(4)), F.lit(4)).alias("r"))
    return n.join(runs, "r").select("name_id", "run_id")


@query("w6_chunks", "WITH x AS (SELECT home_country AS market, kind = 'name' AS heavy, id AS name_id FROM names), r AS (SELECT *, row_number() OVER (PARTITION BY market, heavy ORDER BY name_id) - 1 AS p, ceil(count(*) FILTER (WHERE NOT heavy) OVER (PARTITION BY market) / 6.0) AS light FROM x) SELECT market, name_id, CAST(p // 6 + CASE WHEN heavy THEN light ELSE 0 END AS BIGINT) AS group_no FROM r")
def w6(spark, sf):
    """Names of each market in groups of six, heavy ones among themselves."""
    rows = table(spark, sf, "names").select(F.col("home_country").alias("market"), (F.col("kind") == "name").alias("heavy"), F.col("id").alias("name_id"))
    return scheduling.chunks(rows, 6).select("market", "name_id", F.col("group_no").cast("bigint").alias("group_no"))


@query("w8_breaker", f"WITH {LEDGER}, s AS (SELECT *, row_number() OVER (PARTITION BY route, run_id ORDER BY source) AS seq FROM l), g AS (SELECT *, sum(CASE WHEN items > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY route, run_id ORDER BY seq) AS isl FROM s), k AS (SELECT *, count(*) FILTER (WHERE items = 0) OVER (PARTITION BY route, run_id, isl ORDER BY seq) AS streak FROM g) SELECT route, run_id, min(seq) AS tripped_at FROM k WHERE streak >= 3 GROUP BY 1, 2")
def w8(spark, sf):
    """Where each route trips after three empty answers in a row."""
    rows = ledger.ledger(spark, sf).withColumn("seq", F.row_number().over(Window.partitionBy("route", "run_id").orderBy("source")))
    return scheduling.trips(rows, 3, F.col("items") > 0)


@query("w10_quota")
def w10(spark, sf):
    """Cap of each route after every run."""
    rows = ledger.ledger(spark, sf).groupBy("route", "run_id").agg((F.count_if(~F.col("ok")) > 2).alias("refused"))
    return scheduling.quota(rows, 160, 80, 200, 0.75, 5)


@query("w12_previous_cut", "SELECT id, (date_trunc('day', started_at) - CASE dayofweek(started_at) WHEN 1 THEN INTERVAL 3 DAY WHEN 0 THEN INTERVAL 2 DAY ELSE INTERVAL 1 DAY END)::DATE::VARCHAR AS cut FROM (SELECT DISTINCT * FROM runs)")
def w12(spark, sf):
    """Working day before each run: Friday for a Monday or a Sunday."""
    d = F.dayofweek("started_at")
    return _runs(spark, sf).select("id", F.date_sub(F.to_date("started_at"), F.when(d == 2, 3).when(d == 1, 2).otherwise(1)).cast("string").alias("cut"))


@query("t3_recent", f"WITH {ITEMS}, {MATCHES}, r AS (SELECT m.name_id, i.id, row_number() OVER (PARTITION BY m.name_id ORDER BY i.id DESC) AS k FROM (SELECT DISTINCT item_id, name_id FROM m) m JOIN i ON i.id = m.item_id) SELECT name_id, id FROM r WHERE k <= 2000")
def t3(spark, sf):
    """The 2,000 newest items of each name (the limit is the operator)."""
    m = ledger.matches(spark, sf).select("name_id", F.col("item_id").alias("id")).join(table(spark, sf, "items").select("id").distinct(), "id", "left_semi")
    return m.withColumn("k", F.row_number().over(Window.partitionBy("name_id").orderBy(F.desc("id")))).where("k <= 2000").select("name_id", "id")


@query("t1_export_order", f"WITH {ITEMS}, {MATCHES}, c AS (SELECT id, max(confidence) AS best FROM i JOIN m ON m.item_id = i.id GROUP BY 1) SELECT id, alert_candidate, run_id, row_number() OVER (ORDER BY alert_candidate DESC, run_id DESC, coalesce(best, 0) DESC, id) AS place FROM i LEFT JOIN c USING (id) WHERE status = 'candidate'")
def t1(spark, sf):
    """Every candidate with its place in the export: alerts first, then the newest, then the surest.

    The global order is a range-partitioned sort; a place is the rank in its partition plus the rows of the partitions
    before, so no task sees more than its range.
    """
    best = table(spark, sf, "matches").groupBy(F.col("item_id").alias("id")).agg(F.max("confidence").alias("best"))
    rows = ledger.items(spark, sf, "alert_candidate", "run_id", "status").where("status = 'candidate'").join(best, "id", "left")
    order = [F.desc("alert_candidate"), F.desc("run_id"), F.desc(F.coalesce("best", F.lit(0.0))), F.asc("id")]
    # the ranges come from a sample; the checkpoint keeps them the same for both uses
    ranged = cut(rows.repartitionByRange(*order).withColumn("part", F.spark_partition_id()).select("id", "alert_candidate", "run_id", "best", "part"))
    sizes = ranged.groupBy("part").count()  # one row a partition
    before = sizes.withColumn("before", F.sum("count").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))).select("part", F.coalesce("before", F.lit(0)).alias("before"))
    return ranged.join(before, "part").select("id", "alert_candidate", "run_id", (F.col("before") + F.row_number().over(Window.partitionBy("part").orderBy(*order))).alias("place"))


@query("u1_token_overlap", f"WITH {ITEMS}, c AS (SELECT cluster_id, min(id) AS a, max(id) AS b FROM i WHERE cluster_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1) SELECT c.cluster_id, len(list_intersect(list_distinct(string_split(x.title_key, ' ')), list_distinct(string_split(y.title_key, ' ')))) AS n_common, len(list_distinct(list_concat(string_split(x.title_key, ' '), string_split(y.title_key, ' ')))) AS n_all FROM c JOIN i x ON x.id = c.a JOIN i y ON y.id = c.b")
def u1(spark, sf):
    """Words the first and last item of each cluster share."""
    i = ledger.items(spark, sf, "cluster_id", "title_key").where("cluster_id IS NOT NULL").withColumn("w", F.split("title_key", " "))
    c = i.groupBy("cluster_id").agg(F.min_by("w", "id").alias("x"), F.max_by("w", "id").alias("y"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return c.select("cluster_id", F.size(F.array_intersect("x", "y")).alias("n_common"), F.size(F.array_union("x", "y")).alias("n_all"))


@query("u3_dropped_names", f"WITH {MATCHES} SELECT id FROM names EXCEPT SELECT name_id FROM m")
def u3(spark, sf):
    """Names without any match."""
    return table(spark, sf, "names").select("id").distinct().join(table(spark, sf, "matches").select(F.col("name_id").alias("id")), "id", "left_anti")


@query("u5_all_links", "SELECT link, count(*) AS n FROM (SELECT canonical_url AS link FROM (SELECT DISTINCT id, canonical_url FROM items) UNION ALL SELECT url FROM (SELECT DISTINCT gdelt_id, url FROM gdelt)) GROUP BY 1")
def u5(spark, sf):
    """How often each address comes in items and articles together."""
    a = ledger.items(spark, sf, "canonical_url").select(F.col("canonical_url").alias("link"))
    return a.unionByName(table(spark, sf, "gdelt").dropDuplicates(["gdelt_id"]).select(F.col("url").alias("link"))).groupBy("link").agg(F.count(F.lit(1)).alias("n"))


# ---- stateful curation and streams ------------------------------------------------------------------------------


_STOP = ", ".join(f"'{w}'" for w in T.STOP_WORDS)


_TOKS = f"list_distinct(list_filter(string_split(coalesce(i.title_key, ''), ' '), lambda w: length(w) > 2 AND w NOT IN ({_STOP})))"
_AT = "at_ AS (SELECT DISTINCT id, epoch_us(started_at) // 1000000 AS t FROM runs)"


@query("c17_clusters", f"""WITH RECURSIVE {ITEMS}, {MATCHES}, {_AT}, pn AS (SELECT item_id AS id, name_id AS scope, row_number() OVER (PARTITION BY item_id ORDER BY c DESC, name_id) AS rk FROM (SELECT item_id, name_id, max(confidence) AS c FROM m GROUP BY 1, 2)),
    x AS (SELECT d.name_id AS scope, i.id, coalesce(i.title_key, '') AS key, {_TOKS} AS toks, at_.t, row_number() OVER (PARTITION BY d.name_id ORDER BY i.id) AS place FROM i JOIN (SELECT DISTINCT item_id, name_id FROM m) d ON d.item_id = i.id JOIN at_ ON at_.id = i.run_id),
    p AS (SELECT b.id, max(a.id) AS parent FROM pn JOIN x b ON b.id = pn.id AND b.scope = pn.scope AND pn.rk = 1 JOIN x a ON a.scope = b.scope AND a.id < b.id AND b.t - a.t <= 259200 AND b.place - a.place <= 1999
          AND ((a.key = b.key AND b.key <> '') OR (len(a.toks) >= 4 AND len(b.toks) >= 4 AND len(list_intersect(a.toks, b.toks)) >= 0.6 * len(list_distinct(list_concat(a.toks, b.toks))))) GROUP BY 1),
    f AS (SELECT pn.id, p.parent FROM pn JOIN i ON i.id = pn.id LEFT JOIN p ON p.id = pn.id WHERE pn.rk = 1),
    r(id, up) AS (SELECT id, id FROM f UNION ALL SELECT r.id, f.parent FROM r JOIN f ON f.id = r.up WHERE f.parent IS NOT NULL)
    SELECT id, min(up) AS cluster FROM r GROUP BY 1""")
def c17(spark, sf):
    """Cluster of every item: the root of the pointer forest over the items matched to its primary name."""
    m = table(spark, sf, "matches").groupBy("item_id", "name_id").agg(F.max("confidence").alias("confidence"))
    runs = _runs(spark, sf).select(F.col("id").alias("run_id"), F.unix_seconds(F.col("started_at").cast("timestamp")).alias("at"))
    i = ledger.items(spark, sf, "title_key", "run_id").join(runs, "run_id").select("id", F.coalesce("title_key", F.lit("")).alias("key"), T.tokens(F.coalesce("title_key", F.lit(""))).alias("toks"), "at")
    primary = matching.primary_name(m).select(F.col("item_id").alias("id"), F.col("name_id").alias("scope")).join(i.select("id"), "id", "left_semi")
    return clusters.roots(clusters.pointers(m.select(F.col("name_id").alias("scope"), F.col("item_id").alias("id")).join(i, "id"), primary))


@query("j10_republished", f"""WITH {ITEMS}, {_AT}, x AS (SELECT i.id, {_TOKS} AS toks, list_sort(list_distinct(regexp_extract_all(i.title_key, '[0-9]+'))) AS nums, at_.t FROM i JOIN at_ ON at_.id = i.run_id), y AS (SELECT *, unnest(toks) AS tok FROM x WHERE len(toks) >= 5),
    c AS (SELECT a.id AS a, b.id AS b, count(*) AS n, any_value(len(a.toks)) AS na, any_value(len(b.toks)) AS nb, any_value(a.t) AS ta FROM y a JOIN y b ON a.tok = b.tok AND a.nums = b.nums AND b.t - a.t BETWEEN 259200 AND 12960000 GROUP BY 1, 2)
    SELECT b AS id, arg_min(a, ta * 10000000 + a) AS first_id FROM c WHERE n >= 0.85 * (na + nb - n) GROUP BY 1""")
def j10(spark, sf):
    """Headlines that come again after three days or more, with the first of them."""
    runs = _runs(spark, sf).select(F.col("id").alias("run_id"), F.unix_seconds(F.col("started_at").cast("timestamp")).alias("at"))
    i = ledger.items(spark, sf, "title_key", "run_id").join(runs, "run_id")
    return clusters.republished(i.select("id", F.coalesce("title_key", F.lit("")).alias("key"), T.tokens(F.coalesce("title_key", F.lit(""))).alias("toks"), "at"))


_STEMS = "list_distinct(list_transform(list_filter(regexp_extract_all(title_key, '\\p{L}{5,}'), lambda w: NOT list_contains(own, left(w, 5))), lambda w: left(w, 6)))"


@query("j17_echo_stems", f"""WITH {ITEMS}, {MATCHES}, n AS (SELECT id AS name_id, list_transform(regexp_extract_all(lower(concat_ws(' ', name, array_to_string(aliases, ' '))), '\\p{{L}}{{5,}}'), lambda w: left(w, 5)) AS own FROM names),
    x AS (SELECT DISTINCT i.id, i.title_key, i.status, i.alert_candidate, m.name_id, m.where_ = 'title' AS named, {_STEMS} AS stems FROM i JOIN m ON m.item_id = i.id JOIN n USING (name_id) WHERE i.title_key <> '')
    SELECT a.id, a.name_id, count(DISTINCT e.title_key) AS n_echoes FROM x a JOIN x e ON e.name_id = a.name_id AND e.status = 'screened' AND e.named AND list_has_any(a.stems, e.stems) WHERE a.alert_candidate AND a.status <> 'screened' GROUP BY 1, 2""")
def j17_echo_stems(spark, sf):
    """Distinct screened headlines of the same name that share a stem with each alert, the name's own words left out.

    Equal headlines of a name are one class on both sides before the stems meet; a stem of many headlines is split by AQE.
    """
    i = ledger.items(spark, sf, "title_key", "status", "alert_candidate").where("title_key <> ''")
    m = table(spark, sf, "matches").select(F.col("item_id").alias("id"), "name_id", (F.col("where_") == "title").alias("named")).distinct()
    words = lambda text: F.regexp_extract_all(text, F.lit(r"(\p{L}{5,})"))
    own = F.transform(words(F.lower(F.concat_ws(" ", "name", F.array_join("aliases", " ")))), lambda w: F.left(w, F.lit(5)))
    n = table(spark, sf, "names").select(F.col("id").alias("name_id"), own.alias("own"))
    rows = i.join(m, "id")

    def classes(part, out):
        firsts = part.groupBy("name_id", "title_key").agg(F.min("id").alias(out)).join(n, "name_id")
        told = F.filter(words(F.col("title_key")), lambda w: ~F.array_contains("own", F.left(w, F.lit(5))))
        return firsts.select("name_id", out, F.explode(F.array_distinct(F.transform(told, lambda w: F.left(w, F.lit(6))))).alias("stem"))

    alerts = rows.where("alert_candidate AND status <> 'screened'").select("id", "name_id", "title_key").distinct()
    met = classes(alerts, "first_id").join(classes(rows.where("status = 'screened' AND named"), "echo_id"), ["name_id", "stem"])
    counts = met.select("name_id", "first_id", "echo_id").distinct().groupBy("name_id", "first_id").agg(F.count(F.lit(1)).alias("n_echoes"))
    members = alerts.select("id", "name_id", F.min("id").over(Window.partitionBy("name_id", "title_key")).alias("first_id"))
    return members.join(counts, ["name_id", "first_id"]).select("id", "name_id", "n_echoes")


@query("c18_page_visits", f"WITH {ITEMS}, f AS (SELECT source_domain, canonical_url, min(run_id) AS first_run FROM i WHERE route = 'page' GROUP BY 1, 2), v AS (SELECT source_domain, min(first_run) AS seed FROM f GROUP BY 1) SELECT f.source_domain, f.first_run AS run_id, count(*) AS n_new FROM f JOIN v USING (source_domain) WHERE f.first_run > v.seed GROUP BY 1, 2")
def c18(spark, sf):
    """New links of every watched page by visit; the first visit only seeds."""
    f = ledger.items(spark, sf, "route", "source_domain", "canonical_url", "run_id").where("route = 'page'").groupBy("source_domain", "canonical_url").agg(F.min("run_id").alias("run_id"))
    seed = F.min("run_id").over(Window.partitionBy("source_domain"))
    return f.withColumn("seed", seed).where("run_id > seed").groupBy("source_domain", "run_id").agg(F.count(F.lit(1)).alias("n_new"))


@query("c18_guarded_visits", f"""WITH {ITEMS}, v AS (SELECT DISTINCT source_domain, canonical_url, run_id FROM i WHERE route = 'page'),
    c AS (SELECT a.*, NOT EXISTS (SELECT 1 FROM v b WHERE b.source_domain = a.source_domain AND b.canonical_url = a.canonical_url AND b.run_id < a.run_id) AS unseen FROM v a),
    t AS (SELECT source_domain, run_id, count(*) AS n_listed, count(*) FILTER (WHERE unseen) AS n_unseen FROM c GROUP BY 1, 2)
    SELECT source_domain, run_id, n_unseen AS n_new FROM t WHERE n_unseen > 0 AND NOT (n_unseen > 3 AND 2 * n_unseen >= n_listed) AND run_id > (SELECT min(run_id) FROM v WHERE v.source_domain = t.source_domain)""")
def c18_guarded(spark, sf):
    """New links of every watched page by visit: the first visit seeds, and so does a visit that reads the archive again.

    Such a visit has more than three unseen links that are at least half of those listed; its links count as seen after.
    """
    v = ledger.items(spark, sf, "route", "source_domain", "canonical_url", "run_id").where("route = 'page'").select("source_domain", "canonical_url", "run_id").distinct()
    first = F.min("run_id").over(Window.partitionBy("source_domain", "canonical_url"))
    visits = v.withColumn("unseen", F.col("run_id") == first).groupBy("source_domain", "run_id").agg(F.count(F.lit(1)).alias("n_listed"), F.count_if("unseen").alias("n_new"))
    seed = F.min("run_id").over(Window.partitionBy("source_domain"))
    return visits.withColumn("seed", seed).where("run_id > seed AND n_new > 0 AND NOT (n_new > 3 AND 2 * n_new >= n_listed)").select("source_domain", "run_id", "n_new")


_WINDOW = "SELECT strftime(time_bucket(INTERVAL 1 HOUR, ts), '%Y-%m-%d %H:%M:%S') AS start, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1, 2"


@query("r1_event_windows", _WINDOW)
def r1(spark, sf):
    """Hourly counts of the events as a batch."""
    return incremental.windowed_counts(table(spark, sf, "events")).withColumn("total", F.round("total", 2))


@query("r2_stream_windows", _WINDOW)
def r2(spark, sf):
    """The same counts by a stream driven over what is there."""
    name = "events.parquet"
    schema = table(spark, sf, "events").schema
    reader = spark.readStream.schema(schema)
    stream = reader.parquet(f"{sf}/{name}") if os.path.isdir(f"{sf}/{name}") else reader.option("pathGlobFilter", name).parquet(sf)
    run = uuid.uuid4().hex
    where = f"{ensure_checkpoint_dir(spark)}/stream-{run}"
    out = incremental.run_available(incremental.windowed_counts(stream.withColumn("ts", F.col("ts").cast("timestamp"))), f"r2_{run}", where, ["start", "event_type"])
    return out.withColumn("total", F.round("total", 2))


@query("r3_sessions", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS b FROM events), s AS (SELECT *, sum(b) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, k")
def r3(spark, sf):
    """Sessions of each user with a gap of thirty minutes."""
    s = incremental.sessions(table(spark, sf, "events"))
    return s.withColumn("start", F.date_format(F.col("start").cast("timestamp_ntz"), "yyyy-MM-dd HH:mm:ss"))


_MARKET_NAMES = "SELECT n.name, k.lang, k.country FROM names n JOIN markets k ON k.country = n.home_country"


def _market_names(spark, sf):
    return table(spark, sf, "names").join(table(spark, sf, "markets").select("country", "lang"), F.col("home_country") == F.col("country")).select("name", "lang", "country")


def _case(column: str, values: dict[str, str]) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in values.items()) + f" ELSE {column} END"


@query("s2_second_search", f"SELECT name, 'https://www.bing.com/news/search?q=' || replace(url_encode(name), '%20', '+') || '&format=rss&mkt=' || CASE WHEN country = 'NO' AND lang IN ('nb', 'no') THEN 'nb-NO' ELSE lang || '-' || country END AS url FROM ({_MARKET_NAMES})")
def s2(spark, sf):
    """Address of the second search for each name in its home market."""
    return _market_names(spark, sf).select("name", feeds.second_search_url(F.col("name"), F.col("lang"), F.col("country")).alias("url"))


@query("s3_article_api", f"SELECT name, 'https://api.gdeltproject.org/api/v2/doc/doc?query=' || replace(url_encode(name || ' sourcecountry:' || {_case('country', feeds.API_COUNTRIES)} || ' sourcelang:' || {_case('lang', feeds.API_LANGUAGES)}), '%20', '+') || '&mode=artlist&maxrecords=250&format=json&timespan=24h&sort=datedesc' AS url FROM ({_MARKET_NAMES})")
def s3(spark, sf):
    """Address of the article API for each name in its home market."""
    return _market_names(spark, sf).select("name", feeds.article_api_url(F.col("name"), F.col("lang"), F.col("country")).alias("url"))


@query("s7_atom", f"WITH {ITEMS} SELECT id, {_CLEAN.format(c='title')} AS title, canonical_url AS link, CASE WHEN id % 2 = 0 THEN 1700000000000000 ELSE 1600000000000000 END AS published_us FROM i")
def s7(spark, sf):
    """Every item written as an Atom entry, of which every other has only the time of its last change, and parsed back."""
    i = ledger.items(spark, sf, "title", "canonical_url")
    published = F.when(F.col("id") % 2 == 0, "<published>2023-11-14T22:13:20Z</published>").otherwise("")
    doc = F.concat(F.lit('<feed><title>f</title><entry><link rel="self" href="https://x.test/"/><link href="'), _xml("canonical_url"), F.lit('"/><title>'), _xml("title"), F.lit("</title>"), published, F.lit("<updated>2020-09-13T12:26:40Z</updated></entry></feed>"))
    return feeds.parse_atom(i.select("id", doc.alias("doc"))).select("id", "title", "link", "published_us")


@query("s10_feed_anchors", f"WITH {ITEMS}, p AS (SELECT 'https://' || source_domain || '/?i=' || id AS page_url, 'https://' || source_domain AS base, string_split(canonical_url, '#')[1] AS link, title FROM i WHERE canonical_url IS NOT NULL AND title IS NOT NULL) SELECT page_url, base || '/news/rss.xml' AS link, 1 AS rank FROM p UNION ALL SELECT page_url, base || '/atom', 0 FROM p UNION ALL SELECT page_url, link, 1 FROM p WHERE regexp_matches(lower(link || ' ' || title), 'rss|atom|feed')")
def s10(spark, sf):
    """Links of pages that may be feeds: declared ones and those with a feed's name."""
    return feeds.feed_anchors(feeds.extract_links(_link_page(spark, sf)))


@query("s12_page_items", f"WITH {ITEMS}, p AS (SELECT 'https://' || source_domain || '/?i=' || id AS page_url, lower(source_domain) AS host, string_split(canonical_url, '#')[1] AS link, {_CLEAN.format(c='title')} AS title FROM i WHERE canonical_url IS NOT NULL AND title IS NOT NULL) SELECT page_url, link, 'page' AS route FROM p WHERE lower(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1)) = host AND length(rtrim(regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/')) >= 12 AND length(title) >= 20")
def s12(spark, sf):
    """Undated mentions of the articles that pages link to."""
    return feeds.page_items(feeds.extract_links(_link_page(spark, sf))).select("page_url", "link", "route")
