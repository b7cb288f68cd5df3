"""Operators whose relational form both engines share: one SQL text over views i, m, l, r, n, o, k, g of the tables.

In Spark the views are pruned DataFrames (distinct items and matches, the ledger, runs and the dimensions) passed to
``spark.sql``; in DuckDB they are common table expressions. Catalyst plans the text like any other query.
"""

from __future__ import annotations

import re


from presslens.operators import ledger
from presslens.plans.core_queries import LEDGER, MATCHES, _runs, query
from presslens.session import table

_VIEWS = {
    "i": lambda s, d: table(s, d, "items").dropDuplicates(["id"]),
    "m": lambda s, d: table(s, d, "matches").distinct(),
    "l": ledger.ledger,
    "r": _runs,
    "n": lambda s, d: table(s, d, "names"),
    "o": lambda s, d: table(s, d, "outlets"),
    "k": lambda s, d: table(s, d, "markets"),
    "g": lambda s, d: table(s, d, "gdelt").dropDuplicates(["gdelt_id"]),
    "d": lambda s, d: table(s, d, "documents"),
}
_CTES = f"WITH {LEDGER}, {MATCHES}, r AS (SELECT DISTINCT * FROM runs), n AS (SELECT * FROM names), o AS (SELECT * FROM outlets), k AS (SELECT * FROM markets), g AS (SELECT DISTINCT * FROM gdelt), d AS (SELECT * FROM documents) "


def portable(name: str, doc: str, sql: str, duck: tuple[tuple[str, str], ...] = ()) -> None:
    """Register one SQL text for both engines; ``duck`` rewrites what DuckDB spells differently."""
    used = sorted(set(re.findall(r"\{(\w)\}", sql)))

    def run(spark, sf):
        return spark.sql(sql, **{v: _VIEWS[v](spark, sf) for v in used})

    run.__doc__ = doc
    theirs = re.sub(r"\{(\w)\}", r"\1", sql)
    for a, b in duck:
        theirs = theirs.replace(a, b)
    query(name, _CTES + theirs)(run)


portable("a11_run_count", "Runs, finished runs and items per run.", "SELECT count(*) AS n_runs, count(finished_at) AS n_finished, sum(items_new) AS n_new, max(items_fetched) AS most_fetched FROM {r}")
portable("a17_domain_outcomes", "Outcomes of the queries that name a feed, by its domain.", "SELECT regexp_extract(source, '^https?://([^/]+)', 1) AS domain, count(*) AS n_jobs, sum(CASE WHEN ok THEN 1 ELSE 0 END) AS n_ok FROM {l} WHERE source LIKE 'http%' GROUP BY 1")
portable("a19_funnel", "Funnel of the items: every row falls into one step, and the steps add up.", """
    SELECT CASE WHEN title IS NULL OR title = '' THEN 'empty' WHEN status = 'screened' THEN 'screened' WHEN status = 'new' THEN 'waiting' WHEN alert_candidate THEN 'alert' WHEN cluster_id IS NULL THEN 'alone' ELSE 'clustered' END AS step,
           count(*) AS n_items, count(DISTINCT source_domain) AS n_domains FROM {i} GROUP BY 1""")
portable("a20_quiet_names", "Names never heard of, by kind and home country.", "SELECT n.kind, n.home_country, count(*) AS n_names, sum(CASE WHEN h.name_id IS NULL THEN 1 ELSE 0 END) AS n_quiet FROM {n} n LEFT JOIN (SELECT DISTINCT name_id FROM {m}) h ON h.name_id = n.id GROUP BY 1, 2")
portable("a22_health_totals", "Sources by their whole history: failing, silent, sound.", "SELECT state, count(*) AS n_sources FROM (SELECT route, source, CASE WHEN NOT max(ok) THEN 'failing' WHEN sum(items) = 0 THEN 'silent' ELSE 'sound' END AS state FROM {l} GROUP BY route, source) t GROUP BY 1", (("NOT max(ok)", "NOT bool_or(ok)"),))
portable("a23_run_summary", "Counters of every run.", """
    SELECT run_id, count(*) AS n_items, sum(CASE WHEN status = 'candidate' THEN 1 ELSE 0 END) AS n_candidates, sum(CASE WHEN status = 'screened' THEN 1 ELSE 0 END) AS n_screened,
           sum(CASE WHEN alert_candidate THEN 1 ELSE 0 END) AS n_alerts, count(DISTINCT route) AS n_routes FROM {i} GROUP BY run_id""")
portable("a25_source_grades", "Grade of every outlet domain from its best tier.", "SELECT regexp_extract(homepage, '//([^/]+)', 1) AS domain, CASE min(tier) WHEN 0 THEN 'premium' WHEN 1 THEN 'premium' WHEN 2 THEN 'trade' ELSE 'press' END AS grade, count(DISTINCT lang) AS n_langs FROM {o} GROUP BY 1")
portable("fn_error_class", "Ordered classification of the ledger's errors.", "SELECT run_id, route, source, CASE WHEN error = '' THEN 'none' WHEN error LIKE '%budget%' THEN 'budget' WHEN error LIKE '%rotation%' THEN 'deferred' WHEN error LIKE 'refused upstream%' THEN 'refused' WHEN error LIKE '%429%' THEN 'rate_limit' ELSE 'other' END AS error_class FROM {l}")
portable("fn_stems", "Six-letter stems of the long words of a key.", "SELECT id, array_sort(array_distinct(transform(filter(split(title_key, ' '), w -> length(w) >= 5), w -> substring(w, 1, 6)))) AS stems FROM {i}", (("array_sort(array_distinct(transform(filter(split(title_key, ' '), w -> length(w) >= 5), w -> substring(w, 1, 6))))", "list_sort(list_distinct(list_transform(list_filter(string_split(title_key, ' '), lambda w: length(w) >= 5), lambda w: substr(w, 1, 6))))"),))
portable("fn_contains_all", "Golden predicate: all of a name's words in the headline.", "SELECT i.id, m.name_id, forall(split(lower(n.name), ' '), w -> contains(lower(i.title), w)) AS all_words FROM {i} i JOIN {m} m ON m.item_id = i.id JOIN {n} n ON n.id = m.name_id WHERE i.title IS NOT NULL GROUP BY ALL", (("forall(split(lower(n.name), ' '), w -> contains(lower(i.title), w))", "len(list_filter(string_split(lower(n.name), ' '), lambda w: NOT contains(lower(i.title), w))) = 0"), ("WHERE i.title IS NOT NULL GROUP BY ALL", "WHERE i.title IS NOT NULL GROUP BY i.id, m.name_id, i.title, n.name")))
portable("c12_keep", "Screened items of watched names that stay candidates, with the reason kept.", "SELECT DISTINCT i.id, concat('kept:', i.screen_reason, ':watched') AS reason FROM {i} i JOIN {m} m ON m.item_id = i.id JOIN {n} n ON n.id = m.name_id WHERE i.status = 'screened' AND n.watch AND m.where_ = 'title' AND i.screen_reason <> ''")
portable("c25_revalidate", "Stored candidates whose alias is no longer in the text.", "SELECT DISTINCT i.id, m.name_id FROM {i} i JOIN {m} m ON m.item_id = i.id WHERE i.status = 'candidate' AND i.route NOT IN ('page', 'rss') AND NOT contains(lower(concat(coalesce(i.title, ''), ' ', coalesce(i.summary, ''))), lower(m.alias))")
portable("j7_recent_jobs", "Queries of the last day with the start of their run.", "SELECT l.route, l.source, l.ok, CAST(r.started_at AS STRING) AS started FROM {l} l JOIN {r} r ON r.id = l.run_id WHERE r.started_at >= (SELECT max(started_at) FROM {r}) - INTERVAL 24 HOUR", (("AS STRING", "AS VARCHAR"),))
portable("j15_overlay", "Upsert of outlets over the domains seen in items: configured values win.", "SELECT coalesce(o.domain, s.source_domain) AS domain, coalesce(o.country, s.country) AS country, o.domain IS NULL AS is_unknown FROM (SELECT regexp_extract(homepage, '//([^/]+)', 1) AS domain, min(country) AS country FROM {o} GROUP BY 1) o FULL OUTER JOIN (SELECT source_domain, min(nullif(country, '')) AS country FROM {i} GROUP BY source_domain) s ON s.source_domain = o.domain")
portable("j17_echoes", "Other domains that carry the story of each alert, from counts per cluster rather than pairs.", "SELECT a.id, c.n_domains - 1 AS n_echoes FROM {i} a JOIN (SELECT cluster_id, count(DISTINCT source_domain) AS n_domains FROM {i} WHERE cluster_id IS NOT NULL GROUP BY 1) c ON c.cluster_id = a.cluster_id WHERE a.alert_candidate AND c.n_domains > 1")
portable("j18_window_merge", "Clusters of the wide window that the narrow one doesn't have.", "SELECT c.cluster_id FROM (SELECT i.cluster_id, max(r.started_at) AS latest FROM {i} i JOIN {r} r ON r.id = i.run_id WHERE i.cluster_id IS NOT NULL GROUP BY 1) c JOIN (SELECT max(started_at) AS last FROM {r}) z ON c.latest >= z.last - INTERVAL 72 HOUR AND c.latest < z.last - INTERVAL 24 HOUR")
portable("j19_carry_merge", "Judgements carried on: the newer half overrides the older, screened ones drop out.", """
    SELECT j.cluster_id, j.id FROM (SELECT coalesce(b.cluster_id, a.cluster_id) AS cluster_id, coalesce(b.id, a.id) AS id FROM (SELECT cluster_id, max(id) AS id FROM {i} WHERE run_id % 2 = 0 AND cluster_id IS NOT NULL GROUP BY 1) a
    FULL OUTER JOIN (SELECT cluster_id, max(id) AS id FROM {i} WHERE run_id % 2 = 1 AND cluster_id IS NOT NULL GROUP BY 1) b ON a.cluster_id = b.cluster_id) j
    LEFT JOIN (SELECT DISTINCT cluster_id FROM {i} WHERE status = 'screened' AND cluster_id IS NOT NULL) x ON x.cluster_id = j.cluster_id WHERE x.cluster_id IS NULL""")
portable("j20_regulators", "Names of each regulator's country in chunks of six.", "SELECT country, chunk, count(*) AS n_names FROM (SELECT k.country, floor((row_number() OVER (PARTITION BY k.country ORDER BY n.id) - 1) / 6) AS chunk FROM {k} k JOIN {n} n ON n.home_country = k.country) t GROUP BY 1, 2")
portable("j22_facts", "Lint: documents that name a company by its name and speak of no creditors.", "SELECT n.id AS name_id, count(*) AS n_docs FROM {d} d JOIN {n} n ON n.id = d.name_id WHERE d.text IS NOT NULL AND contains(d.text, n.name) AND NOT contains(lower(d.text), 'creditors') GROUP BY 1")
portable("j23_silent_catalysts", "Watched names without an item in the last week: a warning.", "SELECT n.id FROM {n} n WHERE n.watch AND NOT EXISTS (SELECT 1 FROM {m} m JOIN {i} i ON i.id = m.item_id JOIN {r} r ON r.id = i.run_id WHERE m.name_id = n.id AND r.started_at >= (SELECT max(started_at) FROM {r}) - INTERVAL 168 HOUR)")
portable("q1_solo_queries", "Solo queries of each name: watched ones every run, others every fourth.", "SELECT n.id AS name_id, k.country, k.lang, CASE WHEN n.watch THEN 1 WHEN n.focus <> '' THEN 2 ELSE 4 END AS every_n FROM {n} n JOIN {k} k ON k.country = n.home_country")
portable("q2_alias_queries", "Secondary alias queries, once per language, the home market first.", """
    SELECT name_id, alias, lang, country FROM (SELECT a.name_id, a.alias, k.lang, k.country, row_number() OVER (PARTITION BY a.name_id, a.alias, k.lang ORDER BY CASE WHEN k.country = a.home_country THEN 0 ELSE 1 END, k.country) AS rk
    FROM (SELECT id AS name_id, home_country, explode(aliases) AS alias FROM {n} WHERE kind = 'name') a JOIN {k} k ON k.country = a.home_country OR k.lang = 'en') t WHERE rk = 1""", (("explode(aliases)", "unnest(aliases)"),))
portable("q5_group_queries", "Grouped OR queries of six names per market.", """
    SELECT market, grp, concat('(', array_join(transform(array_sort(collect_list(name)), x -> concat('"', x, '"')), ' OR '), ')') AS q FROM (SELECT home_country AS market, name, floor((row_number() OVER (PARTITION BY home_country ORDER BY id) - 1) / 6) AS grp FROM {n}) t GROUP BY 1, 2""",
    (("array_join(transform(array_sort(collect_list(name)), x -> concat('\"', x, '\"')), ' OR ')", "array_to_string(list_transform(list_sort(list(name)), lambda x: concat('\"', x, '\"')), ' OR ')"),))
portable("w7_slice", "Rotating slice of five site queries per run: each run joins the five places whose turn it is.", """
    SELECT d.domain, q.run_id FROM (SELECT s.run_id, (s.run_id * 5 + s.k) % c.n AS p FROM (SELECT id AS run_id, explode(array(0, 1, 2, 3, 4)) AS k FROM {r}) s JOIN (SELECT count(DISTINCT homepage) AS n FROM {o}) c ON c.n > 0) q
    JOIN (SELECT domain, row_number() OVER (ORDER BY domain) - 1 AS p FROM (SELECT DISTINCT regexp_extract(homepage, '//([^/]+)', 1) AS domain FROM {o}) x) d ON d.p = q.p""", (("explode(array(0, 1, 2, 3, 4))", "unnest([0, 1, 2, 3, 4])"),))
portable("w9_refusals", "Where each route first has three refused queries in a row; an answer in between starts anew.", """
    SELECT route, run_id, min(seq) AS tripped_at FROM (SELECT route, run_id, seq, count(*) OVER (PARTITION BY route, run_id, answers ORDER BY seq) AS streak, ok FROM (
        SELECT route, run_id, ok, seq, sum(CASE WHEN ok THEN 1 ELSE 0 END) OVER (PARTITION BY route, run_id ORDER BY seq) AS answers FROM (SELECT route, run_id, ok, row_number() OVER (PARTITION BY route, run_id ORDER BY source) AS seq FROM {l}) s) t WHERE NOT ok) u
    WHERE streak >= 3 GROUP BY 1, 2""")
portable("w13_latest_title", "Latest item of every headline.", "SELECT title_key, max(id) AS id FROM {i} WHERE title_key <> '' GROUP BY 1")
portable("t2_caps", "The 25 newest screened items of each reason (the cap is the operator).", "SELECT screen_reason, id FROM (SELECT screen_reason, id, row_number() OVER (PARTITION BY screen_reason ORDER BY id DESC) AS rk FROM {i} WHERE status = 'screened') t WHERE rk <= 25")
portable("t4_last_runs", "The last four runs.", "SELECT id, items_new FROM {r} ORDER BY id DESC LIMIT 4")
portable("u2_category_union", "Categories of each cluster, merged.", "SELECT cluster_id, array_sort(collect_set(c)) AS categories FROM (SELECT cluster_id, explode(alert_categories) AS c FROM {i} WHERE cluster_id IS NOT NULL) t GROUP BY 1", (("array_sort(collect_set(c))", "list_sort(list(DISTINCT c))"), ("explode(", "unnest(")))
portable("x4_main_alias", "First alias of each name, else its name.", "SELECT id, coalesce(element_at(aliases, 1), name) AS main_alias FROM {n}", (("element_at(aliases, 1)", "aliases[1]"),))
portable("x17_new_in_hours", "Items of the last 24, 72 and 168 hours of runs.", """
    SELECT sum(CASE WHEN r.started_at >= z.last - INTERVAL 24 HOUR THEN 1 ELSE 0 END) AS n_24, sum(CASE WHEN r.started_at >= z.last - INTERVAL 72 HOUR THEN 1 ELSE 0 END) AS n_72, sum(CASE WHEN r.started_at >= z.last - INTERVAL 168 HOUR THEN 1 ELSE 0 END) AS n_168
    FROM {i} i JOIN {r} r ON r.id = i.run_id JOIN (SELECT max(started_at) AS last FROM {r}) z ON r.started_at >= z.last - INTERVAL 168 HOUR""")
portable("d1_documents_of_items", "Documents of each kind with the status of their item.", "SELECT d.doc_kind, coalesce(i.status, 'none') AS status, count(*) AS n_docs, sum(d.n_chars) AS n_chars FROM {d} d LEFT JOIN {i} i ON i.id = d.item_id GROUP BY 1, 2")
portable("k10_export", "Nested export of each name as JSON: the ten newest candidates first.", """
    SELECT name_id, to_json(transform(array_sort(collect_list(struct(rk, id, route))), x -> struct(x.id AS id, x.route AS route))) AS items
    FROM (SELECT m.name_id, i.id, i.route, row_number() OVER (PARTITION BY m.name_id ORDER BY i.id DESC) AS rk FROM {i} i JOIN (SELECT DISTINCT item_id, name_id FROM {m}) m ON m.item_id = i.id WHERE i.status = 'candidate') t WHERE rk <= 10 GROUP BY 1""",
    (("to_json(transform(array_sort(collect_list(struct(rk, id, route))), x -> struct(x.id AS id, x.route AS route)))", "CAST(to_json(list({'id': id, 'route': route} ORDER BY rk)) AS VARCHAR)"),))
