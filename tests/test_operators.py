"""Operators against plain sequential restatements on small random inputs; sinks and streams on small folders."""

import random
from collections import Counter

from pyspark.sql import functions as F

from presslens.functions import titles as T
from presslens.operators import clusters, matching, scheduling
from presslens.sources import feeds
from presslens.sources.store import Store, fill_only, insert_absent, upsert
from presslens.streaming.incremental import Curator


def test_clusters_equal_sequential(spark):
    rng = random.Random(1)
    rows = [(rng.choice("ab"), i, " ".join(rng.sample(["court", "loans", "bonds", "group", "sells", "terms", "plan"], rng.randint(3, 5)))) for i in range(60)]
    want, seen = {}, []
    for scope, i, key in rows:
        mine = {w for w in key.split() if len(w) > 2}
        parent = None
        for s, j, other, toks in reversed(seen):
            if s == scope and (other == key or len(mine) >= 4 and len(toks) >= 4 and len(mine & toks) >= 0.6 * len(mine | toks)):
                parent = j
                break
        want[(scope, i)] = want[(scope, parent)] if parent is not None else i
        seen.append((scope, i, key, mine))
    df = spark.createDataFrame(rows, "scope string, id long, key string").withColumn("toks", T.tokens(F.col("key")))
    df = df.withColumn("at", F.lit(0))
    got = {r["id"]: r["cluster"] for r in clusters.roots(clusters.pointers(df, df.select("id", "scope"))).collect()}
    assert got == {i: c for (_, i), c in want.items()}


def test_rotation_keeps_its_promises(spark):
    """Never over the cap, never over a name's share; a job left out is behind every kept one it could have replaced."""
    rng = random.Random(2)
    for cap, share, slots in ((5, 2, 2), (8, 0, 3), (7, 1, 0), (3, 1, 9), (40, 1, 2)):
        rows = [(f"q{i}", rng.choice(["x", "y", "z", None]), rng.randint(0, 3), float(-rng.randint(0, 9)), rng.randint(0, 3), f"q{i:02}", rng.random() < 0.4) for i in range(24)]
        df = spark.createDataFrame(rows, "label string, name_id string, tier int, waited double, prio int, ord string, dormant boolean")
        got = {r["label"]: r["kept"] for r in scheduling.rotate(df, cap, share, slots).collect()}
        assert got.keys() == {r[0] for r in rows}
        if cap >= len(rows):
            assert all(got.values())
            continue
        urgency = {r[0]: r[2:6] for r in rows}
        inside = [r for r in rows if got[r[0]]]
        held = Counter(r[1] for r in inside if r[1] is not None)
        full = {n for n, k in held.items() if share and k >= share}
        assert len(inside) <= cap and (not share or max(held.values(), default=0) <= share)
        for asleep in (False, True):
            ins, outs = ([r for r in rows if r[6] is asleep and got[r[0]] is kept] for kept in (True, False))
            free = [r for r in outs if r[1] not in full]
            # among jobs of one kind whose name has room left, the order of urgency decides
            assert not free or all(urgency[i[0]] <= min(urgency[o[0]] for o in free) for i in ins if i[1] not in full)
            for o in outs:
                if o[1] in full:
                    assert all(urgency[i[0]] < urgency[o[0]] for i in ins if i[1] == o[1])
        reserve = min(slots, sum(r[6] for r in rows), cap - 1)
        assert sum(not r[6] for r in inside) <= cap - reserve
        # places stay empty only when nothing is left that may take one
        if len(inside) < cap:
            assert all(r[1] in full for r in rows if r[6] and not got[r[0]])


def test_match_guards(spark):
    names = spark.createDataFrame([("n1", ["Ab Cd", "Ab"]), ("n2", ["Åland"]), ("n3", [""]), ("n4", None)], "id string, aliases array<string>")
    items = spark.createDataFrame([(1, "ab-cd rises", None), (2, "x", "the åland bank"), (3, "tab", "cdab"), (4, None, None)], "id long, title string, summary string")
    got = {tuple(r) for r in matching.match_aliases(items, matching.alias_table(names)).collect()}
    assert got == {(1, "n1", "Ab Cd", "title", 1.0), (2, "n2", "Åland", "summary", 0.7)}


def test_breaker_and_quota(spark):
    rows = [("g", 1, s, n) for s, n in enumerate([0, 0, 3, 0, 0, 0, 0, 1])]
    df = spark.createDataFrame(rows, "route string, run_id long, seq int, items int")
    assert [tuple(r) for r in scheduling.trips(df, 3, F.col("items") > 0).collect()] == [("g", 1, 5)]
    q = spark.createDataFrame([("g", i, r) for i, r in enumerate([True, True, True, False])], "route string, run_id long, refused boolean")
    assert [r["cap"] for r in scheduling.quota(q, 160, 80, 200, 0.75, 5).orderBy("run_id").collect()] == [120, 90, 80, 85]


def test_sinks(spark, tmp_path):
    old = spark.createDataFrame([(1, "a", ""), (2, "b", "y")], "id long, v string, w string")
    new = spark.createDataFrame([(2, "c", "z"), (2, "d", "q"), (3, "e", "")], "id long, v string, w string")
    assert {tuple(r) for r in upsert(old, new, ["id"], "v").collect()} == {(1, "a", ""), (2, "d", "q"), (3, "e", "")}
    assert [r["id"] for r in insert_absent(old, new, ["id"]).collect()] == [3]
    assert {tuple(r) for r in fill_only(old, spark.createDataFrame([(1, "n"), (2, "n")], "id long, w string"), "id", ["w"]).collect()} == {(1, "a", "n"), (2, "b", "y")}
    store = Store(spark, str(tmp_path))
    assert store.read("t") is None
    store.write("t", old)
    store.append("t", new)
    assert store.read("t").count() == 5
    store.write("t", upsert(store.read("t").dropDuplicates(["id"]), new, ["id"], "v"))
    store.compact("t", 1)
    assert store.read("t").count() == 3 and len(store.versions("t")) == 2


def test_curating_stream_is_idempotent(spark, tmp_path):
    src = tmp_path / "in"
    spark.createDataFrame([("t1", "https://a.test/x?utm_a=1"), ("t2", "https://a.test/x"), ("", "https://a.test/z"), ("t3", "https://a.test/y")], "title string, link string").coalesce(1).write.parquet(str(src))
    for _ in range(2):
        stream = spark.readStream.schema("title string, link string").parquet(str(src))
        Curator(spark, str(tmp_path / "store")).start(stream, str(tmp_path / "ck1")).awaitTermination()
    Curator(spark, str(tmp_path / "store")).start(spark.readStream.schema("title string, link string").parquet(str(src)), str(tmp_path / "ck2")).awaitTermination()
    assert sorted(r[0] for r in Store(spark, str(tmp_path / "store")).read("items").select("canonical_url").collect()) == ["https://a.test/x", "https://a.test/y"]


def test_feeds(spark):
    docs = spark.createDataFrame([("<rss><channel><title>F</title><item><title>A &amp; B - Src</title><link>https://x.test/1</link><pubDate>Mon, 15 Sep 2025 03:47:04 +0200</pubDate><description>&lt;b&gt;s&lt;/b&gt;</description><source url='https://www.src.test'>Src</source></item></channel></rss>",), ("broken",), (None,)], "doc string")
    r = feeds.parse_rss(docs).collect()
    assert [(x["title"], x["link"], x["summary"], x["source_name"], x["source_domain"], x["published_us"]) for x in r] == [("A & B", "https://x.test/1", "s", "Src", "src.test", 1757900824000000)]
    assert feeds.page_links('<a href="/a#x">t <b>u</b></a><a href="mailto:q">m</a><link rel="alternate" type="application/rss+xml" href="f.xml"><a href="y"', "https://p.test/d/") == [("https://p.test/a", "t u", False), ("https://p.test/d/f.xml", "", True)]
    lines = spark.createDataFrame([("f", i, x) for i, x in enumerate(["# c", "domains:", "  - a.test  # n", "other:", "- 'b c'", "x: 1"])], "file string, n int, line string")
    assert {(r["block"], r["value"]) for r in feeds.flat_lists(lines).collect()} == {("domains", "a.test"), ("other", "b c")}
    articles = spark.createDataFrame([('{"articles":[{"url":"https://a.test/1","title":"T","seendate":"20250915T151821Z","language":"English"}]}',), ("rate limit",)], "doc string")
    assert [(x["link"], x["lang"]) for x in feeds.parse_articles(articles).collect()] == [("https://a.test/1", "english")]


def test_echoes_outside_the_cluster(spark, tmp_path):
    from presslens.plans import registry

    items = [(1, "gola court blocks refinancing", "candidate", True), (2, "gola refinancing talks stall", "screened", False), (3, "gola appoints chairman", "screened", False), (4, "refinancing of another house", "screened", False)]
    spark.createDataFrame([(*r, None) for r in items], "id long, title_key string, status string, alert_candidate boolean, cluster_id long").write.parquet(f"{tmp_path}/items.parquet")
    spark.createDataFrame([(1, "a", "Gola", "title", 1.0), (2, "a", "Gola", "title", 1.0), (3, "a", "Gola", "title", 1.0), (4, "b", "Other", "title", 1.0)], "item_id long, name_id string, alias string, where_ string, confidence double").write.parquet(f"{tmp_path}/matches.parquet")
    spark.createDataFrame([("a", "Gola Group", ["Gola"]), ("b", "Other", ["Other"])], "id string, name string, aliases array<string>").write.parquet(f"{tmp_path}/names.parquet")
    assert [tuple(r) for r in registry.queries()["j17_echo_stems"](spark, str(tmp_path)).collect()] == [(1, "a", 1)]


def test_archive_read_again_is_no_news(spark, tmp_path):
    from presslens.plans import registry

    links = [(1, "a"), (1, "b"), (2, "a"), (2, "c"), *((3, x) for x in "defg"), (3, "a"), (4, "d"), (4, "h"), (5, "a"), *((5, f"o{k}") for k in range(3))]
    rows = [(n, "page", "x.example", f"https://x.example/{u}", r) for n, (r, u) in enumerate(links)]
    spark.createDataFrame(rows, "id long, route string, source_domain string, canonical_url string, run_id long").write.parquet(f"{tmp_path}/items.parquet")
    got = registry.queries()["c18_guarded_visits"](spark, str(tmp_path)).collect()
    assert {(r["run_id"], r["n_new"]) for r in got} == {(2, 1), (4, 1), (5, 3)}


def test_scan_and_turns_follow_all_runs(spark):
    from presslens.plans import registry

    sf = "/root/testdata/sf0.01"  # has more than ten runs
    assert registry.queries()["w5_due_runs"](spark, sf).select("run_id").distinct().count() == spark.read.parquet(f"{sf}/runs.parquet").select("id").distinct().count()
    candidates = spark.read.parquet(f"{sf}/items.parquet").where("status = 'candidate'").select("id").distinct().count()
    assert 0.15 * candidates < registry.queries()["s17_store_span"](spark, sf).count() < 0.35 * candidates
