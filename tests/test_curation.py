"""The curation pass on a small store: every outcome, and what each leaves behind."""

import datetime as dt

import pytest

from presslens.operators import curation

NOW = dt.datetime(2026, 10, 18, 12)
DAY = dt.timedelta(days=1)
BATCH = "id long, title string, link string, route string, query string, summary string, published_at timestamp, source_name string, source_domain string, lang string, name_ids array<string>, now timestamp"
STORED = "id long, canonical_url string, title string, title_key string, summary string, source_name string, source_domain string, published_at timestamp, at long, status string, also_routes array<string>"
RULES = [(1, "domain", "noise.test"), (2, "title", r"(?i)\bvideo\b")]
LEXICON = {"court": r"(?i)\bcourt\b", "bid": r"(?i)\bbid\b"}


def mention(i, title, link, route="rss", published=NOW - DAY, names=(), summary="", domain="", query="q"):
    return (i, title, link, route, query, summary, published, "Src", domain, "en", list(names), NOW)


@pytest.fixture(scope="module")
def done(spark):
    seconds = int(NOW.replace(tzinfo=dt.timezone.utc).timestamp())
    old = [
        (1, "https://a.test/old", "Gola wins", "gola wins", "", "", "a.test", None, seconds - 3600, "candidate", ["rss:q"]),
        (2, "https://b.test/x", "t", "gola sells its harbour warehouses to rivals", "s", "Src", "b.test", None, seconds - 2 * 3600, "candidate", []),
        (3, "https://c.test/y", "t", "regulator fines gola over hidden harbour fees", "s", "Cee", "c.test", None, seconds - 9 * 86400, "candidate", []),
        (4, "https://d.test/z", "t", "gola plans large bond sale soon", "s", "Dee", "d.test", None, seconds - 86400, "candidate", []),
    ]
    batch = [
        mention(100, "", "https://a.test/1"), mention(101, "Gola", None),
        mention(102, "Gola a", "https://a.test/2", published=NOW - 9 * DAY), mention(103, "Gola b", "https://a.test/3", "bingnews", None),
        mention(104, "Gola c", "https://a.test/2009/x"), mention(105, "Gola d", "https://a.test/2026/07/06/x"), mention(106, "Gola e - 01/08", "https://a.test/5"),
        mention(107, "Gola wins again", "https://www.a.test/old?utm_x=1", "bingnews", summary="now there", names=["g"]), mention(108, "Nothing here", "https://a.test/7"),
        mention(109, "Quite another thing", "https://a.test/8", "googlenews", names=["g"]), mention(110, "Other thing", "https://a.test/9", "googlenews", names=["c"]),
        mention(111, "Gola court video", "https://a.test/10"), mention(112, "Gola court case", "https://x.noise.test/11"), mention(113, "Vera speaks", "https://noise.test/12"),
        mention(114, "Gola sells its harbour warehouses to rivals", "https://b.test/13", domain="b.test"), mention(115, "Regulator fines Gola over hidden harbour fees", "https://e.test/14"),
        mention(116, "Gola plans large bond sale now", "https://f.test/15"), mention(117, "Court hears bid for Gola", "https://g.test/16"), mention(118, "Court hears bid for Gola", "https://g.test/16#x", "bingnews"),
        mention(119, "Own news", "https://gola.test/17", "page", None, ["g"], query="own"), mention(119, "Own news", "https://gola.test/17", "page", None, ["g"], query="own"),
        mention(120, "Redirected", "https://news.google.com/rss/articles/zz", names=["g"], route="googlenews"),
    ]
    names = spark.createDataFrame([("g", "name", False, ["Gola"]), ("c", "comp", False, ["Cepu"]), ("v", "comp", False, ["Vera"])], "id string, kind string, watch boolean, aliases array<string>")
    make = spark.createDataFrame
    return curation.curate(
        make(batch, BATCH), make(old, STORED), make([(i, "g") for i in (1, 2, 3, 4)], "item_id long, name_id string"), names, make(RULES, "ordinal int, kind string, pattern string"), LEXICON,
        resolved=make([("https://news.google.com/rss/articles/zz", "https://h.test/2020/01/02/a")], "link string, target string"), trusted=make([("own",)], "query string"),
    )


def test_outcomes(done):
    got = [tuple(r) for r in done.outcomes.collect()]
    assert len(got) == len(dict(got)) and dict(got) == {
        100: "empty", 101: "empty", 102: "stale_date", 103: "stale_undated", 104: "stale_year", 105: "stale_redated", 106: "stale_redated", 107: "duplicate", 108: "unrelated",
        109: "candidate", 110: "unrelated", 111: "screened", 112: "kept", 113: "screened", 114: "served_again", 115: "screened", 116: "candidate", 117: "candidate", 118: "duplicate", 119: "candidate", 120: "stale_year",
    }


def test_what_is_stored(done):
    items = {r["id"]: r for r in done.items.collect()}
    assert items.keys() == {109, 111, 112, 113, 115, 116, 117, 119}
    assert items[115]["screen_reason"] == "republished:2026-10-09" and items[112]["screen_reason"] == "kept:noise_domain:noise.test:category"
    assert {i for i, r in items.items() if r["alert_candidate"]} == {117} and items[117]["alert_categories"] == ["court", "bid"]
    assert items[116]["story"] == 4 and items[117]["story"] == 117
    matches = {(r["item_id"], r["name_id"]): (r["alias"], r["confidence"]) for r in done.matches.collect()}
    assert matches[(109, "g")] == ("(query)", 0.4) and matches[(119, "g")] == ("(page)", 0.8) and matches[(117, "g")] == ("Gola", 1.0) and (114, "g") not in matches
    old = {r["id"]: r for r in done.stored.collect()}
    assert old[1]["summary"] == "now there" and old[1]["also_routes"] == ["rss:q", "bingnews:q"] and old[1]["published_at"] == NOW - DAY and old[2]["summary"] == "s" and len(old) == 4


def test_empty_store_and_batch(spark, done):
    make = spark.createDataFrame
    args = [make([], STORED), make([], "item_id long, name_id string"), make([], "id string, kind string, watch boolean, aliases array<string>"), make([], "ordinal int, kind string, pattern string"), LEXICON]
    assert curation.curate(make([], BATCH), *args).outcomes.count() == 0
    alone = curation.curate(make([mention(1, "x", "https://a.test/1")], BATCH), *args)
    assert [tuple(r) for r in alone.outcomes.collect()] == [(1, "unrelated")] and alone.items.count() == 0
