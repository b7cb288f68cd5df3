"""URL and title functions on tables of cases."""

import base64

from pyspark.sql import functions as F

from presslens.functions import titles as T
from presslens.functions import urls as U

TOKEN = base64.urlsafe_b64encode(b"\x08\x13\x22\x20https://a.example/x/y?z=1\xd2\x01\x00").decode().rstrip("=")


def column(spark, values, f):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[1] for r in sorted(df.select("i", f(F.col("v"))).collect())]


def test_urls(spark):
    urls = ["https://WWW.m.Foo.example:80/a//b/index.html?utm_x=1&b=2&a=1&ref=q#f", "https://u@amp.Foo.example/x/amp/", f"https://news.google.com/rss/articles/{TOKEN}?oc=5", "https://www.bing.com/r?url=https%3A%2F%2Fx.test%2Fp%3Fq%3D1", None, "nonsense", "", "https://www.msn.com/x?url=/local", "HTTPS://a.test/a%20b/?q=x%2Fy&p=a+b&p=~*&e"]
    assert column(spark, urls, U.domain_of) == ["foo.example", "foo.example", "news.google.com", "bing.com", "", "", "", "msn.com", "a.test"]
    assert column(spark, urls, U.canonical_url) == ["https://m.foo.example:80/a/b?a=1&b=2", "https://u@amp.foo.example/x", "https://a.example/x/y?z=1", "https://x.test/p?q=1", None, "https:///nonsense", "", "https://msn.com/x?url=%2Flocal", "https://a.test/a%20b?e=&p=a+b&p=~%2A&q=x%2Fy"]
    long = "https://" + "h" * 20_000 + ".test/" + "p" * 120_000
    assert column(spark, [f"https://bing.com/?url={long}", long], U.canonical_url) == [long, long] and column(spark, [long.replace("https://", "https://www.")], U.domain_of) == ["h" * 20_000 + ".test"]


def test_url_dates(spark):
    urls = ["https://a.test/2009/03/12/x-20260101", "https://a.test/06.07.2026-b", "https://a.test/2026/02/30/x", "https://a.test/1200/x", None, "https://a.test/2026/2009/x", "https://a.test/x/20260131-a", "https://a.test/x.01.02.2020"]
    assert [str(x) for x in column(spark, urls, U.url_date)] == ["2009-03-12", "2026-07-06", "None", "None", "None", "None", "2026-01-31", "None"]
    assert column(spark, urls, U.url_year) == [2009, 2026, 2026, None, None, 2026, None, 2020]


def test_titles(spark):
    assert column(spark, ["Foo Bär & Co. meldet | The Daily", "Ａbc – x", None, "", "A - B-C", "A - one two three four five", "A - 24 Hours", "A -B", "A - B | C d"], lambda c: T.title_key(c)) == ["foo bär co meldet", "abc x", "", "", "a b c", "a one two three four five", "a 24 hours", "a b", "a b"]
    assert column(spark, ["the court clears a court", None], lambda c: T.tokens(c)) == [["court", "clears"], None]
    assert column(spark, ["<b>a &amp; b</b>&nbsp;c", None], T.strip_html) == ["a & b c", ""]


def test_trailing_date(spark):
    df = spark.createDataFrame([("x - 27/04", "2026-03-01"), ("x - 01/03", "2026-03-01"), ("x - 31/02", "2026-03-01"), ("x", None)], "t string, p string")
    assert [str(r[0]) for r in df.select(T.trailing_date(F.col("t"), F.col("p"))).collect()] == ["2025-04-27", "2026-03-01", "None", "None"]
