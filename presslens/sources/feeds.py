"""Parsing of fetched documents into mentions: RSS, article JSON and HTML pages, and the addresses to fetch them from.

RSS and JSON are parsed by Spark's own ``from_xml`` and ``from_json``; a broken document gives no rows. HTML needs a
real parser: Arrow batches go through the standard library's.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from presslens.functions.times import utc_micros
from presslens.functions.titles import strip_html
from presslens.functions.urls import domain_of, looks_like_article, unwrap_redirect

RSS = "channel struct<title:string, item:array<struct<title:string, link:string, guid:string, pubDate:string, description:string, source:struct<_VALUE:string, _url:string>, `News:Source`:string>>>"
ATOM = "title string, entry array<struct<title:string, link:array<struct<_href:string, _rel:string>>, published:string, updated:string, summary:string>>"
ARTICLES = "articles array<struct<url:string, url_mobile:string, title:string, seendate:string, domain:string, language:string, sourcecountry:string>>"
SUMMARY_LENGTH = 600
FEED_WORDS = "(?i)(rss|atom|feed)"

# The article API's country codes (FIPS 10-4) and language names.
API_COUNTRIES = {
    "SE": "SW", "GR": "GR", "ES": "SP", "DE": "GM", "IT": "IT", "NL": "NL", "FR": "FR", "GB": "UK", "HU": "HU", "PL": "PL", "CZ": "EZ", "SK": "LO", "FI": "FI", "NO": "NO", "DK": "DA",
    "PT": "PO", "CH": "SZ", "AT": "AU", "BE": "BE", "IE": "EI", "LT": "LH", "LV": "LG", "EE": "EN", "RO": "RO", "US": "US", "CN": "CH", "HK": "HK", "IN": "IN", "TW": "TW",
}
API_LANGUAGES = {
    "sv": "swedish", "el": "greek", "es": "spanish", "de": "german", "it": "italian", "nl": "dutch", "fr": "french", "en": "english", "hu": "hungarian", "pl": "polish", "cs": "czech",
    "sk": "slovak", "fi": "finnish", "nb": "norwegian", "no": "norwegian", "da": "danish", "pt": "portuguese", "lt": "lithuanian", "lv": "latvian", "et": "estonian", "ro": "romanian", "zh": "chinese",
}


def parse_rss(docs: DataFrame, doc: str = "doc", route: str = "rss", hosts: list[str] | None = None) -> DataFrame:
    """One mention per entry of each RSS document, all other columns of ``docs`` kept; ``hosts`` are those whose links only redirect."""
    parsed = docs.withColumn("__p", F.from_xml(doc, RSS, {"mode": "PERMISSIVE", "rowTag": "rss"}))
    entries = parsed.select(*[c for c in docs.columns if c != doc], F.col("__p.channel.title").alias("feed_title"), F.explode("__p.channel.item").alias("e"))
    title, source = strip_html(F.col("e.title")), F.coalesce("e.source._VALUE", "e.`News:Source`")
    named = F.endswith(title, F.concat(F.lit(" - "), source))
    link = unwrap_redirect(F.col("e.link"), hosts)
    return entries.select(
        *[c for c in docs.columns if c != doc],
        F.when(named, F.trim(F.left(title, F.length(title) - F.length(source) - 3))).otherwise(title).alias("title"),
        link.alias("link"), F.lit(route).alias("route"), F.substring(strip_html(F.col("e.description")), 1, SUMMARY_LENGTH).alias("summary"),
        utc_micros(F.col("e.pubDate")).alias("published_us"), F.coalesce(source, F.col("feed_title")).alias("source_name"),
        F.coalesce(F.nullif(domain_of(F.col("e.source._url")), F.lit("")), domain_of(link)).alias("source_domain"),
    )


def parse_atom(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One mention per entry of each Atom document: its alternate link, the date of publication, else of the last change."""
    parsed = docs.withColumn("__p", F.from_xml(doc, ATOM, {"mode": "PERMISSIVE", "rowTag": "feed"}))
    entries = parsed.select(*[c for c in docs.columns if c != doc], F.col("__p.title").alias("feed_title"), F.explode("__p.entry").alias("e"))
    usual = F.filter("e.link", lambda x: F.coalesce(x["_rel"], F.lit("alternate")) == "alternate")
    link = F.coalesce(F.get(usual, F.lit(0))["_href"], F.get("e.link", F.lit(0))["_href"])
    return entries.select(
        *[c for c in docs.columns if c != doc], strip_html(F.col("e.title")).alias("title"), link.alias("link"), F.lit("rss").alias("route"),
        F.substring(strip_html(F.col("e.summary")), 1, SUMMARY_LENGTH).alias("summary"), F.coalesce(utc_micros(F.col("e.published")), utc_micros(F.col("e.updated"))).alias("published_us"),
        F.coalesce(F.nullif("feed_title", F.lit("")), domain_of(link)).alias("source_name"), domain_of(link).alias("source_domain"),
    )


def parse_articles(docs: DataFrame, doc: str = "doc") -> DataFrame:
    """One mention per article of each JSON answer; anything that isn't an object is an error and gives no rows."""
    parsed = docs.where(F.startswith(F.ltrim(doc), F.lit("{"))).withColumn("__p", F.from_json(doc, ARTICLES))
    rows = parsed.select(*[c for c in docs.columns if c != doc], F.explode("__p.articles").alias("a"))
    return rows.select(
        *[c for c in docs.columns if c != doc], strip_html(F.col("a.title")).alias("title"), F.col("a.url").alias("link"), F.lit("gdelt").alias("route"),
        utc_micros(F.col("a.seendate")).alias("published_us"), F.col("a.domain").alias("source_name"), domain_of(F.col("a.url")).alias("source_domain"),
        F.left(F.lower("a.language"), F.lit(12)).alias("lang"), F.col("a.sourcecountry").alias("country"),
    )


class _Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.links, self.feeds, self.href, self.text = [], [], None, []

    def handle_starttag(self, tag, attrs):
        a = {k: v or "" for k, v in attrs}
        if tag == "link" and "alternate" in a.get("rel", "").lower() and any(x in a.get("type", "").lower() for x in ("rss", "atom")):
            self.feeds.append(a.get("href", ""))
        if tag == "a" and a.get("href"):
            self.href, self.text = a["href"], []

    def handle_data(self, data):
        if self.href is not None:
            self.text.append(data)

    def handle_endtag(self, tag):
        if tag == "a" and self.href is not None:
            self.links.append((self.href, " ".join("".join(self.text).split())))
            self.href = None


def page_links(html: str | None, base: str | None) -> list[tuple[str, str, bool]]:
    """(absolute address without fragment, text, whether it is a declared feed) of every link of a page."""
    parser = _Links()
    parser.feed(html or "")
    out = [(urljoin(base or "", h).split("#")[0], t, False) for h, t in parser.links if not h.startswith(("javascript:", "mailto:", "tel:", "#"))]
    return out + [(urljoin(base or "", h), "", True) for h in parser.feeds if h]


def extract_links(pages: DataFrame) -> DataFrame:
    """(page_url, position, link, text, is_feed) of pages (page_url, html)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(u, n, *x) for u, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) for n, x in enumerate(page_links(h, u))]
            cols = list(zip(*rows)) if rows else [()] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int32(), pa.string(), pa.string(), pa.bool_()))], names=["page_url", "position", "link", "text", "is_feed"])

    return pages.select("page_url", "html").mapInArrow(run, "page_url string, position int, link string, text string, is_feed boolean")


def feed_anchors(links: DataFrame) -> DataFrame:
    """Links of ``extract_links`` that may lead to a feed: declared ones first, then any with a feed's name in address or text."""
    named = F.col("link").rlike(FEED_WORDS) | F.col("text").rlike(FEED_WORDS)
    return links.where(F.col("is_feed") | named).select("page_url", "link", F.when(F.col("is_feed"), 0).otherwise(1).alias("rank")).groupBy("page_url", "link").agg(F.min("rank").alias("rank"))


def page_items(links: DataFrame, pattern: str | None = None) -> DataFrame:
    """Undated mentions of the articles that pages link to, each link of a page once, by its first place and longest text."""
    good = links.where(~F.col("is_feed")).where(looks_like_article(F.col("link"), F.col("text"), F.col("page_url"), pattern))
    return good.groupBy("page_url", "link").agg(F.max_by("text", F.struct(F.length("text"), "text")).alias("title"), F.min("position").alias("position")).select("page_url", "link", "title", "position", F.lit("page").alias("route"), domain_of(F.col("link")).alias("source_domain"))


def _plus(text: Column) -> Column:
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def second_search_url(query: Column, lang: Column, country: Column) -> Column:
    """Address of the second news search in a market."""
    low = F.lower(lang)
    market = F.when((F.upper(country) == "NO") & low.isin("nb", "no"), "nb-NO").otherwise(F.concat(low, F.lit("-"), F.upper(country)))
    return F.concat(F.lit("https://www.bing.com/news/search?q="), _plus(query), F.lit("&format=rss&mkt="), market)


def article_api_url(query: Column, lang: Column, country: Column, timespan: str = "24h", most: int = 250) -> Column:
    """Address of the article API's newest answers; its country codes and language names are its own, unknown ones go as they are."""
    code, name = F.upper(country), F.lower(lang)
    codes, names = (F.create_map(*(F.lit(x) for pair in d.items() for x in pair)) for d in (API_COUNTRIES, API_LANGUAGES))
    where = F.when(F.length(country) > 0, F.concat(F.lit(" sourcecountry:"), F.coalesce(F.try_element_at(codes, code), code))).otherwise("")
    what = F.when(F.length(lang) > 0, F.concat(F.lit(" sourcelang:"), F.coalesce(F.try_element_at(names, name), name))).otherwise("")
    return F.concat(F.lit("https://api.gdeltproject.org/api/v2/doc/doc?query="), _plus(F.concat(query, where, what)), F.lit(f"&mode=artlist&maxrecords={most}&format=json&timespan={timespan}&sort=datedesc"))


def search_url(query: Column, lang: Column, country: Column, when: str = "1d", base: str = "https://news.example/rss/search") -> Column:
    """Address of a news search in a market."""
    q = F.url_encode(F.concat(query, F.lit(f" when:{when}" if when else "")))
    return F.concat(F.lit(base + "?q="), q, F.lit("&hl="), lang, F.lit("&gl="), F.upper(country), F.lit("&ceid="), F.upper(country), F.lit(":"), lang)


def flat_lists(lines: DataFrame) -> DataFrame:
    """(block, ord, value) of ``- value`` lines under top-level ``block:`` headers; lines are (file, n, line)."""
    from pyspark.sql import Window

    head = F.when(F.col("line").rlike(r"^\w[\w-]*:\s*$"), F.regexp_extract("line", r"^([\w-]+):", 1))
    w = Window.partitionBy("file").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    item = F.regexp_extract("line", r"^\s*-\s+[\"']?([^\"'#]+?)[\"']?\s*(?:#.*)?$", 1)
    return lines.withColumn("block", F.last(head, ignorenulls=True).over(w)).withColumn("value", item).where("value <> '' AND block IS NOT NULL").select("file", "block", F.col("n").alias("ord"), "value")
