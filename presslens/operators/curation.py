"""The curation pass: raw mentions of one batch against the store, as one declarative plan per step.

Every mention gets exactly one outcome: ``empty``, ``stale_*``, ``duplicate`` (its page is stored: it leaves provenance and
fills what is empty), ``unrelated`` (no name in it and none attributed), ``served_again`` (not stored), ``screened``, ``kept``
(screened, but for a name that is watched) or ``candidate``. Steps are joins on keys; of the store only rows that share a
page, a headline or a token with the batch go on, so a pass costs what its batch costs. Ties go to the earlier mention.

A batch is (id, title, link, route, query, summary, published_at, source_name, source_domain, lang, name_ids, now); ``id``
grows with arrival and ``now`` is the start of its run. Null and blank titles and links are empty; repeated ids count once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions import titles, urls
from presslens.operators import clusters, matching
from presslens.session import cut
from presslens.sources import store

# Routes that only search, and the days by which a written date may be behind the claimed one.
SEARCH_ROUTES = ["googlenews", "bingnews", "gdelt"]
REDATE_GAP_DAYS = 14
#: Confidence of names that only the query, the page or the feed tells.
BY_QUERY, BY_PAGE, BY_FEED = 0.4, 0.8, 0.9


@dataclass
class Pass:
    """What a pass leaves: an outcome per mention, new items, their matches, and the old items as they are now."""

    outcomes: DataFrame
    items: DataFrame
    matches: DataFrame
    stored: DataFrame


def redated(link: Column, title: Column, published: Column, cutoff: Column) -> Column:
    """Whether the date in an address or at the end of a headline belies the claimed one; undated ones go by the address."""
    written = urls.url_date(link)
    claimed = published.cast("date") - F.lit(REDATE_GAP_DAYS)
    return F.coalesce(F.when(published.isNull(), written < cutoff.cast("date")).otherwise((written < claimed) | (titles.trailing_date(title, published) < claimed)), F.lit(False))


def staleness(link: Column, title: Column, route: Column, published: Column, cutoff: Column) -> Column:
    """Why a mention is too old, null if it isn't: its date, none where one is due, a year or a date written elsewhere."""
    return (
        F.when(published < cutoff, "stale_date")
        .when(published.isNull() & route.isin(*SEARCH_ROUTES), "stale_undated")
        .when(urls.url_year(link) < F.year(cutoff), "stale_year")
        .when(redated(link, title, published, cutoff), "stale_redated")
    )


def arrivals(batch: DataFrame, lookback_hours: int, resolved: DataFrame | None = None, hosts: list[str] | None = None) -> DataFrame:
    """The batch with its canonical address, domain and, for mentions that end here, ``outcome``.

    ``resolved`` is (link, target) of token links whose target is known by now; the target is judged for age again.
    """
    cutoff = F.col("now") - F.make_dt_interval(hours=F.lit(lookback_hours))
    blank = (F.coalesce(F.length("title"), F.lit(0)) == 0) | (F.coalesce(F.length("link"), F.lit(0)) == 0)
    rows = batch.dropDuplicates(["id"]).withColumn("canonical_url", urls.canonical_url(F.col("link"), hosts))
    outcome = F.when(blank, "empty").otherwise(staleness(F.col("link"), F.col("title"), F.col("route"), F.col("published_at"), cutoff))
    rows = rows.withColumn("outcome", outcome)
    if resolved is not None:
        known = resolved.groupBy(urls.canonical_url(F.col("link"), hosts).alias("canonical_url")).agg(F.min("target").alias("__target"))
        rows = rows.join(known, "canonical_url", "left")
        moved = F.col("__target").isNotNull() & urls.is_token_link(F.col("canonical_url")) & ~urls.is_token_link(F.col("__target"))
        target = F.when(moved, urls.canonical_url(F.col("__target"), hosts))
        again = F.when(urls.url_year(target) < F.year(cutoff), "stale_year").when(redated(target, F.lit(""), F.col("published_at"), cutoff), "stale_redated")
        rows = rows.withColumn("outcome", F.coalesce("outcome", F.when(moved, again))).withColumn("canonical_url", F.coalesce(target, "canonical_url")).drop("__target")
    return rows.withColumn("source_domain", F.coalesce(F.nullif("source_domain", F.lit("")), urls.domain_of(F.col("canonical_url"))))


def duplicates(rows: DataFrame, stored: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(mentions whose page isn't stored, the first of each page only; (id, original) of all others)."""
    first = Window.partitionBy("canonical_url")
    open_ = rows.where("outcome IS NULL").join(stored.groupBy("canonical_url").agg(F.min("id").alias("__old")), "canonical_url", "left")
    placed = open_.withColumn("original", F.coalesce("__old", F.min("id").over(first))).drop("__old")
    return placed.where("id = original").drop("original"), placed.where("id <> original").select("id", "original", "route", "query", "published_at", "summary", "source_name")


def attribute(rows: DataFrame, names: DataFrame, aliases: DataFrame, trusted: DataFrame | None = None) -> DataFrame:
    """(item_id, name_id, alias, where, confidence): names found in the text, else the one that the way of delivery tells.

    Search and page mentions only count for the names they were fetched for, if there are any. ``trusted`` is (query) of
    pages and feeds whose every mention belongs to their names.
    """
    limited = F.col("route").isin(*SEARCH_ROUTES, "page") & (F.size("name_ids") > 0)
    scope = rows.select(F.col("id").alias("item_id"), F.when(limited, F.col("name_ids")).alias("only"))
    matched = matching.match_aliases(rows, aliases).join(scope, "item_id").where(F.col("only").isNull() | F.array_contains("only", F.col("name_id"))).drop("only")
    silent = rows.join(matched.select(F.col("item_id").alias("id")).distinct(), "id", "left_anti")
    single = silent.where(F.col("route").isin(*SEARCH_ROUTES) & (F.size("name_ids") == 1)).select("id", F.get("name_ids", F.lit(0)).alias("name_id"))
    single = single.join(names.where("kind = 'comp'").select(F.col("id").alias("name_id")), "name_id", "left_anti")
    ways = single.select(F.col("id").alias("item_id"), "name_id", F.lit("(query)").alias("alias"), F.lit("none").alias("where"), F.lit(BY_QUERY).alias("confidence"))
    if trusted is not None:
        own = silent.where(F.col("route").isin("page", "rss")).join(trusted.select("query").distinct(), "query", "left_semi").select("id", "route", F.explode("name_ids").alias("name_id"))
        page = F.col("route") == "page"
        ways = ways.unionByName(own.select(F.col("id").alias("item_id"), "name_id", F.when(page, "(page)").otherwise("(feed)").alias("alias"), F.lit("none").alias("where"), F.when(page, BY_PAGE).otherwise(BY_FEED).alias("confidence")))
    return matched.unionByName(ways)


def curate(batch: DataFrame, stored: DataFrame, stored_matches: DataFrame, names: DataFrame, rules: DataFrame, lexicon: dict[str, str], lookback_hours: int = 72, resolved: DataFrame | None = None, trusted: DataFrame | None = None, hosts: list[str] | None = None) -> Pass:
    """One pass. ``stored`` is (id, canonical_url, title, title_key, summary, source_name, source_domain, published_at, at, status,
    also_routes), ``stored_matches`` (item_id, name_id), ``names`` (id, kind, watch, aliases), ``rules`` as in ``matching.screen``;
    ``at`` are seconds."""
    rows = cut(arrivals(batch, lookback_hours, resolved, hosts))
    new, known = duplicates(rows, stored)
    new = cut(new.withColumn("title_key", titles.title_key(F.col("title"), F.col("source_name"))).withColumn("at", F.unix_seconds("now")))
    matched = cut(attribute(new, names, matching.alias_table(names), trusted))
    main = matching.primary_name(matched).join(names.select(F.col("id").alias("name_id"), "kind", "watch"), "name_id")

    # screens, and the exception for what is watched
    reasons = matching.screen(new, rules).unionByName(new.limit(0).select("id", F.lit("").alias("reason")))
    by_title = matching.screen(new.withColumns({"source_domain": F.lit(""), "canonical_url": F.lit("")}), rules).select("id", F.lit(True).alias("bad_title"))
    categories, alert = matching.flag_categories(F.col("title"), F.col("summary"), lexicon)
    in_title, _ = matching.flag_categories(F.col("title"), F.lit(""), lexicon)
    judged = new.join(main.select(F.col("item_id").alias("id"), "name_id", "kind", "watch"), "id").join(reasons, "id", "left").join(by_title, "id", "left")
    kept = F.startswith("reason", F.lit("noise_domain")) & ((F.col("kind") != "comp") | F.col("watch")) & F.col("bad_title").isNull() & (F.col("watch") | (F.size(in_title) > 0))
    judged = judged.withColumn("kept", F.coalesce(kept, F.lit(False)))

    # the same headline before: from the same outlet it is not stored, from any after days it is screened
    heads = judged.select("title_key").distinct()
    before = stored.join(heads, "title_key", "left_semi").join(stored_matches.select(F.col("item_id").alias("id"), "name_id").distinct(), "id")
    columns = ["name_id", "id", "title_key", "source_domain", "source_name", "at"]
    fresh = judged.where("route <> 'page'").drop("name_id").join(matched.select(F.col("item_id").alias("id"), "name_id"), "id").select(*columns)
    again = clusters.served_again(before.select(*columns).unionByName(fresh)).join(new.select("id"), "id", "left_semi").select("id", F.lit(True).alias("again"))
    telling = judged.select("id", F.col("title_key").alias("key"), titles.tokens(F.col("title_key")).alias("toks"), "at")
    wanted = telling.select(F.explode("toks").alias("tok")).distinct()
    past = stored.select("id", F.col("title_key").alias("key"), titles.tokens(F.col("title_key")).alias("toks"), "at")
    past = past.join(past.select("id", F.explode("toks").alias("tok")).join(wanted, "tok", "left_semi").groupBy("id").count().where("count >= 4").select("id"), "id", "left_semi")
    old = clusters.republished(past.unionByName(telling)).join(stored.select(F.col("id").alias("first_id"), F.date_format(F.timestamp_seconds("at"), "yyyy-MM-dd").alias("day")), "first_id").select("id", "day")
    judged = judged.join(again, "id", "left").join(old, "id", "left")
    reason = F.when(F.col("day").isNotNull(), F.concat(F.lit("republished:"), "day")).when(F.col("kept"), F.concat(F.lit("kept:"), "reason", F.when(F.col("watch"), ":watched").otherwise(":category"))).otherwise(F.coalesce("reason", F.lit("")))
    outcome = F.when(F.col("again"), "served_again").when(F.col("day").isNotNull(), "screened").when(F.col("kept"), "kept").when(F.col("reason").isNotNull(), "screened").otherwise("candidate")
    judged = cut(judged.withColumn("screen_reason", reason).withColumn("outcome", outcome))
    kept_rows = judged.where("outcome <> 'served_again'")
    status = F.when(F.col("outcome") == "screened", "screened").otherwise("candidate")

    # stories: the newest similar item of the primary name within three days
    key = lambda rows_: rows_.select(F.col("name_id").alias("scope"), "id", F.col("title_key").alias("key"), titles.tokens(F.col("title_key")).alias("toks"), "at")
    since = new.agg((F.min("at") - 72 * 3600).alias("since"))
    recent = stored.join(F.broadcast(since)).where("at >= since").join(stored_matches.select(F.col("item_id").alias("id"), "name_id").distinct(), "id")
    every = kept_rows.drop("name_id").join(matched.select(F.col("item_id").alias("id"), "name_id"), "id")
    forest = clusters.pointers(key(recent).unionByName(key(every)), kept_rows.select("id", F.col("name_id").alias("scope")))
    items = kept_rows.join(forest, "id", "left").select(
        "id", "canonical_url", F.col("link").alias("raw_link"), "title", "title_key", "summary", "source_name", "source_domain", "published_at", "at", "lang", "route", "query",
        status.alias("status"), "screen_reason", categories.alias("alert_categories"), (alert & (F.col("outcome") == "candidate")).alias("alert_candidate"), F.coalesce("parent", "id").alias("story"),
    )
    unrelated = new.join(judged.select("id"), "id", "left_anti").select("id", F.lit("unrelated").alias("outcome"))
    ended = rows.where("outcome IS NOT NULL").select("id", "outcome").unionByName(known.select("id", F.lit("duplicate").alias("outcome"))).unionByName(unrelated).unionByName(judged.select("id", "outcome"))
    seen = known.select(F.col("original").alias("id"), F.concat_ws(":", "route", "query").alias("via"), "published_at", "summary", "source_name")
    updated = store.add_provenance(store.fill_only(stored, seen, "id", ["summary", "source_name"]), seen, "id")
    dated = seen.groupBy("id").agg(F.min("published_at").alias("__dated"))
    updated = updated.join(dated, "id", "left").withColumn("published_at", F.coalesce("published_at", "__dated")).drop("__dated")
    return Pass(ended, items, matched.join(kept_rows.select(F.col("id").alias("item_id")), "item_id", "left_semi"), updated)
