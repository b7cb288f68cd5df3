"""Matching of mentions to names, screening and flagging.

Aliases, screens and categories are small tables that come from configuration. Alias texts are found by their first
word: both sides are exploded to words and joined on them, so a mention meets only aliases that can match; the full
pattern is checked afterwards. No side is hinted: Spark broadcasts the aliases only while they are under its limit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Confidence of a match in the summary, relative to one in the title.
SUMMARY_WEIGHT = 0.7


def words(text: Column) -> Column:
    """Distinct lower-case words of a text."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != ""))


def alias_pattern(alias: Column) -> Column:
    """Pattern of an alias: whole words, any case, inner blanks also as hyphens."""
    quoted = F.regexp_replace(alias, r"([\\.\[\]{}()*+?^$|\-])", r"\\$1")
    return F.concat(F.lit(r"(?iU)(?<!\w)"), F.regexp_replace(quoted, r"\s+", r"[\\s\\-]+"), F.lit(r"(?!\w)"))


def alias_table(names: DataFrame) -> DataFrame:
    """(name_id, ord, alias, first, pattern, weight) of every alias, in the order of the configuration."""
    exploded = names.select(F.col("id").alias("name_id"), F.posexplode("aliases").alias("ord", "alias")).where(F.length(F.trim("alias")) > 0)
    return exploded.select("name_id", "ord", "alias", F.get(F.split(F.lower("alias"), r"[^\p{L}\p{N}]+"), F.lit(0)).alias("first"), alias_pattern(F.col("alias")).alias("pattern"), F.lit(1.0).alias("weight"))


def match_aliases(items: DataFrame, aliases: DataFrame) -> DataFrame:
    """Best match of each item and name: (item_id, name_id, alias, where, confidence); ties go to the earlier alias.

    A null title or summary matches nothing; an item delivered twice must be deduplicated before.
    """
    text = items.select(F.col("id").alias("item_id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("summary", F.lit("")).alias("summary"))
    tokens = text.select("item_id", "title", "summary", F.explode(words(F.concat_ws(" ", "title", "summary"))).alias("first"))
    met = tokens.join(aliases, "first")
    where = F.when(F.expr("title rlike pattern"), "title").when(F.expr("summary rlike pattern"), "summary")
    scored = met.withColumn("where", where).where(F.col("where").isNotNull()).withColumn("confidence", F.round(F.col("weight") * F.when(F.col("where") == "title", 1.0).otherwise(SUMMARY_WEIGHT), 3))
    best = Window.partitionBy("item_id", "name_id").orderBy(F.desc("confidence"), "ord")
    return scored.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("item_id", "name_id", "alias", "where", "confidence")


def primary_name(matched: DataFrame) -> DataFrame:
    """The name of highest confidence of each item, the first in name order on ties."""
    best = Window.partitionBy("item_id").orderBy(F.desc("confidence"), "name_id")
    return matched.withColumn("rank", F.row_number().over(best)).where("rank = 1").select("item_id", "name_id", "confidence")


def screen(items: DataFrame, rules: DataFrame) -> DataFrame:
    """First rule that hits each item, in the order of the rules: (id, reason).

    ``rules`` is (ordinal, kind, pattern): domain rules hit a domain and its subdomains, url rules a part of the
    address, title rules a pattern in the headline. Only domain rules are joined by key; the few others by pattern.
    """
    suffixes = F.transform(F.sequence(F.lit(1), F.size(F.split("source_domain", r"\."))), lambda i: F.array_join(F.slice(F.split("source_domain", r"\."), i, F.size(F.split("source_domain", r"\."))), "."))
    by_domain = items.select("id", F.explode(suffixes).alias("pattern")).join(rules.where("kind = 'domain'"), "pattern").select("id", "ordinal", F.concat_ws(":", F.lit("noise_domain"), "pattern").alias("reason"))
    by_text = items.join(rules.where("kind <> 'domain'"), F.expr("(kind = 'url' AND contains(canonical_url, pattern)) OR (kind = 'title' AND title rlike pattern)")).select("id", "ordinal", F.concat(F.lit("noise_"), "kind", F.lit(":"), "pattern").alias("reason"))
    return by_domain.unionByName(by_text).groupBy("id").agg(F.min_by("reason", F.struct("ordinal", "reason")).alias("reason"))


def flag_categories(title: Column, summary: Column, lexicon: dict[str, str]) -> tuple[Column, Column]:
    """(categories in lexicon order, whether they make an alert): any in the title, or two found only in the summary."""
    t, s = F.coalesce(title, F.lit("")), F.coalesce(summary, F.lit(""))
    title_hits = F.array_compact(F.array(*(F.when(t.rlike(p), F.lit(c)) for c, p in lexicon.items())))
    all_hits = F.array_compact(F.array(*(F.when(t.rlike(p) | s.rlike(p), F.lit(c)) for c, p in lexicon.items())))
    return all_hits, (F.size(title_hits) > 0) | (F.size(F.array_except(all_hits, title_hits)) >= 2)
