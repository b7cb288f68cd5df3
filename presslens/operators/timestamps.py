"""Problem 6, mixed timestamp formats and time zones: the normalising operator over whole tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.functions.times import is_canonical, utc_micros
from presslens.session import table


def with_utc(rows: DataFrame, markets: DataFrame, fields: list[str], place: str, market_key: str) -> DataFrame:
    """Add ``<field>_us`` (instant in microseconds, null if unreadable) for each time field.

    ``place`` is the column that names the country, ``market_key`` the column of ``markets`` it refers to. The zone
    table is joined on its key without a hint: it is broadcast only while its size is under the session's limit.
    A null or unknown country means UTC; a country that ``markets`` holds twice takes its smallest zone. Extra
    columns of either table do no harm: only the key, the code and the zone of ``markets`` are used, renamed first.
    """
    zones = markets.where(F.col(market_key).isNotNull()).groupBy(F.col(market_key).alias("__place")).agg(F.min("tz").alias("__tz"), F.min("country").alias("__cc"))
    joined = rows.join(zones, rows[place] == F.col("__place"), "left")
    american: Column = F.col("__cc") == "US"
    return joined.select(*rows.columns, *(utc_micros(F.col(f), F.col("__tz"), american).alias(f"{f}_us") for f in fields))


def items_utc(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Distinct items with ``published_at_us`` and ``first_seen_at_us``; an item delivered twice comes out once."""
    need = list(dict.fromkeys(["id", "published_at", "first_seen_at", "country", *columns]))
    return with_utc(table(spark, sf_dir, "items").select(*need), table(spark, sf_dir, "markets"), ["published_at", "first_seen_at"], "country", "country").dropDuplicates(["id"])


def nonstandard_times(rows: DataFrame, src: str, key: str, fields: list[str]) -> DataFrame:
    """(src, row_id, field, utc_us) of readable values that are not in the normal form; distinct."""
    pairs = F.array(*(F.struct(F.lit(f).alias("field"), F.when(~is_canonical(F.col(f)), F.col(f"{f}_us")).alias("utc_us")) for f in fields))
    return (
        rows.select(F.lit(src).alias("src"), F.col(key).alias("row_id"), F.explode(pairs).alias("x"))
        .where(F.col("x.utc_us").isNotNull())
        .select("src", "row_id", "x.field", "x.utc_us")
        .distinct()
    )


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readable, not yet normal values of items and gdelt with their instants."""
    markets = table(spark, sf_dir, "markets")
    items = table(spark, sf_dir, "items").select("id", "published_at", "first_seen_at", "country")
    gdelt = table(spark, sf_dir, "gdelt").select("gdelt_id", "seendate", "sourcecountry")
    a = nonstandard_times(with_utc(items, markets, ["published_at", "first_seen_at"], "country", "country"), "items", "id", ["published_at", "first_seen_at"])
    b = nonstandard_times(with_utc(gdelt, markets, ["seendate"], "sourcecountry", "country_name"), "gdelt", "gdelt_id", ["seendate"])
    return a.unionByName(b)


def p6_notations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per table, field and shape of the notation (digits as 9): number of values and how many were readable."""
    markets = table(spark, sf_dir, "markets")
    parts = []
    for name, key, place, market_key, fields in (("items", "id", "country", "country", ["published_at", "first_seen_at"]), ("gdelt", "gdelt_id", "sourcecountry", "country_name", ["seendate"])):
        rows = with_utc(table(spark, sf_dir, name).select(key, place, *fields), markets, fields, place, market_key)
        cells = F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("value"), F.col(f"{f}_us").alias("us")) for f in fields))
        parts.append(rows.select(F.lit(name).alias("src"), F.explode(cells).alias("x")).select("src", "x.*"))
    shape = F.regexp_replace(F.col("value"), r"\d", "9")
    return parts[0].unionByName(parts[1]).groupBy("src", "field", shape.alias("shape")).agg(F.count(F.lit(1)).alias("n_values"), F.count("us").alias("n_readable"))
