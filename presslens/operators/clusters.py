"""Stories: copies served again, republished headlines, and clusters as roots of a pointer forest.

Similar headlines are found by prefix filtering on rare tokens, never by pairing all items of a name. Each item points
to the most recent earlier similar item of its scope; its cluster is the root it reaches. Pointer jumping resolves
chains of any length in logarithmically many joins; each round cuts its lineage into the shared checkpoint folder.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from presslens.functions.titles import LEAST_TOKENS, SIMILARITY
from presslens.session import cut


def similar_pairs(keyed: DataFrame, threshold: float = SIMILARITY, least: int = LEAST_TOKENS) -> DataFrame:
    """(scope, a, b) with a < b of rows (scope, id, key, toks) whose keys are equal or whose tokens are near-equal.

    Equal token sets are joined by the set, near-equal ones by the tokens of their prefixes in order of rarity. The
    document frequencies are joined back, not collected.
    """
    rows = keyed.select("scope", "id", "key", "toks")
    rare = rows.select("scope", "id", F.explode("toks").alias("tok"))
    df = rare.groupBy("scope", "tok").count()
    ordered = rare.join(df, ["scope", "tok"]).groupBy("scope", "id").agg(F.transform(F.array_sort(F.collect_list(F.struct("count", "tok"))), lambda x: x["tok"]).alias("order"))
    sized = rows.join(ordered, ["scope", "id"], "left").withColumn("n", F.size("toks")).where((F.col("n") >= least) | (F.length("key") > 0))
    prefix = F.slice("order", 1, F.greatest(F.lit(1), (F.col("n") - F.ceil(F.lit(threshold) * F.col("n")) + 1).cast("int")))
    entry = sized.where(F.col("n") >= least).select("scope", "id", "toks", "n", F.explode(prefix).alias("tok"))
    a, b = (entry.select("scope", "tok", *(F.col(c).alias(f"{c}_{s}") for c in ("id", "toks", "n"))) for s in "ab")
    met = a.join(b, ["scope", "tok"]).where((F.col("id_a") < F.col("id_b")) & (F.col("n_a") >= threshold * F.col("n_b")) & (F.col("n_b") >= threshold * F.col("n_a")))
    near = met.where(F.size(F.array_intersect("toks_a", "toks_b")) >= threshold * F.size(F.array_union("toks_a", "toks_b"))).select("scope", F.col("id_a").alias("a"), F.col("id_b").alias("b"))
    # copies of one key are chained in order of id: the latest earlier one is all that a pointer needs
    return near.distinct()


def pointers(keyed: DataFrame, primary: DataFrame, within: int = 72 * 3600, newest: int = 1_999, threshold: float = SIMILARITY, least: int = LEAST_TOKENS) -> DataFrame:
    """(id, parent): the most recent earlier similar item among those matched to the item's primary name, or null.

    ``keyed`` is (scope, id, key, toks, at) with a row for every name an item is matched to, ``primary`` is (id, scope).
    Only items at most ``within`` seconds older and among the ``newest`` before it count.
    """
    placed = keyed.withColumn("place", F.row_number().over(Window.partitionBy("scope").orderBy("id")))
    where = placed.select("scope", "id", "at", "place")
    same = placed.where(F.length("key") > 0).select("scope", F.lag("id").over(Window.partitionBy("scope", "key").orderBy("id")).alias("a"), F.col("id").alias("b")).where(F.col("a").isNotNull())
    pairs = same.unionByName(similar_pairs(keyed, threshold, least)).join(primary.select(F.col("id").alias("b"), "scope"), ["b", "scope"])
    old, new = where.select("scope", F.col("id").alias("a"), F.col("at").alias("at_a"), F.col("place").alias("place_a")), where.select("scope", F.col("id").alias("b"), F.col("at").alias("at_b"), F.col("place").alias("place_b"))
    near = pairs.join(old, ["scope", "a"]).join(new, ["scope", "b"]).where((F.col("at_b") - F.col("at_a") <= within) & (F.col("place_b") - F.col("place_a") <= newest))
    best = near.groupBy(F.col("b").alias("id")).agg(F.max("a").alias("parent"))
    return primary.select("id").join(best, "id", "left")


def roots(forest: DataFrame) -> DataFrame:
    """(id, cluster): the root that each row's pointers lead to."""
    state = cut(forest.select("id", F.coalesce("parent", "id").alias("up")))
    n = max(2, state.count())
    for _ in range(math.ceil(math.log2(n)) + 1):
        up = state.select(F.col("id").alias("up"), F.col("up").alias("further"))
        new = cut(state.join(up, "up").select("id", F.col("further").alias("new"), (F.col("further") != F.col("up")).alias("moved")))
        moved = new.where("moved").limit(1).count()
        state = new.select("id", F.col("new").alias("up"))
        if not moved:
            break
    return state.select("id", F.col("up").alias("cluster"))


def served_again(rows: DataFrame) -> DataFrame:
    """(id, original): later copies of a headline by the same outlet for the same name, with the newest original.

    ``rows`` is (name_id, id, title_key, source_domain, source_name, at): a copy comes at least an hour later.
    """
    keyed = rows.where((F.length("title_key") > 0) & F.col("at").isNotNull())
    # any earlier row of the group an hour before: the range frame ends there, so no pairs are made
    parts = []
    for outlet in ("source_domain", "source_name"):
        w = Window.partitionBy("name_id", "title_key", outlet).orderBy("at").rangeBetween(Window.unboundedPreceding, -3600)
        parts.append(keyed.where(F.length(outlet) > 0).select("id", F.max("id").over(w).alias("original")))
    return parts[0].unionByName(parts[1]).where(F.col("original").isNotNull()).groupBy("id").agg(F.max("original").alias("original"))


def republished(items: DataFrame, threshold: float = 0.85, least: int = 5, youngest: int = 72 * 3600, oldest: int = 150 * 86400) -> DataFrame:
    """(id, first_id): items whose headline, with the same numbers, was first seen 72 hours to 150 days before.

    ``items`` is (id, key, toks, at). The numbers of the key are the scope of the search for similar keys.
    """
    keyed = items.where(F.size("toks") >= least).select(F.array_join(F.array_sort(F.array_distinct(F.regexp_extract_all("key", F.lit(r"(\d+)"), 1))), ",").alias("scope"), "id", "key", "toks")
    pairs = similar_pairs(keyed, threshold, least)
    at = items.select("id", "at")
    timed = pairs.join(at.select(F.col("id").alias("a"), F.col("at").alias("at_a")), "a").join(at.select(F.col("id").alias("b"), F.col("at").alias("at_b")), "b")
    both = timed.select(F.when(F.col("at_a") <= F.col("at_b"), F.struct("a", "b")).otherwise(F.struct(F.col("b").alias("a"), F.col("a").alias("b"))).alias("p"), F.abs(F.col("at_b") - F.col("at_a")).alias("gap"), F.least("at_a", "at_b").alias("at"))
    return both.where(F.col("gap").between(youngest, oldest)).groupBy(F.col("p.b").alias("id")).agg(F.min_by("p.a", F.struct("at", "p.a")).alias("first_id"))
