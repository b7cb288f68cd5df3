"""Problem 4, deduplicating new batches against all history: immutable suffix arrays per batch, merged logarithmically.

A record's text is the concatenation of its *grams*. For a title key these are the pairs of its rarest words, rare
ones first, a gapped form of two-word substrings: two keys of Jaccard similarity 0.6 share at least two words within
these prefixes (prefix filter with two common words), so every near-equal pair shares a gram, in whatever order and
with whatever words between. Contiguous substrings would lose keys whose words changed alternately or moved; the README
says how many. Keys of more than ``LONG`` words have single words as grams, as their pairs would grow with the square of
their length; keys near that size have both.

Grams are spread by hash over buckets. In a bucket the batches are taken in order of arrival: a batch's suffix array
is its grams in sorted order; its substrings are binary-searched in the arrays of all earlier segments and in its
own; then it joins the segments, of which any two of like size are merged. Nothing accepted before is read again but
by binary search. Matches that position and size show to be too short are dropped, the rest are summed per pair of
records (coverage) and verified exactly on the whole word sets.

Pairs of words of a limited vocabulary come back as a corpus grows, and their matches would grow with its square. Of two
matching records the smaller has the gram in its *short* prefix, so only these rows are matched with the others, and a
gram that more than ``CROWD`` records have there makes no pairs: its records are taken again with the gram made longer by
each next rare word, in rounds, until no gram is crowded. Two records that must share more words than the gram has share
one of the longer grams; those that need not are matched at once, as they are near-equal already. So a gram
makes at most ``CROWD`` matches a row, and they are made in slices of ``SLICE``, whatever the size of the corpus.

Exact copies of a key are one class and so are the items of a page, so copies never multiply the work; only the result
expands them. How rare a word is follows from the list of words that make up over 1/``HOT`` of all words, at most ``HOT``
words however large the corpus. Nulls: a null key or address has no grams; fewer than four distinct words make no key;
the same item delivered twice is one item; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import cut, table

SIMILARITY = 0.6
LEAST_WORDS = 4
#: A word is hot if it makes up more than 1 / HOT of all words.
HOT = 4_000
#: Distinct words from which a key has single words as grams.
LONG = 64
#: Rows of grams in a bucket, and in the batches of a bucket; sizes of work only.
BUCKET_GRAMS, BATCH_GRAMS = 250_000, 20_000
#: Records with a gram in the short prefix beyond which it is made longer, matches and rows made at once; sizes of work only.
CROWD, SLICE = 128, 200_000
IGNORED = ("fbclid", "gclid", "ref", "oc")


def page_key(url: Column) -> Column:
    """The page of an address without its irrelevant variations; null for null and blank."""
    u = F.regexp_replace(F.trim(url), r"#.*$", "")
    rest = F.regexp_replace(u, r"^(?i)[a-z][a-z0-9+.-]*://", "")
    host = F.regexp_replace(F.lower(F.regexp_extract(rest, r"^([^/?]*)", 1)), r"^(?:(?:www|m|amp)\.)+", "")
    path = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, r"^[^/?]*([^?]*)", 1), "/{2,}", "/"), r"(?:/amp|/index\.html|/)+$", "")
    params = F.filter(F.split(F.regexp_extract(rest, r"^[^?]*\?(.*)$", 1), "&"), lambda p: (p != "") & ~F.split(p, "=")[0].rlike(r"^utm_|^(?:" + "|".join(IGNORED) + ")$"))
    return F.when(F.length(host) > 0, F.concat(host, path, F.lit("?"), F.array_join(F.array_sort(params), "&")))


def _ends(n: int | np.ndarray, g: int | np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of the prefix and of the shorter prefix that hold the first ``g`` common words of a key of ``n`` words."""
    least = 2 * SIMILARITY / (1 + SIMILARITY)  # words in common of two keys of one size, as a share of it
    return np.minimum(n, n - np.ceil(SIMILARITY * n - 1e-9).astype(np.int64) + g), n - np.ceil(least * n - 1e-9).astype(np.int64) + g


@lru_cache(256)
def _prefix(n: int, g: int) -> tuple[np.ndarray, np.ndarray]:
    """(positions of the words of each gram of ``g`` words, whether it is within the shorter prefix) of a key of ``n`` words."""
    whole, short = _ends(n, g)
    at = np.array(list(combinations(range(int(whole)), g)), np.int64).reshape(-1, g)
    return at, at[:, -1] < short


def _sizes(n: int) -> tuple[int, ...]:
    """Words of the grams of a key of ``n`` words: two keys that can be near-equal have one size in common."""
    return (1,) if n > LONG else (2, 1) if n > SIMILARITY * LONG else (2,)


def _mix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One 64-bit gram of two 64-bit words in order."""
    x = a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) ^ (b.astype(np.uint64) + np.uint64(0x7F4A7C15))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _rare_first(words: np.ndarray, hot: dict[int, int]) -> np.ndarray:
    """Rows of words, the rarest first."""
    keys = np.array(sorted(hot), np.int64)
    df = np.zeros(words.shape, np.int64)
    if len(keys):
        counts = np.array([hot[k] for k in keys.tolist()], np.int64)
        where = np.minimum(np.searchsorted(keys, words), len(keys) - 1)
        df = np.where(keys[where] == words, counts[where], 0)
    return np.take_along_axis(words, np.lexsort((words, df), axis=1), axis=1)


def _by_size(lists: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(n, indices, words) of all lists of ``n`` words."""
    flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False))
    sizes = np.diff(np.concatenate([[0], ends]))
    for n in np.unique(sizes):
        at = np.flatnonzero(sizes == n)
        yield int(n), at, flat[(ends[at] - n)[:, None] + np.arange(n)]


_GRAM_SCHEMA = "bucket int, gram bigint, rec bigint, batch bigint, n int, j int, short boolean, g byte"


def _gram_rows(buckets: int, gram: np.ndarray, rec: np.ndarray, batch: np.ndarray, n: int, j: np.ndarray, short: np.ndarray, g: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array((gram % np.uint64(buckets)).astype(np.int32)), pa.array(gram.view(np.int64)), pa.array(rec), pa.array(batch), pa.array(np.full(len(gram), n, np.int32)), pa.array(j.astype(np.int32)), pa.array(short), pa.array(g.astype(np.int8))],
        names=["bucket", "gram", "rec", "batch", "n", "j", "short", "g"],
    )


def _grams(rows: DataFrame, hot: dict[int, int], buckets: int) -> DataFrame:
    """(bucket, gram, rec, batch, n, j, short, g) of (rec, batch, words): n words, j the last position of the gram, g its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rec, batch = (b.column(i).to_numpy(zero_copy_only=False) for i in range(2))
            for n, every, words in _by_size(b.column(2)):
                words = _rare_first(words, hot)
                for g in _sizes(n):
                    place, short = _prefix(n, g)
                    k = len(place)
                    for lo in range(0, len(every), step := max(1, SLICE // k)):
                        at, w = every[lo : lo + step], words[lo : lo + step]
                        gram = _mix(w[:, place[:, 0]], w[:, place[:, -1]] if g == 2 else np.full(1, g)).reshape(-1)
                        yield _gram_rows(buckets, gram, rec[np.repeat(at, k)], batch[np.repeat(at, k)], n, np.tile(place[:, -1], len(at)), np.tile(short, len(at)), np.full(len(gram), g))

    return rows.select("rec", "batch", "words").mapInArrow(run, _GRAM_SCHEMA)


def _longer(rows: DataFrame, hot: dict[int, int], buckets: int) -> DataFrame:
    """The grams of (rec, batch, words, gram, j, g) with one more of the words behind position j; columns as ``_grams`` has them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rec, batch, gram, j, g = (b.column(i).to_numpy(zero_copy_only=False) for i in (0, 1, 3, 4, 5))
            for n, every, words in _by_size(b.column(2)):
                words = _rare_first(words, hot)
                for lo in range(0, len(every), step := max(1, SLICE // n)):
                    at, w = every[lo : lo + step], words[lo : lo + step]
                    size = g[at].astype(np.int64) + 1
                    whole, short = _ends(n, size)
                    k = np.maximum(whole - 1 - j[at], 0)
                    row = np.repeat(np.arange(len(at)), k)
                    last = j[at][row] + 1 + np.arange(len(row)) - np.repeat(np.cumsum(k) - k, k)
                    yield _gram_rows(buckets, _mix(gram[at][row], w[row, last]), rec[at][row], batch[at][row], n, last, last < short[row], size[row])

    return rows.select("rec", "batch", "words", "gram", "j", "g").mapInArrow(run, _GRAM_SCHEMA)


class Segment:
    """An immutable sorted array of grams with the records they come from."""

    def __init__(self, gram: np.ndarray, rest: np.ndarray, ordered: bool = False):
        order = np.argsort(gram, kind="stable") if not ordered else slice(None)
        self.gram, self.rest = gram[order], rest[order]

    def merge(self, other: "Segment") -> "Segment":
        """The segment of both."""
        return Segment(np.concatenate([self.gram, other.gram]), np.concatenate([self.rest, other.rest]))

    def search(self, gram: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(index in ``gram``, index in this segment) of all equal grams, by binary search; about ``SLICE`` at a time."""
        left, right = np.searchsorted(self.gram, gram, "left"), np.searchsorted(self.gram, gram, "right")
        met = np.flatnonzero(right > left)
        left, n = left[met], (right - left)[met]
        ends, lo = np.cumsum(n), 0
        while lo < len(met):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] - n[lo] + SLICE, "right")))
            k = n[lo:hi]
            yield np.repeat(met[lo:hi], k), np.repeat(left[lo:hi], k) + (np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k))
            lo = hi


_REST = np.dtype([("rec", np.int64), ("n", np.int32), ("j", np.int32), ("short", bool), ("g", np.int8)])


def _least(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Words in common from which keys of ``n`` and ``m`` words are near-equal."""
    return np.ceil(SIMILARITY / (1 + SIMILARITY) * (n + m) - 1e-9)


def _possible(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether two records can be similar if this gram is made of the first words they share."""
    n, m = a["n"].astype(np.int64), b["n"].astype(np.int64)
    least = _least(n, m)
    room = a["g"] + np.minimum(n - 1 - a["j"], m - 1 - b["j"])
    smaller = np.where(n < m, a["short"], np.where(n > m, b["short"], a["short"] & b["short"]))
    return (a["rec"] != b["rec"]) & (a["g"] == b["g"]) & smaller & (room >= least) & (np.minimum(n, m) >= SIMILARITY * np.maximum(n, m) - 1e-9)


class _Found:
    """Pairs of records and how many matches each has, kept once."""

    def __init__(self):
        self.parts: list[np.ndarray] = []
        self.size = self.kept = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> None:
        self.parts.append(np.stack([np.minimum(a, b), np.maximum(a, b), np.ones(len(a), np.int64)]))
        self.size += len(a)
        if self.size > 2 * self.kept + SLICE:
            self.once()

    def once(self) -> np.ndarray:
        """Columns a, b, coverage."""
        x = np.concatenate(self.parts, axis=1) if self.parts else np.zeros((3, 0), np.int64)
        x = x[:, np.lexsort((x[1], x[0]))]
        first = np.flatnonzero(np.concatenate([[True], (np.diff(x[0]) != 0) | (np.diff(x[1]) != 0)])[: x.shape[1]])
        x = np.stack([x[0, first], x[1, first], np.add.reduceat(x[2], first)]) if len(first) else x
        self.parts, self.size, self.kept = [x], x.shape[1], x.shape[1]
        return x


def _match(gram: np.ndarray, rest: np.ndarray, batch: np.ndarray, found: _Found, done: bool = False) -> None:
    """Add the matches of all rows, in order of batches, to ``found``; if ``done``, only of those that need no longer gram."""
    # whole batches, as many as make up a fair amount of work
    edges = np.flatnonzero(np.diff(batch)) + 1
    cuts, last = [0], 0
    for e in edges.tolist():
        if e - last >= BATCH_GRAMS:
            cuts.append(e)
            last = e
    cuts.append(len(gram))
    segments: list[tuple[Segment, Segment]] = []
    for lo, hi in zip(cuts, cuts[1:]):
        short = rest["short"][lo:hi]
        new = near, far = Segment(gram[lo:hi][short], rest[lo:hi][short]), Segment(gram[lo:hi][~short], rest[lo:hi][~short])
        # the smaller of two records has the gram in its short prefix
        for mine, other in [x for s in segments for x in ((near, s[0]), (near, s[1]), (far, s[0]))] + [(near, near), (far, near)]:
            for x, y in other.search(mine.gram):
                if mine is other:
                    x, y = x[x < y], y[x < y]
                a, b = mine.rest[x], other.rest[y]
                ok = _possible(a, b)
                if done:
                    ok &= _least(a["n"].astype(np.int64), b["n"].astype(np.int64)) <= a["g"]
                found.add(a["rec"][ok], b["rec"][ok])
        segments.append(new)
        size = lambda s: len(s[0].gram) + len(s[1].gram)
        while len(segments) > 1 and size(segments[-2]) < 2 * size(segments[-1]):
            segments[-2:] = [tuple(a.merge(b) for a, b in zip(*segments[-2:]))]


def _replay(rows: pa.Table, crowd: int | None) -> pa.Table:
    """Pairs of ``replay``. With ``crowd``, grams that more records have in their short prefix are not matched where a longer
    one can tell; their rows come out as (rec, gram) with the position j and size g of the gram, which pairs have not."""
    gram = rows.column("gram").to_numpy().view(np.uint64)
    _, inverse, count = np.unique(gram, return_inverse=True, return_counts=True)
    near = np.bincount(inverse, rows.column("short").to_numpy(zero_copy_only=False), len(count))
    # a gram of one record or of no short prefix has no match
    at = np.flatnonzero((count > 1)[inverse] & (near > 0)[inverse])
    at = at[np.argsort(rows.column("batch").to_numpy()[at], kind="stable")]
    crowded = (near > crowd)[inverse[at]] if crowd is not None else np.zeros(len(at), bool)
    gram, batch = gram[at], rows.column("batch").to_numpy()[at]
    rest = np.empty(len(at), _REST)
    for name in _REST.names:
        rest[name] = rows.column(name).to_numpy(zero_copy_only=False)[at]
    found = _Found()
    _match(gram[~crowded], rest[~crowded], batch[~crowded], found)
    n, g = rest["n"].astype(np.int64), rest["g"]
    done = crowded & (_least(n, np.ceil(SIMILARITY * n - 1e-9)) <= g)
    _match(gram[done], rest[done], batch[done], found, done=True)
    again = crowded & (n > g)
    a, b, coverage = found.once()
    none = np.zeros(again.sum(), np.int64)
    pairs = pa.table({"a": a, "b": b, "coverage": coverage, "j": pa.nulls(len(a), pa.int32()), "g": pa.nulls(len(a), pa.int8())})
    longer = pa.table({"a": rest["rec"][again], "b": gram[again].view(np.int64), "coverage": none, "j": rest["j"][again], "g": g[again]})
    return pa.Table.from_batches([b for t in (pairs, longer) for b in t.to_batches(max_chunksize=SLICE)], pairs.schema)


def replay(rows: pa.Table) -> pa.Table:
    """All pairs of records with a common gram in one bucket, its batches taken in order against the segments before."""
    return _replay(rows, None)


def replay_uncrowded(rows: pa.Table) -> pa.Table:
    """As ``replay``, but of crowded grams the rows to be taken again with longer grams."""
    return _replay(rows, CROWD)


_PAIRS = "a bigint, b bigint, coverage bigint, j int, g byte"


def _words() -> Column:
    """Sorted hashes of the distinct words of the key; null for fewer than ``LEAST_WORDS``."""
    words = F.array_sort(F.transform(F.array_distinct(F.filter(F.split("title_key", " "), lambda w: w != "")), lambda w: F.xxhash64(w)))
    return F.when(F.size(words) >= LEAST_WORDS, words)


def _page() -> tuple[Column, Column, Column]:
    """(there is a page, two hashes of it)."""
    page = page_key(F.col("canonical_url"))
    return page.isNotNull(), F.xxhash64(page), F.xxhash64(page, F.lit("page"))


def _batch() -> Column:
    return F.coalesce("run_id", F.lit(0).cast("bigint"))


def _records(items: DataFrame) -> DataFrame:
    """(id, batch, page, words) of each item once: hashes of the page and of the distinct words, null where there is none."""
    there, p, q = _page()
    return items.where(F.col("id").isNotNull()).select("id", _batch().alias("batch"), F.when(there, F.array(p, q)).alias("page"), _words().alias("words")).dropDuplicates(["id"])


def _alike() -> Column:
    """Exact check of a candidate on the word hashes wa and wb of both records."""
    common = F.size(F.array_intersect("wa", "wb"))
    return common >= SIMILARITY * (F.size("wa") + F.size("wb") - common) - 1e-9


def near_pairs(items: DataFrame) -> DataFrame:
    """(id_a, id_b) of all items of the same page or with a near-equal key; ``items`` has id, canonical_url, title_key, run_id."""
    spark = items.sparkSession
    known = items.where(F.col("id").isNotNull())
    # one class per distinct set of words; its members share every similarity
    sets = known.select("id", _batch().alias("batch"), _words().alias("words")).where(F.col("words").isNotNull())
    classes = cut(sets.groupBy("words").agg(F.min("batch").alias("batch"), F.sort_array(F.collect_set("id")).alias("ids")).withColumn("rec", F.monotonically_increasing_id()))
    tokens = classes.select(F.explode("words").alias("w"))
    n_tokens, n_records = classes.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)), F.count(F.lit(1))).head()
    hot = {r[0]: r[1] for r in tokens.groupBy("w").count().where(F.col("count") > max(1, n_tokens // HOT)).collect()}
    matched = _matched(_grams, classes, hot, 20 * n_records)
    parts = [matched.where("j IS NULL")]
    longer = matched.where("j IS NOT NULL").select(F.col("a").alias("rec"), F.col("b").alias("gram"), "j", "g")
    if again := longer.count():  # only the records met in the first round can be in a later one
        met = cut(classes.select("rec", "batch", "words").join(longer.select("rec").distinct(), "rec", "left_semi"))
        while again:
            matched = _matched(_longer, met.join(longer, "rec"), hot, 4 * again)
            parts.append(matched.where("j IS NULL"))
            longer = matched.where("j IS NOT NULL").select(F.col("a").alias("rec"), F.col("b").alias("gram"), "j", "g")
            again = longer.count()
    candidates = reduce(DataFrame.unionByName, parts).groupBy("a", "b").agg(F.sum("coverage").alias("coverage"))
    both = candidates.join(classes.select(F.col("rec").alias("a"), F.col("words").alias("wa")), "a").join(classes.select(F.col("rec").alias("b"), F.col("words").alias("wb")), "b")
    verified = both.where(_alike()).select("a", "b")
    # the result expands classes, in joins that spread over the members and never gather a class in one task
    members = classes.select("rec", F.explode("ids").alias("id"))
    many = classes.where(F.size("ids") > 1).select(F.col("rec").alias("a"), F.col("rec").alias("b"))
    links = verified.unionByName(many)
    title_pairs = links.join(members.select(F.col("rec").alias("a"), F.col("id").alias("x")), "a").join(members.select(F.col("rec").alias("b"), F.col("id").alias("y")), "b")
    title_pairs = title_pairs.where((F.col("a") != F.col("b")) & (F.col("x") != F.col("y")) | (F.col("x") < F.col("y")))
    there, p, q = _page()
    paged = known.where(there).select(p.alias("p"), q.alias("q"), "id").repartition("p", "q").dropDuplicates(["p", "q", "id"])
    page_pairs = paged.withColumnRenamed("id", "x").join(paged.withColumnRenamed("id", "y"), ["p", "q"]).where("x < y")
    pairs = title_pairs.select("x", "y").unionByName(page_pairs.select("x", "y"))
    return pairs.select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b")).distinct()


def _matched(make: Callable[[DataFrame, dict[int, int], int], DataFrame], rows: DataFrame, hot: dict[int, int], about: int) -> DataFrame:
    """Pairs and rows to be taken again of the grams that ``make`` makes of ``rows``, ``about`` as many."""
    buckets = max(rows.sparkSession.sparkContext.defaultParallelism, about // BUCKET_GRAMS + 1)
    # the pairs of all buckets are read twice and small next to the grams
    return cut(make(rows, hot, buckets).repartition(buckets, "bucket").groupBy("bucket").applyInArrow(replay_uncrowded, _PAIRS))


_GRAM_COLUMNS = ["bucket", "gram", "rec", "batch", "n", "j", "short", "g"]


class HistoryIndex:
    """The persistent form: one immutable sorted segment of grams and records per batch, any two of like size merged into one.

    ``add`` compares a batch with everything accepted before and with itself, then accepts it. It reads the texts of
    the batch only; of the store it reads the index rows whose gram or page the batch has, and the hashes of the candidates.
    The order of rarity is that of the first batch and stays: any fixed order finds every pair, a stale one only makes
    more candidates. Items accepted before are ignored when they come again. Grams and records of a batch lie under one
    number and become part of the store by one step, the new list of segments; only numbers on that list are ever read,
    so a run that dies before that step has changed nothing and can be repeated.
    """

    def __init__(self, spark: SparkSession, folder: str, buckets: int = 64):
        self.spark, self.folder, self.buckets = spark, folder.rstrip("/"), buckets
        from presslens.sources.store import Store

        self.store = Store(spark, self.folder)

    def _segments(self) -> list[tuple[int, int]]:
        """(number, grams) of the live segments, oldest first."""
        live = self.store.read("segments")
        return sorted((r["no"], r["grams"]) for r in live.collect()) if live is not None else []

    def _read(self, what: str, live: list[tuple[int, int]]) -> DataFrame | None:
        """All live grams or records; Parquet skips the row groups that a filter or range on the sorted key excludes."""
        return self.spark.read.parquet(*(f"{self.folder}/{what}/{no}" for no, _ in live)) if live else None

    def add(self, items: DataFrame) -> DataFrame:
        """(id_a, id_b) of the new pairs of a batch; afterwards the batch is part of the history."""
        live = self._segments()
        batch = _records(items)
        known = self._read("records", live)
        if known is not None:
            lo, hi = batch.agg(F.min("id"), F.max("id")).head()
            batch = batch.join(known.where(F.col("id").between(F.lit(lo), F.lit(hi))).select("id"), "id", "left_anti")
        batch = cut(batch)
        titles = batch.where(F.col("words").isNotNull()).select(F.col("id").alias("rec"), "batch", "words")
        hot_rows = self.store.read("hot")
        if hot_rows is None:
            n = titles.agg(F.coalesce(F.sum(F.size("words")), F.lit(0))).head()[0]
            self.store.write("hot", titles.select(F.explode("words").alias("w")).groupBy("w").count().where(F.col("count") > max(1, n // HOT)))
            hot_rows = self.store.read("hot")
        grams = cut(_grams(titles, {r["w"]: r["count"] for r in hot_rows.collect()}, self.buckets))
        met, paged = grams, batch.where(F.col("page").isNotNull()).select("id", "page")
        everyone = batch.select("id", "page", "words") if known is None else known.select("id", "page", "words").unionByName(batch.select("id", "page", "words"))
        if live:
            met = met.unionByName(self._read("grams", live).join(grams.select("gram").distinct(), "gram", "left_semi").select(*_GRAM_COLUMNS))
        found = met.groupBy("bucket").applyInArrow(replay, _PAIRS).select("a", "b").distinct()
        new = batch.select("id")
        if live:  # pairs of two old records were reported when the later one came
            found = found.join(new.select(F.col("id").alias("a"), F.lit(True).alias("na")), "a", "left").join(new.select(F.col("id").alias("b"), F.lit(True).alias("nb")), "b", "left").where("na OR nb")
        payload = lambda end, own: everyone.select(F.col("id").alias(end), F.col("words").alias(f"w{own}"))
        near = found.join(payload("a", "a"), "a").join(payload("b", "b"), "b").where(_alike()).select("a", "b")
        others = everyone.where(F.col("page").isNotNull()).select(F.col("id").alias("other"), "page")
        same = paged.join(others, "page").where("id <> other").select(F.least("id", "other").alias("a"), F.greatest("id", "other").alias("b"))
        pairs = cut(near.unionByName(same).select(F.col("a").alias("id_a"), F.col("b").alias("id_b")).distinct())
        number = max([no for no, _ in live], default=0) + 1
        before = {no for no, _ in live}
        self._write(number, grams, batch)
        live.append((number, grams.count()))
        while len(live) > 1 and live[-2][1] < 2 * live[-1][1]:  # merging keeps the number of segments logarithmic
            (a, n), (b, m) = pair = live[-2:]
            self._write(b + 1, self._read("grams", pair), self._read("records", pair))
            live[-2:] = [(b + 1, n + m)]
        self.store.write("segments", self.spark.createDataFrame(live, "no long, grams long"))
        self._sweep(before | {no for no, _ in live})
        return pairs

    def _write(self, number: int, grams: DataFrame, records: DataFrame) -> None:
        grams.select(*_GRAM_COLUMNS).repartition("bucket").sortWithinPartitions("gram").write.mode("overwrite").parquet(f"{self.folder}/grams/{number}")
        records.select("id", "batch", "page", "words").repartitionByRange("id").sortWithinPartitions("id").write.mode("overwrite").parquet(f"{self.folder}/records/{number}")

    def _sweep(self, keep: set[int]) -> None:
        """Segments that neither the last list nor the one before has go."""
        for what in ("grams", "records"):
            root = self.store._path(f"{self.folder}/{what}")
            for s in self.store._fs.listStatus(root):
                if int(s.getPath().getName()) not in keep:
                    self.store._fs.delete(s.getPath(), True)


def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of items that tell the same story, over all runs."""
    return near_pairs(table(spark, sf_dir, "items").select("id", "canonical_url", "title_key", "run_id"))
