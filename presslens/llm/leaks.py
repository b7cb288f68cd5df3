"""Problem 9, evaluation texts that leak into training text: CGK embedding and bit-sampling LSH over word windows.

Windows of test items and of documents are embedded by a CGK random walk: at each step the current word is written out
and the walk moves on or stays by a random bit of (step, word). Windows at a small edit distance stay synchronised and
so come out at a small Hamming distance. Each repetition draws its own walk and samples ``BITS`` positions of the output
as a key; equal keys make a candidate, which an exact edit distance in words then accepts or refuses. Repetitions follow
from the target recall and the edits allowed; windows that are equal word for word agree in every key.

There are two kinds of windows. *Passages* are all runs of ``WINDOW`` words of an item, the smallest leak that counts;
one edit is let through and ``p9_found`` takes the verified pairs whose 13 words are all equal. *Items* are whole items:
the windows over a document have the size of the item, and one edit for each ``WORDS_PER_EDIT`` words is let through (a
word left out or put in shifts the window's end and so counts twice); ``p9_altered`` reports these. A word is a longest run of letters and digits, case ignored.

A document's window is embedded only if all but the edits allowed are words of some item, and goes on only if one of its
keys is one of an item. Both are bitmaps of at most ``BITMAP`` bits, whatever the number of items: with more items they
let more through, and the exact steps behind them decide. Words that no item has are one symbol, so windows that differ
in them only are one window. Distinct windows and the documents that hold them are joined by key and by window in Spark;
neither items nor documents are collected, and texts are read once.

Null, empty and short texts have no window and give no row; items of fewer than 13 words give none either. Repeated rows
give one row.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import cut, table

WINDOW = 13
BITS = 5
#: Words of an item for each edit allowed when whole items are searched for.
WORDS_PER_EDIT = 13
TARGET_RECALL = 0.95
#: Share of keys that agree at the largest distance searched for, whatever the size of the window (measured by
#: tests/llm/test_leaks.py: 0.39 to 0.66 for windows of 13 to 108 words with 1 to 4 words changed, left out or put in).
KEYS_AGREE = 0.38
#: Largest size of a bitmap, 16 MB; smaller for few items.
BITMAP = 1 << 27
BLOCK_CHARS = 4_000_000
MEMO_WORDS = 400_000

_WORD = re.compile(r"[^\W_]+")
_ONE = np.uint64(1)
_UNKNOWN = 1


def words_of(text: str | None) -> list[str]:
    """Longest runs of letters and digits, without case."""
    return _WORD.findall(text.lower()) if text else []


def symbol_of(word: str) -> int:
    """64-bit symbol of a word."""
    return xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")) | 2


def allowed(size: int) -> int:
    """Edits allowed in a window of this many words."""
    return max(1, size // WORDS_PER_EDIT)


def repetitions(target_recall: float = TARGET_RECALL) -> int:
    """Repetitions that reach the target recall for windows at the largest distance searched for."""
    return math.ceil(math.log(1 - target_recall) / math.log(1 - KEYS_AGREE))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _walk(size: int, repetition: int) -> tuple[np.ndarray, set[int]]:
    """(salts of the walk's bits, 64 steps each, and of the key; sampled steps) from a fixed seed."""
    rng = np.random.default_rng([7, size, repetition])
    salts = rng.integers(1, 2**63, size=2 + 2 * size // 64, dtype=np.uint64)
    return salts, set(rng.choice(2 * size, size=BITS, replace=False).tolist())


def walk_keys(symbols: np.ndarray, starts: np.ndarray, size: int, target_recall: float = TARGET_RECALL) -> np.ndarray:
    """Keys (windows x repetitions) of the windows of ``size`` symbols from ``starts`` on."""
    used = np.zeros(len(symbols) + 1, np.int64)
    np.add.at(used, starts, 1)
    np.add.at(used, starts + size, -1)
    inside = np.cumsum(used)[:-1] > 0  # only words in a window are ever looked at
    text = np.concatenate([symbols[inside], np.zeros(1, np.uint64)])
    first, pad = (np.cumsum(inside) - 1)[starts], len(text) - 1
    out = np.empty((len(starts), repetitions(target_recall)), np.uint64)
    for r in range(out.shape[1]):
        salts, sampled = _walk(size, r)
        at, key, bits = np.zeros(len(starts), np.int64), np.full(len(starts), salts[-1], np.uint64), None
        for step in range(max(sampled) + 1):
            if step % 64 == 0:
                bits = _mix(text ^ salts[step // 64])
            place = np.where(at < size, first + at, pad)
            if step in sampled:
                key = _mix(key ^ text[place])
            at = np.minimum(at + ((bits[place] >> np.uint64(step % 64)) & _ONE).astype(np.int64), size)
        out[:, r] = key
    return out


def edit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Edit distance in words of each row of ``a`` to the same row of ``b``."""
    n, w = a.shape
    # along the diagonals of the table, all cells of which follow from the two before; cell i of diagonal d is (i, d - i)
    far = np.int32(2 * w)
    before, last = np.full((n, w + 1), far, np.int32), np.full((n, w + 1), far, np.int32)
    last[:, 0] = 0
    for d in range(1, 2 * w + 1):
        lo, hi = max(0, d - w), min(d, w)
        now = np.full((n, w + 1), far, np.int32)
        i = np.arange(max(1, lo), min(hi, d - 1) + 1)
        now[:, i] = np.minimum(np.minimum(last[:, i - 1], last[:, i]) + 1, before[:, i - 1] + (a[:, i - 1] != b[:, d - i - 1]))
        if lo == 0:
            now[:, 0] = d
        if hi == d:
            now[:, d] = d
        before, last = last, now
    return last[:, w].astype(np.int64)


class Bitmap:
    """A set of 64-bit values as one bit each of at most ``BITMAP``; says yes to every member."""

    def __init__(self, values: DataFrame, column: str, n: int):
        self.bits = min(BITMAP, 1 << max(20, 8 + int(n).bit_length()))
        slot = (F.col(column).bitwiseAND(F.lit(self.bits - 1)) + 1).alias("s")
        parts = values.select(slot).groupBy(F.bitmap_bucket_number("s").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("s")).alias("m")).collect()
        self.map = np.zeros(self.bits // 8, np.uint8)
        for p in parts:  # at most BITMAP / 32768 rows of 4 KB
            at = (p["b"] - 1) * 4096
            self.map[at : at + 4096] = np.frombuffer(bytes(p["m"]), np.uint8)[: len(self.map) - at]

    def holds(self, values: np.ndarray) -> np.ndarray:
        """Whether each value may be a member."""
        slot = values & np.uint64(self.bits - 1)
        return (self.map[(slot >> np.uint64(3)).astype(np.int64)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1

    def has(self, value: int) -> bool:
        """Whether one value may be a member."""
        slot = value & (self.bits - 1)
        return bool(self.map[slot >> 3] >> (slot & 7) & 1)


class _Memo(dict):
    """Symbols of the words met, one for all that no item has."""

    def __init__(self, known: Bitmap):
        self.known = known

    def __missing__(self, word: str) -> int:
        s = symbol_of(word)
        self[word] = s = s if self.known.has(s) else _UNKNOWN
        return s


def _longs(rows: np.ndarray) -> pa.Array:
    n, w = rows.shape
    return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * w, pa.int32()), pa.array(rows.reshape(-1).view(np.int64)))


def item_windows(items: DataFrame, whole: bool) -> DataFrame:
    """(eval_id, size, words, keys) of the passages, or of the whole, of every item."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                symbols = np.array([symbol_of(w) for w in words_of(text)], np.uint64)
                size = len(symbols) if whole else WINDOW
                if len(symbols) >= WINDOW:
                    starts = np.arange(len(symbols) - size + 1)
                    n = len(starts)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(n, key)), pa.array(np.full(n, size, np.int32)), _longs(symbols[starts[:, None] + np.arange(size)]), _longs(walk_keys(symbols, starts, size))], names=["eval_id", "size", "words", "keys"])

    return items.select("eval_id", "text").where(F.col("eval_id").isNotNull() & F.col("text").isNotNull()).mapInArrow(run, "eval_id bigint, size int, words array<bigint>, keys array<bigint>")


class Searcher:
    """Windows of documents that share a key with an item."""

    def __init__(self, sizes: list[int], words: Bitmap, keys: Bitmap):
        self.sizes, self.words, self.keys, self.memo = sizes, words, keys, _Memo(words)

    def search(self, texts: list[str | None]) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per size (size, index of text, which window, and of each window its hash, words and keys) of all windows that go on."""
        if len(self.memo) > MEMO_WORDS:  # a memory bound
            self.memo = _Memo(self.words)
        per_text = [words_of(t) for t in texts]
        counts = np.array([len(w) for w in per_text], np.int64)
        total = int(counts.sum())
        look = self.memo.__getitem__
        symbols = np.fromiter((look(x) for words in per_text for x in words), np.uint64, count=total)
        text_of = np.repeat(np.arange(len(texts)), counts)
        unknown = np.concatenate([[0], np.cumsum(symbols == _UNKNOWN)])
        for size in self.sizes:
            if total < size:
                continue
            starts = np.flatnonzero((unknown[size:] - unknown[:-size] <= allowed(size)) & (text_of[size - 1 :] == text_of[: total - size + 1]))
            for lo in range(0, len(starts), 100_000):
                part = starts[lo : lo + 100_000]
                words = symbols[part[:, None] + np.arange(size)]
                name = np.full(len(part), size, np.uint64)
                for j in range(size):
                    name = _mix(name ^ words[:, j])
                # equal windows have equal keys: each is embedded once
                name, at, back = np.unique(name, return_index=True, return_inverse=True)
                keys = walk_keys(symbols, part[at], size)
                hit = self.keys.holds(keys.reshape(-1)).reshape(keys.shape).any(axis=1)
                kept = hit[back]
                renumber = np.cumsum(hit) - 1
                yield size, text_of[part[kept]], renumber[back[kept]], name[hit], words[at[hit]], keys[hit]


_FOUND = "doc_id bigint, name bigint, size int, words array<bigint>, keys array<bigint>"


def document_windows(documents: DataFrame, searcher_parts: tuple[list[int], Bitmap, Bitmap]) -> DataFrame:
    """Rows of two kinds: (doc_id, name) of every document and window that goes on, and, once a block, the window itself."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searcher = Searcher(*searcher_parts)
        for batch in batches:
            keys, texts = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_pylist()
            lo = 0
            while lo < len(texts):
                hi, chars = lo, 0
                while hi < len(texts) and chars < BLOCK_CHARS:
                    chars += len(texts[hi] or "")
                    hi += 1
                for size, text, which, name, words, walked in searcher.search(texts[lo:hi]):
                    both = np.unique(np.stack([text, which], axis=1), axis=0)
                    if len(both):
                        n, m = len(both), len(name)
                        yield pa.RecordBatch.from_arrays([pa.array(keys[lo + both[:, 0]]), pa.array(name[both[:, 1]].view(np.int64)), pa.nulls(n, pa.int32()), pa.nulls(n, pa.list_(pa.int64())), pa.nulls(n, pa.list_(pa.int64()))], names=["doc_id", "name", "size", "words", "keys"])
                        yield pa.RecordBatch.from_arrays([pa.nulls(m, pa.int64()), pa.array(name.view(np.int64)), pa.array(np.full(m, size, np.int32)), _longs(words), _longs(walked)], names=["doc_id", "name", "size", "words", "keys"])
                lo = hi

    return documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull()).mapInArrow(run, _FOUND)


def _verify(pairs: DataFrame) -> DataFrame:
    """(name, eval_id, n_edits) of candidates (name, eval_id, a, b) within the edits allowed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch.column(2).value_lengths().to_numpy(zero_copy_only=False)
            for n in np.unique(size):
                at = np.flatnonzero(size == n)
                part = batch.take(pa.array(at))
                a, b = (part.column(k).flatten().to_numpy(zero_copy_only=False).reshape(-1, n) for k in (2, 3))
                distance = edit_distances(a, b)
                good = pa.array(np.flatnonzero(distance <= allowed(int(n))))
                yield pa.RecordBatch.from_arrays([part.column(0).take(good), part.column(1).take(good), pa.array(distance).take(good)], names=["name", "eval_id", "n_edits"])

    return pairs.select("name", "eval_id", "a", "b").mapInArrow(run, "name bigint, eval_id bigint, n_edits bigint")


def find_leaks(documents: DataFrame, items: DataFrame, whole: bool = False, most_edits: int | None = None) -> DataFrame:
    """(doc_id, eval_id, n_edits): the closest pair of windows of each document and test item, within the edits allowed.

    ``whole`` searches for whole items, else for passages; ``most_edits`` keeps only verified pairs of so few edits."""
    targets = cut(item_windows(items, whole))
    sizes = sorted(r[0] for r in targets.select("size").distinct().collect())  # word counts of items
    n_words, n_keys = targets.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.sum(F.size("keys")), F.lit(0))).head()
    words, keys = Bitmap(targets.select(F.explode("words").alias("x")), "x", n_words), Bitmap(targets.select(F.explode("keys").alias("x")), "x", n_keys)
    met = cut(document_windows(documents, (sizes, words, keys)))
    windows = met.where("keys IS NOT NULL").groupBy("name").agg(F.any_value("size").alias("size"), F.any_value("words").alias("a"), F.any_value("keys").alias("keys"))
    # copies of an item's window are one target
    distinct = targets.groupBy("words").agg(F.any_value("size").alias("size"), F.any_value("keys").alias("keys"), F.min(F.xxhash64("words")).alias("target"))
    left, right = windows.select("name", "size", F.explode("keys").alias("key")), distinct.select("target", "size", F.explode("keys").alias("key"))
    pairs = left.join(right, ["key", "size"]).select("name", "target").distinct()
    full = pairs.join(windows.select("name", "a"), "name").join(distinct.select("target", F.col("words").alias("b")), "target")
    close = _verify(full.select("name", F.col("target").alias("eval_id"), "a", "b")).withColumnRenamed("eval_id", "target")
    if most_edits is not None:
        close = close.where(F.col("n_edits") <= most_edits)
    owners = targets.select(F.xxhash64("words").alias("target"), "eval_id").distinct()
    near = close.join(owners, "target").groupBy("name", "eval_id").agg(F.min("n_edits").alias("n_edits"))
    return met.where("keys IS NULL").select("doc_id", "name").join(near, "name").groupBy("doc_id", "eval_id").agg(F.min("n_edits").alias("n_edits"))


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold at least 13 consecutive words of a test item, with the item."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), most_edits=0).select("doc_id", "eval_id")


def p9_altered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a whole test item, word for word or altered, with the number of words changed."""
    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "eval_items"), whole=True)
