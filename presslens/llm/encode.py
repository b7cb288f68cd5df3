"""Problem 8, encoding of the whole corpus with a public byte-level BPE vocabulary by merge replay.

The distinct words of a block of documents are laid out as byte symbols in one array. An inverted index holds, for
every merge rule, the positions at which its pair stands. Rules are then applied in rank order: each merge touches
only its two neighbours, whose new pairs enter the index under their own, always later, rule. Words are remembered
between the blocks of a worker, so a word is merged once per worker and not once per document, and no shuffle is
needed: the operator is one pass over the scan at any corpus size.

Results: the empty list for empty and for null text; text that looks like a special token is plain text; texts of
any length are encoded whole; repeated rows are encoded each. Extra columns are not read.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from presslens.session import table

#: Words that a worker remembers before it starts afresh, and characters of text taken at once: memory bounds only.
MEMO_WORDS = 400_000
BLOCK_CHARS = 2_000_000


@lru_cache(1)
def _splitters() -> tuple[frozenset[str], re.Pattern, re.Pattern]:
    """(characters that need the exact pattern, quick pattern, exact pattern).

    In the standard library \\w also holds the non-decimal numbers and \\s some controls. The exact pattern excludes
    them, which makes its character sets slow; the quick one is the same for texts without any of them.
    """
    odd = "".join(c for c in map(chr, range(sys.maxunicode + 1)) if unicodedata.category(c) in ("No", "Nl"))
    quick = re.compile(r"'(?:[stmd]|re|ve|ll)| ?[^\W\d_]+| ?\d+| ?(?:[^\s\w]|_)+|\s+(?!\S)|\s+")
    space, black = r"[^\S\x1c-\x1f]", r"[\S\x1c-\x1f]"
    exact = re.compile(rf"'(?:[stmd]|re|ve|ll)| ?[^\W\d_{odd}]+| ?[\d{odd}]+| ?(?:[^\s\w]|[_\x1c-\x1f])+|{space}+(?!{black})|{space}+")
    return frozenset(odd + "\x1c\x1d\x1e\x1f"), quick, exact


def split_words(text: str) -> list[str]:
    """The vocabulary's words of a text, in order; together they are the text."""
    odd, quick, exact = _splitters()
    return (quick if odd.isdisjoint(text) else exact).findall(text)


@lru_cache(2)
def _rules(path: str) -> tuple[dict[int, int], list[tuple[int, int, int]], list[int]]:
    """Pair to rank, the rules as (left, right, merged) by rank, and the id of each byte."""
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    vocab = model["vocab"]
    rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"])]
    # The vocabulary writes bytes as printable characters: those that are printable as themselves, the rest from 256 on.
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    byte_ids = [vocab[chr(b if b in printable else next(rest))] for b in range(256)]
    return {(a << 20) | b: r for r, (a, b, _) in enumerate(rules)}, rules, byte_ids


class MergeReplay:
    """Encodes sets of distinct words by replaying all merges over an inverted index from pair to positions."""

    def __init__(self, path: str):
        self.rank_of, self.rules, self.byte_ids = _rules(path)
        self.memo: dict[str, list[int]] = {}

    def learn(self, words: list[str]) -> None:
        """Encode the words into the memo."""
        raw = [w.encode("utf-8", "surrogatepass") for w in words]
        starts = np.cumsum([0, *(len(b) + 1 for b in raw)]).tolist()
        symbols = np.array([*self.byte_ids, -1], dtype=np.int64)
        text = np.full(starts[-1] + 1, 256, dtype=np.int64)
        lengths = np.array([len(b) for b in raw], dtype=np.int64)
        where = np.repeat(np.array(starts[:-1], dtype=np.int64), lengths) + (np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths))
        text[where] = np.frombuffer(b"".join(raw), dtype=np.uint8)
        token = symbols[text].tolist()  # a boundary of -1 after every word
        after = list(range(1, len(token) + 1))
        before = list(range(-1, len(token) - 1))
        rank_of, rules = self.rank_of, self.rules
        index: list[list[int] | None] = [None] * len(rules)
        pairs = (symbols[text[:-1]] << 20) | symbols[text[1:]]
        inside = np.flatnonzero((text[:-1] < 256) & (text[1:] < 256))
        for at, pair in zip(inside.tolist(), pairs[inside].tolist()):
            if (rank := rank_of.get(pair)) is not None:
                if index[rank] is None:
                    index[rank] = [at]
                else:
                    index[rank].append(at)
        for rank in range(len(rules)):
            places = index[rank]
            if places is None:
                continue
            index[rank] = None
            left, right, merged = rules[rank]
            if left == right:
                places.sort()  # in a run of one symbol the leftmost pair goes first
            for at in places:
                if token[at] != left:
                    continue
                nxt = after[at]
                if token[nxt] != right:
                    continue
                token[at], token[nxt] = merged, -2
                beyond = after[nxt]
                after[at], before[beyond] = beyond, at
                prev = before[at]
                if prev >= 0 and (symbol := token[prev]) >= 0 and (new := rank_of.get((symbol << 20) | merged)) is not None:
                    if index[new] is None:
                        index[new] = [prev]
                    else:
                        index[new].append(prev)
                if (symbol := token[beyond]) >= 0 and (new := rank_of.get((merged << 20) | symbol)) is not None:
                    if index[new] is None:
                        index[new] = [at]
                    else:
                        index[new].append(at)
        final = np.array(token, dtype=np.int32)
        kept = np.flatnonzero(final >= 0)
        ids = final[kept].tolist()
        cuts = np.searchsorted(kept, starts).tolist()
        self.memo.update((w, ids[cuts[i] : cuts[i + 1]]) for i, w in enumerate(words))

    def encode(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(flat ids, offsets) of the texts."""
        split = [split_words(t) if t else [] for t in texts]
        new = set(chain.from_iterable(split)).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_WORDS:
            self.memo.clear()
            new = set(chain.from_iterable(split))
        if new:
            self.learn(list(new))
        memo = self.memo
        per_text = [list(chain.from_iterable([memo[w] for w in words])) for words in split]
        offsets = np.cumsum([0, *map(len, per_text)])
        return np.fromiter(chain.from_iterable(per_text), dtype=np.int32, count=int(offsets[-1])), offsets


@lru_cache(1)
def _replay(path: str) -> MergeReplay:
    return MergeReplay(path)


def _blocks(texts: list[str | None]) -> Iterator[list[str | None]]:
    block, size = [], 0
    for t in texts:
        block.append(t)
        size += len(t) if t else 0
        if size >= BLOCK_CHARS:
            yield block
            block, size = [], 0
    if block:
        yield block


def encode_corpus(documents: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, ids array<int>) of every row of ``documents`` under the byte-level BPE file at ``path``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        replay = _replay(path)
        for batch in batches:
            keys, texts, done = batch.column(0), batch.column(1).to_pylist(), 0
            for block in _blocks(texts):
                flat, offsets = replay.encode(block)
                lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat))
                yield pa.RecordBatch.from_arrays([keys.slice(done, len(block)), lists], names=[key, "ids"])
                done += len(block)

    rows = documents.select(key, text)
    return rows.mapInArrow(run, f"{key} {rows.schema[key].dataType.simpleString()}, ids array<int>")


def default_vocabulary() -> str:
    """The installed file of byte_bpe_50k; pass another path to ``encode_corpus`` for another vocabulary."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document under byte_bpe_50k, without special tokens."""
    return encode_corpus(table(spark, sf_dir, "documents"), default_vocabulary())
