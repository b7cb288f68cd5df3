"""Merge replay against the reference library of the vocabulary, on random and on hard texts."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

encode = pytest.importorskip("presslens.llm.encode")
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def both():
    lib = tokenizers.Tokenizer.from_file(encode.default_vocabulary())
    lib.encode_special_tokens = True
    return encode.MergeReplay(encode.default_vocabulary()), lib


def ids(replay, texts):
    flat, ends = replay.encode(texts)
    return [flat[ends[i] : ends[i + 1]].tolist() for i in range(len(texts))]


HARD = ["", None, " ", "a" * 9000, " " * 5000, "<|endoftext|>", "x²½Ⅷ①١", "\x1c\x1d\x85  　\n\n\t x", "'s'T're don't", "日本語のテキスト", "é​﻿", "👩‍👩‍👧 ok", "_a__1_", "ab" * 4000, "Οι πιστωτές της", "a\r\n b"]


def test_hard_texts(both):
    replay, lib = both
    assert ids(replay, HARD) == [lib.encode(t or "", add_special_tokens=False).ids for t in HARD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.characters(exclude_categories=["Cs", "Cn"]), max_size=40), min_size=1, max_size=12))
def test_random_texts(both, texts):
    replay, lib = both
    assert ids(replay, texts) == [e.ids for e in lib.encode_batch(texts, add_special_tokens=False)]
