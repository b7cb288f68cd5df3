"""Leak detection against brute force; recall of altered items planted into documents of the corpus."""

import random

import numpy as np
import pytest

leaks = pytest.importorskip("presslens.llm.leaks")


def brute(docs, items, w=13):
    grams = {}
    for e, t in items:
        ws = leaks.words_of(t)
        for i in range(len(ws) - w + 1):
            grams.setdefault(tuple(ws[i : i + w]), set()).add(e)
    out = set()
    for d, t in docs:
        ws = leaks.words_of(t)
        for i in range(len(ws) - w + 1):
            out |= {(d, e) for e in grams.get(tuple(ws[i : i + w]), ())}
    return out


def test_equals_brute_force(spark):
    rng = random.Random(3)
    vocab = [f"w{i}" for i in range(40)] + ["Straße", "Ωμέγα", "l’avait"]
    items = [(e, " ".join(rng.choices(vocab, k=rng.choice([5, 13, 30])))) for e in range(20)] + [(90, None), (91, ""), (92, items_dup := "a b c d e f g h i j k l m"), (93, items_dup)]
    docs = [(0, None), (1, ""), (2, "x " * 40_000), (3, "A, B - c; d e f! g h I J k (l) M n")]
    for d in range(4, 60):
        e = rng.choice(items)[1] or ""
        ws = e.split()
        lo = rng.randint(0, max(0, len(ws) - 13))
        part = ws[lo : lo + rng.choice([12, 13, 14, 20])]
        docs.append((d, " ".join(rng.choices(vocab, k=9)) + ". " + rng.choice([str.upper, str.title, str])(" ".join(part)) + " " + " ".join(rng.choices(vocab, k=9))))
    got = {(r["doc_id"], r["eval_id"]) for r in leaks.find_leaks(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "eval_id long, text string"), most_edits=0).collect()}
    assert got == brute(docs, items) and (3, 92) in got and (3, 93) in got


def alter(words, edits, rng, vocab):
    """A text some words of which are changed, left out or put in."""
    words = list(words)
    for _ in range(edits):
        kind, at = rng.choice(["change", "leave", "put"]), rng.randrange(len(words))
        words[at : at + (kind != "put")] = [] if kind == "leave" else [rng.choice(vocab)]
    return words


def test_altered_items_in_documents(spark, sf):
    """Whole items with one word in 26 changed, left out or put in, in the middle of real documents: at least 0.9 come out."""
    rng = random.Random(8)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{sf}/documents.parquet").where("text IS NOT NULL").select("doc_id", "text").orderBy("doc_id").collect()]
    items = [(r["eval_id"], r["text"]) for r in spark.read.parquet(f"{sf}/eval_items.parquet").orderBy("eval_id").collect()]
    vocab = [w for _, t in docs[:20] for w in leaks.words_of(t)]
    planted, due = [], {}
    for k, (e, text) in enumerate(items):
        words = leaks.words_of(text)
        due[(100_000 + k, e)] = edits = leaks.allowed(len(words)) // 2 or 1
        host = docs[k % len(docs)][1]
        planted.append((100_000 + k, host[: len(host) // 2] + " " + " ".join(alter(words, edits, rng, vocab)) + ". " + host[len(host) // 2 :]))
    got = {(r["doc_id"], r["eval_id"]): r["n_edits"] for r in leaks.find_leaks(spark.createDataFrame(planted, "doc_id long, text string"), spark.createDataFrame(items, "eval_id long, text string"), whole=True).collect()}
    assert len(due.keys() & got.keys()) >= 0.9 * len(due)
    assert all(n <= 2 * due[k] for k, n in got.items() if k in due)


def test_keys_agree_as_often_as_the_repetitions_assume():
    rng = random.Random(5)
    for size in (13, 40, 108):
        edits = leaks.allowed(size) // 2 or 1
        same = total = hit = 0
        for _ in range(120):
            row = [rng.randrange(2, 2**62) for _ in range(size)]
            other = (alter(row, edits, rng, range(2, 2**62)) + [rng.randrange(2, 2**62) for _ in range(edits)])[:size]
            keys = leaks.walk_keys(np.array(row + other, np.uint64), np.array([0, size]), size)
            same, total, hit = same + (keys[0] == keys[1]).sum(), total + keys.shape[1], hit + (keys[0] == keys[1]).any()
        assert same / total >= leaks.KEYS_AGREE - 0.04 and hit >= 0.9 * 120


def test_edit_distances():
    rng = random.Random(2)

    def plain(x, y):
        row = list(range(len(y) + 1))
        for i, c in enumerate(x, 1):
            new = [i]
            for j, d in enumerate(y, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
            row = new
        return row[-1]

    a, b = (np.array([[rng.randint(0, 3) for _ in range(9)] for _ in range(60)]) for _ in range(2))
    assert leaks.edit_distances(a, b).tolist() == [plain(x, y) for x, y in zip(a.tolist(), b.tolist())]
