"""History deduplication against all pairs, whatever the order, ties and hot words."""

import random

import pytest

history = pytest.importorskip("presslens.llm.history")
from pyspark.sql import functions as F  # noqa: E402


def words(key):
    return frozenset(w for w in (key or "").split(" ") if w)


def test_equals_all_pairs(spark):
    rng = random.Random(4)
    vocab, hot = [f"n{i}" for i in range(60)], ["to", "of", "and", "sells", "court"]
    items = []
    for i in range(260):
        if items and rng.random() < 0.5:
            ws = (rng.choice(items)[2] or "x").split(" ")
            for _ in range(rng.randint(0, 4)):
                ws[rng.randrange(len(ws))] = rng.choice(vocab)
            rng.shuffle(ws)
        else:
            ws = rng.sample(vocab, rng.randint(1, 7)) + rng.sample(hot, rng.randint(0, 5))
        items.append((i, f"https://a.test/{rng.randint(0, 200)}", " ".join(ws), i // 10))
    items += [(900, None, None, None), (901, "", "", 3), (902, " ", "a b c", 3), (903, "https://a.test/1", "a b c", 3), items[5], items[7]]
    want = set()
    for a in items:
        for b in items:
            if a[0] < b[0]:
                s, t = words(a[2]), words(b[2])
                near = len(s) >= 4 and len(t) >= 4 and len(s & t) >= 0.6 * len(s | t) - 1e-12
                if near or a[1] and a[1].strip() and a[1] == b[1]:
                    want.add((a[0], b[0]))
    df = spark.createDataFrame(items, "id long, canonical_url string, title_key string, run_id long")
    assert {(r[0], r[1]) for r in history.near_pairs(df).collect()} == want


def test_many_copies_stay_whole(spark):
    items = [(i, f"https://a.test/{i}", "one two three four five" if i % 3 else f"six{i} seven{i} eight{i} nine{i}", i) for i in range(120)]
    got = history.near_pairs(spark.createDataFrame(items, "id long, canonical_url string, title_key string, run_id long"))
    assert got.count() == 80 * 79 // 2


def test_page_key(spark):
    same = ["https://www.A.test/x/?b=2&a=1#f", "http://amp.a.test//x/amp?a=1&b=2&utm_x=3", "https://m.a.test/x/index.html?fbclid=1&a=1&b=2", "a.test/x?a=1&b=2"]
    other = ["https://a.test/X?a=1&b=2", "https://a.test/x?a=1", "https://b.test/x?a=1&b=2", None, ""]
    df = spark.createDataFrame([(u,) for u in same + other], "u string").select(history.page_key(F.col("u")).alias("k"))
    keys = [r[0] for r in df.collect()]
    assert len(set(keys[:4])) == 1 and len(set(keys[4:7]) | {keys[0]}) == 4 and keys[7:] == [None, None]


def test_merging_segments_finds_across_batches():
    import numpy as np
    import pyarrow as pa

    n = 30_000
    rng = np.random.default_rng(1)
    gram = rng.integers(0, 5_000, n)
    t = pa.table({"bucket": pa.array(np.zeros(n, np.int32)), "gram": pa.array(gram), "rec": pa.array(np.arange(n)), "batch": pa.array(np.arange(n) // 100), "n": pa.array(np.full(n, 5, np.int32)), "j": pa.array(np.zeros(n, np.int32)), "short": pa.array(np.ones(n, bool)), "g": pa.array(np.ones(n, np.int8))})
    counts = np.bincount(gram)
    assert history.replay(t).num_rows == int((counts * (counts - 1) // 2).sum())


def test_batches_add_up_to_the_whole(spark, tmp_path):
    rng = random.Random(9)
    items = []
    for i in range(150):
        ws = (rng.choice(items)[2].split(" ") if items and rng.random() < 0.5 else rng.sample([f"n{k}" for k in range(40)], 6)) + []
        ws[rng.randrange(len(ws))] = rng.choice(["court", "loans", "n1"])
        items.append((i, f"https://a.test/{rng.randint(0, 90)}", " ".join(ws), i // 30))
    schema = "id long, canonical_url string, title_key string, run_id long"
    index, got = history.HistoryIndex(spark, str(tmp_path), buckets=4), []
    for run in range(5):
        batch = [x for x in items if x[3] == run] + ([items[0]] if run else [])
        got += [(r[0], r[1]) for r in index.add(spark.createDataFrame(batch, schema)).collect()]
    assert len(got) == len(set(got)) and set(got) == {(r[0], r[1]) for r in history.near_pairs(spark.createDataFrame(items, schema)).collect()}
    assert len(index._segments()) <= 3
    assert index.add(spark.createDataFrame([], schema)).count() == 0


def test_a_run_that_dies_can_be_repeated(spark, tmp_path, monkeypatch):
    schema = "id long, canonical_url string, title_key string, run_id long"
    keys = ["one two three four five", "one two three four six", "one two three five six"]
    batches = [spark.createDataFrame([(i + 1, f"https://a.test/{i}", k, i)], schema) for i, k in enumerate(keys)]
    index = history.HistoryIndex(spark, str(tmp_path), buckets=2)
    index.add(batches[0])
    for step in ("segments", "records"):
        with monkeypatch.context() as m:
            if step == "segments":
                m.setattr(index.store, "write", lambda *a, **k: (_ for _ in ()).throw(OSError("gone")))
            else:
                m.setattr(index, "_write", lambda number, grams, records: (grams.write.mode("overwrite").parquet(f"{tmp_path}/grams/{number}"), (_ for _ in ()).throw(OSError("gone"))))
            with pytest.raises(OSError):
                index.add(batches[1])
    assert [tuple(r) for r in index.add(batches[1]).collect()] == [(1, 2)]
    assert {tuple(r) for r in index.add(batches[2]).collect()} == {(1, 3), (2, 3)}


def test_long_keys(spark):
    rng = random.Random(1)
    base = [f"w{i}" for i in range(600)]
    items = [(i, f"https://a.test/{i}", " ".join(rng.sample(base, n))) for i, n in enumerate([14, 25, 38, 39, 55, 64, 65, 90, 106, 107, 600, 500, 380])]
    items += [(100 + i, f"https://b.test/{i}", " ".join(k.split()[: int(len(k.split()) * 0.7)])) for i, _, k in items]
    items += [(200, "https://c.test/", " ".join(f"v{i}" for i in range(40_000))), (201, "https://c.test/1", " ".join(f"v{i}" for i in range(39_000)))]
    got = history.near_pairs(spark.createDataFrame([(*x, 0) for x in items], "id long, canonical_url string, title_key string, run_id long"))
    want = {(a[0], b[0]) for a in items for b in items if a[0] < b[0] and len(words(a[2]) & words(b[2])) >= 0.6 * len(words(a[2]) | words(b[2])) - 1e-12}
    assert {tuple(r) for r in got.collect()} == want and (200, 201) in want


def test_a_crowded_gram_takes_little_memory():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    n, near = 8_000, 300
    t = pa.table({"bucket": pa.array(np.zeros(n, np.int32)), "gram": pa.array(np.full(n, 7)), "rec": pa.array(np.arange(n)), "batch": pa.array(np.arange(n) // 2_000), "n": pa.array(np.full(n, 14, np.int32)), "j": pa.array(np.where(np.arange(n) < near, 4, 6).astype(np.int32)), "short": pa.array(np.arange(n) < near), "g": pa.array(np.full(n, 2, np.int8))})
    tracemalloc.start()
    try:
        found = history.replay(t).num_rows
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert found == near * (near - 1) // 2 and peak < 100e6


def test_crowded_grams_lose_no_pair(spark):
    rng = random.Random(2)
    # 12 words make few pairs of rarest words; words so common that four-word keys share their three rarest; long keys
    vocab, common, long = [f"n{i}" for i in range(14)], [f"c{i}" for i in range(200)], [f"l{i}" for i in range(90)]
    keys = [rng.sample(vocab, rng.randint(5, 9)) for _ in range(420)] + [["a", "b", "d", c] for c in common]
    keys += [rng.sample(common, 50) for _ in range(900)] + [rng.sample(long, 70) for _ in range(150)]
    items = [(i, f"https://a.test/{i}", " ".join(k), i // 40) for i, k in enumerate(keys)]
    sets = [words(x[2]) for x in items]
    want = {(i, j) for j in range(len(sets)) for i in range(j) if len(sets[i] & sets[j]) >= 0.6 * len(sets[i] | sets[j]) - 1e-12}
    got = history.near_pairs(spark.createDataFrame(items, "id long, canonical_url string, title_key string, run_id long"))
    assert {tuple(r) for r in got.collect()} == want and len(want) > 30_000
