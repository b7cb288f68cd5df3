"""Held-out accuracy of the language network, stretches of mixed texts, labels in all notations."""

import duckdb
import pytest

language = pytest.importorskip("presslens.llm.language")
from pyspark.sql import functions as F  # noqa: E402


@pytest.fixture(scope="module")
def fitted():
    rows = duckdb.connect().sql("select distinct id, lang, title, summary from '/root/testdata/sf0.01/items.parquet' order by id").fetchall()
    rows = [r[1:] for r in rows if r[1] in language.LANGUAGES and "�" not in (r[2] or "") + (r[3] or "")]
    by = {}
    train = [r for r in rows[::2] if by.setdefault(r[0], []) is not None and len(by[r[0]]) < 150 and not by[r[0]].append(r)]
    return language.fit(train), rows[1::2]


def test_held_out_accuracy(fitted):
    network, held = fitted
    held = [r for r in held if r[2] and len(r[2]) > 80]
    found = [language.languages_of(j) for j in language.judge([(r[1], r[2]) for r in held], network)]
    right = sum(r[0] in f for r, f in zip(held, found))  # some labels are wrong on purpose
    assert right >= 0.93 * len(held)
    assert sum(len(f) == 1 for f in found) >= 0.9 * len(found)


def test_mixed_and_edge_texts(fitted):
    network, _ = fitted
    de = "Die Aufsicht untersucht, ob die Gebühren zu hoch waren und wer sie zahlt."
    fr = "La banque a précisé que les négociations ont été suspendues cette semaine."
    rows = language.judge([(de, fr), (None, None), ("", " "), ("Xx", None), (de + " " + fr, ""), (de * 400, None)], network)
    assert [set(language.languages_of(r)) for r in rows] == [{"de", "fr"}, set(), set(), set(), {"de", "fr"}, {"de"}]
    text = "a b. c d... e 1.5 f!  g"
    assert "".join(text[a:b] for a, b in language.stretches(text)) == text


HEADLINES = {
    "el": "Υποβάθμιση της Zamamont Bank λόγω Zojunor, Zukaström, Cegolin, Cigudem και Cohakas",
    "pl": "Zadłużenie Luzifors rośnie po Gerunor, Juseström, Misolin, Puzodem i Ticakas",
    "pt": "Credores da Ronifors Bank recusam Fehonor, Jobaström, Mutilin e Semudem com Zohekas",
    "fr": "Ritufors SE cède Legenor et Kopaström à Kadilin malgré Jepudem et Hofekas",
}
ENGLISH = "Shares in Lipora fell sharply after the auditor of the company refused to sign the accounts."


def test_short_headlines_over_another_language(fitted):
    network, _ = fitted
    rows = language.judge([(h, ENGLISH) for h in HEADLINES.values()], network)
    assert all(s[5] < language.SECOND_LETTERS for row in rows for s in row if s[0] == 0)
    assert [set(language.languages_of(r, k)) for k, r in zip(HEADLINES, rows)] == [{k, "en"} for k in HEADLINES]
    assert set(language.languages_of(rows[0])) == {"el", "en"}  # without a label


def test_short_stretches_need_more():
    long = (1, 0, 90, "en", 0.99, 60)
    for n, conf, label, brings in [(8, 0.9, "en", False), (8, 0.9, "pl", True), (8, 0.995, None, True), (20, 0.85, None, True), (0, 0.99, "pl", False), (8, 0.7, "pl", False)]:
        assert set(language.languages_of([(0, 0, 30, "pl", conf, n), long], label)) == ({"en", "pl"} if brings else {"en"})
    assert set(language.languages_of([long, (1, 90, 99, "nl", 0.999, 8)], "nl")) == {"en"}  # the rest of a cut field


def test_labels(spark):
    labels = {"EN": "en", "en_GB": "en", "pt-BR": "pt", "deu": "de", "Finnish": "fi", " german ": "de", "--": None, "": None, None: None, "und": None, "ell": "el", "ru": "ru"}
    df = spark.createDataFrame([(i, k) for i, k in enumerate(labels)], "i int, l string").select("i", language.normal_label(F.col("l")).alias("n"))
    assert [r["n"] for r in df.orderBy("i").collect()] == list(labels.values())


def test_nothing_to_learn():
    assert language.fit([]) is None and language.fit([("en", None, None)]) is None
