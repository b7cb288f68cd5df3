"""Personal information: cases of every type, look-alikes that are none, placeholders that keep the rest."""

import pytest

personal = pytest.importorskip("presslens.llm.personal")

CASES = [
    ("Signed: Zoë Guliovska, national insurance reference 996-62-9013.", {("name", "Zoë Guliovska"), ("id_number", "996-62-9013")}),
    ("Kontakt: Hugo Tinanen, Telefon +44 20 7946 0230, E-Mail hugo+press@robipost.invalid.", {("name", "Hugo Tinanen"), ("phone", "+44 20 7946 0230"), ("email", "hugo+press@robipost.invalid")}),
    ("Dr Irene B. van der Bolenen told the desk by phone (+49 (0) 171 / 39200 95) that", {("name", "Irene B. van der Bolenen"), ("phone", "+49 (0) 171 / 39200 95")}),
    ("Powód Lucia Bafahagen, PESEL 30811843400, mieszka przy ul. Vawuer 37/15.", {("name", "Lucia Bafahagen"), ("id_number", "30811843400"), ("address", "ul. Vawuer 37/15")}),
    ("Write to ana (at) cabu [dot] example today; lives at 11B Musain Close.", {("email", "ana (at) cabu [dot] example"), ("address", "11B Musain Close")}),
    ("demeure au 24A bis boulevard Ruleer.", {("address", "24A bis boulevard Ruleer")}),
    ("Elena Bistro Group opens 24 sites. The deal on Lewonor Street closed in 2020.", set()),
    ("Org.nr 556405-4532. ISBN 978-0-0703-0703-10. Case no. 2026-7593/743168. Invoice 000737338-7548. Turnover rose to 25 200 200 euro.", set()),
    ("Follow @fuhonordesk for 8388.3 million updates, due 2014-11-14.", set()),
    (f"x {'a' * 200}@mail.example.com", {("email", "a" * 200 + "@mail.example.com")}),
    (f"wohnt {'Ab' + 'c' * 300}straße 7", {("address", "Ab" + "c" * 300 + "straße 7")}),
    ("", set()), (None, set()), (" ", set()), ("1" * 50_000, set()), ("( ( 12 @ @@ a@ @b 7", set()),
]


@pytest.fixture(scope="module")
def model():
    return personal.fit([])


@pytest.mark.parametrize("text,want", CASES)
def test_cases(model, text, want):
    assert {(k, text[a:b]) for a, b, k in personal.spans(text, model)} == want


def test_placeholders(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in personal.redact(df).collect()}
    for i, (text, want) in enumerate(CASES):
        clean = text
        for kind, value in want:
            clean = clean.replace(value, f"[{kind.upper()}]")
        assert out[i] == clean


def test_reliabilities_recover():
    import numpy as np

    rng = np.random.default_rng(2)
    truth = rng.random(4000) < 0.5
    votes = np.stack([np.where(rng.random(4000) < q, 1, -1) * np.where(truth, 1, -1) for q in (0.95, 0.8, 0.7)], axis=1).astype(float)
    accuracy, prior, posterior = personal.em_reliabilities(votes, (0.85, 0.85, 0.85))
    assert abs(accuracy - [0.95, 0.8, 0.7]).max() < 0.05 and ((posterior > 0.5) == truth).mean() > 0.93
