"""Truncation on a corpus made for it: cut ends are found, complete ends without stop are not."""

import random

import pytest

truncated = pytest.importorskip("presslens.llm.truncated")


def corpus(n=900, seed=6):
    rng = random.Random(seed)
    name = lambda: "".join(rng.choice("bcdfgjklm") + rng.choice("aeiou") for _ in range(2)).title() + rng.choice(["nor", "lin", "dem", "kas"])
    forms = ["Creditors of {} will vote next month on whether {} can keep its licence", "Shares in {} fell sharply after the auditor of {} refused to sign the accounts", "The lender said that {} would remain part of the group until the sale to {} is completed", "Rent arrears at {} doubled within a year, and {} has stopped new leases"]
    rows, cut = [], set()
    for i in range(n):
        text = ". ".join(rng.choice(forms).format(name(), name()) for _ in range(rng.randint(1, 3)))
        kind = rng.random()
        if kind < 0.05:
            at = rng.randint(20, 60)
            while text[at - 1] == " " or text[at : at + 1] in ("", "."):
                at -= 1
            if not text[:at].endswith(("licence", "accounts", "completed", "leases")):
                text = text[:at]
                cut.add(i)
        elif kind < 0.08:
            text = text[:40].rstrip() + rng.choice(["…", "...", " [...]"])
            cut.add(i)
        elif kind < 0.9:
            text += "."
        rows.append((i, "s.test", None, text))
    return rows, cut


def test_found(spark):
    rows, cut = corpus()
    rows += [(5001, "s.test", "", " "), (5002, None, None, "one"), (5003, "s.test", "x " * 50_000, None), rows[3]]
    df = spark.createDataFrame(rows, "id long, source_domain string, title string, summary string")
    got = {r["id"] for r in truncated.find_cut(spark, df).collect() if r["field"] == "summary"}
    assert len(got & cut) >= 0.8 * len(cut) and len(got - cut) <= 0.1 * len(got)


def test_cut_after_a_lone_capital(spark):
    rows = [(i, "s.test", None, "Gonland lost the case. Shares fell again today.") for i in range(60)] + [(i, "s.test", None, "They met again. A Gonland firm won.") for i in range(60, 120)]
    df = spark.createDataFrame([*rows, (999, "s.test", None, "Gonland lost the case. S")], "id long, source_domain string, title string, summary string")
    assert [r["id"] for r in truncated.find_cut(spark, df).collect()] == [999]
