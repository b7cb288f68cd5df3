"""One form for equal-looking text; nothing for text that is plain."""

import unicodedata

import pytest
from hypothesis import given
from hypothesis import strategies as st

look = pytest.importorskip("presslens.llm.lookalikes")
from pyspark.sql import functions as F  # noqa: E402

CASES = [("Ｍｅｖａ Ｐｏｓｔ", "Meva Post"), ("reﬁnance", "refinance"), ("Köln", "Köln"), ("Su​wu­nor", "Suwunor"), ("a b　c", "a b c"), ("Mеvа", "Meva"), ("Μuwupress", "Muwupress"), ("Aθήνα", "Αθήνα"), ("﻿x", "x"), ("աpple", "wpple"), ("ᎪBC", "ABC"), ("ꓮcme", "Acme"), ("cѐder", "cèder"), ("a\u0302\u0323b", "ậb"), ("ê\u0323b", "ệb"), ("ａ\u0308b", "äb"), ("q\u0303b", "q\u0303b"), ("ᎠᎠ-Ꭰa", "ᎠᎠ-Da")]
PLAIN = ["", "Köln", "Οι πιστωτές της Wiguberg", "Москва Bank", "L’Écho – “x” … 5 €", "naïve", "Łódź"]


@pytest.mark.parametrize("text,want", CASES)
def test_cases(spark, text, want):
    assert look.plain(text) == (want, True)
    assert look.plain(want)[0] == want


@pytest.mark.parametrize("text", PLAIN)
def test_plain_text_stays(text):
    assert look.plain(text) == (text, False)


def test_java_pattern_loses_nothing(spark):
    df = spark.createDataFrame([(c[0],) for c in CASES], "t string")
    assert df.where(~look.changeable(F.col("t"))).count() == 0


@given(st.text(st.characters(categories=["Lu", "Ll", "Mn", "Zs", "Cf", "Nd"], max_codepoint=0x24FF), max_size=30))
def test_composed_and_decomposed_agree(text):
    once = look.plain(unicodedata.normalize("NFC", text))[0]
    assert look.plain(once)[0] == once or unicodedata.normalize("NFD", once) != once


def test_mapping_has_no_conflicts():
    m = look.mapping()
    assert not any(x in m for v in m.values() for x in v)
