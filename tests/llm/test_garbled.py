"""Encoding repair: round trips through wrong codecs, clean text untouched, damage found."""

import re

import pytest

garbled = pytest.importorskip("presslens.llm.garbled")

TEXTS = {
    "de": "Die Gläubiger von Fühlström lehnen die Übernahme über Köln ab, während die Prüfer zögern",
    "fr": "Le tribunal a précisé que la société déçue restera dans le groupe jusqu’à la fin de l’été",
    "el": "Οι πιστωτές της εταιρείας απορρίπτουν την προσφορά και περιμένουν την απόφαση",
    "pl": "Wierzyciele zdecydują wkrótce, czy spółka zachowa swoją licencję i działalność",
    "sv": "Långivarna säger nej när Gösta Åkerström förhandlar på Öland",
    "fi": "Pankki kiistää väitteet, joiden mukaan yhtiö rikkoi ehtoja myöhään tiistaina",
}


@pytest.fixture(scope="module")
def restorer():
    return garbled.Restorer({k: (t + ". ").encode() * 6 for k, t in TEXTS.items()})


def wrong(text, codec):
    out = []
    for b in text.encode("utf-8"):
        out.append({v: k for k, v in garbled._bytes_of(codec).items()}[b])
    return "".join(out)


@pytest.mark.parametrize("lang", TEXTS)
@pytest.mark.parametrize("codec", ["cp1252", "cp1250", "cp1251", "mac-roman"])
def test_round_trip(restorer, lang, codec):
    assert restorer.restore(wrong(TEXTS[lang], codec)) == (TEXTS[lang], True)
    assert restorer.restore(wrong(wrong(TEXTS[lang], codec), codec)) == (TEXTS[lang], True)
    words = TEXTS[lang].split(" ")
    k = next(i for i, w in enumerate(words) if not w.isascii() and all(ord(c) < 0x2000 for c in w))
    part = " ".join(words[:k] + [wrong(words[k], codec)] + words[k + 1 :])
    assert restorer.restore(part) == (TEXTS[lang], True)


@pytest.mark.parametrize("lang,right,read", [("el", "cp1253", "cp1252"), ("pl", "cp1250", "cp1252"), ("de", "cp1252", "mac-roman"), ("sv", "cp1252", "cp850")])
def test_single_byte(restorer, lang, right, read):
    back = {v: k for k, v in garbled._bytes_of(read).items()}
    text = TEXTS[lang].replace("’", "'")
    assert restorer.restore("".join(back[b] for b in text.encode(right)))[1]


@pytest.mark.parametrize("text", [*TEXTS.values(), "", " ", "plain", "© 2026 ☂ 日本語 Ω µ", "L’Écho jusqu’à", "NÃO É", "ｗｉｄｅ", "x" * 200_000])
def test_clean_text_stays(restorer, text):
    assert restorer.restore(text) == (text, False)


def test_damage_is_found(restorer):
    assert restorer.restore("Le tribunal d� raison")[1]
    assert garbled.Restorer({}).restore("cafÃ©")[1]


def test_java_pattern_loses_nothing(spark):
    from pyspark.sql import functions as F

    texts = [wrong(t, c) for t in TEXTS.values() for c in ("cp1252", "cp1250", "cp1251", "mac-roman")] + ["d� x"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert df.where(~garbled.suspicious(F.col("t"))).count() == 0


USUAL = "—".join([*TEXTS.values(), "La Città", "El consejo decidió este año", "O café fechou", "Financiële", "the company’s debt"])


def narrow(text, wrong_codec, right):
    """A text in the codec ``right`` that was read as another, or None where they don't have its characters."""
    back = {v: k for k, v in garbled._bytes_of(wrong_codec).items()}
    raw = garbled._encode(text, right)
    return None if raw is None or any(b not in back for b in raw) else "".join(back[b] for b in raw)


def test_java_pattern_passes_every_narrow_pair(spark):
    from pyspark.sql import functions as F

    texts = [(w, r, word, narrow(word, w, r)) for word in set(re.findall(r"\w{2,}", USUAL)) for w, r in garbled.NARROW if not word.isascii()]
    texts = [t for t in texts if t[3] and t[3] != t[2] and not t[3].isascii() and "’" not in t[3]]
    assert len(texts) > 200
    df = spark.createDataFrame(texts, "w string, r string, word string, t string")
    assert df.where(~garbled.suspicious(F.col("t"))).collect() == []


@pytest.mark.parametrize("read", ["FinanciÎle Budapress", "La CittÓ di Todepress", "Dogapress CafÈ & Markets", "Nijipress NotÌcias", "Nogopress Põivõlehti"])
def test_usual_letters_in_odd_places(read):
    rest = ["Financiële Budapress", "La Città di Todepress", "Dogapress Café & Markets", "Nijipress Notícias", "Nogopress Päivälehti"]
    restorer = garbled.Restorer({k: "\n".join(f"{x} {i}" for x in (t, *rest) for i in range(6)).encode() for k, t in TEXTS.items()})
    assert restorer.restore(read) == (next(t for t in rest if t[:4] == read[:4] and t[-4:] == read[-4:]), True)


@pytest.mark.parametrize("text", ["Vakuutti tuloksen Cuceströ", "Er fragte nach dem Grü…", "Die Bank erklärte Vajoví...", "SEGÚN WIMUDEM", "Wiwovík zögert"])
def test_cut_and_rare_places_stay(restorer, text):
    assert restorer.restore(text) == (text, False)
