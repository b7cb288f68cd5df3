"""Problem 7, visually identical text with different characters: one form by a compiled longest-match transducer.

The transducer is computed once from the character database and checked for conflicts. Its input are grapheme clusters, a
base with its marks: ``expand`` gives the plain parts of every character (compatibility forms of letters and digits,
every space as U+0020, invisible characters as nothing, composed letters as base and marks), and ``step`` leads from a
letter and a mark to the composed letter, for every composition of the database. From a base the longest path over the
marks of a cluster is taken, so one pass gives widths, accents and spaces their one form. At the end of each word, in the
same pass, a word whose letters are of more than one script has its look-alikes, also those with accents, turned into the
script of most of the letters that can't be look-alikes. A whole word in one script stays as it is.

A regular expression in the JVM passes on only values that can change. Null and empty values stay as they are;
repeated rows give one case; values of any length are treated whole. A letter of a foreign script in a mixed word that
looks like no letter of the word's script is found and stays.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.garbled import _restorer, fit_dictionaries
from presslens.session import table

FIELDS = ("title", "source_name")

# Letters of other scripts and the Latin letters they look like, in the same order.
LOOKALIKES = {
    "CYRILLIC": ("АВЕЅІЈКМНОРСТУХҮԌԚԜаеѕіјорсухүһԁԛԝѵ", "ABESIJKMHOPCTYXYGQWaesijopcyxyhdqwv"),
    "GREEK": ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧοινραϲ", "ABEZHIKMNOPTYXoivpac"),
    "ARMENIAN": ("աօոսհցզՕՍՏԼ", "wonuhgqOUSL"),
    "CHEROKEE": ("ᎪᏴᏟᎠᎬᏀᎻᏆᎫᏦᏞᎷᏢᏒᏚᎢᏙᏔᏃ", "ABCDEGHIJKLMPRSTVWZ"),
    "COPTIC": ("ⲂⲎⲒⲔⲘⲚⲞⲢⲤⲦⲨⲬⲟⲣⲥ", "BHIKMNOPCTYXopc"),
    "LISU": ("ꓮꓐꓚꓓꓰꓝꓖꓧꓲꓙꓗꓡꓟꓠꓳꓑꓣꓢꓔꓴꓦꓪꓫꓬꓜ", "ABCDEFGHIJKLMNOPRSTUVWXYZ"),
}


def _script(c: str) -> str:
    """L for Latin, else the first word of the name of a letter; empty for everything else."""
    if c.isascii():
        return "L" if c.isalpha() else ""
    if not c.isalpha():
        return ""
    name = unicodedata.name(c, "OTHER").split(" ")[0]
    return "L" if name == "LATIN" else name


_script = lru_cache(4096)(_script)


class Transducer:
    """The compiled tables; ``cluster`` runs them over one cluster."""

    def __init__(self):
        self.single: dict[str, str] = {}
        self.expand: dict[str, str] = {}
        self.step: dict[str, str] = {}
        self.order: dict[str, int] = {}
        for c in map(chr, range(128, sys.maxunicode + 1)):
            kind, parts = unicodedata.category(c), unicodedata.decomposition(c)
            if kind == "Zs":
                self.single[c] = " "
            elif kind == "Cf" or c in "͏ᅟᅠ឴឵᠋᠌᠍ㅤﾠ" or "︀" <= c <= "️":
                self.single[c] = ""
            elif kind[0] in "LN" and parts.startswith("<"):
                self.single[c] = unicodedata.normalize("NFKC", c)
            elif parts and not parts.startswith("<") and kind[0] in "LM":
                whole = unicodedata.normalize("NFD", c)
                self.expand[c] = whole
                first, *rest = (chr(int(x, 16)) for x in parts.split(" "))
                if len(rest) == 1 and unicodedata.normalize("NFC", whole) == c:
                    if self.step.setdefault(first + rest[0], c) != c:
                        raise ValueError(f"two compositions of {first!r} and U+{ord(rest[0]):04X}")
            if rank := unicodedata.combining(c):
                self.order[c] = rank
        for c, put in self.single.items():
            self.expand[c] = "".join(self.expand.get(x, x) for x in put)
        self.known: dict[str, str] = {}
        self._check()

    def cluster(self, text: str) -> str:
        """The one form of a base with its marks."""
        if (out := self.known.get(text)) is None:
            if len(self.known) > 50_000:  # a memory bound
                self.known.clear()
            out = self.known[text] = self._run(text)
        return out

    def _run(self, text: str) -> str:
        parts = "".join(self.expand.get(c, c) for c in text)
        out, lo = [], 0
        while lo < len(parts):  # a compatibility form may stand for several letters
            hi = lo + 1
            while hi < len(parts) and parts[hi] in self.order:
                hi += 1
            state, left, blocked = parts[lo], [], 0
            for mark in sorted(parts[lo + 1 : hi], key=self.order.__getitem__):
                longer = self.step.get(state + mark)
                if longer is not None and blocked < self.order[mark]:
                    state = longer
                else:
                    left.append(mark)
                    blocked = self.order[mark]
            out += [state, *left]
            lo = hi
        return "".join(out)

    def _check(self) -> None:
        """Every key once more: a result is never changed again."""
        for keys in (self.single, self.step):
            for key in keys:
                out = self._run(key)
                if self._run(out) != out or any(c in self.single for c in out):
                    raise ValueError(f"the result of {key!r} is a key itself")


@lru_cache(1)
def transducer() -> Transducer:
    """The one transducer of a worker."""
    return Transducer()


def mapping() -> dict[str, str]:
    """Single character to its plain form, for compatibility letters and digits, spaces and invisible characters."""
    return transducer().single


@lru_cache(1)
def _to_script() -> dict[str, dict[str, str]]:
    """Per target script, look-alike letter to the letter of that script, with and without accents."""
    latin: dict[str, str] = {}
    tables: dict[str, dict[str, str]] = {"L": latin}
    for script, (letters, shapes) in LOOKALIKES.items():
        back = tables.setdefault(script, {})
        for a, b in zip(letters, shapes, strict=True):
            if latin.setdefault(a, b) != b:
                raise ValueError(f"two look-alikes for {a}")
            back.setdefault(b, a)
    run = transducer()
    for table_ in tables.values():
        for c, whole in run.expand.items():
            if len(whole) > 1 and whole[0] in table_ and c not in run.single:
                put = run._run(table_[whole[0]] + whole[1:])
                if len(put) == 1 and put != c and table_.setdefault(c, put) != put:
                    raise ValueError(f"two look-alikes for {c}")
    return tables


_MARKS = r"̀-ͯ҃-҉᪰-᫿᷀-᷿⃐-⃿︠-︯"


@lru_cache(1)
def _compiled() -> tuple[re.Pattern, re.Pattern]:
    """(words with what may stand inside them or another character that changes, clusters)."""
    singles = "".join(re.escape(c) for c in mapping())
    return re.compile(rf"(?:[^\W_]|[{_MARKS}­​-‏⁠-⁤﻿])+|.[{_MARKS}]+|[{singles}]", re.S), re.compile(rf".[{_MARKS}]*", re.S)


@lru_cache(1)
def _triggers() -> frozenset[str]:
    marks = [*range(0x300, 0x370), *range(0x483, 0x488), *range(0x1AB0, 0x1B00), *range(0x1DC0, 0x1E00), *range(0x20D0, 0x2100), *range(0xFE20, 0xFE30)]
    return frozenset([*mapping(), *map(chr, marks)])


def has_clusters(text: str) -> bool:
    """Whether a text holds anything that the cluster transducer changes."""
    return not text.isascii() and not _triggers().isdisjoint(text)


#: Java pattern of what can change at all: anything but plain characters, and letters of two scripts side by side.
CHANGEABLE_JAVA = (
    r"(?=[^\x{0}-\x{7F}])(?:[^\x{0}-\x{7F}\x{A1}-\x{A9}\x{AB}\x{AC}\x{AE}-\x{B1}\x{B4}\x{B6}\x{B7}\x{BB}\x{BF}-\x{131}\x{134}-\x{13E}\x{141}-\x{148}\x{14A}-\x{17E}\x{370}-\x{3CF}\x{400}-\x{482}\x{48A}-\x{4FF}\x{2010}-\x{2027}\x{20AC}]"
    r"|(?<=\p{IsLatin}\p{Nd}{0,3})[\p{L}&&[^\p{IsLatin}]]|[\p{L}&&[^\p{IsLatin}]](?=\p{Nd}*\p{IsLatin})|(?<=[\p{IsGreek}])\p{IsCyrillic}|\p{IsCyrillic}(?=\p{IsGreek}))"
)


def changeable(value: Column) -> Column:
    """Whether a value may have another plain form."""
    return value.rlike(CHANGEABLE_JAVA)


def _one_script(word: str) -> tuple[str, bool]:
    """(word with its look-alikes in one script, whether its letters were of more than one script)."""
    scripts = [s for s in map(_script, word) if s]
    present = set(scripts)
    if len(present) < 2:
        return word, False
    # ties and words of many scripts go to the script whose letters can't be look-alikes, else to Latin
    tables = _to_script()
    fixed = {s: sum(1 for c in word if _script(c) == s and all(c not in tables.get(t, ()) for t in present if t != s)) for s in present}
    target = max(sorted(present), key=lambda s: (fixed[s], scripts.count(s), s == "L"))
    return "".join(tables.get(target, {}).get(c, c) if _script(c) != target else c for c in word), True


def plain(text: str) -> tuple[str, bool]:
    """(the one form of a text, whether it holds a case of this problem)."""
    if text.isascii():
        return text, False
    (words, clusters), run, found = _compiled(), transducer(), False
    triggers = _triggers()

    def word(m: re.Match) -> str:
        nonlocal found
        out = m[0]
        if out.isascii():
            return out
        if not triggers.isdisjoint(out):
            found = True
            out = "".join(map(run.cluster, clusters.findall(out)))
        out, mixed = _one_script(out)
        found |= mixed
        return out

    return words.sub(word, text), found


def unify_fields(rows: DataFrame, key: str, fields: tuple[str, ...], dictionaries: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """(key, field, text, plain) of every value that holds a case and isn't garbled by a wrong encoding, distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(dictionaries)
        for batch in batches:
            out = []
            for i, f, t in zip(*(batch.column(j).to_pylist() for j in range(3))):
                form, found = plain(t)
                if found and not restorer.restore(t)[1]:
                    out.append((i, f, t, form))
            ids, names, texts, forms = zip(*out) if out else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(forms, pa.string())], names=[key, "field", "text", "plain"])

    cells = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields)))
    judged = rows.select(key, cells.alias("c")).select(key, "c.field", "c.text").where(F.col("text").isNotNull() & changeable(F.col("text")))
    return judged.mapInArrow(run, f"{key} bigint, field string, text string, plain string").distinct()


def p7_plain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every affected title and source name with its one form."""
    items = table(spark, sf_dir, "items")
    return unify_fields(items, "id", FIELDS, fit_dictionaries(items))


def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, field) of every value with characters that only look the same."""
    return p7_plain(spark, sf_dir).select("id", "field").distinct()
