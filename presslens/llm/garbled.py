"""Problem 1, text decoded with the wrong character encoding: repair by minimum description length.

A wrong reading is undone by a chain of steps, each encoding with the codec of the wrong reading and decoding with
the right one. Every chain that a text allows, on its suspicious words or on the whole of it, gives a candidate. All
candidates are compressed with one zstandard dictionary per language; the cheapest description, compressed length
plus the cost of the chain, wins, and the text stays as it is unless a chain beats it. Replacement characters are
damage that nothing undoes: such a value is found and only its recoverable words are restored.

A regular expression in the JVM passes on only values with a pair of characters that reads as a multi-byte sequence
under some codec, a character that no language of the corpus writes, or a letter or sign that a single-byte mix-up may
have brought in. Of the last kind only those are judged whose letter or sign stands where the dictionaries don't have
it (after and before other characters), or that have a capital after a small letter. The dictionaries come from a bounded
sample (``SAMPLE_ROWS`` labelled rows of each language, smallest hashes first); every value of every row is judged.
Null and empty values are no cases; repeated rows give one case; without any labelled row, plain compression decides.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from presslens.session import table

SAMPLE_ROWS = 500
LANGUAGES = ("en", "de", "fr", "es", "it", "pt", "sv", "nl", "pl", "fi", "el")
FIELDS = ("title", "summary", "source_name")

#: Codecs under which UTF-8 was wrongly read, and pairs (wrong, right) of single-byte codecs.
WIDE = ("cp1252", "iso8859-15", "mac-roman", "cp1250", "cp1251", "cp1253", "cp850", "cp437", "iso8859-2", "iso8859-7")
NARROW = [(w, r) for w in ("cp1252", "mac-roman", "cp850", "cp437", "cp1251", "cp1250") for r in ("cp1252", "cp1250", "cp1253", "iso8859-2") if w != r]
#: Description length in bytes of naming a step of either kind.
COST_WIDE, COST_NARROW, COST_LOSS = 1.0, 2.0, 3.0
#: Description length of a character that a chain brings in and no language of the corpus writes.
COST_FOREIGN = 4.0
#: Description length of a letter or sign in a place where the dictionaries don't have it.
COST_ODD = 4.5
#: Sentences of the dictionaries that must have a letter or sign between the same neighbours for it to be usual there, and
#: the largest share of places met in one sentence only (so often a place not met is a usual one) with which places count.
USUAL_PLACE, SINGLE_PLACES = 3, 0.02

# The letters beyond ASCII that the eleven languages write, and common signs.
LETTERS = "áàâäãåæçéèêëíìîïñóòôöõøœúùûüßýąćęłńśźżÁÀÂÄÃÅÆÇÉÈÊËÍÌÎÏÑÓÒÔÖÕØŒÚÙÛÜÝĄĆĘŁŃŚŹŻΪΫΆΈΉΊΌΎΏΐΰϊϋάέήίόύώ"
SIGNS = "–—’‘“”„…«»€§°·ºª¡¿£"


@lru_cache(None)
def _bytes_of(codec: str) -> dict[str, int]:
    """Character to byte; bytes that a codec leaves undefined stand for the control of the same number."""
    out = {}
    for b in range(256):
        try:
            out[bytes([b]).decode(codec)] = b
        except UnicodeDecodeError:
            out.setdefault(chr(b), b)
    if codec == "cp1252":  # the same text may have been read as ISO 8859-1
        out |= {chr(b): b for b in range(128, 160)}
    return out


def _encode(text: str, codec: str) -> bytes | None:
    table_ = _bytes_of(codec)
    try:
        return bytes([table_[c] for c in text])
    except KeyError:
        return None


def _pairs() -> list[tuple[str, str]]:
    """Per codec, first and later characters of split sequences; pairs with a foreign character are told by that alone."""
    usual = set(LETTERS + SIGNS) | set(map(chr, [*range(0x391, 0x3AA), *range(0x3B1, 0x3CA)]))
    out = []
    for codec in WIDE:
        lead = "".join(c for c, b in _bytes_of(codec).items() if 0xC2 <= b <= 0xF4 and c in usual)
        follow = "".join(c for c, b in _bytes_of(codec).items() if 0x80 <= b <= 0xBF and c in usual)
        if lead and follow:
            out.append((lead, follow))
    return out


def _class(chars: str, java: bool) -> str:
    return "".join(rf"\x{{{ord(c):X}}}" if java else re.escape(c) for c in sorted(set(chars)))


def _patterns(java: bool) -> str:
    pairs = "|".join(f"[{_class(a, java)}][{_class(b, java)}]" for a, b in _pairs())
    greek = r"\x{391}-\x{3A9}\x{3B1}-\x{3C9}" if java else "Α-Ωα-ω"
    ascii_ = r"\x{0}-\x{7F}" if java else "\x00-\x7f"
    latin = r"\x{A1}-\x{FF}" if java else "¡-ÿ"
    # The look-ahead spares plain characters the long classes.
    return rf"(?=[^{ascii_}])(?:[^{ascii_}{greek}{_class(LETTERS + SIGNS, java)}]|{pairs}|[{latin}]{{3}})"


#: What a value must contain to be judged at all; tests hold that it loses no restorable value.
SUSPICIOUS_JAVA = _patterns(java=True)
_SUSPICIOUS = re.compile(_patterns(java=False))
#: Signs that stand inside running text; the others and all Latin letters beyond ASCII are passed on wherever they are.
_QUOTES = "–—‘“”…«»"
_LATIN = "".join(c for c in LETTERS if c < "\u0370")
_ODD_SIGNS = "".join(c for c in SIGNS if c not in _QUOTES + "’")
#: What a value must contain that a single-byte mix-up may have changed to usual letters and signs.
MIXED_UP_JAVA = rf"(?=[^\x{{0}}-\x{{7F}}])(?:[{_class(_LATIN + _ODD_SIGNS, java=True)}]|(?<=\p{{L}})[{_class(_QUOTES, java=True)}]\p{{L}}|(?<=[A-Za-z])[\x{{370}}-\x{{3FF}}]|[\x{{370}}-\x{{3FF}}][A-Za-z])"
_SENTENCE = re.compile(r"[.!?]\s+|\n")
_PLACED = re.compile(f"[{_class(_LATIN + SIGNS, java=False)}]")
_CAPITAL_INSIDE = re.compile(f"[a-z{_class(''.join(c for c in _LATIN if c.islower()), java=False)}][{_class(''.join(c for c in _LATIN if c.isupper()), java=False)}]")
_FOREIGN = re.compile(_patterns(java=False).split("]|", 1)[0].split("(?:", 1)[1] + "]")
_SIGN_KINDS = ("So", "Sm", "Sc", "Sk", "Po", "No", "Lm", "Cc", "Pc", "Pe", "Ps")
_MIXED = re.compile(r"[A-Za-zÀ-ɏ][\u0370-\u04ff]|[\u0370-\u04ff][A-Za-zÀ-ɏ]")
#: Rows with these stay out of the dictionaries: foreign characters, and the usual first halves of split characters.
_UNCLEAN_JAVA = SUSPICIOUS_JAVA.split("]|", 1)[0] + r"]|[ÂÃÎÏÄÅĂРС][^\x{0}-\x{7F}])"
_LATIN_RUN = re.compile(r"[À-ÿ]{2}")
_ALL_LATIN = re.compile(r"[^\w\s]*[À-ÿ]{2,}[^\w\s]*$")


def suspicious(value: Column) -> Column:
    """Whether a value may be garbled."""
    return value.rlike(SUSPICIOUS_JAVA) | value.rlike(MIXED_UP_JAVA)


@lru_cache(20_000)
def _place(three: str) -> str:
    """A character with its neighbours: of a letter the letters beside it, of a sign only their kinds."""
    if three[1].isalpha():
        return "".join(c if c.isalpha() else " " for c in three)
    return "".join(c if i == 1 else "a" if c.isalpha() else " " if c.isspace() else "." for i, c in enumerate(three))


def places(text: str) -> Iterator[str]:
    """Where the letters and signs beyond ASCII of a text stand, without regard to case; a cut and what it ends are left out.

    A small letter at the end of the text may stand before a cut without mark.
    """
    low, last = f" {text.lower()} ", len(text) if text[-1:].islower() else -1
    return (_place(low[m.start() - 1 : m.start() + 2]) for m in _PLACED.finditer(low) if m[0] != "…" and low[m.end()] not in ".…" and m.start() != last)


class Restorer:
    """Judges texts with the dictionaries of all languages."""

    def __init__(self, dictionaries: dict[str, bytes]):
        self.packers, self.known = [], {}
        seen = Counter(p for content in dictionaries.values() for part in dict.fromkeys(_SENTENCE.split(content.decode("utf-8", "replace"))) for p in places(part))
        enough = sum(n == 1 for n in seen.values()) <= SINGLE_PLACES * sum(seen.values())
        self.usual = {p for p, n in seen.items() if n >= USUAL_PLACE} if enough else set()
        for content in dictionaries.values():
            if len(content) >= 8:
                d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
                d.precompute_compress(level=3)
                self.packers.append(zstandard.ZstdCompressor(dict_data=d, write_content_size=False, write_checksum=False))
        self.packers = self.packers or [zstandard.ZstdCompressor(level=3, write_content_size=False)]

    def length(self, text: str) -> int:
        """Shortest compressed form over the languages."""
        raw = text.encode("utf-8", "surrogatepass")
        return min(len(p.compress(raw)) for p in self.packers)

    @staticmethod
    def foreign(out: str, text: str | None = None) -> float:
        """Cost of foreign signs; of a repaired ``out`` also of foreign letters and mixed scripts that ``text`` doesn't have.

        Look-alike letters, marks and invisible characters of the text itself are another problem and cost nothing.
        """
        signs = [c for c in _FOREIGN.findall(out) if c != "\ufffd"]
        count = sum(unicodedata.category(c) in _SIGN_KINDS for c in signs)
        if text is not None:
            count += sum(c not in text for c in signs if unicodedata.category(c) not in _SIGN_KINDS) + len(_MIXED.findall(out))
        return COST_FOREIGN * count

    def odd(self, text: str) -> int:
        """How many usual letters and signs stand where no language writes them; with few texts known only capitals tell."""
        if text.isascii():
            return 0
        return sum(p not in self.usual for p in places(text)) if self.usual else len(_CAPITAL_INSIDE.findall(text))

    def doubtful(self, text: str) -> bool:
        """Whether a single-byte mix-up may have changed letters to usual ones."""
        return bool(self.odd(text) or _MIXED.search(text))

    def price(self, out: str, text: str | None = None) -> float:
        """Description length of a text, as a repair of ``text`` if that is given; foreign characters only come from foreign ones."""
        if text is not None and _FOREIGN.search(out) and not _FOREIGN.search(text):
            return 1e9
        return self.length(out) + self.foreign(out, text) + COST_ODD * self.odd(out)

    def steps(self, text: str) -> Iterator[tuple[str, float]]:
        """Every text that one step of a chain can lead to, with the step's cost."""
        clean = False
        for codec in WIDE:
            raw = _encode(text, codec)
            if raw is None:
                continue
            try:
                out, cost = raw.decode("utf-8"), COST_WIDE
            except UnicodeDecodeError:
                out = raw.decode("utf-8", "replace")
                cost = COST_WIDE + COST_LOSS * out.count("�")
                if 2 * out.count("�") > sum(ord(c) > 127 for c in out):
                    continue
            if out != text:
                clean |= cost == COST_WIDE
                yield out, cost
        if clean or not (_FOREIGN.search(text) or _LATIN_RUN.search(text) or self.doubtful(text + " ")):
            return  # a text that reads as split sequences throughout, or has no sign of a single-byte mix-up
        for wrong, right in NARROW:
            raw = _encode(text, wrong)
            if raw is None:
                continue
            try:
                out = raw.decode(right)
            except UnicodeDecodeError:
                continue
            if out != text and not any("\x80" <= c < "\xa0" for c in out):
                yield out, COST_NARROW

    def chains(self, text: str) -> dict[str, float]:
        """Texts that chains of up to three steps lead to, each with its cheapest cost."""
        found: dict[str, float] = {}
        level = {text: 0.0}
        for depth in range(3):
            nxt: dict[str, float] = {}
            for t, c in level.items():
                for out, cost in self.steps(t):
                    if depth and cost != COST_WIDE:
                        continue  # only clean multi-byte steps are ever repeated
                    if out != text and c + cost < found.get(out, 1e9):
                        found[out] = nxt[out] = c + cost
            level = {t: c for t, c in nxt.items() if _SUSPICIOUS.search(t)}
            if not level:
                break
        return found

    def restore(self, text: str) -> tuple[str, bool]:
        """(text as the source wrote it as far as it can be told, whether it was garbled)."""
        if (known := self.known.get(text)) is None:
            if len(self.known) >= 20_000:  # a memory bound; names of sources come again and again
                self.known.clear()
            known = self.known[text] = self._restore(text)
        return known

    def _restore(self, text: str) -> tuple[str, bool]:
        damaged = "�" in text
        if not (_SUSPICIOUS.search(text) or self.doubtful(text)):
            return text, damaged
        parts = re.split(r"( )", text)
        flagged = [i for i, p in enumerate(parts) if "�" not in p and any(map(str.isalpha, p)) and (_SUSPICIOUS.search(p) or _ALL_LATIN.match(p) or self.doubtful(p + " "))]
        if not flagged:
            return text, damaged
        best, least = text, self.price(text)
        candidates: dict[str, float] = dict(self.chains(text)) if not damaged else {}
        joined = " ".join(parts[i] for i in flagged)
        for out, cost in self.chains(joined).items():
            words = out.split(" ")
            if len(words) == len(flagged):
                copy = parts.copy()
                for i, w in zip(flagged, words):
                    copy[i] = w
                whole = "".join(copy)
                candidates[whole] = min(cost, candidates.get(whole, 1e9))
        for out, cost in candidates.items():
            total = self.price(out, text) + cost
            if total < least:
                best, least = out, total
        if len(flagged) > 1 and (best == text or best.count("�") > text.count("�") or _SUSPICIOUS.search(best)):
            # words damaged in different ways, or some of them not at all, are judged one by one
            now, spent = self.price(text), 0.0
            for i in flagged:
                options = []
                for out, cost in self.chains(parts[i]).items():
                    whole = "".join(parts[:i] + [out] + parts[i + 1 :])
                    options.append((self.price(whole, text) + cost + spent, cost, out))
                if options and min(options)[0] < now:
                    now, cost, parts[i] = min(options)
                    spent += cost
            if now < least:
                best, least = "".join(parts), now
        return best, damaged or best != text


@lru_cache(2)
def _restorer(packed: tuple[tuple[str, bytes], ...]) -> Restorer:
    return Restorer(dict(packed))


def labelled_sample(items: DataFrame, rows: int, *columns: str) -> DataFrame:
    """At most ``rows`` labelled rows of each language: those whose ids have the smallest hashes.

    A count per language gives the share of hashes that holds about twice as many rows as are due, which the scan
    then tests; so no task meets more than that of a language, however large the table is and whatever its languages'
    shares are. A language of which chance leaves too few under its threshold just has a smaller sample.
    """
    h = F.xxhash64("id")
    labelled = items.where(F.col("lang").isin(*LANGUAGES) & F.col("id").isNotNull())
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # one row a language
    least, space = -(2**63), 2**64
    under = F.lit(False)
    for lang, n in sorted(counts.items()):
        share = min(1.0, (2 * rows + 100) / n)
        under = under | ((F.col("lang") == lang) & (h <= F.lit(min(2**63 - 1, least + int(share * space)))))
    ranked = labelled.where(under).select("lang", *columns, h.alias("h")).withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", *columns)))
    return ranked.where(F.col("n") <= rows)


def fit_dictionaries(items: DataFrame, rows: int = SAMPLE_ROWS) -> tuple[tuple[str, bytes], ...]:
    """Dictionary content of each language from its sample of ``rows`` labelled rows, without the unclean ones."""
    text = F.concat_ws("\n", "summary", "title", "source_name").alias("text")
    sample = labelled_sample(items.select("id", "lang", text), rows, "text").where(~F.col("text").rlike(_UNCLEAN_JAVA))
    by: dict[str, list[str]] = {}
    for r in sorted(sample.select("lang", "n", "text").collect()):
        by.setdefault(r[0], []).append(r[2])
    return tuple((k, "\n".join(dict.fromkeys(v)).encode("utf-8", "replace")) for k, v in sorted(by.items()))


def restore_fields(rows: DataFrame, key: str, fields: tuple[str, ...], dictionaries: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """(key, field, text, restored) of every garbled value of the fields, distinct."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(dictionaries)
        for batch in batches:
            ids, names, texts, outs = [], [], [], []
            for i, f, t in zip(*(batch.column(j).to_pylist() for j in range(3))):
                out, garbled = restorer.restore(t)
                if garbled:
                    ids.append(i)
                    names.append(f)
                    texts.append(t)
                    outs.append(out)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(names, pa.string()), pa.array(texts, pa.string()), pa.array(outs, pa.string())], names=[key, "field", "text", "restored"])

    cells = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).alias("text")) for f in fields)))
    judged = rows.select(key, *fields).select(key, cells.alias("c")).select(key, "c.field", "c.text").where(F.col("text").isNotNull() & suspicious(F.col("text")))
    return judged.mapInArrow(run, f"{key} bigint, field string, text string, restored string").distinct()


def p1_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every garbled value of items with the text that the source wrote as far as it can be recovered."""
    items = table(spark, sf_dir, "items")
    return restore_fields(items, "id", FIELDS, fit_dictionaries(items))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, field) of every value with text in the wrong encoding."""
    return p1_restored(spark, sf_dir).select("id", "field").distinct()
