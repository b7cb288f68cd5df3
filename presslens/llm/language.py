"""Problem 5, missing or wrong document language labels: a byte convolutional network over fixed-length windows.

Title and summary fall into stretches at sentence ends. Each stretch is cut into windows of ``WINDOW`` bytes; the
network embeds the bytes, applies filters of several widths, keeps each filter's maximum over the window and feeds a
softmax. Log probabilities of a stretch's windows are added, so every byte of every text counts. A stretch too short
to judge takes the language of the one before it (or after it) in its field.

The network is trained in numpy on stretches of a bounded sample of labelled rows (``SAMPLE_ROWS`` a language, the
smallest hashes); labels are dirty, so rows that a first fit contradicts are left out of the final one. Texts read
in the wrong encoding are restored before they are judged. Null, empty and unreadable texts have no stretch and give
no row; repeated rows give one result; without labelled rows nothing can be told and no row comes out.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.llm.garbled import LANGUAGES, Restorer, _restorer, fit_dictionaries, labelled_sample
from presslens.llm.lookalikes import has_clusters, plain
from presslens.session import table

SAMPLE_ROWS = 400
WINDOW = 96
EMBED, WIDTHS, FILTERS = 8, (2, 3, 4, 5), 20
#: Letters of lower-case words that a stretch must have to be judged by itself, and to bring in a second language.
LEAST_LETTERS, SECOND_LETTERS, SECOND_CONFIDENCE = 6, 16, 0.8
#: Confidence with which a shorter or damaged stretch brings in a second language that the label doesn't name.
SHORT_CONFIDENCE = 0.99

# Other notations of the languages, and labels that name none.
NOTATIONS = {
    "en": "eng english", "de": "deu ger german", "fr": "fra fre french", "es": "spa spanish", "it": "ita italian", "pt": "por portuguese",
    "sv": "swe swedish", "nl": "nld dut dutch", "pl": "pol polish", "fi": "fin finnish", "el": "ell gre gr greek",
}
NO_LANGUAGE = ("", "--", "-", "und", "unknown", "xx", "xxx", "zxx", "mul", "mis", "none", "null", "n/a", "na", "?")

_STRETCH = re.compile(r"[^.!?…]*(?:[.!?…]+(?!\s|$)[^.!?…]*)*(?:[.!?…]+|$)\s*")
_LOWER = re.compile(r"(?<![\w’'])[^\W\d_]+")
_SHOUT = re.compile(r"[A-ZÀ-ÞĄĆĘŁŃŚŹŻΑ-Ϋ]{3,}|(?<=[A-ZÀ-Þ]\s)[A-ZÀ-Þ]{1,2}(?=\s[A-ZÀ-Þ])")


def stretches(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences of a text; together they are the text."""
    return [m.span() for m in _STRETCH.finditer(text) if m.end() > m.start()]


def evidence(part: str) -> int:
    """Letters in words that aren't capitalised; names and other capitalised words tell no language."""
    return sum(len(w) for w in _LOWER.findall(part) if not w[0].isupper())


def _windows(parts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(windows x WINDOW bytes, index of the part of each window)."""
    rows, owner = [], []
    for i, p in enumerate(parts):
        raw = p.encode("utf-8", "replace")
        for at in range(0, max(1, len(raw)), WINDOW):
            piece = raw[max(0, min(at, len(raw) - WINDOW)) : at + WINDOW]  # the last window reaches back to be full
            rows.append(piece.ljust(WINDOW, b"\0"))
            owner.append(i)
    return np.frombuffer(b"".join(rows), np.uint8).reshape(-1, WINDOW), np.array(owner)


def _readable(text: str | None, restorer: Restorer) -> str | None:
    """A text as the source wrote it, in its one form."""
    if not text or text.isascii():
        return text
    text = restorer.restore(text)[0]
    return plain(text)[0] if has_clusters(text) else text


class Network:
    """Embedding, filters of several widths in one kernel of the greatest width, max pooling, softmax."""

    def __init__(self, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.wide, self.count = max(WIDTHS), FILTERS * len(WIDTHS)
        self.mask = np.concatenate([np.repeat((np.arange(self.wide) < w)[:, None], FILTERS, axis=1) for w in WIDTHS], axis=1).repeat(EMBED, axis=0).astype(np.float32)
        self.p = {
            "embed": rng.normal(0, 0.5, (256, EMBED)).astype(np.float32),
            "kernel": (rng.normal(0, 1, (self.wide * EMBED, self.count)) / np.sqrt(EMBED * np.repeat(WIDTHS, FILTERS))).astype(np.float32) * self.mask,
            "bias": np.zeros(self.count, np.float32),
            "out": rng.normal(0, 0.1, (self.count, len(LANGUAGES))).astype(np.float32),
            "prior": np.zeros(len(LANGUAGES), np.float32),
        }

    def pool(self, x: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Maximum of every filter over each window, and its position."""
        e = self.p["embed"][x].reshape(len(x), -1)
        n = WINDOW - self.wide + 1
        columns = np.lib.stride_tricks.sliding_window_view(e, self.wide * EMBED, axis=1)[:, :: EMBED][:, :n]
        act = (np.ascontiguousarray(columns).reshape(-1, self.wide * EMBED) @ self.p["kernel"]).reshape(len(x), n, self.count)
        return np.maximum(act.max(1) + self.p["bias"], 0), act.argmax(1) if where else None

    def log_probabilities(self, x: np.ndarray) -> np.ndarray:
        """Log probability of every language for every window."""
        parts = []
        for lo in range(0, len(x), 256):
            z = self.pool(x[lo : lo + 256])[0] @ self.p["out"] + self.p["prior"]
            z -= z.max(1, keepdims=True)
            parts.append(z - np.log(np.exp(z).sum(1, keepdims=True)))
        return np.concatenate(parts) if parts else np.zeros((0, len(LANGUAGES)), np.float32)

    def train(self, x: np.ndarray, y: np.ndarray, epochs: int, rate: float = 0.004, seed: int = 5) -> None:
        """Adam on the cross entropy; only the positions that won the pooling pass gradients on."""
        rng = np.random.default_rng(seed)
        moment = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in self.p.items()}
        t = 0
        offsets = np.arange(self.wide)
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for lo in range(0, len(x), 64):
                rows = order[lo : lo + 64]
                b = x[rows]
                h, at = self.pool(b, where=True)
                z = h @ self.p["out"] + self.p["prior"]
                q = np.exp(z - z.max(1, keepdims=True))
                q /= q.sum(1, keepdims=True)
                q[np.arange(len(b)), y[rows]] -= 1
                q /= len(b)
                dh = (q @ self.p["out"].T) * (h > 0)
                byte = b[np.arange(len(b))[:, None, None], at[:, :, None] + offsets]  # rows x filters x width
                seen = self.p["embed"][byte].reshape(len(b), self.count, -1)
                kernel = np.einsum("nfk,nf->kf", seen, dh, optimize=True) * self.mask
                back = dh[:, :, None] * self.p["kernel"].T[None]
                flat, back = byte.reshape(-1), back.reshape(-1, EMBED)
                embed = np.stack([np.bincount(flat, weights=back[:, d], minlength=256) for d in range(EMBED)], axis=1).astype(np.float32)
                grads = {"embed": embed, "kernel": kernel, "bias": dh.sum(0), "out": h.T @ q, "prior": q.sum(0)}
                t += 1
                for k, g in grads.items():
                    m, v = moment[k]
                    m += 0.1 * (g - m)
                    v += 0.001 * (g * g - v)
                    self.p[k] -= (rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)).astype(np.float32)


def _prepare(part: str) -> str:
    """Words in capitals become lower case, as the network knows running text."""
    return _SHOUT.sub(lambda m: m[0].lower(), part)


def fit(labelled: list[tuple[str, str, str]]) -> Network | None:
    """Train on (lang, title, summary) rows; None without any."""
    parts, y = [], []
    for lang, title, summary in labelled:
        for text in (title, summary):
            for a, b in stretches(text or ""):
                part = text[a:b].strip()
                if evidence(part) >= SECOND_LETTERS or part.isupper():
                    parts.append(_prepare(part))
                    y.append(LANGUAGES.index(lang))
    if not parts:
        return None
    x, owner = _windows(parts)
    y = np.array(y)[owner]
    first = Network()
    first.train(x, y, epochs=4)
    agreed = np.exp(first.log_probabilities(x)[np.arange(len(x)), y]) > 0.1
    first.train(x[agreed], y[agreed], epochs=5, rate=0.0015)
    return first


def judge(texts: list[tuple[str | None, ...]], network: Network) -> list[list[tuple[int, int, int, str, float, int]]]:
    """For each row of texts, its stretches as (field, start, end, lang, confidence, letters)."""
    keys, parts, letters = [], [], []
    for r, fields in enumerate(texts):
        for f, text in enumerate(fields):
            for a, b in stretches(text or ""):
                part = text[a:b].strip()
                keys.append((r, f, a, b))
                parts.append(_prepare(part))
                n = evidence(parts[-1])
                letters.append(min(n, SECOND_LETTERS - 1) if "\ufffd" in part else n)  # damage counts as a short stretch
    out: list[list[tuple[int, int, int, str, float, int]]] = [[] for _ in texts]
    if not parts:
        return out
    strong = [i for i, n in enumerate(letters) if n >= LEAST_LETTERS]
    x, owner = _windows([parts[i] for i in strong])
    score = np.zeros((len(parts), len(LANGUAGES)))
    np.add.at(score, np.array(strong, int)[owner] if strong else owner, network.log_probabilities(x))
    p = np.exp(score - score.max(1, keepdims=True))
    p /= p.sum(1, keepdims=True)
    best = p.argmax(1)
    judged = set(strong)
    for i, (r, f, a, b) in enumerate(keys):
        if i in judged:
            out[r].append((f, a, b, LANGUAGES[best[i]], float(p[i, best[i]]), letters[i]))
        else:
            out[r].append((f, a, b, "", 0.0, letters[i]))
    for row in out:
        for k, (f, a, b, lang, conf, n) in enumerate(row):
            if not lang:  # too short to judge: as its neighbour in the field, else as the row's first judged stretch
                near = [s for s in row[:k][::-1] + row[k + 1 :] if s[3] and s[0] == f] or [s for s in row if s[3]]
                if near:
                    row[k] = (f, a, b, near[0][3], near[0][4] * 0.5, 0)
    return out


def languages_of(row: list[tuple[int, int, int, str, float, int]], label: str | None = None) -> dict[str, float]:
    """Languages of a row of stretches with their confidence; the first is the one of most letters.

    A short stretch brings in a second language only where nothing else of its field is in the main one (a cut sentence
    tells little), and if it is surer than a long one or the row's label names the same.
    """
    weight: dict[str, float] = {}
    for _, _, _, lang, conf, n in row:
        if lang:
            weight[lang] = weight.get(lang, 0.0) + conf * n
    if not weight:
        return {}
    main = max(weight, key=lambda k: (weight[k], k))
    out = {main: max(c for _, _, _, lang, c, _ in row if lang == main)}
    in_main = {f for f, _, _, lang, _, n in row if lang == main and n}
    for f, _, _, lang, conf, n in row:
        least = SECOND_CONFIDENCE if n >= SECOND_LETTERS or lang == label else SHORT_CONFIDENCE
        if lang and lang != main and conf >= least and (n >= SECOND_LETTERS or n >= LEAST_LETTERS and f not in in_main):
            out[lang] = max(conf, out.get(lang, 0.0))
    return out


def _against(label: str | None, langs: dict[str, float]) -> list[str]:
    """Languages of a row, where a label stands against a single doubtful language."""
    if len(langs) == 1 and label in LANGUAGES and max(langs.values()) < SECOND_CONFIDENCE:
        return [label]
    return list(langs)


def normal_label(label: Column) -> Column:
    """The code of a label in any notation, null where it names no language, itself where it is another language."""
    v = F.lower(F.trim(label))
    short = F.regexp_extract(v, r"^([a-z]+)(?:[-_ ].*)?$", 1)
    out = F.when(v.isNull() | v.isin(*NO_LANGUAGE), F.lit(None))
    for code, others in NOTATIONS.items():
        out = out.when(short.isin(code, *others.split()), F.lit(code))
    return out.otherwise(v)


def fit_rows(items: DataFrame, rows: int = SAMPLE_ROWS) -> Network | None:
    """Fit on at most ``rows`` labelled rows of each language, those whose ids have the smallest hashes."""
    sample = labelled_sample(items.select("id", "lang", "title", "summary"), rows, "title", "summary")
    return fit([(r[0], r[1], r[2]) for r in sorted(sample.select("lang", "title", "summary", "h").collect(), key=lambda r: (r[3], r[0], r[1] or "", r[2] or ""))])


def identify(items: DataFrame, network: Network | None, dictionaries: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """(id, lang, confidence, is_main, segments) per row and language; segments of (field, start, end, lang, confidence)."""
    schema = "id bigint, lang string, confidence double, is_main boolean, segments array<struct<field:string,start:int,end:int,lang:string,confidence:double>>"
    arrow = pa.list_(pa.struct([("field", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string()), ("confidence", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(dictionaries)
        readable = lambda t: _readable(t, restorer)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                ids = batch.column(0).to_pylist()
                texts = [(readable(t), readable(s)) for t, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
                out = []
                for i, row in zip(ids, judge(texts, network)):
                    segments = [{"field": ("title", "summary")[f], "start": a, "end": b, "lang": lang, "confidence": c} for f, a, b, lang, c, _ in row if lang]
                    for k, (lang, conf) in enumerate(languages_of(row).items()):
                        out.append((i, lang, conf, k == 0, segments))
                cols = list(zip(*out)) if out else [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.float64()), pa.array(cols[3], pa.bool_()), pa.array(cols[4], arrow)], names=["id", "lang", "confidence", "is_main", "segments"])

    rows = items.select("id", "title", "summary")
    return rows.mapInArrow(run, schema) if network else rows.sparkSession.createDataFrame([], schema)


def p5_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main language, its confidence and the judged segments of every item that has a readable text."""
    items = table(spark, sf_dir, "items")
    return identify(items, fit_rows(items), fit_dictionaries(items)).where("is_main").drop("is_main").dropDuplicates(["id"])


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, lang): the true languages of items whose label is missing or wrong, or that mix languages."""
    items = table(spark, sf_dir, "items")
    judged = _identify_labelled(items, fit_rows(items), fit_dictionaries(items))
    return judged.where((F.col("n_langs") > 1) | F.col("label").isNull() | (F.col("label") != F.col("lang"))).select("id", "lang").distinct()


def _identify_labelled(items: DataFrame, network: Network | None, dictionaries: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """(id, label, lang, n_langs) per row and language, the label carried through so that nothing is joined back."""
    schema = "id bigint, label string, lang string, n_langs int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = _restorer(dictionaries)
        readable = lambda t: _readable(t, restorer)
        for whole in batches:
            for lo in range(0, whole.num_rows, 2000):
                batch = whole.slice(lo, 2000)
                texts = [(readable(t), readable(s)) for t, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
                found = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), judge(texts, network))
                out = [(i, label, lang, len(langs)) for i, label, row in found for langs in [languages_of(row, label)] for lang in _against(label, langs)]
                cols = list(zip(*out)) if out else [()] * 4
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.string(), pa.string(), pa.int32()))], names=["id", "label", "lang", "n_langs"])

    rows = items.select("id", normal_label(F.col("lang")).alias("label"), "title", "summary")
    return rows.mapInArrow(run, schema) if network else rows.sparkSession.createDataFrame([], schema)
