"""Problem 10, personal information inside free text: weak supervision over candidate spans.

Wide anchors (digits, at-signs, capitalised words) propose spans of five types. Labelling functions of three kinds,
patterns, gazetteers and contexts, vote for or against each span or abstain. Expectation maximisation over the votes
of a bounded sample of documents estimates how reliable every labeller is, with no labelled data; the posteriors
then train a logistic span classifier over votes and shape features, which decides every span of every document.

The sample is the ``SAMPLE_DOCS`` documents of smallest hash (the only bounded part: it fits 200 numbers); candidates
and decisions cover whole texts and values of any length. A context labeller looks for its cue in the line before a
span, at the distance its pattern states (at most 60 characters): that is what makes a cue one of the span. Priors stand in where the sample holds too few spans, so tiny and empty
tables work. Null and blank texts give no spans and come back unchanged; repeated rows give the same spans; of
overlapping spans the one of higher probability, then the longer, then the earlier wins. Rows are never shuffled
but for the final distinct of the short spans.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from presslens.session import table

SAMPLE_DOCS = 4_000
TYPES = ("name", "email", "phone", "id_number", "address")

# Common given names of the eleven languages (gazetteer).
GIVEN = set(
    """Adam Agnès Agnieszka Albert Alice Amélie Ana Anders André Andrea Andreas Anna Anne Antonio Astrid Barbara Beata Beatriz
    Bruno Camille Carlos Carmen Caroline Catarina Charles Charlotte Chiara Christian Clara Claire Dagmar Daniel David Diego Dimitris
    Eduardo Elena Eleni Elisabeth Emma Erik Eva Ewa Felix Fernando Francesca Francesco Francisco Frank Gabriel Giorgos Giovanni
    Giulia Greta Gustav Hanna Hannah Hans Helena Henrik Hugo Ines Ingrid Irene Isabel Jakub James Jan Javier Jean Johan Johanna
    John José João Jonas Julia Jürgen Kaisa Karin Karl Katarzyna Katerina Klaus Konstantinos Kristina Lars Laura Leon Linda Lucas
    Lucia Luis Łukasz Magnus Maja Manuel Marcel Marco Maria Marie Marta Martin Mateo Matti Michael Miguel Mikael Mónica Nadia Nicolas
    Nikos Nina Nora Olga Oskar Otto Päivi Pablo Paula Paulo Pavel Pedro Peter Petra Philippe Pierre Piotr Rafael Ricardo Robert Rosa
    Sandra Sara Sebastian Silvia Simon Sofia Søren Stefan Susanne Teresa Thomas Tiago Timo Tomas Tomasz Urban Ursula Vera Viktor
    Walter Willem Wolfgang Yannis Yvonne Zoë Zofia Åsa""".split()
)
COMPANY = r"(?:Group|Bistro|Bank|AB|SE|Oyj|Oy|Invest|Capital|Energia|Foods|Logistics|Ltd|Inc|GmbH|AG|SA|SpA|NV|BV|plc|LLC|Holding|Holdings|Partners|Foundation|Stiftung|Hotel|Café|Stadium|Bakery|Motors|Shop)"
PARTICLES = r"(?:von der|von|van der|van den|van|de la|de los|de|del|della|da|dos|di|af|zu|le|la)"

_CAP = r"[A-ZÀ-ÖØ-ÞĄĆĘŁŃŚŹŻΑ-ΫΆΈΉΊΌΎΏ]"
_CAPWORD = re.compile(rf"(?<!\w){_CAP}[\w’']+")
_NAME = re.compile(rf"{_CAP}[\w’']+(?:-{_CAP}\w+)?(?:\s{{1,2}}{_CAP}\.)*(?:\s{{1,2}}{PARTICLES}(?=\s))?\s{{1,2}}{_CAP}[\w’']+(?:-{_CAP}\w+)?")
_AT = re.compile(r"@|\s?[(\[{]\s?(?:at|@)\s?[)\]}]\s?|\s(?:at|AT)\s(?=[\w-]+\s(?:dot|DOT)\s)", re.I)
#: The part before the at-sign, matched on the reversed text from the sign back, so that it may have any length.
_LOCAL_BACK = re.compile(r"[\w+-]+(?:(?:\.|\s?[)\]}]\s?tod\s?[(\[{]\s?|\stod\s)[\w+-]+)*", re.I)
_DOMAIN = re.compile(r"[\w-]+(?:(?:\.|\s?[(\[{]\s?dot\s?[)\]}]\s?|\sdot\s)[\w-]+)+", re.I)
_RUN = re.compile(r"(?:\+|\(\+?|(?<![\w.]))\d(?:[\d()/.\-  ]{5,}\d|\d{6,})")
_ID = re.compile(r"(?<![\w-])(?:[A-Z]{6}\d\d[A-Z]\d\d[A-Z]\d{3}[A-Z]|\d{6}[-+A]\d{3}[A-Z0-9]|\d{8}-\d{4}|\d{3}([- ])\d\d\1\d{4}|\d{8}-?[A-Z]|\d{10,11})(?![\w-])")
_NUMBER = re.compile(r"(?<![\w.,/-])\d{1,4}[A-Za-z]?(?!\w)")

_STREET_END = r"(?:straße|strasse|str\.|weg|gasse|allee|platz|ufer|damm|gatan|vägen|gränd|torget|straat|plein|laan|gracht|kade|singel|katu|polku|tie|kuja|aukio)"
_BEFORE = re.compile(
    rf"(?<!\w)(?:(?:(?:Am|An der|Auf der|Im|Zum) )?{_CAP}\w*{_STREET_END}|{_CAP}\w+ (?:torg|gata|väg|katu|tie|allé)|(?:Calle|C/|Avda\.|Av\.|Pza\.|Avenida|Plaza|Paseo|Camino|Ronda|Via|Viale|Piazza|Corso|Largo|Vicolo|Rua|Travessa|Praça|Estrada|Alameda|ul\.|al\.|pl\.|os\.|Οδός|Οδό|Λεωφόρος|Λεωφόρο|Πλατεία|οδός|οδό|λεωφόρο) (?:(?:de la|de los|del|de|da|do|dos|di|della|dei) )?{_CAP}\w+(?: {_CAP}\w+)?),? (?:n[º°.] ?)?$"
)
_AFTER = re.compile(
    rf"(?:\s(?:bis|ter))?,?\s(?:(?:rue|boulevard|avenue|place|impasse|chemin|quai|allée|cours|route)\s(?:(?:de la|de l’|des|du|de|d’)\s?)?{_CAP}\w+|{_CAP}\w+(?:\s{_CAP}\w+)?\s(?:Street|Road|Lane|Close|Avenue|Drive|Square|Terrace|Court|Place|Way|Gardens|Crescent|St\.|Rd\.))"
)
_FLAT = re.compile(r"(?:\s?[A-Z](?![\w’'])|[/-]\d{1,4}[A-Z]?(?!\w)|\s(?:bis|ter)\b|,?\s(?:apt|apartment|flat|lgh|m\.|bst|Whg\.|App\.|int\.|bus|piso|διαμ\.)\s?\d+\w?)*", re.I)

_PHONE_CUE = re.compile(r"(?:tel|phone|call|mobil|cell|ring|puh|τηλ|ligue|llamada|number|numer|nummer|fax|kontakt|contact|desk by|unter|joignable|antaa|no\s?$|på\s?$|al\s?$|el\s?$|under\s?$)[^\n]{0,28}$", re.I)
_ID_CUE = re.compile(r"(?:\bID|PESEL|DNI|NIF|BSN|CPF|SSN|codice fiscale|personnummer|henkilötunnus|ausweis\w*|documento|identiteitsnummer|insurance reference|social security|identit\w*|ταυτότητας|ΑΦΜ|passport|pass\w*nummer|dowód\w*|born abroad)[^\n]{0,14}$", re.I)
_OTHER_CUE = re.compile(r"(?:ISIN|ISBN|ISSN|Org\.?\s?nr|Case|Invoice|Version|Turnover|Docket|KRS|HRB|SIREN|VAT|EIN|DOI|NIP|REGON|Y-tunnus|KvK|Reg\.|No\.|form|Ref\.?|order|file no|see|due|rose to)[^\n]{0,24}$", re.I)
_MONEY = re.compile(r"\s?(?:million|millones|millionen|miljoon|milhões|milioni|milionów|εκατομ|miljoen|miljoner|euro|EUR|USD|%|percent|sites)", re.I)
_NAME_CUE = re.compile(
    r"(?:\b(?:Dr|Dr\.|Me|Mr|Mrs|Ms|Herr|Frau|Sr|Sra|Kläger|Klägerin|Kantaja|Käranden|Eiser|Eiseres|Powód|Powódka|plaignant|plaignante|demandante|abogado|abogada|autor|autora|ricorrente|claimant|named|ενάγων|ενάγουσα|Signed|Signé|From|contact|Contact|Kontakt|Contatti|Contato|Contacto|Yhteyshenkilö|Επικοινωνία|Thanks to|antaa|podpisał|firmato|Υπογράφει ο|till|naar|para|Ring|c/o)[:,]?\s{1,2})$"
)
_TITLE = re.compile(r"(?:\b(?:Dr|Dr\.|Mr|Mrs|Ms|Herr|Frau|Kläger|Klägerin|Kantaja|Käranden|Eiser|Eiseres|Powód|Powódka|plaignant|plaignante|claimant|ενάγων|ενάγουσα|witness named)[:,]? )$")
_ADDRESS_CUE = re.compile(r"(?:lives|address|wohnt|mieszka|asuu|folkbokförd|woont|demeure|domicili|reside|risiede|mora|κατοικεί|Deliveries|Notificaciones|lists|osoitteessa|skickas|Bescheid)[^\n]{0,60}$", re.I)



def _shape(text: str) -> str:
    return re.sub(r"[a-z]+", "a", re.sub(r"[A-Z]", "A", re.sub(r"\d", "9", text)))


def _words_back(text: str, end: int, words: int = 9) -> int:
    """Where the last words before a place begin: as many as a street's name with its article and comma can have."""
    at = end - 1
    for _ in range(words):
        at = max(text.rfind(" ", 0, at), text.rfind("\n", 0, at))
        if at <= 0:
            return 0
    return at


def candidates(text: str) -> list[tuple[int, int, str, tuple[int, ...]]]:
    """(start, end, type, votes) of every span that may be personal information; 1 for, -1 against, 0 abstains."""
    found, backwards = [], None
    for m in _AT.finditer(text):
        domain = _DOMAIN.match(text, m.end())
        if not domain:
            continue
        backwards = backwards or text[::-1]
        local = _LOCAL_BACK.match(backwards, len(text) - m.start())
        if not local:
            continue
        a, b = len(text) - local.end(), domain.end()
        value = text[a:b]
        top = re.split(r"\W+", value.rstrip(")]} "))[-1]
        found.append((a, b, "email", (1, 1 if top.isalpha() and 2 <= len(top) <= 12 else -1, 1 if re.search(r"mail|post|κοιν|to |contact|scri|an |\bat |<|:|, ", text[max(0, a - 25) : a], re.I) else 0, -1 if a and text[a - 1] in "/@" else 0)))
    for m in _ID.finditer(text):
        a, b = m.span()
        before, value = text[max(0, a - 45) : a], m[0]
        cue, other = bool(_ID_CUE.search(before)), bool(_OTHER_CUE.search(before))
        typical = bool(re.fullmatch(r"[A-Z]{6}.*|.*[A-Z]|\d{8}-\d{4}|\d{3}[- ]\d\d[- ]\d{4}", value))
        phoney = value[0] == "0" and value.isdigit() or bool(_PHONE_CUE.search(before)) and not cue
        found.append((a, b, "id_number", (1 if cue else -1, -1 if other and not cue else 0, 1 if typical else 0, -1 if phoney else 0)))
    for m in _RUN.finditer(text):
        a, b = m.span()
        if text[a] == "(":  # an outer bracket that does not close around the first digits is punctuation
            close = text.find(")", a, b)
            if close < 0 or close - a > 5 or text[a + 1] == "+":
                a += 1
        if "(" in text[a:b] and text.count("(", a, b) != text.count(")", a, b):
            b = text.rfind("(", a, b) if text.count("(", a, b) > text.count(")", a, b) else text.find(")", a, b)
            b = a + len(text[a:b].rstrip(" ()/.-  "))
        value = text[a:b]
        digits = sum(map(str.isdigit, value))
        if not 7 <= digits <= 15:
            continue
        before = text[max(0, a - 45) : a]
        other = bool(_OTHER_CUE.search(before)) or bool(re.search(r"[A-Za-z]$", before))
        dated = bool(re.fullmatch(r"\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|[\d.]+\.\d", value)) and not re.fullmatch(r"\d{3}\.\d{3}\.\d{4}|\d\d(?:\.\d\d){4}", value)
        known = bool(re.fullmatch(r"\+\d[\d ()/-]+|0[\d ()/-]+\d|\(0?\d{2,4}\) ?[\d -]+|\d{3}[-. ]\d{3}[-. ]\d{4}|\d\d(?:[. ]\d\d){4}", value)) and 9 <= digits <= 14
        cue = bool(_PHONE_CUE.search(before))
        idish = bool(_ID_CUE.search(before)) or bool(re.match(r"[A-Z]|-[A-Z0-9]", text[b : b + 2]))
        found.append((a, b, "phone", (1 if known else -1, 1 if cue else 0, -1 if other else 0, -1 if dated or _MONEY.match(text, b) else 0, -1 if idish else 0)))
    for m in _NUMBER.finditer(text):
        a, b = m.span()
        before, after = _BEFORE.search(text, _words_back(text, a), a), None
        if before:
            a = before.start()
            b = _FLAT.match(text, b).end()
        elif after := _AFTER.match(text, b):
            b = after.end()
        else:
            continue
        found.append((a, b, "address", (1, 1 if _ADDRESS_CUE.search(text[max(0, a - 80) : a]) else 0, -1 if _MONEY.match(text, b) else 0)))
    taken = 0
    for m in _CAPWORD.finditer(text):
        a = m.start()
        if a < taken:
            continue
        first = m[0]
        given = first in GIVEN
        if not given:
            if not _TITLE.search(text, max(0, a - 24), a):  # an unknown given name needs a title before it
                continue
        n = _NAME.match(text, a)
        if not n:
            continue
        b = n.end()
        last = re.split(r"\s+", n[0])[-1]
        firm = bool(re.fullmatch(COMPANY, last)) or bool(re.match(rf"(?:\s|-){COMPANY}\b|\s(?:&|och|und|and)\s(?:Sons|Söhne|Co)\b", text[b : b + 16]))
        cue = bool(_NAME_CUE.search(text, max(0, a - 24), a))
        found.append((a, b, "name", (1 if given else -1, 1 if cue else 0, -1 if firm else 0, -1 if last in GIVEN and not given else 0)))
        taken = b if given else taken
    return found


#: How far each labeller is trusted before any data, in the order of its votes, and how many votes that trust weighs.
PRIORS = {"name": (0.9, 0.9, 0.99, 0.9), "email": (0.9, 0.85, 0.85, 0.85), "phone": (0.85, 0.85, 0.85, 0.85, 0.9), "id_number": (0.9, 0.9, 0.85, 0.85), "address": (0.9, 0.85, 0.9)}
PRIOR_WEIGHT = 50.0


def em_reliabilities(votes: np.ndarray, trust: tuple[float, ...], rounds: int = 25) -> tuple[np.ndarray, float, np.ndarray]:
    """(reliability of each labeller when it votes, prior of a true span, posterior of each span) by EM."""
    n, k = votes.shape
    accuracy, prior = np.array(trust), 0.5
    posterior = np.full(n, 0.5)
    for _ in range(rounds):
        weight = np.log(accuracy / (1 - accuracy))
        posterior = 1 / (1 + np.exp(-(votes @ weight + np.log(prior / (1 - prior)))))
        right = ((votes > 0) * posterior[:, None] + (votes < 0) * (1 - posterior)[:, None]).sum(0)
        accuracy = np.clip((right + np.array(trust) * PRIOR_WEIGHT) / ((votes != 0).sum(0) + PRIOR_WEIGHT), 2 * np.array(trust) - 1, 0.995)
        prior = float(np.clip((posterior.sum() + 5) / (n + 10), 0.2, 0.7))
    return accuracy, prior, posterior


def features(votes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Input of the span classifier: votes for, votes against, length."""
    return np.concatenate([np.ones((len(votes), 1)), votes > 0, votes < 0, np.minimum(lengths, 40)[:, None] / 40], axis=1).astype(float)


def fit(texts: list[str | None]) -> dict[str, np.ndarray]:
    """Weights of the span classifier of each type, trained on the posteriors of the labellers."""
    rows: dict[str, list[tuple[tuple[int, ...], int]]] = {t: [] for t in TYPES}
    for text in texts:
        for a, b, kind, votes in candidates(text or ""):
            rows[kind].append((votes, b - a))
    model = {}
    for kind in TYPES:
        votes = np.array([v for v, _ in rows[kind]], float).reshape(-1, len(PRIORS[kind]))
        accuracy, prior, posterior = em_reliabilities(votes, PRIORS[kind])
        x = features(votes, np.array([n for _, n in rows[kind]], float))
        # start from the labellers' log odds, so that without data the classifier is their weighted vote
        odds = np.log(accuracy / (1 - accuracy))
        start = np.concatenate([[np.log(prior / (1 - prior))], odds, -odds, [0.0]])
        w = start.copy()
        for _ in range(200 if len(x) else 0):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            w -= 0.5 * (x.T @ (p - posterior) / len(x) + 0.002 * (w - start))
        model[kind] = w
    return model


def spans(text: str | None, model: dict[str, np.ndarray]) -> list[tuple[int, int, str]]:
    """Accepted, non-overlapping spans of a text in order."""
    if not text:
        return []
    scored = []
    for a, b, kind, votes in candidates(text):
        w, k = model[kind], len(votes)
        score = w[0] + w[-1] * min(b - a, 40) / 40
        for i, v in enumerate(votes):
            score += w[1 + i] if v > 0 else w[1 + k + i] if v < 0 else 0.0
        if score > 0:
            scored.append((-score, a - b, a, b, kind))
    scored.sort()
    kept: list[tuple[int, int, str]] = []
    for _, _, a, b, kind in scored:
        if all(b <= x or a >= y for x, y, _ in kept):
            kept.append((a, b, kind))
    return sorted(kept)


def fit_sample(documents: DataFrame, sample: int = SAMPLE_DOCS) -> dict[str, np.ndarray]:
    """Fit on the ``sample`` documents whose ids have the smallest hashes; the bound keeps the driver's share fixed."""
    h = F.xxhash64("doc_id")
    ids = documents.select(h.alias("h")).orderBy("h").limit(sample).agg(F.max("h")).head()[0]
    texts = [r[0] for r in documents.where(h <= F.lit(ids)).orderBy(h).limit(sample).select("text").collect()] if ids is not None else []
    return fit(texts)


def find_personal(documents: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, pii_type, pii_text): each distinct value of each document as written."""
    model = fit_sample(documents, sample)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, kinds, values = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for kind, value in {(kind, text[a:b]) for a, b, kind in spans(text, model)}:
                    ids.append(key)
                    kinds.append(kind)
                    values.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["doc_id", "pii_type", "pii_text"])

    return documents.select("doc_id", "text").where(F.col("text").isNotNull()).mapInArrow(run, "doc_id bigint, pii_type string, pii_text string").distinct()


def redact(documents: DataFrame, sample: int = SAMPLE_DOCS) -> DataFrame:
    """(doc_id, text) with each span replaced by its type in brackets and all other text unchanged."""
    model = fit_sample(documents, sample)

    def clean(text: str | None) -> str | None:
        parts, last = [], 0
        for a, b, kind in spans(text, model):
            parts += [text[last:a], f"[{kind.upper()}]"]
            last = b
        return text if text is None else "".join(parts) + text[last:]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([clean(t) for t in batch.column(1).to_pylist()], pa.string())], names=["doc_id", "text"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, text string")


def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal values of every document."""
    return find_personal(table(spark, sf_dir, "documents"))


def p10_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with placeholders for its personal values."""
    return redact(table(spark, sf_dir, "documents"))
