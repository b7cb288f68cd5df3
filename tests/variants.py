"""Copies of a small test folder with every table emptied, nulled, doubled or widened by clashing columns."""

from __future__ import annotations

from pathlib import Path

import pyarrow as pa
import pyarrow.parquet as pq

KEYS = {"items": ["id"], "gdelt": ["gdelt_id"], "documents": ["doc_id"], "eval_items": ["eval_id"]}
CLASHING = ["field", "text", "period", "effect", "src", "utc_us", "row_id", "tz", "us", "k", "c", "w", "a", "b", "h", "n", "rec", "words", "batch", "gram", "kind", "bucket", "label", "marked", "len", "ids", "value", "shape", "n_langs", "restored", "plain", "segments", "pii_type", "eval_id", "key", "country_name", "confidence"]


def make(kind: str, source: str, target: Path) -> str:
    """Write the variant ``kind`` of the folder ``source``."""
    target.mkdir(parents=True, exist_ok=True)
    for p in Path(source).glob("*.parquet"):
        t = pq.read_table(p)
        if kind == "empty":
            t = t.slice(0, 0)
        elif kind == "nulls" and p.stem in KEYS:
            cols = [c if n in KEYS[p.stem] else pa.nulls(len(t), c.type) for n, c in zip(t.column_names, t.columns)]
            t = pa.table(dict(zip(t.column_names, cols)))
        elif kind == "doubled" and p.stem in KEYS:
            t = pa.concat_tables([t, t])
        elif kind == "wide":
            for c in CLASHING:
                if c not in t.column_names:
                    t = t.append_column(c, pa.array(["x"] * len(t)))
        pq.write_table(t, target / p.name)
    return str(target)


def rows(df) -> set:
    """Distinct rows in the order of the column names."""
    cols = sorted(df.columns)
    return {tuple(str(r[c]) for c in cols) for r in df.collect()}
