"""Compares a registered query with its DuckDB SQL: columns by name, rows as a multiset of normalised values."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def norm(v):
    """One comparable form of a value."""
    if isinstance(v, float):
        return "nan" if v != v else f"{v:.6g}"
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(norm(x)) for x in v) + "]"
    if hasattr(v, "item"):
        return norm(v.item())
    if isinstance(v, bool) or v is None:
        return str(v)
    if hasattr(v, "as_tuple"):
        return f"{float(v):.6g}" if v != int(v) else str(int(v))
    return str(v)


def connect(sf_dir: str):
    """DuckDB with a view per table."""
    c = duckdb.connect()
    for p in Path(sf_dir).glob("*.parquet"):
        c.execute(f"create view {p.stem} as select * from '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return c


def compare(df, sql: str, sf_dir: str) -> str:
    """Empty if equal, else what differs."""
    cur = connect(sf_dir).execute(sql)
    names = [d[0] for d in cur.description]
    theirs = cur.fetchall()
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    cols = sorted(names)
    at = [names.index(c) for c in cols]
    a = Counter(tuple(norm(r[c]) for c in cols) for r in df.collect())
    b = Counter(tuple(norm(r[i]) for i in at) for r in theirs)
    if a != b:
        return f"{sum(a.values())} against {sum(b.values())} rows; only here {list((a - b).items())[:2]}; only there {list((b - a).items())[:2]}"
    return ""
