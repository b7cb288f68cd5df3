"""Timestamp notations: a table of cases, and random instants through every notation and back."""

from datetime import datetime, timedelta, timezone
from zoneinfo import ZoneInfo

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from presslens.functions.times import utc_micros

US = 1_000_000


def at(text: str) -> int:
    return int(datetime.fromisoformat(text).timestamp() * US)


CASES = [
    ("2026-03-29 02:30", "Europe/Berlin", False, at("2026-03-29T01:30:00+00:00")),  # skipped: the offset before
    ("2026-10-25 02:30:00", "Europe/Berlin", False, at("2026-10-25T00:30:00+00:00")),  # repeated: the first pass
    ("2026-11-01T01:30:00", "America/New_York", False, at("2026-11-01T05:30:00+00:00")),
    ("Mon, 15 Sep 2025 03:47:04 +0200", None, False, at("2025-09-15T01:47:04+00:00")),
    ("5 Sep 2025 21:08:33 CEST", None, False, at("2025-09-05T19:08:33+00:00")),
    ("09/23/2025 12:28 AM", "UTC", True, at("2025-09-23T00:28:00+00:00")),
    ("03/04/2026 10:00", "UTC", False, at("2026-04-03T10:00:00+00:00")),
    ("2025-09-15T06:58:18.311657+02:00", None, False, at("2025-09-15T04:58:18.311657+00:00")),
    ("2025-09-15T06:58:18.5Z", None, False, at("2025-09-15T06:58:18.500000+00:00")),
    ("20250915T151821Z", None, False, at("2025-09-15T15:18:21+00:00")),
    ("1757914844", None, False, 1757914844 * US),
    ("1757924251609", None, False, 1757924251609 * 1000),
    ("2025-09-15 10:00:00", "", False, at("2025-09-15T10:00:00+00:00")),
    ("31.11.2025 09:15", "UTC", False, None), ("2025-09-15", "UTC", False, None), ("Thu, 45 Foo 2026 10:00:00 GMT", None, False, None),
    ("2025-09-15T25:00:00", None, False, None), ("2025-09-15T10:61:00", None, False, None), ("13:00 PM", None, False, None),
    ("", None, False, None), (None, None, False, None), ("yesterday" * 5000, None, False, None),
]


def test_cases(spark):
    df = spark.createDataFrame([(i, v, z, us) for i, (v, z, us, _) in enumerate(CASES)], "i int, v string, z string, us boolean")
    got = {r[0]: r[1] for r in df.select("i", utc_micros(F.col("v"), F.col("z"), F.col("us"))).collect()}
    assert [(CASES[i][0], got[i]) for i in sorted(got)] == [(c[0], c[3]) for c in CASES]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 60 * 60 * 24 * 365 * 40), st.sampled_from(["Europe/London", "America/Sao_Paulo", "Asia/Kolkata"])), min_size=30, max_size=60))
def test_round_trip(spark, moments):
    rows = []
    for s, zone in moments:
        t = datetime(1995, 1, 1, tzinfo=timezone.utc) + timedelta(seconds=s)
        local = t.astimezone(ZoneInfo(zone))
        us = int(t.timestamp()) * US
        first = local.replace(fold=0).astimezone(timezone.utc) == t
        rows += [(t.strftime("%a, %d %b %Y %H:%M:%S GMT"), zone, us), (local.strftime("%Y-%m-%dT%H:%M:%S%z"), None, us), (t.strftime("%Y%m%dT%H%M%SZ"), zone, us)]
        if first:
            rows.append((local.strftime("%d %b %Y %H:%M:%S"), zone, us))
    df = spark.createDataFrame(rows, "v string, z string, want bigint")
    assert df.where(~utc_micros(F.col("v"), F.col("z")).eqNullSafe(F.col("want"))).collect() == []
