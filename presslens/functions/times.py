"""Problem 6: one instant in UTC out of many timestamp notations, entirely in JVM expressions.

An ordered cascade of anchored patterns rewrites a value to nine fields; the first pattern that fits decides. The
fields then go through ``try_make_timestamp`` with the zone of the value, or else the default zone of its source.

Policy: null, blank, unknown or impossible values (31 November, hour 25, unknown month, date without time) give
null. A local time that occurs twice means the first pass; one that is skipped takes the offset before the change.
Both are what ``java.time`` does, on which ``try_make_timestamp`` rests. Without a zone in the value and without a
default zone, UTC holds.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# English month abbreviations and the zone abbreviations with their offsets.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]
ZONES = {"Z": "UTC", "UTC": "UTC", "GMT": "UTC", "CET": "+01:00", "CEST": "+02:00", "EST": "-05:00", "EDT": "-04:00"}

_MON = "(" + "|".join(MONTHS) + ")[a-z]*"
_ZONE = r"(Z|UTC|GMT|CEST|CET|EST|EDT|[+-](?:0\d|1[0-4]):?[0-5]\d|[+-](?:0\d|1[0-4]))"
_HMS = r"(\d{1,2}):(\d\d)(?::(\d\d))?"

#: (name, pattern, rewrite to year|month|day|hour|minute|second|fraction|zone|half)
CASCADE = [
    ("iso", rf"^(\d{{4}})-(\d\d)-(\d\d)[T ](\d\d):(\d\d)(?::(\d\d)(?:[.,](\d{{1,9}}))?)? ?{_ZONE}?$", "$1|$2|$3|$4|$5|$6|$7|$8|"),
    ("compact", r"^(\d{4})(\d\d)(\d\d)T?(\d\d)(\d\d)(\d\d)(Z)?$", "$1|$2|$3|$4|$5|$6||$7|"),
    ("dotted", rf"^(\d{{1,2}})\.(\d{{1,2}})\.(\d{{4}}),? {_HMS} ?{_ZONE}?$", "$3|$2|$1|$4|$5|$6||$7|"),
    ("slashed", rf"^(\d{{1,2}})/(\d{{1,2}})/(\d{{4}}),? {_HMS}(?: ?([AP])M)?$", "$3|$2|$1|$4|$5|$6|||$7"),
    ("english", rf"^(?:(?:Mon|Tue|Wed|Thu|Fri|Sat|Sun),? )?(\d{{1,2}}) {_MON} (\d{{4}}),? {_HMS} ?{_ZONE}?$", "$3|$2|$1|$4|$5|$6||$7|"),
]
CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\+00:00$"


def utc_micros(value: Column, default_zone: Column | None = None, month_first: Column | None = None) -> Column:
    """Microseconds since 1970 UTC of a time string; null where it is unreadable."""
    v = F.trim(value)
    default_zone = F.lit("UTC") if default_zone is None else F.coalesce(F.nullif(default_zone, F.lit("")), F.lit("UTC"))
    month_first = F.lit(False) if month_first is None else F.coalesce(month_first, F.lit(False))
    fields = None
    for name, pattern, rewrite in CASCADE:
        if name == "slashed":
            day_first = F.regexp_replace(v, pattern, rewrite)
            written = F.when(month_first, F.regexp_replace(v, pattern, "$3|$1|$2|$4|$5|$6|||$7")).otherwise(day_first)
        else:
            written = F.regexp_replace(v, pattern, rewrite)
        fields = F.when(v.rlike(pattern), written) if fields is None else fields.when(v.rlike(pattern), written)
    # Bound variables keep the plan small: each step refers to the one before by name instead of repeating it.
    stamped = F.get(F.transform(F.array(F.split(fields, r"\|")), lambda f: _instant(f, default_zone)), F.lit(0))
    return F.when(v.rlike(r"^\d{10}$"), v.try_cast("bigint") * 1_000_000).when(v.rlike(r"^\d{13}$"), v.try_cast("bigint") * 1_000).otherwise(stamped)


def _instant(f: Column, default_zone: Column) -> Column:
    """The instant of nine split fields; null where they name no moment."""
    number = lambda i: F.get(f, F.lit(i)).try_cast("int")
    month = F.get(f, F.lit(1))
    month = F.coalesce(month.try_cast("int"), F.nullif(F.array_position(F.array(*map(F.lit, MONTHS)), month).cast("int"), F.lit(0)))
    half, hour = F.get(f, F.lit(8)), number(3)
    hour = F.when(half == "", hour).when(hour.between(1, 12), hour % 12 + F.when(half == "P", 12).otherwise(0))
    seconds = F.concat(F.coalesce(F.nullif(F.get(f, F.lit(5)), F.lit("")), F.lit("0")), F.lit("."), F.rpad(F.get(f, F.lit(6)), 6, "0")).try_cast("decimal(8,6)")
    seconds = F.when(seconds < 60, seconds)
    z = F.get(f, F.lit(7))
    zone = F.when(z == "", default_zone)
    for short, offset in ZONES.items():
        zone = zone.when(z == short, F.lit(offset))
    zone = zone.otherwise(F.concat(F.substring(z, 1, 3), F.lit(":"), F.coalesce(F.nullif(F.regexp_extract(z, r"^.\d\d:?(\d\d)$", 1), F.lit("")), F.lit("00"))))
    return F.unix_micros(F.try_make_timestamp(number(0), month, number(2), hour, number(4), seconds, zone))


def is_canonical(value: Column) -> Column:
    """Whether a value is already written in the one normal form."""
    return value.rlike(CANONICAL)
