"""DuckDB SQL for the queries of problems 2 and 6, written independently of the Spark expressions."""

from __future__ import annotations

_FORMATS = ["%Y-%m-%dT%H:%M:%S", "%Y-%m-%dT%H:%M:%S.%f", "%Y-%m-%d %H:%M:%S", "%Y-%m-%d %H:%M", "%Y%m%dT%H%M%S", "%Y%m%d%H%M%S", "%d.%m.%Y %H:%M", "%d %b %Y, %H:%M", "%d %b %Y %H:%M:%S", "%a, %d %b %Y %H:%M:%S"]
_LOCAL = ", ".join(f"try_strptime(base, '{f}')" for f in _FORMATS)
_SLASH = "CASE WHEN us THEN coalesce(try_strptime(base, '%m/%d/%Y %H:%M'), try_strptime(base, '%m/%d/%Y %I:%M %p')) ELSE coalesce(try_strptime(base, '%d/%m/%Y %H:%M'), try_strptime(base, '%d/%m/%Y %I:%M %p')) END"


def cells(values: str) -> str:
    """CTEs that end in ``parsed(src, row_id, field, v, utc_us)`` for rows (src, row_id, field, v, tz, us)."""
    return f"""vals AS ({values}),
    zoned AS (SELECT *, CASE WHEN contains(v, ':') OR contains(v, 'Z') THEN regexp_extract(v, '(Z|UTC|GMT|CEST|CET|EST|EDT|[+-][0-9][0-9]:?[0-9][0-9])$', 1) ELSE '' END AS z FROM (SELECT src, row_id, field, trim(v) AS v, v AS raw, coalesce(tz, 'UTC') AS tz, coalesce(us, false) AS us FROM vals WHERE v IS NOT NULL)),
    based AS (SELECT *, trim(left(v, length(v) - length(z))) AS base FROM zoned),
    local AS (SELECT *, coalesce({_LOCAL}, {_SLASH}) AS t FROM based),
    offs AS (SELECT *, CASE WHEN z IN ('Z', 'UTC', 'GMT') THEN 0 WHEN z = 'CET' THEN 60 WHEN z = 'CEST' THEN 120 WHEN z = 'EST' THEN -300 WHEN z = 'EDT' THEN -240
        WHEN z <> '' THEN (CASE WHEN z[1] = '-' THEN -1 ELSE 1 END) * (CAST(substr(z, 2, 2) AS INTEGER) * 60 + CAST(right(z, 2) AS INTEGER)) END AS off FROM local),
    inst AS (SELECT *, CASE WHEN off IS NULL THEN CASE WHEN timezone(tz, timezone(tz, t) - INTERVAL 1 HOUR) = t THEN timezone(tz, t) - INTERVAL 1 HOUR ELSE timezone(tz, t) END END AS stamp FROM offs),
    parsed AS (SELECT src, row_id, field, raw AS v, CASE WHEN regexp_full_match(v, '[0-9]{{10}}') THEN CAST(v AS BIGINT) * 1000000 WHEN regexp_full_match(v, '[0-9]{{13}}') THEN CAST(v AS BIGINT) * 1000
        WHEN off IS NOT NULL THEN epoch_us(t) - CAST(off AS BIGINT) * 60000000 ELSE epoch_us(stamp) END AS utc_us FROM inst)"""


_ITEM = "SELECT DISTINCT 'items' AS src, i.id AS row_id, '{f}' AS field, i.{f} AS v, k.tz, i.country = 'US' AS us FROM items i LEFT JOIN markets k ON k.country = i.country"
_GDELT = "SELECT DISTINCT 'gdelt', g.gdelt_id, 'seendate', g.seendate, k.tz, k.country = 'US' FROM gdelt g LEFT JOIN markets k ON k.country_name = g.sourcecountry"

P6_FOUND = f"WITH {cells(' UNION ALL '.join([_ITEM.format(f='published_at'), _ITEM.format(f='first_seen_at'), _GDELT]))} SELECT DISTINCT src, row_id, field, utc_us FROM parsed WHERE utc_us IS NOT NULL AND NOT regexp_full_match(v, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}T[0-9]{{2}}:[0-9]{{2}}:[0-9]{{2}}\\+00:00')"

_BOTH = f"WITH {cells(' UNION ALL '.join([_ITEM.format(f='published_at'), _ITEM.format(f='first_seen_at')]))}, b AS (SELECT row_id AS id, max(CASE WHEN field = 'published_at' THEN utc_us END) AS p, max(CASE WHEN field = 'first_seen_at' THEN utc_us END) AS s FROM parsed GROUP BY 1), d AS (SELECT *, (p // 86400000000 + 1) * 86400000000 AS day_end FROM b WHERE p IS NOT NULL AND s IS NOT NULL)"
_PERIOD = "strftime(make_timestamp(day_end - 86400000000), '%Y-%m-%d')"

P2_FOUND = f"{_BOTH} SELECT id, {_PERIOD} AS period, CASE WHEN s < day_end + 72 * 3600000000 THEN 'late' ELSE 'dropped' END AS effect FROM d WHERE s >= day_end + 6 * 3600000000"
P2_REVISIONS = f"""{_BOTH}, c AS (SELECT day_end, CASE WHEN s < day_end + 6 * 3600000000 THEN 0 ELSE 1 + (s - day_end - 6 * 3600000000) // 3600000000 END AS arrival_hour, count(DISTINCT id) AS n_items FROM d WHERE s < day_end + 72 * 3600000000 GROUP BY 1, 2)
    SELECT {_PERIOD} AS period, arrival_hour, n_items, sum(n_items) OVER (PARTITION BY day_end ORDER BY arrival_hour) AS n_corrected, row_number() OVER (PARTITION BY day_end ORDER BY arrival_hour) - 1 AS revision,
    arrival_hour = max(arrival_hour) OVER (PARTITION BY day_end) AS is_latest FROM c"""
P6_NOTATIONS = f"WITH {cells(' UNION ALL '.join([_ITEM.format(f='published_at').replace('DISTINCT ', ''), _ITEM.format(f='first_seen_at').replace('DISTINCT ', ''), _GDELT.replace('DISTINCT ', '')]))}, a AS (SELECT src, field, v, utc_us FROM parsed UNION ALL SELECT src, field, NULL, NULL FROM vals WHERE v IS NULL) SELECT src, field, regexp_replace(v, '[0-9]', '9', 'g') AS shape, count(*) AS n_values, count(utc_us) AS n_readable FROM a GROUP BY 1, 2, 3"

SQL = {"p6_found": P6_FOUND, "p6_notations": P6_NOTATIONS, "p2_found": P2_FOUND, "p2_revisions": P2_REVISIONS}
