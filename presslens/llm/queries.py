"""The registered queries of the training-data text operators and the SQL they are checked against."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from presslens.llm import encode, garbled, history, language, leaks, lookalikes, personal, truncated


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Query name to a callable of (spark, sf_dir)."""
    return {
        "p1_found": garbled.p1_found,
        "p1_restored": garbled.p1_restored,
        "p3_found": truncated.p3_found,
        "p3_sources": truncated.p3_sources,
        "p4_found": history.p4_found,
        "p5_found": language.p5_found,
        "p5_languages": language.p5_languages,
        "p7_found": lookalikes.p7_found,
        "p7_plain": lookalikes.p7_plain,
        "p8_ids": encode.p8_ids,
        "p9_found": leaks.p9_found,
        "p9_altered": leaks.p9_altered,
        "p10_found": personal.p10_found,
        "p10_redacted": personal.p10_redacted,
    }


_WORDS = "list_transform(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+'), lambda w: w)"
_GRAMS = "unnest(list_transform(range(1, len(w) - 11), lambda k: array_to_string(w[k:k + 12], ' '))) AS g"
_KEY = r"""regexp_replace(lower(regexp_extract(rest, '^([^/?]*)', 1)), '^((www|m|amp)\.)+', '') || regexp_replace(regexp_replace(regexp_extract(rest, '^[^/?]*([^?]*)', 1), '/{2,}', '/', 'g'), '(/amp|/index\.html|/)+$', '')
    || '?' || array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '^[^?]*\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(string_split(p, '=')[1], '^utm_|^(fbclid|gclid|ref|oc)$'))), '&')"""


def oracle_sql() -> dict[str, str]:
    """Query name to DuckDB SQL over the same tables."""
    return {
        "p4_found": f"""WITH i AS (SELECT DISTINCT id, canonical_url, title_key FROM items),
            u AS (SELECT id, {_KEY} AS k FROM (SELECT id, regexp_replace(regexp_replace(trim(canonical_url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS rest FROM i)),
            t AS (SELECT id, list_distinct(list_filter(string_split(title_key, ' '), lambda x: x <> '')) AS w FROM i), s AS (SELECT id, w, len(w) AS n FROM t WHERE len(w) >= 4),
            e AS (SELECT id, n, unnest(w) AS x FROM s), c AS (SELECT a.id AS id_a, b.id AS id_b, count(*) AS n, any_value(a.n) AS na, any_value(b.n) AS nb FROM e a JOIN e b ON a.x = b.x AND a.id < b.id GROUP BY 1, 2)
            SELECT id_a, id_b FROM c WHERE n >= 0.6 * (na + nb - n) UNION SELECT a.id, b.id FROM u a JOIN u b ON a.k = b.k AND a.id < b.id""",
        "p9_found": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL), e AS (SELECT eval_id, {_WORDS} AS w FROM eval_items),
            dg AS (SELECT doc_id, {_GRAMS} FROM d), eg AS (SELECT eval_id, {_GRAMS} FROM e) SELECT DISTINCT doc_id, eval_id FROM dg JOIN eg USING (g)""",
    }
