"""Problem 3, text cut off by field limits: trigrams that are frequent inside texts and almost never end one. Pure SQL.

Words are classed first: a capitalised word by its last letters (names are too many to be counted one by one), a
number as #, everything else as itself; a final stop becomes a token of its own. Over all texts of a field, each
trigram is counted inside (another word follows) and terminal (a stop or the end of the text follows). A text is cut
if its final trigram is frequent inside and almost never terminal; with a mark of omission, which is taken off before,
unless its final trigram often stands before a stop and is never met inside; or if its final word is unknown after the
two before it while a longer word that begins with it is frequent there (for a name: while names are frequent there and
none ends like it). If the first word of the text (behind a label such as
"Update:") is a usual one after its last two, the words were only moved around and nothing is missing.

A text that ends in a stop, or in a trigram that does end texts, is complete, with or without the stop. Null and
blank values are no cases; repeated rows give one case; texts of any length are counted whole. The counts are
aggregated on the map side before they are shuffled, so a frequent trigram or source makes no hot group, and the
joins are on hashed trigram keys of the final trigrams only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from presslens.session import cut, table

#: Occurrences that make a trigram known, and the share of terminal ones under which it counts as never terminal.
LEAST_SEEN, TERMINAL_SHARE = 3, 0.1

#: Stops behind a trigram that is never met inside from which it makes a text complete in spite of a mark of omission.
LEAST_ENDED = 20

#: A word class that makes up this share of the capitalised words is a usual ending of names.
USUAL_ENDING = 0.001

#: A word that follows two others in this share of the places is their usual next one.
USUAL_NEXT = 0.05

_MARK = r"\s*(…|\.\.\.+|\[\s*(…|\.\.\.+)\s*\]|\(\s*(…|\.\.\.+)\s*\))\s*$"

# Cyrillic letters and the Latin ones they look like; before them the full-width digits and letters.
_WIDTHS = [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]
_WIDE = "".join(map(chr, _WIDTHS)) + "АВЕКМНОРСТХІЅЈаеорсухіѕј"
_PLAIN = "".join(chr(c - 0xFEE0) for c in _WIDTHS) + "ABEKMHOPCTXISJaeopcyxisj"

#: What needs the slow clean-up: anything but controls, plain Latin and Greek letters and usual punctuation.
_ODD = r"[^\x00-\x84\x86-\x9F\xA1-\xAC\xAE-ſͰ-Ͽ‐-‧€]"

CELLS = rf"""
    SELECT id, source_domain, field, text, length(text) AS len, (contains(text, '…') OR contains(text, '...')) AND text RLIKE r'{_MARK}' AS marked
    FROM (SELECT id, source_domain, stack(2, 'title', title, 'summary', summary) AS (field, text) FROM {{items}})
    WHERE trim(text) <> ''
"""

#: The tokens of every text behind two signs of its beginning; the one step that reads the texts.
TOKENS = rf"""
    SELECT id, source_domain, field, len, marked, concat(array('<s>', '<s>'), split(text, r'\s+')) AS w
    FROM (SELECT id, source_domain, field, len, marked,
                 trim(regexp_replace(regexp_replace(regexp_replace(text, r'\p{{{{Lu}}}}(?:\p{{{{L}}}}*(\p{{{{L}}}}{{{{3}}}})|(\p{{{{L}}}}{{{{0,2}}}}))(?!\p{{{{L}}}})', '~$1$2'),
                     r'[0-9](?:[0-9.,]*[0-9])?', '#'), r'[.!?]+(?=[\s”"»)]|$)', ' </s> ')) AS text
          FROM (SELECT id, source_domain, field, len, marked, rtrim(' \t\n\r\f”"»)’', CASE WHEN text RLIKE r'{_ODD}'
                    THEN regexp_replace(regexp_replace(translate(text, '{_WIDE}', '{_PLAIN}'), r'[\p{{{{Cf}}}}\p{{{{M}}}}]', ''), r'[\s\p{{{{Z}}}}]+', ' ') ELSE text END) AS text
                FROM (SELECT id, source_domain, field, len, marked, if(marked, regexp_replace(text, r'{_MARK}', ''), text) AS text FROM {{cells}})))
    WHERE text <> ''
"""

#: One row per word after two others, counted on the map side: inside a text, and before a stop. The last word of a text
#: is a row of its own (``f``), with the two words that would have it followed by the first; complete texts only leave
#: how many of them have which length.
PLACES = """
    SELECT k, c, f, count_if(d <> '</s>') AS n_inside, count_if(d = '</s>') AS n_stopped, count(1) AS n
    FROM (SELECT xxhash64(field, a, b) AS k, c, d,
                 CASE WHEN d IS NULL AND (marked OR c <> '</s>') THEN named_struct('id', id, 'field', field, 'source', source_domain, 'len', len, 'marked', marked, 'k_around', xxhash64(field, b, c), 'c_around', first)
                      WHEN d IS NULL THEN named_struct('id', CAST(NULL AS BIGINT), 'field', field, 'source', source_domain, 'len', len, 'marked', false, 'k_around', 0L, 'c_around', '') END AS f
          FROM (SELECT id, source_domain, field, len, marked, CASE WHEN w[2] LIKE '%:' AND size(w) > 4 THEN w[3] ELSE w[2] END AS first,
                       inline(arrays_zip(w, slice(w, 2, size(w)), slice(w, 3, size(w)), slice(w, 4, size(w)))) AS (a, b, c, d) FROM {tokens})
          WHERE c IS NOT NULL AND (d IS NULL OR c <> '</s>' AND NOT marked))
    GROUP BY k, c, f
"""

#: Lengths at which a source's values pile up with next to nothing beyond: at most a few rows per source and field.
LIMITS = """
    SELECT source, field, max_by(len, struct(n, len)) AS len FROM (
        SELECT source, field, len, n, sum(n) OVER (PARTITION BY source, field ORDER BY len DESC) - n AS n_beyond
        FROM (SELECT f.source, f.field, f.len, sum(n) AS n FROM {places} WHERE f IS NOT NULL AND NOT f.marked GROUP BY 1, 2, 3))
    WHERE n >= 5 AND n_beyond <= 0.5 * n GROUP BY 1, 2
"""

#: Last words of texts without stop, and whether the text is as long as its source allows.
FINALS = """
    SELECT p.id, p.field, p.marked, l.len IS NOT NULL AS at_limit, p.n, p.k, p.c, p.k_around, p.c_around
    FROM (SELECT k, c, n, f.* FROM {places} WHERE f.id IS NOT NULL) p
    LEFT JOIN {limits} l ON p.source = l.source AND p.field = l.field AND p.len BETWEEN l.len - 1 AND l.len
"""

#: How often each word followed two others inside a text, and how often as the last before a stop or the end. The end
#: of a text that is as long as its source allows, or that has a mark, says nothing.
COUNTS = """
    SELECT k, c, sum(n_inside) AS n_inside, sum(n_stopped + n_ended) AS n_terminal, sum(n_stopped) AS n_stopped
    FROM (SELECT k, c, n_inside, n_stopped, 0L AS n_ended FROM {places} WHERE f IS NULL
          UNION ALL SELECT k, c, 0L, 0L, n FROM {finals} WHERE NOT marked AND NOT at_limit)
    GROUP BY k, c
"""

#: Endings of names that are usual: at most 1 / USUAL_ENDING rows.
ENDINGS = """
    SELECT c FROM (SELECT c, n, sum(n) OVER () AS total FROM (SELECT c, sum(n_inside) AS n FROM {counts} WHERE c LIKE '~%' GROUP BY c)) WHERE n >= {usual} * total
"""

#: Final trigrams that are never terminal or have a mark, and final words that are the beginning of a usual word of their place. Texts
#: whose first word usually follows their end were moved round, but not a summary at its limit or a lone capital at the end.
CUT = r"""
    WITH seen AS (SELECT f.*, coalesce(n.n_inside, 0) AS n_inside, coalesce(n.n_terminal, 0) AS n_terminal, coalesce(n.n_stopped, 0) AS n_stopped FROM {finals} f LEFT JOIN {counts} n ON f.k = n.k AND f.c = n.c),
    open AS (
        SELECT * FROM seen WHERE NOT marked AND n_inside >= {least} AND n_terminal < {share} * (n_inside + n_terminal)
        UNION ALL
        SELECT u.* FROM seen u LEFT SEMI JOIN {counts} m ON u.k = m.k AND m.c <> u.c AND startswith(m.c, u.c)
            AND m.n_inside + m.n_terminal >= 5 * (u.n_inside + u.n_terminal) AND m.n_inside + m.n_terminal >= {least}
        WHERE NOT u.marked AND u.n_inside < {least}
        UNION ALL
        SELECT u.* FROM seen u LEFT ANTI JOIN {endings} e ON u.c = e.c
        LEFT SEMI JOIN {counts} m ON u.k = m.k AND m.c <> u.c AND m.c LIKE '~%' AND m.n_inside + m.n_terminal >= 5 * (u.n_inside + u.n_terminal) AND m.n_inside + m.n_terminal >= {least}
        WHERE NOT u.marked AND u.n_inside < {least} AND u.c RLIKE r'^~\p{{L}}{{0,3}}$')
    SELECT id, field FROM seen WHERE marked AND NOT (n_inside = 0 AND n_stopped >= {ended})
    UNION
    SELECT o.id, o.field FROM open o
    LEFT ANTI JOIN (SELECT k, c FROM (SELECT k, c, n_inside, sum(n_inside) OVER (PARTITION BY k) AS n_all FROM {counts}) WHERE n_inside >= {least} AND n_inside >= {around} * n_all) r
        ON o.k_around = r.k AND o.c_around = r.c AND NOT (o.at_limit AND o.field = 'summary') AND o.c <> '~'
"""


def find_cut(spark: SparkSession, items: DataFrame, least: int = LEAST_SEEN, share: float = TERMINAL_SHARE) -> DataFrame:
    """(id, field) of every cut title and summary, distinct."""
    cells = spark.sql(CELLS, items=items.select("id", "source_domain", "title", "summary"))
    # each is read several times below and small next to the texts, which are read once
    places = cut(spark.sql(PLACES, tokens=spark.sql(TOKENS, cells=cells)))
    finals = cut(spark.sql(FINALS, places=places, limits=spark.sql(LIMITS, places=places)))
    counts = cut(spark.sql(COUNTS, places=places, finals=finals))
    return spark.sql(CUT, counts=counts, finals=finals, endings=spark.sql(ENDINGS, counts=counts, usual=USUAL_ENDING), least=least, share=share, around=USUAL_NEXT, ended=LEAST_ENDED)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut titles and summaries of all items."""
    return find_cut(spark, table(spark, sf_dir, "items"))


def p3_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source and field: values, cut values and their share."""
    items = table(spark, sf_dir, "items").dropDuplicates(["id"])
    return spark.sql(
        """
        SELECT v.source_domain, v.field, count(*) AS n_values, count(c.id) AS n_cut, count(c.id) / count(*) AS share_cut
        FROM (SELECT id, source_domain, stack(2, 'title', title, 'summary', summary) AS (field, text) FROM {items}) v
        LEFT JOIN {cut} c ON v.id = c.id AND v.field = c.field
        WHERE trim(v.text) <> '' GROUP BY v.source_domain, v.field
        """,
        items=items,
        cut=find_cut(spark, items),
    )
