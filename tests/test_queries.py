"""Every registered core query against its SQL, and the found queries on emptied, nulled, doubled and widened tables."""

import pytest

import oracle
import variants
from presslens.plans import registry

FOUND = ["p2_found", "p6_found"]


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_equals_sql(spark, sf, name):
    df = registry.queries()[name](spark, sf)
    sql = registry.oracle_sql().get(name)
    if sql:
        assert oracle.compare(df, sql, sf) == ""
    else:
        assert df.count() > 0 and len(set(df.columns)) == len(df.columns)


@pytest.mark.parametrize("kind", ["empty", "nulls", "doubled", "wide"])
@pytest.mark.parametrize("name", FOUND)
def test_variants(spark, sf, tmp_path, name, kind):
    query = registry.queries()[name]
    got = variants.rows(query(spark, variants.make(kind, sf, tmp_path / kind)))
    assert got == (set() if kind in ("empty", "nulls") else variants.rows(query(spark, sf)))
