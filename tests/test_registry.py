"""Every query with SQL against DuckDB on the same tables."""

import glob
import os

import duckdb
import pandas as pd
import pytest

from captrail.plans import extended, registry, retrieval  # noqa: F401  both add to the registry


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]
    out = []
    for r in df.itertuples(index=False, name=None):
        out.append(tuple("null" if pd.isna(v) else f"{float(v):.9g}" if isinstance(v, (int, float)) and not isinstance(v, bool) else str(v) for v in r))
    return sorted(out)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for p in glob.glob(f"{sf}/*.parquet"):
        con.execute(f"create view {os.path.basename(p)[:-8]} as select * from read_parquet('{p}')")
    return con


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_same_as_sql(spark, duck, sf, name):
    got = registry.QUERIES[name](spark, sf).toPandas()
    want = duck.execute(registry.SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


@pytest.mark.parametrize("name,key", [("domain_search_ranked", "page_id"), ("result_page", "page_id"), ("newest_jobs", "event_id")])
def test_ranked_in_order(spark, duck, sf, name, key):
    """The order of ranked results, which a comparison of sorted rows does not see."""
    got = [r[key] for r in registry.QUERIES[name](spark, sf).collect()]
    assert got == [r[0] for r in duck.execute(registry.SQL[name]).fetchall()]
