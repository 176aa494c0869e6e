"""Driver contract: entry() runs, every query has an oracle, and every
query matches its DuckDB oracle on the smallest tables."""

from __future__ import annotations

import decimal

import duckdb
import pytest

import __spark_entry__ as entry
from conftest import SF_SMALL
from strata.plans.oracles import ORACLES
from strata.plans.registry import QUERIES

ALL = sorted(QUERIES)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns == ["order_date", "order_year", "order_month", "total_revenue",
                          "line_count", "order_count"]
    assert df.count() > 0


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def _norm(rows):
    def v(x):
        if isinstance(x, decimal.Decimal):
            return x.normalize()
        return x
    return sorted((tuple(v(x) for x in r) for r in rows), key=repr)


@pytest.mark.parametrize("name", ALL)
def test_matches_duckdb(spark, name):
    con = duckdb.connect()
    for t in ("orders", "lineitem"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = entry.queries()[name](spark, SF_SMALL)
    cur = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    order = sorted(df.columns)
    srows = [tuple(r[c] for c in order) for r in df.collect()]
    drows = [tuple(r[dcols.index(c)] for c in order) for r in drows]
    assert _norm(srows) == _norm(drows)


def test_stored_queries_survive_catalog_repointing(spark, sample_run):
    """The shared job run re-points the catalog names before querying."""
    q = entry.queries()
    first = q["stored_yearly_revenue"](spark, SF_SMALL).collect()
    sample_run.register_tables(spark)           # names now point at the sample
    again = q["stored_yearly_revenue"](spark, SF_SMALL).collect()
    sample_run.register_tables(spark)
    assert first == again and len(first) > 1
