from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

DATA = os.path.join(ROOT, "tests", "data")
SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from strata.session import build_session
    warehouse = tempfile.mkdtemp(prefix="strata-test-warehouse-")
    session = build_session("local[4]", shuffle_partitions=4,
                            extra={"spark.sql.warehouse.dir": warehouse})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sample_run(spark, tmp_path_factory):
    """The three-layer job once over the 10-order / 13-line text sample."""
    from strata.plans.layers import LayerJob
    root = str(tmp_path_factory.mktemp("warehouse"))
    job = LayerJob(source=DATA, root=root, source_format="text", register=True)
    return job.run(spark)


# Every order with each of its lines, summed: what the gold tables must equal.
DAILY = """
    WITH pairs AS (SELECT * FROM {o} INNER JOIN {l} ON l_orderkey = o_orderkey)
    SELECT o_orderdate AS order_date, order_year, order_month, sum(revenue) AS total_revenue,
           count(l_orderkey) AS line_count, count(DISTINCT o_orderkey) AS order_count
    FROM pairs GROUP BY o_orderdate, order_year, order_month"""
CUSTOMERS = """
    WITH pairs AS (SELECT * FROM {o} INNER JOIN {l} ON l_orderkey = o_orderkey)
    SELECT o_custkey AS customer_key, sum(revenue) AS total_revenue, count(DISTINCT o_orderkey) AS order_count,
           min(o_orderdate) AS first_order_date, max(o_orderdate) AS last_order_date
    FROM pairs GROUP BY o_custkey"""


def plain_sql(spark, text, orders, lineitem):
    return spark.sql(text, o=orders, l=lineitem)


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())
