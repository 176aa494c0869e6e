"""Independent SQL (DuckDB dialect) for every registered query.

Written from the semantics, not from our Spark code: casts, joins and
aggregates are spelled out so a mistake in either engine shows up as a
mismatch.  DuckDB widens year()/month() and sums of counts, so those are
cast back to Spark's INTEGER / BIGINT.
"""

from __future__ import annotations

# Clean orders / lineitem straight from the source tables.
SO = """(SELECT o_orderkey, o_custkey, o_orderstatus,
        CAST(o_totalprice AS DECIMAL(15,2)) AS o_totalprice,
        CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
        CAST(year(o_orderdate) AS INTEGER) AS order_year,
        CAST(month(o_orderdate) AS INTEGER) AS order_month
 FROM orders WHERE o_orderkey IS NOT NULL)"""

SL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        CAST(l_quantity AS DECIMAL(15,2)) AS l_quantity,
        CAST(l_extendedprice AS DECIMAL(15,2)) AS l_extendedprice,
        CAST(l_discount AS DECIMAL(15,2)) AS l_discount,
        CAST(l_tax AS DECIMAL(15,2)) AS l_tax,
        l_returnflag, l_linestatus,
        CAST(l_shipdate AS DATE) AS l_shipdate,
        CAST(year(l_shipdate) AS INTEGER) AS ship_year,
        CAST(CAST(l_extendedprice AS DECIMAL(15,2))
             * (1 - CAST(l_discount AS DECIMAL(15,2))) AS DECIMAL(32,4)) AS revenue
 FROM lineitem WHERE l_orderkey IS NOT NULL)"""

R = f"""(SELECT o.o_orderdate AS order_date, o.order_year, o.order_month,
        SUM(l.revenue) AS total_revenue,
        COUNT(l.l_orderkey) AS line_count,
        COUNT(DISTINCT o.o_orderkey) AS order_count
 FROM {SO} o JOIN {SL} l ON o.o_orderkey = l.l_orderkey
 GROUP BY o.o_orderdate, o.order_year, o.order_month)"""

C = f"""(SELECT o.o_custkey AS customer_key,
        SUM(l.revenue) AS total_revenue,
        COUNT(DISTINCT o.o_orderkey) AS order_count,
        MIN(o.o_orderdate) AS first_order_date,
        MAX(o.o_orderdate) AS last_order_date
 FROM {SO} o JOIN {SL} l ON o.o_orderkey = l.l_orderkey
 GROUP BY o.o_custkey)"""

TOP10 = f"""(SELECT customer_key, total_revenue, order_count FROM {C} c
 ORDER BY total_revenue DESC NULLS LAST, customer_key ASC NULLS LAST LIMIT 10)"""

YEARLY = f"""SELECT order_year, SUM(total_revenue) AS yearly_revenue,
       CAST(SUM(order_count) AS BIGINT) AS yearly_orders
FROM {R} r GROUP BY order_year"""

ORACLES: dict[str, str] = {
    "silver_orders": f"SELECT * FROM {SO} s",
    "silver_lineitem": f"SELECT * FROM {SL} s",
    "revenue_by_order_date": f"SELECT * FROM {R} r",
    "top_customers": f"SELECT * FROM {C} c",
    "total_revenue": f"SELECT SUM(total_revenue) AS total_revenue FROM {R} r",
    "yearly_revenue": YEARLY,
    "yearly_revenue_sql": YEARLY,
    "top_10_customers": f"SELECT * FROM {TOP10} t",
    "top_days_1996": f"""SELECT order_date, total_revenue, order_count FROM {R} r
        WHERE order_year = 1996
        ORDER BY total_revenue DESC NULLS LAST, order_date ASC NULLS LAST LIMIT 10""",
    "gold_preview": f"SELECT * FROM {R} r ORDER BY order_date ASC NULLS LAST LIMIT 10",
    "gold_view": f"SELECT * FROM {R} r",
    "analyst_view": f"SELECT order_year, total_revenue FROM {R} r",
    "row_counts": f"""
        SELECT 'source' AS layer, 'orders' AS table_name, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'source', 'lineitem', COUNT(*) FROM lineitem
        UNION ALL SELECT 'bronze', 'orders', COUNT(*) FROM orders
        UNION ALL SELECT 'bronze', 'lineitem', COUNT(*) FROM lineitem
        UNION ALL SELECT 'silver', 'orders', COUNT(*) FROM {SO} a
        UNION ALL SELECT 'silver', 'lineitem', COUNT(*) FROM {SL} b
        UNION ALL SELECT 'gold', 'revenue_by_order_date', COUNT(*) FROM {R} c
        UNION ALL SELECT 'gold', 'top_customers', COUNT(*) FROM {C} d""",
    "qc_null_keys": f"""
        SELECT 'orders' AS table_name, COUNT(*) AS row_count,
               COUNT(*) FILTER (WHERE o_orderkey IS NULL) AS null_keys FROM {SO} a
        UNION ALL
        SELECT 'lineitem', COUNT(*), COUNT(*) FILTER (WHERE l_orderkey IS NULL) FROM {SL} b""",
    "qc_revenue_positive": f"""SELECT COUNT(*) AS row_count,
        COUNT(*) FILTER (WHERE total_revenue IS NULL OR total_revenue <= 0) AS non_positive
        FROM {R} r""",
    "qc_top_complete": f"""SELECT (SELECT COUNT(*) FROM {TOP10} t1) AS report_rows,
        COUNT(*) AS missed FROM {C} c
        WHERE c.customer_key NOT IN (SELECT customer_key FROM {TOP10} t2)
          AND c.total_revenue > (SELECT MIN(total_revenue) FROM {TOP10} t3)""",
    "qc_top_sorted": f"""
        WITH t AS (SELECT customer_key, total_revenue FROM {TOP10} x),
        pairs AS (
          SELECT 'as_returned' AS report, total_revenue, customer_key,
                 LAG(total_revenue) OVER w AS prev, LAG(customer_key) OVER w AS prev_key
          FROM t WINDOW w AS (ORDER BY total_revenue DESC NULLS LAST, customer_key ASC NULLS LAST)
          UNION ALL
          SELECT 'by_customer', total_revenue, customer_key,
                 LAG(total_revenue) OVER w, LAG(customer_key) OVER w FROM t WINDOW w AS (ORDER BY customer_key))
        SELECT report, COUNT(*) AS checked_rows,
               COUNT(*) FILTER (WHERE prev < total_revenue OR (prev = total_revenue AND prev_key > customer_key))
                 AS out_of_order
        FROM pairs GROUP BY report""",
}

# -- raw ingest and writes ----------------------------------------------------

DIRTY = """(SELECT o_orderkey, o_custkey,
    CASE WHEN o_orderkey % 11 = 5 THEN NULL
         WHEN o_orderkey % 5 IN (0, 3) THEN NULL
         WHEN o_orderkey % 5 = 2
              THEN CAST(CAST(o_totalprice AS DECIMAL(15,2)) + 0.01 AS DECIMAL(15,2))
         ELSE CAST(o_totalprice AS DECIMAL(15,2)) END AS o_totalprice,
    CASE WHEN o_orderkey % 11 = 5 THEN NULL
         WHEN o_orderkey % 5 = 4 THEN NULL
         WHEN o_orderkey % 5 = 1 AND (month(o_orderdate) < 10 OR day(o_orderdate) < 10)
              THEN NULL
         ELSE CAST(o_orderdate AS DATE) END AS o_orderdate
  FROM orders WHERE o_orderkey % 7 <> 0)"""

DIRTY_LINES = """(SELECT l_orderkey, l_linenumber,
    CASE WHEN r = 0 THEN NULL ELSE CAST(l_quantity AS DECIMAL(15,2)) END AS l_quantity,
    CASE WHEN r = 1
         THEN CAST(CAST(l_extendedprice AS DECIMAL(15,2)) + 0.01 AS DECIMAL(15,2))
         ELSE CAST(l_extendedprice AS DECIMAL(15,2)) END AS l_extendedprice,
    CASE WHEN r = 2 THEN NULL ELSE CAST(l_discount AS DECIMAL(15,2)) END AS l_discount,
    CASE WHEN r = 4 THEN NULL ELSE CAST(l_tax AS DECIMAL(15,2)) END AS l_tax,
    CASE WHEN r = 3 AND (month(l_shipdate) < 10 OR day(l_shipdate) < 10) THEN NULL
         ELSE CAST(l_shipdate AS DATE) END AS l_shipdate
  FROM (SELECT *, (l_orderkey + l_linenumber) % 6 AS r FROM lineitem) x)"""

UPDATES = f"""(SELECT o_orderkey, o_custkey, 'U' AS o_orderstatus,
        CAST(o_totalprice + 1 AS DECIMAL(15,2)) AS o_totalprice, o_orderdate,
        o_orderpriority, order_year, order_month
   FROM {SO} a WHERE o_orderkey % 10 = 0
 UNION ALL
 SELECT o_orderkey + 1000000000, o_custkey, 'N', o_totalprice, o_orderdate,
        o_orderpriority, order_year, order_month
   FROM {SO} b WHERE o_orderkey % 10 = 1)"""

# Orders and lines after the change set of the incremental gold queries.
CHANGED_ORDERS = f"""(SELECT o_orderkey, CASE WHEN o_orderkey % 10 = 7 THEN o_custkey + 1 ELSE o_custkey END AS o_custkey,
        CASE WHEN o_orderkey % 10 = 3 THEN o_orderdate + 400 ELSE o_orderdate END AS o_orderdate
   FROM {SO} a WHERE o_orderkey % 10 <> 5
 UNION ALL SELECT o_orderkey + 1000000000, o_custkey, o_orderdate FROM {SO} b WHERE o_orderkey % 10 = 1)"""

CHANGED_LINES = f"""(SELECT l_orderkey, CAST(CASE WHEN l_orderkey % 10 = 9 THEN revenue + 1 ELSE revenue END AS DECIMAL(32,4)) AS revenue
   FROM {SL} a WHERE l_orderkey % 10 <> 5
 UNION ALL SELECT l_orderkey + 1000000000, CAST(revenue * 2 AS DECIMAL(32,4)) FROM {SL} b WHERE l_orderkey % 10 = 1)"""

ORDERS_TEXT = """SELECT o_orderkey, o_custkey, o_orderstatus,
        CAST(CAST(o_totalprice AS DECIMAL(15,2)) AS VARCHAR) AS o_totalprice,
        strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_orderpriority FROM orders"""

LINEITEM_TEXT = """SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber,
        CAST(CAST(l_quantity AS DECIMAL(15,2)) AS VARCHAR) AS l_quantity,
        CAST(CAST(l_extendedprice AS DECIMAL(15,2)) AS VARCHAR) AS l_extendedprice,
        CAST(CAST(l_discount AS DECIMAL(15,2)) AS VARCHAR) AS l_discount,
        CAST(CAST(l_tax AS DECIMAL(15,2)) AS VARCHAR) AS l_tax,
        l_returnflag, l_linestatus,
        strftime(l_shipdate, '%Y-%m-%d') AS l_shipdate FROM lineitem"""

COPY_CHECK = f"""
        SELECT layer, table_name, row_count AS source_rows, row_count AS copied_rows,
               TRUE AS same_rows FROM (
          SELECT 'bronze' AS layer, 'orders' AS table_name, COUNT(*) AS row_count FROM orders
          UNION ALL SELECT 'bronze', 'lineitem', COUNT(*) FROM lineitem
          UNION ALL SELECT 'silver', 'orders', COUNT(*) FROM {SO} a
          UNION ALL SELECT 'silver', 'lineitem', COUNT(*) FROM {SL} b
          UNION ALL SELECT 'gold', 'revenue_by_order_date', COUNT(*) FROM {R} c
          UNION ALL SELECT 'gold', 'top_customers', COUNT(*) FROM {C} d) """

ORACLES.update({
    "bronze_orders": ORDERS_TEXT,

    "incremental_ingest": ORDERS_TEXT,

    "incremental_clean": f"SELECT * FROM {SO} s",
    "bronze_lineitem": LINEITEM_TEXT,


    "bronze_dirty": """SELECT
        CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_orderkey END AS o_orderkey,
        o_custkey,
        CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_orderpriority END AS o_orderpriority
        FROM orders""",
    "silver_key_gate": """SELECT 'orders' AS table_name, COUNT(*) AS rows_in,
        COUNT(*) FILTER (WHERE o_orderkey % 7 <> 0) AS rows_kept,
        COUNT(*) FILTER (WHERE o_orderkey % 7 = 0) AS rows_dropped FROM orders""",
    "silver_dirty_casts": f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
        CAST(year(o_orderdate) AS INTEGER) AS order_year,
        CAST(month(o_orderdate) AS INTEGER) AS order_month FROM {DIRTY} d""",
    "qc_bronze_matches_raw": """
        SELECT 'orders' AS table_name, COUNT(*) AS raw_rows, COUNT(*) AS bronze_rows,
               TRUE AS equal FROM orders
        UNION ALL SELECT 'lineitem', COUNT(*), COUNT(*), TRUE FROM lineitem""",
    "silver_dirty_lineitem": f"""SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
        l_discount, l_tax, l_shipdate, CAST(year(l_shipdate) AS INTEGER) AS ship_year,
        CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(32,4)) AS revenue
        FROM {DIRTY_LINES} d""",
    "replace_idempotent": f"SELECT * FROM {R} r",
    "partitioned_write": f"""SELECT order_year, COUNT(*) AS row_count,
        MIN(o_orderdate) AS first_date, MAX(o_orderdate) AS last_date
        FROM {SO} s GROUP BY order_year""",
    "partition_overwrite": f"""SELECT * FROM {SO} a WHERE order_year <> 1996
        UNION ALL SELECT * FROM {SO} b WHERE order_year = 1996 AND o_orderstatus = 'F'""",
    "upsert_orders": f"""SELECT * FROM {SO} s
        WHERE NOT EXISTS (SELECT 1 FROM {UPDATES} u WHERE u.o_orderkey = s.o_orderkey)
        UNION ALL SELECT * FROM {UPDATES} u2""",
    "upsert_orders_by_partition": f"""
        SELECT * REPLACE (CASE WHEN order_year = 1993 THEN 1994 ELSE order_year END AS order_year)
        FROM (SELECT * FROM {SO} s
              WHERE NOT EXISTS (SELECT 1 FROM {UPDATES} u WHERE u.o_orderkey = s.o_orderkey)
              UNION ALL SELECT * FROM {UPDATES} u2) merged""",
    "compaction_same_rows": f"SELECT * FROM {SL} s",
    "compaction_packs_small_files": f"""SELECT order_year, order_month, COUNT(*) AS row_count,
        CAST(SUM(o_orderkey) AS BIGINT) AS key_sum, CAST(SUM(o_totalprice) AS DECIMAL(25,2)) AS price_sum,
        TRUE AS large_files_kept, TRUE AS fewer_files
        FROM {SO} s GROUP BY order_year, order_month""",
    "compaction_in_place": f"""SELECT ship_year, COUNT(*) AS row_count, CAST(SUM(l_orderkey) AS BIGINT) AS key_sum,
        SUM(revenue) AS revenue, TRUE AS fewer_files FROM {SL} s GROUP BY ship_year""",
    "schema_add_column": f"SELECT *, CAST(NULL AS VARCHAR) AS o_note FROM {SO} s",
    "schema_drop_then_add": f"SELECT * REPLACE (CAST(NULL AS VARCHAR) AS o_orderstatus) FROM {SO} s",
    "schema_rename_drop": f"""SELECT o_orderkey, o_custkey, o_totalprice, o_orderdate,
        o_orderpriority AS order_priority, order_year, order_month FROM {SO} s""",
    "schema_widen": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority, order_year, CAST(order_month AS BIGINT) AS order_month FROM {SO} s""",
    "run_metrics": f"""
        SELECT 'bronze' AS phase, 'orders' AS table_name, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'bronze', 'lineitem', COUNT(*) FROM lineitem
        UNION ALL SELECT 'silver', 'orders', COUNT(*) FROM {SO} a
        UNION ALL SELECT 'silver', 'lineitem', COUNT(*) FROM {SL} b
        UNION ALL SELECT 'gold', 'revenue_by_order_date', COUNT(*) FROM {R} c
        UNION ALL SELECT 'gold', 'top_customers', COUNT(*) FROM {C} d""",
    "stored_top_days_1996": f"""SELECT order_date, total_revenue, order_count FROM {R} r
        WHERE order_year = 1996
        ORDER BY total_revenue DESC NULLS LAST, order_date ASC NULLS LAST LIMIT 10""",
    "stored_yearly_revenue": YEARLY,
    "ctas_yearly_revenue": YEARLY,
    "stored_top_10_customers": f"SELECT * FROM {TOP10} t",
    "catalog_layers": f"""
        SELECT 'bronze' AS layer, 'orders' AS table_name, COUNT(*) AS row_count FROM orders
        UNION ALL SELECT 'bronze', 'lineitem', COUNT(*) FROM lineitem
        UNION ALL SELECT 'silver', 'orders', COUNT(*) FROM {SO} a
        UNION ALL SELECT 'silver', 'lineitem', COUNT(*) FROM {SL} b
        UNION ALL SELECT 'gold', 'revenue_by_order_date', COUNT(*) FROM {R} c
        UNION ALL SELECT 'gold', 'top_customers', COUNT(*) FROM {C} d""",
    "acceptance_report": f"""
        SELECT 'bronze_rows_match_source' AS check_name,
               (SELECT COUNT(*) FROM orders) > 0 AND (SELECT COUNT(*) FROM lineitem) > 0
               AS passed
        UNION ALL SELECT 'silver_money_is_decimal_15_2', TRUE
        UNION ALL SELECT 'silver_partitioned_by_year', TRUE
        UNION ALL SELECT 'silver_no_null_keys',
               (SELECT COUNT(*) FROM {SO} a WHERE o_orderkey IS NULL) = 0
               AND (SELECT COUNT(*) FROM {SL} b WHERE l_orderkey IS NULL) = 0
        UNION ALL SELECT 'gold_revenue_positive',
               (SELECT COUNT(*) FROM {R} r WHERE total_revenue IS NULL OR total_revenue <= 0) = 0
        UNION ALL SELECT 'gold_top_customers_sorted',
               (SELECT COUNT(*) FROM (SELECT total_revenue, LAG(total_revenue) OVER
                   (ORDER BY total_revenue DESC NULLS LAST, customer_key ASC NULLS LAST) AS prev
                 FROM {TOP10} t) x WHERE prev < total_revenue) = 0""",
    "copy_tables": COPY_CHECK,
    "clustered_top_customers": f"SELECT * FROM {C} c",
    "clustered_top_10_customers": f"SELECT * FROM {TOP10} t",
    "clustered_days_of_a_quarter": f"""SELECT * FROM {R} r
        WHERE order_date BETWEEN DATE '1995-01-01' AND DATE '1995-03-31'""",
    "mixed_schema_files": f"""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
        o_orderpriority AS order_priority, order_year, CAST(order_month AS BIGINT) AS order_month,
        CASE WHEN o_orderkey % 2 = 1 THEN 'n' || CAST(o_orderkey AS VARCHAR) END AS o_note FROM {SO} s""",
    "raw_accepted": f"""SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
        d.o_totalprice, d.o_orderdate, CASE WHEN o_orderkey % 11 = 5 THEN NULL ELSE o_orderpriority END AS o_orderpriority,
        CAST(year(d.o_orderdate) AS INTEGER) AS order_year, CAST(month(d.o_orderdate) AS INTEGER) AS order_month
        FROM {DIRTY} d JOIN (SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders) o USING (o_orderkey, o_custkey)
        WHERE o_orderkey % 11 = 5 OR (d.o_totalprice IS NOT NULL AND d.o_orderdate IS NOT NULL)""",
    "raw_rejected": """SELECT raw_key, fields, reasons FROM (
        SELECT CASE WHEN k % 7 = 0 THEN 'x' ELSE '' END || CAST(k AS VARCHAR) AS raw_key,
          CAST(CASE WHEN k % 11 = 5 THEN 2 WHEN k % 11 = 6 THEN 7 ELSE 6 END AS INTEGER) AS fields,
          concat_ws(',', CASE WHEN k % 7 = 0 THEN 'bad_key' END,
            CASE WHEN k % 11 <> 5 AND k % 5 IN (0, 3) THEN 'bad_money' END,
            CASE WHEN k % 11 <> 5 AND (k % 5 = 4 OR (k % 5 = 1 AND (month(d) < 10 OR day(d) < 10))) THEN 'bad_date' END) AS reasons
        FROM (SELECT o_orderkey AS k, o_orderdate AS d FROM orders) o) x WHERE reasons <> ''""",
    "colocated_daily_revenue": f"SELECT * FROM {R} r",
    "incremental_daily_revenue": f"""SELECT o_orderdate AS order_date, CAST(year(o_orderdate) AS INTEGER) AS order_year,
        CAST(month(o_orderdate) AS INTEGER) AS order_month, SUM(revenue) AS total_revenue, COUNT(l_orderkey) AS line_count,
        COUNT(DISTINCT o_orderkey) AS order_count
        FROM {CHANGED_ORDERS} o JOIN {CHANGED_LINES} l ON o_orderkey = l_orderkey GROUP BY o_orderdate""",
    "incremental_top_customers": f"""SELECT o_custkey AS customer_key, SUM(revenue) AS total_revenue,
        COUNT(DISTINCT o_orderkey) AS order_count, MIN(o_orderdate) AS first_order_date, MAX(o_orderdate) AS last_order_date
        FROM {CHANGED_ORDERS} o JOIN {CHANGED_LINES} l ON o_orderkey = l_orderkey GROUP BY o_custkey""",

})
