"""Data-quality checks.  Each check is one aggregate (one scan per input)
returning a small DataFrame; nothing is collected to decide pass/fail
until the caller asks (``assert_check``)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def row_counts(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """(layer, table_name, row_count) for every table, one DataFrame."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count"))
          .select(F.lit(layer).alias("layer"), F.lit(name).alias("table_name"), "row_count")
        for (layer, name), df in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def raw_rows(spark, path: str, header: bool = True) -> DataFrame:
    """Data lines in delimited raw files: non-blank lines, minus one header
    line per file when the files carry headers.  One scan of the text."""
    lines = (spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
             .filter(F.trim(F.col("value")) != ""))
    files = F.count_distinct("file") if header else F.lit(0)
    return lines.agg((F.count(F.lit(1)) - files).alias("raw_rows"))


def bronze_matches_raw(spark, path: str, bronze: DataFrame, table: str,
                       header: bool = True) -> DataFrame:
    """(table_name, raw_rows, bronze_rows, equal) for one ingested table."""
    r = raw_rows(spark, path, header)
    b = bronze.agg(F.count(F.lit(1)).alias("bronze_rows"))
    both = (r.select(F.col("raw_rows").alias("n"), F.lit("raw").alias("side"))
            .unionByName(b.select(F.col("bronze_rows").alias("n"), F.lit("bronze").alias("side"))))
    raw_n = F.max(F.when(F.col("side") == "raw", F.col("n")))
    bronze_n = F.max(F.when(F.col("side") == "bronze", F.col("n")))
    return both.agg(F.lit(table).alias("table_name"), raw_n.alias("raw_rows"),
                    bronze_n.alias("bronze_rows"), (raw_n == bronze_n).alias("equal"))


def null_keys(df: DataFrame, key: str) -> DataFrame:
    """Rows and NULL-key rows (the SQL-text predicate form)."""
    return df.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(F.expr(f"{key} IS NULL")).alias("null_keys"),
    )


def revenue_positive(daily: DataFrame) -> DataFrame:
    """Days whose total revenue is not positive (NULL counts as failing)."""
    bad = F.col("total_revenue").isNull() | (F.col("total_revenue") <= 0)
    return daily.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.count_if(bad).alias("non_positive"),
    )


#: Neighbouring rows that one window of the sortedness check holds.
BLOCK_ROWS = 65_536


def _wrong_way(value, tie, next_value, next_tie):
    """Whether the first row should stand after the second: a smaller value (NULL
    smallest) before a larger one, or on equal values a larger ``tie`` first."""
    return ((value < next_value) | (value.isNull() & next_value.isNotNull())
            | (value.eqNullSafe(next_value) & F.coalesce(tie > next_tie, F.lit(False))))


def _chained(rows: DataFrame, group: list[str], order: str) -> DataFrame:
    """Rows (.., order, n, wrong, first, last) in sequence become one for each ``group``:
    its first and last row, and the pairs of neighbours that stand the wrong way round."""
    before = F.lag("last").over(Window.partitionBy(*group).orderBy(order))
    joint = F.coalesce(_wrong_way(before["v"], before["t"], F.col("first.v"), F.col("first.t")) & before.isNotNull(), F.lit(False))
    return rows.withColumn("joint", joint.cast("long")).groupBy(*group).agg(
        F.sum("n").alias("n"), F.sum(F.col("wrong") + F.col("joint")).alias("wrong"),
        F.min_by("first", order).alias("first"), F.max_by("last", order).alias("last"))


def sorted_desc(report: DataFrame, value: str, tie: str) -> DataFrame:
    """(checked_rows, out_of_order): neighbours of a report or table, in the order in which
    it returns its rows, that should stand the other way round.

    Rows are numbered as they come, by task and place, and never sorted by the value.
    Neighbours are compared in blocks of BLOCK_ROWS, a task's blocks are then chained by
    their first and last rows, and last the tasks by theirs: one row a task is all that
    comes together, whatever the size of the table.
    """
    at = F.col("_at")
    numbered = report.select(F.col(value).alias("v"), F.col(tie).alias("t"), F.monotonically_increasing_id().alias("_at")).select(
        "v", "t", "_at", F.shiftright(at, 33).alias("_task"),
        F.floor(at.bitwiseAND(F.lit(2**33 - 1)) / BLOCK_ROWS).alias("_block"))
    own = ["_task", "_block"]
    row = F.struct("v", "t")
    before = F.lag(row).over(Window.partitionBy(*own).orderBy("_at"))
    wrong = F.coalesce(_wrong_way(before["v"], before["t"], F.col("v"), F.col("t")) & before.isNotNull(), F.lit(False))
    blocks = numbered.withColumn("wrong", wrong.cast("long")).groupBy(*own).agg(
        F.count(F.lit(1)).alias("n"), F.sum("wrong").alias("wrong"),
        F.min_by(row, "_at").alias("first"), F.max_by(row, "_at").alias("last"))
    tasks = _chained(blocks, ["_task"], "_block")
    ends = F.sort_array(F.collect_list(F.struct("_task", "first", "last")))
    pairs = lambda e: F.zip_with(F.slice(e, 1, F.greatest(F.size(e) - 1, F.lit(0))), F.slice(e, 2, F.size(e)), lambda x, y: F.coalesce(
        _wrong_way(x["last"]["v"], x["last"]["t"], y["first"]["v"], y["first"]["t"]), F.lit(False)))
    whole = tasks.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("checked_rows"), F.coalesce(F.sum("wrong"), F.lit(0)).alias("inside"), ends.alias("ends"))
    return whole.select("checked_rows", (F.col("inside") + F.size(F.filter(pairs(F.col("ends")), lambda w: w))).cast("long").alias("out_of_order"))


def top_n_complete(full: DataFrame, report: DataFrame, value: str, key: str) -> DataFrame:
    """(report_rows, missed): rows outside a top-N report that rank above its
    last row.  Zero means the report really holds the top N.

    The report's size and lowest value are scalar subqueries of one plan; no job
    starts before the check does.
    """
    lowest = report.agg(F.min(value)).scalar()
    rows = report.agg(F.count(F.lit(1))).scalar()
    outside = full.join(report.select(key), key, "left_anti").select(value)
    return outside.agg(rows.alias("report_rows"), F.count_if(F.col(value) > lowest).alias("missed"))


def assert_check(result: DataFrame, **expected) -> None:
    """Collect the one-row check result and compare named fields."""
    row = result.first().asDict()
    wrong = {k: (row[k], v) for k, v in expected.items() if row[k] != v}
    if wrong:
        raise AssertionError(f"check failed: {wrong}")
