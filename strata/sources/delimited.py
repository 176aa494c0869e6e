"""Delimited-text sources (raw layer input) and their text export.

Reads are always under a declared schema: no inference pass over the data,
columns bind by position, the header line (if any) is skipped, and PERMISSIVE
mode turns an unparsable field into NULL, fills missing trailing fields with
NULL and drops extra ones.  Uncompressed text is splittable, so a large raw
file is scanned by many tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DateType, StringType, StructType, TimestampNTZType, TimestampType,
)

from strata.functions.casts import to_money
from strata.schemas import DATE_COLUMNS, MONEY_COLUMNS, SOURCE_TABLES, raw_schema

DEFAULT_SEP = "|"


def source_path(base: str, table: str, suffix: str = ".csv") -> str:
    """``<base><table>.csv``: a single file or a directory of part files."""
    sep = "" if base.endswith("/") else "/"
    return f"{base}{sep}{table}{suffix}"


def read_delimited(spark: SparkSession, path: str, table: str, *, header: bool = True,
                   sep: str = DEFAULT_SEP, columns: list[str] | None = None,
                   mode: str = "PERMISSIVE", schema: StructType | None = None) -> DataFrame:
    """Raw table from delimited text under the table's declared schema.

    ``header`` is a parameter because real TPC-H ``.tbl`` files have none (and
    a trailing delimiter, whose empty extra field PERMISSIVE mode drops).
    ``columns`` restricts the schema to a leading subset of the declared
    columns for files that carry only those; with a header, a file that has other
    or more columns is then refused rather than cut.  ``schema`` overrides the
    declared schema entirely (other raw tables).
    """
    reader = spark.read
    if header and columns is not None:
        reader = reader.option("enforceSchema", "false")
    return (
        reader
        .option("header", "true" if header else "false")
        .option("sep", sep)
        .option("mode", mode)
        .schema(schema if schema is not None else raw_schema(table, columns))
        .csv(path)
    )


def read_raw_tables(spark: SparkSession, base: str, tables=SOURCE_TABLES, **options
                    ) -> dict[str, DataFrame]:
    """The ingest loop: one lazily-defined raw DataFrame per source table."""
    return {t: read_delimited(spark, source_path(base, t), t, **options) for t in tables}


def as_raw_text(df: DataFrame, table: str) -> DataFrame:
    """Render a typed table the way raw TPC-H text carries it: money as plain
    decimal text with two places, dates as ``yyyy-MM-dd``; other columns as is."""
    money = set(MONEY_COLUMNS.get(table, ()))
    dates = set(DATE_COLUMNS.get(table, ()))
    exprs = []
    for field in df.schema.fields:
        name = field.name
        c = F.col(name)
        if name.lower() in money and not isinstance(field.dataType, StringType):
            c = to_money(c).cast("string")
        elif name.lower() in dates and isinstance(
                field.dataType, (DateType, TimestampType, TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd")
        exprs.append(c.alias(name))
    return df.select(*exprs)


def write_delimited(df: DataFrame, path: str, *, header: bool = True,
                    sep: str = DEFAULT_SEP) -> None:
    """Write text the raw reader accepts (one part file per task)."""
    (df.write.mode("overwrite")
       .option("header", "true" if header else "false")
       .option("sep", sep)
       .csv(path))
