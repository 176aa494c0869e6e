"""Raw text split into accepted rows and rejected lines, in one pass.

The tolerant read turns what it can't parse into NULL.  Here each line keeps its raw text
and gets the reasons for which it can't be taken as it stands:

* ``bad_key``: the key is missing or no number (the clean layer's gate would drop it);
* ``bad_money``: a money field has text that is no decimal of its type;
* ``bad_date``: a date field has text that is no date of the declared format.

Empty and missing fields other than the key are NULL and no reason.  A line without a
reason is accepted, so every line is on exactly one side.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from strata.functions.casts import to_day, to_money
from strata.schemas import DATE_COLUMNS, KEY_COLUMNS, MONEY_COLUMNS, raw_schema
from strata.sinks.writes import write_table

REASONS = ("bad_key", "bad_money", "bad_date")


def parsed_lines(spark: SparkSession, path: str, table: str, *, header: bool = True, sep: str = "|",
                 columns: list[str] | None = None) -> DataFrame:
    """(line, fields of the declared schema as text) of every non-blank line; a file's
    header, the declared names, is no line."""
    schema = raw_schema(table, columns)
    text = ", ".join(f"{f.name} string" for f in schema.fields)
    lines = spark.read.text(path).where(F.trim("value") != "")
    if header:
        lines = lines.where(F.lower(F.trim("value")) != sep.join(f.name for f in schema.fields))
    return lines.select(F.col("value").alias("line"), F.from_csv("value", text, {"sep": sep}).alias("f"))


def _unreadable(raw: Column, typed: Column) -> Column:
    return raw.isNotNull() & (F.trim(raw) != "") & typed.isNull()


def checked_lines(lines: DataFrame, table: str) -> DataFrame:
    """(line, reasons, columns of the raw schema): keys and other numbers typed, money and
    dates still text."""
    types = {f.name: f.dataType for f in raw_schema(table).fields}
    fields = [f.name for f in lines.schema["f"].dataType.fields]
    key = KEY_COLUMNS[table]
    number = lambda c: F.when(F.col(f"f.{c}").rlike(r"^[+-]?\d+$"), F.col(f"f.{c}").try_cast(types[c]))
    text = lambda names: [F.col(f"f.{c}") for c in names if c in fields]
    bad = {
        "bad_key": [number(key).isNull()],
        "bad_money": [_unreadable(c, to_money(c)) for c in text(MONEY_COLUMNS[table])],
        "bad_date": [_unreadable(c, to_day(c, StringType())) for c in text(DATE_COLUMNS[table])],
    }
    found = [F.when(F.array_contains(F.array(*bad[r]), True), F.lit(r)) for r in REASONS if bad[r]]
    reasons = F.filter(F.array(*found), lambda r: r.isNotNull())
    typed = [F.col(f"f.{c}").alias(c) if types[c] == StringType() else number(c).alias(c) for c in fields]
    return lines.select("line", reasons.alias("reasons"), *typed)


def split_raw(spark: SparkSession, path: str, table: str, out: str, *, header: bool = True, sep: str = "|",
              columns: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Read the raw lines once and store both sides under ``out``; returns (accepted rows
    with the raw schema's columns, rejected as (line, reasons))."""
    checked = checked_lines(parsed_lines(spark, path, table, header=header, sep=sep, columns=columns), table)
    rejected = F.size("reasons") > 0
    side = checked.select("*", F.when(rejected, "rejected").otherwise("accepted").alias("side"))
    # Accepted lines need no raw text, rejected ones no fields: neither is stored twice.
    fields = [c for c in checked.columns if c not in ("line", "reasons")]
    slim = side.select(F.when(rejected, F.col("line")).alias("line"), F.when(rejected, F.col("reasons")).alias("reasons"),
                       *[F.when(~rejected, F.col(c)).alias(c) for c in fields], "side")
    write_table(slim, out, partition_by="side")
    stored = spark.read.schema(slim.schema).parquet(out)
    return (stored.where("side = 'accepted'").select(fields),
            stored.where("side = 'rejected'").select("line", "reasons"))
