"""Tolerant typing of raw values.

Spark 4 runs with ANSI mode on: a plain ``cast`` or ``to_date`` of malformed
text fails the whole job.  The clean layer must instead turn a bad value into
NULL (the behaviour of the non-ANSI engine the job was written for), so every
conversion here is a ``try_`` form.  Inputs may be raw text (text ingest) or
already typed columns (Parquet sources carry doubles and timestamps); both
land on the same clean types.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType

from strata.schemas import DATE_FORMAT, MONEY


def to_money(col: Column) -> Column:
    """Text or number -> decimal(15,2); rounds half up; bad or too large -> NULL."""
    return col.try_cast(MONEY)


def to_day(col: Column, source_type: DataType) -> Column:
    """Text ``yyyy-MM-dd`` (zero padded) or timestamp -> date; bad -> NULL."""
    if isinstance(source_type, StringType):
        return F.try_to_date(col, DATE_FORMAT)
    if isinstance(source_type, DateType):
        return col
    return col.try_cast(DateType())


def typed(df: DataFrame, money: tuple[str, ...] | list[str],
          dates: tuple[str, ...] | list[str]) -> dict[str, Column]:
    """Replacement expressions for the money and date columns present in ``df``."""
    present = {f.name.lower(): f for f in df.schema.fields}
    out: dict[str, Column] = {}
    for name in money:
        if name in present:
            out[present[name].name] = to_money(F.col(present[name].name))
    for name in dates:
        if name in present:
            field = present[name]
            out[field.name] = to_day(F.col(field.name), field.dataType)
    return out
