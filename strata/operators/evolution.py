"""Schema steps as projections at read time: add, drop, rename and widen a column.

A step takes the table as read and returns it as it should look; nothing is
rewritten.  Every row read through an added column is NULL, whatever an older,
dropped column of that name held, because the column is made here and not bound to
the files by name.  Written back with ``tables.publish``, the new schema is the
files'; as a view (``register``), it is the readers'.

Names compare without case, as Spark resolves them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType,
    ShortType, _parse_datatype_string,
)


def _found(df: DataFrame, name: str) -> str:
    """The column's own spelling."""
    for c in df.columns:
        if c.lower() == name.lower():
            return c
    raise ValueError(f"no column {name}")


def _free(df: DataFrame, name: str) -> None:
    if name.lower() in (c.lower() for c in df.columns):
        raise ValueError(f"column {name} already exists")


def _not_partition(name: str, partition_by: str | None, step: str) -> None:
    if partition_by and name.lower() == partition_by.lower():
        raise ValueError(f"cannot {step} the partition column {name}")


def _type(data_type: str | DataType) -> DataType:
    return _parse_datatype_string(data_type) if isinstance(data_type, str) else data_type


def add_column(df: DataFrame, name: str, data_type: str | DataType) -> DataFrame:
    _free(df, name)
    return df.select("*", F.lit(None).cast(_type(data_type)).alias(name))


def drop_column(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    own = _found(df, name)
    _not_partition(own, partition_by, "drop")
    return df.select(*[F.col(f"`{c}`") for c in df.columns if c != own])


def rename_column(df: DataFrame, old: str, new: str, partition_by: str | None = None) -> DataFrame:
    own = _found(df, old)
    _not_partition(own, partition_by, "rename")
    if own.lower() != new.lower():
        _free(df, new)
    return df.select(*[F.col(f"`{c}`").alias(new if c == own else c) for c in df.columns])


_INTEGRAL = {ByteType: 1, ShortType: 2, IntegerType: 3, LongType: 4}
_DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 19}


def is_widening(src: DataType, dst: DataType) -> bool:
    """Whether ``dst`` holds every value of ``src`` and is another type."""
    if src == dst:
        return False
    if type(src) in _INTEGRAL and type(dst) in _INTEGRAL:
        return _INTEGRAL[type(dst)] > _INTEGRAL[type(src)]
    if isinstance(src, FloatType):
        return isinstance(dst, DoubleType)
    if isinstance(dst, DecimalType):
        whole = dst.precision - dst.scale
        if isinstance(src, DecimalType):
            return dst.scale >= src.scale and whole >= src.precision - src.scale
        return type(src) in _DIGITS and whole >= _DIGITS[type(src)]
    return False


def widen_column(df: DataFrame, name: str, data_type: str | DataType) -> DataFrame:
    own, dst = _found(df, name), _type(data_type)
    src = df.schema[own].dataType
    if not is_widening(src, dst):
        raise ValueError(f"{own}: {src.simpleString()} to {dst.simpleString()} is not widening")
    return df.select(*[F.col(f"`{c}`").cast(dst).alias(c) if c == own else F.col(f"`{c}`") for c in df.columns])


def register(df: DataFrame, view: str) -> str:
    """Readers of ``view`` see the evolved table."""
    df.createOrReplaceTempView(view)
    return view
