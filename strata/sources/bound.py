"""Reading files of several generations by one declared schema.

A table's directory may hold files written before and after its schema changed.  Spark
resolves a declared schema against each file by name: a column that a file lacks is NULL
there, and a number stored in a narrower type is widened as it is read.  Columns that were
renamed are bound to their former names as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

from strata.operators.evolution import is_widening


def file_types(spark: SparkSession, paths: list[str]) -> dict[str, set[str]]:
    """Column (lower case) -> the types that the given files or directories store it in."""
    found: dict[str, set[str]] = {}
    for path in paths:
        for f in spark.read.parquet(path).schema.fields:
            found.setdefault(f.name.lower(), set()).add(f.dataType.simpleString())
    return found


def refuse_unbound(schema: StructType, stored: StructType, former: dict[str, list[str]] | None = None) -> None:
    """Raise if a stored column can't be read as declared: its type must be the declared
    one or a narrower one."""
    types = {f.name.lower(): f.dataType for f in stored.fields}
    for f in schema.fields:
        for name in (f.name, *(former or {}).get(f.name, ())):
            own: DataType | None = types.get(name.lower())
            if own is not None and own != f.dataType and not is_widening(own, f.dataType):
                raise ValueError(f"{name}: stored as {own.simpleString()}, declared as {f.dataType.simpleString()}")


def read_bound(spark: SparkSession, path: str, schema: StructType, former: dict[str, list[str]] | None = None) -> DataFrame:
    """The table at ``path``, old files and new ones, with the columns of ``schema``.

    ``former`` gives the names that a column had in older files; the first of its names
    that a file has a value under counts.  One scan: no file is rewritten, and files are
    not read apart.  A file whose type is neither the declared one nor narrower fails the
    read (``refuse_unbound`` tells beforehand, from a file's schema).
    """
    names = {f.name: [f.name, *(former or {}).get(f.name, ())] for f in schema.fields}
    taken = [n.lower() for own in names.values() for n in own]
    if len(set(taken)) < len(taken):
        raise ValueError("a name is bound to two columns")
    physical = StructType([StructField(n, f.dataType, True) for f in schema.fields for n in names[f.name]])
    rows = spark.read.schema(physical).parquet(path)
    return rows.select(*[F.coalesce(*[F.col(f"`{n}`") for n in names[f.name]]).alias(f.name) for f in schema.fields])
