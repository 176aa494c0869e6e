"""Derived measures."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def revenue(extended_price: Column, discount: Column) -> Column:
    """price * (1 - discount) on exact decimals.

    The literal must stay the integer 1: with decimal(15,2) inputs the result
    is decimal(32,4) and keeps all four decimals.  A float literal or any
    rounding here would change every downstream sum.
    """
    return extended_price * (F.lit(1) - discount)
