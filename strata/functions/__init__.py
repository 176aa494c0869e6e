"""Column expressions used by the layers (all JVM-side built-ins)."""

from strata.functions.casts import to_day, to_money, typed
from strata.functions.measures import revenue

__all__ = ["to_day", "to_money", "typed", "revenue"]
