"""Relational operators of the three layers, as DataFrame -> DataFrame functions."""

from strata.operators import analyst, checks, gold, silver

__all__ = ["analyst", "checks", "gold", "silver"]
