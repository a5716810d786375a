"""Money is DECIMAL(18,2) in records and whole cents (BIGINT) in arithmetic."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallybrook.schemas import MONEY

# Below this many cents the product of two amounts, doubled, fits a BIGINT.
_SMALL = 1 << 30


def money(value: Column) -> Column:
    """A number as DECIMAL(18,2), rounded half up."""
    return value.cast(MONEY)


def cents(value: Column) -> Column:
    """A DECIMAL(18,2) amount as whole cents."""
    return (value * 100).cast("bigint")


def from_cents(value: Column) -> Column:
    """Whole cents as DECIMAL(18,2)."""
    return (value.cast("decimal(20,0)") / 100).cast(MONEY)


def proportion(total: Column, part: Column, whole: Column) -> Column:
    """``total * part / whole`` rounded half up, all non-negative whole cents.

    Null where ``whole`` is zero. The product is a BIGINT while both factors are
    small and a DECIMAL(38,0) beyond, so it never overflows silently.
    """
    twice = F.nullif(whole * 2, F.lit(0).cast("bigint"))
    narrow = F.call_function("div", total * part * 2 + whole, twice)
    wide_total = total.cast("decimal(18,0)").cast("decimal(38,0)")
    wide = F.call_function(
        "div", wide_total * part * 2 + whole, twice.cast("decimal(38,0)")
    )
    return F.when((total < _SMALL) & (part < _SMALL), narrow).otherwise(wide)
