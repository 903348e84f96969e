"""Array expressions used by the native operators (whole arrays inside one row, no shuffle)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

RADIX, PASSES = 16, 6  # arrays of up to 16 million entries


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), body)[0]


def scan(values: Column, join: Callable[[Column, Column], Column], step: int = 1) -> Column:
    """Running ``join`` (null-skipping: ``a``, ``b`` may be NULL) over an array, from the left or (``step=-1``) the
    right, in ``n log n`` steps; short arrays take one pass."""
    def one(width: int) -> Callable[[Column], Column]:
        def over(a: Column) -> Column:
            def entry(x: Column, i: Column) -> Column:
                for k in range(1, RADIX):
                    x = join(x, F.get(a, i - step * k * width))
                return x

            return F.when(F.size(a) > width, F.transform(a, entry)).otherwise(a)

        return over

    for level in range(PASSES):
        values = let(values, one(RADIX ** level))
    return values


def total(a: Column, b: Column) -> Column:
    return a + F.coalesce(b, F.lit(0))


def largest(a: Column, b: Column) -> Column:
    return F.greatest(a, b)


def least(a: Column, b: Column) -> Column:
    return F.least(a, b)


def shifted(values: Column, by: int) -> Column:
    """The entry ``by`` places earlier, NULL outside."""
    return let(values, lambda v: F.transform(v, lambda _, i: F.get(v, i - by)))
