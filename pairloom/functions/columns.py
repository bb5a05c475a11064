"""Column expressions shared by the operators.

All are built-in functions. Those on array columns (:func:`dot`, :func:`cosine_distance`) walk
their arrays by an interpreted lambda; the others are part of the generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def required(column: Column, what: str) -> Column:
    """The column itself; a null in it fails the query."""
    return F.coalesce(column, F.raise_error(F.lit(f"null in {what}")))


def low(a: Column, b: Column) -> Column:
    """First half of the unordered pair key."""
    return F.least(a, b)


def high(a: Column, b: Column) -> Column:
    """Second half of the unordered pair key."""
    return F.greatest(a, b)


def epoch_day(timestamp: Column) -> Column:
    """Integer day number of a date or timestamp."""
    return F.unix_date(timestamp.cast("date"))


def band_start(day: Column, width: int) -> Column:
    """First day of the fixed band of ``width`` days that holds ``day`` (right for negative days too)."""
    return day - F.pmod(day, F.lit(width).cast("bigint"))


def pmi_score(count: Column, total: Column, word: Column, context: Column, alpha: float) -> Column:
    """log2(count * total / (word * context ** alpha)); minus infinity for a zero count."""
    ratio = count * total / (word * F.pow(context.cast("double"), F.lit(float(alpha))))
    return F.when(count == 0, F.lit(float("-inf"))).otherwise(F.log2(ratio))


def positive(score: Column) -> Column:
    """The score clipped at zero. A null score is a bug upstream and must not turn into zero."""
    return F.greatest(F.lit(0.0), required(score, "score"))


def dot(a: Column, b: Column) -> Column:
    """Inner product of two array columns of equal length."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda acc, x: acc + x)


def cosine_distance(a: Column, b: Column) -> Column:
    """1 - cos(a, b) in one walk over the arrays; null when either has no length or is all zeros."""
    zero = F.lit(0.0)
    sums = F.aggregate(
        F.arrays_zip(a.alias("x"), b.alias("y")),
        F.struct(zero.alias("xy"), zero.alias("xx"), zero.alias("yy")),
        lambda acc, term: F.struct(
            (acc["xy"] + term["x"] * term["y"]).alias("xy"),
            (acc["xx"] + term["x"] * term["x"]).alias("xx"),
            (acc["yy"] + term["y"] * term["y"]).alias("yy"),
        ),
        lambda acc: acc["xy"] / F.nullif(F.sqrt(acc["xx"] * acc["yy"]), zero),
    )
    return F.lit(1.0) - sums
