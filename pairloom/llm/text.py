"""Column expressions on whole texts, and helpers that several operators share."""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words are runs of anything but these ASCII blanks.
SPACED_WORD = r"[^\x20\x09-\x0D]+"
# Words are runs of ASCII letters and digits and of anything outside ASCII.
PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def whole(text: Column) -> Column:
    """The text as a string; null counts as empty."""
    return F.coalesce(text.cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``text`` with only A to Z lower-cased; null counts as empty.

    ``lower`` also changes letters outside ASCII, so it serves only texts that have none.
    """
    full = whole(text)
    return F.when(F.length(full) == F.octet_length(full), F.lower(full)).otherwise(
        F.translate(full, string.ascii_uppercase, string.ascii_lowercase)
    )


def spaced_words(text: Column) -> Column:
    """Number of words between ASCII blanks."""
    return F.regexp_count(whole(text), F.lit(SPACED_WORD)).cast("long")


def has_repeats(df: DataFrame, *columns: str) -> bool:
    """Whether rows repeat a key. Counts only ride through the shuffle."""
    return not df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").isEmpty()


def free_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores in front until no column of ``df`` has it."""
    taken = {column.lower() for column in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
