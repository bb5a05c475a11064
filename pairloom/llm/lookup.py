"""Lookups of a keyed table for every row of a large one, safe when one key holds a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.text import free_name
from pairloom.scratch import broadcast_if_small

# A key is heavy from one row in so many; there are never more heavy keys than this.
HEAVY = 1000


def lookup(rows: DataFrame, table: DataFrame, keys: list[str], members: str, *, row_bytes: int = 64, total: int | None = None) -> DataFrame:
    """``rows`` joined with their row of ``table``, which has one row for each key; rows without one go.

    ``members`` counts the rows of each key. A table that is small by its counted rows is broadcast. Of a
    larger one only the heavy keys are, at most :data:`HEAVY` by their definition, whatever the size of
    the tables; the rows of the other keys move by key, and none of these has more than a
    thousandth of them. Nulls of keys do not match. ``rows`` is read twice, so it should be a stored table.
    """
    facts = table.agg(F.count(F.lit(1)).alias("keys"), F.sum(members).alias("members")).first()
    few = broadcast_if_small(table, facts["keys"], row_bytes)
    if few is not table:
        return rows.join(few, keys)
    least = F.lit(max(1, (total or facts["members"] or 0) // HEAVY))
    mark = free_name(rows.join(table.limit(0), keys), "is_heavy")
    heavy = table.filter(F.col(members) >= least)
    hot = rows.join(F.broadcast(heavy), keys)
    cold = rows.join(F.broadcast(heavy.select(*keys, F.lit(True).alias(mark))), keys, "left_anti")
    return hot.unionByName(cold.join(table.filter(F.col(members) < least), keys).select(*hot.columns))


def salted_lookup(rows: DataFrame, table: DataFrame, keys: list[str], members: str) -> DataFrame:
    """As :func:`lookup`, for ``rows`` that are dear to read: they are read once.

    The rows of a heavy key are dealt to as many parts as they are thousandths of all rows, and its row of the table is copied
    to each part. There are at most :data:`HEAVY` heavy keys, which are broadcast, and so at most twice as many copies.
    """
    total = table.agg(F.sum(members)).first()[0] or 0
    least = max(1, -(-total // HEAVY))
    both = rows.join(table.limit(0), keys)
    part, parts = free_name(both, "part_of_key"), free_name(both, "parts_of_key")
    counted = table.withColumn(parts, F.when(F.col(members) >= least, F.ceil(F.col(members) / least)).otherwise(1).cast("long"))
    heavy = F.broadcast(counted.filter(F.col(members) >= least).select(*keys, parts))
    dealt = rows.join(heavy, keys, "left")
    dealt = dealt.withColumn(part, F.pmod(F.monotonically_increasing_id(), F.coalesce(parts, F.lit(1).cast("long")))).drop(parts)
    zero = F.lit(0).cast("long")
    copied = counted.withColumn(part, F.explode(F.sequence(zero, F.col(parts) - 1))).drop(parts)
    return dealt.join(copied, [*keys, part]).drop(part)
