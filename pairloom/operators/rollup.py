"""Rolling a word matrix up to coarser codes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import high, low, required
from pairloom.scratch import broadcast_if_small, stage

# The vocabularies kept by default.
KEPT_SOURCES = (1, 2, 5)

# monotonically_increasing_id keeps the partition above this bit and the position below it.
_POSITION_BITS = 33


def dedupe_mapping(mapping: DataFrame, order_col: str | None = None) -> DataFrame:
    """One row per word, the last by ``order_col``; equal order falls back on Source and Code.

    Without ``order_col`` nothing says which row is the last, so a word with several fails the query.
    """
    rank = [F.col(order_col)] if order_col else []
    last = F.max_by(F.struct("Source", "Code"), F.struct(*rank, "Source", "Code")).alias("last")
    word = required(F.col("WordIndex"), "WordIndex").alias("WordIndex")
    words = mapping.groupBy(word).agg(last, F.count(F.lit(1)).alias("rows"))
    if order_col is None:
        message = F.concat(F.lit("several rows and no order for word "), F.col("WordIndex").cast("string"))
        words = words.withColumn("last", F.when(F.col("rows") == 1, F.col("last")).otherwise(F.raise_error(message)))
    return words.select("WordIndex", "last.Source", "last.Code")


def dense_index(mapping: DataFrame) -> DataFrame:
    """``(Code, NewIndex)``: the distinct codes numbered from 0 in byte order.

    Codes are range partitioned and sorted in parallel, the position inside a partition comes from
    the row id, and the sizes of the partitions before it are added. Only that list of partition
    sizes goes through a single window. The sorted table is written first, so a task that is run
    again cannot see other partition bounds.
    """
    codes = mapping.select(required(F.col("Code"), "Code").alias("Code")).distinct()
    ordered = codes.repartitionByRange("Code").sortWithinPartitions("Code")
    row_id = F.monotonically_increasing_id()
    numbered = stage(
        ordered.select(
            "Code",
            F.shiftright(row_id, _POSITION_BITS).cast("int").alias("part"),
            row_id.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("position"),
        ),
        "codes",
    ).df
    sizes = numbered.groupBy("part").agg(F.count(F.lit(1)).alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    index = (F.col("position") + F.col("offset")).cast("int")
    # One row per partition: bounded by the number of shuffle partitions.
    return numbered.join(F.broadcast(offsets), "part").select("Code", index.alias("NewIndex"))


def mapping_stats(mapping: DataFrame) -> DataFrame:
    """One row ``(words, codes)``: distinct words mapped and distinct codes."""
    return mapping.agg(
        F.countDistinct("WordIndex").alias("words"),
        F.countDistinct("Code").alias("codes"),
    )


def rollup(
    matrix: DataFrame,
    mapping: DataFrame,
    sources: Sequence[int] = KEPT_SOURCES,
    order_col: str | None = None,
) -> DataFrame:
    """Count matrix over code indexes.

    Pairs with an unmapped word or a source outside ``sources`` are left out. The index covers every
    code of the mapping, also codes that no kept word uses. Input that holds both (i, j) and (j, i)
    is folded onto one cell and added.
    """
    codes = dense_index(mapping)
    words = dedupe_mapping(mapping, order_col).filter(F.col("Source").isin(*sources))
    kept = stage(words.join(codes, "Code").select("WordIndex", "NewIndex"), "kept-words")
    rows = kept.count()

    def renamed(key: str, name: str) -> DataFrame:
        table = kept.df.select(F.col("WordIndex").alias(key), F.col("NewIndex").alias(name))
        return broadcast_if_small(table, rows, 64)

    cells = matrix.select(
        required(F.col("i"), "i").cast("bigint").alias("word_i"),
        required(F.col("j"), "j").cast("bigint").alias("word_j"),
        required(F.col("count"), "count").alias("count"),
    )
    mapped = cells.join(renamed("word_i", "new_i"), "word_i").join(renamed("word_j", "new_j"), "word_j")
    return mapped.groupBy(
        low(F.col("new_i"), F.col("new_j")).alias("i"),
        high(F.col("new_i"), F.col("new_j")).alias("j"),
    ).agg(F.sum("count").alias("count"))
