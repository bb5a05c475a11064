"""Exact duplicates by skew-safe combining."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.lookup import salted_lookup
from pairloom.llm.text import ascii_lower
from pairloom.scratch import stage


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _combine(rows: DataFrame, salts: int) -> DataFrame:
    """``(digest, content, keep, n)`` per distinct content.

    Every step groups by the content itself, so rows meet only when all their characters agree.
    The salt is that of the input partition: a task adds up its own copies before anything is
    shuffled, a salted group takes the copies of some tasks, and the last step gets at most
    ``salts`` rows of any content.
    """
    local = rows.withColumn("salt", F.pmod(F.spark_partition_id(), F.lit(salts)))
    salted = local.groupBy("salt", "digest", "content").agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    # Dealt by digest alone, so that the count of contents per digest needs no further shuffle.
    dealt = salted.select("digest", "content", "keep", "n").repartition("digest")
    return dealt.groupBy("digest", "content").agg(F.max("keep").alias("keep"), F.sum("n").alias("n"))


def exact_duplicates(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    salts: int = 16,
    digest: Callable[[Column], Column] = sha256,
) -> DataFrame:
    """``(id_col, keep_id, group_size, kept, text_sha256)``, a row for every row of ``docs``.

    Texts are equal when they are identical after lower-casing A to Z. Of equal texts the row with
    the largest id stays. A null text counts as empty and equals other empty texts. A null id is
    smaller than any other; when a group has no other, ``keep_id`` is null and its rows are kept.
    Rows that agree in id and text are all marked as kept or all as dropped, and each counts in
    ``group_size``. Other columns are not read, whatever their names. An empty table gives no rows.

    Very long texts are taken whole. Winners go back to the documents by digest, those of large groups in several parts. A digest that stands for several contents, which
    the combining step counts, goes back by digest and content instead.
    """
    rows = docs.select(F.col(id_col).alias("id"), ascii_lower(F.col(text_col)).alias("content"))
    rows = rows.withColumn("digest", digest(F.col("content")))
    per_digest = (
        _combine(rows, salts)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("contents"), F.max("keep").alias("keep"), F.sum("n").alias("n"))
    )
    winners = stage(per_digest, "exact-winners").df
    single = winners.filter("contents = 1").select("digest", "keep", "n")
    keys = rows.select("id", "digest", F.sha2("content", 256).alias("hash"))
    found = salted_lookup(keys, single, ["digest"], "n").select("id", "keep", "n", "hash")
    shared = winners.filter("contents > 1").select("digest")
    if not shared.isEmpty():
        again = rows.join(shared, "digest", "left_semi")
        several = again.join(_combine(again, salts), ["digest", "content"])
        found = found.unionByName(several.select("id", "keep", "n", F.sha2("content", 256).alias("hash")))
    return found.select(
        F.col("id").alias(id_col),
        F.col("keep").alias("keep_id"),
        F.col("n").alias("group_size"),
        F.col("id").eqNullSafe(F.col("keep")).alias("kept"),
        F.col("hash").alias("text_sha256"),
    )
