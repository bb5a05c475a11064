"""Corpus pipeline: each stage reads the documents that the one before it wrote.

All stages read ``doc_id``, ``text`` and ``source``, and keep any other column as it is, whatever
its name. Very long texts are taken whole. A null text counts as empty; an empty text is a clean document, and of several the exact
dedup keeps one. A null id is an id of its own. An empty table goes through as an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.exact_dedup import exact_duplicates
from pairloom.llm.mixing import whole_copies
from pairloom.llm.ngram_join import ngram_join
from pairloom.llm.packing import pack_documents
from pairloom.llm.text import SPACED_WORD, ascii_lower, free_name, has_repeats, whole
from pairloom.llm.toxicity import fit_toxicity
from pairloom.scratch import broadcast_if_small, kept_result, small_batches, stage


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not take for toxic. It learns from the labels of ``sf_dir``.

    They are written here, as the size of the batches of texts that go to Python is set only while a table is written.
    """

    def left() -> DataFrame:
        model = fit_toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
        return docs.filter(model.score(F.col("text")) < 0.5)

    with small_batches(spark):
        return kept_result(spark, left, "toxicity-left")


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id.

    Rows that repeat both id and text leave one row.
    """
    decided = stage(exact_duplicates(docs), "pipeline-exact").df
    id_, hash_, content = (free_name(docs, name) for name in ("dropped_id", "dropped_hash", "content"))
    dropped = decided.filter("NOT kept").select(F.col("doc_id").alias(id_), F.col("text_sha256").alias(hash_)).distinct()
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.sha2(ascii_lower(F.col("text")), 256) == F.col(hash_))
    # The list of dropped rows is the short one; documents move only when it is too large to broadcast.
    left = docs.join(broadcast_if_small(dropped, dropped.count(), 128), same, "left_anti")
    if has_repeats(decided.filter("kept"), "doc_id", "text_sha256"):
        left = left.withColumn(content, ascii_lower(F.col("text"))).dropDuplicates(["doc_id", content]).drop(content)
    return left


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one with the smallest id stays. Rows that repeat an id stay or go together.

    Texts link from 80 hundredths of common runs of five words; op10's query has a rule of its own.
    """
    decided = stage(ngram_join(docs, size=5, percent=80), "pipeline-near").df
    id_ = free_name(docs, "dropped_id")
    stays = F.col("doc_id").eqNullSafe(F.col("component_id"))
    dropped = decided.groupBy(F.col("doc_id").alias(id_)).agg(F.max(stays).alias("stays")).filter("NOT stays").select(id_)
    dropped = broadcast_if_small(dropped, dropped.count(), 32)
    return docs.join(dropped, F.col("doc_id").eqNullSafe(F.col(id_)), "left_anti")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, not at all, once or twice, so that the words of each source come within half of its longest
    document of those that the mix takes.

    A document without words takes no part in the mix and stays once.
    """
    id_, src, no, copies = (free_name(docs, name) for name in ("taken_id", "taken_source", "no_source", "copies"))
    taken = whole_copies(docs).select(F.col("id").alias(id_), F.col("src").alias(src), F.col("no").alias(no), F.col("copies").alias(copies))
    taken = stage(taken, "pipeline-mix").df
    # Names of sources are strings of any length.
    size = taken.agg(F.sum(F.octet_length(src) + 64).alias("bytes")).first()["bytes"] or 0
    source = F.col("source").cast("string")
    same = F.col("doc_id").eqNullSafe(F.col(id_)) & (F.coalesce(source, F.lit("")) == F.col(src)) & (source.isNull() == F.col(no))
    joined = docs.join(broadcast_if_small(taken, size, 1), same, "left")
    times = F.when(F.regexp_like(whole(F.col("text")), F.lit(SPACED_WORD)), F.coalesce(F.col(copies), F.lit(0))).otherwise(F.lit(1))
    return joined.withColumn(copies, times).filter(F.col(copies) > 0).withColumn(copies, F.explode(F.sequence(F.lit(1), F.col(copies)))).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Length buckets and batches of the mixed documents; a document taken twice is packed twice."""
    return pack_documents(docs)


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("ngram join", drop_near_copies),
    ("mix sources", mix),
    ("packing", pack),
]
# A classifier, hashes and a dynamic program decide: tests compare the stages with plain Python instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES[:-1]:
        # What a stage wrote for itself goes when its documents are written.
        docs = kept_result(spark, lambda function=function, docs=docs: function(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
