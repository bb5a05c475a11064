"""Registered queries: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.llm.collocations import mine_collocations
from pairloom.llm.exact_dedup import exact_duplicates
from pairloom.llm.lexical_search import rank_documents
from pairloom.llm.license_scan import scan_licenses
from pairloom.llm.mixing import mix_sources
from pairloom.llm.ngram_join import ngram_join
from pairloom.llm.packing import pack_documents
from pairloom.llm.secret_scan import scan_secrets
from pairloom.llm.sharding import shard_documents
from pairloom.llm.toxicity import fit_toxicity, score_toxicity
from pairloom.llm.url_filter import filter_urls
from pairloom.llm.vector_join import nearest_neighbours
from pairloom.llm.warc import read_archives, write_archives


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(_table(spark, sf_dir, "documents"))


def op2_pack_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"))


def op3_shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(_table(spark, sf_dir, "documents"))


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(_table(spark, sf_dir, "documents"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = write_archives(_table(spark, sf_dir, "pages"))
    return read_archives(manifest).drop("url")


def op6_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Queries are the rows whose id is divisible by 50."""
    return nearest_neighbours(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(_table(spark, sf_dir, "documents"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, _table(spark, sf_dir, "labels")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(_table(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine_collocations(_table(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rank_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(_table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        op1_license_scan,
        op2_pack_documents,
        op3_shard_documents,
        op4_secret_scan,
        op5_warc,
        op6_vector_join,
        op7_mix_sources,
        op8_toxicity,
        op9_exact_dedup,
        op10_ngram_join,
        op11_collocations,
        op12_ranked_search,
        op13_url_filter,
    )
}
