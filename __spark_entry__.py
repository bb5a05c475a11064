"""Queries over the given tables, with the SQL that must give the same rows.

Order lines are the main event table: the customer is the patient, the order date the day and the
part the word. The event log is a second one with a small vocabulary. Parts also serve as the word
mapping: the part name is the code, and the size modulo eight the source.
"""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

import pairloom as pl  # noqa: E402
from pairloom import plans, sources  # noqa: E402
from pairloom.functions import cosine_distance, epoch_day  # noqa: E402
from pairloom.scratch import broadcast_if_small, scratch_folder, stage  # noqa: E402

SMOKE_DIR = "/root/testdata/sf0.001"


# ---------------------------------------------------------------- inputs


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    orders = _table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        F.col("o_custkey").alias("PatientOrder"),
        epoch_day(F.col("o_orderdate")).alias("NumDays"),
        F.col("l_partkey").cast("int").alias("WordIndex"),
        F.lit(1).alias("window"),
        "l_orderkey",
    )


def log_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _table(spark, sf_dir, "events").select("user_id", "ts", "event_type")
    codes = stage(pl.dense_index(log.select(F.col("event_type").alias("Code"))), "event-types")
    words = broadcast_if_small(codes.df, codes.count(), 64)
    return log.join(words, log.event_type == words.Code).select(
        F.col("user_id").alias("PatientOrder"),
        epoch_day(F.col("ts")).alias("NumDays"),
        F.col("NewIndex").alias("WordIndex"),
    )


def part_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("WordIndex"),
        (F.col("p_size") % 8).cast("bigint").alias("Source"),
        F.col("p_name").alias("Code"),
    )


def order_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Count matrix of the order lines as a stored table."""
    return stage(pl.cooccurrence(order_events(spark, sf_dir)), "order-matrix").df


def code_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order matrix rolled up to part names, as a stored table."""
    return stage(pl.rollup(order_matrix(spark, sf_dir), part_mapping(spark, sf_dir)), "code-matrix").df


def code_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPMI of the code matrix, as a stored table."""
    scores = pl.ppmi(code_matrix(spark, sf_dir), symmetric=True, merge_duplicates=False)
    return stage(scores, "code-scores").df


def part_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """PPMI of the order matrix without its zeros, as a stored table."""
    scores = pl.ppmi(order_matrix(spark, sf_dir), symmetric=True, merge_duplicates=False, keep_zeros=False)
    return stage(scores, "part-scores").df


def _rounded(column: str, digits: int = 6):
    # Adding zero turns -0.0 into 0.0.
    return (F.round(F.col(column), digits) + F.lit(0.0)).alias(column)


# ---------------------------------------------------------------- pair counting


def pairs_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(order_events(spark, sf_dir))


def pairs_orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(order_events(spark, sf_dir), window_days=400)


def pairs_same_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(order_events(spark, sf_dir), window_days=0)


def pairs_split_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nearly every patient is counted as a busy one, and days above four words are cut."""
    return pl.cooccurrence(order_events(spark, sf_dir), max_group_rows=4)


def pairs_busy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event log has few words that come back every day."""
    return pl.cooccurrence(log_events(spark, sf_dir), window_days=7, max_group_rows=16)


def pairs_busy_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some patients busy, some not."""
    return pl.cooccurrence(order_events(spark, sf_dir), window_days=400, max_group_rows=24)


def pairs_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(log_events(spark, sf_dir))


def pairs_events_w3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(log_events(spark, sf_dir), window_days=3)


def _event_shards(spark: SparkSession, sf_dir: str) -> list[str]:
    """Order events written as two inputs that share patients."""
    folder = scratch_folder(spark, "event-shards")
    events = order_events(spark, sf_dir).withColumn("shard", F.pmod("l_orderkey", F.lit(2)))
    events.drop("l_orderkey").write.partitionBy("shard").parquet(folder)
    return [f"{folder}/shard={shard}" for shard in range(2)]


def pairs_file_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = sources.read_events(spark, _event_shards(spark, sf_dir), scope="directory")
    return pl.cooccurrence(events, scope=["input"])


def pairs_multi_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(sources.read_events(spark, _event_shards(spark, sf_dir)))


def combine_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = stage(order_events(spark, sf_dir), "events").df
    shards = [events.filter(F.pmod("PatientOrder", F.lit(4)) == shard) for shard in range(4)]
    counts = [stage(pl.cooccurrence(shard), "shard-counts") for shard in shards]
    return pl.combine(*[shard.df for shard in counts], rows=sum(shard.count() for shard in counts))


# ---------------------------------------------------------------- matrix operators


def symmetrize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.symmetrize(order_matrix(spark, sf_dir))


def marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.marginals(order_matrix(spark, sf_dir), symmetric=True)


def column_marginals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.column_marginals(order_matrix(spark, sf_dir))


def smoothed_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    total = pl.smoothed_total(pl.marginals(order_matrix(spark, sf_dir), symmetric=True))
    return total.select(_rounded("smoothed_total", 4))


def total_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.total_count(order_matrix(spark, sf_dir))


def matrix_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.matrix_order(order_matrix(spark, sf_dir))


def row_slice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.row_slice(order_matrix(spark, sf_dir), 100, 200)


# ---------------------------------------------------------------- PMI


def pmi_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pl.pmi(order_matrix(spark, sf_dir), symmetric=True, merge_duplicates=False)
    return scores.select("i", "j", "count", "word_marginal", "context_marginal", _rounded("pmi"))


def ppmi(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pl.ppmi(order_matrix(spark, sf_dir), symmetric=True, merge_duplicates=False)
    return scores.select("i", "j", _rounded("ppmi"))


def ppmi_alpha1(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pl.ppmi(order_matrix(spark, sf_dir), alpha=1.0, symmetric=True, merge_duplicates=False)
    return scores.select("i", "j", _rounded("ppmi"))


def ppmi_triangular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without expansion some contexts never occur as a row; their cells are left out."""
    scores = pl.ppmi(order_matrix(spark, sf_dir), on_zero_context="drop")
    return scores.select("i", "j", _rounded("ppmi"))


def ppmi_column_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pl.ppmi(order_matrix(spark, sf_dir), context="column")
    return scores.select("i", "j", _rounded("ppmi"))


def ppmi_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Input that already holds both halves is folded by expansion; equal cells are added."""
    full = pl.symmetrize(order_matrix(spark, sf_dir))
    return pl.ppmi(full, symmetric=True, keep_zeros=False).select("i", "j", _rounded("ppmi"))


def explain_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = pl.pmi(code_matrix(spark, sf_dir), symmetric=True, merge_duplicates=False)
    cell = pl.explain_cell(scores, 5, 3)
    return cell.select("i", "j", "count", "word_marginal", "context_marginal", _rounded("total", 4), _rounded("ppmi"))


# ---------------------------------------------------------------- roll-up


def dense_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.dense_index(part_mapping(spark, sf_dir))


def dense_index_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.dense_index(_table(spark, sf_dir, "customer").select(F.col("c_name").alias("Code")))


def _repeated_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four rows a word, in the order of their part keys."""
    parts = _table(spark, sf_dir, "part").withColumn("line", F.col("p_partkey").cast("bigint"))
    words = max(1, parts.count() // 4)
    return parts.select(
        (F.col("p_partkey") % words).cast("bigint").alias("WordIndex"),
        (F.col("p_size") % 8).cast("bigint").alias("Source"),
        F.col("p_name").alias("Code"),
        "line",
    )


def mapping_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.dedupe_mapping(_repeated_mapping(spark, sf_dir), "line")


def mapping_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.mapping_stats(part_mapping(spark, sf_dir))


def rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.rollup(order_matrix(spark, sf_dir), part_mapping(spark, sf_dir))


def rollup_symmetric_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full symmetric matrix is folded onto the upper triangle."""
    return pl.rollup(pl.symmetrize(order_matrix(spark, sf_dir)), part_mapping(spark, sf_dir))


def rollup_repeated_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.rollup(order_matrix(spark, sf_dir), _repeated_mapping(spark, sf_dir), (0, 3, 4), "line")


# ---------------------------------------------------------------- SVD


def balance_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer by nation, with the account balance as the value.

    A customer is in one nation, so the columns are orthogonal: a nation's singular value is the
    root of its squared balances, and the left vector has its customers' balances over that. The
    order grows with the customers.
    """
    return _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("i"),
        F.col("c_nationkey").cast("int").alias("j"),
        F.col("c_acctbal").cast("double").alias("ppmi"),
    )


def _balance_svd(spark: SparkSession, sf_dir: str, **options) -> tuple[DataFrame, pl.SvdResult]:
    """The five largest triplets, of as many as there are nations."""
    cells = stage(balance_cells(spark, sf_dir), "balances").df
    return cells, pl.svd(cells, 5, **options)


def _lengths(vectors: DataFrame) -> DataFrame:
    square = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x * x)
    return vectors.select("i", F.sqrt(square).alias("length")).select("i", _rounded("length", 2))


def svd_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _balance_svd(spark, sf_dir)
    energy = result.sigma.agg((F.sum(F.col("sigma") * F.col("sigma")) / 1e6).alias("energy"))
    return energy.select(_rounded("energy", 3))


def svd_reconstruct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every triplet that there is, so all cells come back as they are."""
    cells = stage(balance_cells(spark, sf_dir), "balances").df
    # No more triplets than nations or customers; the solver gives fewer when the rank is lower.
    sides = cells.agg(F.least(F.count_distinct("i"), F.count_distinct("j")).alias("most")).first()["most"]
    result = pl.svd(cells, max(1, sides), right_vectors=True)
    return pl.reconstruct(cells, result).select("i", "j", _rounded("approximation", 2))


def svd_orthonormal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner products of the columns of U S."""
    _, result = _balance_svd(spark, sf_dir)
    long = pl.to_long(pl.embeddings(result, 1.0))
    left = long.select("i", F.col("component").alias("a"), F.col("value").alias("x"))
    right = long.select("i", F.col("component").alias("b"), F.col("value").alias("y"))
    products = left.join(right, "i").groupBy("a", "b").agg((F.sum(F.col("x") * F.col("y")) / 1e6).alias("product"))
    return products.select("a", "b", _rounded("product", 3))


def svd_row_energy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every row of U S."""
    _, result = _balance_svd(spark, sf_dir)
    return _lengths(pl.embeddings(result, 1.0))


def embeddings_weighted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Column c of U sqrt(S) has the squared length sigma[c]."""
    _, result = _balance_svd(spark, sf_dir)
    lengths = pl.to_long(pl.embeddings(result, 0.5)).groupBy("component")
    sigma = lengths.agg(F.sum(F.col("value") * F.col("value")).alias("sigma"))
    return sigma.select("component", _rounded("sigma", 2))


def svd_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _balance_svd(spark, sf_dir)
    return result.components.select("component", _rounded("sigma", 2), "converged")


def svd_smallest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three smallest of a diagonal matrix, which stand apart from the rest."""
    spread = F.abs("c_acctbal") / 20000.0
    value = F.when(F.col("c_custkey") < 3, F.lit(1.0)).otherwise(F.lit(5.0)) + spread
    key = F.col("c_custkey").cast("int")
    cells = _table(spark, sf_dir, "customer").select(key.alias("i"), key.alias("j"), value.alias("ppmi"))
    result = pl.svd(stage(cells, "diagonal").df, 3, which="smallest")
    return result.sigma.select("component", _rounded("sigma", 5))


def svd_top_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five largest triplets of the part matrix, whose order grows with the data."""
    result = pl.svd(part_scores(spark, sf_dir), 5)
    first = F.lit(result.values[0]).alias("first")
    return result.components.select("component", "converged", first).select("component", "converged", _rounded("first", 4))


def svd_dominant_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First left vector, weighted by its singular value, of the part matrix."""
    result = pl.svd(part_scores(spark, sf_dir), 1, block=8, tol=1e-11)
    first = pl.to_long(pl.embeddings(result, 1.0)).select("i", "value")
    return first.select("i", _rounded("value", 4))


def _code_svd(scores: DataFrame, k: int, **options) -> pl.SvdResult:
    """Triplets of the rolled-up PPMI matrix, by small blocks and a small basis, so that the solver restarts."""
    return pl.svd(scores, k, block=8, max_basis=32, **options)


def svd_code_sigma(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every one of the five largest singular values."""
    return _code_svd(code_scores(spark, sf_dir), 5).components.select("component", _rounded("sigma", 4), "converged")


def svd_code_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length of every row of U S, over the five largest."""
    return _lengths(pl.embeddings(_code_svd(code_scores(spark, sf_dir), 5), 1.0))


def svd_code_right(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Energy that the five largest triplets explain, by their values at all cells: the sum of U S V' times the cell."""
    scores = code_scores(spark, sf_dir)
    cells = pl.reconstruct(scores, _code_svd(scores, 5, right_vectors=True))
    return cells.agg(F.sum(F.col("ppmi") * F.col("approximation")).alias("energy")).select(_rounded("energy", 3))


def svd_code_smallest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three smallest singular values."""
    return pl.svd(code_scores(spark, sf_dir), 3, which="smallest").sigma.select("component", _rounded("sigma", 4))


def svd_code_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All triplets by rotations: their number, and the sums of the second and fourth powers of the values."""
    scores = code_scores(spark, sf_dir)
    order = scores.agg(F.greatest(F.max("i"), F.max("j")).alias("top")).first()["top"] + 1
    values = pl.svd(scores, order, method="lapack", which="smallest").sigma
    square = F.col("sigma") * F.col("sigma")
    sums = values.agg(F.count(F.lit(1)).alias("triplets"), F.sum(square).alias("second"), (F.sum(square * square) / 1e3).alias("fourth"))
    return sums.select("triplets", _rounded("second", 3), _rounded("fourth", 3))


def subspace_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same five triplets from two start blocks, component groups against each other."""
    scores = code_scores(spark, sf_dir)
    first, second = _code_svd(scores, 5), _code_svd(scores, 5, seed=99)
    groups = pl.compare_subspaces(first.u, second.u, first.values, gap=0.0)
    return groups.select("first", "last", _rounded("sigma", 4), "failed")


# ---------------------------------------------------------------- checks


def matrix_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts at 30 days against counts at 29."""
    daily = stage(pl.daily_counts(order_events(spark, sf_dir)), "daily").df
    cells = pl.matrix_diff(pl.count_pairs(daily), pl.count_pairs(daily, window_days=29))
    # A missing cell is null; zero keeps the integer type when the rows are compared.
    return cells.fillna(0, ["left_count", "right_count"])


def matrix_diff_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same difference, looked for only in row ranges whose digests differ."""
    daily = stage(pl.daily_counts(order_events(spark, sf_dir)), "daily").df
    wide, narrow = (stage(pl.count_pairs(daily, window_days=days), "counts").df for days in (30, 29))
    cells = pl.matrix_diff_by_range(wide, narrow, rows=64)
    return cells.fillna(0, ["left_count", "right_count"])


def digest_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of each range of 100 rows, by the digests; and that a count made in another way has the same digests."""
    events = stage(order_events(spark, sf_dir), "events").df
    matrix = stage(pl.cooccurrence(events), "counts").df
    again = stage(pl.cooccurrence(events, max_group_rows=16), "counts").df
    other = pl.range_digests(again, 100).select("range", F.col("sum").alias("s"), F.col("xor").alias("x"))
    digests = pl.range_digests(matrix, 100).join(other, "range", "left")
    return digests.select("range", "cells", F.coalesce((F.col("sum") == F.col("s")) & (F.col("xor") == F.col("x")), F.lit(False)).alias("same"))


def marginals_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row sums of the expanded matrix as a table that is bucketed by its rows."""
    path = scratch_folder(spark, "bucketed")
    name = "counts_" + path.rsplit("-", 1)[1]
    return pl.marginals(sources.write_bucketed_matrix(pl.symmetrize(order_matrix(spark, sf_dir)), name, path, 8))


def row_slice_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A slice of the matrix as it is stored by row ranges."""
    path = scratch_folder(spark, "row-ranges")
    sources.write_row_ranges(order_matrix(spark, sf_dir), path, 16)
    return sources.read_row_slice(spark, path, 100, 200)


def diff_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = stage(pl.daily_counts(order_events(spark, sf_dir)), "daily").df
    return pl.diff_summary(pl.count_pairs(daily), pl.count_pairs(daily, max_group_rows=16))


def factor_compare(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Left vectors beside those that the balances give, with the odd ones put in the place of the next."""
    cells, result = _balance_svd(spark, sf_dir)
    sums = cells.groupBy("j").agg(F.sqrt(F.sum(F.col("ppmi") * F.col("ppmi"))).alias("sigma"))
    top = sums.orderBy(F.col("sigma").desc(), "j").limit(5)
    place = F.row_number().over(Window.orderBy(F.col("sigma").desc(), "j")) - 1
    # Five rows.
    owned = cells.join(F.broadcast(top.select("j", "sigma", place.alias("c"))), "j")
    entry = F.col("ppmi") / F.col("sigma")
    given = [F.when(F.col("c") == (c + 1 if c % 2 else c), entry).otherwise(F.lit(0.0)) for c in range(5)]
    return pl.compare_factors(result.u, owned.select("i", F.array(*given).alias("features"))).select("component", "failed")


def cosine_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distance of every vector to the one with the next id."""
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("a"))
    following = vectors.select((F.col("vec_id") - 1).alias("vec_id"), F.col("a").alias("b"))
    distance = cosine_distance(F.col("a"), F.col("b")).alias("distance")
    return vectors.join(following, "vec_id").select("vec_id", distance).select("vec_id", _rounded("distance"))


def invariants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells with ``count = i + j``; expansion doubles the diagonal and leaves the rest."""
    i, j = F.col("i"), F.col("j")
    cells = _table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("i"), F.col("l_linenumber").alias("j")
    )
    matrix = cells.distinct().select("i", "j", (i + j).cast("bigint").alias("count"))
    return pl.cell_invariants(pl.symmetrize(matrix), F.when(i == j, (i + j) * 2).otherwise(i + j).cast("bigint"))


# ---------------------------------------------------------------- files and generators


def roundtrip_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "written-matrix")
    sources.write_matrix(pl.cooccurrence(order_events(spark, sf_dir)), path)
    return sources.read_matrix(spark, path)


def roundtrip_mapping(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sources.read_mapping(spark, stage(part_mapping(spark, sf_dir), "written-mapping").path)


def roundtrip_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _balance_svd(spark, sf_dir)
    path = scratch_folder(spark, "written-embeddings")
    sources.write_embeddings(pl.embeddings(result, 1.0), path)
    return _lengths(sources.read_embeddings(spark, path))


def roundtrip_long_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, result = _balance_svd(spark, sf_dir)
    path = scratch_folder(spark, "written-long-embeddings")
    sources.write_long_embeddings(pl.embeddings(result, 1.0), path)
    square = F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("length")
    return spark.read.parquet(path).groupBy("i").agg(square).select("i", _rounded("length", 2))


def csv_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_folder(spark, "events-csv")
    order_events(spark, sf_dir).drop("l_orderkey").write.option("compression", "gzip").csv(path)
    return sources.read_events(spark, path, file_format="csv")


def pairs_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pl.cooccurrence(csv_events(spark, sf_dir))


def _event_files(spark: SparkSession, sf_dir: str, shards: int = 1) -> list[str]:
    """Order events written as event files, sharded by patient."""
    events = stage(order_events(spark, sf_dir).drop("l_orderkey"), "events").df
    folder = scratch_folder(spark, "event-files")
    for shard in range(shards):
        events.filter(F.pmod("PatientOrder", F.lit(shards)) == shard).write.parquet(f"{folder}/{shard}")
    return [f"{folder}/{shard}" for shard in range(shards)]


def job_count_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plans.count_events(spark, _event_files(spark, sf_dir), scratch_folder(spark, "counts"))


def job_add_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shards counted on their own, then added up."""
    folder = scratch_folder(spark, "shard-counts")
    outputs = []
    for shard, path in enumerate(_event_files(spark, sf_dir, 3)):
        outputs.append(f"{folder}/{shard}")
        plans.count_events(spark, path, outputs[-1])
    return plans.add_counts(spark, outputs, scratch_folder(spark, "sum"))


def job_add_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads that share patients, days and even orders, each added to the matrix of those before."""
    events = stage(order_events(spark, sf_dir).drop("l_orderkey"), "events").df
    folder, matrix = scratch_folder(spark, "loads"), None
    load = F.pmod(F.xxhash64("PatientOrder", "NumDays", "WordIndex"), F.lit(3))
    for k in range(3):
        events.filter(load == k).write.parquet(f"{folder}/events-{k}")
        plans.add_events(spark, f"{folder}/events-{k}", f"{folder}/state", f"{folder}/matrix-{k}", matrix)
        matrix = f"{folder}/matrix-{k}"
    return sources.read_matrix(spark, matrix)


def job_reduce_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    matrix = stage(pl.cooccurrence(order_events(spark, sf_dir)), "counts").path
    mapping = stage(part_mapping(spark, sf_dir), "mapping").path
    return plans.reduce_matrix(spark, matrix, mapping, scratch_folder(spark, "reduced"))


def job_reduce_repeated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mapping repeats words; the line number says which row is the last."""
    matrix = stage(pl.cooccurrence(order_events(spark, sf_dir)), "counts").path
    mapping = stage(_repeated_mapping(spark, sf_dir), "mapping").path
    return plans.reduce_matrix(spark, matrix, mapping, scratch_folder(spark, "reduced"), (0, 3, 4), order_col="line")


def _embedded_sigma(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """Column 0 of the written U sqrt(S) has the squared length sigma[0]."""
    counts, output = stage(pl.cooccurrence(order_events(spark, sf_dir)), "counts"), scratch_folder(spark, "embeddings")
    plans.embed_matrix(spark, counts.path, output, 1, weighted=True, tol=1e-10, **options)
    first = pl.to_long(sources.read_embeddings(spark, output)).filter("component = 0")
    return first.agg(F.sum(F.col("value") * F.col("value")).alias("sigma")).select(_rounded("sigma", 4))


def job_embed_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _embedded_sigma(spark, sf_dir, symmetric=True)


def job_embed_triangular(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without expansion, contexts that are never a row are left out."""
    return _embedded_sigma(spark, sf_dir, on_zero_context="drop")


def gen_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The histories of the order lines: events, days and words of each customer."""
    return order_events(spark, sf_dir).groupBy("PatientOrder").agg(
        F.count(F.lit(1)).alias("n_events"),
        F.min("NumDays").cast("bigint").alias("first_day"),
        F.max("NumDays").cast("bigint").alias("last_day"),
        F.count_distinct("WordIndex").alias("n_words"),
    )


def gen_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Supplier by part, with the number of order lines: how many cells differ from one line."""
    lines = _table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").cast("int").alias("i"), F.col("l_partkey").cast("int").alias("j"))
    return pl.cell_invariants(lines.groupBy("i", "j").agg(F.count(F.lit(1)).alias("count")), F.lit(1).cast("bigint"))


# ---------------------------------------------------------------- SQL

_ORDER_EVENTS = """ev AS (
  SELECT row_number() OVER () AS id, o_custkey AS patient, CAST(l_partkey AS INTEGER) AS word, l_orderkey AS okey,
         date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS day
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_LOG_EVENTS = """ev AS (
  SELECT event_id AS id, user_id AS patient, CAST(dense_rank() OVER (ORDER BY event_type) - 1 AS INTEGER) AS word,
         0 AS okey, date_diff('day', DATE '1970-01-01', CAST(ts AS DATE)) AS day
  FROM events)"""


def _pairs_cte(events: str = _ORDER_EVENTS, window: int = 30, extra: str = "", name: str = "counts") -> str:
    """Every two rows of a patient, counted one by one."""
    return f"""{events}, {name} AS (
  SELECT least(a.word, b.word) AS i, greatest(a.word, b.word) AS j, CAST(count(*) AS BIGINT) AS count
  FROM ev a JOIN ev b ON a.patient = b.patient AND a.id < b.id AND abs(a.day - b.day) <= {window} {extra}
  GROUP BY 1, 2)"""


_COUNTS = _pairs_cte()

_SYM = """sym AS (
  SELECT i, j, count FROM {source} WHERE i <> j
  UNION ALL SELECT j, i, count FROM {source} WHERE i <> j
  UNION ALL SELECT i, j, 2 * count FROM {source} WHERE i = j)"""

_CODES = """codes AS (
  SELECT DISTINCT p_name AS code, CAST(dense_rank() OVER (ORDER BY p_name) - 1 AS INTEGER) AS idx FROM part),
words AS (SELECT p_partkey AS word, idx FROM part JOIN codes ON p_name = code WHERE p_size % 8 IN (1, 2, 5)),
reduced AS (
  SELECT least(a.idx, b.idx) AS i, greatest(a.idx, b.idx) AS j, CAST(sum(count) AS BIGINT) AS count
  FROM {source} m JOIN words a ON m.i = a.word JOIN words b ON m.j = b.word GROUP BY 1, 2)"""


def _pmi_cte(cells: str, alpha: str = "0.75", context: str = "i") -> str:
    return f"""marg AS (SELECT i, CAST(sum(count) AS BIGINT) AS m FROM {cells} GROUP BY i),
ctx AS (SELECT {context} AS j, CAST(sum(count) AS BIGINT) AS m FROM {cells} GROUP BY {context}),
tot AS (SELECT sum(pow(m, {alpha})) AS t FROM ctx),
scored AS (
  SELECT c.i, c.j, c.count, w.m AS wm, x.m AS cm, t,
         log2(c.count * t / (w.m * pow(x.m, {alpha}))) AS pmi
  FROM {cells} c JOIN marg w ON c.i = w.i JOIN ctx x ON c.j = x.j, tot),
ppmi AS (SELECT i, j, greatest(0.0, pmi) AS ppmi FROM scored)"""


_PART_PPMI = f"WITH {_COUNTS}, {_SYM.format(source='counts')}, {_pmi_cte('sym')}"
_CODE_COUNTS = f"WITH {_COUNTS}, {_CODES.format(source='counts')}"
_CODE_PPMI = f"{_CODE_COUNTS}, {_SYM.format(source='reduced')}, {_pmi_cte('sym')}"
_PPMI_ROWS = "SELECT i, j, round(ppmi, 6) + 0.0 AS ppmi FROM ppmi"


def _power_sql(scores: str, last: str, rounds: int = 10) -> str:
    """Power iteration: each round multiplies by the matrix and its transpose and normalizes."""
    steps = ["x0 AS (SELECT i, sum(ppmi) AS x FROM ppmi GROUP BY i)"]
    for r in range(rounds):
        steps.append(f"y{r} AS (SELECT j, sum(ppmi * x) AS y FROM ppmi JOIN x{r} USING (i) GROUP BY j)")
        steps.append(f"z{r} AS (SELECT i, sum(ppmi * y) AS z FROM ppmi JOIN y{r} USING (j) GROUP BY i)")
        steps.append(f"x{r + 1} AS (SELECT i, z / (SELECT sqrt(sum(z * z)) FROM z{r}) AS x FROM z{r})")
    largest = f"lam AS (SELECT sqrt(sqrt(sum(z * z))) AS sigma FROM z{rounds - 1})"
    return f"{scores}, {', '.join(steps)}, {largest} {last}"


_DOMINANT_ROWS = """SELECT CAST(r.i AS INTEGER) AS i, round(coalesce(x, 0) * sigma, 4) + 0.0 AS value
FROM (SELECT unnest(range(CAST(max(greatest(i, j)) + 1 AS BIGINT))) AS i FROM ppmi) r
LEFT JOIN x10 x ON x.i = r.i, lam"""
_DOMINANT_SIGMA = "SELECT round(sigma, 4) + 0.0 AS sigma FROM lam"

def _spectral_sql(scores: str, k: int, last: str, smallest: bool = False, squarings: int = 32) -> str:
    """The ``k`` largest (or smallest) eigenvalues of ``A A'`` with their projectors, one after the other.

    A matrix that is squared over and over becomes the projector of its largest eigenvalue; that is taken out and the
    rest squared again. For the smallest, the matrix is taken from a multiple of the identity first. An eigenvalue that comes
    several times, like zero, gives the mean of its projectors, whose squares tell how many there are.
    """
    parts = [
        "every AS MATERIALIZED (SELECT CAST(unnest(range(CAST(max(greatest(i, j)) + 1 AS BIGINT))) AS INTEGER) AS i FROM ppmi)",
        """gram AS MATERIALIZED (SELECT e.i, f.i AS j, coalesce(x, 0.0) AS x FROM every e CROSS JOIN every f LEFT JOIN (
          SELECT a.i, b.i AS j, sum(a.ppmi * b.ppmi) AS x FROM ppmi a JOIN ppmi b USING (j) GROUP BY 1, 2) g ON g.i = e.i AND g.j = f.i)""",
    ]
    shift = "CASE WHEN i = j THEN (SELECT max(s) FROM (SELECT sum(abs(x)) AS s FROM gram GROUP BY i)) ELSE 0 END - x" if smallest else "x"
    parts.append(f"rest0 AS MATERIALIZED (SELECT i, j, {shift} AS x FROM gram)")
    for c in range(k):
        parts.append(f"p{c}_0 AS MATERIALIZED (SELECT i, j, x / (SELECT sum(x) FROM rest{c} WHERE i = j) AS x FROM rest{c})")
        for s in range(squarings):
            parts.append(f"q{c}_{s} AS MATERIALIZED (SELECT a.i, b.j, sum(a.x * b.x) AS x FROM p{c}_{s} a JOIN p{c}_{s} b ON a.j = b.i GROUP BY 1, 2)")
            parts.append(f"p{c}_{s + 1} AS MATERIALIZED (SELECT i, j, x / (SELECT sum(x) FROM q{c}_{s} WHERE i = j) AS x FROM q{c}_{s})")
        parts.append(f"proj{c} AS MATERIALIZED (SELECT i, j, x FROM p{c}_{squarings})")
        parts.append(f"lam{c} AS MATERIALIZED (SELECT sum(g.x * v.x) AS lam, (SELECT sum(g.x * v.x) FROM rest{c} g JOIN proj{c} v USING (i, j)) AS own, (SELECT CAST(round(1 / sum(x * x)) AS BIGINT) FROM proj{c}) AS times FROM gram g JOIN proj{c} v USING (i, j))")
        parts.append(f"rest{c + 1} AS MATERIALIZED (SELECT g.i, g.j, g.x - own * times * v.x AS x FROM rest{c} g JOIN proj{c} v USING (i, j), lam{c})")
    each = " UNION ALL ".join(f"SELECT {c} AS place, sqrt(greatest(lam, 0.0)) AS sigma, unnest(range(times)) FROM lam{c}" for c in range(k))
    values = f"SELECT CAST(row_number() OVER (ORDER BY place) - 1 AS INTEGER) AS component, sigma FROM ({each}) ORDER BY place LIMIT {k}"
    rows = " UNION ALL ".join(f"SELECT i, x * times * lam AS square FROM proj{c}, lam{c} WHERE i = j" for c in range(k))
    return f"{scores}, {', '.join(parts)}, values_of AS ({values}), squares AS ({rows}) {last}"


_TOP_BALANCES = """WITH cells AS (SELECT c_custkey AS i, c_nationkey AS j, c_acctbal AS v FROM customer),
  sums AS (SELECT j, sum(v * v) AS square FROM cells GROUP BY j),
  top AS (SELECT j, square, CAST(row_number() OVER (ORDER BY square DESC, j) - 1 AS INTEGER) AS component
          FROM sums ORDER BY square DESC, j LIMIT 5)"""
_BALANCE_LENGTHS = f"""{_TOP_BALANCES}, rows AS (
    SELECT CAST(unnest(range(CAST(max(greatest(i, j)) + 1 AS BIGINT))) AS INTEGER) AS i FROM cells)
  SELECT r.i, round(coalesce(abs(v), 0), 2) + 0.0 AS length
  FROM rows r LEFT JOIN (SELECT i, v FROM cells JOIN top USING (j)) c ON c.i = r.i"""


def _own_sql() -> dict[str, str]:
    pairs = f"WITH {_COUNTS} SELECT i, j, count FROM counts"
    order_rows = f"""WITH {_ORDER_EVENTS} SELECT patient AS "PatientOrder", CAST(day AS INTEGER) AS "NumDays",
      word AS "WordIndex", CAST(1 AS INTEGER) AS "window" FROM ev"""
    both_windows = f"""WITH {_pairs_cte(name='wide')}, narrow AS (
      SELECT least(a.word, b.word) AS i, greatest(a.word, b.word) AS j, CAST(count(*) AS BIGINT) AS count
      FROM ev a JOIN ev b ON a.patient = b.patient AND a.id < b.id AND abs(a.day - b.day) <= 29 GROUP BY 1, 2)"""
    repeated = """last AS (
      SELECT p_partkey % (SELECT greatest(1, count(*) // 4) FROM part) AS word, arg_max(p_size % 8, p_partkey) AS src, arg_max(p_name, p_partkey) AS code
      FROM part GROUP BY 1)"""
    return {
        "pairs_orders": pairs,
        "pairs_orders_wide": f"WITH {_pairs_cte(window=400)} SELECT i, j, count FROM counts",
        "pairs_same_day": f"WITH {_pairs_cte(window=0)} SELECT i, j, count FROM counts",
        "pairs_split_groups": pairs,
        "pairs_busy_events": f"WITH {_pairs_cte(_LOG_EVENTS, 7)} SELECT i, j, count FROM counts",
        "pairs_busy_wide": f"WITH {_pairs_cte(window=400)} SELECT i, j, count FROM counts",
        "pairs_events": f"WITH {_pairs_cte(_LOG_EVENTS)} SELECT i, j, count FROM counts",
        "pairs_events_w3": f"WITH {_pairs_cte(_LOG_EVENTS, 3)} SELECT i, j, count FROM counts",
        "pairs_file_scope": f"WITH {_pairs_cte(extra='AND a.okey % 2 = b.okey % 2')} SELECT i, j, count FROM counts",
        "pairs_multi_file": pairs,
        "combine_shards": pairs,
        "symmetrize": f"WITH {_COUNTS}, {_SYM.format(source='counts')} SELECT i, j, count FROM sym",
        "marginals": f"""WITH {_COUNTS}, {_SYM.format(source='counts')}
          SELECT i, CAST(sum(count) AS BIGINT) AS marginal FROM sym GROUP BY i""",
        "marginals_bucketed": f"""WITH {_COUNTS}, {_SYM.format(source='counts')}
          SELECT i, CAST(sum(count) AS BIGINT) AS marginal FROM sym GROUP BY i""",
        "column_marginals": f"WITH {_COUNTS} SELECT j, CAST(sum(count) AS BIGINT) AS marginal FROM counts GROUP BY j",
        "smoothed_total": f"""WITH {_COUNTS}, {_SYM.format(source='counts')}, {_pmi_cte('sym')}
          SELECT round(t, 4) + 0.0 AS smoothed_total FROM tot""",
        "total_count": f"WITH {_COUNTS} SELECT CAST(sum(count) AS BIGINT) AS total FROM counts",
        "matrix_order": f"WITH {_COUNTS} SELECT CAST(max(greatest(i, j)) + 1 AS INTEGER) AS n FROM counts",
        "row_slice": f"WITH {_COUNTS} SELECT i, j, count FROM counts WHERE i >= 100 AND i < 200",
        "pmi_cells": f"""{_PART_PPMI} SELECT i, j, CAST(count AS BIGINT) AS count, wm AS word_marginal,
          cm AS context_marginal, round(pmi, 6) + 0.0 AS pmi FROM scored""",
        "ppmi": f"{_PART_PPMI} {_PPMI_ROWS}",
        "ppmi_alpha1": f"""WITH {_COUNTS}, {_SYM.format(source='counts')}, {_pmi_cte('sym', '1.0')} {_PPMI_ROWS}""",
        "ppmi_triangular": f"WITH {_COUNTS}, {_pmi_cte('counts')} {_PPMI_ROWS}",
        "ppmi_column_context": f"WITH {_COUNTS}, {_pmi_cte('counts', context='j')} {_PPMI_ROWS}",
        "ppmi_merged": f"""WITH {_COUNTS}, {_SYM.format(source='counts')},
          twice AS (SELECT i, j, 2 * count AS count FROM sym), {_pmi_cte('twice')}
          {_PPMI_ROWS} WHERE ppmi > 0""",
        "explain_cell": f"""{_CODE_PPMI} SELECT i, j, CAST(count AS BIGINT) AS count, wm AS word_marginal,
          cm AS context_marginal, round(t, 4) + 0.0 AS total, round(greatest(0.0, pmi), 6) + 0.0 AS ppmi
          FROM scored WHERE i = 5 AND j = 3""",
        "dense_index": """SELECT code AS "Code", CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS "NewIndex"
          FROM (SELECT DISTINCT p_name AS code FROM part)""",
        "dense_index_customers": """SELECT code AS "Code",
          CAST(row_number() OVER (ORDER BY code) - 1 AS INTEGER) AS "NewIndex"
          FROM (SELECT DISTINCT c_name AS code FROM customer)""",
        "mapping_last_wins": f"""WITH {repeated}
          SELECT word AS "WordIndex", CAST(src AS BIGINT) AS "Source", code AS "Code" FROM last""",
        "mapping_stats": "SELECT count(DISTINCT p_partkey) AS words, count(DISTINCT p_name) AS codes FROM part",
        "rollup": f"{_CODE_COUNTS} SELECT i, j, count FROM reduced",
        "rollup_symmetric_input": f"""WITH {_COUNTS}, {_SYM.format(source='counts')}, {_CODES.format(source='sym')}
          SELECT i, j, count FROM reduced""",
        "rollup_repeated_words": f"""WITH {_COUNTS}, {repeated}, codes AS (
            SELECT DISTINCT p_name AS code, dense_rank() OVER (ORDER BY p_name) - 1 AS idx FROM part),
          words AS (SELECT word, CAST(idx AS INTEGER) AS idx FROM last JOIN codes USING (code) WHERE src IN (0, 3, 4))
          SELECT least(a.idx, b.idx) AS i, greatest(a.idx, b.idx) AS j, CAST(sum(count) AS BIGINT) AS count
          FROM counts m JOIN words a ON m.i = a.word JOIN words b ON m.j = b.word GROUP BY 1, 2""",
        "svd_energy": f"{_TOP_BALANCES} SELECT round(sum(square) / 1e6, 3) + 0.0 AS energy FROM top",
        "svd_reconstruct": """SELECT CAST(c_custkey AS INTEGER) AS i, CAST(c_nationkey AS INTEGER) AS j,
          CAST(round(c_acctbal, 2) + 0.0 AS DOUBLE) AS approximation FROM customer""",
        "svd_orthonormal": f"""{_TOP_BALANCES} SELECT x.component AS a, y.component AS b,
          CASE WHEN x.j = y.j THEN round(x.square / 1e6, 3) ELSE 0.0 END::DOUBLE AS product FROM top x, top y""",
        "svd_row_energy": _BALANCE_LENGTHS,
        "embeddings_weighted": f"{_TOP_BALANCES} SELECT component, round(sqrt(square), 2) + 0.0 AS sigma FROM top",
        "svd_report": f"{_TOP_BALANCES} SELECT component, round(sqrt(square), 2) + 0.0 AS sigma, true AS converged FROM top",
        "svd_smallest": """WITH diagonal AS (
            SELECT CASE WHEN c_custkey < 3 THEN 1.0 ELSE 5.0 END + abs(c_acctbal) / 20000.0 AS v FROM customer)
          SELECT CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS component, round(v::DOUBLE, 5) + 0.0 AS sigma
          FROM diagonal ORDER BY v LIMIT 3""",
        "svd_top_parts": _power_sql(
            _PART_PPMI,
            "SELECT CAST(unnest(range(5)) AS INTEGER) AS component, true AS converged, round(sigma, 4) + 0.0 AS first FROM lam",
        ),
        "svd_dominant_parts": _power_sql(_PART_PPMI, _DOMINANT_ROWS),
        "svd_code_sigma": _spectral_sql(_CODE_PPMI, 5, "SELECT component, round(sigma, 4) + 0.0 AS sigma, true AS converged FROM values_of"),
        "svd_code_rows": _spectral_sql(_CODE_PPMI, 5, "SELECT i, round(sqrt(greatest(sum(square), 0.0)), 2) + 0.0 AS length FROM squares GROUP BY i"),
        "svd_code_right": _spectral_sql(_CODE_PPMI, 5, "SELECT round(sum(sigma * sigma), 3) + 0.0 AS energy FROM values_of"),
        "svd_code_smallest": _spectral_sql(_CODE_PPMI, 3, "SELECT component, round(sigma, 4) + 0.0 AS sigma FROM values_of", smallest=True),
        "svd_code_all": f"""{_CODE_PPMI}, gram AS (SELECT a.i, b.i AS j, sum(a.ppmi * b.ppmi) AS x FROM ppmi a JOIN ppmi b USING (j) GROUP BY 1, 2)
          SELECT (SELECT CAST(max(greatest(i, j)) + 1 AS BIGINT) FROM ppmi) AS triplets,
                 (SELECT round(sum(ppmi * ppmi), 3) + 0.0 FROM ppmi) AS second, round(sum(x * x) / 1e3, 3) + 0.0 AS fourth FROM gram""",
        "subspace_compare": _spectral_sql(
            _CODE_PPMI, 5, 'SELECT component AS "first", component AS "last", round(sigma, 4) + 0.0 AS sigma, false AS failed FROM values_of'
        ),
        "matrix_diff": f"""{both_windows}
          SELECT i, j, coalesce(w.count, 0) AS left_count, coalesce(n.count, 0) AS right_count
          FROM wide w FULL JOIN narrow n USING (i, j) WHERE w.count IS DISTINCT FROM n.count""",
        "matrix_diff_ranges": f"""{both_windows}
          SELECT i, j, coalesce(w.count, 0) AS left_count, coalesce(n.count, 0) AS right_count
          FROM wide w FULL JOIN narrow n USING (i, j) WHERE w.count IS DISTINCT FROM n.count""",
        "digest_summary": f"WITH {_COUNTS} SELECT CAST(i // 100 AS INTEGER) AS range, count(*) AS cells, true AS same FROM counts GROUP BY 1",
        "row_slice_stored": f"WITH {_COUNTS} SELECT i, j, count FROM counts WHERE i >= 100 AND i < 200",
        "diff_summary": f"WITH {_COUNTS} SELECT count(*) AS cells, CAST(0 AS BIGINT) AS mismatches FROM counts",
        "factor_compare": f"{_TOP_BALANCES} SELECT component, component % 2 = 1 AS failed FROM top",
        "cosine_neighbours": """SELECT a.vec_id, round(list_cosine_distance(CAST(a.embedding AS DOUBLE[]),
            CAST(b.embedding AS DOUBLE[])), 6) + 0.0 AS distance
          FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1""",
        "invariants": """WITH cells AS (SELECT DISTINCT l_suppkey AS i, l_linenumber AS j FROM lineitem)
          SELECT CAST(sum(CASE WHEN i = j THEN 1 ELSE 2 END) AS BIGINT) AS cells,
                 CAST(count(*) FILTER (i = j) AS BIGINT) AS diagonal, CAST(0 AS BIGINT) AS violations FROM cells""",
        "roundtrip_matrix": pairs,
        "roundtrip_mapping": """SELECT p_partkey AS "WordIndex", CAST(p_size % 8 AS BIGINT) AS "Source",
          p_name AS "Code" FROM part""",
        "roundtrip_embeddings": _BALANCE_LENGTHS,
        "roundtrip_long_embeddings": _BALANCE_LENGTHS,
        "csv_events": order_rows,
        "pairs_csv": pairs,
        "job_count_events": pairs,
        "job_add_counts": pairs,
        "job_add_events": pairs,
        "job_reduce_matrix": f"{_CODE_COUNTS} SELECT i, j, count FROM reduced",
        "job_reduce_repeated": f"""WITH {_COUNTS}, {repeated}, codes AS (
            SELECT DISTINCT p_name AS code, dense_rank() OVER (ORDER BY p_name) - 1 AS idx FROM part),
          words AS (SELECT word, CAST(idx AS INTEGER) AS idx FROM last JOIN codes USING (code) WHERE src IN (0, 3, 4))
          SELECT least(a.idx, b.idx) AS i, greatest(a.idx, b.idx) AS j, CAST(sum(count) AS BIGINT) AS count
          FROM counts m JOIN words a ON m.i = a.word JOIN words b ON m.j = b.word GROUP BY 1, 2""",
        "job_embed_matrix": _power_sql(_PART_PPMI, _DOMINANT_SIGMA),
        "job_embed_triangular": _power_sql(f"WITH {_COUNTS}, {_pmi_cte('counts')}", _DOMINANT_SIGMA),
        "gen_events": f"""WITH {_ORDER_EVENTS} SELECT patient AS "PatientOrder", count(*) AS n_events,
          CAST(min(day) AS BIGINT) AS first_day, CAST(max(day) AS BIGINT) AS last_day, count(DISTINCT word) AS n_words FROM ev GROUP BY 1""",
        "gen_matrix": """WITH cells AS (SELECT l_suppkey AS i, l_partkey AS j, count(*) AS n FROM lineitem GROUP BY 1, 2)
          SELECT count(*) AS cells, count(*) FILTER (i = j) AS diagonal, count(*) FILTER (n <> 1) AS violations FROM cells""",
    }


def _text_queries() -> tuple[dict[str, Callable[[SparkSession, str], DataFrame]], dict[str, str]]:
    """Queries and SQL of the text subpackage, which may be absent together with its pipeline."""
    if importlib.util.find_spec("pairloom.llm") is None or importlib.util.find_spec("corpus_pipeline") is None:
        return {}, {}
    import corpus_pipeline
    from pairloom.llm import oracles, queries

    return {**queries.QUERIES, "pipeline": corpus_pipeline.run}, oracles.ORACLES


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: globals()[name] for name in _own_sql()} | _text_queries()[0]


def oracle_sql() -> dict[str, str]:
    return _own_sql() | _text_queries()[1]


def entry(spark: SparkSession) -> DataFrame:
    return pairs_orders(spark, SMOKE_DIR)
