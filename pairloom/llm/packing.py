"""Packing: optimal length buckets and token-budget batches."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.positions import with_running_sums
from pairloom.llm.text import spaced_words
from pairloom.scratch import stage


def _bin(length: Column, fine: int) -> Column:
    """Upper edge of a length's bin: the length itself up to ``fine``, above that a grid of ``fine`` steps per doubling."""
    step = F.pow(F.lit(2.0), F.greatest(F.lit(0.0), F.ceil(F.log2(F.greatest(length, F.lit(1)) / F.lit(float(fine)))))).cast("long")
    return F.ceil(length / step).cast("long") * step


def optimal_buckets(edges: Sequence[int], counts: Sequence[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` runs of ``edges`` that pad ``counts`` up to them with the fewest tokens.

    Dynamic programming over the histogram. The cost of a run obeys the quadrangle inequality, so
    the best last cut moves right with the end, and each layer is solved by halving.
    """
    edges, counts = np.asarray(edges, np.float64), np.asarray(counts, np.float64)
    size = len(edges)
    if not size:
        return []
    before = np.concatenate([[0.0], np.cumsum(counts)])
    best = np.concatenate([[0.0], edges * before[1:]])  # padded tokens of the first j bins in one bucket
    cuts = [np.zeros(size + 1, np.int64)]
    for _ in range(1, min(buckets, size)):
        layer, cut = best.copy(), np.arange(size + 1)
        todo = [(1, size, 0, size)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            end = (low + high) // 2
            starts = np.arange(first, min(last, end - 1) + 1)
            cost = best[starts] + edges[end - 1] * (before[end] - before[starts])
            at = int(np.argmin(cost))
            layer[end], cut[end] = cost[at], starts[at]
            todo += [(low, end - 1, first, int(starts[at])), (end + 1, high, int(starts[at]), last)]
        cuts.append(cut)
        best = layer
    bounds, end = [], size
    for cut in reversed(cuts):
        if end > 0:
            bounds.append(int(edges[end - 1]))
            end = int(cut[end])
    return bounds[::-1]


def pack_documents(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    buckets: int = 16,
    budget: int = 1 << 16,
    fine: int = 4096,
) -> DataFrame:
    """``(id_col, n_tokens, bucket, bound, batch, slot, padding)``, a row for every row of ``docs``.

    Tokens are words between blanks. Documents go to the length bucket with the smallest bound
    that holds them, which is the longest length in it; the bounds minimise the padding over the
    whole table among those that keep the bins of the histogram whole. In a bucket, documents
    in the order of their id fill batches of ``budget`` tokens, each padded to the bound; a document
    above the budget is a batch of its own. ``batch`` counts from 0 in each bucket, ``slot`` in each
    batch.

    The histogram that goes to the driver has at most ``fine`` lengths and ``fine`` more for each
    doubling, whatever the number of documents. Lengths up to ``fine`` have a bin each, so without
    longer ones no bounds are better; above, a bucket ends at the longest length in a bin.
    A null or empty text has no tokens and is packed like the others. A null id comes first; rows
    that repeat an id are packed one by one. Other columns are not read. An empty table gives no
    rows.
    """
    rows = docs.select(F.col(id_col).alias("id"), spaced_words(F.col(text_col)).alias("n_tokens"))
    rows = stage(rows.withColumn("edge", _bin(F.col("n_tokens"), fine)), "pack-lengths").df
    histogram = rows.groupBy("edge").agg(F.max("n_tokens").alias("longest"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("longest")
    bounds = optimal_buckets(histogram["longest"].tolist(), histogram["n"].tolist(), buckets)
    bucket = sum((F.col("n_tokens") > F.lit(bound)).cast("int") for bound in bounds[:-1]) if len(bounds) > 1 else F.lit(0)
    bound = F.get(F.array(*map(F.lit, bounds)), F.col("bucket")).cast("long") if bounds else F.lit(0).cast("long")
    dealt = rows.select("id", "n_tokens", bucket.cast("int").alias("bucket")).withColumn("bound", bound)
    placed = stage(with_running_sums(dealt, ["bucket", "id", "n_tokens"], []), "pack-positions").df
    starts = placed.groupBy("bucket").agg(F.min("position").alias("bucket_start"))
    # At most one row per bucket.
    placed = placed.join(F.broadcast(starts), "bucket").withColumn("index", F.col("position") - F.col("bucket_start"))
    per_batch = f"greatest(1L, {budget}L div greatest(1L, bound))"
    return placed.select(
        F.col("id").alias(id_col),
        "n_tokens",
        "bucket",
        "bound",
        F.expr(f"index div {per_batch}").alias("batch"),
        F.expr(f"index % {per_batch}").alias("slot"),
        (F.col("bound") - F.col("n_tokens")).alias("padding"),
    )
