"""Ranked lexical search: LEMP-style norm buckets over integer impact vectors."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pairloom.scratch import stage

# Terms are runs of ASCII letters and digits and of anything outside ASCII, A to Z lower-cased.
_TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_BREAK = re.compile(rb"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]")
_PIECE = 1 << 20
# Texts of queries that are held at once. More queries are searched in several blocks.
QUERY_BYTES = 4 << 20

_ENTRY = "id long, n long, terms array<int>, tfs array<int>"
_VECTOR = "id long, norm double, terms array<int>, impacts array<long>"
_FOUND = "query int, score long, id long"


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """Terms of a text, a piece at a time; a piece ends where no term does."""
    lowered, at = text.lower(), 0
    while at < len(lowered):
        stop = _BREAK.search(lowered, at + _PIECE)
        end = stop.start() if stop else len(lowered)
        yield _TERM.findall(lowered, at, end)
        at = end


def _lists(parts: list[np.ndarray], kind: np.dtype) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts).astype(kind) if parts else np.empty(0, kind)))


def _entries(docs: DataFrame, vocabulary: list[bytes]) -> DataFrame:
    """Per document with a term: the number of its terms, and which of the vocabulary it holds how often."""
    shared = docs.sparkSession.sparkContext.broadcast({term: k for k, term in enumerate(vocabulary)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            ids, sizes, terms, tfs = [], [], [], []
            for row, text in enumerate(batch.column("text")):
                n, held = 0, np.zeros(0, np.int64)
                for piece in terms_of(text.as_buffer().to_pybytes()) if text.is_valid else ():
                    n += len(piece)
                    places = np.fromiter((known.get(term, -1) for term in piece), np.int64, len(piece))
                    held = np.concatenate([held, places[places >= 0]])
                if n:
                    distinct, counts = np.unique(held, return_counts=True)
                    ids.append(row)
                    sizes.append(n)
                    terms.append(distinct)
                    tfs.append(counts)
            arrays = [batch.column("id").take(pa.array(ids, pa.int64())), pa.array(sizes, pa.int64()), _lists(terms, np.int32), _lists(tfs, np.int32)]
            yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "terms", "tfs"])

    return docs.mapInArrow(count, _ENTRY)


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column and where each list begins and the last ends."""
    offsets = column.offsets.to_numpy()
    return column.values.to_numpy()[offsets[0] : offsets[-1]], (offsets - offsets[0]).astype(np.int64)


def _vectors(entries: DataFrame, weights: np.ndarray, documents: int, length: int) -> DataFrame:
    """Impact vectors over the vocabulary: a document's score is the sum of its impacts of a query's terms."""
    shared = entries.sparkSession.sparkContext.broadcast(weights)

    def impacts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            terms, at = _flat(batch.column("terms"))
            tf, _ = _flat(batch.column("tfs"))
            n = batch.column("n").to_numpy().astype(np.int64)
            m = 10 + (90 * n * documents) // length
            tf = tf.astype(np.int64)
            values = shared.value[terms] * ((1_000_000_000 * tf) // (1000 * tf + 8 * np.repeat(m, np.diff(at))))
            some = values > 0
            before = np.concatenate([[0], np.cumsum(some)])[at]
            full = np.diff(before) > 0
            # A sum for each row, as differences of running sums lose digits.
            norms = np.sqrt(np.bincount(np.repeat(np.arange(len(n)), np.diff(at)), values.astype(float) ** 2, len(n)))
            offsets = pa.array(np.append(before[:-1][full], before[-1]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (terms[some].astype(np.int32), values[some])]
            rows = pa.array(np.flatnonzero(full))
            # Rounding must not make a bound too small.
            yield pa.RecordBatch.from_arrays([batch.column("id").take(rows), pa.array(norms[full] * (1 + 1e-9)), *lists], names=["id", "norm", "terms", "impacts"])

    return entries.mapInArrow(impacts, _VECTOR)


class _Best:
    """The best ``top`` documents of each query so far, and the score that a better one needs."""

    def __init__(self, least: np.ndarray, top: int):
        self.top, self.need = top, np.maximum(least, 1)
        self.held: list[list[tuple[int, float]]] = [[] for _ in least]

    def add(self, query: int, scores: np.ndarray, ids: list[int | None]) -> None:
        some = [(-int(s), float("inf") if i is None else i) for s, i in zip(scores, ids, strict=True) if s >= self.need[query]]
        if some:
            best = sorted(self.held[query] + some)[: self.top]
            self.held[query] = best
            if len(best) == self.top:
                self.need[query] = max(self.need[query], -best[-1][0])


def _search_bucket(ids: pa.Array, norms: np.ndarray, terms: np.ndarray, impacts: np.ndarray, at: np.ndarray, queries: list[np.ndarray], size: int, best: _Best) -> None:
    """Look for better documents of each query in one bucket of vectors of about equal norm.

    A task may read several files, so a bucket may span two of them: its bound is its own largest norm.
    """
    longest = norms.max()
    rows = np.repeat(np.arange(len(norms)), np.diff(at))
    order = np.argsort(terms, kind="stable")
    starts = np.searchsorted(terms[order], np.arange(size + 1))
    rows_of, impacts_of = rows[order], impacts[order]
    largest = np.zeros(size, np.int64)
    there = np.flatnonzero(np.diff(starts))
    if len(there):
        largest[there] = np.maximum.reduceat(impacts_of, starts[there])
    for query, wanted in enumerate(queries):
        need = best.need[query]
        # Cauchy-Schwarz for the bucket.
        if np.sqrt(len(wanted)) * longest < need:
            continue
        wanted = wanted[largest[wanted] > 0]
        wanted = wanted[np.argsort(-largest[wanted], kind="stable")]
        rest = np.append(np.cumsum(largest[wanted][::-1])[::-1], 0)
        if rest[0] < need:
            continue
        # Coordinates beyond the focus cannot reach what is needed, by their largest impacts or by their number.
        left = np.sqrt(len(wanted) - np.arange(len(wanted) + 1))
        bound = np.minimum(rest, left * longest)
        focus = int(np.argmax(bound < need))
        if not focus:
            continue
        lists = [slice(starts[t], starts[t + 1]) for t in wanted[:focus]]
        touched = np.concatenate([rows_of[s] for s in lists])
        held = np.concatenate([impacts_of[s] for s in lists]).astype(float)
        part = np.bincount(touched, held, len(norms))
        square = np.bincount(touched, held * held, len(norms))
        some = np.flatnonzero(part)
        beyond = np.sqrt(np.maximum(norms[some] ** 2 - square[some], 0.0) + 1e-6 * norms[some] ** 2)
        some = some[part[some] + np.minimum(rest[focus], left[focus] * beyond) >= need]
        if not len(some):
            continue
        # Survivors are scored again over all their impacts, in whole numbers.
        chosen = np.zeros(size, bool)
        chosen[wanted] = True
        sizes = np.diff(at)[some]
        ends = np.cumsum(sizes)
        places = np.arange(ends[-1]) + np.repeat(at[some] - (ends - sizes), sizes)
        scores = np.add.reduceat(np.where(chosen[terms[places]], impacts[places], 0), ends - sizes)
        best.add(query, scores, ids.take(pa.array(some)).to_pylist())


def _search(vectors: DataFrame, queries: list[np.ndarray], size: int, least: np.ndarray, top: int, bucket: int) -> DataFrame:
    """Per task the best documents of each query. Rows come by falling norm within a task."""
    shared = vectors.sparkSession.sparkContext.broadcast((queries, least))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted, needed = shared.value
        best = _Best(needed.copy(), top)
        for batch in batches:
            for first in range(0, batch.num_rows, bucket):
                part = batch.slice(first, bucket)
                terms, at = _flat(part.column("terms"))
                impacts, _ = _flat(part.column("impacts"))
                _search_bucket(part.column("id"), part.column("norm").to_numpy(), terms, impacts, at, wanted, size, best)
        rows = [(q, -s, None if i == float("inf") else i) for q, held in enumerate(best.held) for s, i in held]
        arrays = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate((pa.int32(), pa.int64(), pa.int64()))]
        yield pa.RecordBatch.from_arrays(arrays, names=["query", "score", "id"])

    return vectors.mapInArrow(search, _FOUND)


def _query_blocks(items: DataFrame, id_col: str, text_col: str, block_bytes: int) -> Iterator[tuple[list, list[list[bytes]]]]:
    """Ids and distinct terms of some queries at a time, of about ``block_bytes`` bytes of text."""
    texts = items.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"))
    texts = stage(texts.withColumn("draw", F.xxhash64("id")), "search-items").df
    size = texts.agg(F.sum(F.octet_length("text") + 16).alias("bytes"), F.count_distinct("draw").alias("items")).first()
    blocks = max(1, min(size["items"], -(-(size["bytes"] or 0) // block_bytes)))
    for block in range(blocks):
        held: dict[int | None, set[bytes]] = {}
        # Bounded by the size of a block.
        for row in texts.filter(F.pmod("draw", F.lit(blocks)) == block).select("id", "text").collect():
            wanted = held.setdefault(row["id"], set())
            for piece in terms_of(bytes(row["text"])):
                wanted.update(piece)
        if held:
            yield list(held), [sorted(terms) for terms in held.values()]


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = 10,
    bucket: int = 2048,
    head: int = 4096,
    query_bytes: int = QUERY_BYTES,
) -> DataFrame:
    """``(item_col, rank, id_col, score)``: the ``top`` documents of highest score above 0 of each item.

    Terms are the runs of letters, digits and characters outside ASCII in whole texts, A to Z
    lower-cased. With N documents that hold a term, L their terms with repeats, n one document's, df the
    documents with a term and tf its occurrences in one: ``w = floor(1000 ln((2 N + 2) / (2 df + 1)))``,
    ``m = 10 + (90 n N) div L``, and a document scores the sum of ``w ((10^9 tf) div (1000 tf + 8 m))`` over
    an item's different terms. Equal scores go by ascending id, a null id last.

    A document is the vector of its impacts on the terms of the items, an item a vector of ones, and the score their
    product. Vectors are ordered by their length over the whole table and cut into buckets of
    ``bucket`` in that order. About ``head`` of the longest give each item a score that its result must reach. Then a
    bucket is passed over for an item when Cauchy-Schwarz on its longest vector stays below that score. Inside,
    a focus of the item's coordinates is chosen such that the others cannot reach the score, by the largest
    impact of each or by Cauchy-Schwarz; only documents with a focus coordinate are looked at, filtered by their
    sum there plus a bound for the rest, and survivors are summed over all coordinates in whole
    numbers. Each task keeps a heap for each item; the heaps are merged by a window. Bounds are safe, so the
    result is exact.

    Items are searched in blocks of about ``query_bytes`` bytes of text, so what is sent to tasks does not grow with their
    number. Rows that repeat an item id are one item with the terms of all; rows that repeat a document id are documents
    of their own. Null and empty texts have no terms, and an item without terms has no rows. Very long texts are taken
    whole, in pieces. Other columns are not read. An empty table on either side gives no rows.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = None
    for ids, wanted in _query_blocks(items, item_col, item_text_col, query_bytes):
        part = _ranked_block(spark, texts, wanted, top, bucket, head)
        names = spark.createDataFrame(list(enumerate(ids)), f"query int, item {items.schema[item_col].dataType.simpleString()}")
        # A block of queries is small.
        part = part.join(F.broadcast(names), "query").drop("query")
        found = part if found is None else found.unionByName(part)
    if found is None:
        kind = items.schema[item_col].dataType.simpleString()
        found = spark.createDataFrame([], f"score long, id long, rank int, item {kind}")
    return found.select(F.col("item").alias(item_col), "rank", F.col("id").alias(id_col), "score")


def _longest(vectors: DataFrame, head: int) -> DataFrame:
    """About ``head`` of the longest vectors. Any choice gives a score that ``top`` documents reach, so a quantile will do;
    of more vectors of equal length a share by hash is taken."""
    rows = vectors.count()
    if rows <= head:
        return vectors
    cut = vectors.agg(F.percentile_approx("norm", 1.0 - head / rows, 10_000).alias("cut")).first()["cut"]
    longest = vectors.filter(F.col("norm") >= cut)
    share = longest.count() // head
    return longest if share < 2 else longest.filter(F.pmod(F.xxhash64("id", "norm", "terms"), F.lit(share)) == 0)


def _ranked_block(spark: SparkSession, texts: DataFrame, wanted: list[list[bytes]], top: int, bucket: int, head: int) -> DataFrame:
    """``(query, rank, id, score)`` for one block of queries."""
    vocabulary = sorted({term for terms in wanted for term in terms})
    place = {term: k for k, term in enumerate(vocabulary)}
    queries = [np.array([place[term] for term in terms], np.int64) for terms in wanted]
    entries = stage(_entries(texts, vocabulary), "search-entries").df
    facts = entries.agg(F.count(F.lit(1)).alias("documents"), F.sum("n").alias("length")).first()
    documents, length = facts["documents"], max(1, facts["length"] or 0)
    counts = entries.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("df"))
    # One row for each term of the block.
    ratio = F.lit(2.0 * documents + 2.0) / (2.0 * F.col("df") + 1.0)
    weights = np.zeros(len(vocabulary), np.int64)
    for row in counts.select("term", F.floor(F.lit(1000.0) * F.ln(ratio)).alias("w")).collect():
        weights[row["term"]] = row["w"]
    order = [F.col("norm").desc(), F.xxhash64("id", "terms")]
    vectors = _vectors(entries, weights, documents, length)
    vectors = stage(vectors.repartitionByRange(*order).sortWithinPartitions(*order), "search-vectors").df
    seen = _search(_longest(vectors, head), queries, len(vocabulary), np.zeros(len(queries), np.int64), top, bucket)
    by_score = Window.partitionBy("query").orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    # At most one row for each query: a score that ``top`` documents reach.
    reached = seen.withColumn("place", F.row_number().over(by_score)).filter(F.col("place") == top)
    least = np.zeros(len(queries), np.int64)
    for row in reached.select("query", "score").collect():
        least[row["query"]] = row["score"]
    found = stage(_search(vectors, queries, len(vocabulary), least, top, bucket), "search-found").df
    return found.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= top)
