"""Nearest neighbours by a block matrix join with int8 tiles."""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.scratch import stage

_BLOCK = (
    "dim int, n int, ids binary, rows binary, asked binary, vectors binary, codes binary, scale binary, error binary, length binary"
)
_FOUND = "query_row long, query_id long, vec_id long, score double"
# Room for rounding in the float32 products and in the bounds themselves.
_ROUNDING = 1e-5
_TILE = 1024


@dataclass
class _Block:
    """Vectors of one dimension, their int8 codes and what the codes may be wrong by."""

    ids: np.ndarray
    rows: np.ndarray  # numbers of the table's rows, as ids may repeat
    vectors: np.ndarray  # as given, scaled by a power of two each
    codes: np.ndarray  # float32 copies of the int8 codes, for exact products
    scale: np.ndarray
    error: np.ndarray  # length of unit vector minus decoded vector
    length: np.ndarray  # length of the decoded vector

    @classmethod
    def of(cls, row: dict) -> _Block:
        dim = row["dim"]
        read = lambda name, kind: np.frombuffer(row[name], kind)
        codes = read("codes", np.int8).reshape(-1, dim)
        # Sums of int8 products stay whole in float32 up to 2 ** 24.
        kind = np.float32 if dim * 127 * 127 < 1 << 24 else np.float64
        return cls(
            read("ids", np.int64),
            read("rows", np.int64),
            read("vectors", np.float64).reshape(-1, dim),
            codes.astype(kind),
            read("scale", np.float64),
            read("error", np.float64),
            read("length", np.float64),
        )


def _packed(ids: list[int], rows: list[int], asked: list[bool], vectors: list[np.ndarray], dim: int) -> dict:
    values = np.stack(vectors)
    # A power of two changes no digit of a cosine, but keeps squares within range.
    values = np.ldexp(values, -np.frexp(np.abs(values).max(axis=1))[1][:, None])
    unit = values / np.linalg.norm(values, axis=1, keepdims=True)
    scale = np.abs(unit).max(axis=1) / 127.0
    codes = np.rint(unit / scale[:, None]).astype(np.int8)
    decoded = codes * scale[:, None]
    return {
        "dim": dim,
        "n": len(ids),
        "ids": np.asarray(ids, np.int64).tobytes(),
        "rows": np.asarray(rows, np.int64).tobytes(),
        "asked": np.asarray(asked, np.bool_).tobytes(),
        "vectors": values.tobytes(),
        "codes": codes.tobytes(),
        "scale": scale.tobytes(),
        "error": np.linalg.norm(unit - decoded, axis=1).tobytes(),
        "length": np.linalg.norm(decoded, axis=1).tobytes(),
    }


def _pack(vectors: Iterator[tuple[int, int, bool, np.ndarray]], size: int) -> Iterator[pa.RecordBatch]:
    """Blocks of ``size`` vectors of one dimension from ``(id, row, asked, vector)``."""
    names = [field.split()[0] for field in _BLOCK.split(", ")]
    types = [pa.int32(), pa.int32()] + [pa.binary()] * (len(names) - 2)
    held: dict[int, tuple[list, list, list, list]] = {}

    def out(dim: int) -> pa.RecordBatch:
        row = _packed(*held.pop(dim), dim)
        return pa.RecordBatch.from_arrays([pa.array([row[n]], t) for n, t in zip(names, types, strict=True)], names=names)

    for item in vectors:
        dim = len(item[3])
        lists = held.setdefault(dim, ([], [], [], []))
        for values, value in zip(lists, item, strict=True):
            values.append(value)
        if len(lists[0]) >= size:
            yield out(dim)
    for dim in list(held):
        yield out(dim)


def _blocks(rows: DataFrame, size: int) -> DataFrame:
    """Rows ``(id, row, query, vector)`` packed by ``size`` vectors of one dimension."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given():
            for batch in batches:
                lists = batch.column("vector")
                flat, offsets = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
                keys = (batch.column(name).to_pylist() for name in ("id", "row", "query"))
                for k, key in enumerate(zip(*keys, strict=True)):
                    yield *key, flat[offsets[k] : offsets[k + 1]].copy()

        return _pack(given(), size)

    return rows.mapInArrow(pack, _BLOCK)


def _asked(blocks: DataFrame, size: int) -> DataFrame:
    """The blocks' query vectors in blocks of their own."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def given():
            for batch in batches:
                for row in batch.to_pylist():
                    read = lambda name, kind, row=row: np.frombuffer(row[name], kind)
                    ids, numbers = read("ids", np.int64), read("rows", np.int64)
                    vectors = read("vectors", np.float64).reshape(-1, row["dim"])
                    for k in np.flatnonzero(read("asked", np.bool_)):
                        yield int(ids[k]), int(numbers[k]), True, vectors[k].copy()

        return _pack(given(), size)

    return blocks.select("dim", "ids", "rows", "asked", "vectors").mapInArrow(pack, _BLOCK)


def _cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of rows, added up component by component in double precision."""
    dot, left, right = np.zeros(len(a)), np.zeros(len(a)), np.zeros(len(a))
    for k in range(a.shape[1]):
        x, y = a[:, k], b[:, k]
        dot += x * y
        left += x * x
        right += y * y
    return np.clip(dot / np.sqrt(left * right), -1.0, 1.0)


def _search(queries: _Block, groups: list[_Block], k: int) -> Iterator[tuple[int, int, list[tuple[float, int]]]]:
    """``(query row, query id, [(score, -id)])``: the ``k`` nearest of the blocks for each query."""
    heaps: list[list[tuple[float, int]]] = [[] for _ in queries.ids]
    floor = np.full(len(queries.ids), -np.inf)
    for block in groups:
        for first in range(0, len(block.ids), _TILE):
            part = slice(first, first + _TILE)
            about = (queries.codes @ block.codes[part].T) * (queries.scale[:, None] * block.scale[None, part])
            wrong = queries.error[:, None] * block.length[None, part] + (queries.length + queries.error)[:, None] * block.error[None, part]
            wrong += _ROUNDING
            own = queries.rows[:, None] == block.rows[None, part]
            low = np.where(own, -np.inf, about - wrong)
            if low.shape[1] >= k:
                kth = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
                floor = np.maximum(floor, kth)
            rows, columns = np.nonzero((about + wrong >= floor[:, None]) & ~own)
            if not len(rows):
                continue
            scores = np.empty(len(rows))
            for at in range(0, len(rows), 1 << 16):
                piece = slice(at, at + (1 << 16))
                scores[piece] = _cosines(queries.vectors[rows[piece]], block.vectors[part][columns[piece]])
            ids = block.ids[part][columns]
            order = np.lexsort((ids, -scores, rows))
            starts = np.searchsorted(rows[order], np.arange(len(heaps) + 1))
            for q in np.unique(rows):
                heap = heaps[q]
                for at in order[starts[q] : min(starts[q + 1], starts[q] + k)]:
                    item = (float(scores[at]), -int(ids[at]))
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
                if len(heap) == k:
                    floor[q] = max(floor[q], heap[0][0])
    for q, heap in enumerate(heaps):
        yield int(queries.rows[q]), int(queries.ids[q]), heap


def nearest_neighbours(
    vectors: DataFrame,
    is_query: Column,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = 5,
    block_rows: int = 2048,
    query_rows: int = 256,
    group_blocks: int = 64,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each row that ``is_query`` holds for, its ``k`` nearest other rows by cosine.

    Exact. Vectors are packed into blocks with int8 codes of their unit vectors. A tile of code
    products gives each cosine to within a bound made of the lengths of both quantisation errors;
    only pairs whose upper bound reaches the query's ``k``-th best lower bound or score are computed
    again in double precision, and heaps keep the best of each query. Candidate blocks are dealt to
    groups of at most ``group_blocks``; a task holds one group and streams all query blocks past it.
    The groups' best, ``k`` rows a query, are ranked in the end.

    Ties go to the smaller id. With fewer than ``k`` candidates all are returned. Vectors that are
    null, empty, zero, or hold a null or a value that is not finite take no part, nor do rows with
    a null id. A query meets only vectors of its own dimension. Rows that repeat an id are rows of their
    own: each is a candidate, also for the others with its id, and each that asks has ranks of its own. ``is_query`` may use any column; others are not read. An empty
    table gives no rows.
    """
    spark = vectors.sparkSession
    values = F.col(vector_col).cast("array<double>")
    usable = F.forall(values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(values, lambda x: x != 0)
    rows = vectors.filter(F.col(id_col).isNotNull() & usable)
    rows = rows.select(F.col(id_col).cast("long").alias("id"), values.alias("vector"), F.coalesce(is_query, F.lit(False)).alias("query"))
    # Rows are numbered in the job that writes the blocks; queries are taken from these, so the numbers hold.
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    blocks = stage(_blocks(rows.select("id", "row", "query", "vector"), block_rows), "vector-blocks").df
    asked = stage(_asked(blocks, query_rows), "query-blocks").df
    blocks, asked = blocks.drop("asked"), asked.drop("asked")
    tasks = spark.sparkContext.defaultParallelism
    count = blocks.count()
    groups = max(1, -(-count // group_blocks), min(count, tasks))

    # Blocks of the written table are numbered in each of its partitions; the partition shifts the start.
    at = F.monotonically_increasing_id()
    turn = F.shiftright(at, 33) + at.bitwiseAND(F.lit((1 << 33) - 1))
    dealt = blocks.withColumn("group", F.pmod(turn, F.lit(groups)))
    met = asked.withColumn("group", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    together = dealt.withColumn("kind", F.lit(0)).unionByName(met.withColumn("kind", F.lit(1)))
    together = together.repartition(groups, "group").sortWithinPartitions("group", "kind")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["group"] != group:
                    group, held = row["group"], []
                block = _Block.of(row)
                if row["kind"] == 0:
                    held.append(block)
                    continue
                same = [b for b in held if b.vectors.shape[1] == row["dim"]]
                found = [(at, q, -other, score) for at, q, heap in _search(block, same, k) for score, other in heap]
                columns = list(zip(*found, strict=True)) or [()] * 4
                types = (pa.int64(), pa.int64(), pa.int64(), pa.float64())
                names = ["query_row", "query_id", "vec_id", "score"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    best = together.mapInArrow(search, _FOUND)
    rank = F.row_number().over(Window.partitionBy("query_row").orderBy(F.col("score").desc(), "vec_id"))
    return best.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
