"""All singular triplets by one-sided block Jacobi rotations over column blocks.

The columns of ``A'`` are dealt to an even number of blocks. In a round the blocks meet in pairs, and each pair is
rotated until its columns are orthogonal; after a tournament of rounds every two blocks have met, and tournaments are
repeated until no two columns overlap. Then the lengths of the columns are the singular values and the
rotations are the left vectors. Blocks are table rows and a round is one shuffle, so no task or driver holds
more than two blocks of columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators import blocks as bl
from pairloom.operators.blocks import BLOCK_BYTES, Grid
from pairloom.scratch import Staged, stage

# The task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_SCHEMA = "slot int, off double, data binary"
# Columns overlap no more when the part of each that lies along a longer one is below this share of the whole matrix.
OVERLAP = 1e-14
MOST_SWEEPS = 30
# Rounds between two written tables.
_ROUNDS = 16


class Columns:
    """How ``n`` columns are dealt to an even number of blocks: column ``i`` is number ``i // count`` of block ``i % count``."""

    def __init__(self, n: int, parallelism: int):
        widest = max(1, BLOCK_BYTES // (16 * n))
        count = max(2 * parallelism if n > 8 * parallelism else 2, math.ceil(n / widest))
        self.n, self.count = n, count + count % 2

    def of(self, slot: int) -> np.ndarray:
        return np.arange(slot, self.n, self.count)

    def partners(self, turn: int) -> list[int]:
        """The pair of each block in a round of the tournament: block 0 stays, the others go round."""
        others = [1 + (k + turn) % (self.count - 1) for k in range(self.count - 1)]
        line = [0, *others]
        pair = [0] * self.count
        for k in range(self.count // 2):
            pair[line[k]] = pair[line[-1 - k]] = k
        return pair


def _dense(cells: DataFrame, columns: Columns) -> DataFrame:
    """Blocks of the columns of ``A'`` above the same columns of the identity."""
    count, n = columns.count, columns.n

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, block = None, None

        def out() -> pa.RecordBatch:
            return _row(slot, 0.0, block)

        for batch in batches:
            slots, i, j, value = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            edges = np.flatnonzero(np.diff(slots)) + 1
            for low, high in zip([0, *edges], [*edges, len(slots)], strict=True):
                if low == high:
                    continue
                if slots[low] != slot:
                    if slot is not None:
                        yield out()
                    slot = int(slots[low])
                    own = columns.of(slot)
                    block = np.zeros((2 * n, len(own)))
                    block[n + own, np.arange(len(own))] = 1.0
                np.add.at(block, (j[low:high], i[low:high] // count), value[low:high])
        if slot is not None:
            yield out()

    spark = cells.sparkSession
    # A cell of zero for each block, so that blocks without cells are there.
    every = spark.range(min(count, n)).select(F.col("id").cast("int").alias("i"), F.lit(0).alias("j"), F.lit(0.0).alias("value"))
    dealt = cells.select("i", "j", F.col("value").cast("double").alias("value")).unionByName(every)
    dealt = dealt.select((F.col("i") % count).alias("slot"), "i", "j", "value")
    return dealt.repartition("slot").sortWithinPartitions("slot").mapInArrow(fill, _SCHEMA)


def _row(slot: int, off: float, block: np.ndarray) -> pa.RecordBatch:
    data = pa.array([np.ascontiguousarray(block).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([slot], pa.int32()), pa.array([off]), data], ["slot", "off", "data"])


def _rotated(blocks: DataFrame, columns: Columns, turn: int, whole: float) -> DataFrame:
    """One round: each pair of blocks with its columns orthogonal, and the largest overlap that was found so far."""
    n, pair = columns.n, columns.partners(turn)

    def rotate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, float, np.ndarray]] = []
        key = None

        def out() -> Iterator[pa.RecordBatch]:
            both = np.hstack([block for _, _, block in held])
            triangle = np.linalg.qr(both[:n], mode="r")
            sizes = np.linalg.norm(triangle, axis=0)
            along = np.abs(triangle.T @ triangle) / np.maximum(np.maximum(sizes[:, None], sizes[None, :]) * whole, 1e-300)
            np.fill_diagonal(along, 0.0)
            off = max(float(along.max(initial=0.0)), *(o for _, o, _ in held))
            if along.max(initial=0.0) > OVERLAP / 8:
                both = both @ np.linalg.svd(triangle)[2].T
            at = 0
            for slot, _, block in held:
                yield _row(slot, off, both[:, at : at + block.shape[1]])
                at += block.shape[1]
            held.clear()

        for _, slot, off, data in bl._rows_of(batches):
            if pair[slot] != key and held:
                yield from out()
            key = pair[slot]
            held.append((slot, off, np.frombuffer(data).reshape(2 * n, -1)))
        if held:
            yield from out()

    pairs = F.element_at(F.array(*map(F.lit, pair)), F.col("slot") + 1) if columns.count <= 4096 else None
    if pairs is None:
        table = blocks.sparkSession.createDataFrame(list(enumerate(pair)), "slot int, pair int")
        dealt = blocks.join(F.broadcast(table), "slot").select("pair", "slot", "off", "data")
    else:
        dealt = blocks.select(pairs.alias("pair"), "slot", "off", "data")
    # The wider block first, so that larger columns go to the same side.
    return dealt.repartition(columns.count // 2, "pair").sortWithinPartitions("pair", "slot").mapInArrow(rotate, _SCHEMA)


def all_triplets(cells: DataFrame, n: int, squares: float) -> tuple[Staged, Columns, np.ndarray, np.ndarray]:
    """Orthogonal columns and their rotations as ``(slot, off, data)``; all singular values, largest first, and the column of each.

    ``squares`` is the sum of all squared cells: overlaps are measured against the whole matrix, as rounding is.
    """
    spark = cells.sparkSession
    columns = Columns(n, spark.sparkContext.defaultParallelism)
    whole = math.sqrt(squares)
    held = stage(_dense(cells, columns), "jacobi-blocks")
    for _ in range(MOST_SWEEPS):
        fresh = held.df.withColumn("off", F.lit(0.0))
        for turn in range(columns.count - 1):
            fresh = _rotated(fresh, columns, turn, whole)
            if turn % _ROUNDS == _ROUNDS - 1 or turn == columns.count - 2:
                before, held = held, stage(fresh, "jacobi-blocks")
                before.drop()
                fresh = held.df
        if (held.df.agg(F.max("off")).first()[0] or 0.0) <= OVERLAP:
            break
    else:
        raise RuntimeError(f"columns still overlap after {MOST_SWEEPS} tournaments")

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for slot, data in bl._rows_of(batches):
            sizes = np.linalg.norm(np.frombuffer(data).reshape(2 * n, -1)[:n], axis=0)
            arrays = [pa.array(np.full(len(sizes), slot, np.int32)), pa.array(np.arange(len(sizes), dtype=np.int32)), pa.array(sizes)]
            yield pa.RecordBatch.from_arrays(arrays, ["slot", "place", "sigma"])

    # One number for each column.
    found = held.df.select("slot", "data").mapInArrow(lengths, "slot int, place int, sigma double").toPandas()
    found = found.sort_values(["sigma", "slot", "place"], ascending=[False, True, True])
    return held, columns, found["sigma"].to_numpy(), found[["slot", "place"]].to_numpy()


def chosen_columns(held: DataFrame, columns: Columns, chosen: np.ndarray, grid: Grid, rotations: bool) -> DataFrame:
    """Block table of the given columns (slot, place): of the rotations, or of what the columns became."""
    n, count = columns.n, len(chosen)
    of_slot = {}
    for component, (slot, place) in enumerate(chosen):
        of_slot.setdefault(int(slot), []).append((component, int(place)))

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def terms():
            for slot, data in bl._rows_of(batches):
                own = of_slot.get(slot)
                if own:
                    values = np.frombuffer(data).reshape(2 * n, -1)
                    values = (values[n:] if rotations else values[:n])[:, [place for _, place in own]]
                    for block in range(grid.side):
                        out = np.zeros((grid.height(block), count))
                        out[:, [component for component, _ in own]] = values[grid.indexes(block)]
                        yield block, out

        return bl._partial_sums(terms())

    partial = held.select("slot", "data").mapInArrow(pick, bl._BLOCK_SCHEMA)
    return bl._sum_blocks(partial.unionByName(bl.random_blocks(held.sparkSession, grid, count, 0.0, 0)))
