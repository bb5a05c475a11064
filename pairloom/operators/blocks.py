"""Tall dense matrices and sparse tiles as Spark tables.

The rows of an ``n`` row matrix are dealt round-robin to ``side`` blocks: index ``i`` is slot
``i // side`` of block ``i % side``. Frequent words often have neighbouring indexes, so dealing
spreads them. A dense matrix with ``b`` columns is a table ``(block, data)`` with one row per block;
a sparse matrix is a table of tiles, one per pair of blocks that holds cells. Both sizes are limited
per row, whatever ``n`` is. No table of ``n`` rows is ever collected by the driver: it only sees
matrices whose sides are numbers of columns.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.scratch import BROADCAST_BYTES, Staged, delete, of_large_rows, scratch_folder, session_conf, stage

# Limits of one row: a task holds a few rows at a time in the JVM and in Python.
BLOCK_BYTES = 32 * 1024 * 1024
# A tile is read together with a block of a dense matrix, so it should not be much smaller than one.
TILE_CELLS = 524_288
# Tiles for shuffled passes are read beside rows that come once a tile, so their pieces may be small, which takes less memory.
PIECE_CELLS = 131_072
# Fewer cells than this are not worth a tile, fewer than a million not a partition of a large matrix.
SMALL_TILE_CELLS = 32_768
PARTITION_CELLS = 1_000_000
DRIVER_BYTES = 64 * 1024 * 1024
COMBINE_BYTES = 128 * 1024 * 1024
# Rows on their way back from tiles that one task adds up; merging them takes three times as much.
ROWS_BYTES = 32 * 1024 * 1024
# Rows of a dense block that one task sends to tiles.
SEND_BYTES = 512 * 1024 * 1024
# Terms of one slice of a product; about what a core's cache holds.
_PRODUCT_TERMS = 65_536
# Fewer cells than this are not worth a run.
_LEAST_RUN = 256

# The task functions travel with the job, so executors need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_BLOCK_SCHEMA = "block int, data binary"
_TILE_SCHEMA = "row_block int, col_block int, piece int, rows binary, cols binary, by_col binary, vals binary, runs binary, col_runs binary"
_WANT_SCHEMA = "row_block int, col_block int, row_slots binary, col_slots binary"
_SENT_SCHEMA = "source int, target int, slots binary, data binary"
_ROWS_SCHEMA = "block int, slots binary, data binary"


@dataclass(frozen=True)
class Grid:
    """How ``n`` indexes are dealt to ``side`` blocks."""

    n: int
    side: int

    @classmethod
    def plan(cls, n: int, cells: int, columns: int, parallelism: int) -> Grid:
        by_bytes = math.ceil(n * columns * 8 / BLOCK_BYTES)
        by_cores = min(math.ceil(math.sqrt(4 * parallelism)), math.ceil(math.sqrt(cells / SMALL_TILE_CELLS)))
        return cls(n, max(1, min(n, max(by_bytes, by_cores))))

    def height(self, block: int) -> int:
        return (self.n - block + self.side - 1) // self.side

    def indexes(self, block: int) -> np.ndarray:
        return np.arange(block, self.n, self.side, dtype=np.int32)


def tile_table(cells: DataFrame, grid: Grid, count: int, parallelism: int, by_tile: bool = False) -> DataFrame:
    """Pack cells ``(i, j, value)`` into tiles; a tile with many cells becomes several rows.

    Range partitioning on (tile, row) gives equal shares of cells, also when one tile or one word
    holds many of them. With ``by_tile`` the rows of a tile are in one partition, one after the other. A cell travels as one
    number that holds its tile, row and column, which also sorts faster than four columns.
    """
    side, height, area = grid.side, _height(grid), _height(grid) ** 2
    i, j = F.col("i").cast("long"), F.col("j").cast("long")
    tile = (i % side) * side + j % side
    key = tile * F.lit(area) + F.floor(i / side) * F.lit(height) + F.floor(j / side)
    dealt = cells.select(key.cast("long").alias("key"), F.col("value").cast("double").alias("value"))
    parts = _tile_parts(count, parallelism)
    if by_tile:
        block = F.expr(f"key div {area} div {side}").cast("int"), F.expr(f"key div {area} % {side}").cast("int")
        dealt = dealt.repartition(parts, *block)
    else:
        dealt = dealt.repartitionByRange(parts, "key")
    return dealt.sortWithinPartitions("key").mapInArrow(_packer(grid, min(TILE_CELLS, PIECE_CELLS) if by_tile else TILE_CELLS), _TILE_SCHEMA)


def _height(grid: Grid) -> int:
    return -(-grid.n // grid.side)


def _tile_parts(count: int, parallelism: int) -> int:
    return max(1, min(max(parallelism, count // PARTITION_CELLS), math.ceil(count / (SMALL_TILE_CELLS // 2))))


@dataclass(frozen=True)
class Tiles:
    """Tiles as the passes read them; for shuffled passes also which rows of the dense blocks each tile refers to.

    ``wants`` holds the lists, ``wanted_rows`` is by direction (transposed or not): how long they are in all. ``table`` and
    ``path`` are those of tiles that were laid out here.
    """

    df: DataFrame
    wants: Staged | None = None
    wanted_rows: dict[bool, int] | None = None
    table: str = ""
    path: str = ""

    def release(self) -> None:
        if self.wants is not None:
            self.wants.drop()
            self.df.sparkSession.sql(f"DROP TABLE IF EXISTS {self.table}")
            delete(self.df.sparkSession, self.path)


def shuffled(grid: Grid, count: int, parallelism: int, columns: int) -> bool:
    """Whether passes send rows to tiles instead of broadcasting the dense block: when that is too large, or when so many tasks
    would give a sum of a whole block each that more came back than goes to and from the tiles."""
    return not _fits_broadcast(grid, columns) or _tile_parts(count, parallelism) > 2 * grid.side**2


def laid_out(tiles: DataFrame, grid: Grid, count: int, parallelism: int, columns: int) -> Tiles:
    """Stored tiles as the passes want them.

    Dense blocks are exchanged by shuffle when :func:`shuffled` says so. The tiles are laid out once by tile for that,
    and each tile's list of the rows it refers to is written, so that later passes move these rows only.
    """
    if not shuffled(grid, count, parallelism, columns):
        return Tiles(tiles)
    parts, tile = _tile_parts(count, parallelism), ["row_block", "col_block"]
    return _written_by_tile(tiles.repartition(parts, *tile).sortWithinPartitions(*tile, "piece"), grid, parts)


def cells_laid_out(cells: DataFrame, grid: Grid, count: int, parallelism: int) -> Tiles:
    """Cells as tiles for shuffled passes, without a copy of the tiles in another order before."""
    return _written_by_tile(tile_table(cells, grid, count, parallelism, by_tile=True), grid, _tile_parts(count, parallelism))


def _written_by_tile(placed: DataFrame, grid: Grid, parts: int) -> Tiles:
    """Tiles that are partitioned by tile as a table with one bucket a partition: every pass reads it as it lies, without a shuffle,
    a sort or a copy that executors hold."""
    spark = placed.sparkSession
    path = scratch_folder(spark, "svd-tiles")
    table = "svd_tiles_" + path.rsplit("-", 1)[1]
    writer = of_large_rows(placed.write.bucketBy(parts, "row_block", "col_block").option("path", path).format("parquet"))
    # A task has one bucket; without this Spark would sort its rows by bucket, which are large.
    with session_conf(spark, "spark.sql.maxConcurrentOutputFileWriters", "2"):
        writer.saveAsTable(table)
    tiles = spark.table(table)
    wants = stage(tiles.select("row_block", "col_block", "rows", "cols").mapInArrow(_wanted(grid), _WANT_SCHEMA), "svd-wants", large_rows=True)
    rows, cols = wants.df.agg(*[F.sum(F.octet_length(c) / 4).cast("long") for c in ("row_slots", "col_slots")]).first()
    return Tiles(tiles, wants, {True: rows or 0, False: cols or 0}, table, path)


def _wanted(grid: Grid) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """For each tile the rows and the columns that have cells, as slots of their blocks, ascending."""

    def distinct(batches):
        key, marks = None, ()
        for row_block, col_block, *slots in _rows_of(batches):
            if (row_block, col_block) != key:
                if key is not None:
                    yield _record(_WANT_SCHEMA, *key, *(np.flatnonzero(m).astype(np.int32) for m in marks))
                key = row_block, col_block
                marks = [np.zeros(grid.height(block), bool) for block in key]
            for mark, data in zip(marks, slots):
                mark[_ints(data)] = True
        if key is not None:
            yield _record(_WANT_SCHEMA, *key, *(np.flatnonzero(m).astype(np.int32) for m in marks))

    return distinct


def sent_rows(tiles: Tiles, x: DataFrame, grid: Grid, columns: int, transposed: bool) -> DataFrame:
    """``(source, target, slots, data)``: the rows of the blocks ``x`` that each tile refers to, once a tile.

    A block whose rows go to many tiles is copied to several tasks, one for each ``SEND_BYTES`` of what it sends.
    """
    each = tiles.wanted_rows[transposed] * columns * 8 / grid.side
    splits = max(1, min(grid.side, math.ceil(each / SEND_BYTES)))
    none = F.lit(None).cast("binary")
    part = F.pmod("target", F.lit(splits))
    source, target, slots = ("row_block", "col_block", "row_slots") if transposed else ("col_block", "row_block", "col_slots")
    wants = tiles.wants.df.select(F.col(source).alias("source"), F.col(target).alias("target"), F.col(slots).alias("slots"))
    asked = wants.select("source", part.alias("part"), "target", "slots", none.alias("data"))
    copies = F.explode(F.sequence(F.lit(0), F.lit(splits - 1)))
    held = x.select(F.col("block").alias("source"), copies.alias("part"), F.lit(-1).alias("target"), none.alias("slots"), "data")

    def gather(batches):
        at, rows = None, None
        for source, piece, target, slots, data in _rows_of(batches):
            # A block comes before the lists of rows that are wanted of it.
            if target < 0:
                at, rows = (source, piece), np.frombuffer(data).reshape(-1, columns)
            elif at == (source, piece):
                slots = _ints(slots)
                yield _record(_SENT_SCHEMA, source, target, slots, rows[slots])

    both = held.unionByName(asked).repartition("source", "part")
    return both.sortWithinPartitions("source", "part", "target").mapInArrow(gather, _SENT_SCHEMA)


def _packer(grid: Grid, most: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    height, area = _height(grid), _height(grid) ** 2

    def pack(batches):
        tile, piece, held, parts = None, 0, 0, []
        for batch in batches:
            keys, vals = (column.to_numpy(zero_copy_only=False) for column in batch.columns)
            if not len(keys):
                continue
            edges = np.flatnonzero(np.diff(keys // area)) + 1 if keys[0] // area != keys[-1] // area else []
            for low, high in zip([0, *edges], [*edges, len(keys)]):
                key = int(keys[low]) // area
                if parts and (key != tile or held >= most):
                    yield _tile(divmod(tile, grid.side), piece, parts, height)
                    piece, held, parts = (piece + 1 if key == tile else 0), 0, []
                tile = key
                parts.append((keys[low:high] - key * area, vals[low:high]))
                held += int(high - low)
        if parts:
            yield _tile(divmod(tile, grid.side), piece, parts, height)

    return pack


def _tile(key: tuple[int, int], piece: int, parts: list, height: int) -> pa.RecordBatch:
    places, vals = (np.concatenate(columns) for columns in zip(*parts))
    rows = places // height
    cols = (places - rows * height).astype(np.int32)
    rows = rows.astype(np.int32)
    order, runs = _in_runs(rows)
    rows, cols, vals = rows[order], cols[order], vals[order]
    by_col = np.argsort(cols, kind="stable").astype(np.int32)
    order, col_runs = _in_runs(cols[by_col])
    return _record(_TILE_SCHEMA, *key, piece, rows, cols, by_col[order], vals, runs, col_runs)


def _in_runs(index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of the cells with ascending ``index`` by runs, and the lengths of these.

    The first run has one cell of each index, those with most cells first; the next one the second cells of as many of
    them as have one, and so on, so a run is added up at once. Cells beyond the last run follow as they were.
    """
    starts = np.flatnonzero(np.diff(index, prepend=-1))
    counts = np.diff(starts, append=len(index))
    starts = starts[np.argsort(-counts, kind="stable")]
    runs = np.cumsum(np.bincount(counts)[::-1])[::-1][1:]
    runs = runs[runs >= _LEAST_RUN].astype(np.int32)
    order = np.concatenate([np.empty(0, np.int64), *(starts[:run] + k for k, run in enumerate(runs))])
    rest = np.ones(len(index), bool)
    rest[order] = False
    return np.concatenate([order, np.flatnonzero(rest)]), runs


def multiply(
    tiles: Tiles, x: DataFrame, grid: Grid, columns: int, transposed: bool, every_block: bool = False
) -> DataFrame:
    """``A x`` or, with ``transposed``, ``A' x`` as a block table.

    A block without cells has no row in it unless ``every_block`` asks for zeros. Blocks of ``x`` are
    broadcast unless the tiles are laid out for shuffled passes; then only the rows that tiles refer to are sent, and only the rows that they touch come back.
    """
    if tiles.wants is not None:
        return _multiply_sparse(tiles, x, grid, columns, transposed, every_block)
    inward, outward = ("row_block", "col_block") if transposed else ("col_block", "row_block")
    joined = tiles.df.join(F.broadcast(x.select(F.col("block").alias(inward), "data")), inward)

    def products(batches):
        def terms():
            for block, data, *cells in _rows_of(batches):
                out = np.zeros((grid.height(block), columns))
                _add_product(out, *_cells(*cells), np.frombuffer(data).reshape(-1, columns))
                yield block, out

        return _partial_sums(terms())

    partial = joined.select(outward, "data", *_cell_columns(transposed)).mapInArrow(products, _BLOCK_SCHEMA)
    if every_block:
        partial = partial.unionByName(random_blocks(x.sparkSession, grid, columns, 0.0, 0))
    return _sum_blocks(partial)


def _multiply_sparse(tiles: Tiles, x: DataFrame, grid: Grid, columns: int, transposed: bool, every_block: bool) -> DataFrame:
    inward, outward = ("row_block", "col_block") if transposed else ("col_block", "row_block")
    sent = sent_rows(tiles, x, grid, columns, transposed)
    joined = met_rows(tiles, sent.withColumnsRenamed({"source": inward, "target": outward}))
    towards = int(transposed)

    def products(batches):
        def terms():
            tile, found = None, None

            def whole():
                slots = np.flatnonzero(touched).astype(np.int32)
                return tile[towards], slots, found[slots]

            for row_block, col_block, slots, data, *cells in _rows_of(batches):
                if (row_block, col_block) != tile:
                    if found is not None:
                        yield whole()
                    if data is None:
                        raise RuntimeError(f"rows of tile {row_block}, {col_block} did not come before its pieces")
                    tile, values = (row_block, col_block), np.frombuffer(data).reshape(-1, columns)
                    place = np.zeros(grid.height(tile[1 - towards]), np.int32)
                    place[_ints(slots)] = np.arange(len(values), dtype=np.int32)
                    found = np.zeros((grid.height(tile[towards]), columns))
                    touched = np.zeros(len(found), bool)
                runs, rows, cols, vals = _cells(*cells)
                _add_product(found, runs, rows, place.take(cols), vals, values)
                touched[rows] = True
            if found is not None:
                yield whole()

        return _partial_rows(terms())

    def totals(batches):
        held = {}
        for block, slots, data in _rows_of(batches):
            if block not in held:
                held[block] = np.zeros((grid.height(block), columns))
            if len(slots):
                held[block][_ints(slots)] += np.frombuffer(data).reshape(-1, columns)
        for block, total in held.items():
            yield _block_row(block, total)

    partial = joined.select("row_block", "col_block", "slots", "data", *_cell_columns(transposed)).mapInArrow(products, _ROWS_SCHEMA)
    if every_block:
        nothing = F.lit(bytearray())
        partial = partial.unionByName(_block_ids(x.sparkSession, grid).select("block", nothing.alias("slots"), nothing.alias("data")))
    # Some four partitions a block: a task has few blocks, and holds their sums, not the rows that it adds up.
    return partial.repartition(4 * grid.side, "block").mapInArrow(totals, _BLOCK_SCHEMA)


def met_rows(tiles: Tiles, sent: DataFrame) -> DataFrame:
    """Tiles beside the rows that were sent to them. Rows go with the first piece of a tile only, and the other pieces follow it:
    what a task reads follows the cells and the dense blocks, not their product."""
    # A hash join of what was sent keeps the order in which the tiles were written; written by an older version they have no number.
    first = F.coalesce("piece", F.lit(0)) == 0
    joined = tiles.df.join(sent.hint("shuffle_hash"), ["row_block", "col_block"])
    return joined.withColumns({name: F.when(first, F.col(name)) for name in ("slots", "data")})


def _cell_columns(transposed: bool) -> list[str]:
    return ["rows", "cols", "vals", *(["col_runs", "by_col"] if transposed else ["runs"])]


def _cells(rows, cols, vals, runs, by_col=None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Cells of a tile by runs of outward indexes: the runs, outward and inward indexes and values. Tiles that an older version
    wrote have no runs; all their cells are by ascending outward index."""
    runs = np.empty(0, np.int32) if runs is None else _ints(runs)
    rows, cols, vals = _ints(rows), _ints(cols), np.frombuffer(vals)
    if by_col is None:
        return runs, rows, cols, vals
    order = _ints(by_col)
    return runs, cols.take(order), rows.take(order), vals.take(order)


def _add_product(out: np.ndarray, runs: np.ndarray, rows: np.ndarray, cols: np.ndarray, vals: np.ndarray, x: np.ndarray) -> None:
    """``out[rows] += vals * x[cols]`` for cells by runs, in slices of limited size; cells beyond the runs have ascending ``rows``."""
    step = max(1, _PRODUCT_TERMS // x.shape[1])
    at = 0
    if len(runs):
        total = np.zeros((int(runs[0]), x.shape[1]))
        for run in runs.tolist():
            for low in range(0, run, step):
                part = slice(at + low, at + min(run, low + step))
                terms = x.take(cols[part], axis=0)
                terms *= vals[part, None]
                total[low : low + len(terms)] += terms
            at += run
        out[rows[: len(total)]] += total
    for low in range(at, len(rows), step):
        part = slice(low, low + step)
        starts = np.flatnonzero(np.diff(rows[part], prepend=-1))
        terms = x.take(cols[part], axis=0)
        terms *= vals[part, None]
        out[rows[part][starts]] += np.add.reduceat(terms, starts, axis=0)


class BlockStore:
    """Block tables written as ``seq=0``, ``seq=1``, ... of one scratch folder, read back in one scan."""

    def __init__(self, spark: SparkSession, grid: Grid, folder: str | None = None):
        """With a ``folder`` of the caller, dropped tables stay until :meth:`forget_dropped`."""
        self.spark, self.grid, self.kept = spark, grid, folder is not None
        self.folder = folder or scratch_folder(spark, "svd-blocks")
        self.widths: dict[int, int] = {}
        self.next = 0
        self._dropped: list[int] = []

    def write(self, blocks: DataFrame, width: int) -> int:
        """Write a block table and return its number."""
        seq = self.next
        self.next += 1
        # What a stopped run left in a folder of the caller goes.
        writer = blocks.write.mode("overwrite" if self.kept else "errorifexists")
        of_large_rows(writer).parquet(f"{self.folder}/seq={seq}")
        self.widths[seq] = width
        return seq

    def read(self, *seqs: int) -> DataFrame:
        """``(block, data, seq)`` of the given tables."""
        reader = self.spark.read.schema(f"{_BLOCK_SCHEMA}, seq int").option("basePath", self.folder)
        return reader.parquet(*[f"{self.folder}/seq={seq}" for seq in seqs])

    def drop(self, *seqs: int) -> None:
        self._dropped.extend(seqs)
        if not self.kept:
            self.forget_dropped()

    def forget_dropped(self) -> None:
        for seq in self._dropped:
            delete(self.spark, f"{self.folder}/seq={seq}")
        self._dropped = []

    def combine(self, factors: dict[int, np.ndarray]) -> DataFrame:
        """Block table of the sum of ``table[s] @ factors[s]``."""

        def scaled(batches):
            def terms():
                for seq, block, data in _rows_of(batches):
                    factor = factors[seq]
                    yield block, np.frombuffer(data).reshape(-1, factor.shape[0]) @ factor

            return _partial_sums(terms())

        tables = self.read(*factors).select("seq", "block", "data")
        return _sum_blocks(tables.mapInArrow(scaled, _BLOCK_SCHEMA))

    def inner(self, left: list[int], right: list[int]) -> dict[tuple[int, int], np.ndarray]:
        """``table[l]' @ table[r]`` for every l and r: column by column, the size does not depend on ``n``."""
        widths, pairs = self.widths, len(right)
        partial = self._products(left, right)
        # One task gives at most one product per pair of tables, and there are at most as many tasks as
        # blocks read. If even all of these are few they need no shuffle to be added up.
        bound = 8 * self.grid.side * len(left) * sum(widths[a] * widths[b] for a in left for b in right)
        if bound > DRIVER_BYTES:
            partial = _sum_blocks(partial)
        totals = {(a, b): np.zeros((widths[a], widths[b])) for a in left for b in right}
        for row in partial.collect():
            pair = row["block"] // pairs, right[row["block"] % pairs]
            totals[pair] += np.frombuffer(row["data"]).reshape(totals[pair].shape)
        return totals

    def _products(self, left: list[int], right: list[int]) -> DataFrame:
        """Partial sums of the products of blocks, keyed by the pair of tables.

        Blocks on the right that are small in all are broadcast; else all tables are shuffled by block, each once, and the
        blocks of the right come first.
        """
        widths, pairs = dict(self.widths), len(right)
        place = {seq: position for position, seq in enumerate(right)}
        if _fits_broadcast(self.grid, sum(widths[seq] for seq in right)):
            others = self.read(*right).select("block", F.col("seq").alias("other"), F.col("data").alias("other_data"))
            joined = self.read(*left).join(F.broadcast(others), "block").select("seq", "other", "data", "other_data")

            def products(batches):
                def terms():
                    for seq, other, data, other_data in _rows_of(batches):
                        a = np.frombuffer(data).reshape(-1, widths[seq])
                        yield seq * pairs + place[other], a.T @ np.frombuffer(other_data).reshape(-1, widths[other])

                return _partial_sums(terms())

            return joined.mapInArrow(products, _BLOCK_SCHEMA)

        both = set(left) & set(right)

        def met(batches):
            def against(seq, values, others):
                for other, held in others.items():
                    yield seq * pairs + place[other], values.T @ held

            def terms():
                current, others = None, {}
                for block, later, seq, data in _rows_of(batches):
                    if block != current:
                        for own in both & others.keys():
                            yield from against(own, others[own], others)
                        current, others = block, {}
                    values = np.frombuffer(data).reshape(-1, widths[seq])
                    if later:
                        yield from against(seq, values, others)
                    else:
                        others[seq] = values
                for own in both & others.keys():
                    yield from against(own, others[own], others)

            return _partial_sums(terms())

        later = (~F.col("seq").isin(list(right))).cast("int").alias("later")
        tables = self.read(*right, *[seq for seq in left if seq not in place]).select("block", later, "seq", "data")
        return tables.repartition("block").sortWithinPartitions("block", "later").mapInArrow(met, _BLOCK_SCHEMA)

    def triangular(self, seqs: list[int], parallelism: int) -> np.ndarray:
        """``R`` of the QR factorization of all tables side by side, so ``R' R`` are their inner products.

        Rows are cut into slices that a task can hold, each task folds its slices into one small triangle, and the
        triangles are folded eight at a time until the rest is small enough to collect. Nothing is squared.
        """
        columns = sum(self.widths[seq] for seq in seqs)
        ends = np.cumsum([0, *(self.widths[seq] for seq in seqs)])
        place = {seq: (int(ends[k]), int(ends[k + 1])) for k, seq in enumerate(seqs)}
        height = max(1, BLOCK_BYTES // (8 * columns))
        widths = self.widths

        def sliced(batches):
            for seq, block, data in _rows_of(batches):
                values = np.frombuffer(data).reshape(-1, widths[seq])
                for low in range(0, len(values), height):
                    cell = pa.array([np.ascontiguousarray(values[low : low + height]).tobytes()], pa.binary())
                    keys = [pa.array([x], pa.int32()) for x in (block, low // height, seq)]
                    yield pa.RecordBatch.from_arrays([*keys, cell], ["block", "part", "seq", "data"])

        def factor(batches):
            total, key, rows = np.zeros((0, columns)), None, None
            for block, part, seq, data in _rows_of(batches):
                low, high = place[seq]
                values = np.frombuffer(data).reshape(-1, high - low)
                if (block, part) != key:
                    if rows is not None:
                        total = np.linalg.qr(np.vstack([total, rows]), mode="r")
                    key, rows = (block, part), np.zeros((len(values), columns))
                rows[:, low:high] = values
            if rows is not None:
                yield _block_row(0, np.linalg.qr(np.vstack([total, rows]), mode="r"))

        def fold(batches):
            total = np.zeros((0, columns))
            for _, data in _rows_of(batches):
                total = np.linalg.qr(np.vstack([total, np.frombuffer(data).reshape(-1, columns)]), mode="r")
            if len(total):
                yield _block_row(0, total)

        slices = self.read(*seqs).select("seq", "block", "data").mapInArrow(sliced, "block int, part int, seq int, data binary")
        parts, key = max(1, min(parallelism, self.grid.side)), ["block", "part"]
        triangles = slices.repartition(parts, *key).sortWithinPartitions(*key).mapInArrow(factor, _BLOCK_SCHEMA)
        while parts > 1 and parts * columns * columns * 8 > DRIVER_BYTES:
            parts = -(-parts // 8)
            triangles = triangles.repartition(parts).mapInArrow(fold, _BLOCK_SCHEMA)
        stacked = [np.frombuffer(row["data"]).reshape(-1, columns) for row in triangles.collect()]
        return np.linalg.qr(np.vstack([np.zeros((columns, columns)), *stacked]), mode="r")


def random_blocks(spark: SparkSession, grid: Grid, columns: int, scale: float, seed: int) -> DataFrame:
    """Block table of normal random numbers, a function of the seed and the block."""

    def draw(batches):
        for (block,) in _rows_of(batches):
            numbers = np.random.default_rng([seed, block]).standard_normal((grid.height(block), columns))
            yield _block_row(block, numbers * scale)

    return _block_ids(spark, grid).mapInArrow(draw, _BLOCK_SCHEMA)


def random_rows(blocks: DataFrame, grid: Grid, columns: int, seed: int) -> DataFrame:
    """Normal random numbers in the rows of ``blocks`` that are not zero, zero elsewhere."""

    def draw(batches):
        for block, data in _rows_of(batches):
            some = (np.frombuffer(data).reshape(-1, columns) != 0).any(axis=1)
            numbers = np.random.default_rng([seed, block]).standard_normal((grid.height(block), columns))
            yield _block_row(block, numbers * some[:, None] / np.sqrt(grid.n))

    return blocks.select("block", "data").mapInArrow(draw, _BLOCK_SCHEMA)


def vectors(blocks: DataFrame, grid: Grid, scale: np.ndarray) -> DataFrame:
    """``(i, features)`` with one row per index; column ``c`` is multiplied by ``scale[c]``."""
    columns = len(scale)

    def spread(batches):
        for block, data in _rows_of(batches):
            values = np.frombuffer(data).reshape(-1, columns) * scale + 0.0
            index = grid.indexes(block)
            for low in range(0, len(index), 4096):
                part = values[low : low + 4096]
                offsets = np.arange(0, part.size + 1, columns, dtype=np.int32)
                features = pa.ListArray.from_arrays(pa.array(offsets), pa.array(part.ravel()))
                yield pa.RecordBatch.from_arrays([pa.array(index[low : low + 4096]), features], ["i", "features"])

    return blocks.select("block", "data").mapInArrow(spread, "i int, features array<double>")


def column_signs(blocks: DataFrame, grid: Grid, columns: int) -> np.ndarray:
    """Per column the sign of its entry of largest magnitude (the first such entry)."""

    def largest(batches):
        for block, data in _rows_of(batches):
            values = np.frombuffer(data).reshape(-1, columns)
            slot = np.argmax(np.abs(values), axis=0)
            entry = values[slot, np.arange(columns)]
            where = grid.indexes(block)[slot]
            arrays = [np.arange(columns, dtype=np.int32), where, entry]
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in arrays], ["component", "i", "value"])

    entries = blocks.select("block", "data").mapInArrow(largest, "component int, i int, value double")
    first = F.max_by("value", F.struct(F.abs("value"), -F.col("i"))).alias("value")
    signs = np.ones(columns)
    for row in entries.groupBy("component").agg(first).collect():
        signs[row["component"]] = -1.0 if row["value"] < 0 else 1.0
    return signs


def _fits_broadcast(grid: Grid, columns: int) -> bool:
    return grid.n * columns * 8 <= BROADCAST_BYTES


def _block_ids(spark: SparkSession, grid: Grid) -> DataFrame:
    return spark.range(grid.side).select(F.col("id").cast("int").alias("block"))


def _partial_sums(terms: Iterable[tuple[int, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Add up terms of the same block before the shuffle, in limited memory."""
    sums: dict[int, np.ndarray] = {}
    held = 0
    for block, value in terms:
        if block in sums:
            sums[block] += value
            continue
        if held + value.nbytes > COMBINE_BYTES:
            yield from (_block_row(b, v) for b, v in sums.items())
            sums, held = {}, 0
        sums[block] = value
        held += value.nbytes
    yield from (_block_row(b, v) for b, v in sums.items())


def _partial_rows(terms: Iterable[tuple[int, np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
    """Add up rows of the same block and slot before the shuffle, in limited memory."""
    held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
    size, limit = 0, min(COMBINE_BYTES, ROWS_BYTES)

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        if len(parts) == 1:
            return parts[0]
        slots, values = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(slots, kind="stable")
        starts = np.flatnonzero(np.diff(slots[order], prepend=-1))
        return slots[order][starts], np.add.reduceat(values[order], starts, axis=0)

    for block, slots, values in terms:
        held.setdefault(block, []).append((slots, values))
        size += values.nbytes
        if size > limit:
            held = {b: [merged(parts)] for b, parts in held.items()}
            size = sum(parts[0][1].nbytes for parts in held.values())
            if size > limit // 2:
                yield from (_record(_ROWS_SCHEMA, b, *parts[0]) for b, parts in held.items())
                held, size = {}, 0
    yield from (_record(_ROWS_SCHEMA, b, *merged(parts)) for b, parts in held.items())


def _sum_blocks(partial: DataFrame) -> DataFrame:
    """Add up partial blocks. Sorted input means one block in memory at a time."""

    def totals(batches):
        current, total = None, None
        for block, data in _rows_of(batches):
            value = np.frombuffer(data)
            if block == current:
                total += value
                continue
            if current is not None:
                yield _block_row(current, total)
            current, total = block, value.copy()
        if current is not None:
            yield _block_row(current, total)

    return partial.repartition("block").sortWithinPartitions("block").mapInArrow(totals, _BLOCK_SCHEMA)


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Rows of Arrow batches; binary cells as buffers without a copy."""
    for batch in batches:
        binary = [pa.types.is_binary(field.type) for field in batch.schema]
        for row in range(batch.num_rows):
            yield tuple(
                column[row].as_buffer() if is_binary else column[row].as_py()
                for column, is_binary in zip(batch.columns, binary)
            )


def _ints(buffer: pa.Buffer) -> np.ndarray:
    return np.frombuffer(buffer, dtype=np.int32)


def _block_row(block: int, values: np.ndarray) -> pa.RecordBatch:
    data = pa.array([np.ascontiguousarray(values, dtype=np.float64).tobytes()], pa.binary())
    return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), data], ["block", "data"])


def _record(schema: str, *values: int | np.ndarray) -> pa.RecordBatch:
    """One row of whole numbers and of arrays as binary."""
    names = [field.split()[0] for field in schema.split(", ")]
    arrays = [
        pa.array([np.ascontiguousarray(v).tobytes()], pa.binary()) if isinstance(v, np.ndarray) else pa.array([v], pa.int32())
        for v in values
    ]
    return pa.RecordBatch.from_arrays(arrays, names)
