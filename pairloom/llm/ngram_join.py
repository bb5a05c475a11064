"""N-gram Jaccard join by blocked sparse matrix products."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.components import connected_components
from pairloom.llm.hashing import runs, shingles, word_hashes
from pairloom.llm.lookup import lookup
from pairloom.scratch import broadcast_if_small, kept_result, small_batches, stage

_ROW = "id long, n long, k1 long, k2 long, prefix array<long>"
_SET = "id long, k1 long, k2 long, tokens array<long>"
_SLICES = 64
# Shingles of the pairs whose overlaps accumulate together.
_PAIR_TOKENS = 1 << 20


def _sets(ids: pa.Array, texts: pa.Array, size: int) -> Iterator[tuple[list, list[np.ndarray]]]:
    """Ids and the sorted distinct shingles of their texts, some rows at a time."""
    for first, words, ends in word_hashes(texts):
        starts = np.concatenate([[0], ends[:-1]])
        found = [np.unique(shingles(words[a:b], size)) for a, b in zip(starts, ends, strict=True)]
        yield ids[first : first + len(ends)].to_pylist(), found


def _key(tokens: np.ndarray) -> tuple[int, int]:
    digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
    return int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True)


def _lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64)))


def shingle_counts(rows: DataFrame, size: int, bits: int) -> np.ndarray:
    """How many shingles of all texts fall on each of ``2 ** bits`` counters. Of fixed size, whatever the table."""
    width = (1 << bits) // _SLICES

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << bits, np.int64)
        for batch in batches:
            for _, words, ends in word_hashes(batch.column("text")):
                starts = np.concatenate([[0], ends[:-1]])
                tokens = [shingles(words[a:b], size) for a, b in zip(starts, ends, strict=True)]
                if len(words):
                    at = (np.concatenate(tokens) >> np.uint64(64 - bits)).astype(np.int64)
                    counts += np.bincount(at, minlength=1 << bits)
        if counts.any():
            parts = [counts[k * width : (k + 1) * width].astype(np.uint32).tobytes() for k in range(_SLICES)]
            yield pa.RecordBatch.from_arrays([pa.array(range(_SLICES), pa.int32()), pa.array(parts, pa.binary())], names=["slice", "counts"])

    def add(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for part in parts:
            for slice_, counts in zip(part.column("slice").to_pylist(), part.column("counts"), strict=True):
                sums[slice_] = sums.get(slice_, 0) + np.frombuffer(counts.as_buffer(), np.uint32).astype(np.int64)
        totals = [s.astype(np.int64).tobytes() for s in sums.values()]
        yield pa.RecordBatch.from_arrays([pa.array(list(sums), pa.int32()), pa.array(totals, pa.binary())], names=["slice", "counts"])

    partial = rows.mapInArrow(count, "slice int, counts binary").repartition(_SLICES, "slice")
    total = np.zeros(1 << bits, np.int64)
    for row in partial.mapInArrow(add, "slice int, counts binary").collect():
        total[row["slice"] * width : (row["slice"] + 1) * width] += np.frombuffer(row["counts"], np.int64)
    return total


def _prefixes(rows: DataFrame, counts: np.ndarray, size: int, percent: int) -> DataFrame:
    """Per row: the size and digest of its set, and its rarest shingles, one of which any linked set must share."""
    bits = int(math.log2(len(counts)))
    shared = rows.sparkSession.sparkContext.broadcast(np.minimum(counts, (1 << 32) - 1).astype(np.uint32))

    def prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            for ids, sets in _sets(batch.column("id"), batch.column("text"), size):
                parts, keys = [], []
                for tokens in sets:
                    need = -(-percent * len(tokens) // 100)
                    rare = np.lexsort((tokens, known[(tokens >> np.uint64(64 - bits)).astype(np.int64)]))
                    parts.append(tokens[rare[: len(tokens) - need + 1 if len(tokens) else 0]])
                    keys.append(_key(tokens))
                columns = [ids, [len(s) for s in sets], [k for k, _ in keys], [k for _, k in keys]]
                arrays = [pa.array(c, pa.int64()) for c in columns] + [_lists(parts)]
                yield pa.RecordBatch.from_arrays(arrays, names=["id", "n", "k1", "k2", "prefix"])

    return rows.mapInArrow(prefixes, _ROW)


def _full_sets(rows: DataFrame, size: int) -> DataFrame:
    def full(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for ids, sets in _sets(batch.column("id"), batch.column("text"), size):
                keys = [_key(tokens) for tokens in sets]
                arrays = [pa.array(c, pa.int64()) for c in (ids, [k for k, _ in keys], [k for _, k in keys])]
                yield pa.RecordBatch.from_arrays([*arrays, _lists(sets)], names=["id", "k1", "k2", "tokens"])

    return rows.mapInArrow(full, _SET)


def _may_link(percent: int) -> Column:
    """Bounds for sides a and b that share a shingle: by their sizes, and by what follows its place in either order."""
    need = F.ceil(F.lit(float(percent)) * (F.col("a.n") + F.col("b.n")) / (100.0 + percent))
    after = F.least(F.col("a.n") - F.col("a.pos"), F.col("b.n") - F.col("b.pos"))
    sizes = F.lit(100) * F.least("a.n", "b.n") >= F.lit(percent) * F.greatest("a.n", "b.n")
    return sizes & (after >= need)


def _accumulated(pairs: DataFrame, percent: int, blocks: int) -> DataFrame:
    """``(a, b)``: candidate pairs that link, of ``(a, b, ta, tb)``.

    The columns are cut into ``blocks`` ranges of the shingles' hashes. The overlaps of all pairs of a batch
    are counted one range after another and added up; a pair goes as soon as what it has and
    the smaller rest of its two sets stay below the overlap that its sizes ask for.
    """

    def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = sum(np.diff(batch.column(name).offsets.to_numpy()).astype(np.int64) for name in ("ta", "tb"))
            for first, last in runs(np.concatenate([[0], np.cumsum(sizes)]), _PAIR_TOKENS):
                part = batch.slice(first, last - first)
                a, b = (part.column(name).to_numpy() for name in ("a", "b"))
                alive = _linked_pairs(*(_side(part.column(name)) for name in ("ta", "tb")), percent, blocks)
                yield pa.RecordBatch.from_arrays([pa.array(a[alive]), pa.array(b[alive])], names=["a", "b"])

    return pairs.select("a", "b", "ta", "tb").mapInArrow(accumulate, "a long, b long")


def _side(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All shingles of one side in the order of their pairs, and the size of each set."""
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy()[offsets[0] : offsets[-1]].view(np.uint64), np.diff(offsets).astype(np.int64)


def _linked_pairs(left: tuple, right: tuple, percent: int, blocks: int) -> np.ndarray:
    """Which pairs link; see :func:`_accumulated`."""
    need = -(-percent * (left[1] + right[1]) // (100 + percent))
    rests = [left[1].copy(), right[1].copy()]
    alive = np.arange(len(need))
    common = np.zeros(len(need), np.int64)
    sides = []
    for tokens, sizes in (left, right):
        pair = np.repeat(np.arange(len(sizes)), sizes)
        block = (tokens.astype(np.float64) / 2.0**64 * blocks).astype(np.int64).clip(0, blocks - 1)
        order = np.lexsort((pair, block))
        sides.append((pair[order], tokens[order], np.searchsorted(block[order], np.arange(blocks + 1))))
    for k in range(blocks):
        keep = np.zeros(len(need), bool)
        keep[alive] = True
        parts = []
        for side, (pair, tokens, ends) in enumerate(sides):
            own, held = pair[ends[k] : ends[k + 1]], tokens[ends[k] : ends[k + 1]]
            rests[side] -= np.bincount(own, minlength=len(need))
            parts.append((own[keep[own]], held[keep[own]]))
        own, held = (np.concatenate([p[i] for p in parts]) for i in (0, 1))
        order = np.lexsort((held, own))
        own, held = own[order], held[order]
        # A set has no shingle twice, so neighbours that agree are of both sides.
        same = (own[1:] == own[:-1]) & (held[1:] == held[:-1])
        common += np.bincount(own[1:][same], minlength=len(need))
        alive = alive[common[alive] + np.minimum(rests[0], rests[1])[alive] >= need[alive]]
        if not len(alive):
            break
    return alive


def _tile_links(left: list[np.ndarray], right: list[np.ndarray], percent: int, same: bool) -> np.ndarray:
    """Which rows of a tile link: the product of two incidence matrices, a run of columns at a time."""
    sizes_l, sizes_r = np.array([len(t) for t in left]), np.array([len(t) for t in right])
    both = left if same else left + right
    columns, counts = np.unique(np.concatenate(both), return_counts=True)
    # A shingle of one row adds to no overlap.
    columns = columns[counts > 1]
    overlap = np.zeros((len(left), len(right)), np.float32)
    for at in range(0, len(columns), 4096):
        part = columns[at : at + 4096]

        def incidence(sets: list[np.ndarray], part: np.ndarray = part) -> np.ndarray:
            matrix = np.zeros((len(sets), len(part)), np.float32)
            for k, tokens in enumerate(sets):
                inside = tokens[np.searchsorted(tokens, part[0]) : np.searchsorted(tokens, part[-1], side="right")]
                place = np.searchsorted(part, inside)
                matrix[k, place[part[place] == inside]] = 1.0
            return matrix

        first = incidence(left)
        overlap += first @ (first if same else incidence(right)).T
    joint = sizes_l[:, None] + sizes_r[None, :] - overlap
    linked = 100 * overlap >= percent * joint
    if same:
        linked &= ~np.eye(len(left), dtype=bool)
    return linked


def _forest(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links enough to connect what a tile connects."""
    leader: dict[int, int] = {}

    def find(x: int) -> int:
        while leader.get(x, x) != x:
            leader[x] = leader.get(leader[x], leader[x])
            x = leader[x]
        return x

    kept = []
    for i in np.flatnonzero(linked.any(axis=1)):
        for j in np.flatnonzero(linked[i]):
            a, b = find(int(left[i])), find(int(right[j]))
            if a != b:
                leader[max(a, b)] = min(a, b)
                kept.append((int(left[i]), int(right[j])))
    return kept


def _hot_tiles(hot: DataFrame, nodes: DataFrame, percent: int, block: int) -> DataFrame:
    """``(tile, side, cluster, node)``: blocks of sets to multiply, for shingles that too many sets share.

    Sets that share such shingles, over any number of steps, are one cluster. A cluster is cut by
    size, as sets of very different sizes cannot link, and then by hash into blocks of about
    ``block`` sets; tiles are the pairs of blocks of the same or neighbouring sizes. Each pair of
    sets of a cluster that can link meets in one tile.
    """
    root = hot.groupBy("node").agg(F.min("token").alias("root"))
    pairs = hot.select("node", "token").join(root, "node").select(F.col("token").alias("a"), F.col("root").alias("b"))
    clusters = connected_components(pairs.distinct()).select(F.col("node").alias("root"), F.col("root").alias("cluster"))
    placed = root.join(clusters, "root", "left").select("node", F.coalesce("cluster", "root").alias("cluster"))
    band = F.floor(F.log(F.col("n").cast("double")) / F.lit(math.log(100 / percent)) + F.lit(1e-9)).cast("long")
    placed = placed.join(nodes.select("node", "n"), "node").withColumn("band", band)
    sizes = placed.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("members"))
    sizes = stage(sizes.withColumn("chunks", F.ceil(F.col("members") / block).cast("long")), "hot-sizes").df
    chunk = F.pmod(F.xxhash64("node"), F.col("chunks"))
    placed = stage(placed.join(sizes, ["cluster", "band"]).withColumn("chunk", chunk).drop("members", "chunks"), "hot-nodes").df
    blocks = sizes.withColumn("chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)))
    first = blocks.select("cluster", F.col("band").alias("band1"), F.col("chunk").alias("chunk1"))
    steps = first.withColumn("band2", F.explode(F.array("band1", F.col("band1") + 1)))
    second = blocks.select("cluster", F.col("band").alias("band2"), F.col("chunk").alias("chunk2"))
    tiles = steps.join(second, ["cluster", "band2"]).filter("band1 < band2 OR chunk1 <= chunk2")
    tiles = tiles.withColumn("tile", F.xxhash64("cluster", "band1", "chunk1", "band2", "chunk2"))
    sides = tiles.select("tile", "cluster", F.explode(F.array(*[F.struct(F.lit(k).alias("side"), F.col(f"band{k}").alias("band"), F.col(f"chunk{k}").alias("chunk")) for k in (1, 2)])).alias("at"))
    sides = sides.select("tile", "cluster", "at.side", "at.band", "at.chunk")
    same = tiles.filter("band1 = band2 AND chunk1 = chunk2").select("tile").withColumn("same", F.lit(True))
    sides = sides.join(same, "tile", "left").filter("same IS NULL OR side = 1").withColumn("same", F.coalesce("same", F.lit(False)))
    return placed.join(sides, ["cluster", "band", "chunk"]).select("tile", "side", "same", "cluster", "node")


def _multiply_tiles(tiles: DataFrame, sets: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """``(a, b, links)``: links that connect what the tiles connect, and per node (b null) how many rows it links with."""

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list[int], list[np.ndarray], list[int]]] = {}
        tile, same = None, False

        def done() -> pa.RecordBatch:
            empty = ([], [], [])
            left, right = held.get(1, empty), held.get(1 if same else 2, empty)
            a, b, links = [], [], []
            if left[0] and right[0]:
                linked = _tile_links(left[1], right[1], percent, same)
                ids_l, ids_r = np.array(left[0]), np.array(right[0])
                for x, y in _forest(linked, ids_l, ids_r):
                    a, b, links = [*a, x], [*b, y], [*links, 0]
                degrees = [(ids_l, linked @ np.array(right[2]))] + ([] if same else [(ids_r, linked.T @ np.array(left[2]))])
                for ids, degree in degrees:
                    a, b, links = [*a, *ids[degree > 0].tolist()], [*b, *[None] * int((degree > 0).sum())], [*links, *degree[degree > 0].tolist()]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (a, b, links)], names=["a", "b", "links"])

        for batch in batches:
            lists = batch.column("tokens")
            flat, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
            columns = [batch.column(name).to_pylist() for name in ("tile", "side", "same", "node", "members")]
            for k, (of, side, whole, node, count) in enumerate(zip(*columns, strict=True)):
                if of != tile:
                    if tile is not None:
                        yield done()
                    tile, same, held = of, whole, {}
                nodes, tokens, counts = held.setdefault(side, ([], [], []))
                nodes.append(node)
                tokens.append(np.sort(flat[offsets[k] : offsets[k + 1]].view(np.uint64)))
                counts.append(count)
        if tile is not None:
            yield done()

    placed = stage(tiles.join(members, "node"), "ngram-placed")
    rows = sets.join(broadcast_if_small(placed.df, placed.count(), 64), "node")
    rows = rows.select("tile", "side", "same", "node", "members", "tokens")
    return rows.repartition("tile").sortWithinPartitions("tile").mapInArrow(multiply, "a long, b long, links long")


def ngram_join(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 4,
    percent: int = 85,
    sketch_bits: int = 20,
    cold: int = 128,
    block: int = 512,
    column_blocks: int = 16,
) -> DataFrame:
    """``(id_col, n_shingles, component_id, n_links)``, a row for every row of ``docs``.

    A text's set holds its distinct runs of ``size`` words between ASCII blanks, A to Z lower-cased,
    as 64-bit hashes; a shorter text is one run. Two texts link when ``percent`` hundredths of their
    joint set are common. ``component_id`` is the smallest id reachable by links, its own included;
    ``n_links`` counts the other rows that a row links with.

    Equal sets are one class and go on as one. Shingles are ordered by how often they occur, by
    counters of a fixed number; any order gives right results, a good one fewer candidates. Of a
    set of ``n``, the rarest ``n - ceil(n percent / 100) + 1`` are its prefix, and linked sets share
    one of their prefixes. Columns of the incidence matrix (prefix shingles) with up to ``cold``
    sets are multiplied by a join of the column with itself, which makes at most ``cold / 2`` pairs
    per entry; size and place bounds discard pairs at once. Overlaps of the rest accumulate over
    ``column_blocks`` blocks of all columns, and a pair goes when its sizes leave too little. Columns with
    more sets would make pairs by the square, so their sets are
    gathered to clusters and multiplied block by block in numpy; a tile gives a few links that
    connect the same sets, and no pairs. Nothing is capped or left out.

    A null text counts as empty; an empty text has no set and links with nothing. A null id is
    ignored by the smallest id, and is the component only where no other id is. Rows that repeat an
    id are documents of their own. Other columns are not read. An empty table gives no rows.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    with small_batches(docs.sparkSession):
        linked = kept_result(docs.sparkSession, lambda: _linked_rows(rows, size, percent, sketch_bits, cold, block, column_blocks), "ngram-result")
    return linked.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component")).otherwise(F.col("id")).alias("component_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
    )


def _linked_rows(rows: DataFrame, size: int, percent: int, sketch_bits: int, cold: int, block: int, column_blocks: int) -> DataFrame:
    """``(id, n, component, n_links)``; see :func:`ngram_join`."""
    counts = shingle_counts(rows.select("text"), size, sketch_bits)
    found = _prefixes(rows, counts, size, percent).withColumn("row", F.monotonically_increasing_id())
    found = stage(found, "ngram-rows").df
    # Narrow partial sums take in any number of copies.
    classes = found.filter("n > 0").groupBy("k1", "k2")
    classes = stage(
        classes.agg(F.min("row").alias("node"), F.min("id").alias("first"), F.first("n").alias("n"), F.count(F.lit(1)).alias("members")),
        "ngram-classes",
    ).df
    # Copies are few or many, but their rows are narrow; the sets themselves stay where they are while the list is small.
    again = classes.filter("members > 1").select("k1", "k2", "node")
    copies = stage(found.select("row", "k1", "k2").join(again, ["k1", "k2"]).filter("row <> node").select("row"), "ngram-copies")
    one_each = found.filter("n > 0").join(broadcast_if_small(copies.df, copies.count(), 16), "row", "left_anti")
    entries = one_each.select(F.col("row").alias("node"), "n", F.posexplode("prefix").alias("pos", "token"))
    often = entries.groupBy("token").agg(F.count(F.lit(1)).alias("sets")).filter("sets > 1")
    columns = stage(entries.join(often, "token"), "ngram-columns").df

    narrow = columns.filter(F.col("sets") <= cold)
    a, b = narrow.alias("a"), narrow.alias("b")
    meet = (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & _may_link(percent)
    pairs = a.join(b, meet).select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()
    hot = columns.filter(F.col("sets") > cold)
    has_hot = not hot.isEmpty()
    if has_hot:
        tiles = stage(_hot_tiles(hot, classes, percent, block), "ngram-tiles").df
        cluster = tiles.select("node", "cluster").distinct()
        inside = pairs.join(cluster.select(F.col("node").alias("a"), F.col("cluster").alias("ca")), "a", "left")
        inside = inside.join(cluster.select(F.col("node").alias("b"), F.col("cluster").alias("cb")), "b", "left")
        # Those of one cluster meet in a tile.
        pairs = inside.filter("ca IS NULL OR cb IS NULL OR ca <> cb").select("a", "b")
    pairs = stage(pairs, "ngram-pairs")
    few_pairs = broadcast_if_small(pairs.df, pairs.count(), 32)
    pairs = pairs.df

    involved = pairs.select(F.explode(F.array("a", "b")).alias("node"))
    if has_hot:
        involved = involved.unionByName(tiles.select("node"))
    wanted = classes.join(involved.distinct(), "node", "left_semi").join(found.select(F.col("row").alias("node"), "id"), "node")
    wanted = stage(wanted.select("node", "id", "k1", "k2"), "ngram-wanted")
    ids = wanted.df.select(F.col("id").alias("wanted_id"))
    texts = rows.join(broadcast_if_small(ids, wanted.count(), 32), F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi")
    keys = broadcast_if_small(wanted.df.drop("id"), wanted.count(), 48)
    sets = _full_sets(texts, size).join(keys, ["k1", "k2"]).select("node", "tokens")
    sets = stage(sets, "ngram-sets")
    if sets.count() > wanted.count():
        # Texts are chosen by id, and rows that repeat one may hold the sets of several nodes, or one set twice.
        sets = stage(sets.df.groupBy("node").agg(F.first("tokens").alias("tokens")), "ngram-sets")
    sets = sets.df

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("tb"))
    # Sets of a pair meet where the second one is; while pairs are few the first needs no shuffle.
    met = left.join(few_pairs, "a").join(right, "b")
    links = stage(_accumulated(met, percent, column_blocks), "ngram-links").df
    members = classes.select("node", "members")
    ends = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degrees = ends.join(members, F.col("b") == F.col("node")).select("a", F.col("members").alias("links"))
    if has_hot:
        products = stage(_multiply_tiles(tiles, sets, members, percent), "ngram-products").df
        links = links.unionByName(products.filter("b IS NOT NULL").select("a", "b"))
        degrees = degrees.unionByName(products.filter("b IS NULL").select("a", "links"))
    degrees = degrees.groupBy("a").agg(F.sum("links").alias("links")).withColumnRenamed("a", "node")

    roots = connected_components(links)
    rooted = stage(roots.join(classes.select("node", "first"), "node"), "ngram-roots").df
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component"))
    placed = rooted.join(smallest, "root").select("node", "component")
    placed = classes.join(placed, "node", "left").join(degrees, "node", "left")
    component = F.when(F.col("component").isNull(), F.col("first")).otherwise(F.least("first", "component"))
    placed = placed.select("k1", "k2", "members", component.alias("component"), (F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"))
    # A class may hold a third of all rows, which stay where they are; rows without a set have none.
    placed = stage(placed, "ngram-classes").df
    have = lookup(found.filter("n > 0").select("id", "n", "k1", "k2"), placed, ["k1", "k2"], "members").select("id", "n", "component", "n_links")
    none = found.filter("n = 0").select("id", "n", F.lit(None).cast("long").alias("component"), F.lit(0).cast("long").alias("n_links"))
    return have.unionByName(none)
