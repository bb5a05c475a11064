"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.text import spaced_words, whole
from pairloom.scratch import broadcast_if_small, stage

# Primes above any number of blocks in a shard; a stride prime to the count visits every block once.
STRIDES = (
    1000000007, 1000000009, 1000000021, 1000000033, 1000000087, 1000000093, 1000000097, 1000000103,
    1000000123, 1000000181, 1000000207, 1000000223, 1000000241, 1000000271, 1000000289, 1000000297,
)
# A document taken once, in the sums of ``whole_copies``: parts of 1 / 2^24, with room for 2^38 documents.
ONE = 1 << 24


def apportion(parties: DataFrame, group: Sequence[str], weight: str, seats: str, order: Sequence[str]) -> DataFrame:
    """``parties`` with ``quota``: the seats of each group go one by one to the highest ``weight / (2 k + 1)``.

    A party's ideal share is never further from its quota than its weight's part of all parties'
    rounding, so only the quotients in that belt are ranked: about seven per party, however many
    seats there are. ``order`` settles ties. Parties without weight get nothing.
    """
    whole = Window.partitionBy(*group)
    total = F.sum(weight).over(whole)
    ideal = F.when(total > 0, F.col(weight) * F.col(seats) / total).otherwise(F.lit(0.0))
    slack = F.when(total > 0, F.col(weight) / total * F.count(F.lit(1)).over(whole) * 1.5).otherwise(F.lit(0.0))
    belt = parties.withColumns({"_ideal": ideal, "_slack": slack}).withColumns(
        {
            "_sure": F.greatest(F.lit(0), F.floor(F.col("_ideal") - F.col("_slack") - 1)).cast("long"),
            "_most": F.ceil(F.col("_ideal") + F.col("_slack") + 2).cast("long"),
        }
    )
    belt = belt.withColumn("_open", F.col(seats) - F.sum("_sure").over(whole))
    tried = belt.filter(F.col(weight) > 0).withColumn("_k", F.explode(F.sequence("_sure", "_most")))
    quotient = F.col(weight) / (2 * F.col("_k") + 1)
    ranked = Window.partitionBy(*group).orderBy(quotient.desc(), *order, "_k")
    won = tried.withColumn("_rank", F.row_number().over(ranked)).filter(F.col("_rank") <= F.col("_open"))
    key = [*group, *order]
    extra = won.groupBy(*key).agg(F.count(F.lit(1)).alias("_extra"))
    quota = (F.col("_sure") + F.coalesce(F.col("_extra"), F.lit(0))).alias("quota")
    return belt.join(extra, key, "left").select(*parties.columns, quota)


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """``sizes`` (src, no, size) with ``target``: ``share`` of all sizes by weight, none above ``most`` times its size.

    The weights repeat over the sources by code point, null last. What is over a source's limit is
    shared out again by weight until no source is above, which is one level: each source gets its
    weight times the level or its limit. Ordered by limit over weight, the level is the highest of
    those that stay below the limits that follow. One row per source goes through one window.
    """
    by_name = Window.orderBy("no", "src")
    weighed = sizes.withColumn("index", F.row_number().over(by_name) - 1).withColumn(
        "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("index") % len(weights) + 1).cast("int"))
    )
    limited = weighed.withColumn("limit", F.col("size") * float(most)).withColumn("reach", F.col("limit") / F.col("weight"))
    everything = Window.partitionBy(F.lit(0))
    before = Window.partitionBy(F.lit(0)).orderBy("reach", "index").rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("size").over(everything) * float(share) - F.coalesce(F.sum("limit").over(before), F.lit(0.0))
    open_weight = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    levelled = limited.withColumn("level", left / open_weight)
    best = F.max(F.when(F.col("level") <= F.col("reach"), F.col("level"))).over(everything)
    target = F.when(best.isNull(), F.col("limit")).otherwise(F.least(F.col("limit"), best * F.col("weight")))
    return levelled.select("src", "no", "size", target.alias("target"))


def mix_sources(docs: DataFrame, *, id_col: str = "doc_id", **options) -> DataFrame:
    """``(id_col, size, source_size, target, taken, copies)``, a row for every row of ``docs``.

    Documents are dealt to shards by a seeded hash of id and text; a shard holds about ``shard_words`` words, so it
    stays small when a source does not. A source's documents in a shard are one stream, cut into
    blocks of about ``block_words`` words, equal to within one. Blocks go to sources by highest
    quotients and from a source to its shards in the same way, which gives whole quotas. A shard
    takes every block as often as its quota holds all of them, and the rest by a seeded stride.
    ``taken`` counts a document's words in taken blocks, repeats included; ``copies`` is how often
    the block of its first word is taken, for readers that want whole documents.

    Options are those of ``_taken_blocks``. A null source is a source of its own and comes last. A null text has no words. A document
    without words takes nothing, and a source without words has the target 0. Rows that repeat an
    id are separate documents. Other columns are not read. An empty table gives no rows. The result
    depends only on the rows and the seed.
    """
    rows = _taken_blocks(docs, id_col=id_col, **options)
    return rows.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", "copies")


def whole_copies(docs: DataFrame, *, seed: int = 17, chunk_rows: int = 4096, **options) -> DataFrame:
    """``(id, src, no, copies)``: how often a reader of whole documents takes those of an id in a source; only those taken.

    Each has the share ``taken / size`` of ``mix_sources``, and the shares of a source are rounded
    as running sums from the longest document to the shortest, equal lengths in seeded order. The
    words of a source are then off the taken ones by half of its longest document at most. Rows
    that repeat an id in a source go together. A null source has the empty name and ``no`` set.
    Documents without words are not listed.
    """
    rows = _taken_blocks(docs, seed=seed, **options).filter("size > 0").groupBy("id", "src", "no")
    rows = rows.agg(F.sum("size").alias("size"), F.sum("taken").alias("taken"))
    # Whole numbers, so that sums do not depend on the partitions. Chunks of documents of one length keep each window small.
    part_taken = F.expr(f"taken * {ONE}L div size")
    rows = stage(rows.select("id", "src", "no", "size", part_taken.alias("part_taken")), "mix-shares").df
    same = ["src", "no", "size"]
    lengths = rows.groupBy(*same).agg(F.ceil(F.count(F.lit(1)) / chunk_rows).cast("long").alias("chunks"))
    lengths = stage(lengths.filter("chunks > 1"), "mix-lengths")
    rows = rows.join(broadcast_if_small(lengths.df, lengths.count(), 64), same, "left")
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64(F.lit(seed + 3), "id"), F.coalesce("chunks", F.lit(1).cast("long"))))
    chunks = rows.groupBy(*same, "chunk").agg(F.sum("part_taken").alias("part"))
    ahead = Window.partitionBy("src", "no").orderBy(F.desc("size"), "chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = stage(chunks.select(*same, "chunk", F.coalesce(F.sum("part").over(ahead), F.lit(0)).alias("ahead")), "mix-chunks")
    inside = Window.partitionBy(*same, "chunk").orderBy(F.xxhash64(F.lit(seed + 4), "id"), "id").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("inside", F.coalesce(F.sum("part_taken").over(inside), F.lit(0)))
    placed = placed.join(broadcast_if_small(chunks.df, chunks.count(), 64), [*same, "chunk"])
    placed = placed.withColumn("before", F.col("ahead") + F.col("inside") + F.lit(ONE // 2))
    copies = F.expr(f"(before + part_taken) div {ONE}L - before div {ONE}L").cast("int")
    return placed.select("id", "src", "no", copies.alias("copies")).filter("copies > 0")


def shard_of(seed: int, shards: int) -> Column:
    """The shard of a row by its ``id`` and by ``mark``, a hash of its text, so rows without an id or with one id spread."""
    return F.pmod(F.xxhash64(F.lit(seed), "id", "mark"), F.lit(shards))


def _taken_blocks(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    block_words: int = 64,
    shard_words: int = 1 << 22,
    least_shards: int = 64,
    seed: int = 17,
) -> DataFrame:
    """Rows of ``mix_sources`` with their source (``src``, ``no``)."""
    spark = docs.sparkSession
    source = F.col(source_col).cast("string")
    sized = stage(
        docs.select(
            F.col(id_col).alias("id"),
            F.coalesce(source, F.lit("")).alias("src"),
            source.isNull().alias("no"),
            spaced_words(F.col(text_col)).alias("size"),
            F.xxhash64(whole(F.col(text_col))).alias("mark"),
        ),
        "mix-sizes",
    ).df
    sizes = sized.groupBy("src", "no").agg(F.sum("size").alias("size"))
    targets = stage(source_targets(sizes, weights, share, most), "mix-targets").df
    words = targets.agg(F.sum("size")).first()[0] or 0
    shards = max(least_shards, -(-words // shard_words))
    dealt = sized.withColumn("shard", shard_of(seed, shards)).drop("mark")

    blocks = F.ceil(F.col("words") / block_words).cast("long")
    parts = dealt.groupBy("src", "no", "shard").agg(F.sum("size").alias("words")).withColumn("blocks", blocks)
    parts = stage(parts, "mix-parts").df
    wanted = parts.groupBy("src", "no").agg(F.sum("blocks").alias("blocks")).join(targets, ["src", "no"])
    share_blocks = F.when(F.col("size") > 0, F.col("target") / F.col("size") * F.col("blocks")).otherwise(F.lit(0.0))
    wanted = wanted.withColumn("wanted", share_blocks).withColumn("all", F.lit(1))
    seats = F.round(F.sum("wanted").over(Window.partitionBy("all"))).cast("long")
    by_source = apportion(wanted.withColumn("seats", seats), ["all"], "wanted", "seats", ["no", "src"])
    limit = F.floor(F.col("blocks") * float(most)).cast("long")
    by_source = by_source.select("src", "no", "size", "target", F.least("quota", limit).alias("seats"))
    by_source = stage(by_source, "mix-quotas").df
    spread = parts.join(by_source.select("src", "no", "seats"), ["src", "no"])
    by_part = apportion(spread, ["src", "no"], "blocks", "seats", ["shard"])
    draw = F.xxhash64(F.lit(seed + 1), "src", "no", "shard")
    by_part = by_part.select(
        "src", "no", "shard", "words", "blocks",
        F.expr("CASE WHEN blocks > 0 THEN quota div blocks ELSE 0L END").alias("every"),
        F.expr("CASE WHEN blocks > 0 THEN quota % blocks ELSE 0L END").alias("more"),
        F.element_at(F.array(*map(F.lit, STRIDES)), (F.pmod(draw, F.lit(len(STRIDES))) + 1).cast("int")).cast("long").alias("stride"),
        F.pmod(F.shiftright(draw, 8), F.greatest("blocks", F.lit(1))).alias("shift"),
    )
    by_part = stage(by_part, "mix-shards").df

    stream = Window.partitionBy("src", "no", "shard").orderBy(F.xxhash64(F.lit(seed + 2), "id"), "id", "size")
    before = stream.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = dealt.withColumn("start", F.sum("size").over(before) - F.col("size"))
    joined = placed.join(by_part, ["src", "no", "shard"]).join(by_source.drop("seats").withColumnRenamed("size", "source_size"), ["src", "no"])
    joined = joined.withColumns(
        {
            "first": F.expr("CASE WHEN size > 0 THEN ((start + 1) * blocks - 1) div words END"),
            "last": F.expr("CASE WHEN size > 0 THEN ((start + size) * blocks - 1) div words END"),
        }
    )
    times = "every + IF(pmod(stride * {k} + shift, blocks) < more, 1L, 0L)"
    inside = "least(start + size, ((k + 1) * words) div blocks) - greatest(start, (k * words) div blocks)"
    taken = F.expr(f"aggregate(sequence(first, last), 0L, (taken, k) -> taken + ({inside}) * ({times.format(k='k')}))")
    return joined.select(
        "id",
        "src",
        "no",
        "size",
        "source_size",
        "target",
        F.coalesce(taken, F.lit(0)).alias("taken"),
        F.coalesce(F.expr(times.format(k="first")), F.lit(0)).cast("int").alias("copies"),
    )
