"""Sharding: minimax contiguous partition of ordered atomic groups."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm.lookup import lookup
from pairloom.llm.positions import with_running_sums
from pairloom.llm.text import whole
from pairloom.scratch import stage


class _Cuts:
    """Ends of groups on a line, known exactly in some stretches and elsewhere to within a bucket.

    ``low`` and ``high`` are the smallest and largest end in each bucket of the given width that
    has any.
    """

    def __init__(self, width: int, buckets: np.ndarray, low: np.ndarray, high: np.ndarray):
        self.width, self.buckets, self.low, self.high = width, buckets, low, high
        self.exact = np.empty(0, np.int64)
        self.known: set[int] = set()
        # Stretches whose ends were asked for and are not known.
        self.open: set[int] = set()

    def before(self, at: int, optimistic: bool) -> int:
        """The largest end up to ``at``; in a bucket that is not known, a bound from above or below."""
        slot = int(np.searchsorted(self.buckets, at // self.width, side="right")) - 1
        if slot < 0:
            return 0
        if at >= self.high[slot]:
            return int(self.high[slot])
        if at < self.low[slot]:
            return int(self.high[slot - 1]) if slot else 0
        if int(self.buckets[slot]) in self.known:
            return int(self.exact[np.searchsorted(self.exact, at, side="right") - 1])
        return at if optimistic else int(self.low[slot])

    def nearest(self, at: int, up: bool) -> int:
        """The largest end up to ``at``, or the smallest from ``at``; asks for the stretch when it is not known."""
        slot = int(np.searchsorted(self.buckets, at // self.width, side="right")) - 1
        if slot >= 0 and self.low[slot] <= at <= self.high[slot]:
            bucket = int(self.buckets[slot])
            if at in (self.low[slot], self.high[slot]):
                return at
            if bucket in self.known:
                place = np.searchsorted(self.exact, at, side="left" if up else "right")
                return int(self.exact[place if up else place - 1])
            self.open.add(bucket)
            return int(self.high[slot] if up else self.low[slot])
        if slot >= 0 and at > self.high[slot]:
            return (int(self.low[slot + 1]) if slot + 1 < len(self.low) else int(self.high[-1])) if up else int(self.high[slot])
        if up:
            return int(self.low[max(0, slot)])
        return int(self.high[slot - 1]) if slot > 0 else 0

    @staticmethod
    def goal(start: int, shards: int, total: int, large: list[tuple[int, int]]) -> float:
        """Where a shard that begins at ``start`` should end, when ``shards`` are left.

        Groups above an even share of what is left get a shard each, the others share the rest, and the
        stretch up to the next such group is divided evenly. ``large`` are (start, size) of the largest groups, largest first.
        """
        rest, left, alone = total - start, shards, total
        for begin, size in large:
            if begin >= start and left > 1 and size > rest / left:
                rest, left, alone = rest - size, left - 1, min(alone, begin)
        share = rest / left
        return start + (alone - start) / max(1, round((alone - start) / share)) if alone > start and share else start + share

    def even(self, capacity: int, shards: int, total: int, last: list[int], large: list[tuple[int, int]]) -> list[int]:
        """Cuts with no shard above ``capacity``, each as near to an even share of the rest as the groups allow.

        A cut lies where the rest still fits, and leaves a group for every later shard while there are enough;
        ``last`` are the ends of the last groups, the last of all first.
        """
        self.open = set()
        # From behind: where the rest must begin at the earliest.
        least = [total]
        for _ in range(shards - 1):
            least.append(self.nearest(least[-1] - capacity, up=True) if least[-1] > capacity else 0)
        least.reverse()
        cuts = [0]
        for k in range(1, shards):
            start = cuts[-1]
            goal = self.goal(start, shards - k + 1, total, large)
            most = self.nearest(min(start + capacity, total), up=False)
            if len(last) > shards - k:
                most = min(most, max(last[shards - k], start))
            first = max(least[k - 1], self.nearest(start + 1, up=True)) if start < total else total
            below, above = self.nearest(int(goal), up=False), self.nearest(-int(-goal // 1), up=True)
            cut = below if goal - below <= above - goal else above
            cuts.append(max(min(cut, most), min(first, total)))
        return [*cuts, total]

    def walk(self, capacity: int, shards: int, optimistic: bool) -> list[int]:
        """Greedy cuts: each shard takes all groups that fit."""
        cuts = [0]
        for _ in range(shards):
            cuts.append(self.before(cuts[-1] + capacity, optimistic))
        return cuts

    def smallest(self, low: int, high: int, shards: int, total: int, optimistic: bool) -> int:
        """The smallest capacity whose walk reaches the end."""
        while low < high:
            middle = (low + high) // 2
            if self.walk(middle, shards, optimistic)[-1] >= total:
                high = middle
            else:
                low = middle + 1
        return low


def minimax_cuts(groups: DataFrame, shards: int, buckets: int = 1 << 17) -> list[int]:
    """Cuts of a line of groups (``bytes``, ``bytes_before``) into ``shards`` runs with the smallest possible maximum.

    A capacity is feasible when greedy filling gets by with ``shards`` runs; the smallest feasible
    one is found by binary search. The driver sees the smallest and largest end of at most
    ``buckets`` equal stretches of the line, whatever the number of groups. Where an end is known
    to within a stretch only, walks with the bound from above and from below enclose the answer;
    then the ends of the few stretches that hold a cut for a capacity in between are read, and the
    search ends on those. Exact, not an approximation.

    Within that capacity the cuts are as even as the groups allow: greedy filling up to it would leave later
    shards empty when one group is large. See :meth:`_Cuts.even`.
    """
    facts = groups.agg(F.sum("bytes").alias("total"), F.max("bytes").alias("largest")).first()
    total, largest = facts["total"] or 0, facts["largest"] or 0
    if not total:
        return [0] * (shards + 1)
    width = max(1, -(-total // buckets))
    ends = groups.select((F.col("bytes_before") + F.col("bytes")).alias("end")).withColumn("bucket", F.expr(f"end div {width}L"))
    summary = ends.groupBy("bucket").agg(F.min("end").alias("low"), F.max("end").alias("high")).toPandas().sort_values("bucket")
    line = _Cuts(width, *[summary[name].to_numpy(np.int64) for name in ("bucket", "low", "high")])
    low, high = max(largest, -(-total // shards)), total

    def read(unknown: set[int]) -> None:
        wanted = ends.join(F.broadcast(groups.sparkSession.createDataFrame([(b,) for b in unknown], "bucket long")), "bucket")
        more = wanted.select("end").toPandas()["end"].to_numpy(np.int64)
        line.exact = np.unique(np.concatenate([line.exact, more]))
        line.known |= unknown

    while True:
        low = line.smallest(low, high, shards, total, optimistic=True)
        high = line.smallest(low, high, shards, total, optimistic=False)
        nearest, furthest = line.walk(low, shards, False), line.walk(high, shards, True)
        unknown = set()
        for start, end in zip(nearest, furthest, strict=True):
            first, last = np.searchsorted(line.buckets, [start // width, end // width + 1])
            unknown.update(int(b) for b in line.buckets[first:last])
        unknown -= line.known
        if not unknown:
            break
        read(unknown)
    # As many rows as there are shards, each.
    large = [(row["bytes_before"], row["bytes"]) for row in groups.orderBy(F.col("bytes").desc()).limit(shards).collect()]
    last = [row["end"] for row in ends.select("end").orderBy(F.col("end").desc()).limit(shards).collect()]
    capacity = line.smallest(low, high, shards, total, optimistic=False)
    while True:
        cuts = line.even(capacity, shards, total, last, large)
        if not line.open - line.known:
            return cuts
        read(line.open - line.known)


def shard_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shards: int = 16, buckets: int = 1 << 17) -> DataFrame:
    """``(id_col, size, text_crc32, law, shard, slot, grown_shard)``, a row for every row of ``docs``.

    The law is ``bytes``: documents with equal texts form an atomic group, groups stand in the
    order of their smallest id (then digest), and the row of groups is cut into ``shards``
    contiguous runs whose largest number of bytes is the smallest possible. A document has the
    UTF-8 bytes of its text plus 1. Slots number a shard's documents from 0 in group order and then
    by id. A null text counts as empty and is equal to other empty texts; a null id comes first.
    Rows that repeat an id and text get slots of their own. When one group is larger than an even
    share, its shard is as large as the group and the others share the rest evenly; none is empty unless
    there are fewer groups than shards. Very long texts count whole. Other columns are not read. An
    empty table gives no rows.
    """
    text = whole(F.col(text_col))
    rows = stage(
        docs.select(
            F.col(id_col).alias("id"),
            (F.octet_length(text) + 1).cast("long").alias("size"),
            F.crc32(text.cast("binary")).alias("crc"),
            F.unhex(F.sha2(text, 256)).alias("digest"),
        ),
        "shard-rows",
    ).df
    groups = rows.groupBy("digest").agg(F.min("id").alias("leader"), F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("members"))
    line = stage(with_running_sums(groups, ["leader", "digest"], ["bytes", "members"]), "shard-groups").df
    cuts = minimax_cuts(line, shards, buckets)
    # A group lies after every cut that its start has reached, unless the shard before it was the last to hold any.
    shard = sum((F.col("bytes_before") >= F.lit(cut)).cast("int") for cut in cuts[1:-1]) if shards > 1 else F.lit(0)
    dealt = line.withColumn("shard", F.least(shard, F.lit(shards - 1)))
    starts = dealt.groupBy("shard").agg(F.min("members_before").alias("shard_start"))
    # At most one row per shard.
    dealt = dealt.join(F.broadcast(starts), "shard").select("digest", "leader", "shard", "members", "members_before", "shard_start")
    # A group may hold a third of all rows, which stay where they are.
    placed = lookup(rows, stage(dealt, "shard-dealt").df, ["digest"], "members", row_bytes=96)
    ordered = with_running_sums(placed.select("id", "size", "crc", "leader", "digest", "shard", "shard_start"), ["leader", "digest", "id"], [])
    return ordered.select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("position") - F.col("shard_start")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
