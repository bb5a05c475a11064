"""Counting the pairs that new events add to those already counted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.functions import band_start, high, low
from pairloom.operators.matrix import combine
from pairloom.operators.pairs import MAX_GROUP_ROWS, count_pairs, daily_counts
from pairloom.scratch import broadcast_if_small, stage


def added_pairs(
    known: DataFrame,
    events: DataFrame,
    window_days: int = 30,
    patient: str = "PatientOrder",
    day: str = "NumDays",
    word: str = "WordIndex",
    scope: Sequence[str] = (),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """``((i, j, count), daily)``: what ``events`` add to the counts of earlier events, and the daily counts to be kept for later.

    ``known`` has the daily counts ``(scope, patient, day, word, n)`` of all earlier events; rows may repeat a key, as their
    copies add up. New events meet each other by :func:`pairloom.operators.pairs.cooccurrence`, and known ones by a delta
    join: known rows stay in their band of ``window_days + 1`` days, a new row is sent to its own band and both
    neighbours, so each (new, known) pair within the window meets once and known rows never meet each other. Known rows
    in bands without a new event are left out before the join, and bands with many rows are cut into a
    rectangle of keys of about ``max_group_rows`` rows a side.

    Counting all events at once gives the sum of the earlier counts and these.
    """
    inside, across, fresh = added_parts(known, events, window_days, patient, day, word, scope, max_group_rows)
    return combine(inside, across), fresh


def added_parts(
    known: DataFrame,
    events: DataFrame,
    window_days: int = 30,
    patient: str = "PatientOrder",
    day: str = "NumDays",
    word: str = "WordIndex",
    scope: Sequence[str] = (),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The two summands of :func:`added_pairs`, pairs of new events and pairs of a new and a known one, and the daily counts.

    A caller who adds them to a matrix anyway saves a shuffle.
    """
    if window_days < 0:
        raise ValueError("window_days must not be negative")
    fresh = stage(daily_counts(events, patient, day, word, scope), "daily").df
    owner, width = [*scope, "patient"], window_days + 1
    key = [*owner, "band"]
    own = band_start(F.col("day"), width)
    sent = fresh.withColumn("band", F.explode(F.array(own - width, own, own + width)))
    wanted = sent.groupBy(*key).agg(F.count(F.lit(1)).alias("new_rows"))
    # One row for each band that is touched; a busy patient has many bands, so no key is hot.
    near = known.select(*owner, "day", "word", "n").withColumn("band", own)
    sizes = near.groupBy(*key).agg(F.count(F.lit(1)).alias("old_rows")).join(wanted, key)
    cut = {side: F.ceil(F.col(f"{side}_rows") / max_group_rows).cast("int") for side in ("new", "old")}
    sizes = stage(sizes.select(*key, *[c.alias(f"{side}_parts") for side, c in cut.items()]), "bands")
    touched = broadcast_if_small(sizes.df, sizes.count(), 48 + 32 * len(owner))
    large = sizes.df.filter((F.col("new_parts") > 1) | (F.col("old_parts") > 1)).count()
    dealt, keys = {}, key
    for side, rows in (("new", sent), ("old", near)):
        if not large:
            # No band is cut, so its rows meet where they met the list of touched bands, without a second shuffle.
            dealt[side] = rows.join(touched.select(*key), key, "left_semi")
            continue
        other = "old" if side == "new" else "new"
        part = F.pmod(F.xxhash64("day", "word"), F.col(f"{side}_parts")).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(f"{other}_parts") - 1))
        dealt[side] = rows.join(touched, key).withColumn(f"{side}_part", part).withColumn(f"{other}_part", every).drop("new_parts", "old_parts")
        keys = [*key, "new_part", "old_part"]
    a, b = dealt["new"].alias("a"), dealt["old"].alias("b")
    condition = F.abs(F.col("a.day") - F.col("b.day")) <= window_days
    for name in keys:
        condition = condition & (F.col(f"a.{name}") == F.col(f"b.{name}"))
    # Merge join: a broadcast would follow the few bytes read, not the many pairs made.
    met = a.join(b.hint("merge"), condition)
    cell = low(F.col("a.word"), F.col("b.word")).alias("i"), high(F.col("a.word"), F.col("b.word")).alias("j")
    across = met.select(*cell, (F.col("a.n") * F.col("b.n")).alias("weight")).groupBy("i", "j").agg(F.sum("weight").alias("count"))
    return count_pairs(fresh, window_days, scope, max_group_rows), across, fresh
