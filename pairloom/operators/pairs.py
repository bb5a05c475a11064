"""Counting word pairs that fall inside a day window of the same patient."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.functions import band_start, high, low, required
from pairloom.scratch import Staged, broadcast_if_small, stage

# Most distinct (day, word) rows that one join key may hold on either side.
MAX_GROUP_ROWS = 4096
# Bands up to this size need no look at the pairs they make.
SPARSE_BAND_ROWS = 16
# Work of one task of a pair join.
TASK_PAIRS = 20_000_000
TASK_ROWS = 1_000_000


def daily_counts(
    events: DataFrame,
    patient: str = "PatientOrder",
    day: str = "NumDays",
    word: str = "WordIndex",
    scope: Sequence[str] = (),
) -> DataFrame:
    """Copies ``n`` of each (scope, patient, day, word).

    The grouping key includes day and word, so a patient that holds much of the table is still
    spread over all tasks, and copies are added up before the shuffle.
    """
    return events.groupBy(
        *[required(F.col(column), column).alias(column) for column in scope],
        required(F.col(patient), patient).cast("bigint").alias("patient"),
        required(F.col(day), day).cast("bigint").alias("day"),
        required(F.col(word), word).cast("int").alias("word"),
    ).agg(F.count(F.lit(1)).alias("n"))


def cooccurrence(
    events: DataFrame,
    window_days: int = 30,
    patient: str = "PatientOrder",
    day: str = "NumDays",
    word: str = "WordIndex",
    scope: Sequence[str] = (),
    max_group_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Upper triangular count matrix ``(i, j, count)`` of the unordered event pairs of a patient
    at most ``window_days`` apart (inclusive).

    Two events of the same word count on the diagonal; ``n`` copies of one event give
    ``n (n - 1) / 2``. Columns in ``scope`` must be equal too.

    Patients are counted in one of two ways with the same result. Most have few events in any
    window, see :func:`_banded_pairs`. Those with more than ``max_group_rows`` distinct (day, word)
    rows around a band of days are counted against sums over the window, see :func:`_summed_pairs`.
    In both, joined rows go straight into the partial sum per cell; pairs are not shuffled.
    """
    if window_days < 0:
        raise ValueError("window_days must not be negative")
    counts = stage(daily_counts(events, patient, day, word, scope), "daily").df
    return count_pairs(counts, window_days, scope, max_group_rows)


def count_pairs(counts: DataFrame, window_days: int = 30, scope: Sequence[str] = (), max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """:func:`cooccurrence` of events that are there as a stored table of :func:`daily_counts`."""
    if window_days < 0:
        raise ValueError("window_days must not be negative")
    owner = [*scope, "patient"]
    bands = _dense_bands(counts, owner, window_days, max_group_rows)
    facts = bands.df.agg(F.sum(F.col("rows") * F.col("rows")).alias("squares"), F.max("rows").alias("most")).first()
    parts = _parts(2 * (facts["squares"] or 0), counts.count())
    busy, n_busy = None, 0
    if (facts["most"] or 0) * 2 > max_group_rows:
        busy = _busy_patients(bands.df, owner, window_days, max_group_rows)
        n_busy = busy.count()
    if n_busy == 0:
        return _cell_sums(_banded_pairs(counts, owner, window_days, parts))
    patients = broadcast_if_small(busy.df, n_busy, 32 + 32 * len(owner))
    rest = counts.join(patients, owner, "left_anti")
    many = counts.join(patients, owner, "left_semi")
    # One sum over both: summing each side first would build three tables of all cells where one will do.
    both = _banded_pairs(rest, owner, window_days, parts).unionByName(_summed_pairs(many, owner, window_days, max_group_rows))
    return _cell_sums(both)


def _banded_pairs(counts: DataFrame, owner: list[str], window: int, parts: int) -> DataFrame:
    """Weighted pairs ``(i, j, weight)`` by a range join of the events with each other.

    The day axis is cut into bands of ``window + 1`` days. A later event keeps its own band, an
    earlier one is sent to its own and the next, so the range join becomes an equi-join that meets
    every pair once.
    """
    width = window + 1
    own_band = band_start(F.col("day"), width)
    keys = [*owner, "band"]
    a = _spread(counts.withColumn("band", F.explode(F.array(own_band, own_band + width))), keys, parts).alias("a")
    b = _spread(counts.withColumn("band", own_band), keys, parts).alias("b")
    n, days_apart = F.col("a.n"), F.col("b.day") - F.col("a.day")
    itself = (days_apart == 0) & (F.col("a.word") == F.col("b.word"))
    once = (days_apart > 0) | (F.col("a.word") < F.col("b.word")) | (itself & (n > 1))
    condition = days_apart.between(0, window) & once
    for key in keys:
        condition = condition & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    weight = F.when(itself, _copies(n)).otherwise(n * F.col("b.n"))
    # Merge join on both: a broadcast would follow the few bytes read, not the many pairs made.
    return a.join(b.hint("merge"), condition).select(*_cell(), weight.alias("weight"))


def _dense_bands(counts: DataFrame, owner: list[str], window: int, limit: int) -> Staged:
    """Rows per patient and band, for the bands with enough rows to matter."""
    band = band_start(F.col("day"), window + 1).alias("band")
    bands = counts.groupBy(*owner, band).agg(F.count(F.lit(1)).alias("rows"))
    return stage(bands.filter((F.col("rows") > SPARSE_BAND_ROWS) | (F.col("rows") * 2 > limit)), "bands")


def _busy_patients(bands: DataFrame, owner: list[str], window: int, limit: int) -> Staged:
    """Patients with more than ``limit`` rows in some band and the one before it.

    Two neighbours can pass the limit only if one of them passes half of it, so the counts are cut
    there before the neighbours meet.
    """
    meets = F.explode(F.array(F.col("band"), F.col("band") + window + 1))
    both = bands.filter(F.col("rows") * 2 > limit).withColumn("band", meets)
    around = both.groupBy(*owner, "band").agg(F.sum("rows").alias("rows"))
    return stage(around.filter(F.col("rows") > limit).select(*owner).distinct(), "busy-patients")


def _summed_pairs(counts: DataFrame, owner: list[str], window: int, limit: int) -> DataFrame:
    """Weighted pairs of patients with many events: each event meets each word in its window once.

    For every day of the patient with a word ahead in the window, ``later`` is the number of that
    word's events after the day and ``same`` the number on it. A word that comes back every day is
    then one partner of an event, not one per day. Only days that have events are looked at, so
    there are never more sums than pairs. The sums run per patient and word, the join per patient
    and day, and days above ``limit`` words are split: no task holds a whole patient.
    """
    back = Window.partitionBy(*owner).orderBy("day").rangeBetween(-window, 0)
    # At most window + 1 days each.
    days = counts.select(*owner, "day").distinct().withColumn("reach", F.collect_list("day").over(back))
    reach = stage(days, "days")
    reach_of = broadcast_if_small(reach.df, reach.count(), 64 + 32 * len(owner) + 8 * (window + 1))

    by_word = Window.partitionBy(*owner, "word").orderBy("day")
    rows = counts.join(reach_of, [*owner, "day"]).withColumn("previous", F.lag("day").over(by_word))
    unseen = F.filter("reach", lambda at: F.col("previous").isNull() | (at > F.col("previous")))
    ahead = rows.select(*owner, "word", "day", "n", F.explode(unseen).alias("at"))
    ahead = ahead.withColumn("same", F.when(F.col("at") == F.col("day"), F.col("n")))
    later = F.sum("same").over(Window.partitionBy(*owner, "word").orderBy("at").rangeBetween(1, max(window, 1)))
    sums = ahead.select(
        *owner,
        F.col("at").alias("day"),
        "word",
        F.coalesce("same", F.lit(0)).alias("same"),
        (F.coalesce(later, F.lit(0)) if window else F.lit(0)).cast("bigint").alias("later"),
    )
    sums = stage(sums, "window-sums").df
    left, right, keys, parts = _split_days(counts, sums, [*owner, "day"], limit)

    a, b = _spread(left, keys, parts).alias("a"), _spread(right, keys, parts).alias("b")
    n, this, other = F.col("a.n"), F.col("a.word"), F.col("b.word")
    same_day = F.when(this < other, n * F.col("b.same")).when(this == other, _copies(n)).otherwise(0)
    weight = n * F.col("b.later") + same_day
    condition = weight > 0
    for key in keys:
        condition = condition & (F.col(f"a.{key}") == F.col(f"b.{key}"))
    return a.join(b.hint("merge"), condition).select(*_cell(), weight.alias("weight"))


def _split_days(
    left: DataFrame, right: DataFrame, group: list[str], limit: int
) -> tuple[DataFrame, DataFrame, list[str], int]:
    """Cut the days with many words into ``parts x parts`` join keys of about ``limit`` rows a side.

    A row hashes to one part of its own side and is repeated for every part of the other, so each
    two rows still meet in exactly one key. The table of large days decides only how the work is
    cut, never what is counted.
    """
    n_rows, n_own = F.count(F.lit(1)).alias("rows"), F.count_if(F.col("same") > 0).alias("own")
    sizes = stage(right.groupBy(*group).agg(n_rows, n_own), "days-sizes").df
    facts = sizes.agg(
        F.sum(F.col("rows") * F.col("own")).alias("pairs"),
        F.sum("rows").alias("rows"),
        F.count_if(F.col("rows") > limit).alias("large"),
    ).first()
    tasks = _parts(facts["pairs"] or 0, facts["rows"] or 0)
    n_large = facts["large"]
    if n_large == 0:
        return left, right, group, tasks
    cuts = F.expr(f"(rows + {limit - 1}) div {limit}").alias("parts")
    large = sizes.filter(F.col("rows") > limit).select(*group, cuts)
    parts_of = broadcast_if_small(large, n_large, 32 + 32 * len(group))
    parts = F.coalesce(F.col("parts"), F.lit(1))
    own = F.pmod(F.xxhash64("word"), parts).cast("int")
    every = F.explode(F.sequence(F.lit(0), parts.cast("int") - 1))
    left = left.join(parts_of, group, "left").withColumn("row_part", own).withColumn("col_part", every)
    right = right.join(parts_of, group, "left").withColumn("col_part", own).withColumn("row_part", every)
    return left, right, [*group, "row_part", "col_part"], tasks


def _parts(pairs: int, rows: int) -> int:
    """Tasks for a join that multiplies rows: by the pairs it makes, not only by the bytes it reads."""
    return max(1, -(-pairs // TASK_PAIRS), -(-rows // TASK_ROWS))


def _spread(rows: DataFrame, keys: list[str], parts: int) -> DataFrame:
    """Partition by the join keys. One part leaves the choice to adaptive execution."""
    return rows.repartition(parts, *keys) if parts > 1 else rows


def _cell_sums(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("i", "j").agg(F.sum("weight").alias("count"))


def _copies(n: Column) -> Column:
    """Pairs among ``n`` copies of one event."""
    return F.shiftright(n * (n - 1), 1)


def _cell() -> list[Column]:
    a, b = F.col("a.word"), F.col("b.word")
    return [low(a, b).alias("i"), high(a, b).alias("j")]
