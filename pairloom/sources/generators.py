"""Random event and matrix tables for trials. Values depend on the seed only, not on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Parameters of the trial data.
EVENTS_PER_PATIENT = 99
PATIENTS = 99
DAY_ADVANCE = 0.15
FIRST_WORD = 1000
LAST_WORD = 1_000_000
CELL_KEPT = 0.15

_STEPS = 1 << 30


def _uniform(seed: int, *keys: Column) -> Column:
    """Uniform number in [0, 1) that is a function of the seed and the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(_STEPS)) / F.lit(float(_STEPS))


def generate_events(
    spark: SparkSession,
    patients: int | DataFrame = PATIENTS,
    events_per_patient: int = EVENTS_PER_PATIENT,
    seed: int = 100,
) -> DataFrame:
    """Events whose day starts at 1 and advances now and then, with uniform words.

    ``patients`` is a number, or a one-column table of patient ids.
    """
    ids = spark.range(1, patients + 1) if isinstance(patients, int) else patients
    ids = ids.toDF("PatientOrder").select(F.col("PatientOrder").cast("bigint"))
    steps = ids.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(events_per_patient))))
    advance = (_uniform(seed, F.lit("day"), F.col("PatientOrder"), F.col("step")) < DAY_ADVANCE).cast("int")
    so_far = Window.partitionBy("PatientOrder").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    word = _uniform(seed, F.lit("word"), F.col("PatientOrder"), F.col("step")) * (LAST_WORD - FIRST_WORD + 1)
    return steps.select(
        "PatientOrder",
        (F.sum(advance).over(so_far) + 1).cast("int").alias("NumDays"),
        (F.floor(word) + FIRST_WORD).cast("int").alias("WordIndex"),
        F.lit(1).alias("window"),
    )


def generate_matrix(spark: SparkSession, size: int, seed: int = 42) -> DataFrame:
    """Cells ``1 <= i, j < size``, each kept by chance, with ``count = i + j``."""
    side = max(size - 1, 0)
    cells = spark.range(side * side).select(
        F.expr(f"id div {max(side, 1)} + 1").cast("int").alias("i"),
        (F.col("id") % max(side, 1) + 1).cast("int").alias("j"),
    )
    kept = cells.filter(_uniform(seed, F.col("i"), F.col("j")) < CELL_KEPT)
    return kept.select("i", "j", (F.col("i") + F.col("j")).cast("bigint").alias("count"))
