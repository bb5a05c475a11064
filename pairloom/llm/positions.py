"""Positions in a total order without a window over all rows."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pairloom.scratch import stage


def with_running_sums(df: DataFrame, order: Sequence[str], sums: Sequence[str]) -> DataFrame:
    """``df`` with ``position`` (from 0) in ``order`` and, for each long column in ``sums``, ``<name>_before``.

    Rows are range partitioned and sorted in parallel and numbered inside each partition; the
    partitions' own totals, one row each, are then added up. The numbered table is written first,
    so a task that runs again cannot see other partition bounds. Nulls come first.
    """
    names = ["position", *[f"{name}_before" for name in sums]]
    fields = [*df.schema.fields, T.StructField("part", T.IntegerType()), *[T.StructField(n, T.LongType()) for n in names]]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        at, totals = 0, dict.fromkeys(sums, 0)
        for batch in batches:
            rows = batch.num_rows
            columns = [*batch.columns, pa.array(np.full(rows, part, np.int32)), pa.array(np.arange(at, at + rows))]
            at += rows
            for name in sums:
                values = batch.column(name).to_numpy(zero_copy_only=False).astype(np.int64)
                running = np.cumsum(values) + totals[name]
                columns.append(pa.array(running - values))
                totals[name] = int(running[-1]) if rows else totals[name]
            yield pa.RecordBatch.from_arrays(columns, names=[field.name for field in fields])

    ordered = df.repartitionByRange(*order).sortWithinPartitions(*order)
    numbered = stage(ordered.mapInArrow(number, T.StructType(fields)), "positions").df
    ends = [F.count(F.lit(1)).alias("position"), *[F.sum(name).alias(f"{name}_before") for name in sums]]
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = numbered.groupBy("part").agg(*ends)
    offsets = offsets.select("part", *[F.coalesce(F.sum(n).over(before), F.lit(0)).alias(f"{n}_offset") for n in names])
    # One row per partition: bounded by the number of shuffle partitions.
    joined = numbered.join(F.broadcast(offsets), "part")
    return joined.select(*df.columns, *[(F.col(n) + F.col(f"{n}_offset")).alias(n) for n in names])
