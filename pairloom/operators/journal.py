"""States of a long computation, kept in a folder that outlives the application."""

from __future__ import annotations

import io

import numpy as np
from pyspark.sql import SparkSession

from pairloom.scratch import delete, folders

# A state is written in rows of so many bytes.
_ROW_BYTES = 4 * 1024 * 1024


class Journal:
    """Named arrays of the last finished step, as a small table of its own for each step.

    A step's table counts once Spark has marked it as finished, and only then the one before it is removed, so
    there is always a whole one after the first.
    """

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def _finished(self) -> list[str]:
        return [path for path in folders(self.spark, self.folder) if path.rsplit("/", 1)[-1].startswith("state-")]

    def last(self) -> dict[str, np.ndarray] | None:
        """The newest whole state, None when there is none."""
        finished = self._finished()
        if not finished:
            return None
        rows = self.spark.read.schema("part int, bytes binary").parquet(finished[-1]).collect()
        whole = b"".join(bytes(row["bytes"]) for row in sorted(rows, key=lambda row: row["part"]))
        with np.load(io.BytesIO(whole)) as arrays:
            return {name: arrays[name] for name in arrays.files}

    def write(self, state: dict[str, np.ndarray]) -> None:
        old = self._finished()
        number = int(old[-1].rsplit("-", 1)[-1]) + 1 if old else 0
        buffer = io.BytesIO()
        np.savez(buffer, **state)
        whole = buffer.getvalue()
        rows = [(k, bytearray(whole[at : at + _ROW_BYTES])) for k, at in enumerate(range(0, len(whole), _ROW_BYTES))]
        table = self.spark.createDataFrame(rows, "part int, bytes binary").coalesce(1)
        table.write.mode("overwrite").parquet(f"{self.folder}/state-{number:08d}")
        for path in old:
            delete(self.spark, path)
