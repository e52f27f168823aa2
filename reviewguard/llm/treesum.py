"""Sums of long vectors over many tasks, in a tree."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Vectors travel in slices of so many numbers, so that a sum never holds more than a few slices.
SLICE = 1 << 16

#: Vectors that one branch of the tree adds.
FAN = 256


def slices(part: int, values: np.ndarray) -> pa.RecordBatch:
    """One task's vector as rows (part int, slice int, numbers binary)."""
    cut = [values[i:i + SLICE] for i in range(0, len(values), SLICE)]
    return pa.RecordBatch.from_arrays([pa.array([part] * len(cut), pa.int32()), pa.array(range(len(cut)), pa.int32()), pa.array([c.tobytes() for c in cut], pa.binary())],
                                      ["part", "slice", "numbers"])


SLICES = "part int, slice int, numbers binary"


def tree_sum(parts: DataFrame, kind: type) -> np.ndarray:
    """The sum of all tasks' vectors, through branches of FAN tasks each; empty without tasks.

    The result is one vector on the driver: use it for vectors whose length doesn't grow with the data.
    Parts are added in the order of their numbers, so float sums don't depend on arrival."""
    def add(table: pa.Table) -> pa.Table:
        table = table.sort_by("part")
        total = 0
        for x in table.column("numbers"):
            total = total + np.frombuffer(x.as_buffer(), kind)
        return pa.table({"part": pa.array([table.column("part")[0].as_py()], pa.int32()), "slice": table.column("slice").slice(0, 1), "numbers": pa.array([total.tobytes()], pa.binary())})

    branch = F.floor(F.col("part") / FAN).cast("int")
    inner = parts.groupBy(branch.alias("branch"), "slice").applyInArrow(add, SLICES)
    rows = inner.groupBy("slice").applyInArrow(add, SLICES).orderBy("slice").collect()
    return np.concatenate([np.frombuffer(r.numbers, kind) for r in rows]) if rows else np.zeros(0, kind)
