"""Arrays that tasks have summed, added up by Spark in two levels."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Groups of tasks whose arrays are added first: the last task then gets as many rows a slice at most.
SPREAD = 256


def added(parts: DataFrame, kind: type, tasks: int | None = None) -> dict[int, np.ndarray]:
    """The sum of each ``slice`` (int) over all rows (``slice``, ``sums``: an array of ``kind`` as bytes).

    ``parts`` must come straight from the tasks that made them. Slices are few and of fixed size, so the sums are bounded.
    Where ``tasks`` says that no more than SPREAD made them, one level does: many sums after one another otherwise fill
    the driver with threads, as Spark starts one for a shuffle and keeps it for a minute.
    """
    def add(key, found):
        whole = sum(np.frombuffer(x.as_buffer(), kind) for x in found.column("sums"))
        return pa.table({"slice": found.column("slice").slice(0, 1), "sums": pa.array([whole.tobytes()], pa.binary())})

    fields = "slice int, sums binary"
    if tasks is None or tasks > SPREAD:
        parts = parts.withColumn("spread", F.spark_partition_id() % SPREAD).groupBy("slice", "spread").applyInArrow(add, fields)
    return {r.slice: np.frombuffer(r.sums, kind) for r in parts.groupBy("slice").applyInArrow(add, fields).collect()}
