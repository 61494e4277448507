"""Running totals over a whole frame without moving it into one task."""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docketry.sources.workspace import checkpointed, ship_package


def _before(values: pa.Array, start):
    """For each value the sum of `start` and all values before it, and the sum behind the last one; nulls add nothing."""
    if pa.types.is_decimal(values.type):
        sums = list(accumulate((v or Decimal(0) for v in values.to_pylist()), initial=Decimal(start)))
        return pa.array(sums[:-1], pa.decimal128(38, values.type.scale)), sums[-1]
    floating = pa.types.is_floating(values.type)
    plain = values.cast(pa.float64() if floating else pa.int64()).fill_null(0).to_numpy(zero_copy_only=False)
    sums = np.concatenate([[start], start + np.cumsum(plain)])
    return pa.array(sums[:-1], pa.float64() if floating else pa.int64()), sums[-1].item()


def running_totals(frame: DataFrame, order: list[str], totals: dict[str, str]) -> DataFrame:
    """For each `value: out` add `out`: the sum of `value` over all rows before this one in `order`.

    `order` must tell the rows apart. The frame is sorted into ranges, which a checkpoint fixes: the only shuffle. Each range is
    then summed where it is, from the totals of the ranges before it, which are one row per partition
    of the sort, few whatever the frame holds. Sums of whole numbers are longs, others as wide as their type allows.
    """
    ranges = checkpointed(frame.orderBy(*order))
    values, names = list(totals), list(totals.values())
    sums = ranges.groupBy(F.spark_partition_id().alias("_range")).agg(*[F.sum(v).alias(o) for v, o in totals.items()])
    starts: dict[int, list] = {}
    running = [0] * len(values)
    for row in sorted(sums.collect(), key=lambda r: r["_range"]):
        starts[row["_range"]] = running
        running = [a + (row[o] or 0) for a, o in zip(running, names, strict=True)]
    ship_package(frame.sparkSession)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        now = list(starts.get(TaskContext.get().partitionId(), [0] * len(values)))
        for batch in batches:
            made = []
            for k, value in enumerate(values):
                column, now[k] = _before(batch.column(value), now[k])
                made.append(column)
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], [*batch.schema.names, *names])

    kinds = {f.name: f.dataType.simpleString() for f in ranges.select(*[F.sum(v).alias(o) for v, o in totals.items()]).schema}
    wide = {o: "decimal(38," + k.split(",")[1] if k.startswith("decimal") else k for o, k in kinds.items()}
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in ranges.schema], *[f"`{o}` {wide[o]}" for o in names]])
    return ranges.mapInArrow(add, schema)
