"""Exact global ranks without a single-task window."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.storage import materialize


def with_rank(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with each row's position from 0 in a total order: ranges are sorted apart and numbered from their counts."""

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            n = b.num_rows
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(n, part, dtype=np.int32)), pa.array(np.arange(at, at + n))], names=[*b.schema.names, "_part", "_idx"])
            at += n

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields)
    rows = materialize(df.repartitionByRange(*[F.col(c) for c in order]).sortWithinPartitions(*order).mapInArrow(number, f"{schema}, _part int, _idx long"))
    before, total = [], 0
    for r in rows.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():  # one row a partition
        before.append((r["_part"], total))
        total += r["n"]
    shift = df.sparkSession.createDataFrame(before, "_part int, _before long")
    return rows.join(F.broadcast(shift), "_part").withColumn(name, F.col("_idx") + F.col("_before")).drop("_part", "_idx", "_before")
