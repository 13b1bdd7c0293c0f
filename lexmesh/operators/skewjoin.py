"""Joins to a table with unique keys that survive hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.storage import materialize

#: A key on more rows than this is joined apart from the shuffle.
HOT_ROWS = 500_000


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Keys on more than ``hot_rows`` rows; at most ``rows / hot_rows`` of them."""
    counts = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.filter(F.col("_n") > hot_rows).select(key)


def join_unique(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join of ``left`` to ``right``, which has one row per ``key``.

    ``left`` should be cheap to read again (materialized). A key that holds more
    than ``hot_rows`` rows of ``left`` is counted first with partial aggregation;
    its single right row is broadcast, so its rows never meet in one task. The
    broadcast has at most ``rows(left) / hot_rows`` rows. Null keys match nothing
    and skip the shuffle.
    """
    if left.isEmpty():
        return left.join(right, key, "left")
    hot = materialize(hot_keys(left, key, hot_rows))
    if hot.isEmpty():
        return left.join(right, key, "left")
    nulls = left.filter(F.col(key).isNull())
    rest = [f for f in right.schema.fields if f.name != key]
    nulls = nulls.withColumns({f.name: F.lit(None).cast(f.dataType) for f in rest})
    left = left.filter(F.col(key).isNotNull())
    few = F.broadcast(hot)
    warm = left.join(few, key, "left_semi").join(F.broadcast(right.join(few, key, "left_semi")), key, "left")
    cold = left.join(few, key, "left_anti").join(right, key, "left")
    return warm.unionByName(cold).unionByName(nulls.select(warm.columns))


def anti_join(left: DataFrame, right: DataFrame, keys: list[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """Rows of ``left`` whose ``keys``, none of them null, ``right`` (one row per key) lacks.

    ``left`` should be cheap to read again. Keys on more than ``hot_rows`` rows are
    tested against a broadcast of their own at most ``rows(left) / hot_rows`` keys.
    """
    counts = left.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    hot = materialize(counts.filter(F.col("_n") > hot_rows).select(*keys))
    if hot.isEmpty():
        return left.join(right, keys, "left_anti")
    few = F.broadcast(hot)
    warm = left.join(few, keys, "left_semi").join(F.broadcast(right.select(*keys).join(few, keys, "left_semi")), keys, "left_anti")
    return warm.unionByName(left.join(few, keys, "left_anti").join(right, keys, "left_anti"))
