"""What changed between full snapshots (problem 4).

Snapshots are range-partitioned by scheme and key and sorted within each range by
delivery and key. A merge with two pointers goes over a range's rows once, holding one
delivery of the range against the one before it and comparing the columns themselves.
``SnapshotStore`` keeps deliveries in this layout, so that a new one is merged with
the last alone.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.storage import materialize

#: The columns whose difference makes a record changed.
COMPARED = ("definition", "notes", "notations", "record_status")


def issue_time(issued: Column) -> Column:
    """Releases' times of issue: dates, and date-times with or without fraction or offset."""
    return F.coalesce(F.try_to_timestamp(issued), F.try_to_timestamp(issued, F.lit("yyyy-MM-dd")))


def delivered_order(snapshots: DataFrame, releases: DataFrame) -> DataFrame:
    """(scheme, release, nth, later, last): the delivered releases of a scheme in order of issue.

    ``later`` is the next delivered release, ``last`` the number of deliveries. Equal
    times of issue are ordered by release id. A delivered release that the release
    table lacks or gives no time has no place in the order and is left out.
    """
    there = snapshots.select("scheme", "release").distinct()
    when = releases.select(strip_key("id").alias("release"), issue_time(F.trim("issued")).alias("_at")).groupBy("release").agg(F.min("_at").alias("_at"))
    in_order = Window.partitionBy("scheme").orderBy("_at", "release")
    ranked = there.join(when, "release").filter("_at IS NOT NULL").select(
        "scheme", "release", F.row_number().over(in_order).alias("nth"), F.lead("release").over(in_order).alias("later"), F.count(F.lit(1)).over(Window.partitionBy("scheme")).cast("int").alias("last")
    )
    return ranked


def _as_text(df: DataFrame, column: str) -> Column:
    """A column as text that tells null, '' and [] apart."""
    return F.col(column) if df.schema[column].dataType.simpleString() == "string" else F.to_json(F.struct(column))


def delivered_records(snapshots: DataFrame, order: DataFrame) -> DataFrame:
    """(scheme, id, nth, compared columns as text), one row per record and delivery: the one delivered last.

    Repeats are reduced where they lie, before the shuffle. At equal times the row with
    the greatest fingerprint counts.
    """
    keys = [strip_key(c).alias(c) for c in ("scheme", "release", "id")]
    at = F.coalesce(F.unix_micros(F.col("delivered_at").cast("timestamp")), F.lit(-(2**62)))
    rows = snapshots.select(*keys, at.alias("_t"), *[_as_text(snapshots, c).alias(f"_{c}") for c in COMPARED]).dropna(subset=["scheme", "release", "id"]).join(order.select("scheme", "release", "nth"), ["scheme", "release"])
    values = [f"_{c}" for c in COMPARED]
    rank = F.struct("_t", F.xxhash64(*[F.struct(F.col(v).isNull(), v) for v in values]))
    once = rows.groupBy("scheme", "id", "nth").agg(F.max_by(F.struct(*values), rank).alias("v"))
    return once.select("scheme", "id", "nth", *[F.col(f"v.{v}") for v in values])


_CHANGE = "scheme string, id string, nth int, change_kind string, changed_columns string"


def _merge(before: pa.Table | None, now: pa.Table | None) -> list[tuple[str, str, str | None]]:
    """(id, kind, columns) between two deliveries of one range, both sorted by id."""
    a = before.column("id").to_pylist() if before is not None else []
    b = now.column("id").to_pylist() if now is not None else []
    out, left, right = [], [], []
    i = j = 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            left.append(i)
            right.append(j)
            i, j = i + 1, j + 1
        elif a[i] < b[j]:
            out.append((a[i], "removed", None))
            i += 1
        else:
            out.append((b[j], "added", None))
            j += 1
    out += [(x, "removed", None) for x in a[i:]] + [(x, "added", None) for x in b[j:]]
    if left:
        old, new = before.take(pa.array(left)), now.take(pa.array(right))
        differs = []
        for c in COMPARED:
            x, y = old.column(f"_{c}"), new.column(f"_{c}")
            unequal = pc.if_else(pc.and_(pc.is_valid(x), pc.is_valid(y)), pc.fill_null(pc.not_equal(x, y), False), pc.xor(pc.is_valid(x), pc.is_valid(y)))
            differs.append(unequal.to_pylist())
        for at, flags in enumerate(zip(*differs, strict=True)):
            if any(flags):
                out.append((b[right[at]], "changed", ",".join(c for c, f in zip(COMPARED, flags, strict=True) if f)))
    return out


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.string(), pa.string(), pa.int32(), pa.string(), pa.string()]
    cols = zip(*rows, strict=True) if rows else [[]] * 5
    return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], names=["scheme", "id", "nth", "change_kind", "changed_columns"])


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Changes of a range whose rows come sorted by (scheme, nth, id); two deliveries of the range are held at a time."""
    held: list[pa.RecordBatch] = []
    key: tuple[str, int] | None = None
    last: tuple[tuple[str, int], pa.Table] | None = None

    def close() -> list[tuple]:
        nonlocal last
        scheme, nth = key
        now = pa.Table.from_batches(held)
        out: list[tuple] = []
        if last is not None and last[0] == (scheme, nth - 1):
            out = [(scheme, i, nth, kind, cols) for i, kind, cols in _merge(last[1], now)]
        else:
            if last is not None:
                out = [(last[0][0], i, last[0][1] + 1, kind, cols) for i, kind, cols in _merge(last[1], None)]
            if nth > 1:
                out += [(scheme, i, nth, kind, cols) for i, kind, cols in _merge(None, now)]
        last = ((scheme, nth), now)
        return out

    for batch in batches:
        if not batch.num_rows:
            continue
        schemes, nths = batch.column("scheme"), batch.column("nth")
        runs = pc.run_end_encode(pc.binary_join_element_wise(schemes, nths.cast(pa.string()), "\x01")).run_ends.to_pylist()
        begin, out = 0, []
        for end in runs:
            own = (schemes[begin].as_py(), nths[begin].as_py())
            if key is not None and own != key:
                out += close()
                held = []
            key = own
            held.append(batch.slice(begin, end - begin))
            begin = end
        yield _batch(out)
    if key is not None:
        # whether a later delivery exists is known only per scheme; the last one's removals are dropped when named
        out = close()
        yield _batch(out + [(key[0], i, key[1] + 1, kind, cols) for i, kind, cols in _merge(last[1], None)])


def snapshot_changes(snapshots: DataFrame, releases: DataFrame) -> DataFrame:
    """(scheme, release, id, change_kind, changed_columns), one row per change.

    release is the later one of two consecutive delivered releases of a scheme.
    change_kind is added, removed or changed; changed_columns names the columns that
    differ, comma-separated, for changed records only. A record delivered several
    times in a release counts as delivered last; at equal times the row with the
    greatest fingerprint counts, so the result does not depend on row order. Rows
    with a null id, scheme or release are no records. Null, empty text and empty
    lists are three different values.
    """
    keyed = snapshots.select(strip_key("scheme").alias("scheme"), strip_key("release").alias("release")).dropna()
    order = materialize(delivered_order(keyed, releases))
    once = delivered_records(snapshots, order)
    ranges = once.repartitionByRange(F.col("scheme"), F.col("id")).sortWithinPartitions("scheme", "nth", "id")
    events = ranges.mapInArrow(_walk, _CHANGE)
    return events.join(order.select("scheme", "nth", "release"), ["scheme", "nth"]).select("scheme", "release", "id", "change_kind", "changed_columns")


class SnapshotStore:
    """Deliveries kept range-partitioned and sorted by key under ``path`` in shared storage.

    The first delivery fixes the bounds of the ranges; each further one is written by
    the same bounds, and its changes come from merging it, range by range, with the
    one before. Older deliveries are neither read nor sorted again.
    """

    def __init__(self, spark: SparkSession, path: str, ranges: int = 64) -> None:
        self.spark, self.path, self.ranges = spark, path, ranges

    def _bounds(self, first: DataFrame | None = None) -> list[tuple[str, str]]:
        """The least (scheme, id) of every range but the first; at most ``ranges`` rows."""
        if first is not None:
            parts = first.select("scheme", "id").repartitionByRange(self.ranges, "scheme", "id").groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("scheme", "id")).alias("b"))
            parts.select("b.scheme", "b.id").write.parquet(f"{self.path}/bounds")
        return sorted((r["scheme"], r["id"]) for r in self.spark.read.parquet(f"{self.path}/bounds").collect())[1:]

    def add(self, records: DataFrame, number: int) -> None:
        """Write delivery ``number`` (rows of ``delivered_records``)."""
        bounds = self._bounds(records if number == 1 else None)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys = zip(batch.column("scheme").to_pylist(), batch.column("id").to_pylist(), strict=True)
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([bisect_right(bounds, k) for k in keys], pa.int32())], names=[*batch.schema.names, "range"])

        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in records.schema.fields)
        placed = records.mapInArrow(place, f"{schema}, range int").repartition(self.ranges, "range").sortWithinPartitions("range", "scheme", "id")
        placed.write.parquet(f"{self.path}/delivery-{number}")

    def changes(self, number: int) -> DataFrame:
        """(scheme, id, nth, change_kind, changed_columns) of delivery ``number`` against the one before."""
        old, new = (self.spark.read.parquet(f"{self.path}/delivery-{k}") for k in (number - 1, number))

        def merge(a: pa.Table, b: pa.Table) -> pa.Table:
            # one range of two deliveries; schemes that one side lacks are wholly added or removed
            a, b = (t.sort_by([("scheme", "ascending"), ("id", "ascending")]) for t in (a, b))
            out = []
            for scheme in sorted(set(pc.unique(a.column("scheme")).to_pylist()) | set(pc.unique(b.column("scheme")).to_pylist())):
                x, y = (t.filter(pc.equal(t.column("scheme"), scheme)) for t in (a, b))
                out += [(scheme, i, number, kind, cols) for i, kind, cols in _merge(x, y)]
            return pa.Table.from_batches([_batch(out)])

        return old.groupBy("range").cogroup(new.groupBy("range")).applyInArrow(merge, _CHANGE)


def latest_changes(snapshots: DataFrame, releases: DataFrame, path: str, ranges: int = 64) -> DataFrame:
    """(scheme, release, id, change_kind, changed_columns) of the last delivery of each scheme, through a kept store.

    The last but one delivery of every scheme is the store's first, the last its
    second; a scheme delivered once has no changes.
    """
    keyed = snapshots.select(strip_key("scheme").alias("scheme"), strip_key("release").alias("release")).dropna()
    order = materialize(delivered_order(keyed, releases)).filter("last > 1")
    once = delivered_records(snapshots, order.filter("nth >= last - 1"))
    named = order.filter("nth = last").select("scheme", "last", "release")
    both = materialize(once.join(named, "scheme"))
    store = SnapshotStore(snapshots.sparkSession, path, ranges)
    for k in (1, 2):
        store.add(both.filter(F.col("nth") == F.col("last") + (k - 2)).drop("nth", "last", "release"), k)
    return store.changes(2).join(named, "scheme").select("scheme", "release", "id", "change_kind", "changed_columns")
