"""Filling fixed-capacity containers with items (problem 8).

Shortest-pack-first over the histogram of lengths: lengths are placed longest first,
each into the emptiest open pack that takes it, for all equal packs at once. Only
the histogram, bounded by the capacity, reaches the driver. Documents then find
their container by their rank among documents of their length.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmesh.llm.tokens import VOCABULARY, sized
from lexmesh.storage import materialize


def packing_patterns(histogram: dict[int, int], capacity: int) -> list[tuple[list[tuple[int, int]], int]]:
    """[(pattern, count)]: a pattern is [(length, times)], longest first; count packs have it.

    Lengths must be 1..capacity. The number of patterns is bounded by the number of
    distinct lengths and placements, never by the number of items.
    """
    nodes: list[tuple[int, int, int]] = [(-1, 0, 0)]  # (node before, length, times)
    open_: dict[int, list[list[int]]] = {}  # space left -> [[node, count]]
    spaces: list[int] = []  # negated, a heap of the keys of open_

    def put(space: int, node: int, count: int) -> None:
        if space not in open_:
            open_[space] = []
            heapq.heappush(spaces, -space)
        open_[space].append([node, count])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if spaces and -spaces[0] >= length:
                space = -spaces[0]
                node, count = open_[space].pop()
                if not open_[space]:
                    heapq.heappop(spaces)
                    del open_[space]
            else:
                space, node, count = capacity, 0, left
            used = min(count, left)
            if used < count:
                put(space, node, count - used)
            before, last, times = nodes[node]
            nodes.append((before, length, times + 1) if node and last == length else (node, length, 1))
            put(space - length, len(nodes) - 1, used)
            left -= used
    out = []
    for groups in open_.values():
        for node, count in groups:
            pattern, at = [], node
            while at:
                before, length, times = nodes[at]
                pattern.append((length, times))
                at = before
            out.append((pattern[::-1], count))
    return sorted(out, reverse=True)


def slots_of(patterns: list[tuple[list[tuple[int, int]], int]]) -> tuple[dict[int, list[tuple[int, int, int]]], int]:
    """For each length its runs (first rank, first container, times a container), and the number of containers."""
    runs: dict[int, list[tuple[int, int, int]]] = {}
    filled: dict[int, int] = {}
    base = 0
    for pattern, count in patterns:
        for length, times in pattern:
            start = filled.get(length, 0)
            runs.setdefault(length, []).append((start, base, times))
            filled[length] = start + count * times
        base += count
    return runs, base


def _ranked(kinds: list[tuple[str, int]]):
    """Rows of a sorted partition: for each kind the last piece's length and the running numbers within the partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        seen = [np.zeros(capacity + 1, dtype=np.int64) for _, capacity in kinds]
        whole = [0] * len(kinds)
        for batch in batches:
            n = batch.num_rows
            tokens = batch.column("n_tokens").to_numpy()
            for k, (_, capacity) in enumerate(kinds):
                full = np.where(tokens > capacity, tokens // capacity, 0)
                rest = tokens - full * capacity
                order = np.argsort(rest, kind="stable")
                ranks = np.empty(n, dtype=np.int64)
                ordered = rest[order]
                starts = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if n else np.array([], dtype=np.int64)
                sizes = np.diff(np.r_[starts, n])
                ranks[order] = np.arange(n) - np.repeat(starts, sizes)
                rank = ranks + seen[k][rest]
                seen[k][ordered[starts]] += sizes
                first = whole[k] + np.cumsum(full) - full
                whole[k] += int(full.sum())
                yield pa.record_batch([pa.array(np.full(n, k, dtype=np.int32)), pa.array(np.full(n, part, dtype=np.int32)), batch.column("doc_id"), batch.column("n_tokens"), pa.array(rest), pa.array(rank), pa.array(full), pa.array(first)], names=["kind", "part", "doc_id", "n_tokens", "rest", "rank", "full", "first"])

    return run


def _placed(kinds: list[tuple[str, int]], plans: list[tuple[dict[int, list[tuple[int, int, int]]], int]]):
    """The container of every last piece, and the number of the first whole piece."""
    tables = []
    for runs, _ in plans:
        flat = [(length, start, base, times) for length, of in sorted(runs.items()) for start, base, times in of]
        tables.append(np.array(flat, dtype=np.int64).reshape(-1, 4))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kind, rest, rank = (batch.column(c).to_numpy() for c in ("kind", "rest", "rank"))
            container = np.full(batch.num_rows, -1, dtype=np.int64)
            for k, table in enumerate(tables):
                mine = (kind == k) & (rest > 0)
                if mine.any():
                    keys = (table[:, 0] << 44) | table[:, 1]
                    at = np.searchsorted(keys, (rest[mine].astype(np.int64) << 44) | rank[mine], side="right") - 1
                    container[mine] = table[at, 2] + (rank[mine] - table[at, 1]) // table[at, 3]
            yield pa.record_batch([*[batch.column(c) for c in ("kind", "doc_id", "n_tokens", "rest", "full", "first")], pa.array(container)], names=["kind", "doc_id", "n_tokens", "rest", "full", "first", "container"])

    return run


def pack_documents(documents: DataFrame, sizes: DataFrame, path: str = VOCABULARY) -> DataFrame:
    """(container_kind, doc_id, piece, piece_tokens, container_id): where every text lies.

    A text that exceeds the capacity is cut into pieces of exactly the capacity, each
    filling a container of its own, and a rest that is packed like any other text; no
    other text is divided. Ranks follow doc_id, so containers do not depend on
    partitioning (rows with equal doc_id and size are interchangeable). Texts without
    tokens (null, empty) lie in container 0. Rows with a null doc_id are left out.
    Kinds with null or non-positive capacity hold nothing; ``sizes`` is a small table
    of container kinds, read by the driver.
    """
    kinds = sorted({(r["container_kind"], r["capacity_tokens"]) for r in sizes.select("container_kind", "capacity_tokens").collect() if r["capacity_tokens"] and r["capacity_tokens"] > 0})
    tokens = materialize(sized(documents.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), "text"), "doc_id", path=path))
    schema = "kind int, part int, doc_id long, n_tokens long, rest long, rank long, full long, first long"
    pieces = materialize(tokens.repartitionByRange(F.col("doc_id")).sortWithinPartitions("doc_id", "n_tokens").mapInArrow(_ranked(kinds), schema))
    # where each partition's running numbers start: one row per partition, kind and length
    per = pieces.groupBy("kind", "part", "rest").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("kind", "rest").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(per.select("kind", "part", "rest", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")))
    wholes = pieces.groupBy("kind", "part").agg(F.sum("full").alias("n"))
    ahead = Window.partitionBy("kind").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    shift = materialize(wholes.select("kind", "part", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("shift")))
    # the histogram: at most capacity rows a kind
    histograms: list[dict[int, int]] = [{} for _ in kinds]
    for r in starts.filter("rest > 0").groupBy("kind", "rest").agg(F.sum("n").alias("n")).collect():
        histograms[r["kind"]][r["rest"]] = r["n"]
    plans = [slots_of(packing_patterns(h, capacity)) for h, (_, capacity) in zip(histograms, kinds, strict=True)]
    ranked = pieces.join(starts.drop("n"), ["kind", "part", "rest"]).join(shift, ["kind", "part"])
    ranked = ranked.select("kind", "doc_id", "n_tokens", "rest", (F.col("rank") + F.col("start")).alias("rank"), "full", (F.col("first") + F.col("shift")).alias("first"))
    placed = ranked.mapInArrow(_placed(kinds, plans), "kind int, doc_id long, n_tokens long, rest long, full long, first long, container long")
    names = F.array(*[F.lit(n) for n, _ in kinds]) if kinds else F.array(F.lit(""))
    caps = F.array(*[F.lit(c).cast("long") for _, c in kinds]) if kinds else F.array(F.lit(0).cast("long"))
    packs = F.array(*[F.lit(p[1]).cast("long") for p in plans]) if kinds else F.array(F.lit(0).cast("long"))
    kind, cap = F.get(names, F.col("kind")), F.get(caps, F.col("kind"))
    last = F.when((F.col("rest") > 0) | (F.col("full") == 0), F.array(F.struct((F.col("full") + 1).cast("int").alias("piece"), F.col("rest").alias("piece_tokens"), F.greatest(F.col("container"), F.lit(0)).alias("container_id")))).otherwise(F.array())
    first_whole = F.get(packs, F.col("kind")) + F.col("first")
    cut = F.transform(F.when(F.col("full") > 0, F.sequence(F.lit(1).cast("long"), F.col("full"))).otherwise(F.array().cast("array<bigint>")), lambda i: F.struct(i.cast("int").alias("piece"), cap.alias("piece_tokens"), (first_whole + i - 1).alias("container_id")))
    rows = placed.select(kind.alias("container_kind"), "doc_id", F.explode(F.concat(cut, last)).alias("p"))
    return rows.select("container_kind", "doc_id", "p.piece", "p.piece_tokens", "p.container_id")


def container_fill(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """(container_kind, container_id, texts, used_tokens, capacity_tokens, fill) of every container."""
    of = packed.groupBy("container_kind", "container_id").agg(F.count(F.lit(1)).alias("texts"), F.sum("piece_tokens").alias("used_tokens"))
    kinds = sizes.select("container_kind", "capacity_tokens").distinct()
    return of.join(kinds, "container_kind").select("container_kind", "container_id", "texts", "used_tokens", "capacity_tokens", (F.col("used_tokens") / F.col("capacity_tokens")).alias("fill"))
