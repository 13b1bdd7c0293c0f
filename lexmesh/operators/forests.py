"""Connected components by union-find in bounded cells.

Cells of edges keep only a spanning forest. A node seen in one cell is settled there;
a node seen in several links their roots, and these links are the next, smaller
level. The levels merge until one cell holds all that is left, then roots are carried
back down.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.operators.skewjoin import HOT_ROWS, join_unique
from lexmesh.storage import discard, materialize

#: Links that one union-find holds at a time: about 150 MB of strings and integers.
CELL_EDGES = 600_000


def smallest_labels(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """For nodes 0..n-1 the smallest node connected to each."""
    parent = np.arange(n)
    while True:
        a, b = parent[left], parent[right]
        open_ = a != b
        if not open_.any():
            return parent
        left, right, a, b = left[open_], right[open_], a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))
        while True:
            up = parent[parent]
            if np.array_equal(up, parent):
                break
            parent = up


def _forest(table: pa.Table) -> pa.RecordBatch:
    ends = pa.chunked_array(table["a"].chunks + table["b"].chunks, type=pa.string()).combine_chunks()
    coded = ends.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), dtype=np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    codes = rank[coded.indices.to_numpy()]
    root = smallest_labels(codes[: len(table)], codes[len(table) :], len(order))
    names = coded.dictionary.take(order)
    return pa.record_batch([names, names.take(pa.array(root))], names=["node", "root"])


def cell_forests(cell_edges: int):
    """A mapInArrow function: (a, b) links to (node, root) forests of bounded cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += batch.num_rows
            if rows >= cell_edges:
                yield _forest(pa.Table.from_batches(held))
                held, rows = [], 0
        if rows:
            yield _forest(pa.Table.from_batches(held))

    return run


def forest_groups(pairs: DataFrame, left: str, right: str, cell_edges: int = CELL_EDGES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(node, root): every node on a pair, with the smallest node tied to it.

    Nulls on either side drop the pair. A pair of equal nodes names the node only.
    Repeated and reversed pairs count once; an empty table gives an empty result.
    The order of pairs and their partitioning don't matter.
    """
    edges = pairs.select(F.col(left).cast("string").alias("a"), F.col(right).cast("string").alias("b")).dropna()
    forest = materialize(edges.mapInArrow(cell_forests(cell_edges), "node string, root string"))
    levels: list[DataFrame] = []
    while True:
        at = forest.groupBy("node").agg(F.min("root").alias("root"), F.collect_set("root").alias("roots"))
        nodes = materialize(at.select("node", "root", F.when(F.size("roots") > 1, F.col("roots")).alias("roots")))
        discard(forest)
        levels.append(nodes.select("node", "root"))
        links = nodes.filter(F.col("roots").isNotNull()).select(F.col("root").alias("a"), F.explode("roots").alias("b"))
        links = materialize(links.filter("a <> b").distinct())
        n = links.count()
        if not n:
            break
        cells = -(-n // cell_edges)
        if cells > 1:  # links meet at the end that a hash of this level puts first, so most nodes stay in one cell
            x, y = F.xxhash64("a", F.lit(len(levels))), F.xxhash64("b", F.lit(len(levels)))
            links = links.repartition(cells, F.when(x < y, F.col("a")).otherwise(F.col("b")))
        else:
            links = links.coalesce(1)
        forest = materialize(links.mapInArrow(cell_forests(cell_edges if cells > 1 else 2 * cell_edges), "node string, root string"))
    found = levels[-1]
    for lower in reversed(levels[:-1]):
        up = found.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        found = materialize(join_unique(lower, up, "root", hot_rows).select("node", F.coalesce("_up", "root").alias("root")))
    return found
