"""Parent-child links to full hierarchies (problem 3).

Rows are dealt into cells of bounded size: small trees whole, large trees split.
Inside a cell every chain of parents is contracted to the exit where it leaves the
cell. The exits that are nodes of other cells form a smaller forest, which is
solved the same way; then fragment paths are expanded through their exits. A chain
that never leaves is on or below a cycle, within a cell or across cells.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.operators.skewjoin import HOT_ROWS, join_unique
from lexmesh.storage import materialize

#: Rows that one contraction holds: about 200 MB of keys and integers.
CELL_NODES = 600_000

_ROWS = "tree string, node string, ptr string, dist long, frag array<string>"
_SEP = "\x1f"


def climb(up: np.ndarray, dist: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The last row on each row's way up, the distance to it, and whether the way never ends.

    up: the row of each row's parent, or its own index where the parent is outside.
    """
    ends = up == np.arange(len(up))
    dist = np.where(ends, 0, dist)
    reached = -1
    # a round in which no further row reaches an end leaves only rows that never do
    while (now := int(ends[up].sum())) > reached:
        reached = now
        dist = dist + dist[up]
        up = up[up]
    return up, dist, ~ends[up]


def _contract(paths: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = list(batches)
        if not sum(b.num_rows for b in held):
            return
        table = pa.Table.from_batches(held).combine_chunks()
        n = len(table)
        tree, node, ptr = (table[c].to_pylist() for c in ("tree", "node", "ptr"))
        dist = table["dist"].to_numpy()
        row = {key: i for i, key in enumerate(zip(tree, node, strict=True))}
        up = np.fromiter((row.get((t, p), i) for i, (t, p) in enumerate(zip(tree, ptr, strict=True))), np.int64, n)
        loop = np.fromiter((p is None or p == x for p, x in zip(ptr, node, strict=True)), bool, n)
        # a row that is its own parent, or found cyclic before, never leaves: point it at an extra pair of rows that circle
        ring = np.concatenate([up, [n + 1, n]])
        ring[:n][loop] = n
        top, far, cyclic = climb(ring, np.concatenate([dist, [1, 1]]))
        top, far, cyclic = top[:n], far[:n], cyclic[:n]
        top = np.where(cyclic, 0, top)
        exits = [None if c else ptr[t] for t, c in zip(top, cyclic, strict=True)]
        total = np.where(cyclic, -1, far + dist[top])
        if not paths:
            frags = [None] * n
        else:
            own = table["frag"].to_pylist()
            frags = [None] * n
            for i in range(n):
                way, at = [], i
                while frags[at] is None and not cyclic[at]:
                    way.append(at)
                    if up[at] == at:
                        break
                    at = int(up[at])
                if cyclic[i]:
                    continue
                tail = frags[at] if frags[at] is not None else []
                for x in reversed(way):
                    frags[x] = tail = own[x] + tail
        for start in range(0, n, 50_000):
            cut = slice(start, start + 50_000)
            yield pa.record_batch([pa.array(tree[cut], pa.string()), pa.array(node[cut], pa.string()), pa.array(exits[cut], pa.string()), pa.array(total[cut], pa.int64()), pa.array(frags[cut], pa.list_(pa.string()))], names=["tree", "node", "ptr", "dist", "frag"])

    return run


def _dealt(rows: DataFrame, n: int, cell_nodes: int) -> DataFrame:
    """Rows in cells: trees of up to half a cell whole, larger ones split by node."""
    cells = -(-n // cell_nodes)
    if cells <= 1:
        return rows.coalesce(1)
    large = rows.groupBy("tree").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > cell_nodes // 2)
    # at most 2 * rows / cell_nodes trees are large
    rows = rows.join(F.broadcast(large), "tree", "left")
    part = F.pmod(F.xxhash64("node"), F.ceil(F.col("_n") * 2 / F.lit(cell_nodes)).cast("long"))
    return rows.repartition(2 * cells, F.xxhash64("tree", F.coalesce(part, F.lit(0)))).drop("_n")


def _keyed(rows: DataFrame, *cols: str):
    return F.concat_ws(_SEP, *[F.col(c) for c in cols])


def _through(rows: DataFrame, solved: DataFrame, hot_rows: int) -> DataFrame:
    """Rows whose exits are solved get the answer of their exit."""
    rows = rows.withColumn("_k", _keyed(rows, "tree", "ptr"))
    answers = solved.select(_keyed(solved, "tree", "node").alias("_k"), F.col("ptr").alias("_ptr"), F.col("dist").alias("_dist"), F.col("frag").alias("_frag"))
    both = join_unique(rows, answers, "_k", hot_rows)
    cyclic = F.col("ptr").isNull() | (F.col("_dist") == -1)
    reached = F.when(cyclic, F.lit(None)).when(F.col("_dist").isNull(), F.col("ptr")).otherwise(F.col("_ptr"))
    total = F.when(cyclic, F.lit(-1)).otherwise(F.col("dist") + F.coalesce("_dist", F.lit(0)))
    frag = F.when(cyclic, F.lit(None)).otherwise(F.concat("frag", F.coalesce("_frag", F.array().cast("array<string>"))))
    return materialize(both.select("tree", "node", reached.alias("ptr"), total.cast("long").alias("dist"), frag.alias("frag")))


def _solve(rows: DataFrame, n: int, paths: bool, cell_nodes: int, hot_rows: int, level: int) -> DataFrame:
    """For each row its root in ptr (null on or below a cycle) and its depth in dist."""
    out = materialize(_dealt(rows, n, cell_nodes).mapInArrow(_contract(paths), _ROWS))
    if n <= cell_nodes:
        return out
    exits = out.filter("ptr IS NOT NULL").select("tree", F.col("ptr").alias("node")).distinct()
    smaller = materialize(out.join(exits, ["tree", "node"], "left_semi"))
    m = smaller.count()
    if not m:
        return out
    if m > 0.7 * n and m > cell_nodes:
        solved = _spliced(smaller, paths, cell_nodes, hot_rows, level)
    else:
        solved = _solve(smaller, m, paths, cell_nodes, hot_rows, level + 1)
    return _through(out, solved, hot_rows)


def _spliced(rows: DataFrame, paths: bool, cell_nodes: int, hot_rows: int, level: int) -> DataFrame:
    """Where cells contract little (long chains), take out rows by lot: those with side 0 under a parent with side 1."""
    side = lambda c: F.pmod(F.xxhash64("tree", c, F.lit(level)), F.lit(2))
    done = F.col("ptr").isNull()
    out = (side("node") == 0) & (side("ptr") == 1) & ~done
    gone = materialize(rows.filter(F.coalesce(out, F.lit(False))))
    kept = materialize(rows.filter(~F.coalesce(out, F.lit(False))))
    kept = kept.withColumn("_k", _keyed(kept, "tree", "ptr"))
    over = gone.select(_keyed(gone, "tree", "node").alias("_k"), F.col("ptr").alias("_ptr"), F.col("dist").alias("_dist"), F.col("frag").alias("_frag"))
    both = join_unique(kept, over, "_k", hot_rows)
    hop = both.select("tree", "node", F.coalesce("_ptr", "ptr").alias("ptr"), (F.col("dist") + F.coalesce("_dist", F.lit(0))).alias("dist"), F.concat("frag", F.coalesce("_frag", F.array().cast("array<string>"))).alias("frag"))
    ended = materialize(hop.filter("ptr IS NULL"))
    hop = materialize(hop.filter("ptr IS NOT NULL"))
    solved = _solve(hop, hop.count(), paths, cell_nodes, hot_rows, level + 1).unionByName(ended.withColumn("dist", F.lit(-1).cast("long")))
    return solved.unionByName(_through(gone, materialize(solved), hot_rows))


def resolve_hierarchy(edges: DataFrame, tree: str, child: str, parent: str, paths: bool = False, cell_nodes: int = CELL_NODES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(tree, node, root, depth[, path]) of every node of every tree.

    A node without parent is a root: depth 0, itself as root. A node on a cycle or
    below one has root '' and depth -1 and, with ``paths``, a null path. ``path``
    runs from the root to the node. Edges with a null in any of the three columns
    are no edges; repeated edges count once; a node with several parents follows the
    smallest one compared as text. An empty table gives an empty result.
    """
    named = edges.select(F.col(tree).cast("string").alias("tree"), F.col(child).cast("string").alias("node"), F.col(parent).cast("string").alias("ptr")).dropna()
    up = materialize(named.groupBy("tree", "node").agg(F.min("ptr").alias("ptr")))
    roots = up.select("tree", F.col("ptr").alias("node")).distinct().join(up.select("tree", "node"), ["tree", "node"], "left_anti")
    frag = F.array("node") if paths else F.lit(None).cast("array<string>")
    rows = up.select("tree", "node", "ptr", F.lit(1).cast("long").alias("dist"), frag.alias("frag"))
    solved = _solve(rows, up.count(), paths, cell_nodes, hot_rows, 0)
    root = F.coalesce(F.col("ptr"), F.lit(""))
    below = solved.select("tree", "node", root.alias("root"), "dist", F.reverse(F.concat("frag", F.array("ptr"))).alias("path"))
    tops = roots.select("tree", "node", F.col("node").alias("root"), F.lit(0).cast("long").alias("dist"), F.array("node").alias("path"))
    out = below.unionByName(tops).withColumnRenamed("dist", "depth")
    return out if paths else out.drop("path")


def on_cycle(hierarchy: DataFrame, edges: DataFrame, tree: str, child: str, parent: str, cell_nodes: int = CELL_NODES) -> DataFrame:
    """(tree, node) of the nodes that lie on a cycle themselves.

    ``hierarchy`` is the result of :func:`resolve_hierarchy` for ``edges``. Only its
    nodes on or below cycles are followed: stepping 2^k >= their number of times
    through parents leaves exactly the nodes on cycles.
    """
    caught = hierarchy.filter("depth = -1").select("tree", "node")
    named = edges.select(F.col(tree).cast("string").alias("tree"), F.col(child).cast("string").alias("node"), F.col(parent).cast("string").alias("to")).dropna()
    step = materialize(named.groupBy("tree", "node").agg(F.min("to").alias("to")).join(caught, ["tree", "node"], "left_semi"))
    n = step.count()
    if n <= cell_nodes:

        def image(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = list(batches)
            if not held:
                return
            t = pa.Table.from_batches(held)
            keys = list(zip(t["tree"].to_pylist(), t["node"].to_pylist(), strict=True))
            row = {k: i for i, k in enumerate(keys)}
            to = np.array([row[(k[0], p)] for k, p in zip(keys, t["to"].to_pylist(), strict=True)], dtype=np.int64)
            for _ in range(len(keys).bit_length()):
                to = to[to]
            left = [keys[i] for i in np.unique(to)]
            yield pa.record_batch([pa.array([k[0] for k in left], pa.string()), pa.array([k[1] for k in left], pa.string())], names=["tree", "node"])

        return step.coalesce(1).mapInArrow(image, "tree string, node string")
    for _ in range(n.bit_length()):
        nxt = step.select("tree", F.col("node").alias("to"), F.col("to").alias("_far"))
        step = materialize(step.join(nxt, ["tree", "to"]).select("tree", "node", F.col("_far").alias("to")))
    return step.select("tree", F.col("to").alias("node")).distinct()


#: Versions of up to this number are broadcast to the edges (about 10 MB).
FEW_VERSIONS = 100_000


def keyword_edges(edges: DataFrame, hierarchies: DataFrame) -> DataFrame:
    """(keyword_version, child, parent) of the source hierarchies, identifiers in one notation."""
    from lexmesh.functions.keys import hex32_uuid

    versions = materialize(hierarchies.select("keyword_version", "source_sha256").distinct())
    if versions.count() <= FEW_VERSIONS:  # one version holds most edges, so they had better not be shuffled by it
        versions = F.broadcast(versions)
    named = edges.select("source_sha256", hex32_uuid("child_uuid").alias("child"), hex32_uuid("parent_uuid").alias("parent"))
    return named.join(versions, "source_sha256").select("keyword_version", "child", "parent")
