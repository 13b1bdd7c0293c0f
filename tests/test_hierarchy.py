import random

import pytest
from pyspark.sql import functions as F

from lexmesh.functions.keys import hex32_uuid
from lexmesh.operators.hierarchy import on_cycle, resolve_hierarchy

from .conftest import rows

SCHEMA = "tree string, child string, parent string"


def brute(edges):
    up = {}
    for t, c, p in edges:
        if None not in (t, c, p):
            up[t, c] = min(p, up.get((t, c), p))
    nodes = set(up) | {(t, p) for (t, _), p in up.items()}
    out = {}
    for t, n in nodes:
        way, at = [n], n
        while (t, at) in up and len(way) <= len(nodes) + 1:
            at = up[t, at]
            way.append(at)
        out[t, n] = ("", -1, None) if (t, at) in up else (at, len(way) - 1, way[::-1])
    return out


def random_edges(seed, n, trees=3):
    rng = random.Random(seed)
    out = []
    for _ in range(n):
        t = rng.choices(range(trees), [8] + [1] * (trees - 1))[0]
        c = rng.randrange(n // 2)
        p = rng.randrange(max(1, c)) if rng.random() < 0.97 else rng.randrange(n // 2)
        out.append((f"t{t}", f"n{c:04d}", f"n{p:04d}"))
    return out


@pytest.mark.parametrize("cell", [600_000, 25])
def test_matches_brute_force(spark, cell):
    edges = random_edges(cell, 300)
    df = spark.createDataFrame(edges, SCHEMA).withColumn("root", F.lit("clash")).withColumn("node", F.lit(1))
    got = {(r.tree, r.node): (r.root, r.depth, r.path) for r in resolve_hierarchy(df, "tree", "child", "parent", paths=True, cell_nodes=cell, hot_rows=20).collect()}
    assert got == brute(edges)


def test_long_chain_is_spliced(spark):
    edges = [("t", f"n{i:04d}", f"n{i + 1:04d}") for i in range(160)]
    got = {r.node: (r.root, r.depth) for r in resolve_hierarchy(spark.createDataFrame(edges, SCHEMA), "tree", "child", "parent", cell_nodes=24, hot_rows=20).collect()}
    assert got == {f"n{i:04d}": ("n0160", 160 - i) for i in range(161)}


def test_cycles_nulls_repeats(spark):
    edges = [("t", "a", "b"), ("t", "b", "c"), ("t", "c", "a"), ("t", "x", "a"), ("t", "s", "s"), ("t", "k", "r"), ("t", "k", "r"), ("t", None, "r"), ("t", "q", None), (None, "q", "r"), ("t", "m", "z"), ("t", "m", "y")]
    df = spark.createDataFrame(edges, SCHEMA)
    found = resolve_hierarchy(df, "tree", "child", "parent")
    got = {r.node: (r.root, r.depth) for r in found.collect()}
    assert got == {"a": ("", -1), "b": ("", -1), "c": ("", -1), "x": ("", -1), "s": ("", -1), "k": ("r", 1), "r": ("r", 0), "m": ("y", 1), "y": ("y", 0)}
    for cell in (100, 1):
        assert rows(on_cycle(found, df, "tree", "child", "parent", cell).select("node")) == [("a",), ("b",), ("c",), ("s",)]


def test_empty(spark):
    assert resolve_hierarchy(spark.createDataFrame([], SCHEMA), "tree", "child", "parent", paths=True).count() == 0


def test_identifier_notations(spark):
    want = "0a1b2c3d-0a1b-2c3d-4e5f-0a1b2c3d4e5f"
    texts = [want, want.upper(), "{" + want + "}", " urn:uuid:" + want + "\t", want.replace("-", ""), "short", "", None]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(hex32_uuid("t")).collect()]
    assert got == [want] * 5 + [None] * 3
