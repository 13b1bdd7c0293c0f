import random

import pytest
from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.operators import evaluate as V
from lexmesh.operators import graph as G
from lexmesh.operators.ranks import with_rank
from lexmesh.operators.skewjoin import join_unique
from lexmesh.storage import materialize

from .conftest import rows


def random_pairs(seed, n=40, m=35):
    rng = random.Random(seed)
    return [(f"n{rng.randrange(n):02d}", f"n{rng.randrange(n):02d}") for _ in range(m)]


def smallest(pairs):
    root = {x: x for p in pairs if p[0] != p[1] for x in p}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            if a != b:
                low = min(root[a], root[b])
                changed |= root[a] != low or root[b] != low
                root[a] = root[b] = low
    return sorted(root.items())


def closure(pairs):
    reach = set(pairs)
    while True:
        more = {(a, d) for a, b in reach for c, d in pairs if b == c} - reach
        if not more:
            return reach
        reach |= more


@pytest.mark.parametrize("seed", [1, 2])
def test_components_and_closure(spark, seed):
    pairs = random_pairs(seed)
    df = spark.createDataFrame(pairs, "a string, b string")
    assert rows(G.components(df)) == smallest(pairs)
    assert rows(G.reachable(df).select("a", "b")) == sorted(closure(pairs))


def test_cyclic_core_and_related(spark):
    df = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("x", "a"), ("c", "y"), ("p", "q")], "a string, b string")
    assert rows(G.cyclic_core(df)) == [("a", "b"), ("b", "c"), ("c", "a")]
    related = spark.createDataFrame([("x", "y"), ("y", "x"), ("x", "p"), ("p", "q")], "a string, b string")
    assert rows(G.related_and_connected(related, df)) == [("p", "q"), ("x", "y"), ("y", "x")]
    assert G.cyclic_core(df.filter("a = 'p'")).count() == 0


def test_chain_outcomes(spark):
    links = [("a", "b"), ("b", "c"), ("x", "y"), ("y", "x"), ("m", "f"), ("f", "p"), ("f", "q")]
    got = {r.start: (r.sink, r.outcome) for r in G.follow_chain(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {"a": ("c", "resolved"), "b": ("c", "resolved"), "x": (None, "cycle"), "y": (None, "cycle"), "m": ("f", "branch")}


def test_prefix_parents(spark):
    codes = spark.createDataFrame([("a", "1"), ("b", "1.2"), ("c", "1.2.3"), ("d", "9.9"), ("e", "5"), ("f", "5"), ("g", "5.1"), ("h", "7"), ("h", "7.1")], "resource string, code string")
    got = {(r.resource, r.code): r.outcome for r in G.prefix_parents(codes, F.when(F.contains("code", F.lit(".")), F.regexp_replace("code", r"\.[^.]*$", ""))).collect()}
    assert got == {("a", "1"): "root", ("b", "1.2"): "edge", ("c", "1.2.3"): "edge", ("d", "9.9"): "missing", ("e", "5"): "root", ("f", "5"): "root", ("g", "5.1"): "ambiguous", ("h", "7"): "root", ("h", "7.1"): "self"}


def test_rule_registry():
    rules.reset()
    rule = rules.register(rules.Rule("r", "p", closure))
    rules.register(rule)
    with pytest.raises(ValueError):
        rules.register(rules.Rule("r", "other", closure))
    assert rules.names() == ["r"]
    rules.reset()


def test_ranks_and_skewed_join(spark):
    df = spark.createDataFrame([(f"k{i % 7}", i) for i in range(200)], "k string, v int")
    ranked = with_rank(df, ["v"], "pos")
    assert all(r.pos == r.v for r in ranked.collect())
    left = materialize(df.union(spark.createDataFrame([(None, -1), ("zz", -2)], "k string, v int")))
    right = spark.createDataFrame([(f"k{i}", i * 10) for i in range(5)], "k string, w int")
    assert rows(join_unique(left, right, "k", 10).select("k", "v", "w")) == rows(left.join(right, "k", "left").select("k", "v", "w"))


def test_cheapest_cover_matches_brute_force():
    from itertools import product

    rng = random.Random(4)
    for _ in range(20):
        options = {f"{a}{d}": (rng.randrange(1, 9) * (d + 1), frozenset(s for s in "uvwxyz" if rng.random() < 0.3 * (d + 1))) for a in "ABC" for d in range(3)}
        arms = {o: o[0] for o in options}
        need = {s: 1 for s in "uvwx"}
        best = None
        for combo in product(*[[None, *[o for o in options if o[0] == a]] for a in "ABC"]):
            chosen = [o for o in combo if o]
            if set("uvwx") <= set().union(*[options[o][1] for o in chosen], set()):
                key = (sum(options[o][0] for o in chosen), len(chosen), sorted(chosen))
                best = key if best is None or key < best else best
        got = V.cheapest_cover(options, arms, need)
        assert got == (None if best is None else (best[0], best[2]))
