"""Comparison of all pairs by blocks: nothing may depend on how members are cut into blocks."""

import random
from collections import Counter, defaultdict
from math import isclose, sqrt

import pytest

from lexmesh.operators import candidates as C


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)
    words = ["tide", "gauge", "river", "kelp", "the", "the", "the", "sea", "wave", "level"]
    make = lambda side: spark.createDataFrame([(f"{side}{i:02d}", " ".join(rng.choices(words, k=rng.randrange(4))), rng.choice([1, 4]), "x") for i in range(40)] + [(f"{side}99", "Ωμ", 1, "x")], "member string, value string, weight int, origin string")
    return make("A"), make("B")


def entries(side):
    out = defaultdict(dict)
    for r in C.text_features(side).collect():
        out[r.member][r.feature] = r.value
    return out


def test_all_pairs_of_any_blocks(spark, sides):
    a, b = (entries(s) for s in sides)
    df = Counter(f for side in (a, b) for x in side.values() for f in x)
    n = len(a) + len(b)
    w = lambda x: {f: v * max(1, (n + 1) * 1024 // (df[f] + 1)) for f, v in x.items()}
    a, b = ({m: w(x) for m, x in side.items()} for side in (a, b))
    norm = lambda x: sqrt(sum(v * v for v in x.values()))
    want = {(s, t): (sum(x[f] * y[f] for f in x.keys() & y.keys()) / norm(x) / norm(y), len(x.keys() & y.keys())) for s, x in a.items() for t, y in b.items() if x.keys() & y.keys()}
    best = {s: sorted(want[p][0] for p in want if p[0] == s)[-2:] for s in a}
    for rows in (7, 1000):
        blocks = C.feature_blocks(*sides, block_rows=rows)
        got = {(r.source, r.target): r.score for r in C.block_pairs(blocks).collect()}
        assert got.keys() == want.keys() and all(isclose(got[p], want[p][0], abs_tol=1e-9) for p in got)
        assert {(r.source, r.target): r.n for r in C.block_pairs(blocks, ones=True).collect()} == {p: x[1] for p, x in want.items()}
        kept = C.best_of(C.block_best(blocks, 2), 2).collect()
        first = {(r.source, r.target) for r in kept if r.source_rank}
        assert len(first) == sum(len(x) for x in best.values()) and all(want[p][0] >= best[p[0]][0] - 1e-8 for p in first)
        assert sorted((r.source, r.target, r.source_rank, r.target_rank) for r in kept if r.source_rank and r.target_rank) == sorted((r.source, r.target, r.source_rank, r.target_rank) for r in C.bidirectional(C.block_pairs(blocks), 2).collect() if r.source_rank and r.target_rank)


def test_no_common_feature_no_pair(spark):
    one = lambda m, v: spark.createDataFrame([(m, v, 1, "x")], "member string, value string, weight int, origin string")
    blocks = C.feature_blocks(one("A", "kelp"), one("B", "Ωμ"))
    assert C.block_pairs(blocks).count() == C.block_pairs(blocks, ones=True).count() == C.block_best(blocks, 5).count() == 0
