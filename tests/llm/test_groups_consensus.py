import random
from datetime import datetime as D

import pytest

from lexmesh.llm.consensus import RELATIONS, consensus
from lexmesh.llm.groups import all_concept_groups, concept_groups, group_pairs

from ..conftest import rows
from ..test_graph import random_pairs, smallest

MAP = "source_concept string, target_concept string, relation string, lifecycle_status string, node string, root int"


@pytest.mark.parametrize("cell", [600_000, 7])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_groups_match_brute_force(spark, seed, cell):
    pairs = random_pairs(seed, 60, 55)
    hub = [("hub", f"n{i:02d}") for i in range(20)] if seed == 3 else []
    df = spark.createDataFrame(pairs + hub, "a string, b string").repartition(5)
    assert rows(group_pairs(df.filter("a <> b"), "a", "b", cell_edges=cell, hot_rows=9)) == smallest(pairs + hub)


def test_long_chain_in_small_cells(spark):
    pairs = [(f"n{i:03d}", f"n{i + 1:03d}") for i in range(150)]
    random.Random(0).shuffle(pairs)
    got = group_pairs(spark.createDataFrame(pairs, "a string, b string").repartition(8), "a", "b", cell_edges=9, hot_rows=30)
    assert {r.root for r in got.collect()} == {"n000"} and got.count() == 151


def test_exact_match_spellings(spark):
    names = ["exactMatch", " skos:exactMatch", "EXACT_MATCH", "exact-match", "exact match\t", "https://x.y/core#exactMatch", "Skos:ExactMatch"]
    other = ["exactMatchCandidate", "notExactMatch", "closeMatch", None, ""]
    data = [(f"c{i} ", f"\td{i}", r, "current", None, 1) for i, r in enumerate(names + other)] + [("w", "v", "exactMatch", "withdrawn", None, 1), ("s", " s", "exactMatch", "current", None, 1), (None, "z", "exactMatch", "current", None, 1)]
    df = spark.createDataFrame(data, MAP)
    want = sorted((x, f"c{i}") for i in range(len(names)) for x in (f"c{i}", f"d{i}"))
    assert rows(concept_groups(df)) == want
    every = {r.concept: r.group_id for r in all_concept_groups(df).collect()}
    assert every["w"] == "w" and every["z"] == "z" and every["d0"] == "c0" and None not in every
    assert concept_groups(df.filter("false")).count() == 0


VER = "row_id long, reviewer string, relation_exists boolean, best_relation string, confidence string, judged_at timestamp_ntz, item string"


def verdict(i, who, said, exists=True, conf="high", at=1):
    return (i, who, exists if said != "unrelated" else False, said, conf, D(2024, 1, at), "x")


def test_consensus_beats_majority_with_bad_annotators(spark):
    rng = random.Random(3)
    data, truth = [], {}
    for i in range(220):
        truth[i] = rng.choice(RELATIONS)
        for g in range(3):
            data.append(verdict(i, f"good{g}", truth[i] if rng.random() < 0.92 else rng.choice(RELATIONS)))
        data += [verdict(i, f"const{k}", "related") for k in range(3)]
        swap = {"target_is_broader": "target_is_narrower", "target_is_narrower": "target_is_broader"}
        data.append(verdict(i, "swaps", swap.get(truth[i], truth[i])))
    items, people = consensus(spark.createDataFrame(data, VER))
    found = {r.row_id: r for r in items.collect()}
    right = sum(found[i].best_relation == truth[i] for i in truth) / len(truth)
    plain = 0
    for i in truth:
        said = [d[3] for d in data if d[0] == i]
        plain += max(sorted(set(said)), key=said.count) == truth[i]
    assert right > 0.95 and right > plain / len(truth)
    rel = {r.reviewer: r.reliability for r in people.collect()}
    assert rel["good0"] > 0.8 > 0.4 > rel["const0"] and all(0 <= r.agreement <= 1 for r in found.values())


def test_consensus_edge_cases(spark):
    data = [verdict(1, "a", "same"), verdict(1, "a", "related", at=5), verdict(1, "a", "related", at=5), verdict(2, None, None, exists=False), verdict(3, "a", None, exists=None, conf=None), verdict(None, "a", "same"), verdict(4, "b", "Near-Same "), (4, "c", None, "targetIsBroader", None, None, "x")]
    items, people = consensus(spark.createDataFrame(data, VER))
    got = {r.row_id: r for r in items.collect()}
    assert set(got) == {1, 2, 3, 4} and all(r.best_relation in RELATIONS for r in got.values())
    assert got[1].reviewers == 1 and got[3].agreement is None
    empty, none = consensus(spark.createDataFrame([], VER))
    assert empty.count() == 0 and none.count() == 0


def test_many_annotators_give_the_same(spark):
    rng = random.Random(9)
    data = [verdict(i, f"r{a}", rng.choice(RELATIONS) if rng.random() < 0.3 else RELATIONS[i % 6], conf=rng.choice(["high", "low", None])) for i in range(30) for a in range(4)]
    df = spark.createDataFrame(data, VER)
    few, many = consensus(df, tolerance=0.2), consensus(df, tolerance=0.2, table_annotators=2)
    for a, b in zip(few, many, strict=True):
        for x, y in zip(rows(a), rows(b), strict=True):
            assert all(p == q or abs(p - q) < 1e-9 for p, q in zip(x, y, strict=True)), (x, y)
