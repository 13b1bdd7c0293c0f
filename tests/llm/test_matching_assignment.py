import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmesh.llm import matching as M

from ..conftest import rows


@pytest.mark.parametrize(("n", "m"), [(21, 20), (600, 600), (600, 300), (1, 5)])
def test_tied_rivals_are_all_placed(n, m):
    assert len(M.best_assignment(np.ones((n, m)))) == min(n, m)


def hungarian(cost):
    """Plain textbook assignment of all rows, for comparison."""
    n = len(cost)
    best = {0: 0.0}
    for i in range(n):
        step = {}
        for used, total in best.items():
            for j in range(n):
                if not used >> j & 1:
                    k = used | 1 << j
                    step[k] = max(step.get(k, -1.0), total + cost[i, j])
        best = step
    return max(best.values())


@pytest.mark.parametrize("seed", range(4))
def test_dense_groups_are_optimal(seed):
    w = np.random.default_rng(seed).choice([0.0, 0.75, 0.8, 0.81, 0.9], (11, 11))
    got = M.best_assignment(w)
    assert sum(w[i, j] for i, j in got) == pytest.approx(hungarian(w))
    assert len({i for i, _ in got}) == len(got) == len({j for _, j in got})


def test_sides_are_told_by_source(spark):
    # b is the smaller id of one pair and the greater of the other: still one record of its source
    scored = spark.createDataFrame([("a", "b", "S", "T", 0.9), ("b", "c", "T", "S", 0.95), ("c", "d", "S", "T", 0.8), ("a", "e", "S", "U", 0.9), ("x", "y", "S", "T", 0.5)], "id_1 string, id_2 string, source_1 string, source_2 string, confidence double")
    assert [(a, b) for a, b, _ in rows(M.assign(scored))] == [("a", "b"), ("a", "e"), ("c", "d")]


def test_large_groups_meet_the_auction(spark):
    scored = spark.createDataFrame([(f"a{i}", f"b{j}", "S", "T", 0.9 + 0.01 * (i == j)) for i in range(5) for j in range(5)], "id_1 string, id_2 string, source_1 string, source_2 string, confidence double")
    assert rows(M.assign(scored, group_pairs_most=3)) == rows(M.assign(scored))


def test_short_words_and_numbers_count(spark):
    texts = spark.createDataFrame([("1", "A", ["x9", "ab", "1850", "12"], ["ox", "b2"])], "id string, source string, said array<string>, called array<string>")
    row = texts.mapInArrow(M._split({}, {}), M._RECORD).first()
    assert (row.terms, row.numbers, row.names) == (["ab"], ["x9", "1850", "12"], ["ox", "b2"])


def test_every_record_has_a_place(spark):
    records = spark.createDataFrame([("1", "A", [], [], [], [3], []), ("2", "B", [], [], [], [3], [1]), ("3", "B", [], [], [], [], [])], M._RECORD)
    assert {r.id for r in M.sort_rows(records).collect()} == {"1", "2"}
    assert M.window_pairs(M.sort_rows(records)).select("id_1", "id_2", F.col("said_1").isNull()).collect() == [("1", "2", True)]


def test_weights_never_fall_with_agreement():
    rng = np.random.default_rng(1)
    patterns = {}
    for _ in range(4000):
        same = rng.random() < 0.3
        key = (int(rng.choice([1, 2, 3], p=[0.8, 0.1, 0.1] if same else [0.1, 0.1, 0.8])), int(rng.choice([0, 1, 3], p=[0.3, 0.6, 0.1] if same else [0.3, 0.1, 0.6])), int(rng.choice([1, 3])), int(rng.integers(5, 11) if same else rng.integers(1, 7)), 0)
        patterns[key] = patterns.get(key, 0) + 1
    prior, odds = M.learn_weights(patterns)
    assert odds["terms"][1] >= odds["terms"][2] >= odds["terms"][3] and odds["terms"][1] > 1 and odds["numbers"][1] > 1 > -1 > odds["numbers"][3]
    assert all(a <= b + 1e-9 for a, b in zip(odds["said"][1:], odds["said"][2:], strict=False)) and -2 < prior < 0
    assert M.learn_weights({(1, 1, 1, 1, 1): 3.0})[0] == M.PRIOR
    assert M.learn_weights({})[0] == M.PRIOR


def test_records_without_number_meet_all_of_their_word(spark):
    # forty records of a word, ordered by year: the one without year stands far from the one of its name
    many = [(f"{i:02d}", "A", ["vodi"], [f"{1900 + i}"], [f"{i:02d}x"], [], []) for i in range(40)]
    records = spark.createDataFrame([*many, ("99", "B", ["vodi"], [], ["39x"], [], [])], M._RECORD)
    got = rows(M.score_pairs(M.sort_rows(records), records, {}, {}, 41, least=0.0).select("id_1", "id_2"))
    assert got == [(f"{i:02d}", "99") for i in range(40)]


def test_near_words_are_those_of_few_edits():
    rng = np.random.default_rng(3)
    for _ in range(3000):
        x, y = ("".join(rng.choice(list("ab"), rng.integers(4, 12))) for _ in range(2))
        assert M._near_words(x, y, 1) == (M.edits(x, y, 1) <= 1)
        assert not M._near_words(x, y, 2) or M.edits(x, y, 2) <= 2
