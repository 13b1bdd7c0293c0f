import random

import pytest

from lexmesh.functions import scorers as S


def slow_common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


@pytest.mark.parametrize("seed", range(5))
def test_common_length_is_exact(seed):
    rng = random.Random(seed)
    for _ in range(60):
        a, b = ("".join(rng.choices("abcé ", k=rng.randrange(12))) for _ in range(2))
        assert S.common_length(a, b) == slow_common(a, b)
        assert S.ratio(a, b) == pytest.approx(S.ratio(b, a)) and 0 <= S.weighted_ratio(a, b) <= 100
        assert S.partial_ratio(a, b) >= S.ratio(a, b) * min(len(a), len(b)) / max(len(a), len(b), 1) - 1e-9


def test_known_scores():
    assert S.ratio("this is a test", "this is a test!") == pytest.approx(96.551724, abs=1e-5)
    assert S.partial_ratio("this is a test", "this is a test!") == 100
    assert S.token_sort_ratio("fuzzy wuzzy was a bear", "wuzzy fuzzy was a bear") == 100
    assert S.token_set_ratio("fuzzy was a bear", "fuzzy fuzzy was a bear") == 100
    assert S.jaro("martha", "marhta") == pytest.approx(94.444444, abs=1e-5) and S.jaro("abc", "xyz") == 0
    assert S.quick_ratio("", "") == S.weighted_ratio("", "x") == 0 and S.ratio("", "") == 100


def test_scorers_take_nulls_and_accents(spark):
    df = spark.createDataFrame([("été", "ete"), (None, "x"), (None, None)], "a string, b string")
    got = df.select(*[S.scored(n, df["a"], df["b"]).alias(n) for n in S.SCORERS]).collect()
    assert got[0]["ratio"] == pytest.approx(100 / 3) and got[1]["quick_ratio"] == 0 and got[2]["ratio"] == 100
