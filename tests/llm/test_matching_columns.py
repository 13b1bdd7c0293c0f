import random
import time
from itertools import product

import numpy as np
import pyarrow as pa
import pytest

from lexmesh.llm import matching as M


def lists(rng, n, words, most):
    return [sorted(rng.sample(words, rng.randint(0, most))) for _ in range(n)]


def some_words(rng, n):
    return sorted({"".join(rng.choice("abcé") for _ in range(rng.choice([1, 3, 4, 5, 9, 10, 12]))) for _ in range(n)})


@pytest.mark.parametrize("crossed", [1 << 20, 40, 3])
def test_columns_are_compared_as_rows_are(monkeypatch, crossed):
    monkeypatch.setattr(M, "CROSSED", crossed)
    rng = random.Random(crossed)
    words = some_words(rng, 120)
    words += [w[:-1] + "x" for w in words[::3]] + [w[:1] + w[2:] + "é" for w in words[::4] if len(w) > 8]
    held = lists(rng, 80, sorted(set(words)), 5)
    column = M._Words.of(pa.array(held, pa.list_(pa.string())))
    i, j = (np.array(v) for v in zip(*product(range(80), range(80)), strict=True))
    for most in (1, 2):
        assert column.nearness(i, j, most).tolist() == [M.nearness(held[a], held[b], most) for a, b in zip(i.tolist(), j.tolist(), strict=True)]
    assert column.meet(i, j).tolist() == [not set(held[a]).isdisjoint(held[b]) for a, b in zip(i.tolist(), j.tolist(), strict=True)]


@pytest.mark.parametrize("crossed", [1 << 20, 40, 3])
def test_agreement_of_columns_is_that_of_rows(monkeypatch, crossed):
    monkeypatch.setattr(M, "CROSSED", crossed)
    rng = random.Random(crossed)
    link, weight = np.random.default_rng(1).random((30, 30)), np.random.default_rng(2).random(30) + 0.1
    a, b = (lists(rng, 300, list(range(30)), 6) for _ in range(2))
    codes = [M._Codes(pa.array(x, pa.list_(pa.int32()))) for x in (a, b)]
    assert M.agreements(*codes, link, weight).tolist() == [M.agreement(x, y, link.tolist(), weight.tolist()) for x, y in zip(a, b, strict=True)]


def test_columns_take_a_fraction_of_the_time_of_rows():
    rng = random.Random(5)
    link, weight = np.eye(200), np.ones(200)
    a, b = (lists(rng, 4000, list(range(200)), 16) for _ in range(2))
    codes = [M._Codes(pa.array(x, pa.list_(pa.int32()))) for x in (a, b)]
    M.agreements(*codes, link, weight)
    at = time.process_time()
    M.agreements(*codes, link, weight)
    columns = time.process_time() - at
    rows, w = link.tolist(), weight.tolist()
    at = time.process_time()
    for x, y in zip(a, b, strict=True):
        M.agreement(x, y, rows, w)
    assert columns < 0.6 * (time.process_time() - at)


def test_within_is_edits():
    words = ["".join(p) for n in range(1, 6) for p in product("ab", repeat=n)]
    assert all(M._near_words(x, y, k) == (M.edits(x, y, 5) <= k) for x in words for y in words for k in (1, 2))


def test_common_words_meet_as_counted_row_by_row(spark):
    rng = random.Random(7)
    a, b = (lists(rng, 60, list(range(9)), 4) for _ in range(2))
    met = np.zeros((9, 10))
    for x, y in zip(a, b, strict=True):
        for i, j in product(x, y):
            met[i, j] += 1
            met[j, i] += 1
        for i in x + y:
            met[i, 9] += 1
    pairs = spark.createDataFrame(list(zip(a, b, strict=True)), "x array<int>, y array<int>")
    assert (M._together(pairs, "x", "y", 9) == met).all()
