import random
from itertools import permutations

import numpy as np
import pytest

from lexmesh.llm import matching as M
from lexmesh.llm.lookalike import alike_pairs, canonical_labels

from ..conftest import rows

LAB = "id string, resource string, language string, value string, canonical string"


def found(spark, data, **how):
    return rows(alike_pairs(canonical_labels(spark.createDataFrame([(*d, "x") for d in data], LAB)), **how))


def test_same_looks(spark):
    base = "Kelp office, class 2"
    alike = ["Ｋｅｌｐ office, class 2", "Kelp office, class 2", " Kelp office, class 2​", "Kelp oﬃce, class 2", "Кеlр οffice, class 2", "Kelp  office, class ２", "Ke­lp office， class 2"]
    visible = ["kelp office, class 2", "Kelp óffice, class 2", "Kelp office, class ²", "Kelp office, class ₂", "Kelp office. class 2", "Kelp-office, class 2", "Kelp office class 2"]
    data = [("l00", "r", "en", base)] + [(f"l{i + 1:02d}", "r", "EN-gb", v) for i, v in enumerate(alike)] + [(f"v{i}", "r", "en", v) for i, v in enumerate(visible)]
    got = found(spark, data)
    assert {x for p in got for x in p} == {f"l{i:02d}" for i in range(len(alike) + 1)} and len(got) == 28


def test_accents_scripts_and_keys(spark):
    data = [
        ("a1", "r", "el", "όρος"), ("a2", " r\t", "el", "óρος"), ("a3", "r", "ru", "όρος"), ("b1", "q", "fr", "été"), ("b2", "q", "fr", "ét​é"), ("b3", "q", "fr", "ete"),
        ("c1", "p", None, ""), ("c2", "p", None, "​ "), ("d1", "q", "fr", "été"), ("d1", "q", "fr", "été"), ("e1", "q", "fr", None), (None, "q", "fr", "été"), ("f1", "o", "ru", "мой-дом"), ("f2", "o", "ru", "мой‐дом"),
    ]
    assert found(spark, data) == [("a1", "a2"), ("b1", "b2"), ("b2", "d1"), ("c1", "c2"), ("f1", "f2")]


def test_large_groups_split_alike(spark):
    data = [(f"l{i:03d}", "r", "en", "kelp" + "​" * (i % 5)) for i in range(60)]
    assert found(spark, data, group_rows=7) == found(spark, data)
    assert found(spark, []) == []


@pytest.mark.parametrize("seed", range(6))
def test_assignment_is_optimal(seed):
    rng = np.random.default_rng(seed)
    n, m = rng.integers(1, 5, 2)
    w = np.where(rng.random((n, m)) < 0.6, rng.random((n, m)), 0)
    got = M.best_assignment(w)
    assert len({i for i, _ in got}) == len(got) == len({j for _, j in got})
    small, big = (w, m) if n <= m else (w.T, n)
    best = max(sum(small[i, p[i]] for i in range(small.shape[0])) for p in permutations(range(big), small.shape[0]))
    assert sum(w[i, j] for i, j in got) == pytest.approx(best)


def test_auction_reaches_the_assignment(spark):
    rng = random.Random(5)
    edges = [(f"a{i}", f"b{j}", round(rng.random(), 3)) for i in range(6) for j in range(6) if rng.random() < 0.6]
    got = M.auction(spark.createDataFrame(edges, "l string, r string, w double"), step=1e-3).collect()
    w = np.zeros((6, 6))
    for a, b, x in edges:
        w[int(a[1]), int(b[1])] = x
    best = sum(w[i, j] for i, j in M.best_assignment(w))
    assert len({r.l for r in got}) == len(got) == len({r.r for r in got})
    assert sum(r.w for r in got) >= best - 6 * 1e-3 - 1e-9


def test_edits():
    assert [M.edits("kelp", x, 2) for x in ("kelp", "klep", "kep", "kxxp", "xyz")] == [0, 1, 1, 2, 3]


RES = "id string, scheme string, definition string, source string"
LB = "resource string, value string, names string"


def world(n, seed=1):
    rng = random.Random(seed)
    syl = [c + v for c in "bdfgklmnprstvz" for v in "aeiou"]
    word = lambda k: "".join(rng.choices(syl, k=k)).capitalize()
    topics, uses = ["kelp cover", "road freight", "soil acidity", "river silt", "night noise"], ["zone reserves", "date dredging", "pay arrears", "advise growers"]
    res, lab, truth = [], [], set()
    for i in range(n):
        place, year, name, topic, use = word(3), rng.randrange(1850, 2020), word(4), rng.choice(topics), rng.choice(uses)
        for s in ("A", "B"):
            kind = rng.random()
            own = name if kind < 0.8 else name[:3] + name[4] + name[3] + name[5:]
            text = f"In {year}, {place} began tracking {topic}, chiefly to {use}." if s == "A" else f"Concerns {topic}. Origin: {place}, {year}. Purpose: {use}."
            if rng.random() < 0.15:
                text = f"Concerns {topic}. Purpose: {use}."
            res.append((f"{s}{i:04d}", s, text, "clash"))
            lab.append((f" {s}{i:04d}", f"{own} register" if s == "A" else f"{own.upper()} REGISTER", "x"))
        truth.add((f"A{i:04d}", f"B{i:04d}"))
        if i % 4 == 0:  # another thing with an equal name
            res.append((f"B9{i:03d}", "B", f"Concerns {rng.choice(topics)}. Origin: {word(3)}, {rng.randrange(1850, 2020)}. Purpose: {rng.choice(uses)}.", "clash"))
            lab.append((f"B9{i:03d}", f"{name} register", "x"))
    return res, lab, truth


def test_matching_precision_and_recall(spark):
    res, lab, truth = world(220)
    res += [("B-null", "B", None, None), ("C1", "C", res[0][2], None), (res[0][0], res[0][1], res[0][2], "again")]
    got = M.match_entities(spark.createDataFrame(res, RES), spark.createDataFrame([*lab, (None, "x", "y"), ("A0000", None, "y")], LB), ["A", "B"]).collect()
    pairs = {(r.id_1, r.id_2) for r in got}
    assert len({a for a, _ in pairs}) == len(pairs) == len({b for _, b in pairs})
    assert len(pairs & truth) / len(pairs) > 0.95 and len(pairs & truth) / len(truth) > 0.9
    assert all(0.75 <= r.confidence <= 1 for r in got)


def test_windows_cross_task_borders(spark):
    res, lab, _ = world(60, 2)
    texts = M.source_records(spark.createDataFrame(res, RES), spark.createDataFrame(lab, LB), ["A", "B"])
    said, called = M.common_words(texts, "said", 120), M.common_words(texts, "called", 120)
    records = texts.mapInArrow(M._split(said, called), M._RECORD)
    a, b = (rows(M.window_pairs(M.sort_rows(records), 8, n).select("id_1", "id_2")) for n in (20_000, 11))
    assert a == b and a


def test_matching_empty(spark):
    assert M.match_entities(spark.createDataFrame([], RES), spark.createDataFrame([], LB), ["A", "B"]).count() == 0


def test_confusables_tie_scripts_not_letters_of_one(spark):
    from lexmesh.llm.lookalike import Classes, cross_script_ties, prototypes

    classes = Classes()
    confusable = prototypes(spark, set("aοσоoАAΑɑ"))
    cross_script_ties(confusable, classes)
    same = lambda a, b: classes.find(a) == classes.find(b)
    assert same("o", "о") and same("A", "А") and same("A", "Α")
    assert not same("ο", "σ") and not same("a", "A") and not same("a", "ɑ")
    assert prototypes(spark, set()) == {}


def test_members_stand_for_pairs(spark):
    data = [("l1", "r", "en", "kelp"), ("l2", "r", "EN", "kеlp"), ("l3", "r", "en", "kelp "), ("l4", "r", "en", "weed"), ("l5", "r", "en", "weed"), ("l2", "r", "EN", "kеlp")]
    from lexmesh.llm.lookalike import alike_members

    assert rows(alike_members(canonical_labels(spark.createDataFrame([(*d, "x") for d in data], LAB)))) == [("l1", "l1", 3), ("l2", "l1", 3), ("l3", "l1", 3)]
