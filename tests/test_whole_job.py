"""Queries that once did part of their job, on small tables where the missing part shows."""

from collections import Counter
from hashlib import md5
from itertools import pairwise

import __spark_entry__ as entry
from lexmesh.operators import claims as K
from lexmesh.operators import graph as G
from lexmesh.plans.base import SCHEME_A, SCHEME_B

SCHEMES = {"A": SCHEME_A, "B": SCHEME_B}


def run(spark, folder, name, **tables):
    for table, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{table}.parquet")
    return entry.queries()[name](spark, str(folder))


def test_cover_holds_all_gold_of_all_reviewers(spark, tmp_path):
    schema = "row_id long, crosswalk string, best_relation string, relation_exists boolean, confidence string, reviewer string"
    own = [(i, "x", "same", True, "high", f"r-{i}") for i in range(14)]  # 14 signatures of one reviewer each, four ids of two digits
    shared = [(20, "x", "same", True, "medium", "r-3"), (20, "x", "same", True, "high", "r-99"), (21, "x", "near_same", True, "high", "r-99")]
    got = run(spark, tmp_path, "ev8_cheapest_cover", relation_verdicts=spark.createDataFrame(own + shared, schema)).collect()
    assert {r.option: r.cost for r in got} == {f"r-{i}": 2 if i == 3 else 1 for i in range(14)}


def test_chain_of_any_length_is_resolved(spark):
    links = [(f"n{i}", f"n{i + 1}") for i in range(300)] + [(f"c{i}", f"c{(i + 1) % 5}") for i in range(5)] + [("t", "c0"), ("u", "f"), ("f", "p"), ("f", "q")]
    got = {r.start: (r.sink, r.steps, r.outcome) for r in G.follow_chain(spark.createDataFrame(links, "a string, b string")).collect()}
    assert got == {f"n{i}": ("n300", 300 - i, "resolved") for i in range(300)} | {x: (None, None, "cycle") for x in ("c0", "c1", "c2", "c3", "c4", "t")} | {"u": ("f", 1, "branch")}


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


#: Labels of equal length outside ASCII, accents against other accents, and one equal pair.
WORDS = {"A": ["αλφα", "été", "Ｗide", "мост", "naïve"], "B": ["βητα", "ète", "Ｗide", "мясо", "naive", "лист"]}


def labelled(spark):
    rows = [(f"{side}{i}", SCHEMES[side], None, "r", w) for side, words in WORDS.items() for i, w in enumerate(words)]
    res = spark.createDataFrame([(i, s, d, r, []) for i, s, d, r, _ in rows], "id string, scheme string, definition string, release string, notations array<string>")
    more = [("A0", "ωμεγα"), ("A3", "моет")]
    lab = spark.createDataFrame([(f"l{n}", i, "preferred", w, "en", "r") for n, (i, _, _, _, w) in enumerate(rows)] + [(f"m{n}", i, "alternate", w, "en", "r") for n, (i, w) in enumerate(more)], "id string, resource string, label_role string, value string, language string, release string")
    sta = spark.createDataFrame([], "subject string, predicate string, object string")
    return {"atlas_resources": res, "atlas_labels": lab, "atlas_statements": sta}


def test_labels_outside_ascii_stay_themselves(spark, tmp_path):
    tables = labelled(spark)
    near = {(f"A{i}", f"B{j}", d) for i, x in enumerate(WORDS["A"]) for j, y in enumerate(WORDS["B"]) if 1 <= (d := edits(x.lower(), y.lower())) <= 2}
    assert ("A1", "B1", 2) in near and ("A0", "B0") not in {n[:2] for n in near}
    assert {tuple(r) for r in run(spark, tmp_path, "jn19_near_in_edits_unmasked", **tables).select("source", "target", "distance").collect()} == near
    found = {(r.source, r.target): r.generation_class for r in run(spark, tmp_path, "cg7_candidate_classes_unmasked").collect()}
    assert found == {("A2", "B2"): "normalizedLabelEquality"} | {(a, b): "editDistanceNearMiss" for a, b, _ in near}
    assert {(r["class"], r.n) for r in run(spark, tmp_path, "wn12_class_counts_unmasked").collect()} == {(0, 1)}
    pairs = {tuple(sorted(p)) for p in (("αλφα", "ωμεγα"), ("мост", "моет"))}
    got = {(r.a, r.b): r.distance for r in run(spark, tmp_path, "sf16_edit_distance_unmasked").collect()}
    assert got == {p: edits(*p) for p in pairs}
    for name in ("sf17_token_set", "sf17_jaro_winkler_unmasked", "sf17_edit_ratio_unmasked", "sf17_token_sort_unmasked", "sf18_jaccard_unmasked", "sf15_variant_classes_unmasked", "sf20_challenge_classes_unmasked"):
        assert {(r.a, r.b) for r in run(spark, tmp_path, name).collect()} == pairs


def test_features_of_all_fields(spark, tmp_path):
    concepts = {"urn:a:tide-gauge": ("Tide Gauge", ["tide tide tide tide meter"], "a gauge", ["used at sea"]), "urn:a:device": ("Device", ["tool"], None, []), "urn:a:other": ("Device", [], None, []), "urn:a:buoy": ("Buoy", ["float"], None, [])}
    up = [("urn:a:tide-gauge", "urn:a:device"), ("urn:a:tide-gauge", "urn:a:other"), ("urn:a:buoy", "urn:a:tide-gauge")]
    res = spark.createDataFrame([(i, SCHEME_A, d, n) for i, (_, _, d, n) in concepts.items()] + [("urn:b:sea", SCHEME_B, None, [])], "id string, scheme string, definition string, notes array<string>")
    said = [(i, r, v) for i, (p, alts, _, _) in concepts.items() for r, v in [("preferred", p), *[("alternate", x) for x in alts]]] + [("urn:b:sea", "preferred", "zzz sea")]
    tables = {"atlas_resources": res, "atlas_labels": spark.createDataFrame([(f"l{n}", *x, "en") for n, x in enumerate(said)], "id string, resource string, label_role string, value string, language string")}
    tables["atlas_statements"] = spark.createDataFrame([(a, "skos:broader", b) for a, b in up], "subject string, predicate string, object string")

    want = Counter()

    def add(text, weight):
        words = text.lower().split() if text else []
        phrase = " ".join(words)
        for name, seen, times, cap in (("word:", words, 1, 3), ("bigram:", [f"{x} {y}" for x, y in pairwise(words)], 1, 99), ("phrase:", [phrase] if words else [], 2, 99), *[(f"char{g}:", [f"  {phrase}  "[i : i + g] for i in range(len(phrase) + 5 - g)] if words else [], 1, 3) for g in (3, 4)]):
            for k, n in Counter(seen).items():
                want[name + k] += weight * times * min(n, cap)

    def context(i, weight):
        add(concepts[i][0], weight)
        for alt in concepts[i][1]:
            add(alt, weight // 2)

    add("Tide Gauge", 12)
    add("tide tide tide tide meter", 9)
    add("tide gauge", 7)
    add("a gauge", 2)
    add("used at sea", 3)
    for parent in ("urn:a:device", "urn:a:other"):
        context(parent, 5)
    context("urn:a:buoy", 5)
    got = {r.feature: r.value for r in run(spark, tmp_path, "cg1_features_all_fields", **tables).collect() if r.member == "urn:a:tide-gauge"}
    assert got == dict(want)
    # a scope note is all that the sides share
    assert ("urn:a:tide-gauge", "urn:b:sea") in {(r.source, r.target) for r in run(spark, tmp_path, "cg3_sparse_scores_all_fields").collect()}


def test_fuzzy_ranks_cross_both_sides(spark, tmp_path):
    def text(w):
        return " ".join(w.lower().split())

    sides = {"A": {f"A{i:02d}": w for i, w in enumerate(["tide gauge", "river", "sea level", "wave", "météo"] * 6)}, "B": {f"B{i:02d}": w for i, w in enumerate(["tidal gauge", "rivers", "level of sea", "meteo"] * 6)}}
    every = [(i, SCHEMES[k], None, w) for k, m in sides.items() for i, w in m.items()]
    tables = {"atlas_resources": spark.createDataFrame([x[:3] for x in every], "id string, scheme string, definition string"), "atlas_labels": spark.createDataFrame([(i, i, "preferred", w, "en") for i, _, _, w in every], "id string, resource string, label_role string, value string, language string")}
    got = run(spark, tmp_path, "cg14_fuzzy_ranks_both_sides", **tables).collect()
    assert {r.scorer for r in got} == {"jaro_winkler", "edit_ratio", "token_sort", "token_set"}
    asked = {i for i, *_ in every if int(md5(i.encode()).hexdigest()[:4], 16) % 8 == 0}
    ratio = lambda x, y: round(1 - edits(text(x), text(y)) / max(len(x), len(y)), 6)
    want = {}
    for at, (mine, theirs) in enumerate((("A", "B"), ("B", "A"))):
        for q in asked & set(sides[mine]):
            for rank, o in enumerate(sorted(sides[theirs], key=lambda o: (-ratio(sides[mine][q], sides[theirs][o]), o))[:3], 1):
                want.setdefault((q, o) if mine == "A" else (o, q), [None, None])[at] = rank
    assert asked & set(sides["A"]) and asked & set(sides["B"])
    assert {(r.source, r.target): [r.source_rank, r.target_rank] for r in got if r.scorer == "edit_ratio"} == want


def test_all_definitions_of_a_claim_are_kept(spark):
    claims = spark.createDataFrame([("s", "member", "x", None)] + [("s", "definition", f"d{i:04d}", "en") for i in range(1205)] + [("t", "member", "x", None)], "subject string, predicate string, value string, language string")
    got = {r.id: r for r in K.from_claims(claims, "member").collect()}
    assert (got["s"].definition, got["s"].notes.split("|")) == ("d0000", [f"d{i:04d}" for i in range(1, 1205)])
    assert (got["t"].definition, got["t"].notes) == (None, "")
