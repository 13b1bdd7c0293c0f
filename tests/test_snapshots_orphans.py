from datetime import datetime as D

import pytest

from lexmesh.operators.orphans import orphan_references, unmatched
from lexmesh.operators.snapshots import snapshot_changes

from .conftest import rows

SNAP = "id string, release string, scheme string, definition string, notes array<string>, notations array<string>, record_status string, content_digest binary, delivered_at timestamp_ntz, nth int"
REL = "id string, issued string"


def snap(i, r, d="d", notes=None, at=1, status="active", n=None):
    return (i, r, "s", d, notes, n, status, None, D(2024, 1, at), 7)


def changes(spark, data, releases):
    return rows(snapshot_changes(spark.createDataFrame(data, SNAP), spark.createDataFrame(releases, REL)).select("release", "id", "change_kind", "changed_columns"))


def test_changes_between_delivered_releases(spark):
    releases = [("r10", "2024-01-01"), ("r2", "2024-02-01T00:00:00Z"), ("r3", "2024-03-01T00:00:00.000Z"), ("gap", "2024-02-15T00:00:00+00:00"), (None, None)]
    data = [snap("a", "r10"), snap("a", "r2", "new"), snap(" a\t", "r3", "new"), snap("b", "r10"), snap("b", "r3"), snap("c", "r2"), snap(None, "r2"), snap("d", "r10", notes=None), snap("d", "r2", notes=[]), snap("d", "r3", notes=[None])]
    assert changes(spark, data, releases) == sorted([
        ("r2", "a", "changed", "definition"), ("r2", "b", "removed", None), ("r3", "b", "added", None), ("r2", "c", "added", None), ("r3", "c", "removed", None), ("r2", "d", "changed", "notes"), ("r3", "d", "changed", "notes"),
    ], key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_latest_delivery_counts(spark):
    releases = [("r1", "2024-01-01"), ("r2", "2024-02-01")]
    data = [snap("a", "r1"), snap("a", "r2", "x", at=2), snap("a", "r2", "d", at=3), snap("b", "r1"), snap("b", "r2", "d", at=2), snap("b", "r2", "y", at=5), *[snap("b", "r2", "d", at=2)] * 50]
    assert changes(spark, data, releases) == [("r2", "b", "changed", "definition")]


def test_tied_deliveries_do_not_depend_on_order(spark):
    releases = [("r1", "2024-01-01"), ("r2", "2024-02-01")]
    data = [snap("a", "r1"), snap("a", "r2", "x"), snap("a", "r2", "d")]
    assert changes(spark, data, releases) == changes(spark, data[::-1], releases)


def test_snapshots_empty_and_single(spark):
    assert changes(spark, [], [("r1", "2024-01-01")]) == []
    assert changes(spark, [snap("a", "r1")], [("r1", "2024-01-01")]) == []
    assert changes(spark, [snap("a", "r1")], []) == []


RES = "id string, record_status string, loaded_at timestamp_ntz, key string"
ST = "id string, statement_type string, subject string, object string, loaded_at timestamp_ntz"
EV = "id string, statement string, loaded_at timestamp_ntz"
LB = "id string, resource string, loaded_at timestamp_ntz"


@pytest.mark.parametrize("hot", [500_000, 2])
def test_orphans(spark, hot):
    t = [D(2024, 1, i) for i in range(1, 9)]
    res = [("a", "active", t[0], "x"), ("a", "active", t[6], "x"), ("gone", " Withdrawn\t", t[0], "x"), ("slow", None, t[6], "x"), ("back", "deleted", t[0], "x"), ("back", "active", t[1], "x"), (None, None, None, None)]
    st = [("s1", "MappingAssertion", " a\n", "nowhere", t[3]), ("s2", "SourceAssignment", "record", "gone", t[3]), ("s3", "X", "slow", "", t[3]), ("s3", "X", "slow", "", t[4]), ("s4", "X", "back", "a", None), ("s5", None, None, "a", t[1])]
    ev = [("e1", "s1", t[4]), ("e2", "s1", t[1]), ("e3", "s9", t[1]), ("e4", None, t[1])] + [(f"h{i}", "s1", t[5]) for i in range(5)]
    lb = [("l1", "slow", t[7]), ("l2", "slow", t[2]), ("l3", "gone ", t[2])]
    got = orphan_references(spark.createDataFrame(res, RES), spark.createDataFrame(st, ST), spark.createDataFrame(ev, EV), spark.createDataFrame(lb, LB), hot_rows=hot)
    assert rows(got.select("referring_field", "record_id", "orphan_kind")) == [
        ("object", "s1", "missing"), ("object", "s2", "deleted"), ("object", "s3", "missing"), ("resource", "l2", "late"), ("resource", "l3", "deleted"), ("statement", "e2", "late"), ("statement", "e3", "missing"), ("subject", "s3", "late"),
    ]


def test_orphans_empty(spark):
    got = orphan_references(*[spark.createDataFrame([], s) for s in (RES, ST, EV, LB)])
    assert got.count() == 0


def brute_unmatched(refs, targets, match):
    out = []
    for r in refs:
        here = [i for i, x in enumerate(r) if x is not None]
        if not here or (match == "simple" and len(here) < len(r)):
            continue
        if match == "full" and len(here) < len(r):
            out.append(r)
        elif not any(all(t[i] == r[i] for i in here) for t in targets):
            out.append(r)
    return sorted(out, key=lambda t: tuple((x is not None, str(x)) for x in t))


@pytest.mark.parametrize("match", ["simple", "partial", "full"])
def test_composite_keys_with_nulls(spark, match):
    vals = [None, "a", "b"]
    refs = [(x, y) for x in vals for y in vals] * 2
    targets = [("a", "a"), ("b", None), (None, "a")]
    got = unmatched(spark.createDataFrame(refs, "x string, y string"), spark.createDataFrame(targets, "p string, q string"), [("x", "p"), ("y", "q")], match)
    assert rows(got) == brute_unmatched(refs, targets, match)
    with pytest.raises(ValueError):
        unmatched(got, got, [], "other")
