import pytest
from pyspark.sql import functions as F

from lexmesh.operators import gates as G
from lexmesh.operators.skewjoin import anti_join
from lexmesh.operators.snapshots import SnapshotStore

from .conftest import rows

PAIR = "id int, left string, right string, supported boolean, equal_labels boolean, variants boolean, control boolean"


def test_admission_rules(spark):
    data = [
        (1, "same", "near_same", True, False, False, False), (2, "same", "target_is_broader", True, True, False, False), (3, "same", "target_is_broader", True, False, True, False), (4, "same", "target_is_narrower", True, False, False, False),
        (5, "related", "target_is_broader", True, True, False, True), (6, "same", "same", False, True, True, False), (7, None, "same", True, True, True, False), (8, "target_is_broader", "target_is_narrower", True, True, True, False), (9, "related", "unrelated", True, True, True, False),
    ]
    got = {r.id: [r.r0, r.r1, r.r2, r.r3, r.r4] for r in G.admission(spark.createDataFrame(data, PAIR)).collect()}
    t, f = True, False
    assert got == {1: [t] * 5, 2: [f, t, t, t, t], 3: [f, f, t, t, t], 4: [f, f, t, t, f], 5: [f, f, f, t, f], 6: [f] * 5, 7: [f] * 5, 8: [f] * 5, 9: [f] * 5}
    assert G.admission_counts(spark.createDataFrame([], PAIR), ["control"]).count() == 0


def test_nested_references(spark):
    docs = [("urn:a", '{"x":"urn:b","deep":{"urn:key":["urn:c ",{"y":"urn:c"},"say \\"urn:d\\""]},"self":"urn:a"}'), ("urn:e", "{}"), ("urn:f", None)]
    got = G.reference_closure(spark.createDataFrame(docs, "id string, document string"), spark.createDataFrame([("urn:b",), ("urn:b",)], "identifier string"), "urn:")
    assert rows(got) == [("urn:b", 1, True), ("urn:c", 1, False)]


def test_row_faults_and_budget(spark):
    df = spark.createDataFrame([("a", 1, None), ("b", None, "x"), ("c", -1, None)], "id string, n int, code string")
    assert rows(G.row_faults(df, "id", {"NEGATIVE": F.col("n") < 0, "NO-N": F.col("n").isNull()})) == [("NEGATIVE", "c"), ("NO-N", "b")]
    assert rows(G.null_budget(df, "t", {"n": 0.4, "code": 0.5})) == [("t", "code", 2, 3, False), ("t", "n", 1, 3, True)]
    empty = df.filter("false")
    assert [tuple(r) for r in G.counted_gates([("g", df, df), ("h", df, empty)]).collect()] == [("g", 3, 3, True), ("h", 3, 0, False)]


def test_migrated_rows(spark):
    a = spark.createDataFrame([("1", "x", None), ("2", "x", "p"), ("3", "x", "p")], "id string, scheme string, state string")
    b = spark.createDataFrame([("1", "x", None), ("2", "y", "p"), ("4", "x", "p")], "id string, scheme string, note string").withColumnRenamed("note", "state")
    assert rows(G.migrated_rows(a, b, "id", ["scheme", "state"])) == [("1", "kept"), ("2", "changed"), ("3", "lost"), ("4", "new")]


def test_identity_conflicts(spark):
    data = [("1", "s", "o", "d1"), ("1", "s", "o", "d1"), ("2", "s", "o2", "d2"), ("3", "t", None, "d2"), ("4", "u", "o", "d4"), ("5", "u", "o", "d5"), ("6", "v", "o", None)]
    got = G.identity_conflicts(spark.createDataFrame(data, "id string, subject string, object string, digest string"), ["subject", "object"], "digest")
    assert rows(got) == [("digest-identities", "2"), ("digest-identities", "3"), ("identity-digest-missing", "6"), ("identity-digests", "4"), ("identity-digests", "5")]


@pytest.mark.parametrize("hot", [500_000, 2])
def test_anti_join_with_hot_keys(spark, hot):
    left = spark.createDataFrame([(k, i) for i, k in enumerate("aaaabbbbcd")], "k string, n int")
    right = spark.createDataFrame([("a",), ("d",)], "k string")
    assert [r[0] for r in rows(anti_join(left, right, ["k"], hot))] == ["b"] * 4 + ["c"]


def test_store_merges_only_the_last_delivery(spark, tmp_path):
    cols = "scheme string, id string, _definition string, _notes string, _notations string, _record_status string"
    one = [("s", f"r{i:02d}", "d", None, None, "active") for i in range(20)]
    two = [*one[:5], ("s", "r05", "new", None, None, "active"), *one[7:], ("s", "zz", "d", None, None, None), ("t", "r01", "d", None, None, None)]
    three = two[1:]
    store = SnapshotStore(spark, str(tmp_path / "kept"), ranges=3)
    for k, data in enumerate((one, two, three), 1):
        store.add(spark.createDataFrame(data, cols), k)
    assert rows(store.changes(2).select("scheme", "id", "change_kind", "changed_columns")) == [("s", "r05", "changed", "definition"), ("s", "r06", "removed", None), ("s", "zz", "added", None), ("t", "r01", "added", None)]
    assert rows(store.changes(3).select("id", "change_kind")) == [("r00", "removed")]
