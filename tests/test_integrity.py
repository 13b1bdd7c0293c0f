import pytest

from lexmesh.operators import integrity as I

REL = [("R", "AtlasRelease", "sch", "subject", "conceptScheme"), ("S", "SourceRelease", None, None, None)]
RES = [("a", "R", "sch", "subject", "conceptScheme", "rec"), ("b", "R", "sch", "subject", "conceptScheme", "rec")]
LAB = [("la", "a", "preferred", "Alpha", "en", "R", "rec"), ("lb", "b", "preferred", "Beta", "en", "R", "rec")]
STM = [("s", "NativeRelationAssertion", "a", "skos:broader", "b", "R", "R", "subject", None, None, None)]
EVI = [("e", "s", "rec", b"1", "vx:approved", "role", None)]

SCHEMA = {
    "rel": "id string, release_type string, scheme string, semantic_ring string, resource_profile string",
    "res": "id string, release string, scheme string, semantic_ring string, resource_profile string, source_record string",
    "lab": "id string, resource string, label_role string, value string, language string, release string, source_record string",
    "stm": "id string, statement_type string, subject string, predicate string, object string, source_release string, target_release string, semantic_ring string, source_ring string, target_ring string, supersedes_assertion string",
    "evi": "id string, statement string, source_record string, evidence_source_digest binary, decision string, evidence_role string, based_on_attestation string",
}


def codes(spark, **changed):
    data = {"rel": REL, "res": RES, "lab": LAB, "stm": STM, "evi": EVI} | changed
    t = {k: spark.createDataFrame(v, SCHEMA[k]) for k, v in data.items()}
    records = spark.createDataFrame([("rec", b"1")], "id string, digest binary")
    found = I.all_of(
        *[I.not_unique(t[k], f"{k}-identity", "id") for k in t], I.shared_across({k: t[k] for k in t}), I.release_faults(t["rel"], t["res"]), I.label_faults(t["lab"], t["res"]), I.relation_faults(t["stm"], t["res"]), I.statement_faults(t["stm"]),
        I.evidence_faults(t["evi"], t["stm"], records, records, ("role",)),
    )
    return {r.code for r in found.collect()}


def test_valid_bundle(spark):
    assert codes(spark) == set()


@pytest.mark.parametrize(
    "changed, code",
    [
        ({"stm": [(*STM[0][:4], "nowhere", *STM[0][5:])]}, "statement-object"),
        ({"lab": [*LAB, ("lc", "a", "preferred", "Other", "en", "R", "rec")]}, "label-preferred-language"),
        ({"evi": [(*EVI[0][:3], b"2", *EVI[0][4:])]}, "evidence-digest"),
        ({"lab": [("e", *LAB[0][1:]), LAB[1]]}, "cross-role-identity"),
        ({"res": [*RES, RES[0]]}, "res-identity"),
        ({"rel": [*REL, ("T", "Other", None, None, None)]}, "release-type"),
        ({"evi": [(*EVI[0][:4], "vx:deferred", *EVI[0][5:])]}, "evidence-decision"),
        ({"lab": [(*LAB[0][:2], "main", *LAB[0][3:]), LAB[1]]}, "label-role"),
    ],
)
def test_single_faults(spark, changed, code):
    assert codes(spark, **changed) == {code}


def test_cross_ring_rows_are_accepted(spark):
    res = [RES[0], ("b", "Q", "sch", "entity", "conceptScheme", "rec")]
    rel = [*REL, ("Q", "AtlasRelease", "sch", "entity", "conceptScheme")]
    stm = [("s", "CrossRingRelationAssertion", "a", "vx:about", "b", "R", "Q", None, "subject", "entity", None)]
    lab = [LAB[0], (*LAB[1][:5], "Q", "rec")]
    assert codes(spark, res=res, rel=rel, stm=stm, lab=lab) == set()


def test_independent_proofs(spark):
    axes = ("x", "y")
    df = spark.createDataFrame([("q1", "a", "b"), ("q1", "c", "d"), ("q2", "a", "b"), ("q2", "a", "d")], "request string, x string, y string")
    assert [r.key for r in I.independent_proofs(df, axes).collect()] == ["q2"]
