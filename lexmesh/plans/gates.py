"""Queries of gates before a build, managed releases and reference edges, with their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import functions as F

from lexmesh.operators import candidates as C
from lexmesh.operators import gates as G
from lexmesh.plans.base import Atlas, Book
from lexmesh.sources import formats, store
from lexmesh.storage import scratch_dir

B = Book()

# ---- admission of reviewed pairs ------------------------------------------------
_PAIRS = """
    verdict AS (
        SELECT row_id, reviewer, max_by(struct_pack(r := best_relation, e := relation_exists, b := basis_of_association, c := confidence), judged_at) AS v
        FROM (SELECT DISTINCT * FROM relation_verdicts QUALIFY row_number() OVER (PARTITION BY row_id, reviewer ORDER BY judged_at DESC, coalesce(best_relation, ''), coalesce(confidence, '')) = 1) GROUP BY ALL),
    two AS (SELECT row_id, min_by(v, reviewer) AS x, max_by(v, reviewer) AS y FROM verdict GROUP BY 1 HAVING count(*) > 1),
    pair AS (
        SELECT row_id, x.r AS l, y.r AS r, coalesce(x.e AND y.e, false) AS supported, x.b = 'orthographic' AND y.b = 'orthographic' AS equal_labels, x.b <> y.b AS variants,
            coalesce(x.c = 'low' AND y.c = 'low', false) AS control FROM two)
"""
_ALIKE = "(l = r OR (l IN ('same', 'near_same') AND r IN ('same', 'near_same')))"
_DEG = "CASE {0} WHEN 'target_is_broader' THEN -1 WHEN 'same' THEN 0 WHEN 'near_same' THEN 0 WHEN 'target_is_narrower' THEN 1 END"
_STEP = f"coalesce(abs({_DEG.format('l')} - {_DEG.format('r')}) <= 1, false)"
_LOOSE = f"((l = 'related' OR r = 'related') AND ({_DEG.format('l')} IS NOT NULL OR {_DEG.format('r')} IS NOT NULL))"
_RULES = [_ALIKE, f"{_ALIKE} OR (equal_labels AND {_STEP})", f"{_ALIKE} OR {_STEP}", f"{_ALIKE} OR {_STEP} OR {_LOOSE}", f"{_ALIKE} OR ((equal_labels OR variants) AND {_STEP})"]


def _reviewed_pairs(a: Atlas):
    """Rows judged by two reviewers or more: the verdicts of the first and the last of them by name."""
    v = a.table("relation_verdicts")
    said = F.struct(F.col("best_relation").alias("r"), F.col("relation_exists").alias("e"), F.col("basis_of_association").alias("b"), F.col("confidence").alias("c"))
    # latest first; at equal times the smallest relation, then confidence, as text
    late = F.struct((-F.unix_micros(F.col("judged_at").cast("timestamp"))).alias("t"), F.coalesce("best_relation", F.lit("")).alias("r"), F.coalesce("confidence", F.lit("")).alias("c"))
    own = v.groupBy("row_id", "reviewer").agg(F.min_by(said, late).alias("v"))
    two = own.groupBy("row_id").agg(F.min_by("v", "reviewer").alias("x"), F.max_by("v", "reviewer").alias("y"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    return two.select(
        "row_id", F.col("x.r").alias("left"), F.col("y.r").alias("right"), F.coalesce(F.col("x.e") & F.col("y.e"), F.lit(False)).alias("supported"),
        ((F.col("x.b") == "orthographic") & (F.col("y.b") == "orthographic")).alias("equal_labels"), (F.col("x.b") != F.col("y.b")).alias("variants"), F.coalesce((F.col("x.c") == "low") & (F.col("y.c") == "low"), F.lit(False)).alias("control"),
    )


B.add(
    "ev11_admission_lattice",
    f"WITH {_PAIRS} SELECT control, count(*) AS pairs, " + ", ".join(f"count(*) FILTER (supported AND coalesce({rule}, false)) AS r{i}" for i, rule in enumerate(_RULES)) + " FROM pair GROUP BY 1",
)(lambda a: G.admission_counts(_reviewed_pairs(a), ["control"]))
B.add(
    "ev11_admitted_by_wider_rules",
    f"WITH {_PAIRS} SELECT row_id, coalesce({_RULES[1]}, false) AS r1, coalesce({_RULES[4]}, false) AS r4 FROM pair WHERE supported AND NOT control AND coalesce({_RULES[3]}, false) AND NOT coalesce({_RULES[0]}, false)",
)(lambda a: G.admission(_reviewed_pairs(a)).filter("r3 AND NOT r0 AND NOT control").select("row_id", "r1", "r4"))

# ---- references anywhere in a record ----------------------------------------------
B.add(
    "gr19_reference_closure",
    """WITH named AS (
        SELECT id, unnest(evidence) AS x FROM mapping_assertions UNION ALL SELECT id, unnest(supersedes) FROM mapping_assertions
        UNION ALL SELECT id, unnest([semantic_ring, source_concept, target_concept, source_release, target_release, relation, asserted_at, lifecycle_status]) FROM mapping_assertions),
    one AS (SELECT DISTINCT id, trim(x, chr(32) || chr(9) || chr(10)) AS identifier FROM named WHERE x IS NOT NULL),
    known AS (SELECT trim(id) AS k FROM mapping_assertions UNION SELECT trim(id) FROM atlas_resources UNION SELECT trim(id) FROM atlas_releases)
    SELECT identifier, count(*) AS records, identifier IN (SELECT k FROM known) AS defined FROM one WHERE starts_with(identifier, 'urn:vx:') AND identifier <> trim(id) GROUP BY 1""",
)(lambda a: _closure(a))


def _closure(a: Atlas):
    m = a.table("mapping_assertions")
    records = m.select("id", F.to_json(F.struct([c for c in m.columns if c != "id"])).alias("document")).distinct()
    ids = [d.select(F.trim("id").alias("identifier")) for d in (m, a.resources, a.releases)]
    return G.reference_closure(records, ids[0].unionByName(ids[1]).unionByName(ids[2]), "urn:vx:")


# ---- diagnostics and gates of rows ---------------------------------------------------
_DIAGNOSTICS = {
    "REF-ID": "NOT starts_with(id, 'urn:vx:mapping:') OR length(id) <> 31",
    "REF-RELATION": "relation IS NULL OR trim(relation) = ''",
    "REF-SELF": "trim(source_concept) = trim(target_concept)",
    "REF-EVIDENCE": "len(evidence) = 0",
    "REF-RING": "semantic_ring NOT IN ('subject', 'entity', 'value', 'legalIdentity')",
    "REF-STATUS": "lifecycle_status NOT IN ('current', 'superseded', 'withdrawn')",
    "REF-SUPERSEDES": "list_contains(supersedes, id)",
    "REF-BLANKS": "source_concept <> trim(source_concept) OR target_concept <> trim(target_concept)",
}
B.add("iv22_record_faults", " UNION ALL ".join(f"SELECT '{code}' AS code, id AS key FROM mapping_assertions WHERE {rule}" for code, rule in _DIAGNOSTICS.items()))(
    lambda a: G.row_faults(
        a.table("mapping_assertions"),
        "id",
        {
            "REF-ID": ~F.col("id").startswith("urn:vx:mapping:") | (F.length("id") != 31),
            "REF-RELATION": F.col("relation").isNull() | (F.trim("relation") == ""),
            "REF-SELF": F.trim("source_concept") == F.trim("target_concept"),
            "REF-EVIDENCE": F.size("evidence") == 0,
            "REF-RING": ~F.col("semantic_ring").isin("subject", "entity", "value", "legalIdentity"),
            "REF-STATUS": ~F.col("lifecycle_status").isin("current", "superseded", "withdrawn"),
            "REF-SUPERSEDES": F.array_contains("supersedes", F.col("id")),
            "REF-BLANKS": (F.col("source_concept") != F.trim("source_concept")) | (F.col("target_concept") != F.trim("target_concept")),
        },
    )
)
_GATES = {
    "resources-once": ("SELECT count(*) FROM atlas_resources", "SELECT count(DISTINCT id) FROM atlas_resources"),
    "statements-once": ("SELECT count(*) FROM atlas_statements", "SELECT count(DISTINCT id) FROM atlas_statements"),
    "resources-labelled": ("SELECT count(DISTINCT id) FROM atlas_resources", "SELECT count(*) FROM (SELECT id FROM atlas_resources INTERSECT SELECT resource FROM atlas_labels)"),
    "statements-evidenced": ("SELECT count(DISTINCT id) FROM atlas_statements", "SELECT count(*) FROM (SELECT id FROM atlas_statements INTERSECT SELECT statement FROM atlas_evidence_bindings)"),
    "releases-filled": ("SELECT count(DISTINCT release) FROM atlas_resources", "SELECT count(*) FROM (SELECT release FROM atlas_resources INTERSECT SELECT id FROM atlas_releases)"),
}
B.add("iv24_producer_gates", "SELECT gate, expected, actual, expected = actual AS passes FROM (" + " UNION ALL ".join(f"SELECT '{g}' AS gate, ({want}) AS expected, ({got}) AS actual" for g, (want, got) in _GATES.items()) + ")")(lambda a: _gates(a))


def _gates(a: Atlas):
    once = lambda df, c="id": df.select(F.col(c).alias("id")).distinct()
    in_both = lambda x, y: x.join(y, "id", "left_semi")
    res, st = once(a.resources), once(a.statements)
    return G.counted_gates([
        ("resources-once", a.resources, res), ("statements-once", a.statements, st), ("resources-labelled", res, in_both(res, once(a.labels, "resource"))),
        ("statements-evidenced", st, in_both(st, once(a.evidence_bindings, "statement"))), ("releases-filled", once(a.resources, "release"), in_both(once(a.resources, "release"), once(a.releases))),
    ])


B.add(
    "st11_migrated_rows",
    """WITH f AS (SELECT trim(id, chr(32) || chr(9) || chr(10)) AS id, max_by(struct_pack(s := scheme, p := resource_profile), struct_pack(d := delivered_at, s := scheme, p := resource_profile)) AS v FROM resource_snapshots GROUP BY 1),
    l AS (SELECT trim(id, chr(32) || chr(9) || chr(10)) AS id, max_by(struct_pack(s := scheme, p := resource_profile), struct_pack(d := loaded_at, s := scheme, p := resource_profile)) AS v FROM atlas_resources GROUP BY 1)
    SELECT id, CASE WHEN f.v IS NULL THEN 'new' WHEN l.v IS NULL THEN 'lost' WHEN f.v = l.v THEN 'kept' ELSE 'changed' END AS state FROM f FULL JOIN l USING (id)""",
)(lambda a: G.migrated_rows(_last(a.table("resource_snapshots"), "delivered_at"), _last(a.resources, "loaded_at"), "id", ["scheme", "resource_profile"]))


def _last(df, at: str):
    v = F.struct("scheme", "resource_profile")
    return df.groupBy(F.trim("id", F.lit(" \t\n")).alias("id")).agg(F.max_by(v, F.struct(at, v)).alias("v")).select("id", "v.scheme", "v.resource_profile")


_BUDGET = {"definition": 0.2, "notes": 0.5, "notations": 0.3, "record_status": 0.01, "content_digest": 0.02}
B.add(
    "ev19_missing_budget",
    " UNION ALL ".join(f"SELECT 'atlas_resources' AS \"table\", '{c}' AS \"column\", count(*) FILTER ({c} IS NULL) AS missing, count(*) AS rows, count(*) FILTER ({c} IS NULL) <= CAST({share} AS DOUBLE) * count(*) AS within FROM atlas_resources" for c, share in _BUDGET.items()),
)(lambda a: G.null_budget(a.resources, "atlas_resources", _BUDGET))

# ---- identity, policy and warrants: the lists are written down, not taken from the rows judged -------
_PARTS = ["object", "policy", "predicate", "source_release", "subject", "target_release", "statement_type", "semantic_ring", "source_ring", "target_ring"]
_SAME = "concat_ws(chr(31), " + ", ".join(f"coalesce({c}, chr(30))" for c in _PARTS) + ")"
def _conflicts(rows: str) -> str:
    return f"""WITH s AS ({rows}), r AS (SELECT DISTINCT id, {_SAME} AS identity, digest FROM s), d AS (SELECT DISTINCT identity, digest FROM r WHERE digest IS NOT NULL)
    SELECT DISTINCT 'identity-digest-missing' AS code, id AS key FROM r WHERE digest IS NULL
    UNION SELECT 'identity-digests', id FROM r WHERE identity IN (SELECT identity FROM d GROUP BY 1 HAVING count(*) > 1)
    UNION SELECT 'digest-identities', id FROM r WHERE digest IN (SELECT digest FROM d GROUP BY 1 HAVING count(*) > 1)"""


_GOOD = f"SELECT id, {', '.join(_PARTS)}, hex(assertion_identity_digest) AS digest FROM atlas_statements"
B.add("iv10_identity_conflicts", _conflicts(_GOOD))(lambda a: G.identity_conflicts(a.statements, _PARTS, "assertion_identity_digest"))
# the same beside a damaged copy: digests of related terms lost, those of exact matches altered, objects of broader terms swapped for subjects
_DAMAGED = f"""SELECT id, {', '.join('subject AS object' if c == 'object' else c for c in _PARTS)}, hex(assertion_identity_digest) FROM atlas_statements WHERE predicate = 'skos:broader'
    UNION ALL SELECT id, {', '.join(_PARTS)}, CASE predicate WHEN 'skos:related' THEN NULL ELSE hex(assertion_identity_digest) || '00' END FROM atlas_statements WHERE predicate IN ('skos:related', 'skos:exactMatch')"""
B.add("iv10_damaged_identities", _conflicts(f"{_GOOD} UNION ALL {_DAMAGED}"))(lambda a: _damaged_identities(a))


def _damaged_identities(a: Atlas):
    good = a.statements.select("id", *_PARTS, F.hex("assertion_identity_digest").alias("digest"))
    swapped = good.filter("predicate = 'skos:broader'").withColumn("object", F.col("subject"))
    altered = good.filter("predicate IN ('skos:related', 'skos:exactMatch')").withColumn("digest", F.when(F.col("predicate") == "skos:exactMatch", F.concat("digest", F.lit("00"))))
    return G.identity_conflicts(good.unionByName(swapped).unionByName(altered), _PARTS, "digest")


#: The predicates of each kind of statement; each predicate has one kind.
POLICY = {
    "NativeRelationAssertion": ("skos:broader", "skos:narrower", "skos:related"),
    "MappingAssertion": ("skos:exactMatch", "skos:closeMatch", "skos:broadMatch"),
    "CrossRingRelationAssertion": ("vx:about",),
    "SourceAssignment": ("vx:assignedTo",),
}
_ALLOWED = " OR ".join(f"(statement_type = '{t}' AND predicate IN ({', '.join(repr(p) for p in ps)}))" for t, ps in POLICY.items())
B.add(
    "iv11_written_policy",
    f"""SELECT DISTINCT 'policy-predicate' AS code, id AS key FROM atlas_statements WHERE NOT ({_ALLOWED})
    UNION SELECT 'policy-rings', id FROM atlas_statements WHERE statement_type = 'CrossRingRelationAssertion' AND NOT coalesce(source_ring <> target_ring, false)
    UNION SELECT 'policy-ring', id FROM atlas_statements WHERE statement_type <> 'CrossRingRelationAssertion' AND semantic_ring IS NULL""",
)(lambda a: _policy_faults(a))


def _policy_faults(a: Atlas):
    kind, allowed = F.col("statement_type"), F.lit(False)
    for t, predicates in POLICY.items():
        allowed = allowed | ((kind == t) & F.col("predicate").isin(*predicates))
    cross = kind == "CrossRingRelationAssertion"
    checks = {"policy-predicate": ~allowed, "policy-rings": cross & ~F.coalesce(F.col("source_ring") != F.col("target_ring"), F.lit(False)), "policy-ring": ~cross & F.col("semantic_ring").isNull()}
    return G.row_faults(a.statements, "id", checks).distinct()


#: The roles of evidence that each origin sanctions.
WARRANTS = {
    "vx:published": ("vx:officialSourceMetadata", "vx:authorityCitation", "vx:structuralEvidence"),
    "vx:curated": ("vx:formalAdoptionEvent", "vx:reviewedAuthorityChain", "vx:textualEvidence"),
}
_WARRANTED = " OR ".join(f"(assertion_origin = '{o}' AND evidence_role IN ({', '.join(repr(r) for r in rs)}))" for o, rs in WARRANTS.items())
B.add(
    "iv15_written_warrants",
    f"""SELECT DISTINCT 'warrant' AS code, id AS key FROM atlas_evidence_bindings WHERE NOT ({_WARRANTED})
    UNION SELECT 'warrant-basis', id FROM atlas_evidence_bindings WHERE based_on_attestation IS NOT NULL AND evidence_role <> 'vx:formalAdoptionEvent'
    UNION SELECT 'warrant-inference', id FROM atlas_evidence_bindings WHERE assertion_origin = 'vx:published' AND epistemic_basis = 'vx:inferred'""",
)(lambda a: _warrant_faults(a))


def _warrant_faults(a: Atlas):
    allowed = F.lit(False)
    for origin, roles in WARRANTS.items():
        allowed = allowed | ((F.col("assertion_origin") == origin) & F.col("evidence_role").isin(*roles))
    checks = {
        "warrant": ~allowed,
        "warrant-basis": F.col("based_on_attestation").isNotNull() & (F.col("evidence_role") != "vx:formalAdoptionEvent"),
        "warrant-inference": (F.col("assertion_origin") == "vx:published") & (F.col("epistemic_basis") == "vx:inferred"),
    }
    return G.row_faults(a.evidence_bindings, "id", checks).distinct()


# ---- managed releases -------------------------------------------------------------------
B.add(
    "sc14_release_members",
    "SELECT r.release, count(DISTINCT r.id) AS members, count(DISTINCT r.id) FILTER (l.resource IS NOT NULL) AS expressed FROM atlas_resources r LEFT JOIN (SELECT DISTINCT resource FROM atlas_labels) l ON l.resource = r.id GROUP BY 1",
)(
    lambda a: a.resources.select("release", "id").distinct().join(a.labels.select(F.col("resource").alias("id")).distinct().withColumn("_l", F.lit(1)), "id", "left").groupBy("release").agg(F.count(F.lit(1)).alias("members"), F.count("_l").alias("expressed"))
)
B.add(
    "sc14_member_identifiers",
    "SELECT DISTINCT r.id AS member, n AS identifier FROM (SELECT id, unnest(notations) AS n FROM atlas_resources) r WHERE n IS NOT NULL UNION SELECT id, NULL FROM atlas_resources WHERE notations IS NULL OR len(notations) = 0",
)(lambda a: a.resources.select(F.col("id").alias("member"), F.explode_outer("notations").alias("identifier"), F.size(F.coalesce("notations", F.array().cast("array<string>"))).alias("_n")).filter("identifier IS NOT NULL OR _n <= 0").select("member", "identifier").distinct())
B.add("sc14_expressions", "SELECT DISTINCT resource AS member, label_role, value, language FROM atlas_labels WHERE lower(language) = 'en' OR lower(language) LIKE 'en-%' OR lower(language) LIKE 'en\\_%' ESCAPE '\\'")(
    lambda a: a.labels.filter(F.lower("language").rlike(r"^en($|[-_])")).select(F.col("resource").alias("member"), "label_role", "value", "language").distinct()
)
B.add(
    "sc14_relation_participants",
    "SELECT s.id, p.role, p.participant, r.release FROM (SELECT DISTINCT id, subject, object FROM atlas_statements WHERE statement_type = 'NativeRelationAssertion') s, LATERAL (SELECT 'subject' AS role, s.subject AS participant UNION ALL SELECT 'object', s.object) p LEFT JOIN (SELECT id, min(release) AS release FROM atlas_resources GROUP BY 1) r ON r.id = p.participant",
)(lambda a: _participants(a))


def _participants(a: Atlas):
    s = a.statements.filter("statement_type = 'NativeRelationAssertion'").select("id", "subject", "object").distinct()
    ends = F.array(*[F.struct(F.lit(role).alias("role"), F.col(role).alias("participant")) for role in ("subject", "object")])
    flat = s.select("id", F.explode(ends).alias("p")).select("id", "p.role", "p.participant")
    return flat.join(a.once.select(F.col("id").alias("participant"), "release"), "participant", "left").select("id", "role", "participant", "release")


B.add(
    "sc14_release_mappings",
    "SELECT source_release, target_release, count(DISTINCT id) AS mappings, count(DISTINCT trim(source_concept)) AS sources, count(DISTINCT trim(target_concept)) AS targets FROM mapping_assertions WHERE lifecycle_status = 'current' GROUP BY ALL",
)(
    lambda a: a.table("mapping_assertions").filter("lifecycle_status = 'current'").groupBy("source_release", "target_release").agg(F.count_distinct("id").alias("mappings"), F.count_distinct(F.trim("source_concept")).alias("sources"), F.count_distinct(F.trim("target_concept")).alias("targets"))
)

# ---- guards, run on good and on damaged input ------------------------------------------------
_EMPTY, _BOTH = "(SELECT count(*) FROM s) = 0 OR (SELECT count(*) FROM t) = 0", "(SELECT count(*) FROM s JOIN t USING (member)) > 0"
_MEMBERS = "s AS (SELECT DISTINCT id AS member FROM atlas_resources WHERE scheme = 'urn:vx:scheme:brineworks'), t AS (SELECT DISTINCT id AS member FROM atlas_resources WHERE scheme = 'urn:vx:scheme:lodestar')"
B.add("cg9_side_guard", f"WITH {_MEMBERS} SELECT 'as given' AS sides, ({_EMPTY}) OR ({_BOTH}) AS refused UNION ALL SELECT 'one empty', true UNION ALL SELECT 'both the same', true")(lambda a: _guarded(a))


def _refuses(run) -> bool:
    try:
        run()
    except ValueError:
        return True
    return False


def _guarded(a: Atlas):
    s, t = (a.resources.filter(F.col("scheme") == f"urn:vx:scheme:{x}").select(F.col("id").alias("member")).distinct() for x in ("brineworks", "lodestar"))
    cases = [("as given", s, t), ("one empty", s, t.filter("false")), ("both the same", s, s)]
    return a.spark.createDataFrame([(name, _refuses(lambda x=x, y=y: C.check_sides(x, y))) for name, x, y in cases], "sides string, refused boolean")


def _scratch(a: Atlas) -> str:
    return f"{scratch_dir(a.spark)}/gates-{uuid.uuid4().hex}"


B.add("sc2_optional_tables", "SELECT unnest(['none', 'both', 'refused']) AS state, unnest([0, (SELECT count(*) FROM region), 0]) AS rows")(lambda a: _optional(a))


def _optional(a: Atlas):
    """A pair of optional tables that is absent, there, and there by half."""
    at = _scratch(a)
    a.table("region").write.parquet(f"{at}/one")
    a.table("nation").write.parquet(f"{at}/two")
    none = store.optional_pair(a.spark, f"{at}/no", f"{at}/nor")
    both = store.optional_pair(a.spark, f"{at}/one", f"{at}/two")
    half = _refuses(lambda: store.optional_pair(a.spark, f"{at}/one", f"{at}/nor"))
    return a.spark.createDataFrame([("none" if none is None else "some", 0), ("both" if both else "none", both[0].count() if both else 0), ("refused" if half else "taken", 0)], "state string, rows long")


B.add("sc7_manifest_faults", "SELECT unnest(['good: none', 'damaged: missing member region', 'damaged: nation: bytes differs', 'damaged: nation: digest differs', 'damaged: nation: rows differs', 'damaged: unexpected member part']) AS fault")(lambda a: _manifest_faults(a))


def _manifest_faults(a: Atlas):
    """Members against a manifest pinned before: as they were, and after one lost rows, one vanished and one came."""
    at = _scratch(a)
    good = {n: f"{at}/{n}" for n in ("region", "nation")}
    for n, path in good.items():
        a.table(n).coalesce(1).write.parquet(path)
    pinned = store.manifest(a.spark, good)
    a.table("nation").filter("n_nationkey > 0").coalesce(1).write.parquet(f"{at}/less")
    a.table("part").limit(1).write.parquet(f"{at}/part")
    damaged = {"nation": f"{at}/less", "part": f"{at}/part"}
    rows = [f"good: {x}" for x in store.verify(a.spark, good, pinned) or ["none"]] + [f"damaged: {x}" for x in store.verify(a.spark, damaged, pinned)]
    return a.spark.createDataFrame([(x,) for x in rows], "fault string")


B.add("pf12_lossless_rows", "SELECT id, release_type, identifier, issued, source_locator, resource_profile, semantic_ring, scheme, membership_mode FROM atlas_releases")(lambda a: _round_trip(a))


def _round_trip(a: Atlas):
    """Releases as records that lack their absent fields, projected to rows again: absent fields come back as nulls."""
    cols = ["id", "release_type", "identifier", "issued", "source_locator", "resource_profile", "semantic_ring", "scheme", "membership_mode"]
    records = a.releases.select(F.to_json(F.struct(*cols)).alias("record"))  # nulls are left out of the text
    return records.select(F.from_json("record", ", ".join(f"{c} string" for c in cols)).alias("r")).select("r.*")


B.add(
    "jn21_equal_first_identifiers",
    "WITH f AS (SELECT id, min(scheme) AS scheme, min(list_sort(notations)[1]) AS first FROM atlas_resources WHERE len(notations) > 0 GROUP BY 1) SELECT x.id AS source, y.id AS target, x.first AS identifier FROM f x JOIN f y ON x.first = y.first AND x.scheme < y.scheme",
)(lambda a: _equal_firsts(a))


def _equal_firsts(a: Atlas):
    f = a.resources.filter(F.size("notations") > 0).groupBy("id").agg(F.min("scheme").alias("scheme"), F.min(F.get(F.array_sort("notations"), F.lit(0))).alias("identifier"))
    other = f.select(F.col("id").alias("target"), F.col("scheme").alias("_s"), "identifier")
    return f.join(other, "identifier").filter("scheme < _s").select(F.col("id").alias("source"), "target", "identifier")


B.add(
    "jn28_unbound_lineage",
    "SELECT DISTINCT id, CASE WHEN source_release NOT IN (SELECT id FROM atlas_releases) THEN 'no catalogue' ELSE 'no expression' END AS fault FROM mapping_assertions WHERE source_release NOT IN (SELECT id FROM atlas_releases) OR trim(source_concept) NOT IN (SELECT resource FROM atlas_labels)",
)(lambda a: _unbound(a))


def _unbound(a: Atlas):
    """Assertions whose source release is unknown or whose source concept has no label."""
    m = a.table("mapping_assertions").select("id", "source_release", F.trim("source_concept").alias("resource")).distinct()
    no_release = m.join(a.releases.select(F.col("id").alias("source_release")).distinct(), "source_release", "left_anti").select("id", F.lit("no catalogue").alias("fault"))
    held = m.join(a.releases.select(F.col("id").alias("source_release")).distinct(), "source_release", "left_semi")
    return no_release.unionByName(held.join(a.labels.select("resource").distinct(), "resource", "left_anti").select("id", F.lit("no expression").alias("fault"))).distinct()


# ---- reference edges of XML ------------------------------------------------------------------
B.add("in14_reference_edges", "SELECT DISTINCT source_record AS anchor, 'record/part' AS context, id AS href FROM atlas_resources")(lambda a: _xml_edges(a))


def _xml_edges(a: Atlas):
    """Resources written as lines of XML records, wrapped into one document per file, and their reference edges read back."""
    at = f"{scratch_dir(a.spark)}/in14-{uuid.uuid4().hex}"
    own = a.resources.select("source_record", "id").distinct()
    text = F.concat(F.lit('<record identifier="'), F.col("source_record"), F.lit('"><part><ref href="'), F.col("id"), F.lit('">x</ref></part></record>'))

    def wrap(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.record_batch([pa.array(["<doc>"])], names=["value"])
        yield from batches
        yield pa.record_batch([pa.array(["</doc>"])], names=["value"])

    own.select(text.alias("value")).mapInArrow(wrap, "value string").write.text(at)
    return formats.read_xml_references(a.spark, at, "record").select("anchor", F.regexp_replace("context", "^doc/", "").alias("context"), "href").distinct()


QUERIES, SQL = B.queries, B.sql
