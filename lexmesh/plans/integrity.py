"""Queries of the integrity checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmesh.operators import integrity as I
from lexmesh.plans.base import IDENTIFIERS, SOURCE_RECORDS, Atlas, Book, digest_sql
from lexmesh.schema import IRI_SHAPE, LANGUAGE_SHAPE, missing_values, shape_faults

B = Book()
#: Evidence roles accepted as reviewed.
REVIEW_ROLES = ("vx:reviewedAuthorityChain", "vx:textualEvidence")


def _unique(t: str, code: str, *keys: str, where: str = "true") -> str:
    key = ", ".join(keys)
    null = " OR ".join(f"{k} IS NULL" for k in keys)
    return f"SELECT '{code}' AS code, concat_ws('|', {key}) AS key, CAST(count(*) AS VARCHAR) AS detail FROM {t} WHERE {where} GROUP BY {key} HAVING count(*) > 1 OR {null}"


def _dangling(child: str, col: str, parent: str, code: str, where: str = "true", key: str = "id") -> str:
    return f"SELECT '{code}' AS code, c.{key} AS key, c.{col} AS detail FROM {child} c WHERE ({where}) AND NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.id = c.{col})"


def _unequal(child: str, ref: str, parent: str, pairs: dict[str, str], code: str, where: str = "true", key: str = "id") -> str:
    cols = ", ".join(dict.fromkeys(pairs.values()))
    d = ", ".join(f"CASE WHEN NOT coalesce(c.{a} = p.{b}, false) THEN '{a}' END" for a, b in pairs.items())
    return f"SELECT '{code}' AS code, key, detail FROM (SELECT c.{key} AS key, concat_ws(',', {d}) AS detail FROM {child} c JOIN (SELECT DISTINCT id, {cols} FROM {parent}) p ON p.id = c.{ref} WHERE {where}) WHERE detail <> ''"


def _closed(t: str, col: str, values: tuple[str, ...], code: str) -> str:
    return f"SELECT '{code}' AS code, id AS key, {col} AS detail FROM {t} WHERE NOT coalesce({col} IN ({', '.join(repr(v) for v in values)}), false)"


def _join(*parts: str, ctes: str = "") -> str:
    return (f"WITH {ctes} " if ctes else "") + " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)


_ROLES = {"releases": "atlas_releases", "resources": "atlas_resources", "labels": "atlas_labels", "statements": "atlas_statements", "evidence": "atlas_evidence_bindings"}


def _tables(a: Atlas):
    return {"releases": a.releases, "resources": a.resources, "labels": a.labels, "statements": a.statements, "evidence": a.evidence_bindings}


B.add("ag11_not_unique", _join(*[_unique(t, f"{r}-identity", "id") for r, t in _ROLES.items()]))(lambda a: I.all_of(*[I.not_unique(t, f"{r}-identity", "id") for r, t in _tables(a).items()]))
B.add("iv23_duplicate_ids", _unique("mapping_assertions", "duplicate-id", "id"))(lambda a: I.not_unique(a.table("mapping_assertions"), "duplicate-id", "id"))
B.add(
    "iv1_identity",
    _join(*[_unique(t, f"{r}-identity", "id") for r, t in _ROLES.items()], "SELECT 'cross-role-identity' AS code, id AS key, string_agg(role, ',' ORDER BY role) AS detail FROM (" + " UNION ".join(f"SELECT id, '{r}' AS role FROM {t}" for r, t in _ROLES.items()) + ") GROUP BY id HAVING count(*) > 1"),
)(lambda a: I.all_of(*[I.not_unique(t, f"{r}-identity", "id") for r, t in _tables(a).items()], I.shared_across(_tables(a))))
B.add(
    "ag12_shared_keys",
    "SELECT 'cross-role-identity' AS code, id AS key, string_agg(role, ',' ORDER BY role) AS detail FROM (SELECT subject AS id, 'subject' AS role FROM atlas_statements UNION SELECT object, 'object' FROM atlas_statements UNION SELECT resource, 'label' FROM atlas_labels) GROUP BY id HAVING count(*) > 1",
)(lambda a: I.shared_across({"subject": a.statements.select(F.col("subject").alias("id")), "object": a.statements.select(F.col("object").alias("id")), "label": a.labels.select(F.col("resource").alias("id"))}))
_WANT = {"releases": 134, "resources": 1600, "labels": 3600, "statements": 3000, "evidence": 3000}
B.add("iv2_manifest_counts", _join(*[f"SELECT 'manifest-counts' AS code, '{r}' AS key, n || '/{_WANT[r]}' AS detail FROM (SELECT count(*) AS n FROM {t}) WHERE n <> {_WANT[r]}" for r, t in _ROLES.items()]))(lambda a: I.count_mismatches(_tables(a), _WANT))
B.add("ag14_counts", "SELECT " + ", ".join(f"(SELECT count(*) FROM {t}) AS {r}" for r, t in _ROLES.items()))(
    lambda a: a.spark.createDataFrame([tuple(t.count() for t in _tables(a).values())], ", ".join(f"{r} long" for r in _ROLES))
)
_ATLAS = "atlas AS (SELECT * FROM atlas_releases WHERE release_type = 'AtlasRelease')"
_THREE = {"scheme": "scheme", "semantic_ring": "semantic_ring", "resource_profile": "resource_profile"}
B.add(
    "iv3_releases",
    _join(_closed("atlas_releases", "release_type", ("AtlasRelease", "SourceRelease"), "release-type"), _dangling("atlas_resources", "release", "atlas", "resource-release"), _unequal("atlas_resources", "release", "atlas", _THREE, "resource-release-equality"), ctes=_ATLAS),
)(lambda a: I.release_faults(a.releases, a.resources))
B.add(
    "iv4_labels",
    _join(
        _dangling("atlas_labels", "resource", "atlas_resources", "label-resource"),
        _unequal("atlas_labels", "resource", "atlas_resources", {"release": "release", "source_record": "source_record"}, "label-equality"),
        _closed("atlas_labels", "label_role", ("preferred", "alternate", "hidden"), "label-role"),
        _unique("atlas_labels", "label-preferred-language", "resource", "language", where="label_role = 'preferred'"),
        _unique("atlas_labels", "label-value", "resource", "value", "language"),
    ),
)(lambda a: I.label_faults(a.labels, a.resources))
B.add("iv16_role_conflicts", "SELECT 'label-role-conflict' AS code, concat_ws('|', resource, value, language) AS key, string_agg(DISTINCT label_role, ',' ORDER BY label_role) AS detail FROM atlas_labels GROUP BY resource, value, language HAVING count(DISTINCT label_role) > 1")(lambda a: I.role_conflicts(a.labels))
_OWN_ID = "SELECT 'identifier-value' AS code, concat_ws('|', identifier_scheme, identifier_value) AS key, CAST(count(DISTINCT identifies) AS VARCHAR) AS detail FROM identifiers GROUP BY identifier_scheme, identifier_value HAVING count(DISTINCT identifies) > 1"
B.add("iv5_identifiers", _join(_dangling("identifiers", "identifies", "atlas_resources", "identifier-resource", key="identifier_value"), _OWN_ID, ctes=IDENTIFIERS))(lambda a: I.identifier_faults(a.identifiers, a.resources))
B.add("ag13_identifier_owners", f"WITH {IDENTIFIERS} SELECT identifier_scheme, identifier_value, count(DISTINCT identifies) AS owners FROM identifiers GROUP BY ALL")(lambda a: a.identifiers.groupBy("identifier_scheme", "identifier_value").agg(F.count_distinct("identifies").alias("owners")))
_REL, _CROSS = "c.statement_type <> 'SourceAssignment'", "c.statement_type = 'CrossRingRelationAssertion'"
_MIXED = "CASE WHEN statement_type = 'CrossRingRelationAssertion' THEN semantic_ring IS NOT NULL OR source_ring IS NULL OR target_ring IS NULL ELSE semantic_ring IS NULL OR source_ring IS NOT NULL OR target_ring IS NOT NULL END"
B.add(
    "iv6_relations",
    _join(
        _dangling("atlas_statements", "subject", "atlas_resources", "statement-subject", _REL),
        _dangling("atlas_statements", "object", "atlas_resources", "statement-object", _REL),
        _unequal("atlas_statements", "subject", "atlas_resources", {"source_release": "release"}, "statement-source-release", _REL),
        _unequal("atlas_statements", "object", "atlas_resources", {"target_release": "release"}, "statement-target-release", _REL),
        f"SELECT 'statement-ring-fields' AS code, id AS key, statement_type AS detail FROM atlas_statements WHERE statement_type <> 'SourceAssignment' AND {_MIXED}",
        _unequal("atlas_statements", "subject", "atlas_resources", {"semantic_ring": "semantic_ring"}, "statement-subject-ring", f"{_REL} AND NOT {_CROSS}"),
        _unequal("atlas_statements", "subject", "atlas_resources", {"source_ring": "semantic_ring"}, "statement-source-ring", _CROSS),
        _unequal("atlas_statements", "object", "atlas_resources", {"target_ring": "semantic_ring"}, "statement-target-ring", _CROSS),
    ),
)(lambda a: I.relation_faults(a.statements, a.resources))
B.add("jn13_unknown_subjects", _dangling("atlas_statements", "subject", "atlas_resources", "statement-subject", _REL))(lambda a: I.dangling(a.statements.filter("statement_type <> 'SourceAssignment'"), "subject", a.resources, "statement-subject", optional=False))
B.add("jn14_unequal_rings", _unequal("atlas_labels", "resource", "atlas_resources", {"release": "release"}, "label-release"))(lambda a: I.unequal_through(a.labels, "resource", a.resources, {"release": "release"}, "label-release"))
B.add("jn15_uncovered_statements", "SELECT 'evidence-coverage' AS code, id AS key, CAST(NULL AS VARCHAR) AS detail FROM (SELECT DISTINCT id FROM atlas_statements) WHERE id NOT IN (SELECT statement FROM atlas_evidence_bindings)")(lambda a: I.uncovered(a.statements, a.evidence_bindings, "statement", "evidence-coverage"))
_SRC = "c.statement_type = 'SourceAssignment'"
B.add(
    "iv7_assignments",
    _join(_dangling("atlas_statements", "subject", "source_records", "assignment-subject", _SRC), _dangling("atlas_statements", "object", "atlas_resources", "assignment-object", _SRC), _unequal("atlas_statements", "object", "atlas_resources", {"target_release": "release", "semantic_ring": "semantic_ring"}, "assignment-equality", _SRC), ctes=SOURCE_RECORDS),
)(lambda a: I.assignment_faults(a.statements, a.source_records, a.resources))
B.add(
    "iv8_statements",
    _join(
        _closed("atlas_statements", "statement_type", ("NativeRelationAssertion", "MappingAssertion", "SourceAssignment", "CrossRingRelationAssertion"), "statement-type"),
        "SELECT 'mapping-release' AS code, id AS key, source_release AS detail FROM atlas_statements WHERE statement_type = 'MappingAssertion' AND source_release = target_release",
        _dangling("atlas_statements", "supersedes_assertion", "atlas_statements", "supersession-target", "c.supersedes_assertion IS NOT NULL"),
        "SELECT 'supersession-self' AS code, id AS key, NULL AS detail FROM atlas_statements WHERE supersedes_assertion = id",
        _unique("(SELECT DISTINCT id, supersedes_assertion FROM atlas_statements WHERE supersedes_assertion IS NOT NULL)", "supersession-successor", "supersedes_assertion"),
    ),
)(lambda a: I.statement_faults(a.statements))


def _digests(a: Atlas):
    """The first digest by value that evidence gives a source record stands for the record's own."""
    return a.evidence_bindings.groupBy(F.col("source_record").alias("id")).agg(F.min("evidence_source_digest").alias("digest"))


B.add(
    "iv9_evidence",
    _join(
        _dangling("atlas_evidence_bindings", "statement", "atlas_statements", "evidence-statement"),
        _dangling("atlas_evidence_bindings", "source_record", "source_records", "evidence-source-record"),
        _unequal("atlas_evidence_bindings", "source_record", "digests", {"evidence_source_digest": "digest"}, "evidence-digest"),
        _closed("atlas_evidence_bindings", "decision", ("vx:approved",), "evidence-decision"),
        _closed("atlas_evidence_bindings", "evidence_role", REVIEW_ROLES, "evidence-role"),
        "SELECT 'evidence-coverage' AS code, id AS key, NULL AS detail FROM (SELECT DISTINCT id FROM atlas_statements) WHERE id NOT IN (SELECT statement FROM atlas_evidence_bindings)",
        ctes=SOURCE_RECORDS + ", digests AS (SELECT source_record AS id, min(evidence_source_digest) AS digest FROM atlas_evidence_bindings GROUP BY 1)",
    ),
)(lambda a: I.evidence_faults(a.evidence_bindings, a.statements, a.source_records, _digests(a), REVIEW_ROLES))
#: What an assertion's identity digest covers.
IDENTITY = ("object", "policy", "predicate", "source_release", "subject", "target_release", "statement_type")
_IDENT = " || chr(31) || ".join(f"trim({c})" for c in IDENTITY)
B.add("iv10_assertion_identity", f"SELECT id, sha256({_IDENT} || chr(31) || coalesce(semantic_ring, source_ring || '>' || target_ring, '')) AS digest FROM atlas_statements")(
    lambda a: a.statements.select("id", F.sha2(F.concat_ws("\x1f", *[F.trim(c) for c in IDENTITY], F.coalesce("semantic_ring", F.concat("source_ring", F.lit(">"), "target_ring"), F.lit(""))), 256).alias("digest"))
)
_POLICY = "policy AS (SELECT coalesce(semantic_ring, concat_ws('>', source_ring, target_ring)) AS ring, statement_type, predicate FROM atlas_statements GROUP BY ALL HAVING count(*) >= 20)"


def _policy(a: Atlas):
    """Combinations asserted at least twenty times stand for the policy matrix."""
    ring = F.coalesce("semantic_ring", F.concat_ws(">", "source_ring", "target_ring")).alias("ring")
    return a.statements.groupBy(ring, "statement_type", "predicate").agg(F.count(F.lit(1)).alias("n")).filter("n >= 20").drop("n")


B.add("iv11_policy_matrix", f"WITH {_POLICY}, s AS (SELECT id, coalesce(semantic_ring, concat_ws('>', source_ring, target_ring)) AS ring, statement_type, predicate FROM atlas_statements) SELECT 'policy-matrix' AS code, id AS key, concat_ws('|', ring, statement_type, predicate) AS detail FROM s ANTI JOIN policy USING (ring, statement_type, predicate)")(
    lambda a: I.policy_faults(a.statements, _policy(a))
)
B.add(
    "iv12_both_directions",
    "WITH e AS (SELECT DISTINCT trim(source_concept) AS subject, trim(target_concept) AS object FROM mapping_assertions) SELECT 'both-directions' AS code, e.subject AS key, e.object AS detail FROM e JOIN e f ON f.subject = e.object AND f.object = e.subject WHERE e.subject < e.object",
)(lambda a: I.both_ways(a.table("mapping_assertions").select(F.trim("source_concept").alias("subject"), F.trim("target_concept").alias("object"), F.lit("maps").alias("predicate")), "maps"))
_LINE = ("statement_type", "subject", "source_release", "semantic_ring")
B.add(
    "iv13_lineage",
    "WITH b AS (SELECT s.id, concat_ws(',', "
    + ", ".join(f"CASE WHEN s.{c} IS DISTINCT FROM o.{c} THEN '{c}' END" for c in _LINE)
    + ", CASE WHEN NOT coalesce(CAST(trim(s.asserted_at) AS TIMESTAMPTZ) > CAST(trim(o.asserted_at) AS TIMESTAMPTZ), false) THEN 'asserted_at' END) AS d FROM atlas_statements s JOIN atlas_statements o ON o.id = s.supersedes_assertion) SELECT DISTINCT 'supersession-lineage' AS code, id AS key, d AS detail FROM b WHERE d <> ''",
)(lambda a: I.lineage_faults(a.statements))
_EVENTS = "events AS (SELECT statement AS applies_to, CASE WHEN trim(decision) = 'vx:rejected' THEN 'rescinded' ELSE 'deferred' END AS lifecycle_event_kind FROM atlas_evidence_bindings WHERE trim(decision) <> 'vx:approved')"


def _events(a: Atlas):
    kind = F.when(F.trim("decision") == "vx:rejected", "rescinded").otherwise("deferred")
    return a.evidence_bindings.filter(F.trim("decision") != "vx:approved").select(F.col("statement").alias("applies_to"), kind.alias("lifecycle_event_kind"))


B.add(
    "iv14_lifecycle",
    _join(
        "SELECT 'rescinded-and-superseded' AS code, applies_to AS key, NULL AS detail FROM events WHERE lifecycle_event_kind = 'rescinded' AND applies_to IN (SELECT supersedes_assertion FROM atlas_statements)",
        "SELECT 'lifecycle-event' AS code, applies_to AS key, lifecycle_event_kind AS detail FROM events GROUP BY ALL HAVING count(*) > 1",
        _dangling("events", "applies_to", "atlas_statements", "lifecycle-target", key="applies_to"),
        ctes=_EVENTS,
    ),
)(lambda a: I.lifecycle_faults(a.statements, _events(a)))
_AXES = ("assertion_origin", "epistemic_basis", "evidence_role")
_WARRANT = f"warrant AS (SELECT {', '.join(_AXES)} FROM atlas_evidence_bindings GROUP BY ALL HAVING count(*) >= 40)"
B.add(
    "iv15_warrants",
    _join(
        f"SELECT 'evidence-warrant' AS code, id AS key, concat_ws('|', {', '.join(_AXES)}) AS detail FROM atlas_evidence_bindings ANTI JOIN warrant USING ({', '.join(_AXES)})",
        _dangling("atlas_evidence_bindings", "based_on_attestation", "atlas_evidence_bindings", "evidence-basis", "c.based_on_attestation IS NOT NULL"),
        "SELECT 'evidence-basis-self' AS code, id AS key, NULL AS detail FROM atlas_evidence_bindings WHERE based_on_attestation = id",
        ctes=_WARRANT,
    ),
)(lambda a: I.warrant_faults(a.evidence_bindings, a.evidence_bindings.groupBy(*_AXES).agg(F.count(F.lit(1)).alias("n")).filter("n >= 40").drop("n"), _AXES))
B.add(
    "iv17_membership",
    "WITH l AS (SELECT DISTINCT release, resource AS id FROM atlas_labels), m AS (SELECT DISTINCT release, id FROM atlas_resources) SELECT 'member-missing' AS code, id AS key, release AS detail FROM l ANTI JOIN m USING (release, id) UNION ALL SELECT 'member-unlisted', id, release FROM m ANTI JOIN l USING (release, id)",
)(lambda a: I.membership_faults(a.labels.select("release", F.col("resource").alias("id")), a.resources))
B.add(
    "iv18_independent_proofs",
    "WITH p AS (SELECT DISTINCT statement AS request, attestor, attestor_kind, epistemic_basis FROM atlas_evidence_bindings), g AS (SELECT DISTINCT a.request FROM p a JOIN p b ON a.request = b.request AND a.attestor <> b.attestor AND a.attestor_kind <> b.attestor_kind AND a.epistemic_basis <> b.epistemic_basis) SELECT 'independent-proofs' AS code, request AS key, CAST(NULL AS VARCHAR) AS detail FROM (SELECT DISTINCT request FROM p) ANTI JOIN g USING (request)",
)(lambda a: I.independent_proofs(a.evidence_bindings.withColumn("request", F.col("statement")), ("attestor", "attestor_kind", "epistemic_basis")))
_DERIVED = "derived AS (SELECT id, source_concept AS subject, 'maps' AS predicate, target_concept AS object, coalesce(relation, '') AS derivation_rule, asserted_at AS generated_at FROM mapping_assertions)"


def _derived(a: Atlas):
    return a.table("mapping_assertions").select("id", F.col("source_concept").alias("subject"), F.lit("maps").alias("predicate"), F.col("target_concept").alias("object"), F.coalesce("relation", F.lit("")).alias("derivation_rule"), F.col("asserted_at").alias("generated_at"))


B.add(
    "iv19_derived_rows",
    _join(
        _closed("derived", "derivation_rule", ("skos:exactMatch", "exactMatch"), "derived-rule"),
        _dangling("derived", "subject", "atlas_resources", "derived-subject"),
        _dangling("derived", "object", "atlas_resources", "derived-object"),
        "SELECT 'derived-asserted' AS code, id AS key, NULL AS detail FROM derived d WHERE EXISTS (SELECT 1 FROM atlas_statements s WHERE (s.subject = d.subject AND s.object = d.object) OR (s.subject = d.object AND s.object = d.subject))",
        ctes=_DERIVED,
    ),
)(lambda a: I.derived_faults(_derived(a), a.resources, a.statements, ("skos:exactMatch", "exactMatch")))
_OLD = "both_ AS (SELECT DISTINCT m.id, m.old, m.semantic_ring, m.asserted_at, o.semantic_ring AS oring, o.asserted_at AS oat FROM (SELECT id, semantic_ring, asserted_at, unnest(supersedes) AS old FROM mapping_assertions) m LEFT JOIN mapping_assertions o ON o.id = m.old)"
B.add(
    "iv27_partial_supersession",
    _join(
        "SELECT 'supersession-self' AS code, id AS key, NULL AS detail FROM both_ WHERE old = id",
        "SELECT 'supersession-ring' AS code, id AS key, old AS detail FROM both_ WHERE oring <> semantic_ring",
        "SELECT 'supersession-order' AS code, id AS key, old AS detail FROM both_ WHERE CAST(trim(oat) AS TIMESTAMPTZ) >= CAST(trim(asserted_at) AS TIMESTAMPTZ)",
        ctes=_OLD,
    ),
)(lambda a: I.partial_supersession_faults(a.table("mapping_assertions")))


def _attestations(a: Atlas):
    at = F.coalesce(F.try_to_timestamp(F.trim("attested_at")), F.try_to_timestamp(F.trim("attested_at"), F.lit("yyyy-MM-dd")))
    return a.evidence_bindings.select("id", F.trim("decision").alias("decision"), at.alias("attested"), F.when(F.trim("evidentiary_function") != "vx:supports", F.col("loaded_at").cast("timestamp")).alias("revoked"), F.lit(None).cast("timestamp").alias("starts"), F.lit(None).cast("timestamp").alias("ends"))


B.add(
    "iv28_effective_attestations",
    "SELECT id FROM atlas_evidence_bindings WHERE trim(decision) = 'vx:approved' AND CAST(trim(attested_at) AS TIMESTAMPTZ) <= TIMESTAMPTZ '2024-06-01 00:00:00+00' AND (trim(evidentiary_function) = 'vx:supports' OR loaded_at > TIMESTAMP '2024-06-01 00:00:00')",
)(lambda a: I.effective(_attestations(a), "2024-06-01 00:00:00").select("id"))
B.add(
    "iv29_derived_coverage",
    f"WITH {_DERIVED} SELECT derivation_rule, predicate, count(*) AS edges, count(DISTINCT generated_at) AS stamps, {digest_sql("concat_ws('|', subject, predicate, object)")} AS digest FROM derived GROUP BY derivation_rule, predicate",
)(lambda a: I.coverage_block(_derived(a)))
B.add("pf11_shape_faults", f"SELECT id, 'id' AS \"column\" FROM atlas_labels WHERE NOT regexp_matches(id, '{IRI_SHAPE.replace(chr(39), chr(39) * 2)}') OR id <> trim(id) UNION ALL SELECT id, 'language' FROM atlas_labels WHERE NOT regexp_matches(language, '{LANGUAGE_SHAPE}') OR language <> trim(language)")(
    lambda a: shape_faults(a.labels, {"id": IRI_SHAPE, "language": LANGUAGE_SHAPE})
)
B.add("sc1_missing_values", "SELECT id, 'definition' AS \"column\" FROM atlas_resources WHERE false")(lambda a: missing_values(a.resources, "resources"))
B.add("pf10_digest_suffix", "SELECT id, unhex(substr(id, 14)) AS suffix FROM atlas_labels WHERE starts_with(id, 'urn:vx:label:') AND length(id) = 29")(lambda a: a.labels.filter(F.col("id").startswith("urn:vx:label:") & (F.length("id") == 29)).select("id", F.unhex(F.substring("id", 14, 100)).alias("suffix")))

QUERIES, SQL = B.queries, B.sql
