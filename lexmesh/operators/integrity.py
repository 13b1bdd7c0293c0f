"""Integrity checks: each gives the violating rows as (code, key, detail); none means it holds."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh.functions.text import digest_sums, digest_text
from lexmesh.schema import LABEL_ROLES, RELEASE_TYPES, STATEMENT_TYPES, outside


def _out(df: DataFrame, code: str, key: Column | str, detail: Column | str | None = None) -> DataFrame:
    key = F.col(key) if isinstance(key, str) else key
    detail = F.lit(None) if detail is None else (F.col(detail) if isinstance(detail, str) else detail)
    return df.select(F.lit(code).alias("code"), key.cast("string").alias("key"), detail.cast("string").alias("detail"))


def all_of(*checks: DataFrame) -> DataFrame:
    """All violations of several checks; with limit(1) the first-failure mode."""
    return reduce(DataFrame.unionByName, checks)


def not_unique(df: DataFrame, code: str, *keys: str) -> DataFrame:
    """Keys on more than one row; a null in a key is a violation too. detail is the number of rows."""
    n = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    null = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    return _out(n.filter((F.col("_n") > 1) | null), code, F.concat_ws("|", *keys), "_n")


def shared_across(tables: dict[str, DataFrame], code: str = "cross-role-identity") -> DataFrame:
    """ids that occur under more than one role; detail lists the roles."""
    every = reduce(DataFrame.unionByName, [t.select("id").distinct().withColumn("role", F.lit(r)) for r, t in tables.items()])
    both = every.groupBy("id").agg(F.array_sort(F.collect_set("role")).alias("roles")).filter(F.size("roles") > 1)
    return _out(both, code, "id", F.array_join("roles", ","))


def dangling(child: DataFrame, column: str, parent: DataFrame, code: str, key: str = "id", optional: bool = True) -> DataFrame:
    """Rows whose reference names no parent id; a null reference is one unless optional."""
    known = parent.select(F.col("id").alias(column)).distinct()
    refs = child if optional is False else child.filter(F.col(column).isNotNull())
    return _out(refs.join(known, column, "left_anti"), code, key, column)


def unequal_through(child: DataFrame, reference: str, parent: DataFrame, pairs: dict[str, str], code: str, key: str = "id") -> DataFrame:
    """Rows that disagree with their parent in a column, or where either is null. Rows without parent are another check's."""
    up = parent.select(F.col("id").alias(reference), *[F.col(p).alias(f"_{p}") for p in pairs.values()]).distinct()
    both = child.join(up, reference)
    differs = [F.when(~F.coalesce(F.col(c) == F.col(f"_{p}"), F.lit(False)), F.lit(c)) for c, p in pairs.items()]
    found = both.withColumn("_d", F.array_join(F.array_compact(F.array(*differs)), ","))
    return _out(found.filter("_d <> ''"), code, key, "_d")


def closed_values(df: DataFrame, column: str, values: tuple[str, ...], code: str, key: str = "id") -> DataFrame:
    return _out(df.filter(outside(F.col(column), values)), code, key, column)


def uncovered(parents: DataFrame, children: DataFrame, reference: str, code: str) -> DataFrame:
    """Parents that no child refers to."""
    return _out(parents.select("id").distinct().join(children.select(F.col(reference).alias("id")).distinct(), "id", "left_anti"), code, "id")


def count_mismatches(tables: dict[str, DataFrame], declared: dict[str, int]) -> DataFrame:
    """Roles whose number of rows is not the declared one; detail is found/declared."""
    rows = [t.agg(F.count(F.lit(1)).alias("n")).select(F.lit(r).alias("role"), "n", F.lit(declared.get(r)).cast("long").alias("want")) for r, t in sorted(tables.items())]
    wrong = reduce(DataFrame.unionByName, rows).filter(~F.coalesce(F.col("n") == F.col("want"), F.lit(False)))
    return _out(wrong, "manifest-counts", "role", F.concat_ws("/", F.col("n").cast("string"), F.col("want").cast("string")))


def release_faults(releases: DataFrame, resources: DataFrame) -> DataFrame:
    atlas = releases.filter(F.col("release_type") == "AtlasRelease")
    return all_of(
        closed_values(releases, "release_type", RELEASE_TYPES, "release-type"),
        dangling(resources, "release", atlas, "resource-release", optional=False),
        unequal_through(resources, "release", atlas, {"scheme": "scheme", "semantic_ring": "semantic_ring", "resource_profile": "resource_profile"}, "resource-release-equality"),
    )


def label_faults(labels: DataFrame, resources: DataFrame) -> DataFrame:
    preferred = labels.filter(F.col("label_role") == "preferred")
    return all_of(
        dangling(labels, "resource", resources, "label-resource", optional=False),
        unequal_through(labels, "resource", resources, {"release": "release", "source_record": "source_record"}, "label-equality"),
        closed_values(labels, "label_role", LABEL_ROLES, "label-role"),
        not_unique(preferred, "label-preferred-language", "resource", "language"),
        not_unique(labels, "label-value", "resource", "value", "language"),
    )


def role_conflicts(labels: DataFrame) -> DataFrame:
    """(resource, value, language) carried by more than one role."""
    n = labels.groupBy("resource", "value", "language").agg(F.array_sort(F.collect_set("label_role")).alias("roles")).filter(F.size("roles") > 1)
    return _out(n, "label-role-conflict", F.concat_ws("|", "resource", "value", "language"), F.array_join("roles", ","))


def identifier_faults(identifiers: DataFrame, resources: DataFrame) -> DataFrame:
    owners = identifiers.groupBy("identifier_scheme", "identifier_value").agg(F.count_distinct("identifies").alias("n")).filter("n > 1")
    return all_of(
        dangling(identifiers, "identifies", resources, "identifier-resource", key="identifier_value"),
        _out(owners, "identifier-value", F.concat_ws("|", "identifier_scheme", "identifier_value"), "n"),
    )


def relation_faults(statements: DataFrame, resources: DataFrame) -> DataFrame:
    """Endpoints, their releases, and rings: one ring for both ends, or two rings that equal the ends'."""
    rel = statements.filter(F.col("statement_type") != "SourceAssignment")
    cross = F.col("statement_type") == "CrossRingRelationAssertion"
    mixed = F.when(cross, F.col("semantic_ring").isNotNull() | F.col("source_ring").isNull() | F.col("target_ring").isNull()).otherwise(F.col("semantic_ring").isNull() | F.col("source_ring").isNotNull() | F.col("target_ring").isNotNull())
    return all_of(
        dangling(rel, "subject", resources, "statement-subject", optional=False),
        dangling(rel, "object", resources, "statement-object", optional=False),
        unequal_through(rel, "subject", resources, {"source_release": "release"}, "statement-source-release"),
        unequal_through(rel, "object", resources, {"target_release": "release"}, "statement-target-release"),
        _out(rel.filter(mixed), "statement-ring-fields", "id", "statement_type"),
        unequal_through(rel.filter(~cross), "subject", resources, {"semantic_ring": "semantic_ring"}, "statement-subject-ring"),
        unequal_through(rel.filter(cross), "subject", resources, {"source_ring": "semantic_ring"}, "statement-source-ring"),
        unequal_through(rel.filter(cross), "object", resources, {"target_ring": "semantic_ring"}, "statement-target-ring"),
    )


def assignment_faults(statements: DataFrame, source_records: DataFrame, resources: DataFrame) -> DataFrame:
    """Source assignments: subjects are source records, objects resources of the target release and ring."""
    own = statements.filter(F.col("statement_type") == "SourceAssignment")
    return all_of(
        dangling(own, "subject", source_records, "assignment-subject", optional=False),
        dangling(own, "object", resources, "assignment-object", optional=False),
        unequal_through(own, "object", resources, {"target_release": "release", "semantic_ring": "semantic_ring"}, "assignment-equality"),
    )


def statement_faults(statements: DataFrame) -> DataFrame:
    over = statements.filter(F.col("supersedes_assertion").isNotNull())
    same = (F.col("statement_type") == "MappingAssertion") & (F.col("source_release") == F.col("target_release"))
    return all_of(
        closed_values(statements, "statement_type", STATEMENT_TYPES, "statement-type"),
        _out(statements.filter(same), "mapping-release", "id", "source_release"),
        dangling(over, "supersedes_assertion", statements, "supersession-target"),
        _out(over.filter(F.col("supersedes_assertion") == F.col("id")), "supersession-self", "id"),
        not_unique(over.select("id", "supersedes_assertion").distinct(), "supersession-successor", "supersedes_assertion"),
    )


def evidence_faults(evidence: DataFrame, statements: DataFrame, source_records: DataFrame, digests: DataFrame, roles: tuple[str, ...]) -> DataFrame:
    """Evidence: statement and source record exist, its digest is the source's, decision and role allowed, every statement covered."""
    return all_of(
        dangling(evidence, "statement", statements, "evidence-statement", optional=False),
        dangling(evidence, "source_record", source_records, "evidence-source-record", optional=False),
        unequal_through(evidence, "source_record", digests, {"evidence_source_digest": "digest"}, "evidence-digest"),
        closed_values(evidence, "decision", ("vx:approved",), "evidence-decision"),
        closed_values(evidence, "evidence_role", roles, "evidence-role"),
        uncovered(statements, evidence, "statement", "evidence-coverage"),
    )


def policy_faults(statements: DataFrame, allowed: DataFrame) -> DataFrame:
    """Statements whose (ring or ring pair, type, predicate) no policy allows."""
    ring = F.coalesce("semantic_ring", F.concat_ws(">", "source_ring", "target_ring"))
    return _out(statements.withColumn("ring", ring).join(allowed, ["ring", "statement_type", "predicate"], "left_anti"), "policy-matrix", "id", F.concat_ws("|", "ring", "statement_type", "predicate"))


def both_ways(statements: DataFrame, predicate: str) -> DataFrame:
    """Pairs asserted in both directions with one predicate."""
    one = statements.filter(F.col("predicate") == predicate).select("subject", "object").distinct()
    back = one.select(F.col("subject").alias("object"), F.col("object").alias("subject"))
    return _out(one.join(back, ["subject", "object"], "left_semi").filter("subject < object"), "both-directions", "subject", "object")


def lineage_faults(statements: DataFrame) -> DataFrame:
    """Supersession keeps type, subject, release and ring, and is strictly later."""
    old = statements.select(F.col("id").alias("supersedes_assertion"), *[F.col(c).alias(f"_{c}") for c in ("statement_type", "subject", "source_release", "semantic_ring", "asserted_at")])
    both = statements.filter(F.col("supersedes_assertion").isNotNull()).join(old, "supersedes_assertion")
    moved = [F.when(~F.col(c).eqNullSafe(F.col(f"_{c}")), F.lit(c)) for c in ("statement_type", "subject", "source_release", "semantic_ring")]
    at = lambda c: F.coalesce(F.try_to_timestamp(F.trim(c)), F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd")))
    early = F.when(~F.coalesce(at("asserted_at") > at("_asserted_at"), F.lit(False)), F.lit("asserted_at"))
    found = both.withColumn("_d", F.array_join(F.array_compact(F.array(*moved, early)), ","))
    return _out(found.filter("_d <> ''").distinct(), "supersession-lineage", "id", "_d")


def lifecycle_faults(statements: DataFrame, events: DataFrame) -> DataFrame:
    """Nothing both rescinded and superseded; no target with two events of a kind; every target known."""
    over = statements.select(F.col("supersedes_assertion").alias("applies_to")).dropna().distinct()
    twice = events.groupBy("applies_to", "lifecycle_event_kind").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    return all_of(
        _out(events.filter(F.col("lifecycle_event_kind") == "rescinded").join(over, "applies_to", "left_semi"), "rescinded-and-superseded", "applies_to"),
        _out(twice, "lifecycle-event", "applies_to", "lifecycle_event_kind"),
        dangling(events, "applies_to", statements, "lifecycle-target", key="applies_to"),
    )


def warrant_faults(evidence: DataFrame, warrants: DataFrame, axes: tuple[str, ...]) -> DataFrame:
    """Evidence whose combination of axes is no sanctioned warrant, or whose basis names no binding."""
    based = evidence.filter(F.col("based_on_attestation").isNotNull())
    return all_of(
        _out(evidence.join(warrants, list(axes), "left_anti"), "evidence-warrant", "id", F.concat_ws("|", *axes)),
        dangling(based, "based_on_attestation", evidence, "evidence-basis"),
        _out(based.filter(F.col("based_on_attestation") == F.col("id")), "evidence-basis-self", "id"),
    )


def membership_faults(listed: DataFrame, members: DataFrame) -> DataFrame:
    """(release, id) listed but absent, or present but not listed."""
    a, b = listed.select("release", "id").distinct(), members.select("release", "id").distinct()
    return all_of(_out(a.join(b, ["release", "id"], "left_anti"), "member-missing", "id", "release"), _out(b.join(a, ["release", "id"], "left_anti"), "member-unlisted", "id", "release"))


def independent_proofs(proofs: DataFrame, axes: tuple[str, ...]) -> DataFrame:
    """Requests without two proofs that differ on every axis.

    A request's distinct axis combinations are compared, never its rows.
    """
    once = proofs.select("request", *axes).distinct()
    other = once.select("request", *[F.col(a).alias(f"_{a}") for a in axes])
    apart = reduce(lambda x, y: x & y, [F.col(a) != F.col(f"_{a}") for a in axes])
    good = once.join(other, "request").filter(apart).select("request").distinct()
    return _out(proofs.select("request").distinct().join(good, "request", "left_anti"), "independent-proofs", "request")


def derived_faults(derived: DataFrame, resources: DataFrame, asserted: DataFrame, rules: tuple[str, ...]) -> DataFrame:
    """Derived edges: rules allowed, ends known, and neither the edge nor its inverse asserted."""
    known = asserted.select("subject", "object").distinct()
    inverse = known.select(F.col("object").alias("subject"), F.col("subject").alias("object"))
    return all_of(
        closed_values(derived, "derivation_rule", rules, "derived-rule"),
        dangling(derived, "subject", resources, "derived-subject", optional=False),
        dangling(derived, "object", resources, "derived-object", optional=False),
        _out(derived.join(known.unionByName(inverse).distinct(), ["subject", "object"], "left_semi"), "derived-asserted", "id"),
    )


def partial_supersession_faults(mappings: DataFrame) -> DataFrame:
    """Supersession within a partial set: targets may be absent, but not the row itself; ring kept, strictly later."""
    up = mappings.select("id", "semantic_ring", "asserted_at", F.explode("supersedes").alias("old"))
    old = mappings.select(F.col("id").alias("old"), F.col("semantic_ring").alias("_ring"), F.col("asserted_at").alias("_at"))
    both = up.join(old, "old", "left").distinct()
    at = lambda c: F.coalesce(F.try_to_timestamp(F.trim(c)), F.try_to_timestamp(F.trim(c), F.lit("yyyy-MM-dd")))
    return all_of(
        _out(both.filter("old = id"), "supersession-self", "id"),
        _out(both.filter("_ring <> semantic_ring"), "supersession-ring", "id", "old"),
        _out(both.filter(at("_at") >= at("asserted_at")), "supersession-order", "id", "old"),
    )


def effective(attestations: DataFrame, at: str) -> DataFrame:
    """Attestations in force at a time: approved, attested by then, not yet revoked, within an optional period with open end."""
    t = F.to_timestamp(F.lit(at))
    return attestations.filter((F.col("decision") == "vx:approved") & (F.col("attested") <= t) & F.coalesce(F.col("revoked") > t, F.lit(True)) & F.coalesce(F.col("starts") <= t, F.lit(True)) & F.coalesce(F.col("ends") >= t, F.lit(True)))


def coverage_block(derived: DataFrame) -> DataFrame:
    """(derivation_rule, predicate, edges, stamps, digest): counts, generation stamps, and a digest free of row order."""
    line = F.concat_ws("|", "subject", "predicate", "object")
    sums = derived.groupBy("derivation_rule", "predicate").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("generated_at").alias("stamps"))
    whole = derived.groupBy("derivation_rule", "predicate").agg(*digest_sums(line)).select("derivation_rule", "predicate", digest_text().alias("digest"))
    return sums.join(whole, ["derivation_rule", "predicate"])
