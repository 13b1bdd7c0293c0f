"""Queries of set algebra, aggregates, windows and graph operators."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from lexmesh.operators import graph as G
from lexmesh.operators import multiset as M
from lexmesh.operators.ranks import with_rank
from lexmesh.plans.base import ROLE, SCHEME_A, Atlas, Book

B = Book()

# ---- set and multiset algebra -------------------------------------------------

def _claims(a: Atlas, r: str):
    return a.labels.filter(F.col("release").contains(r)).select("label_role", "value", "language")


_L, _R = ("SELECT label_role, value, language FROM atlas_labels WHERE release LIKE '%" + r + "%'" for r in ("tidewatch", "lodestar"))
_COUNTED = f"l AS (SELECT *, count(*) AS n FROM ({_L}) GROUP BY ALL), r AS (SELECT *, count(*) AS n FROM ({_R}) GROUP BY ALL), b AS (SELECT label_role, value, language, coalesce(l.n, 0) AS a, coalesce(r.n, 0) AS c FROM l FULL JOIN r USING (label_role, value, language))"
B.add("st2_multiset_diff", f"WITH {_COUNTED} SELECT label_role, value, language, 'exact' AS side, least(a, c) AS n FROM b WHERE least(a, c) > 0 UNION ALL SELECT label_role, value, language, 'missing', a - c FROM b WHERE a > c UNION ALL SELECT label_role, value, language, 'added', c - a FROM b WHERE c > a")(
    lambda a: M.multiset_diff(_claims(a, "tidewatch"), _claims(a, "lodestar"))
)
_VER = "SELECT trim(row_id::VARCHAR) AS k, best_relation, confidence FROM relation_verdicts WHERE crosswalk = 'tidewatch-saltmarsh' AND reviewer LIKE '%-{0}'"
B.add(
    "st3_paired_residuals",
    f"""WITH l AS ({_VER.format(0)}), r AS ({_VER.format(1)}), a AS (SELECT * FROM l EXCEPT ALL SELECT * FROM r), c AS (SELECT * FROM r EXCEPT ALL SELECT * FROM l),
    an AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY best_relation NULLS FIRST, confidence NULLS FIRST) AS n FROM a), cn AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY best_relation NULLS FIRST, confidence NULLS FIRST) AS n FROM c)
    SELECT k, CASE WHEN cn.n IS NULL THEN 'missing' WHEN an.n IS NULL THEN 'added' ELSE 'changed' END AS change,
        CASE WHEN an.n IS NOT NULL AND cn.n IS NOT NULL THEN concat_ws(',', CASE WHEN an.best_relation IS DISTINCT FROM cn.best_relation THEN 'best_relation' END, CASE WHEN an.confidence IS DISTINCT FROM cn.confidence THEN 'confidence' END) END AS changed_fields
    FROM an FULL JOIN cn USING (k, n)""",
)(lambda a: M.paired_residuals(*[a.table("relation_verdicts").filter((F.col("crosswalk") == "tidewatch-saltmarsh") & F.col("reviewer").endswith(f"-{i}")).select(F.col("row_id").cast("string").alias("k"), "best_relation", "confidence") for i in (0, 1)], ["k"], ["best_relation", "confidence"]))


def _ranks(a: Atlas):
    """Reviewers' confidence levels stand for arms over verdict rows."""
    return a.table("relation_verdicts").filter("confidence IS NOT NULL").select(F.col("row_id").alias("pair"), F.col("confidence").alias("arm"))


def _gold(a: Atlas):
    return a.table("relation_verdicts").filter("best_relation = 'same' AND relation_exists").select(F.col("row_id").alias("pair"))


_P = "p AS (SELECT DISTINCT row_id AS pair, confidence AS arm FROM relation_verdicts WHERE confidence IS NOT NULL), g AS (SELECT DISTINCT row_id AS pair FROM relation_verdicts WHERE best_relation = 'same' AND relation_exists)"
B.add("st4_arm_unions", f"WITH {_P}, n AS (SELECT pair, count(*) AS n FROM p GROUP BY 1) SELECT arm, count(*) AS candidates, count(g.pair) AS hits, count(*) FILTER (g.pair IS NOT NULL AND n = 1) AS unique_hits FROM p JOIN n USING (pair) LEFT JOIN g USING (pair) GROUP BY 1")(lambda a: M.arm_unions(_ranks(a), _gold(a)))
B.add("st4_arm_overlaps", f"WITH {_P}, s AS (SELECT arm, count(*) AS n FROM p GROUP BY 1), b AS (SELECT x.arm AS arm_1, y.arm AS arm_2, count(*) AS both_ FROM p x JOIN p y USING (pair) WHERE x.arm < y.arm GROUP BY ALL) SELECT arm_1, arm_2, both_ AS \"both\", s1.n + s2.n - both_ AS \"union\" FROM b JOIN s s1 ON s1.arm = arm_1 JOIN s s2 ON s2.arm = arm_2")(lambda a: M.arm_overlaps(_ranks(a)))
B.add("st5_bitmap_counts", "SELECT reviewer, count(DISTINCT row_id) AS \"distinct\" FROM relation_verdicts GROUP BY 1")(lambda a: M.bitmap_counts(a.table("relation_verdicts"), "reviewer", "row_id"))
B.add(
    "st6_partition_faults",
    """WITH p AS (SELECT DISTINCT row_id, 'a' AS p FROM relation_verdicts WHERE confidence = 'high' UNION ALL SELECT DISTINCT row_id, 'b' FROM relation_verdicts WHERE confidence = 'low'), n AS (SELECT row_id, count(*) AS n FROM p GROUP BY 1),
    u AS (SELECT DISTINCT row_id, 1 AS i FROM relation_verdicts WHERE relation_exists) SELECT CASE WHEN i IS NULL THEN 'outside' WHEN n IS NULL THEN 'uncovered' ELSE 'overlap' END AS fault, row_id FROM u FULL JOIN n USING (row_id) WHERE i IS NULL OR n IS NULL OR n > 1""",
)(lambda a: M.partition_faults({c: a.table("relation_verdicts").filter(F.col("confidence") == c) for c in ("high", "low")}, a.table("relation_verdicts").filter("relation_exists"), "row_id"))
B.add("st7_set_difference", f"WITH l AS (SELECT DISTINCT * FROM ({_L})), r AS (SELECT DISTINCT * FROM ({_R})) SELECT *, 'missing' AS side FROM (SELECT * FROM l EXCEPT SELECT * FROM r) UNION ALL SELECT *, 'extra' FROM (SELECT * FROM r EXCEPT SELECT * FROM l)")(
    lambda a: M.set_difference(_claims(a, "tidewatch"), _claims(a, "lodestar"))
)
_TRIPLE = "SELECT DISTINCT subject, predicate, object FROM atlas_statements WHERE statement_type = '{0}'"
B.add("st8_projection_equality", f"SELECT *, 'missing' AS side FROM ({_TRIPLE.format('NativeRelationAssertion')} EXCEPT {_TRIPLE.format('MappingAssertion')}) UNION ALL SELECT *, 'extra' FROM ({_TRIPLE.format('MappingAssertion')} EXCEPT {_TRIPLE.format('NativeRelationAssertion')})")(
    lambda a: M.set_difference(*[a.statements.filter(F.col("statement_type") == t).select("subject", "predicate", "object") for t in ("NativeRelationAssertion", "MappingAssertion")])
)
B.add(
    "st9_ledger_balance",
    "WITH d AS (SELECT source_sha256, CAST(sum(row_count) AS BIGINT) AS declared FROM gcmd_hierarchies GROUP BY 1), l AS (SELECT source_sha256, count(*) AS linked FROM gcmd_hierarchy_edges GROUP BY 1) SELECT source_sha256, coalesce(declared, 0) AS declared, coalesce(linked, 0) AS linked FROM d FULL JOIN l USING (source_sha256) WHERE coalesce(declared, 0) <> coalesce(linked, 0)",
)(lambda a: M.ledger_balance(a.table("gcmd_hierarchies").withColumnRenamed("row_count", "declared"), a.table("gcmd_hierarchy_edges"), "source_sha256"))
_CLASS = "CASE WHEN relation_exists AND best_relation = 'same' THEN 'admitted' WHEN confidence = 'low' THEN 'control' WHEN relation_exists AND best_relation = 'unrelated' THEN 'disputed' ELSE 'remainder' END"
B.add("st12_first_class", f"SELECT {_CLASS} AS class, count(*) AS n FROM relation_verdicts GROUP BY 1")(
    lambda a: M.first_class(a.table("relation_verdicts"), [("admitted", F.expr("relation_exists AND best_relation = 'same'")), ("control", F.expr("confidence = 'low'")), ("disputed", F.expr("relation_exists AND best_relation = 'unrelated'"))], "remainder").groupBy("class").agg(F.count(F.lit(1)).alias("n"))
)
B.add(
    "st13_served_faults",
    """WITH a AS (SELECT 'statement' AS role, id, count(*) AS a FROM atlas_statements GROUP BY 2), s AS (SELECT 'statement' AS role, statement AS id, count(*) AS s FROM atlas_evidence_bindings GROUP BY 2)
    SELECT role, id, CASE WHEN s IS NULL THEN 'not served' WHEN a IS NULL THEN 'not asserted' ELSE 'repeated' END AS fault FROM a FULL JOIN s USING (role, id) WHERE s IS NULL OR a IS NULL OR s > 1""",
)(lambda a: M.served_faults(a.evidence_bindings.select(F.lit("statement").alias("role"), F.col("statement").alias("id")), a.statements.select(F.lit("statement").alias("role"), "id")))
B.add("ag22_dedupe_accounts", "WITH n AS (SELECT reviewer, row_id, best_relation, count(*) AS n, count(confidence) AS a FROM relation_verdicts GROUP BY ALL) SELECT reviewer, CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - a) AS BIGINT) AS anchorless, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS redundant FROM n GROUP BY 1")(
    lambda a: M.dedupe_accounts(a.table("relation_verdicts"), "reviewer", "confidence", ["row_id", "best_relation"])
)
B.add("ag23_roll_up", "WITH n AS (SELECT reviewer, row_id, best_relation, count(*) AS n, count(confidence) AS a FROM relation_verdicts GROUP BY ALL) SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(n - a) AS BIGINT) AS anchorless, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS redundant FROM n")(
    lambda a: M.roll_up(M.dedupe_accounts(a.table("relation_verdicts"), "reviewer", "confidence", ["row_id", "best_relation"]))
)
B.add("ag28_keep_first", "SELECT resource, language, value FROM atlas_labels QUALIFY row_number() OVER (PARTITION BY resource, language ORDER BY value, id) = 1")(lambda a: M.keep_first(a.labels, ["resource", "language"], [F.col("value"), F.col("id")]).select("resource", "language", "value"))
_OWN = "SELECT value AS iri, release AS owner, label_role = 'preferred' AS held, CASE WHEN language = 'en' THEN 0 ELSE 1 END AS preference FROM atlas_labels"
B.add("jn25_owners", f"SELECT iri, owner FROM ({_OWN}) QUALIFY row_number() OVER (PARTITION BY iri ORDER BY held DESC, preference, owner) = 1")(
    lambda a: M.owners(a.labels.select(F.col("value").alias("iri"), F.col("release").alias("owner"), (F.col("label_role") == "preferred").alias("held"), F.when(F.col("language") == "en", 0).otherwise(1).alias("preference")))
)
B.add("in6_release_uniqueness", "SELECT scheme, string_agg(DISTINCT release, ',' ORDER BY release) AS members FROM atlas_resources GROUP BY 1 HAVING count(DISTINCT release) > 1")(lambda a: M.conflict_sets(a.resources, ["scheme"], "release"))
B.add("ag16_conflict_sets", "SELECT scheme, notation, string_agg(DISTINCT id, ',' ORDER BY id) AS members FROM (SELECT id, scheme, unnest(notations) AS notation FROM atlas_resources) GROUP BY 1, 2 HAVING count(DISTINCT id) > 1")(lambda a: M.conflict_sets(a.resources.select("id", "scheme", F.explode("notations").alias("notation")), ["scheme", "notation"], "id"))

# ---- aggregates ---------------------------------------------------------------
B.add(
    "ag18_kind_census",
    "WITH v AS (SELECT scheme, notation, count(*) AS n, count(DISTINCT id) AS r FROM (SELECT id, scheme, unnest(notations) AS notation FROM atlas_resources) GROUP BY ALL) SELECT scheme, CAST(sum(n) AS BIGINT) AS claims, count(*) AS distinct_values, count(*) FILTER (r > 1) AS collisions, CAST(max(r) AS BIGINT) AS max_owners FROM v GROUP BY 1",
)(
    lambda a: a.resources.select("id", "scheme", F.explode("notations").alias("notation")).groupBy("scheme", "notation").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("id").alias("r")).groupBy("scheme").agg(F.sum("n").alias("claims"), F.count(F.lit(1)).alias("distinct_values"), F.count_if(F.col("r") > 1).alias("collisions"), F.max("r").alias("max_owners"))
)
B.add("ag19_coverage_roll_up", "SELECT epistemic_basis, attestor_kind, count(*) AS n, count(*) FILTER (based_on_attestation IS NOT NULL) AS based FROM atlas_evidence_bindings GROUP BY ALL")(lambda a: a.evidence_bindings.groupBy("epistemic_basis", "attestor_kind").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("based_on_attestation").isNotNull()).alias("based")))
B.add("ag20_fact_merge", "SELECT subject, string_agg(DISTINCT predicate || '=' || object, ';' ORDER BY predicate || '=' || object) AS facts FROM atlas_statements GROUP BY 1")(lambda a: a.statements.groupBy("subject").agg(F.array_join(F.array_sort(F.collect_set(F.concat("predicate", F.lit("="), "object"))), ";").alias("facts")))
B.add(
    "ag21_resource_summary",
    f"SELECT resource, first(value ORDER BY {ROLE}, lower(value), value) AS display, string_agg(DISTINCT value, '|' ORDER BY value) AS all_labels, count(DISTINCT language) AS languages, CAST(count(DISTINCT release) > 1 AS BOOLEAN) AS mixed_release FROM atlas_labels GROUP BY 1",
)(lambda a: a.labels.groupBy("resource").agg(F.min_by("value", F.struct(_role(), F.lower("value"), "value")).alias("display"), F.array_join(F.array_sort(F.collect_set("value")), "|").alias("all_labels"), F.count_distinct("language").alias("languages"), (F.count_distinct("release") > 1).alias("mixed_release")))


def _role():
    from lexmesh.functions.labels import role_rank

    return role_rank("label_role")


#: The relation a complete set of verdicts licenses.
_FOLD = [("exactMatch", ["same"]), ("closeMatch", ["same", "near_same"]), ("broadMatch", ["target_is_broader"]), ("narrowMatch", ["target_is_narrower"]), ("relatedMatch", ["related"])]
_V = "v AS (SELECT row_id, list(DISTINCT best_relation) AS v FROM relation_verdicts WHERE best_relation IS NOT NULL GROUP BY 1)"
B.add(
    "ag24_verdict_fold",
    f"WITH {_V} SELECT row_id, CASE " + " ".join(f"WHEN len(list_filter(v, lambda x: x NOT IN ({', '.join(repr(s) for s in ok)}))) = 0 THEN '{name}'" for name, ok in _FOLD) + " END AS relation FROM v",
)(lambda a: _folded(a.table("relation_verdicts").filter("best_relation IS NOT NULL").groupBy("row_id").agg(F.collect_set("best_relation").alias("v"))))


def _folded(df):
    out = F.lit(None).cast("string")
    for name, ok in reversed(_FOLD):
        out = F.when(F.size(F.array_except("v", F.array(*[F.lit(x) for x in ok]))) == 0, name).otherwise(out)
    return df.select("row_id", out.alias("relation"))


B.add("ag25_quantiles", "WITH r AS (SELECT reviewer, row_id, row_number() OVER (PARTITION BY reviewer ORDER BY row_id) AS n, count(*) OVER (PARTITION BY reviewer) AS c FROM relation_verdicts) SELECT reviewer, max(row_id) FILTER (n = ceil(c * 0.5)) AS p50, max(row_id) FILTER (n = ceil(c * 0.95)) AS p95 FROM r GROUP BY 1")(
    lambda a: _quantiles(a)
)


def _quantiles(a: Atlas):
    """Ceil-index quantiles: values are counted per annotator first, then located by running counts."""
    n = a.table("relation_verdicts").groupBy("reviewer", "row_id").agg(F.count(F.lit(1)).alias("n"))
    run = Window.partitionBy("reviewer").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    r = n.withColumn("_to", F.sum("n").over(run)).withColumn("_c", F.sum("n").over(Window.partitionBy("reviewer")))
    return r.groupBy("reviewer").agg(*[F.min(F.when(F.col("_to") >= F.ceil(F.col("_c") * q), F.col("row_id"))).alias(name) for q, name in ((0.5, "p50"), (0.95, "p95"))])


_BROADER = "SELECT DISTINCT subject AS a, object AS b FROM atlas_statements WHERE predicate = 'skos:broader' AND subject <> object"


def _broader(a: Atlas):
    return a.statements.filter("predicate = 'skos:broader' AND subject <> object").select(F.col("subject").alias("a"), F.col("object").alias("b")).distinct()


B.add(
    "ag26_degree_report",
    f"WITH e AS ({_BROADER}), d AS (SELECT node, count(*) AS degree FROM (SELECT a AS node FROM e UNION ALL SELECT b FROM e) GROUP BY 1), r AS (SELECT degree, row_number() OVER (ORDER BY degree DESC) AS n, count(*) OVER () AS c FROM d) SELECT max(degree) AS max_degree, median(degree) AS median_degree, sum(degree) FILTER (n <= ceil(c / 10)) / sum(degree) AS top_share FROM r",
)(lambda a: G.degree_report(_broader(a)))

# ---- graph --------------------------------------------------------------------
_CLOSED = f"e AS ({_BROADER}), reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b)"
_STEPS = f"e AS ({_BROADER}), s1 AS (SELECT a, b, 1 AS depth FROM e), s2 AS (SELECT x.a, y.b, 2 AS depth FROM s1 x JOIN e y ON y.a = x.b), s3 AS (SELECT x.a, y.b, 3 AS depth FROM (SELECT DISTINCT a, b FROM s2) x JOIN e y ON y.a = x.b), every AS (SELECT a, b, min(depth) AS depth FROM (SELECT * FROM s1 UNION ALL SELECT * FROM s2 UNION ALL SELECT * FROM s3) GROUP BY ALL)"
B.add("gr9_reachability", f"WITH RECURSIVE {_CLOSED} SELECT a, b FROM reach")(lambda a: G.reachable(_broader(a)).select("a", "b"))
B.add("gr12_bounded_ancestors", f"WITH {_STEPS} SELECT a, b, depth FROM every")(lambda a: G.reachable(_broader(a), 3))
B.add("gr12_closure_report", f"WITH {_STEPS} SELECT depth, count(*) AS pairs FROM every GROUP BY 1")(lambda a: G.closure_report(G.reachable(_broader(a), 3)))
B.add("gr13_closure_pairs", f"WITH {_STEPS} SELECT DISTINCT least(a, b) AS a, greatest(a, b) AS b FROM every WHERE a <> b")(lambda a: G.reachable(_broader(a), 3).filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
B.add("gr13_siblings", f"WITH e AS ({_BROADER}) SELECT DISTINCT x.a, y.a AS b FROM e x JOIN e y ON x.b = y.b WHERE x.a < y.a")(lambda a: G.siblings(_broader(a)))
B.add("gr14_cyclic_core", f"WITH RECURSIVE {_CLOSED}, c AS (SELECT a AS n FROM reach WHERE a = b) SELECT e.a, e.b FROM e WHERE (e.a IN (SELECT n FROM c) OR EXISTS (SELECT 1 FROM reach r JOIN c ON c.n = r.a WHERE r.b = e.a)) AND (e.b IN (SELECT n FROM c) OR EXISTS (SELECT 1 FROM reach r JOIN c ON c.n = r.b WHERE r.a = e.b))")(
    lambda a: G.cyclic_core(_broader(a))
)
_EXACT = "x AS (SELECT DISTINCT subject AS a, object AS b FROM atlas_statements WHERE predicate IN ('skos:exactMatch', 'skos:closeMatch') AND subject <> object), u AS (SELECT a, b FROM x UNION SELECT b, a FROM x), w AS (SELECT a, a AS b FROM u UNION SELECT w.a, u.b FROM w JOIN u ON u.a = w.b), comp AS (SELECT a AS node, min(b) AS root FROM w GROUP BY 1)"


def _matches(a: Atlas):
    return a.statements.filter("predicate IN ('skos:exactMatch', 'skos:closeMatch')").select(F.col("subject").alias("a"), F.col("object").alias("b"))


B.add("gr7_components", f"WITH RECURSIVE {_EXACT} SELECT node, root FROM comp")(lambda a: G.components(_matches(a)))
B.add("gr15_component_sizes", f"WITH RECURSIVE {_EXACT}, n AS (SELECT root, count(*) AS nodes FROM comp GROUP BY 1) SELECT root, nodes, CAST(nodes * (nodes - 1) / 2 AS BIGINT) AS inferred_pairs FROM n")(lambda a: G.component_sizes(G.components(_matches(a))))
_RELATED = "SELECT DISTINCT subject AS a, object AS b FROM atlas_statements WHERE predicate = 'skos:related'"
B.add("gr10_related_and_connected", f"WITH RECURSIVE {_CLOSED}, t AS (SELECT a, b FROM reach UNION SELECT b, a FROM reach) SELECT DISTINCT r.a, r.b FROM ({_RELATED}) r JOIN t USING (a, b)")(lambda a: G.related_and_connected(a.statements.filter("predicate = 'skos:related'").select(F.col("subject").alias("a"), F.col("object").alias("b")), _broader(a)))
B.add("gr11_cross_release_related", f"WITH RECURSIVE {_CLOSED}, t AS (SELECT a, b FROM reach UNION SELECT b, a FROM reach) SELECT DISTINCT s.id FROM atlas_statements s JOIN t ON t.a = s.subject AND t.b = s.object WHERE s.predicate = 'skos:related' AND s.source_release <> s.target_release")(
    lambda a: (lambda rel: rel.join(G.related_and_connected(rel, _broader(a)), ["a", "b"], "left_semi").select("id").distinct())(a.statements.filter("predicate = 'skos:related' AND source_release <> target_release").select("id", F.col("subject").alias("a"), F.col("object").alias("b")))
)
B.add("gr15_two_hops", f"WITH e AS ({_BROADER}), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e) SELECT DISTINCT x.b AS a, y.b FROM u x JOIN u y ON x.a = y.a WHERE x.b < y.b AND NOT EXISTS (SELECT 1 FROM u WHERE u.a = x.b AND u.b = y.b)")(lambda a: G.two_hop_pairs(_broader(a)))
_KIND = "CASE WHEN predicate IN ('skos:broader', 'skos:narrower') THEN 'hierarchy' WHEN predicate = 'skos:related' THEN 'associative' END"
_FLIP = "(predicate = 'skos:narrower' OR (predicate = 'skos:related' AND subject > object))"
B.add("gr18_oriented_relations", f"SELECT kind, a, b, string_agg(DISTINCT predicate, ',' ORDER BY predicate) AS predicates, count(DISTINCT f) AS directions FROM (SELECT {_KIND} AS kind, CASE WHEN {_FLIP} THEN object ELSE subject END AS a, CASE WHEN {_FLIP} THEN subject ELSE object END AS b, predicate, {_FLIP} AS f FROM atlas_statements WHERE subject <> object) WHERE kind IS NOT NULL GROUP BY ALL")(
    lambda a: G.oriented(a.statements, ("skos:broader",), ("skos:narrower",), ("skos:related",))
)
B.add("gr17_projection", "SELECT subject, predicate, object, assertions, sha256(concat_ws('|', subject, predicate, object, assertions)) AS id FROM (SELECT subject, predicate, object, string_agg(DISTINCT id, ',' ORDER BY id) AS assertions FROM atlas_statements GROUP BY 1, 2, 3)")(lambda a: G.projection(a.statements))
_CODES = "code AS (SELECT DISTINCT 'urn:part:' || p_partkey AS resource, array_to_string(string_split(CAST(p_partkey AS VARCHAR), ''), '.') AS code FROM part)"
_OUTCOME = "own AS (SELECT code AS parent_code, count(*) AS n, min(resource) AS owner FROM code GROUP BY 1), j AS (SELECT c.resource, c.code, c.parent_code, o.n, o.owner FROM cited c LEFT JOIN own o USING (parent_code)) SELECT resource, code, parent_code, CASE WHEN n = 1 AND owner <> resource THEN owner END AS parent, CASE WHEN parent_code IS NULL THEN 'root' WHEN n IS NULL THEN 'missing' WHEN n > 1 THEN 'ambiguous' WHEN owner = resource THEN 'self' ELSE 'edge' END AS outcome FROM j"


def _codes(a: Atlas):
    """Part keys as tree numbers, one level per digit."""
    return a.table("part").select(F.concat(F.lit("urn:part:"), F.col("p_partkey").cast("string")).alias("resource"), F.array_join(F.split(F.col("p_partkey").cast("string"), ""), ".").alias("code"))


B.add("gr1_tree_number_parents", f"WITH {_CODES}, cited AS (SELECT *, CASE WHEN contains(code, '.') THEN regexp_replace(code, '\\.[^.]*$', '') END AS parent_code FROM code), {_OUTCOME}")(
    lambda a: G.prefix_parents(_codes(a), F.when(F.contains("code", F.lit(".")), F.regexp_replace("code", r"\.[^.]*$", "")))
)
B.add("gr2_path_parents", f"WITH {_CODES}, cited AS (SELECT *, CASE WHEN len(string_split(code, '.')) > 1 THEN array_to_string(string_split(code, '.')[:-2], '.') END AS parent_code FROM code), {_OUTCOME}")(
    lambda a: G.prefix_parents(_codes(a), F.when(F.size(F.split("code", r"\.")) > 1, F.array_join(F.slice(F.split("code", r"\."), F.lit(1), F.size(F.split("code", r"\.")) - 1), ".")))
)
_HEAD = f"code AS (SELECT DISTINCT l.resource, l.value AS code FROM atlas_labels l JOIN atlas_resources r ON r.id = l.resource WHERE l.label_role = 'preferred' AND r.scheme = '{SCHEME_A}')"
B.add("gr3_compound_heads", f"WITH {_HEAD}, cited AS (SELECT *, CASE WHEN contains(code, ' ') THEN split_part(code, ' ', 1) END AS parent_code FROM code), {_OUTCOME}")(
    lambda a: G.prefix_parents(a.labels.filter("label_role = 'preferred'").join(a.resources.filter(F.col("scheme") == SCHEME_A).select(F.col("id").alias("resource")).distinct(), "resource").select("resource", F.col("value").alias("code")), F.when(F.contains("code", F.lit(" ")), F.substring_index("code", " ", 1)))
)
_DIG = "dig AS (SELECT 'urn:part:' || CAST(row_number() OVER (ORDER BY id) AS VARCHAR) AS resource, id AS assertion, content_digest AS digest FROM (SELECT DISTINCT id, content_digest FROM atlas_statements))"


def _evidence(a: Atlas):
    """Numbered statements stand for the assertions behind part numbers."""
    return with_rank(a.statements.select(F.col("id").alias("assertion"), F.col("content_digest").alias("digest")).distinct(), ["assertion"], "_n").select(F.concat(F.lit("urn:part:"), (F.col("_n") + 1).cast("string")).alias("resource"), "assertion", "digest")


B.add(
    "gr4_derived_rows",
    f"""WITH {_CODES}, cited AS (SELECT *, CASE WHEN contains(code, '.') THEN regexp_replace(code, '\\.[^.]*$', '') END AS parent_code FROM code), own AS (SELECT code AS parent_code, count(*) AS n, min(resource) AS owner FROM code GROUP BY 1),
    edge AS (SELECT c.resource, o.owner AS parent FROM cited c JOIN own o USING (parent_code) WHERE n = 1 AND owner <> resource), {_DIG},
    used AS (SELECT resource, string_agg(assertion || '=' || hex(digest), ';' ORDER BY assertion) AS line, string_agg(assertion, ',' ORDER BY assertion) AS assertions FROM dig GROUP BY 1 HAVING count(*) = count(digest)),
    d AS (SELECT resource, parent, sha256(line) AS digest, assertions FROM edge JOIN used USING (resource)), h AS (SELECT *, sha256(concat_ws('|', resource, 'skos:broader', parent, 'tree-number', digest)) AS c FROM d)
    SELECT 'urn:derived:' || c AS id, resource AS subject, 'skos:broader' AS predicate, parent AS object, 'tree-number' AS derivation_rule, assertions AS derived_from_assertions, digest AS input_digest, '2024-01-01T00:00:00Z' AS generated_at, c AS content_digest FROM h""",
)(lambda a: G.derive_rows(G.prefix_parents(_codes(a), F.when(F.contains("code", F.lit(".")), F.regexp_replace("code", r"\.[^.]*$", ""))).filter("outcome = 'edge'"), _evidence(a), "tree-number", "skos:broader", "2024-01-01T00:00:00Z"))
B.add("gr6_rule_replay", f"WITH {_CODES}, cited AS (SELECT *, CASE WHEN contains(code, '.') THEN regexp_replace(code, '\\.[^.]*$', '') END AS parent_code FROM code), own AS (SELECT code AS parent_code, count(*) AS n, min(resource) AS owner FROM code GROUP BY 1), now_ AS (SELECT c.resource, o.owner AS parent FROM cited c JOIN own o USING (parent_code) WHERE n = 1 AND owner <> resource), ship AS (SELECT 'urn:part:' || p_partkey AS resource, 'urn:part:' || CAST(p_partkey // 10 AS VARCHAR) AS parent FROM part WHERE p_partkey >= 10 AND p_size > 5) SELECT *, 'missing' AS side FROM (SELECT * FROM now_ EXCEPT SELECT * FROM ship) UNION ALL SELECT *, 'extra' FROM (SELECT * FROM ship EXCEPT SELECT * FROM now_)")(
    lambda a: _replayed(a)
)


def _replayed(a: Atlas):
    from lexmesh import rules

    rule = rules.Rule("tree-number", "skos:broader", _tree_edges)
    key = F.col("p_partkey")
    shipped = a.table("part").filter("p_partkey >= 10 AND p_size > 5").select(F.concat(F.lit("urn:part:"), key.cast("string")).alias("resource"), F.concat(F.lit("urn:part:"), F.floor(key / 10).cast("string")).alias("parent"))
    return rules.replay(rule, _codes(a), shipped)


def _tree_edges(codes):
    return G.prefix_parents(codes, F.when(F.contains("code", F.lit(".")), F.regexp_replace("code", r"\.[^.]*$", ""))).filter("outcome = 'edge'").select("resource", "parent")


_PATHROWS = "SELECT c.id, c.subject, e.object, c.object AS mid FROM atlas_statements c JOIN atlas_statements e ON e.subject = c.object WHERE c.predicate = 'skos:broader' AND e.predicate = 'skos:related'"
B.add("gr8_cited_paths", f"SELECT id, 'no simple path' AS fault FROM (SELECT id || '|' || object AS id, subject, object, mid FROM ({_PATHROWS}) GROUP BY ALL) WHERE subject = object OR subject = mid OR mid = object GROUP BY ALL")(lambda a: _cited(a))


def _cited(a: Atlas):
    """Two-step paths of a broader and a related statement stand for cited evidence."""
    c = a.statements.filter("predicate = 'skos:broader'").select("id", "subject", F.col("object").alias("mid"))
    e = a.statements.filter("predicate = 'skos:related'").select(F.col("subject").alias("mid"), "object")
    rows = c.join(e, "mid").select(F.concat_ws("|", "id", "object").alias("id"), "subject", "object", "mid").distinct()
    return G.cited_path_faults(rows.select("id", "subject", "object", F.array(F.struct(F.col("subject").alias("a"), F.col("mid").alias("b")), F.struct(F.col("mid").alias("a"), F.col("object").alias("b"))).alias("edges")))


#: From a mode over a kind of edge to the next mode: up any number of times, then at most one step across.
_MOVES = [("start", "up", "up"), ("up", "up", "up"), ("start", "across", "across"), ("up", "across", "across")]
_TYPED = """WITH RECURSIVE e AS (SELECT DISTINCT subject AS a, object AS b, CASE WHEN predicate = 'skos:broader' THEN 'up' ELSE 'across' END AS kind FROM atlas_statements WHERE predicate IN ('skos:broader', 'skos:related')),
    goal AS (SELECT DISTINCT subject AS source, object AS target FROM atlas_statements WHERE statement_type = 'MappingAssertion'), m(mode, kind, nxt) AS (VALUES ('start', 'up', 'up'), ('up', 'up', 'up'), ('start', 'across', 'across'), ('up', 'across', 'across')),
    w AS (SELECT DISTINCT source, source AS node, 'start' AS mode, 0 AS steps FROM goal UNION SELECT w.source, e.b, m.nxt, w.steps + 1 FROM w JOIN e ON e.a = w.node JOIN m ON m.mode = w.mode AND m.kind = e.kind WHERE w.steps < 4)
    SELECT source, target, CAST(min(steps) AS INT) AS steps, arg_min(mode, (steps, mode)) AS mode FROM w JOIN goal g USING (source) WHERE g.target = w.node AND steps > 0 GROUP BY ALL"""
B.add("gr16_typed_paths", _TYPED)(
    lambda a: G.typed_paths(
        a.statements.filter("predicate IN ('skos:broader', 'skos:related')").select(F.col("subject").alias("a"), F.col("object").alias("b"), F.when(F.col("predicate") == "skos:broader", "up").otherwise("across").alias("kind")).distinct(),
        _MOVES, "start", a.statements.filter("statement_type = 'MappingAssertion'").select(F.col("subject").alias("source"), F.col("object").alias("target")),
    )
)
B.add(
    "cg12_follow_chain",
    """WITH RECURSIVE l AS (SELECT DISTINCT id AS a, supersedes_assertion AS b FROM atlas_statements WHERE supersedes_assertion IS NOT NULL), n AS (SELECT a, count(*) AS n, min(b) AS b FROM l GROUP BY 1), s AS (SELECT a, b FROM n WHERE n = 1),
    w AS (SELECT a AS start, b AS at_, 1 AS steps FROM s UNION ALL SELECT w.start, s.b, w.steps + 1 FROM w JOIN s ON s.a = w.at_ WHERE w.steps < 60), last AS (SELECT start, arg_max(at_, steps) AS sink, max(steps) AS steps FROM w GROUP BY 1)
    SELECT start, CASE WHEN steps < 60 THEN sink END AS sink, CASE WHEN steps < 60 THEN CAST(steps AS BIGINT) END AS steps, CASE WHEN steps >= 60 THEN 'cycle' WHEN sink IN (SELECT a FROM n WHERE n > 1) THEN 'branch' ELSE 'resolved' END AS outcome FROM last""",
)(lambda a: G.follow_chain(a.statements.filter("supersedes_assertion IS NOT NULL").select(F.col("id").alias("a"), F.col("supersedes_assertion").alias("b"))))
QUERIES, SQL = B.queries, B.sql
