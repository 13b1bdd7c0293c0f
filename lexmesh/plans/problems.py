"""Driver queries of the general large-table problems, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.operators.hierarchy import keyword_edges, on_cycle, resolve_hierarchy
from lexmesh.operators.orphans import orphan_references, scoped_references
from lexmesh.operators.snapshots import latest_changes, snapshot_changes
from lexmesh.storage import materialize, scratch_dir, table


def _edges(spark: SparkSession, d: str) -> DataFrame:
    return keyword_edges(table(spark, d, "gcmd_hierarchy_edges"), table(spark, d, "gcmd_hierarchies"))


def _hierarchy(spark: SparkSession, d: str, **how) -> DataFrame:
    return resolve_hierarchy(_edges(spark, d), "keyword_version", "child", "parent", **how)


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return _hierarchy(spark, d).select(F.col("tree").alias("keyword_version"), F.col("node").alias("node_uuid"), F.col("root").alias("root_uuid"), "depth")


def p3_paths(spark: SparkSession, d: str) -> DataFrame:
    """Full path of every node from its root, as text."""
    return _hierarchy(spark, d, paths=True).select(F.col("tree").alias("keyword_version"), F.col("node").alias("node_uuid"), F.array_join("path", "/").alias("path"), "depth")


def p3_descendants(spark: SparkSession, d: str) -> DataFrame:
    """All (ancestor, descendant) pairs with their distance."""
    nodes = _hierarchy(spark, d, paths=True).filter("depth >= 1").select("tree", "node", "depth", F.posexplode(F.slice("path", F.lit(1), F.col("depth").cast("int"))).alias("at", "ancestor"))
    return nodes.select(F.col("tree").alias("keyword_version"), F.col("ancestor").alias("ancestor_uuid"), F.col("node").alias("descendant_uuid"), (F.col("depth") - F.col("at")).alias("distance"))


def p3_cycles(spark: SparkSession, d: str) -> DataFrame:
    """Nodes caught in a cycle, on it or below it."""
    edges = materialize(_edges(spark, d))
    caught = materialize(resolve_hierarchy(edges, "keyword_version", "child", "parent").filter("depth = -1"))
    on = on_cycle(caught, edges, "keyword_version", "child", "parent").withColumn("_on", F.lit(True))
    return caught.join(on, ["tree", "node"], "left").select(F.col("tree").alias("keyword_version"), F.col("node").alias("node_uuid"), F.when(F.col("_on"), "on cycle").otherwise("below cycle").alias("place"))


def p3_roots(spark: SparkSession, d: str) -> DataFrame:
    """Declared and true number of roots of every keyword version; a version without edges has none."""
    true = _hierarchy(spark, d).groupBy(F.col("tree").alias("keyword_version")).agg(F.count_if(F.col("depth") == 0).alias("true_roots"), F.count(F.lit(1)).alias("nodes"))
    declared = table(spark, d, "gcmd_hierarchies").select("keyword_version", F.col("root_count").alias("declared_roots"))
    both = declared.join(true, "keyword_version", "left")
    return both.select("keyword_version", "declared_roots", F.coalesce("true_roots", F.lit(0)).alias("true_roots"), F.coalesce("nodes", F.lit(0)).alias("nodes"))


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return snapshot_changes(table(spark, d, "resource_snapshots"), table(spark, d, "atlas_releases")).select("release", "id", "change_kind")


def p4_changes(spark: SparkSession, d: str) -> DataFrame:
    """Changes with the columns that differ."""
    return snapshot_changes(table(spark, d, "resource_snapshots"), table(spark, d, "atlas_releases"))


def p4_summary(spark: SparkSession, d: str) -> DataFrame:
    """Number of changes by scheme, release and kind."""
    return p4_changes(spark, d).groupBy("scheme", "release", "change_kind").agg(F.count(F.lit(1)).alias("records"))


def p4_latest(spark: SparkSession, d: str) -> DataFrame:
    """Changes of each scheme's last delivery, merged with the one before out of a kept store."""
    return latest_changes(table(spark, d, "resource_snapshots"), table(spark, d, "atlas_releases"), f"{scratch_dir(spark)}/snapshots-{uuid.uuid4().hex}")


def _orphans(spark: SparkSession, d: str) -> DataFrame:
    return orphan_references(*[table(spark, d, t) for t in ("atlas_resources", "atlas_statements", "atlas_evidence_bindings", "atlas_labels")])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    return _orphans(spark, d).select("referring_table", "referring_field", "record_id", "orphan_kind").distinct()


def p6_report(spark: SparkSession, d: str) -> DataFrame:
    """Number of orphan references per table, field, kind and month of loading."""
    month = F.date_format("loaded_at", "yyyy-MM").alias("month")
    return _orphans(spark, d).groupBy("referring_table", "referring_field", "orphan_kind", month).agg(F.count(F.lit(1)).alias("orphans"))


def _scoped(match: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return scoped_references(table(spark, d, "atlas_resources"), table(spark, d, "atlas_statements"), match)

    run.__name__ = f"p6_{match}_match"
    return run


QUERIES = {f.__name__: f for f in (p3_found, p3_paths, p3_descendants, p3_cycles, p3_roots, p4_found, p4_changes, p4_summary, p4_latest, p6_found, p6_report, *map(_scoped, ("simple", "partial", "full")))}

_UUID = "regexp_replace(right(lower(regexp_replace({0}, '[\\s{{}}-]', '', 'g')), 32), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})(.{{12}})$', '\\1-\\2-\\3-\\4-\\5')"
_TREE = f"""
    WITH RECURSIVE edge AS (
        SELECT DISTINCT h.keyword_version AS v, {_UUID.format("e.child_uuid")} AS c, {_UUID.format("e.parent_uuid")} AS p
        FROM gcmd_hierarchy_edges e JOIN gcmd_hierarchies h USING (source_sha256)),
    node AS (SELECT v, c AS n FROM edge UNION SELECT v, p FROM edge),
    walk AS (
        SELECT v, n, n AS root, 0 AS depth, n AS path FROM node WHERE NOT EXISTS (SELECT 1 FROM edge WHERE edge.v = node.v AND edge.c = node.n)
        UNION ALL
        SELECT e.v, e.c, w.root, w.depth + 1, w.path || '/' || e.c FROM walk w JOIN edge e ON e.v = w.v AND e.p = w.n),
    found AS (
        SELECT node.v AS keyword_version, node.n AS node_uuid, coalesce(w.root, '') AS root_uuid, CAST(coalesce(w.depth, -1) AS BIGINT) AS depth, w.path
        FROM node LEFT JOIN walk w ON w.v = node.v AND w.n = node.n)
"""
_TRIM = "trim({0}, chr(32) || chr(9) || chr(10))"
_CHANGES = f"""
    WITH row_ AS (
        SELECT {_TRIM.format("scheme")} AS scheme, {_TRIM.format("release")} AS release, {_TRIM.format("id")} AS id, definition, notes, notations, record_status, delivered_at
        FROM resource_snapshots),
    issue AS (SELECT {_TRIM.format("id")} AS release, min(CAST(trim(issued) AS TIMESTAMPTZ)) AS at_ FROM atlas_releases GROUP BY 1),
    there AS (SELECT DISTINCT scheme, release FROM row_),
    nth AS (SELECT scheme, release, row_number() OVER (PARTITION BY scheme ORDER BY at_, release) AS k, count(*) OVER (PARTITION BY scheme) AS last FROM there JOIN issue USING (release)),
    once AS (
        SELECT scheme, release, id, definition, notes, notations, record_status, k, last FROM row_ JOIN nth USING (scheme, release)
        QUALIFY row_number() OVER (PARTITION BY scheme, release, id ORDER BY delivered_at DESC) = 1),
    change AS (
        SELECT n.scheme, n.k + 1 AS k, n.id, 'removed' AS change_kind, NULL AS changed_columns FROM once n
        WHERE n.k < n.last AND NOT EXISTS (SELECT 1 FROM once o WHERE o.scheme = n.scheme AND o.id = n.id AND o.k = n.k + 1)
        UNION ALL
        SELECT n.scheme, n.k, n.id, 'added', NULL FROM once n
        WHERE n.k > 1 AND NOT EXISTS (SELECT 1 FROM once o WHERE o.scheme = n.scheme AND o.id = n.id AND o.k = n.k - 1)
        UNION ALL
        SELECT n.scheme, n.k, n.id, 'changed', concat_ws(',',
            CASE WHEN n.definition IS DISTINCT FROM o.definition THEN 'definition' END, CASE WHEN n.notes IS DISTINCT FROM o.notes THEN 'notes' END,
            CASE WHEN n.notations IS DISTINCT FROM o.notations THEN 'notations' END, CASE WHEN n.record_status IS DISTINCT FROM o.record_status THEN 'record_status' END)
        FROM once n JOIN once o ON o.scheme = n.scheme AND o.id = n.id AND o.k = n.k - 1
        WHERE n.definition IS DISTINCT FROM o.definition OR n.notes IS DISTINCT FROM o.notes OR n.notations IS DISTINCT FROM o.notations OR n.record_status IS DISTINCT FROM o.record_status),
    changes AS (SELECT c.scheme, nth.release, c.id, c.change_kind, c.changed_columns FROM change c JOIN nth ON nth.scheme = c.scheme AND nth.k = c.k)
"""
_ORPHANS = f"""
    WITH res AS (
        SELECT {_TRIM.format("id")} AS k, min(loaded_at) AS first, arg_max(regexp_replace(lower(record_status), '^\\s+|\\s+$', '', 'g') IN ('deleted', 'withdrawn', 'tombstone', 'removed'), loaded_at) AS gone
        FROM atlas_resources GROUP BY 1),
    st AS (SELECT {_TRIM.format("id")} AS k, min(loaded_at) AS first FROM atlas_statements GROUP BY 1),
    ref AS (
        SELECT 'atlas_statements' AS t, 'subject' AS f, {_TRIM.format("id")} AS id, {_TRIM.format("subject")} AS k, loaded_at FROM atlas_statements WHERE trim(statement_type) <> 'SourceAssignment'
        UNION ALL SELECT 'atlas_statements', 'object', {_TRIM.format("id")}, {_TRIM.format("object")}, loaded_at FROM atlas_statements
        UNION ALL SELECT 'atlas_labels', 'resource', {_TRIM.format("id")}, {_TRIM.format("resource")}, loaded_at FROM atlas_labels
        UNION ALL SELECT 'atlas_evidence_bindings', 'statement', {_TRIM.format("id")}, {_TRIM.format("statement")}, loaded_at FROM atlas_evidence_bindings),
    first_ref AS (SELECT t, f, id, k, min(loaded_at) AS at_ FROM ref WHERE k IS NOT NULL GROUP BY ALL),
    judged AS (
        SELECT r.t, r.f, r.id, r.at_,
            CASE WHEN r.t = 'atlas_evidence_bindings' THEN CASE WHEN st.k IS NULL THEN 'missing' WHEN st.first > r.at_ THEN 'late' END
                 WHEN res.k IS NULL THEN 'missing' WHEN res.gone THEN 'deleted' WHEN res.first > r.at_ THEN 'late' END AS kind
        FROM first_ref r LEFT JOIN res ON res.k = r.k LEFT JOIN st ON st.k = r.k)
"""

_SCOPED = f"""
    WITH ref AS (SELECT DISTINCT {_TRIM.format("id")} AS record_id, {_TRIM.format("subject")} AS subject, source_ring FROM atlas_statements WHERE coalesce(trim(statement_type) <> 'SourceAssignment', true)),
    res AS (SELECT DISTINCT {_TRIM.format("id")} AS id, semantic_ring FROM atlas_resources),
    both_ AS (SELECT r.* FROM ref r WHERE r.subject IS NOT NULL AND r.source_ring IS NOT NULL AND NOT EXISTS (SELECT 1 FROM res WHERE res.id = r.subject AND res.semantic_ring = r.source_ring))
"""

SQL = {
    "p3_found": f"{_TREE} SELECT keyword_version, node_uuid, root_uuid, depth FROM found",
    "p3_paths": f"{_TREE} SELECT keyword_version, node_uuid, path, depth FROM found",
    "p3_descendants": f"""{_TREE}, pair AS (SELECT keyword_version, node_uuid, depth, unnest(str_split(path, '/')) AS ancestor, generate_subscripts(str_split(path, '/'), 1) - 1 AS at_ FROM found WHERE depth >= 1)
        SELECT keyword_version, ancestor AS ancestor_uuid, node_uuid AS descendant_uuid, depth - at_ AS distance FROM pair WHERE at_ < depth""",
    "p3_cycles": f"""{_TREE}, caught AS (SELECT keyword_version AS v, node_uuid AS n FROM found WHERE depth = -1),
        up AS (SELECT e.v, e.c AS n, e.p AS a FROM edge e JOIN caught k ON k.v = e.v AND k.n = e.c UNION SELECT u.v, u.n, e.p FROM up u JOIN edge e ON e.v = u.v AND e.c = u.a)
        SELECT v AS keyword_version, n AS node_uuid, CASE WHEN EXISTS (SELECT 1 FROM up WHERE up.v = caught.v AND up.n = caught.n AND up.a = caught.n) THEN 'on cycle' ELSE 'below cycle' END AS place FROM caught""",
    "p3_roots": f"""{_TREE} SELECT h.keyword_version, h.root_count AS declared_roots, CAST(count(*) FILTER (f.depth = 0) AS BIGINT) AS true_roots, CAST(count(f.node_uuid) AS BIGINT) AS nodes
        FROM gcmd_hierarchies h LEFT JOIN found f USING (keyword_version) GROUP BY ALL""",
    "p4_found": f"{_CHANGES} SELECT release, id, change_kind FROM changes",
    "p4_changes": f"{_CHANGES} SELECT scheme, release, id, change_kind, changed_columns FROM changes",
    "p4_summary": f"{_CHANGES} SELECT scheme, release, change_kind, count(*) AS records FROM changes GROUP BY ALL",
    "p4_latest": f"""{_CHANGES}, final AS (SELECT scheme, release FROM nth WHERE k = last AND last > 1)
        SELECT c.scheme, c.release, c.id, c.change_kind, c.changed_columns FROM changes c JOIN final USING (scheme, release)""",
    "p6_simple_match": f"{_SCOPED} SELECT * FROM both_",
    "p6_partial_match": f"""{_SCOPED} SELECT * FROM both_
        UNION ALL SELECT r.* FROM ref r WHERE r.subject IS NOT NULL AND r.source_ring IS NULL AND NOT EXISTS (SELECT 1 FROM res WHERE res.id = r.subject)
        UNION ALL SELECT r.* FROM ref r WHERE r.subject IS NULL AND r.source_ring IS NOT NULL AND NOT EXISTS (SELECT 1 FROM res WHERE res.semantic_ring = r.source_ring)""",
    "p6_full_match": f"{_SCOPED} SELECT * FROM both_ UNION ALL SELECT r.* FROM ref r WHERE (r.subject IS NULL) <> (r.source_ring IS NULL)",
    "p6_found": f"{_ORPHANS} SELECT DISTINCT t AS referring_table, f AS referring_field, id AS record_id, kind AS orphan_kind FROM judged WHERE kind IS NOT NULL",
    "p6_report": f"{_ORPHANS} SELECT t AS referring_table, f AS referring_field, kind AS orphan_kind, strftime(at_, '%Y-%m') AS month, count(*) AS orphans FROM judged WHERE kind IS NOT NULL GROUP BY ALL",
}
