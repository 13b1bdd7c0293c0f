"""The query API: facets, overview, release graphs, neighbourhoods, look-ups, coverage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmesh.functions.labels import active, display_labels, local_name, ranked_labels
from lexmesh.operators.ranks import with_rank

#: Fixed value: release identifiers that name an endpoint release.
ENDPOINT_NAME = r"(?i)endpoint"


def check_page(limit: object = 100, offset: object = 0, status: str = "active", relations: str = "asserted") -> None:
    """Refuse arguments outside the API: limit 1..500, offset from 0 (no booleans), known modes."""
    if isinstance(limit, bool) or not isinstance(limit, int) or not 1 <= limit <= 500:
        raise ValueError("limit must be an integer from 1 to 500")
    if isinstance(offset, bool) or not isinstance(offset, int) or offset < 0:
        raise ValueError("offset must be an integer from 0")
    if status not in ("active", "all"):
        raise ValueError("status must be active or all")
    if relations not in ("asserted", "all"):
        raise ValueError("relations must be asserted or all")


def release_counts(releases: DataFrame, resources: DataFrame) -> DataFrame:
    """Members of each atlas release, none included."""
    n = resources.groupBy(F.col("release").alias("id")).agg(F.count("id").alias("count"))
    kept = releases.filter(F.col("release_type") == "AtlasRelease").select("id", "identifier", F.col("semantic_ring").alias("ring"))
    return kept.join(n, "id", "left").withColumn("count", F.coalesce("count", F.lit(0)))


def ring_counts(resources: DataFrame) -> DataFrame:
    return resources.groupBy(F.col("semantic_ring").alias("id")).agg(F.count(F.lit(1)).alias("count"))


def relation_endpoints(statements: DataFrame) -> DataFrame:
    """Both ends of every relation; a self-loop gives its end twice."""
    kept = statements.filter(F.col("statement_type") != "SourceAssignment")
    return kept.select(F.explode(F.array("subject", "object")).alias("id"))


def degrees(statements: DataFrame) -> DataFrame:
    return relation_endpoints(statements).groupBy("id").agg(F.count(F.lit(1)).alias("degree"))


def start_node(statements: DataFrame, low: int = 18, high: int = 48, prefix: str = "urn:vx:resource:") -> DataFrame:
    """One well-connected resource to start from: middling degree first, favoured prefix first, then degree and id."""
    middling = F.col("degree").between(low, high)
    favoured = middling & F.col("id").startswith(prefix)
    return degrees(statements).orderBy(F.when(middling, 0).otherwise(1), F.when(favoured, 0).otherwise(1), F.desc("degree"), F.desc("id")).limit(1)


def _ends(resources: DataFrame, name: str, status: str) -> DataFrame:
    return resources.filter(active("record_status", status)).select(F.col("id").alias(name), F.col("release").alias(f"{name}_release"))


def release_pairs(statements: DataFrame, resources: DataFrame, status: str = "active") -> DataFrame:
    """Relations between undirected release pairs by type, both ends shown."""
    both = statements.join(_ends(resources, "subject", status).drop("subject_release"), "subject").join(_ends(resources, "object", status).drop("object_release"), "object")
    return both.groupBy(F.least("source_release", "target_release").alias("source"), F.greatest("source_release", "target_release").alias("target"), "statement_type").agg(F.count(F.lit(1)).alias("count"))


def internal_relations(pairs: DataFrame) -> DataFrame:
    return pairs.filter("source = target").groupBy(F.col("source").alias("id")).agg(F.sum("count").alias("internal_relations"))


def overview_nodes(releases: DataFrame, resources: DataFrame, status: str = "active") -> DataFrame:
    """Shown members, all members and endpoint members of each atlas release."""
    endpoint = F.coalesce(F.lower("record_status").contains("alignmentendpoint"), F.lit(False))
    # one pass over resources: shown, total and endpoint members together
    n = resources.groupBy(F.col("release").alias("id")).agg(F.count_if(active("record_status", status) & F.col("id").isNotNull()).alias("resources"), F.count(F.lit(1)).alias("total_members"), F.count_if(endpoint).alias("endpoint_members"))
    kept = releases.filter(F.col("release_type") == "AtlasRelease").select("id", "identifier", F.col("semantic_ring").alias("ring"))
    return kept.join(n, "id", "left").fillna(0, ["resources", "total_members", "endpoint_members"])


def satellites(nodes: DataFrame, pairs: DataFrame) -> DataFrame:
    """Nodes with satellite and partner: the release with the most mapping volume, else of any type, ties to the greater id."""
    off = pairs.filter("source <> target")
    sides = off.select(F.col("source").alias("id"), F.col("target").alias("other"), "statement_type", "count").unionByName(off.select(F.col("target").alias("id"), F.col("source").alias("other"), "statement_type", "count"))
    mapped = F.sum(F.when(F.col("statement_type") == "MappingAssertion", F.col("count")))
    volume = sides.groupBy("id", "other").agg(mapped.alias("mapped"), F.sum("count").alias("any"))
    best = volume.groupBy("id").agg(F.max(F.when(F.col("mapped").isNotNull(), F.struct("mapped", "other"))).alias("m"), F.max(F.struct("any", "other")).alias("a"))
    flagged = nodes.withColumn("satellite", ((F.col("total_members") > 0) & (F.col("endpoint_members") / F.greatest("total_members", F.lit(1)) >= 0.5)) | F.coalesce(F.col("identifier").rlike(ENDPOINT_NAME), F.lit(False)))
    return flagged.join(best, "id", "left").select("id", "identifier", "ring", "resources", "satellite", F.when(F.col("satellite"), F.coalesce("m.other", "a.other")).alias("partner"))


def graph_nodes(resources: DataFrame, labels: DataFrame, release: str, status: str = "active") -> DataFrame:
    """(position, id, label) of a release's shown resources in display order, from 0."""
    kept = resources.filter((F.col("release") == release) & active("record_status", status)).select("id")
    first = ranked_labels(labels.join(kept.withColumnRenamed("id", "resource"), "resource", "left_semi")).filter("label_rank = 1")
    label = F.coalesce(first["value"], F.nullif(local_name(kept["id"]), F.lit("")), kept["id"])
    named = kept.join(first, kept["id"] == first["resource"], "left").select("id", label.alias("label"))
    ranked = with_rank(named.withColumn("_low", F.lower("label")), ["_low", "label", "id"], "position")
    return ranked.select(F.col("position").cast("int").alias("position"), "id", "label")


def graph_edges(statements: DataFrame, nodes: DataFrame, release: str) -> DataFrame:
    """(id, subject, object, predicate, statement_type) as positions; predicates and types numbered as first seen by id; null ends where dropped."""
    inside = statements.filter((F.col("source_release") == release) & (F.col("target_release") == release))
    last = nodes.groupBy("id").agg(F.max("position").alias("position"))
    s = last.select(F.col("id").alias("subject"), F.col("position").alias("s"))
    o = last.select(F.col("id").alias("object"), F.col("position").alias("o"))
    return inside.join(s, "subject", "left").join(o, "object", "left").select("id", "s", "o", "predicate", "statement_type")


def first_seen_index(df: DataFrame, value: str, order: str) -> DataFrame:
    """(value, index): distinct values numbered from 0 by where they first occur."""
    first = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(order).alias("_first"))
    return first.select(value, (F.row_number().over(Window.orderBy("_first", value)) - 1).alias("index"))


def neighbourhood(statements: DataFrame, resources: DataFrame, resource: str, status: str = "active") -> DataFrame:
    """Relations that touch a resource, except those to hidden other ends; unknown ends are shown."""
    near = statements.filter((F.col("subject") == resource) | (F.col("object") == resource))
    state = resources.select("id", "record_status")
    s = state.select(F.col("id").alias("_s"), F.col("record_status").alias("_ss"))
    o = state.select(F.col("id").alias("_o"), F.col("record_status").alias("_os"))
    both = near.join(s, near["subject"] == s["_s"], "left").join(o, near["object"] == o["_o"], "left")
    shown = ((F.col("subject") == resource) | active("_ss", status)) & ((F.col("object") == resource) | active("_os", status))
    return both.filter(shown).drop("_s", "_ss", "_o", "_os")


def endpoint_labels(relations: DataFrame, resources: DataFrame, labels: DataFrame) -> DataFrame:
    """(id, release, ring, profile, label) of all ends of given relations."""
    ids = relations.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    ends = resources.join(ids, "id", "left_semi").select("id", "release", "semantic_ring", "resource_profile")
    first = display_labels(labels.join(ids.withColumnRenamed("id", "resource"), "resource", "left_semi"))
    return ends.join(first, ends["id"] == first["resource"], "left").select("id", "release", "semantic_ring", "resource_profile", F.coalesce("label", local_name("id"), F.col("id")).alias("label"))


def evidence_of(evidence: DataFrame, source_records: DataFrame, relations: DataFrame) -> DataFrame:
    """Evidence of given relations with its source record's release and locator, where known."""
    kept = evidence.join(relations.select(F.col("id").alias("statement")).distinct(), "statement", "left_semi")
    known = source_records.select(F.col("id").alias("source_record"), "source_release", "source_locator")
    return kept.join(known, "source_record", "left")


def nested_evidence(relations: DataFrame, evidence: DataFrame) -> DataFrame:
    """Relations with their evidence as an ordered array of structs and its size."""
    item = F.struct("id", "attested_at", "decision", "attestor", "evidence_role", "source_record")
    packed = evidence.groupBy(F.col("statement").alias("id")).agg(F.array_sort(F.collect_list(item)).alias("evidence"))
    return relations.join(packed, "id", "left").withColumn("evidence_count", F.coalesce(F.size("evidence"), F.lit(0)))


def lookup(table: DataFrame, query: str, scalars: list[str], arrays: list[str]) -> DataFrame:
    """Rows in which a text occurs, in any case, in a scalar column or the joined items of an array column."""
    wanted = query.strip().lower()
    if not wanted:
        return table
    hit = F.lit(False)
    for c in scalars:
        hit = hit | F.coalesce(F.lower(c).contains(wanted), F.lit(False))
    for c in arrays:
        hit = hit | F.coalesce(F.lower(F.array_join(c, " ")).contains(wanted), F.lit(False))
    return table.filter(hit)


def with_known(df: DataFrame, column: str, resources: DataFrame, flag: str = "known") -> DataFrame:
    """df with a flag telling whether a column names a resource."""
    ids = resources.select(F.col("id").alias(column)).distinct().withColumn("_k", F.lit(True))
    return df.join(ids, column, "left").withColumn(flag, F.col("_k").isNotNull()).drop("_k")


def coverage(statements: DataFrame) -> DataFrame:
    """(section, key, count): statements by kind, by ring (a cross-ring statement counts for both), by ring pair, by release."""
    rings = F.when(F.col("semantic_ring").isNotNull(), F.array("semantic_ring")).otherwise(F.array_compact(F.array("source_ring", "target_ring")))
    pair = F.when(F.col("semantic_ring").isNull() & F.col("source_ring").isNotNull(), F.concat_ws(" -> ", "source_ring", "target_ring"))
    keys = F.concat(
        F.array(F.struct(F.lit("kind").alias("section"), F.col("statement_type").alias("key"))),
        F.transform(rings, lambda r: F.struct(F.lit("ring").alias("section"), r.alias("key"))),
        F.array_compact(F.array(F.when(pair.isNotNull(), F.struct(F.lit("ring pair").alias("section"), pair.alias("key"))))),
        F.array(F.struct(F.lit("release").alias("section"), F.col("source_release").alias("key"))),
    )
    return statements.select(F.explode(keys).alias("k")).groupBy("k.section", "k.key").agg(F.count(F.lit(1)).alias("count"))


def current_statements(statements: DataFrame, rescinded: DataFrame | None = None) -> DataFrame:
    """Statements that no other one supersedes and no event rescinds."""
    gone = statements.select(F.col("supersedes_assertion").alias("id")).dropna().distinct()
    out = statements.join(gone, "id", "left_anti")
    return out if rescinded is None else out.join(rescinded.select(F.col("applies_to").alias("id")).distinct(), "id", "left_anti")


def statement_states(statements: DataFrame, rescinded: DataFrame) -> DataFrame:
    """(id, state): superseded before rescinded before current."""
    over = statements.select(F.col("supersedes_assertion").alias("id")).dropna().distinct().withColumn("_over", F.lit(True))
    back = rescinded.select(F.col("applies_to").alias("id")).distinct().withColumn("_back", F.lit(True))
    state = F.when(F.col("_over"), "superseded").when(F.col("_back"), "rescinded").otherwise("current")
    return statements.select("id").distinct().join(over, "id", "left").join(back, "id", "left").select("id", state.alias("state"))


def bounded_model(statements: DataFrame, resources: DataFrame, rescinded: DataFrame, first: int, cap: int) -> DataFrame:
    """(kind, id, state): the first statements by id with their state, their ends, and further resources by id up to a cap."""
    few = statements.select("id", "subject", "object", "supersedes_assertion").orderBy("id").limit(first)
    ends = few.select(F.explode(F.array("subject", "object")).alias("id")).distinct()
    own = resources.select("id").distinct()
    needed = own.join(ends, "id", "left_semi").withColumn("_pick", F.lit(0))
    fill = own.join(ends, "id", "left_anti").orderBy("id").limit(cap).withColumn("_pick", F.lit(1))
    picked = needed.unionByName(fill).orderBy("_pick", "id").limit(cap)
    gone = statements.join(few.select(F.col("id").alias("supersedes_assertion")), "supersedes_assertion", "left_semi").select("id", "supersedes_assertion")
    states = statement_states(few.select("id").join(gone.withColumnRenamed("id", "_by").withColumnRenamed("supersedes_assertion", "id"), "id", "left").select("id", F.when(F.col("_by").isNotNull(), F.col("id")).alias("supersedes_assertion")), rescinded)
    return states.select(F.lit("statement").alias("kind"), "id", "state").unionByName(picked.select(F.lit("resource").alias("kind"), "id", F.lit(None).cast("string").alias("state")))
