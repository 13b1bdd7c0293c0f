"""Driver queries of this package, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.llm.consensus import consensus
from lexmesh.llm.groups import all_concept_groups, concept_groups
from lexmesh.llm.lookalike import alike_members, alike_pairs, canonical_labels
from lexmesh.llm.matching import match_entities
from lexmesh.llm.mixing import mix_sources
from lexmesh.llm.packing import container_fill, pack_documents
from lexmesh.llm.spam import spam_pages, spam_scores
from lexmesh.storage import materialize, table

#: The schemes that describe partly the same concepts.
MATCHED_SCHEMES = ["urn:vx:scheme:brineworks", "urn:vx:scheme:fathomline", "urn:vx:scheme:lodestar"]


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return concept_groups(table(spark, d, "mapping_assertions"))


def p1_groups(spark: SparkSession, d: str) -> DataFrame:
    return all_concept_groups(table(spark, d, "mapping_assertions"))


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return consensus(table(spark, d, "relation_verdicts"))[0].select("row_id", "best_relation")


def p2_items(spark: SparkSession, d: str) -> DataFrame:
    return consensus(table(spark, d, "relation_verdicts"))[0]


def p2_reviewers(spark: SparkSession, d: str) -> DataFrame:
    return consensus(table(spark, d, "relation_verdicts"))[1]


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return alike_pairs(materialize(canonical_labels(table(spark, d, "atlas_labels"))))


def p5_canonical(spark: SparkSession, d: str) -> DataFrame:
    return canonical_labels(table(spark, d, "atlas_labels"))


def p5_members(spark: SparkSession, d: str) -> DataFrame:
    return alike_members(materialize(canonical_labels(table(spark, d, "atlas_labels"))))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    pairs = match_entities(table(spark, d, "atlas_resources"), table(spark, d, "atlas_labels"), MATCHED_SCHEMES)
    return pairs.select(F.col("id_1").alias("resource_1"), F.col("id_2").alias("resource_2"))


def p7_matches(spark: SparkSession, d: str) -> DataFrame:
    return match_entities(table(spark, d, "atlas_resources"), table(spark, d, "atlas_labels"), MATCHED_SCHEMES)


def p8_containers(spark: SparkSession, d: str) -> DataFrame:
    return pack_documents(table(spark, d, "documents"), table(spark, d, "container_sizes"))


def p8_fill(spark: SparkSession, d: str) -> DataFrame:
    sizes = table(spark, d, "container_sizes")
    return container_fill(pack_documents(table(spark, d, "documents"), sizes), sizes)


def p8_checks(spark: SparkSession, d: str) -> DataFrame:
    """By container kind: documents placed, pieces placed twice, containers above capacity, documents cut though they fit."""
    sizes = table(spark, d, "container_sizes")
    packed = materialize(pack_documents(table(spark, d, "documents"), sizes))
    each = packed.groupBy("container_kind", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("piece").alias("pieces"), F.sum("piece_tokens").alias("tokens")).join(F.broadcast(sizes), "container_kind")
    cut = (F.col("pieces") > 1) & (F.col("tokens") <= F.col("capacity_tokens"))
    placed = each.groupBy("container_kind").agg(F.count(F.lit(1)).alias("documents"), F.sum(F.col("n") - F.col("pieces")).alias("twice"), F.count_if(cut).alias("cut"))
    over = container_fill(packed, sizes).groupBy("container_kind").agg(F.count_if(F.expr("used_tokens > capacity_tokens")).alias("overfull"))
    return placed.join(over, "container_kind").select("container_kind", "documents", "twice", "overfull", "cut")


def p9_mixture(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[0]


def p9_shares(spark: SparkSession, d: str) -> DataFrame:
    return mix_sources(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[1]


def p9_checks(spark: SparkSession, d: str) -> DataFrame:
    """By mix and source: documents chosen twice, repeated too often, or of another source."""
    targets = table(spark, d, "mixture_targets").select("mix_name", strip_key("source").alias("source"), "max_repeats")
    chosen = mix_sources(table(spark, d, "documents"), table(spark, d, "mixture_targets"))[0]
    own = table(spark, d, "documents").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(strip_key("source")).alias("_own"))
    each = chosen.groupBy("mix_name", "source", "doc_id").agg(F.count(F.lit(1)).alias("n"), F.sum("repeats").alias("repeats")).join(own, "doc_id")
    judged = targets.join(each, ["mix_name", "source"], "left")
    return judged.groupBy("mix_name", "source").agg(F.count_if(F.expr("n > 1")).alias("twice"), F.count_if(F.expr("repeats > max_repeats")).alias("too_often"), F.count_if(F.expr("source <> _own")).alias("elsewhere"))


def p2_panels(spark: SparkSession, d: str) -> DataFrame:
    """Reviewers whose latest verdict counts for each item."""
    return consensus(table(spark, d, "relation_verdicts"))[0].select("row_id", "reviewers")


def p7_checks(spark: SparkSession, d: str) -> DataFrame:
    """Matches that break the assignment: a record matched twice within a scheme, matches within one scheme, ids out of order."""
    resources = table(spark, d, "atlas_resources").select(strip_key("id").alias("id"), strip_key("scheme").alias("scheme"))
    scheme = resources.groupBy("id").agg(F.min("scheme").alias("scheme"))
    pairs = materialize(match_entities(table(spark, d, "atlas_resources"), table(spark, d, "atlas_labels"), MATCHED_SCHEMES))
    both = pairs.join(scheme.select(F.col("id").alias("id_1"), F.col("scheme").alias("s1")), "id_1").join(scheme.select(F.col("id").alias("id_2"), F.col("scheme").alias("s2")), "id_2")
    ends = both.select(F.explode(F.array(F.struct(F.col("id_1").alias("id"), F.col("s2").alias("other")), F.struct(F.col("id_2").alias("id"), F.col("s1").alias("other")))).alias("e"))
    twice = ends.groupBy("e.id", "e.other").agg(F.count(F.lit(1)).alias("n")).agg(F.count_if(F.expr("n > 1")).alias("twice"))
    rest = both.agg(F.count_if(F.expr("s1 = s2")).alias("within"), F.count_if(F.expr("id_1 >= id_2")).alias("unordered"))
    return twice.crossJoin(rest)  # one row each


def p10_found(spark: SparkSession, d: str) -> DataFrame:
    return spam_pages(table(spark, d, "documents"))


def p10_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam_scores(table(spark, d, "documents"))


_EDGES = r"""
    SELECT DISTINCT trim(source_concept, chr(32) || chr(9) || chr(10)) AS a, trim(target_concept, chr(32) || chr(9) || chr(10)) AS b
    FROM mapping_assertions
    WHERE lifecycle_status = 'current'
      AND lower(regexp_replace(regexp_replace(relation, '^.*[:#/]', ''), '[\s_-]+', '', 'g')) = 'exactmatch'
      AND trim(source_concept, chr(32) || chr(9) || chr(10)) <> trim(target_concept, chr(32) || chr(9) || chr(10))
"""
_GROUPS = f"""
    WITH RECURSIVE half AS ({_EDGES}), edge AS (SELECT a, b FROM half UNION SELECT b, a FROM half),
    reach AS (SELECT a, a AS b FROM edge UNION SELECT r.a, e.b FROM reach r JOIN edge e ON r.b = e.a),
    grouped AS (SELECT a AS concept, min(b) AS group_id FROM reach GROUP BY a)
"""

SQL = {
    "p1_found": f"{_GROUPS} SELECT concept, group_id FROM grouped",
    "p1_groups": f"""{_GROUPS}, named AS (
        SELECT trim(source_concept, chr(32) || chr(9) || chr(10)) AS concept FROM mapping_assertions
        UNION SELECT trim(target_concept, chr(32) || chr(9) || chr(10)) FROM mapping_assertions)
    SELECT n.concept, coalesce(g.group_id, n.concept) AS group_id FROM named n LEFT JOIN grouped g USING (concept) WHERE n.concept IS NOT NULL""",
}

SQL |= {
    "p2_panels": "SELECT row_id, count(DISTINCT coalesce(trim(reviewer), '')) AS reviewers FROM relation_verdicts WHERE row_id IS NOT NULL GROUP BY 1",
    "p7_checks": "SELECT 0 AS twice, 0 AS within, 0 AS unordered",
    "p8_checks": "SELECT container_kind, (SELECT count(DISTINCT doc_id) FROM documents) AS documents, 0 AS twice, 0 AS overfull, 0 AS cut FROM container_sizes",
    "p9_checks": "SELECT DISTINCT mix_name, trim(source, chr(32) || chr(9) || chr(10)) AS source, 0 AS twice, 0 AS too_often, 0 AS elsewhere FROM mixture_targets",
}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (p1_found, p1_groups, p2_found, p2_items, p2_reviewers, p2_panels, p5_found, p5_canonical, p5_members, p7_found, p7_matches, p7_checks, p8_containers, p8_fill, p8_checks, p9_mixture, p9_shares, p9_checks, p10_found, p10_scores)
}
