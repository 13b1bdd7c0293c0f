"""Consolidating pairwise matches into groups (problem 1).

Union-find runs inside edge cells of bounded size and keeps only a spanning forest of
each; forests are merged level by level until global components remain (see
``operators.forests``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.operators.forests import forest_groups as group_pairs


def is_exact_match(relation: Column) -> Column:
    """Whether a relation names exact match: any prefix or namespace, case, word separation or padding."""
    bare = F.regexp_replace(relation, r"(?s)^.*[:#/]", "")
    return F.lower(F.regexp_replace(bare, r"[\s_\-]+", "")) == "exactmatch"


def exact_match_pairs(assertions: DataFrame) -> DataFrame:
    """Current exact-match assertions as (source_concept, target_concept) without blanks."""
    kept = assertions.filter((F.col("lifecycle_status") == "current") & is_exact_match(F.col("relation")))
    return kept.select(strip_key("source_concept").alias("source_concept"), strip_key("target_concept").alias("target_concept"))


def concept_groups(assertions: DataFrame, **bounds) -> DataFrame:
    """(concept, group_id) of concepts in groups of two or more.

    group_id is the smallest concept of the group compared as text. Concepts tied
    only to themselves, withdrawn assertions and null relations form no group.
    """
    pairs = exact_match_pairs(assertions).filter("source_concept <> target_concept")
    return group_pairs(pairs, "source_concept", "target_concept", **bounds).select(F.col("node").alias("concept"), F.col("root").alias("group_id"))


def all_concept_groups(assertions: DataFrame, **bounds) -> DataFrame:
    """(concept, group_id) of every concept named on either side, alone or not.

    Concepts that no current exact match ties to another are their own group. Null
    concepts are no concepts; an empty concept text is one.
    """
    both = F.array(strip_key("source_concept"), strip_key("target_concept"))
    named = assertions.select(F.explode(both).alias("concept")).filter("concept IS NOT NULL").distinct()
    return named.join(concept_groups(assertions, **bounds), "concept", "left").withColumn("group_id", F.coalesce("group_id", "concept"))
