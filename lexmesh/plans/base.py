"""Views shared by the queries: the record tables, and those that follow from them."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.storage import table

RELEASE = "urn:vx:release:tidewatch:r1"
SCHEME_A, SCHEME_B = "urn:vx:scheme:brineworks", "urn:vx:scheme:lodestar"


@dataclass
class Atlas:
    """The record tables of one data directory, read lazily."""

    spark: SparkSession
    path: str

    def __getattr__(self, name: str) -> DataFrame:
        return table(self.spark, self.path, f"atlas_{name}")

    def table(self, name: str) -> DataFrame:
        return table(self.spark, self.path, name)

    @property
    def identifiers(self) -> DataFrame:
        """One identifier per notation of a resource."""
        return self.resources.select(F.col("id").alias("identifies"), F.explode("notations").alias("identifier_value"), F.col("scheme").alias("identifier_scheme"), "source_record")

    @property
    def source_records(self) -> DataFrame:
        """One record per source record of a resource, released under the resource's scheme's release."""
        return self.resources.groupBy(F.col("source_record").alias("id")).agg(F.min("release").alias("source_release"), F.concat(F.lit("records#"), F.min("source_record")).alias("source_locator"), F.min("id").alias("represents_resource"))

    @property
    def rescissions(self) -> DataFrame:
        """Statements with rejected evidence count as rescinded."""
        return self.evidence_bindings.filter(F.trim("decision") == "vx:rejected").select(F.col("statement").alias("applies_to")).distinct()

    @property
    def once(self) -> DataFrame:
        """Resources by distinct id."""
        return self.resources.groupBy("id").agg(F.min("release").alias("release"), F.min("scheme").alias("scheme"), F.min("semantic_ring").alias("semantic_ring"), F.min("record_status").alias("record_status"), F.min("source_record").alias("source_record"), F.min("definition").alias("definition"))


IDENTIFIERS = "identifiers AS (SELECT id AS identifies, unnest(notations) AS identifier_value, scheme AS identifier_scheme, source_record FROM atlas_resources)"
SOURCE_RECORDS = "source_records AS (SELECT source_record AS id, min(release) AS source_release, 'records#' || min(source_record) AS source_locator, min(id) AS represents_resource FROM atlas_resources GROUP BY 1)"
RESCISSIONS = "rescissions AS (SELECT DISTINCT statement AS applies_to FROM atlas_evidence_bindings WHERE trim(decision) = 'vx:rejected')"
ONCE = "once AS (SELECT id, min(release) AS release, min(scheme) AS scheme, min(semantic_ring) AS semantic_ring, min(record_status) AS record_status, min(source_record) AS source_record, min(definition) AS definition FROM atlas_resources GROUP BY id)"
ROLE = "CASE label_role WHEN 'preferred' THEN 0 WHEN 'alternate' THEN 1 WHEN 'hidden' THEN 2 ELSE 99 END"
LOCAL = "regexp_extract({0}, '([^#/:]+)[/#:]?$', 1)"


def digest_sql(line: str) -> str:
    """An order-free digest of lines: sums of the eight words of their SHA-256."""
    return " || '-' || ".join(f"CAST(sum(CAST('0x' || substr(sha256({line}), {1 + 8 * i}, 8) AS BIGINT)) AS VARCHAR)" for i in range(8))


def shown(column: str) -> str:
    return f"({column} IS NULL OR lower({column}) NOT LIKE '%deprecated%')"


class Book:
    """A module's queries with their SQL."""

    def __init__(self) -> None:
        self.queries: dict = {}
        self.sql: dict[str, str] = {}

    def add(self, name: str, sql: str | None = None):
        def keep(build):
            def run(spark: SparkSession, path: str) -> DataFrame:
                return build(Atlas(spark, path))

            run.__name__, run.__doc__ = name, build.__doc__
            self.queries[name] = run
            if sql:
                self.sql[name] = sql
            return build

        return keep
