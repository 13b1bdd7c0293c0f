"""The record model: schemas, closed value sets and their guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Closed value sets of the record model.
SEMANTIC_RINGS = ("subject", "entity", "value", "legalIdentity")
LABEL_ROLES = ("preferred", "alternate", "hidden")
STATEMENT_TYPES = ("NativeRelationAssertion", "MappingAssertion", "SourceAssignment", "CrossRingRelationAssertion")
RELEASE_TYPES = ("AtlasRelease", "SourceRelease")
RESOURCE_PROFILES = ("conceptScheme", "codeScheme", "identifierScheme", "structureScheme", "resourceCollection")


def _schema(required: str, optional: str = "", arrays: str = "", binary: str = "", optional_binary: str = "") -> T.StructType:
    fields = [T.StructField(n, T.StringType(), False) for n in required.split()]
    fields += [T.StructField(n, T.BinaryType(), False) for n in binary.split()]
    fields += [T.StructField(n, T.StringType(), True) for n in optional.split()]
    fields += [T.StructField(n, T.ArrayType(T.StringType()), True) for n in arrays.split()]
    fields += [T.StructField(n, T.BinaryType(), True) for n in optional_binary.split()]
    return T.StructType(fields)


#: One schema per record role.
SCHEMAS = {
    "resources": _schema("id release scheme semantic_ring resource_profile source_record", "definition record_status", "notes notations", "", "content_digest"),
    "labels": _schema("id resource label_role value language release source_record", "", "", "", "content_digest"),
    "statements": _schema(
        "id statement_type subject predicate object source_release target_release policy asserted_at", "semantic_ring source_ring target_ring supersedes_assertion", "", "assertion_identity_digest", "content_digest"
    ),
    "evidence_bindings": _schema(
        "id statement source_record attestor attestor_kind assertion_origin epistemic_basis evidence_role evidentiary_function decision attested_at", "based_on_attestation", "", "evidence_source_digest", "content_digest"
    ),
    "source_records": _schema("id source_release source_locator", "represents_resource", "", "source_digest native_payload", "content_digest"),
    "releases": _schema("id release_type identifier issued", "source_locator resource_profile semantic_ring scheme membership_mode", "", "", "source_digest content_digest"),
    "identifiers": _schema("id identifier_value identifier_scheme identifies source_record", "", "", "", "content_digest"),
    "lifecycle_events": _schema("id applies_to lifecycle_event_kind effective_date", "from_release to_release", "source_records", "", "content_digest"),
}

#: Text shapes of identifiers, language tags and digests.
IRI_SHAPE = r"^[A-Za-z][A-Za-z0-9+.\-]*:[^\s<>\"{}|\\^`]+$"
LANGUAGE_SHAPE = r"^[A-Za-z]{2,8}(-[A-Za-z0-9]{1,8})*$"
DIGEST_SHAPE = r"^sha256:[0-9a-f]{64}$"


def conform(df: DataFrame, role: str) -> DataFrame:
    """The columns of a role in order; columns the input lacks become null, others are dropped."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in SCHEMAS[role].fields])


def missing_values(df: DataFrame, role: str) -> DataFrame:
    """(id, column) for every null in a column that must have a value; Spark does not enforce this on read."""
    names = [f.name for f in SCHEMAS[role].fields if not f.nullable and f.name in df.columns]
    gaps = F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]))
    return df.select("id", F.explode(gaps).alias("column"))


def outside(column: Column, values: tuple[str, ...]) -> Column:
    """Whether a value lies outside a closed set; null does."""
    return ~F.coalesce(column.isin(*values), F.lit(False))


def shape_faults(df: DataFrame, shapes: dict[str, str]) -> DataFrame:
    """(id, column) for every present value that misses its column's shape, and for untrimmed text."""
    faults = [F.when(F.col(c).isNotNull() & (~F.col(c).rlike(p) | (F.col(c) != F.trim(c))), F.lit(c)) for c, p in shapes.items()]
    return df.select("id", F.explode(F.array_compact(F.array(*faults))).alias("column"))


def any_of(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)
