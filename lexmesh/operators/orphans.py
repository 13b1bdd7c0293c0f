"""References to records that do not exist (problem 6).

Composite references are grouped by which of their columns are null. Each group is
anti-joined on the columns that are present, under the declared match semantics.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.operators.skewjoin import HOT_ROWS, anti_join, join_unique
from lexmesh.storage import materialize

#: Record statuses of resources that are gone.
GONE = ("deleted", "withdrawn", "tombstone", "removed")


def null_masks(n: int) -> list[tuple[bool, ...]]:
    """All patterns of present columns among n."""
    return [tuple(bool(m >> i & 1) for i in range(n)) for m in range(2**n)]


def unmatched(references: DataFrame, targets: DataFrame, columns: list[tuple[str, str]], match: str = "simple", hot_rows: int = HOT_ROWS) -> DataFrame:
    """References whose key, in ``columns`` (reference column, target column), no target has.

    match: as in SQL foreign keys. ``simple``: a reference with any null holds.
    ``partial``: the columns present must occur together in some target; all null
    holds. ``full``: all null holds, some null never does. Targets with nulls in the
    compared columns match nothing there. Each null mask is anti-joined on its own
    columns only, rows directly, hot keys apart. ``references`` should be cheap to read
    again (materialized).
    """
    if match not in ("simple", "partial", "full"):
        raise ValueError(f"unknown match semantics: {match}")
    out = []
    for mask in null_masks(len(columns)):
        here = [c for c, on in zip(columns, mask, strict=True) if on]
        group = references.filter(reduce(lambda a, b: a & b, [F.col(c[0]).isNotNull() if on else F.col(c[0]).isNull() for c, on in zip(columns, mask, strict=True)]))
        if not here or (match == "simple" and len(here) < len(columns)):
            continue
        if match == "full" and len(here) < len(columns):
            out.append(group)
            continue
        names = [f"_key_{i}" for i in range(len(here))]
        known = targets.select(*[F.col(t).alias(a) for a, (_, t) in zip(names, here, strict=True)]).dropna().distinct()
        keyed = group.withColumns({a: F.col(r) for a, (r, _) in zip(names, here, strict=True)})
        out.append(anti_join(keyed, known, names, hot_rows).select(*references.columns))
    return reduce(DataFrame.unionByName, out) if out else references.filter(F.lit(False))


def reference_rows(statements: DataFrame, evidence: DataFrame, labels: DataFrame) -> DataFrame:
    """(referring_table, referring_field, record_id, target, key, _at) of all checked references."""
    at = F.col("loaded_at")

    def refs(table: str, df: DataFrame, field: str, target: str) -> DataFrame:
        return df.select(F.lit(table).alias("referring_table"), F.lit(field).alias("referring_field"), strip_key("id").alias("record_id"), F.lit(target).alias("target"), strip_key(field).alias("key"), at.alias("_at"))

    parts = [
        refs("atlas_statements", statements.filter(F.coalesce(F.trim("statement_type") != "SourceAssignment", F.lit(True))), "subject", "r"),
        refs("atlas_statements", statements, "object", "r"),
        refs("atlas_evidence_bindings", evidence, "statement", "s"),
        refs("atlas_labels", labels, "resource", "r"),
    ]
    return reduce(DataFrame.unionByName, parts)


def orphan_references(resources: DataFrame, statements: DataFrame, evidence: DataFrame, labels: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(referring_table, referring_field, record_id, key, loaded_at, orphan_kind): references that don't hold.

    missing: no such record, the empty key included; deleted: a resource whose
    latest-loaded row has a gone status; late: first loaded after the referring
    record was. A record counts as loaded at its earliest loaded_at; where rows of one
    referring id name different keys, each key counts from its own earliest row. A
    null key refers to nothing and holds (simple match). A null loaded_at is never late.
    """
    # the referring record's earliest load: rows of one record and key meet after local reduction
    refs = materialize(reference_rows(statements, evidence, labels).groupBy("referring_table", "referring_field", "record_id", "target", "key").agg(F.min("_at").alias("_at")))
    status = F.lower(F.regexp_replace("record_status", r"^\s+|\s+$", ""))
    gone = F.coalesce(status.isin(*GONE), F.lit(False))
    known = resources.select(F.lit("r").alias("target"), strip_key("id").alias("key"), F.col("loaded_at").alias("_t"), gone.alias("_gone")).unionByName(
        statements.select(F.lit("s").alias("target"), strip_key("id").alias("key"), F.col("loaded_at").alias("_t"), F.lit(False).alias("_gone"))
    )
    late_rank = F.coalesce(F.unix_micros(F.col("_t").cast("timestamp")), F.lit(-(2**61))) * 2 + F.col("_gone").cast("long")
    known = materialize(known.filter("key IS NOT NULL").groupBy("target", "key").agg(F.min("_t").alias("_first"), F.max_by("_gone", late_rank).alias("_gone")))
    out = ("referring_table", "referring_field", "record_id", "key", F.col("_at").alias("loaded_at"))
    # these references have one column, so their null masks are two; composite ones are scoped_references
    missing = reduce(DataFrame.unionByName, [unmatched(refs.filter(F.col("target") == t), known.filter(F.col("target") == t), [("key", "key")], "simple", hot_rows) for t in ("r", "s")]).select(*out, F.lit("missing").alias("orphan_kind"))
    text = F.concat("target", "key")
    held = refs.filter("key IS NOT NULL").withColumn("_k", text)
    both = join_unique(held, known.select(text.alias("_k"), "_first", "_gone", F.lit(True).alias("_here")), "_k", hot_rows).filter("_here")
    kind = F.when(F.col("_gone"), "deleted").when(F.col("_first") > F.col("_at"), "late")
    return missing.unionByName(both.select(*out, kind.alias("orphan_kind")).filter("orphan_kind IS NOT NULL"))


def scoped_references(resources: DataFrame, statements: DataFrame, match: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """(record_id, subject, source_ring): statements whose subject and ring together name no resource of that ring.

    Both parts of the key may be null; ``match`` says what that means (see
    ``unmatched``). Subjects of SourceAssignment statements are no references.
    """
    refs = statements.filter(F.coalesce(F.trim("statement_type") != "SourceAssignment", F.lit(True)))
    refs = materialize(refs.select(strip_key("id").alias("record_id"), strip_key("subject").alias("subject"), "source_ring").distinct())
    return unmatched(refs, resources.select(strip_key("id").alias("id"), "semantic_ring"), [("subject", "id"), ("source_ring", "semantic_ring")], match, hot_rows)
