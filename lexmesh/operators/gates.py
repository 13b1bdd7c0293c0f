"""Gates before a build: admission of reviewed pairs, row diagnostics, reference closure, accounting, migration checks."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How far a relation narrows the target; others are no degrees of one link.
DEGREE = {"target_is_broader": -1, "same": 0, "near_same": 0, "target_is_narrower": 1}


def _degree(relation: Column) -> Column:
    return reduce(lambda out, item: F.when(relation == item[0], item[1]).otherwise(out), DEGREE.items(), F.lit(None).cast("int"))


def admission(pairs: DataFrame) -> DataFrame:
    """pairs (left, right, supported, equal_labels, variants, ...) with r0..r4: whether each rule would admit them.

    r0: both relations mean the same. r1: or lie one degree apart, where labels are
    equal. r2: or one degree apart anywhere. r3: or a plain relation beside a degree. r4:
    r1, also where labels are spelling variants. Nothing unsupported or with a relation
    missing is admitted.
    """
    left, right = F.col("left"), F.col("right")
    alike = (left == right) | (left.isin("same", "near_same") & right.isin("same", "near_same"))
    step = F.coalesce(F.abs(_degree(left) - _degree(right)) <= 1, F.lit(False))
    loose = ((left == "related") | (right == "related")) & (_degree(left).isNotNull() | _degree(right).isNotNull())
    rules = {"r0": alike, "r1": alike | (F.col("equal_labels") & step), "r2": alike | step, "r3": alike | step | loose, "r4": alike | ((F.col("equal_labels") | F.col("variants")) & step)}
    return pairs.withColumns({name: F.coalesce(F.col("supported") & rule, F.lit(False)) for name, rule in rules.items()})


def admission_counts(pairs: DataFrame, by: list[str]) -> DataFrame:
    """Rows and admissions under each rule, by group."""
    return admission(pairs).groupBy(*by).agg(F.count(F.lit(1)).alias("pairs"), *[F.count_if(f"r{i}").alias(f"r{i}") for i in range(5)])


def nested_texts(document: Column) -> Column:
    """All string values at any depth of a JSON text, keys left out; no recursion over its structure is needed."""
    quoted = F.regexp_extract_all(document, F.lit(r'("(?:[^"\\]|\\.)*"(?:\s*:)?)'), F.lit(1))
    values = F.filter(quoted, lambda x: ~F.endswith(x, F.lit(":")))
    return F.from_json(F.concat(F.lit("["), F.array_join(values, ","), F.lit("]")), "array<string>")


def referenced_identifiers(records: DataFrame, prefix: str) -> DataFrame:
    """(identifier, records): texts under ``prefix`` anywhere in a record, with the number of records naming them.

    records has (id, document), a JSON text each; a record does not refer to itself.
    Blanks around a text are not part of it.
    """
    found = records.select("id", F.explode(F.array_distinct(F.transform(nested_texts(F.col("document")), lambda x: F.trim(x, F.lit(" \t\n"))))).alias("identifier"))
    return found.filter(F.col("identifier").startswith(prefix) & (F.col("identifier") != F.trim("id"))).groupBy("identifier").agg(F.count(F.lit(1)).alias("records"))


def reference_closure(records: DataFrame, known: DataFrame, prefix: str) -> DataFrame:
    """(identifier, records, defined): every identifier that records name, and whether ``known`` (identifier) has it."""
    have = known.select("identifier").distinct().withColumn("_k", F.lit(True))
    return referenced_identifiers(records, prefix).join(have, "identifier", "left").select("identifier", "records", F.coalesce("_k", F.lit(False)).alias("defined"))


def row_faults(records: DataFrame, key: str, checks: dict[str, Column]) -> DataFrame:
    """(code, key): one row per failed check of a record, all checks in one pass; a check that is null does not fail."""
    codes = F.array_compact(F.array(*[F.when(failed, F.lit(code)) for code, failed in checks.items()]))
    return records.select(F.explode(codes).alias("code"), F.col(key).alias("key"))


def counted_gates(checks: list[tuple[str, DataFrame, DataFrame]]) -> DataFrame:
    """(gate, expected, actual, passes): numbers of rows that have to be equal."""
    count = lambda df, name: df.agg(F.count(F.lit(1)).alias(name))
    rows = [count(want, "expected").crossJoin(count(got, "actual")).select(F.lit(gate).alias("gate"), "expected", "actual") for gate, want, got in checks]  # one row each
    return reduce(DataFrame.unionByName, rows).withColumn("passes", F.col("expected") == F.col("actual"))


def migrated_rows(frozen: DataFrame, live: DataFrame, key: str, compared: list[str]) -> DataFrame:
    """(key, state): rows by their fate - kept, changed, lost, new; both sides have one row per key."""
    a = frozen.select(key, *[F.col(c).alias(f"_a_{c}") for c in compared], F.lit(True).alias("_a"))
    b = live.select(key, *[F.col(c).alias(f"_b_{c}") for c in compared], F.lit(True).alias("_b"))
    equal = reduce(lambda x, y: x & y, [F.col(f"_a_{c}").eqNullSafe(F.col(f"_b_{c}")) for c in compared])
    state = F.when(F.col("_a").isNull(), "new").when(F.col("_b").isNull(), "lost").when(equal, "kept").otherwise("changed")
    return a.join(b, key, "full").select(key, state.alias("state"))


def identity_conflicts(assertions: DataFrame, parts: list[str], digest: str) -> DataFrame:
    """(code, key): ids whose identity has several digests, or whose digest several identities have; a missing digest too."""
    identity = F.sha2(F.to_json(F.struct(*parts), {"ignoreNullFields": "false"}), 256)
    rows = assertions.select("id", identity.alias("identity"), F.col(digest).alias("digest")).distinct()
    several = lambda by, of: rows.filter("digest IS NOT NULL").select(by, of).distinct().groupBy(by).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").select(by)
    out = [rows.filter("digest IS NULL").select(F.lit("identity-digest-missing").alias("code"), F.col("id").alias("key"))]
    out += [rows.join(several(by, of), by, "left_semi").select(F.lit(code).alias("code"), F.col("id").alias("key")) for by, of, code in (("identity", "digest", "identity-digests"), ("digest", "identity", "digest-identities"))]
    return reduce(DataFrame.unionByName, out).distinct()


def null_budget(df: DataFrame, table: str, budget: dict[str, float]) -> DataFrame:
    """(table, column, missing, rows, within): missing values of columns against the share each may have; one pass."""
    sums = df.agg(F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in budget])
    parts = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("missing"), F.lit(share).alias("_s")) for c, share in budget.items()])
    return sums.select(F.explode(parts).alias("p"), "_n").select(F.lit(table).alias("table"), "p.column", "p.missing", F.col("_n").alias("rows"), (F.col("p.missing") <= F.col("p._s") * F.col("_n")).alias("within"))
