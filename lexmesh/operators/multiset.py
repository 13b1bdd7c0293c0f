"""Set and multiset algebra: differences, residual pairing, partitions, deduplication with accounts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def multiset_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """The rows' columns, n and side: exact (min of both), missing (more left), added (more right).

    One aggregation over both sides with signed counts: no row meets its copies.
    """
    keys = left.columns
    sides = left.select(*keys, F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(right.select(*keys, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
    n = sides.groupBy(*keys).agg(F.sum("_l").alias("_l"), F.sum("_r").alias("_r"))
    parts = F.array_compact(F.array(*[F.when(c > 0, F.struct(F.lit(s).alias("side"), c.alias("n"))) for s, c in (("exact", F.least("_l", "_r")), ("missing", F.col("_l") - F.col("_r")), ("added", F.col("_r") - F.col("_l")))]))
    return n.select(*keys, F.explode(parts).alias("p")).select(*keys, "p.side", "p.n")


def paired_residuals(left: DataFrame, right: DataFrame, key: list[str], fields: list[str]) -> DataFrame:
    """(key, change, changed_fields): rows left over on both sides paired by key in field order; pairs changed, the rest missing or added."""
    order = [F.col(f).asc_nulls_first() for f in fields]
    nth = F.row_number().over(Window.partitionBy(*key).orderBy(*order))
    a, b = left.exceptAll(right).withColumn("_n", nth), right.exceptAll(left).withColumn("_n", nth)
    b = b.select(*key, "_n", *[F.col(f).alias(f"_{f}") for f in fields], F.lit(1).alias("_b"))
    both = a.withColumn("_a", F.lit(1)).join(b, [*key, "_n"], "full")
    differs = F.array_join(F.array_compact(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields])), ",")
    change = F.when(F.col("_b").isNull(), "missing").when(F.col("_a").isNull(), "added").otherwise("changed")
    return both.select(*key, change.alias("change"), F.when(change == "changed", differs).alias("changed_fields"))


def arm_unions(ranks: DataFrame, gold: DataFrame) -> DataFrame:
    """(arm, candidates, hits, unique_hits): candidates of each arm, gold among them, gold no other arm has."""
    pairs = ranks.select("pair", "arm").distinct()
    arms = pairs.groupBy("pair").agg(F.count(F.lit(1)).alias("n"))
    marked = pairs.join(arms, "pair").join(gold.select("pair").distinct().withColumn("_g", F.lit(1)), "pair", "left")
    return marked.groupBy("arm").agg(F.count(F.lit(1)).alias("candidates"), F.count("_g").alias("hits"), F.count_if(F.col("_g").isNotNull() & (F.col("n") == 1)).alias("unique_hits"))


def arm_overlaps(ranks: DataFrame) -> DataFrame:
    """(arm_1, arm_2, both, union): sizes of intersections and unions of arms."""
    pairs = ranks.select("pair", "arm").distinct()
    size = pairs.groupBy("arm").agg(F.count(F.lit(1)).alias("n"))
    both = pairs.withColumnRenamed("arm", "arm_1").join(pairs.withColumnRenamed("arm", "arm_2"), "pair").filter("arm_1 < arm_2").groupBy("arm_1", "arm_2").agg(F.count(F.lit(1)).alias("both"))
    a, b = size.select(F.col("arm").alias("arm_1"), F.col("n").alias("_1")), size.select(F.col("arm").alias("arm_2"), F.col("n").alias("_2"))
    return both.join(a, "arm_1").join(b, "arm_2").select("arm_1", "arm_2", "both", (F.col("_1") + F.col("_2") - F.col("both")).alias("union"))


def bitmap_counts(pairs: DataFrame, key: str, position: str) -> DataFrame:
    """(key, distinct): exact distinct positions by bitmaps, combined over buckets of 32,768."""
    buckets = pairs.groupBy(key, F.bitmap_bucket_number(position).alias("_b")).agg(F.bitmap_count(F.bitmap_construct_agg(F.bitmap_bit_position(position))).alias("n"))
    return buckets.groupBy(key).agg(F.sum("n").alias("distinct"))


def partition_faults(parts: dict[str, DataFrame], population: DataFrame, key: str) -> DataFrame:
    """(fault, key): keys in no part, in several parts, or outside the population."""
    every = reduce(DataFrame.unionByName, [d.select(key).distinct().withColumn("_p", F.lit(n)) for n, d in parts.items()])
    n = every.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    both = population.select(key).distinct().withColumn("_in", F.lit(1)).join(n, key, "full")
    fault = F.when(F.col("_in").isNull(), "outside").when(F.col("_n").isNull(), "uncovered").when(F.col("_n") > 1, "overlap")
    return both.select(fault.alias("fault"), key).filter("fault IS NOT NULL")


def first_class(df: DataFrame, classes: list[tuple[str, Column]], rest: str) -> DataFrame:
    """df with class: the first class whose condition holds."""
    out = F.lit(rest)
    for name, condition in reversed(classes):
        out = F.when(condition, name).otherwise(out)
    return df.withColumn("class", out)


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct rows of either side that the other lacks, with side missing (left only) or extra (right only)."""
    n = left.distinct().withColumn("_s", F.lit(1)).unionByName(right.distinct().withColumn("_s", F.lit(2)))
    return n.groupBy(*left.columns).agg(F.sum("_s").alias("_s")).filter("_s < 3").withColumn("side", F.when(F.col("_s") == 1, "missing").otherwise("extra")).drop("_s")


def served_faults(served: DataFrame, asserted: DataFrame) -> DataFrame:
    """(role, id, fault): ids served but not asserted, asserted but not served, or served twice."""
    a = asserted.groupBy("role", "id").agg(F.count(F.lit(1)).alias("_a"))
    s = served.groupBy("role", "id").agg(F.count(F.lit(1)).alias("_s"))
    fault = F.when(F.col("_s").isNull(), "not served").when(F.col("_a").isNull(), "not asserted").when(F.col("_s") > 1, "repeated")
    return a.join(s, ["role", "id"], "full").select("role", "id", fault.alias("fault")).filter("fault IS NOT NULL")


def ledger_balance(records: DataFrame, links: DataFrame, key: str) -> DataFrame:
    """(key, declared, linked): keys whose declared number of links is not the number found."""
    n = links.groupBy(key).agg(F.count(F.lit(1)).alias("linked"))
    return records.groupBy(key).agg(F.sum("declared").alias("declared")).join(n, key, "full").select(key, F.coalesce("declared", F.lit(0)).alias("declared"), F.coalesce("linked", F.lit(0)).alias("linked")).filter("declared <> linked")


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of every key in a total order."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_n = 1").drop("_n")


def dedupe_accounts(df: DataFrame, part: str, anchor: str, keys: list[str]) -> DataFrame:
    """(part, rows, anchorless, distinct_rows, redundant): the accounts of deduplication, per partition that leads the key."""
    n = df.groupBy(part, *[k for k in keys if k != part]).agg(F.count(F.lit(1)).alias("_n"), F.count(anchor).alias("_a"))
    return n.groupBy(part).agg(F.sum("_n").alias("rows"), F.sum(F.col("_n") - F.col("_a")).alias("anchorless"), F.count(F.lit(1)).alias("distinct_rows"), F.sum(F.col("_n") - 1).alias("redundant"))


def roll_up(accounts: DataFrame) -> DataFrame:
    """Totals over partitions; valid since the partition leads the key."""
    return accounts.agg(*[F.sum(c).alias(c) for c in accounts.columns[1:]])


def owners(claims: DataFrame) -> DataFrame:
    """(iri, owner) of claims (iri, owner, held, preference): held first, then preference, then owner."""
    rank = Window.partitionBy("iri").orderBy(F.desc("held"), "preference", "owner")
    return claims.withColumn("_n", F.row_number().over(rank)).filter("_n = 1").select("iri", "owner")


def conflict_sets(claims: DataFrame, key: list[str], value: str) -> DataFrame:
    """(key, members): keys claimed by more than one value, members sorted."""
    return claims.groupBy(*key).agg(F.array_join(F.array_sort(F.collect_set(value)), ",").alias("members"), F.count_distinct(value).alias("_n")).filter("_n > 1").drop("_n")
