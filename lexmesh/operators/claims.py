"""Claims (one fact per row) to records and back, and other restructuring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmesh.functions.text import digest_sums, digest_text
from lexmesh.functions.labels import english_family


def to_claims(resources: DataFrame, labels: DataFrame) -> DataFrame:
    """(subject, predicate, object_kind, value, language): records as claims; nulls make no claim."""
    lit, iri = F.lit("literal"), F.lit("iri")
    none = F.lit(None).cast("string")
    facts = F.array_compact(
        F.concat(
            F.array(F.struct(F.lit("inScheme").alias("p"), iri.alias("k"), F.col("scheme").alias("v"))),
            F.array(F.when(F.col("definition").isNotNull(), F.struct(F.lit("definition").alias("p"), lit.alias("k"), F.col("definition").alias("v")))),
            F.transform(F.coalesce("notes", F.array().cast("array<string>")), lambda x: F.struct(F.lit("note").alias("p"), lit.alias("k"), x.alias("v"))),
            F.transform(F.coalesce("notations", F.array().cast("array<string>")), lambda x: F.struct(F.lit("notation").alias("p"), lit.alias("k"), x.alias("v"))),
        )
    )
    own = resources.select(F.col("id").alias("subject"), F.explode(facts).alias("f")).select("subject", F.col("f.p").alias("predicate"), F.col("f.k").alias("object_kind"), F.col("f.v").alias("value"), none.alias("language"))
    named = labels.select(F.col("resource").alias("subject"), F.concat(F.col("label_role"), F.lit("Label")).alias("predicate"), lit.alias("object_kind"), "value", "language")
    return own.unionByName(named).distinct()


def from_claims(claims: DataFrame, membership: str, excluded: tuple[str, ...] = ()) -> DataFrame:
    """(id, scheme, preferred, alternates, notations, definition, notes): subjects with a membership claim, pivoted by rule.

    Values are trimmed, distinct and sorted; the first definition is the definition and
    further ones join the notes.
    """
    text = F.trim("value")

    def values(predicate: str):
        return F.array_sort(F.collect_set(F.when((F.col("predicate") == predicate) & english_family("language", True), text)))

    wide = claims.groupBy(F.col("subject").alias("id")).agg(
        F.min(F.when(F.col("predicate") == membership, F.col("value"))).alias("scheme"),
        values("preferredLabel").alias("_p"), values("alternateLabel").alias("_a"), values("notation").alias("_n"), values("definition").alias("_d"), values("note").alias("_o"),
    ).filter("scheme IS NOT NULL")
    if excluded:
        wide = wide.filter(~F.col("id").isin(*excluded))
    return wide.select(
        "id", "scheme", F.get("_p", F.lit(0)).alias("preferred"), F.array_join("_a", "|").alias("alternates"), F.array_join("_n", "|").alias("notations"),
        F.get("_d", F.lit(0)).alias("definition"), F.array_join(F.array_sort(F.concat("_o", F.slice("_d", F.lit(2), F.greatest(F.size("_d"), F.lit(1))))), "|").alias("notes"),
    )


def claim_relations(claims: DataFrame, members: DataFrame, predicates: dict[str, str]) -> DataFrame:
    """(subject, predicate, object): iri claims between members, predicates mapped by a small table."""
    ids = members.select("id").distinct()
    kept = claims.filter((F.col("object_kind") == "iri") & F.col("predicate").isin(*predicates))
    kept = kept.join(ids.withColumnRenamed("id", "subject"), "subject", "left_semi").join(ids.withColumnRenamed("id", "value"), "value", "left_semi")
    out = F.col("predicate")
    for old, new in predicates.items():
        out = F.when(F.col("predicate") == old, new).otherwise(out)
    return kept.select("subject", out.alias("predicate"), F.col("value").alias("object")).distinct()


def release_digests(claims: DataFrame, by: str) -> DataFrame:
    """(by, claims, digest): an order-free digest of each release's claims, summed from whole SHA-256 digests of rows."""
    line = F.concat_ws("\x1f", *[F.coalesce(F.col(c).cast("string"), F.lit("\x1e")) for c in sorted(claims.columns)])
    return claims.groupBy(by).agg(F.count(F.lit(1)).alias("claims"), *digest_sums(line)).select(by, "claims", digest_text().alias("digest"))


def language_audit(labels: DataFrame) -> DataFrame:
    """(language, labels, resources, english): labels by language tag as written."""
    return labels.groupBy("language").agg(F.count(F.lit(1)).alias("labels"), F.count_distinct("resource").alias("resources"), F.max(english_family("language")).alias("english"))


def unit_selection(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """(column, rows, selected): units with their rows and whether the allow-list has them."""
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows")).withColumn("selected", F.col(column).isin(*allowed))


def unknown_units(df: DataFrame, column: str, allowed: tuple[str, ...]) -> DataFrame:
    """Allowed units that do not occur."""
    want = df.sparkSession.createDataFrame([(x,) for x in allowed], f"{column} string")
    return want.join(df.select(column).distinct(), column, "left_anti")


def owner_dependencies(statements: DataFrame, resources: DataFrame) -> DataFrame:
    """(owner, needs, edges): releases whose records refer to another release's records."""
    own = resources.select("id", "release").distinct()
    s, o = own.select(F.col("id").alias("subject"), F.col("release").alias("owner")), own.select(F.col("id").alias("object"), F.col("release").alias("needs"))
    return statements.select("subject", "object").join(s, "subject").join(o, "object").filter("owner <> needs").groupBy("owner", "needs").agg(F.count(F.lit(1)).alias("edges"))


def pivot_subjects(triples: DataFrame, predicates: list[str]) -> DataFrame:
    """(subject, predicate columns...): one record per subject, values sorted and joined."""
    return triples.groupBy("subject").agg(*[F.array_join(F.array_sort(F.collect_set(F.when(F.col("predicate") == p, F.col("object")))), "|").alias(p.rpartition(":")[2]) for p in predicates])


def map_relations(df: DataFrame, column: str, table: dict[str, str]) -> DataFrame:
    """(…, mapped): relation spellings to one name each by a small table, after dropping namespace, case and word breaks; unknown ones are null."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(column, r"(?s)^.*[:#/]", ""), r"[\s_\-]+", ""))
    out = F.lit(None).cast("string")
    for name, target in table.items():
        out = F.when(bare == name, target).otherwise(out)
    return df.withColumn("mapped", out)


def spread_positions(df: DataFrame, by: str, order: str, k: int = 5) -> DataFrame:
    """Up to k rows per group at evenly spread positions i * (n - 1) div (k - 1) of its order."""
    per = Window.partitionBy(by)
    rows = df.withColumn("_n", F.count(F.lit(1)).over(per)).withColumn("_i", F.row_number().over(per.orderBy(order)) - 1)
    spots = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.floor(i * (F.col("_n") - 1) / (k - 1)))
    return rows.filter(F.array_contains(spots, F.col("_i").cast("long"))).drop("_n", "_i")


def supersession_records(releases: DataFrame, order: str) -> DataFrame:
    """(id, superseded_by): each release with the next of its scheme."""
    return releases.select("id", "scheme", F.lead("id").over(Window.partitionBy("scheme").orderBy(order, "id")).alias("superseded_by")).filter("superseded_by IS NOT NULL").drop("scheme")


def reconcile_digests(left: DataFrame, right: DataFrame, key: str, digest: str) -> DataFrame:
    """(key, state): equal, differs, left only, right only."""
    both = left.select(key, F.col(digest).alias("_l"), F.lit(1).alias("_a")).join(right.select(key, F.col(digest).alias("_r"), F.lit(1).alias("_b")), key, "full")
    state = F.when(F.col("_b").isNull(), "left only").when(F.col("_a").isNull(), "right only").when(F.col("_l").eqNullSafe(F.col("_r")), "equal").otherwise("differs")
    return both.select(key, state.alias("state"))
