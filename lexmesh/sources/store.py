"""Opening, verifying and writing the record tables."""

from __future__ import annotations

import hashlib
import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmesh.schema import SCHEMAS, conform


def exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def open_views(spark: SparkSession, tables: dict[str, str], prefix: str = "atlas_") -> list[str]:
    """Register each Parquet member as a temporary view; names of the views."""
    names = []
    for name, path in sorted(tables.items()):
        spark.read.parquet(path).createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names


def optional_pair(spark: SparkSession, first: str, second: str) -> tuple[DataFrame, DataFrame] | None:
    """Two tables that come together; None if neither is there, an error if only one is."""
    there = [exists(spark, first), exists(spark, second)]
    if any(there) and not all(there):
        raise ValueError("of a pair of tables only one is present")
    return (spark.read.parquet(first), spark.read.parquet(second)) if all(there) else None


def discover(df: DataFrame, wanted: dict[str, tuple[str, ...]], required: tuple[str, ...]) -> DataFrame:
    """Columns by the first candidate name that exists; others become null text, a missing required one is an error."""
    out = []
    for name, candidates in wanted.items():
        found = next((c for c in candidates if c in df.columns), None)
        if found is None and name in required:
            raise ValueError(f"no column for {name}")
        out.append((F.col(found) if found else F.lit(None).cast("string")).alias(name))
    return df.select(*out)


def ad_hoc(spark: SparkSession, sql: str, parameters: list | None = None) -> DataFrame:
    """A query with positional parameters."""
    return spark.sql(sql, args=parameters or [])


def write_records(df: DataFrame, role: str, path: str) -> None:
    """One role's table with its closed schema, zstd; an empty table is written with its schema."""
    conform(df, role).write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_search_view(df: DataFrame, role: str, path: str) -> None:
    """A role's columns for serving (digests dropped), staged beside the target and renamed into place."""
    spark = df.sparkSession
    keep = [f.name for f in SCHEMAS[role].fields if f.name != "content_digest"]
    conform(df, role).select(*keep).write.mode("overwrite").option("compression", "zstd").parquet(f"{path}.staged")
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    Path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = Path(path).getFileSystem(conf)
    fs.delete(Path(path), True)
    if not fs.rename(Path(f"{path}.staged"), Path(path)):
        raise OSError(f"could not move the staged view to {path}")


def write_text_table(df: DataFrame, path: str) -> None:
    """All columns as text; nested ones as JSON."""
    cols = [F.to_json(c).alias(c) if t.startswith(("array", "struct", "map")) else (F.hex(c) if t == "binary" else F.col(c).cast("string")).alias(c) for c, t in df.dtypes]
    df.select(*cols).write.mode("overwrite").parquet(path)


def write_sorted_text(lines: DataFrame, path: str, partitions: int) -> DataFrame:
    """Distinct lines in total order as compressed text, with one receipt row per partition: lines, first, last, digest.

    Ranges are sorted apart with spilling, so no task holds more than its range.
    """
    ordered = lines.select("value").distinct().repartitionByRange(partitions, "value").sortWithinPartitions("value")
    ordered.write.mode("overwrite").option("compression", "gzip").text(path)
    back = lines.sparkSession.read.text(path).select("value", F.input_file_name().alias("file"))
    return back.groupBy("file").agg(F.count(F.lit(1)).alias("lines"), F.min("value").alias("first"), F.max("value").alias("last"), F.sum(F.xxhash64("value").cast("decimal(38,0)")).cast("string").alias("digest"))


def write_shards(df: DataFrame, key: str, path: str, digits: int = 2) -> None:
    """JSON lines in one folder per hash prefix of a key, sorted by key; a shard's rows meet in few tasks."""
    shard = F.substring(F.sha2(key, 256), 1, digits)
    df.withColumn("shard", shard).repartition("shard").sortWithinPartitions("shard", key).write.mode("overwrite").partitionBy("shard").option("compression", "gzip").json(path)


def catalog_pages(documents: DataFrame, size: int) -> DataFrame:
    """(key, page, entries, first, last): search entries by two-character word keys, in pages of fixed size.

    Entries are sorted by label, id; a page tells its first and last label.
    """
    from lexmesh.functions.text import search_key, word_tokens
    from lexmesh.operators.ranks import with_rank

    words = documents.select("id", "label", F.lower("label").alias("_low"), F.explode(F.array_distinct(F.transform(word_tokens(F.lower("label")), search_key))).alias("key"))
    ranked = with_rank(words, ["key", "_low", "label", "id"], "_n")
    first = ranked.groupBy("key").agg(F.min("_n").alias("_first"))  # a row per two-character key
    paged = ranked.join(F.broadcast(first), "key").withColumn("page", F.floor((F.col("_n") - F.col("_first")) / size).cast("int"))
    order = F.struct(F.lower("label"), "label", "id")
    return paged.groupBy("key", "page").agg(F.count(F.lit(1)).alias("entries"), F.min_by("label", order).alias("first"), F.max_by("label", order).alias("last"))


def manifest(spark: SparkSession, tables: dict[str, str]) -> dict:
    """Per member: rows, schema and the digests of its files' bytes, hashed by executors."""
    out = {}
    for name, path in sorted(tables.items()):
        files = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256).alias("d"), "length").orderBy("d").collect()
        df = spark.read.parquet(path)
        out[name] = {"rows": df.count(), "schema": hashlib.sha256(df.schema.json().encode()).hexdigest(), "bytes": sum(f["length"] for f in files), "digest": hashlib.sha256("".join(f["d"] for f in files).encode()).hexdigest()}
    return out


def verify(spark: SparkSession, tables: dict[str, str], expected: dict) -> list[str]:
    """What differs from a manifest: members that lack or exceed it, and values that changed."""
    found = manifest(spark, {k: v for k, v in tables.items() if k in expected})
    faults = [f"unexpected member {k}" for k in sorted(set(tables) - set(expected))] + [f"missing member {k}" for k in sorted(set(expected) - set(tables))]
    return faults + [f"{k}: {field} differs" for k in sorted(found) for field in found[k] if found[k][field] != expected[k][field]]


def pin(path: str, size: int, digest: str) -> None:
    """Refuse a local input file whose bytes are not the pinned ones."""
    h, n = hashlib.sha256(), os.path.getsize(path)
    with open(path, "rb") as f:
        while block := f.read(1 << 20):
            h.update(block)
    if n != size or h.hexdigest() != digest:
        raise ValueError(f"{path} is not the pinned input")


def tree_diff(spark: SparkSession, left: str, right: str) -> DataFrame:
    """(file, state) of two directory trees by bytes: equal, differs, left only, right only."""
    from lexmesh.operators.claims import reconcile_digests

    def side(root: str) -> DataFrame:
        files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
        return files.select(F.element_at(F.split("path", root.rstrip("/").rpartition("/")[2] + "/", 2), 2).alias("file"), F.sha2("content", 256).alias("digest"))

    return reconcile_digests(side(left), side(right), "file", "digest")


def canonical_json(value: object) -> str:
    """Sorted keys, no blanks; floats are refused and integers bounded to 53 bits."""

    def check(v: object) -> None:
        if isinstance(v, float):
            raise ValueError("no floats in canonical JSON")
        if isinstance(v, int) and not isinstance(v, bool) and abs(v) > 2**53 - 1:
            raise ValueError("integer beyond 53 bits")
        for x in v.values() if isinstance(v, dict) else v if isinstance(v, list | tuple) else ():
            check(x)

    check(value)
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
