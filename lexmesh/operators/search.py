"""Search documents, token postings and BM25 ranking."""

from __future__ import annotations

import math
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lexmesh.functions.labels import english, local_name, role_rank

#: The usual BM25 parameters.
K1, B = 1.2, 0.75


@F.pandas_udf(T.StringType())
def strip_accents(texts: pd.Series) -> pd.Series:
    """Decomposed text without combining marks."""
    return texts.map(lambda t: t if t is None or t.isascii() else "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.combining(c)))


def search_documents(resources: DataFrame, labels: DataFrame, identifiers: DataFrame) -> DataFrame:
    """(id, label, search_text): display label, and aliases, notations, identifiers, id and definition joined by blanks."""
    english_labels = labels.filter(english("language"))
    by_label = english_labels.groupBy(F.col("resource").alias("id")).agg(
        F.min_by("value", F.struct(role_rank("label_role"), F.lower("value"), "value")).alias("display"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.lower("value"), F.col("value").alias("v")))), lambda x: x["v"]), " ").alias("aliases"),
    )
    by_identifier = identifiers.groupBy(F.col("identifies").alias("id")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.lower("identifier_value"), F.col("identifier_value").alias("v")))), lambda x: x["v"]), " ").alias("identifiers")
    )
    both = resources.select("id", "notations", "definition").join(by_label, "id", "left").join(by_identifier, "id", "left")
    label = F.coalesce("display", F.nullif(local_name("id"), F.lit("")), F.col("id"))
    return both.select("id", label.alias("label"), F.concat_ws(" ", "aliases", F.array_join("notations", " "), "identifiers", "id", "definition").alias("search_text"))


def tokens(text: Column, fold: bool = True) -> Column:
    """Lower-case runs of a-z0-9; no stemming, no stop words."""
    text = strip_accents(text) if fold else text
    return F.filter(F.split(F.lower(text), "[^a-z0-9]+"), lambda t: t != "")


def postings(documents: DataFrame, fold: bool = True) -> tuple[DataFrame, DataFrame]:
    """Postings (term, id, tf) and document lengths (id, length)."""
    cut = documents.select("id", tokens(F.col("search_text"), fold).alias("t"))
    return cut.select("id", F.explode("t").alias("term")).groupBy("term", "id").agg(F.count(F.lit(1)).alias("tf")), cut.select("id", F.size("t").alias("length"))


def _occurrences(word: str) -> Column:
    return F.size(F.filter("t", lambda x: x == word))


def bm25(documents: DataFrame, query: str, fold: bool = True) -> DataFrame:
    """(id, label, score) of documents with any word of the query.

    score is the sum over distinct query words of ln(1 + (n - df + 0.5) / (df + 0.5)) *
    tf * (k1 + 1) / (tf + k1 * (1 - b + b * length / mean length)). Only postings of
    query words are kept: they are filtered inside each document before any shuffle.
    """
    import re

    text = "".join(c for c in unicodedata.normalize("NFD", query) if not unicodedata.combining(c)) if fold else query
    words = sorted({w for w in re.split("[^a-z0-9]+", text.lower()) if w})
    cut = documents.select("id", "label", tokens(F.col("search_text"), fold).alias("t"))
    sized = cut.select("id", "label", F.size("t").alias("length"), *[_occurrences(w).alias(f"tf{i}") for i, w in enumerate(words)])
    stats = sized.agg(F.count(F.lit(1)).alias("n"), F.avg("length").alias("mean"), *[F.count_if(F.col(f"tf{i}") > 0).alias(f"df{i}") for i in range(len(words))])
    totals = stats.first()  # one row of corpus totals
    norm = K1 * (1 - B + B * F.col("length") / F.lit(totals["mean"] or 1.0))
    score = F.lit(0.0)
    for i in range(len(words)):
        idf = math.log(1 + (totals["n"] - totals[f"df{i}"] + 0.5) / (totals[f"df{i}"] + 0.5))
        score = score + F.lit(idf) * F.col(f"tf{i}") * (K1 + 1) / (F.col(f"tf{i}") + norm)
    hit = F.lit(False)
    for i in range(len(words)):
        hit = hit | (F.col(f"tf{i}") > 0)
    return sized.filter(hit).select("id", "label", score.alias("score"))


def search(documents: DataFrame, resources: DataFrame, query: str = "", releases: tuple[str, ...] = (), ring: str = "", status: str = "active", limit: int = 100, offset: int = 0) -> DataFrame:
    """Ranked hits, or all documents by label for a blank query; filters on release, ring and status."""
    from lexmesh.functions.labels import active
    from lexmesh.operators.explore import check_page

    check_page(limit, offset, status)
    kept = resources.filter(active("record_status", status))
    wanted = sorted({r for r in releases if r})
    if wanted:
        kept = kept.filter(F.col("release").isin(wanted))
    if ring:
        kept = kept.filter(F.col("semantic_ring") == ring)
    kept = kept.select("id", "release", F.col("semantic_ring").alias("ring"), F.col("resource_profile").alias("profile"))
    by_label = [F.lower("label"), F.col("label"), F.col("id")]
    if not query.strip():
        return documents.select("id", "label").join(kept, "id").orderBy(*by_label).offset(offset).limit(limit)
    hits = bm25(documents, query).join(kept, "id")
    return hits.orderBy(F.desc(F.round("score", 9)), *by_label).offset(offset).limit(limit)
