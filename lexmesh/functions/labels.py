"""Display labels, statuses and ranks of records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def active(status: Column | str, mode: str = "active") -> Column:
    """Whether a status is shown: anything but a text with "deprecated" in it; null is shown; mode "all" shows all."""
    if mode not in ("active", "all"):
        raise ValueError(f"unknown status mode: {mode}")
    status = F.col(status) if isinstance(status, str) else status
    return F.lit(True) if mode == "all" else status.isNull() | ~F.lower(status).contains("deprecated")


def role_rank(role: Column | str) -> Column:
    role = F.col(role) if isinstance(role, str) else role
    return F.when(role == "preferred", 0).when(role == "alternate", 1).when(role == "hidden", 2).otherwise(99)


def local_name(iri: Column | str) -> Column:
    """The last part of an IRI, '' if it has none."""
    iri = F.col(iri) if isinstance(iri, str) else iri
    return F.regexp_extract(iri, r"([^#/:]+)[/#:]?$", 1)


def short_name(iri: Column | str) -> Column:
    """After the last '#', without closing '/', after the last '/', after the last ':'; '' for null."""
    iri = F.col(iri) if isinstance(iri, str) else iri
    tail = F.regexp_replace(F.substring_index(iri, "#", -1), "/+$", "")
    return F.coalesce(F.substring_index(F.substring_index(tail, "/", -1), ":", -1), F.lit(""))


def english(language: Column | str) -> Column:
    language = F.col(language) if isinstance(language, str) else language
    return F.lower(language) == "en"


def english_family(language: Column | str, untagged: bool = False) -> Column:
    """en and its regional forms; with ``untagged`` also null or empty tags."""
    language = F.lower(F.trim(F.col(language) if isinstance(language, str) else language))
    own = F.coalesce(language.rlike(r"^en([-_].*)?$"), F.lit(False))
    return own | F.coalesce(language, F.lit("")).isin("") if untagged else own


def ranked_labels(labels: DataFrame) -> DataFrame:
    """(resource, value, label_role, label_rank) of English labels, by role, then value."""
    order = Window.partitionBy("resource").orderBy(role_rank("label_role"), F.lower("value"), "value")
    return labels.filter(english("language")).select("resource", "value", "label_role", F.row_number().over(order).alias("label_rank"))


def display_labels(labels: DataFrame) -> DataFrame:
    """(resource, label): the first English label; one partial aggregation, no sort of whole groups."""
    first = F.min_by("value", F.struct(role_rank("label_role"), F.lower("value"), "value"))
    return labels.filter(english("language")).groupBy("resource").agg(first.alias("label"))
