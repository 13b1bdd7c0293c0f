"""Text normalisers, tokens, n-grams and similarity measures."""

from __future__ import annotations

import unicodedata

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def fold_label(texts: pd.Series) -> pd.Series:
    """NFKC, case folding, runs of white space to one blank."""
    return texts.map(lambda t: None if t is None else " ".join(unicodedata.normalize("NFKC", t).casefold().split()))


@F.pandas_udf(T.StringType())
def fold_diacritics(texts: pd.Series) -> pd.Series:
    """NFKD without combining marks, lower case."""
    return texts.map(lambda t: None if t is None else "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower())


def fold_plain(text: Column | str) -> Column:
    """The same fold for plain text inside the JVM: lower case (one small sigma, as case folding has), runs of white space to one blank."""
    text = F.col(text) if isinstance(text, str) else text
    return F.replace(F.lower(F.trim(F.regexp_replace(text, r"\s+", " "))), F.lit("ς"), F.lit("σ"))


def word_tokens(folded: Column | str) -> Column:
    """Runs of 0-9a-z of a folded text."""
    folded = F.col(folded) if isinstance(folded, str) else folded
    return F.filter(F.split(folded, "[^0-9a-z]+"), lambda t: t != "")


def camel_tokens(text: Column | str) -> Column:
    """Words of a text, camelCase cut before its capitals."""
    text = F.col(text) if isinstance(text, str) else text
    return word_tokens(F.lower(F.regexp_replace(text, r"([a-z0-9])([A-Z])", "$1 $2")))


def identifier_tail(iri: Column | str) -> Column:
    """The words of an IRI's fragment, path end or urn end as a phrase; null under three letters or digits."""
    iri = F.col(iri) if isinstance(iri, str) else iri
    tail = F.when(iri.contains("#"), F.substring_index(iri, "#", -1)).when(iri.startswith("urn:"), F.substring_index(iri, ":", -1)).otherwise(F.substring_index(F.regexp_replace(iri, "/+$", ""), "/", -1))
    phrase = F.array_join(camel_tokens(F.url_decode(F.regexp_replace(tail, "%(?![0-9A-Fa-f]{2})", "%25"))), " ")
    return F.when(F.length(F.replace(phrase, F.lit(" "), F.lit(""))) >= 3, phrase)


def char_ngrams(phrase: Column | str, size: int, pad: str = "  ") -> Column:
    """All n-grams of a phrase with padding on both sides, repeats kept; none for an empty phrase."""
    phrase = F.col(phrase) if isinstance(phrase, str) else phrase
    padded = F.concat(F.lit(pad), phrase, F.lit(pad))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - size + 1, F.lit(1)))
    return F.when((F.length(phrase) > 0) & (F.length(padded) >= size), F.transform(starts, lambda i: F.substring(padded, i, F.lit(size)))).otherwise(F.array().cast("array<string>"))


def trigram_set(phrase: Column | str) -> Column:
    phrase = F.col(phrase) if isinstance(phrase, str) else phrase
    padded = F.concat(F.lit("^^"), phrase, F.lit("$$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(padded) - 2), lambda i: F.substring(padded, i, F.lit(3))))


def bigrams(tokens: Column | str) -> Column:
    """Neighbouring tokens joined by a blank."""
    tokens = F.col(tokens) if isinstance(tokens, str) else tokens
    n = F.size(tokens)
    pairs = F.transform(F.sequence(F.lit(1), F.greatest(n - 1, F.lit(1))), lambda i: F.concat_ws(" ", F.try_element_at(tokens, i), F.try_element_at(tokens, i + 1)))
    return F.when(n > 1, pairs).otherwise(F.array().cast("array<string>"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all distinct tokens; 0 if there are none."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


def overlap_band(score: Column) -> Column:
    return F.when(score == 0, "none").when(score < 0.34, "low").when(score < 0.67, "middle").when(score < 1, "high").otherwise("equal")


def singular(word: Column) -> Column:
    """A simple singular: -ies to -y, -(s|x|z|ch|sh)es without -es, -s without -s but not -ss, -us, -is."""
    return (
        F.when(word.rlike("[^aeiou]ies$"), F.regexp_replace(word, "ies$", "y"))
        .when(word.rlike("(s|x|z|ch|sh)es$"), F.regexp_replace(word, "es$", ""))
        .when(word.rlike("[^sui]s$") & (F.length(word) > 3), F.regexp_replace(word, "s$", ""))
        .otherwise(word)
    )


def initials(tokens: Column) -> Column:
    return F.array_join(F.transform(tokens, lambda t: F.substring(t, 1, 1)), "")


#: Ligatures and typographic marks of extracted text, with their plain form.
LIGATURES = {"ﬀ": "ff", "ﬁ": "fi", "ﬂ": "fl", "ﬃ": "ffi", "ﬄ": "ffl", "ﬅ": "st", "ﬆ": "st", "’": "'", "‘": "'", "“": '"', "”": '"', "–": "-", "—": "-", " ": " "}


def fold_extracted(text: Column | str) -> Column:
    """Ligatures spelled out, soft hyphens dropped, words cut at a line end joined."""
    text = F.col(text) if isinstance(text, str) else text
    out = F.regexp_replace(text, "­", "")
    out = F.regexp_replace(out, r"([a-z])-\n([a-z])", "$1$2")
    for mark, plain in LIGATURES.items():
        out = F.replace(out, F.lit(mark), F.lit(plain))
    return out


def stable_id(*parts: Column) -> Column:
    """SHA-256 over parts with an unambiguous separator."""
    return F.sha2(F.concat_ws("\x1f", *parts), 256)


def shard_key(column: Column | str, digits: int = 2) -> Column:
    return F.substring(F.sha2(column, 256), 1, digits)


def search_key(word: Column) -> Column:
    """The first two characters of a word, padded with '_'."""
    return F.substring(F.rpad(word, 2, "_"), 1, 2)


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors, null if either is null or has no length."""
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)
    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    return dot / F.nullif(norm(a) * norm(b), F.lit(0.0))


def wilson(hits: Column, total: Column, z: float = 1.96) -> tuple[Column, Column]:
    """The Wilson interval of a share; nulls for an empty total."""
    n = F.nullif(total.cast("double"), F.lit(0.0))
    p = hits / n
    centre, spread = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))
    return (centre - spread) / (1 + z * z / n), (centre + spread) / (1 + z * z / n)


@F.pandas_udf(T.DoubleType())
def fisher_exact(a: pd.Series, b: pd.Series, c: pd.Series, d: pd.Series) -> pd.Series:
    """Two-sided p-value of a 2 x 2 table: the weight of all tables no likelier than this one."""
    from math import lgamma

    def log_choose(n: int, k: int) -> float:
        return lgamma(n + 1) - lgamma(k + 1) - lgamma(n - k + 1)

    def one(a: int, b: int, c: int, d: int) -> float:
        row, col, n = a + b, a + c, a + b + c + d
        low, high = max(0, col - (n - row)), min(row, col)
        logs = np.array([log_choose(row, k) + log_choose(n - row, col - k) - log_choose(n, col) for k in range(low, high + 1)])
        return float(min(1.0, np.exp(logs[logs <= logs[a - low] + 1e-7]).sum()))

    return pd.Series([one(*map(int, r)) for r in zip(a, b, c, d, strict=True)])


@F.pandas_udf(T.DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    """Jaro-Winkler similarity with prefix weight 0.1 over up to four characters, above 0.7."""

    def jaro(s: str, t: str) -> float:
        if s == t:
            return 1.0
        if not s or not t:
            return 0.0
        reach = max(max(len(s), len(t)) // 2 - 1, 0)
        used = [False] * len(t)
        left = []
        for i, x in enumerate(s):
            for j in range(max(0, i - reach), min(len(t), i + reach + 1)):
                if not used[j] and t[j] == x:
                    used[j] = True
                    left.append(x)
                    break
        if not left:
            return 0.0
        right = [t[j] for j in range(len(t)) if used[j]]
        swaps = sum(x != y for x, y in zip(left, right, strict=True)) // 2
        m = len(left)
        return (m / len(s) + m / len(t) + (m - swaps) / m) / 3

    def one(s: str | None, t: str | None) -> float | None:
        if s is None or t is None:
            return None
        v = jaro(s, t)
        same = 0
        for x, y in zip(s[:4], t[:4], strict=False):
            if x != y:
                break
            same += 1
        return v + same * 0.1 * (1 - v) if v > 0.7 else v

    return pd.Series([one(s, t) for s, t in zip(a, b, strict=True)])


def edit_ratio(a: Column, b: Column) -> Column:
    """1 - edit distance over the longer length; 1 for two empty texts."""
    longest = F.greatest(F.length(a), F.length(b))
    return F.when(longest > 0, 1 - F.levenshtein(a, b) / longest).otherwise(F.lit(1.0))


def sorted_token_text(tokens: Column) -> Column:
    return F.array_join(F.array_sort(tokens), " ")


def token_set_ratio(a: Column, b: Column) -> Column:
    """The best edit ratio between the shared tokens and either side's tokens with the shared ones first."""
    both, x, y = (F.array_sort(F.array_distinct(v)) for v in (F.array_intersect(a, b), F.array_except(a, b), F.array_except(b, a)))
    base = F.array_join(both, " ")
    left, right = F.trim(F.concat_ws(" ", base, F.array_join(x, " "))), F.trim(F.concat_ws(" ", base, F.array_join(y, " ")))
    return F.greatest(F.when(F.size(both) > 0, F.greatest(edit_ratio(base, left), edit_ratio(base, right))).otherwise(F.lit(0.0)), edit_ratio(left, right))


def digest_sums(line: Column) -> list[Column]:
    """Aggregates of the eight 32-bit words of the SHA-256 of lines; joined by ``digest_text`` they digest rows in any order."""
    full = F.sha2(line, 256)
    return [F.sum(F.conv(F.substring(full, 1 + 8 * i, 8), 16, 10).cast("decimal(20,0)")).alias(f"_d{i}") for i in range(8)]


def digest_text() -> Column:
    return F.concat_ws("-", *[F.col(f"_d{i}").cast("string") for i in range(8)])
