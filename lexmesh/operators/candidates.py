"""Candidate generation and ranking across two vocabularies."""

from __future__ import annotations

import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lexmesh.functions.labels import display_labels, english
from lexmesh.functions.text import bigrams, char_ngrams, fold_plain, identifier_tail, word_tokens
from lexmesh.storage import materialize, scratch_dir

#: Classes of candidate pairs, strongest first.
CLASSES = ("normalizedLabelEquality", "alternateLabelEquality", "substringNearMiss", "editDistanceNearMiss", "siblingDistractor")
TERM_CAP = 3


def concepts(resources: DataFrame, labels: DataFrame, scheme: str) -> DataFrame:
    """(member, pref, definition) of a scheme's resources with an English label; distinct ids."""
    own = resources.filter(F.col("scheme") == scheme).groupBy(F.col("id").alias("member")).agg(F.min("definition").alias("definition"))
    return own.join(display_labels(labels).select(F.col("resource").alias("member"), F.col("label").alias("pref")), "member").select("member", "pref", "definition")


def concept_labels(found: DataFrame, labels: DataFrame) -> DataFrame:
    """(member, label, preferred): all English labels of concepts, folded, once each."""
    every = labels.filter(english("language")).select(F.col("resource").alias("member"), "value").join(found.select("member", "pref"), "member")
    flat = every.select("member", fold_plain("value").alias("label"), (F.col("value") == F.col("pref")).alias("p"))
    return flat.groupBy("member", "label").agg(F.max("p").alias("preferred"))


def equal_preferred(s: DataFrame, t: DataFrame, fold=fold_plain) -> DataFrame:
    """Pairs with equal folded preferred labels."""
    return s.select(F.col("member").alias("source"), fold("pref").alias("k")).join(t.select(F.col("member").alias("target"), fold("pref").alias("k")), "k").filter("k <> ''").select("source", "target").distinct()


def equal_any(s_labels: DataFrame, t_labels: DataFrame, equal: DataFrame) -> DataFrame:
    """Pairs with any equal label, without the pairs of equal preferred labels."""
    both = s_labels.select(F.col("member").alias("source"), "label").join(t_labels.select(F.col("member").alias("target"), "label"), "label").filter("label <> ''")
    return both.select("source", "target").distinct().join(equal, ["source", "target"], "left_anti")


def contained(s: DataFrame, t: DataFrame) -> DataFrame:
    """(source, target, direction): one label's tokens are a proper run of the other's.

    A contained label must share its rarest token, so only labels with that token meet;
    no pair of all labels is formed.
    """
    def cut(df: DataFrame) -> DataFrame:
        toks = word_tokens(fold_plain("pref"))
        return df.select("member", toks.alias("toks"), F.concat(F.lit(" "), F.array_join(toks, " "), F.lit(" ")).alias("text")).filter(F.size("toks") > 0)

    s, t = cut(s), cut(t)
    df = s.unionByName(t).select(F.explode(F.array_distinct("toks")).alias("tok")).groupBy("tok").agg(F.count(F.lit(1)).alias("n"))

    def rarest(side: DataFrame) -> DataFrame:
        flat = side.select("member", "text", F.size("toks").alias("size"), F.explode(F.array_distinct("toks")).alias("tok")).join(df, "tok")
        return flat.groupBy("member", "text", "size").agg(F.min(F.struct("n", "tok")).alias("m")).select("member", "text", "size", F.col("m.tok").alias("tok"))

    def inside(small: DataFrame, big: DataFrame, names: tuple[str, str], direction: str) -> DataFrame:
        flat = big.select(F.col("member").alias(names[1]), F.col("text").alias("_big"), F.size("toks").alias("_size"), F.explode(F.array_distinct("toks")).alias("tok"))
        both = rarest(small).withColumnRenamed("member", names[0]).join(flat, "tok").filter((F.col("size") < F.col("_size")) & F.contains("_big", "text"))
        return both.select("source", "target", F.lit(direction).alias("direction"))

    return inside(s, t, ("source", "target"), "sourceInsideTarget").unionByName(inside(t, s, ("target", "source"), "targetInsideSource"))


def near_in_edits(s: DataFrame, t: DataFrame, limit: int = 2) -> DataFrame:
    """(source, target, distance): folded labels that differ by 1..limit edits.

    A label cut in limit + 1 parts keeps one part unchanged, shifted by at most the
    limit; labels meet on (length, part number, part). All such pairs are found, and no
    pair of all labels is formed.
    """
    parts = limit + 1
    s, t = (d.select("member", fold_plain("pref").alias("label")).filter("label <> ''") for d in (s, t))

    def begin(length: Column, i: Column) -> Column:
        return F.floor(length * i / parts).cast("int")

    index = F.sequence(F.lit(0), F.lit(parts - 1))
    n = F.length("label")
    own = F.transform(index, lambda i: F.struct(n.alias("n"), i.alias("i"), F.substring("label", begin(n, i) + 1, begin(n, i + 1) - begin(n, i)).alias("part")))
    left = s.select(F.col("member").alias("source"), F.col("label").alias("_a"), F.explode(own).alias("k"))
    lengths = F.sequence(F.greatest(n - limit, F.lit(1)), n + limit)
    shifts = F.sequence(F.lit(-limit), F.lit(limit))
    probes = F.flatten(
        F.transform(lengths, lambda m: F.flatten(F.transform(index, lambda i: F.transform(shifts, lambda d: F.when(begin(m, i) + d >= 0, F.struct(m.alias("n"), i.alias("i"), F.substring("label", begin(m, i) + d + 1, begin(m, i + 1) - begin(m, i)).alias("part")))))))
    )
    right = t.select(F.col("member").alias("target"), F.col("label").alias("_b"), F.explode(F.array_distinct(F.array_compact(probes))).alias("k"))
    met = left.join(right, "k").select("source", "target", "_a", "_b").distinct().filter("_a <> _b")
    return met.withColumn("distance", F.levenshtein("_a", "_b", limit)).filter("distance >= 0").select("source", "target", "distance")


def sibling_distractors(equal: DataFrame, broader: DataFrame) -> DataFrame:
    """Pairs of a source and the siblings of its equal match; broader (a, b) points from child to parent."""
    up = broader.select(F.col("a").alias("kid"), F.col("b").alias("up")).distinct()
    both = equal.join(up.withColumnRenamed("kid", "target"), "target").join(up, "up").filter("kid <> target")
    return both.select("source", F.col("kid").alias("target")).distinct()


def claim_classes(classes: list[tuple[str, DataFrame]]) -> DataFrame:
    """(source, target, generation_class): each pair under the first class that has it; nothing is capped."""
    every = reduce(DataFrame.unionByName, [d.select("source", "target", F.lit(i).alias("_c")) for i, (_, d) in enumerate(classes)])
    first = every.groupBy("source", "target").agg(F.min("_c").alias("_c"))
    names = F.array(*[F.lit(n) for n, _ in classes])
    return first.select("source", "target", F.get(names, F.col("_c")).alias("generation_class"))


def candidate_pairs(s: DataFrame, t: DataFrame, labels: DataFrame, broader: DataFrame) -> DataFrame:
    """All five deterministic classes."""
    equal = equal_preferred(s, t)
    members = t.select("member")
    inside = broader.join(members.select(F.col("member").alias("a")), "a", "left_semi").join(members.select(F.col("member").alias("b")), "b", "left_semi")
    return claim_classes(list(zip(CLASSES, [equal, equal_any(concept_labels(s, labels), concept_labels(t, labels), equal), contained(s, t), near_in_edits(s, t), sibling_distractors(equal, inside)], strict=True)))


def check_sides(sources: DataFrame, targets: DataFrame) -> None:
    """Refuse empty sides and members on both sides."""
    if sources.isEmpty() or targets.isEmpty():
        raise ValueError("both sides need concepts")
    if not sources.select("member").join(targets.select("member"), "member", "left_semi").isEmpty():
        raise ValueError("a member lies on both sides")


def _member_texts(texts: DataFrame) -> DataFrame:
    """(member, texts): all texts of a member that have words, as words with their weight, each distinct one once."""
    key = ["member", "value", "weight", *(["origin"] if "origin" in texts.columns else [])]
    base = texts.select(*key).distinct().select("member", F.struct(F.col("weight").cast("long").alias("weight"), word_tokens(fold_plain("value")).alias("toks")).alias("t")).filter(F.size("t.toks") > 0)
    return base.groupBy("member").agg(F.collect_list("t").alias("texts"))


def _count_features(texts: list[dict], grams: tuple[int, ...]) -> dict[str, int]:
    """The features of one member's texts with their values."""
    out: Counter = Counter()
    for t in texts:
        w, toks = t["weight"], t["toks"]
        phrase = " ".join(toks)
        for name, n in Counter(toks).items():
            out[f"word:{name}"] += min(n, TERM_CAP) * w
        for x, y in pairwise(toks):
            out[f"bigram:{x} {y}"] += w
        out[f"phrase:{phrase}"] += 2 * w
        padded = f"  {phrase}  "
        for g in grams:
            for name, n in Counter([padded[i : i + g] for i in range(len(padded) - g + 1)]).items():
                out[f"char{g}:{name}"] += min(n, TERM_CAP) * w
    return out


def text_features(texts: DataFrame, grams: tuple[int, ...] = (3, 4)) -> DataFrame:
    """(member, feature, value) of texts (member, value, weight): words, bigrams, the phrase and character n-grams.

    Repeats within one text count up to TERM_CAP; a text with equal weight counts once a
    member, or once for each ``origin`` where texts have that column. Texts are shuffled
    to their member, features are not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), MEMBER_ROWS):
                part = batch.slice(at, MEMBER_ROWS)
                found = [_count_features(t, grams) for t in part.column("texts").to_pylist()]
                rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
                names, values = pa.array([k for f in found for k in f], pa.string()), pa.array([v for f in found for v in f.values()], pa.int64())
                yield pa.record_batch([part.column("member").take(pa.array(rows)), names, values], names=["member", "feature", "value"])

    return _member_texts(texts).mapInArrow(run, "member string, feature string, value long")


def concept_texts(found: DataFrame, labels: DataFrame, weights: dict[str, int], notes: DataFrame | None = None, broader: DataFrame | None = None) -> DataFrame:
    """(member, value, weight, origin): preferred and alternate labels, identifier words, definition, scope notes, parents and children.

    notes (member, value) hold scope notes; broader (a, b) points from child to parent.
    Fields without weight are left out. Each parent and child gives its preferred label
    and, at half the weight but at least 1, its alternate labels.
    """
    if (weights.get("scope") and notes is None) or ((weights.get("parent") or weights.get("child")) and broader is None):
        raise ValueError("a field has a weight but no table")
    shown = display_labels(labels).select(F.col("resource").alias("member"), F.col("label").alias("pref"))
    others = lambda own: labels.filter(english("language")).select(F.col("resource").alias("member"), "value").distinct().join(own.select("member", "pref"), "member").filter("value <> pref").select("member", "value")
    fields = [("preferred", found, F.col("pref")), ("alternate", others(found), F.col("value")), ("identifier", found, identifier_tail("member")), ("definition", found, F.col("definition"))]
    if notes is not None:
        fields.append(("scope", notes.join(found.select("member"), "member", "left_semi"), F.col("value")))
    texts = [d.select("member", c.alias("value"), F.lit(weights[n]).alias("weight"), F.lit(n).alias("origin")) for n, d, c in fields if weights.get(n)]
    for name, near, far in (("parent", "a", "b"), ("child", "b", "a")):
        if weights.get(name):
            ends = broader.select(F.col(near).alias("_m"), F.col(far).alias("member")).distinct().join(found.select(F.col("member").alias("_m")), "_m", "left_semi")
            origin = F.concat(F.lit(f"{name}:"), "member").alias("origin")
            texts.append(ends.join(shown, "member").select(F.col("_m").alias("member"), F.col("pref").alias("value"), F.lit(weights[name]).alias("weight"), origin))
            texts.append(ends.join(others(shown), "member").select(F.col("_m").alias("member"), "value", F.lit(max(1, weights[name] // 2)).alias("weight"), origin))
    return reduce(DataFrame.unionByName, texts).filter("value IS NOT NULL")


def concept_features(found: DataFrame, labels: DataFrame, weights: dict[str, int], grams: tuple[int, ...] = (3, 4), notes: DataFrame | None = None, broader: DataFrame | None = None) -> DataFrame:
    """(member, feature, value) summed over the texts of ``concept_texts``."""
    return text_features(concept_texts(found, labels, weights, notes, broader), grams)


def weighted(s: DataFrame, t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides' features times an integer rarity weight over both: value * max(1, (n + 1) * 1024 div (df + 1))."""
    every = s.unionByName(t)
    n = every.select("member").distinct().count()
    df = every.groupBy("feature").agg(F.count(F.lit(1)).alias("_df"))
    rarity = F.greatest(F.lit(1), F.floor(F.lit((n + 1) * 1024) / (F.col("_df") + 1)))
    return tuple(d.join(df, "feature").select("member", "feature", (F.col("value") * rarity).alias("w")) for d in (s, t))


#: A feature that alone would join more pairs of two blocks than this is multiplied densely.
HOT_PAIRS = 5_000
#: Members of a block, and members whose features are counted at once.
BLOCK_ROWS, MEMBER_ROWS = 2048, 256
#: Blocks of the first side that a task holds while it reads all of the other.
TASK_BLOCKS = 4


def _read(path: str, columns: list[str]) -> pa.Table:
    """Parquet files of the shared folder, read within a task."""
    files, at = pa.fs.FileSystem.from_uri(path if "://" in path else f"/{path.removeprefix('file:').lstrip('/')}")
    found = [f.path for f in files.get_file_info(pa.fs.FileSelector(at, recursive=True, allow_not_found=True)) if f.path.endswith(".parquet")]
    return pa.concat_tables([pq.read_table(f, columns=columns, filesystem=files, partitioning=None) for f in sorted(found)]) if found else None


def _digests(names: list[str]) -> np.ndarray:
    """64-bit digests; that any two of ten million features share one has a chance of about 3 in a million."""
    return pd.util.hash_array(np.array(names, dtype=object), categorize=False).view(np.int64)


@dataclass
class Blocks:
    """Both sides of a comparison as blocks of members in the shared folder: folders and numbers of blocks."""

    spark: SparkSession
    paths: tuple[str, str]
    counts: tuple[int, int]


def feature_blocks(s: DataFrame, t: DataFrame, grams: tuple[int, ...] = (3, 4), block_rows: int = BLOCK_ROWS) -> Blocks:
    """Weighted features of texts (member, value, weight, origin) of two sides, written as blocks of about ``block_rows`` members.

    Only texts are shuffled. Features are counted twice: for how many members have each,
    and, with that at hand, for the blocks. A task holds the digests of features that
    more than one member has (12 bytes each); the others meet nothing and count for the
    norm only. Weights are those of ``weighted``.
    """
    spark = s.sparkSession
    sides = [materialize(_member_texts(d)) for d in (s, t)]
    counts = tuple(max(1, -(-d.count() // block_rows)) for d in sides)
    n = sides[0].select("member").unionByName(sides[1].select("member")).distinct().count()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()
        for batch in batches:
            for at in range(0, len(batch), MEMBER_ROWS):
                for texts in batch.column("texts").slice(at, MEMBER_ROWS).to_pylist():
                    seen.update(_count_features(texts, grams).keys())
                if len(seen) > 1_000_000:
                    yield pa.record_batch([pa.array(_digests(list(seen))), pa.array(list(seen.values()), pa.int64())], names=["h", "n"])
                    seen.clear()
        if seen:
            yield pa.record_batch([pa.array(_digests(list(seen))), pa.array(list(seen.values()), pa.int64())], names=["h", "n"])

    several = sides[0].unionByName(sides[1]).mapInArrow(count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n")).filter("n > 1")
    table = f"{scratch_dir(spark)}/{uuid.uuid4().hex}"
    several.write.parquet(table)

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None
        for batch in batches:
            if known is None:
                read = _read(table, ["h", "n"])
                h, df = (read.column(c).to_numpy() if read else np.zeros(0, np.int64) for c in ("h", "n"))
                order = np.argsort(h)
                known, rarity = h[order], np.maximum(1, (n + 1) * 1024 // (df[order] + 1))
            for at in range(0, len(batch), MEMBER_ROWS):
                part = batch.slice(at, MEMBER_ROWS)
                found = [_count_features(x, grams) for x in part.column("texts").to_pylist()]
                h, value = _digests([k for f in found for k in f]), np.array([v for f in found for v in f.values()], dtype=np.int64)
                rows = np.repeat(np.arange(len(found)), [len(f) for f in found])
                place = np.minimum(np.searchsorted(known, h), max(0, len(known) - 1))
                shared = known[place] == h if len(known) else np.zeros(len(h), dtype=bool)
                w = value * (np.where(shared, rarity[place], max(1, (n + 1) * 1024 // 2)) if len(known) else max(1, (n + 1) * 1024 // 2))
                norm = np.sqrt(np.bincount(rows, weights=w.astype(float) ** 2, minlength=len(found)))
                ends = np.r_[0, np.cumsum(np.bincount(rows[shared], minlength=len(found)))].astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x)) for x in (place[shared].astype(np.int32), w[shared])]
                yield pa.record_batch([part.column("block"), part.column("member"), pa.array(norm), *lists], names=["block", "member", "norm", "features", "weights"])

    paths = []
    for side, blocks in zip(sides, counts, strict=True):
        own = side.withColumn("block", F.pmod(F.xxhash64("member"), F.lit(blocks)).cast("int"))
        paths.append(f"{scratch_dir(spark)}/{uuid.uuid4().hex}")
        held = own.repartition(max(blocks, 6), "block").mapInArrow(weigh, "block int, member string, norm double, features array<int>, weights array<long>")
        held.write.partitionBy("block").parquet(paths[-1])
    return Blocks(spark, tuple(paths), counts)


class _Block:
    """Members of a block with their entries."""

    def __init__(self, path: str, number: int) -> None:
        table = _read(f"{path}/block={number}", ["member", "norm", "features", "weights"])
        self.size = len(table) if table else 0
        if self.size:
            self.member, self.norm = table.column("member").combine_chunks(), table.column("norm").to_numpy()
            lists = table.column("features").combine_chunks()
            sizes = np.diff(lists.offsets.to_numpy())
            self.rows, self.codes = np.repeat(np.arange(self.size), sizes), lists.flatten().to_numpy()
            self.weights = table.column("weights").combine_chunks().flatten().to_numpy().astype(float)


def _products(a: _Block, b: _Block, ones: bool = False) -> np.ndarray:
    """Dot products of two blocks' members; with ``ones``, how many features they share. Common features as dense blocks, rare ones along their members."""
    kind = np.float32 if ones else np.float64
    wa, wb = (np.ones(len(x.codes)) if ones else x.weights for x in (a, b))
    codes = np.unique(np.r_[a.codes, b.codes])
    ca, cb, size = np.searchsorted(codes, a.codes), np.searchsorted(codes, b.codes), len(codes)
    xa, xb = np.bincount(ca, minlength=size), np.bincount(cb, minlength=size)
    dots = np.zeros((a.size, b.size), dtype=kind)
    hot = np.flatnonzero(xa * xb > HOT_PAIRS)
    for at in range(0, len(hot), 2048):
        here = hot[at : at + 2048]
        place = np.full(size, -1)
        place[here] = np.arange(len(here))
        dense = []
        for x, code, w in ((a, ca, wa), (b, cb, wb)):
            out = np.zeros((x.size, len(here)), dtype=kind)
            own = place[code] >= 0
            out[x.rows[own], place[code[own]]] = w[own]
            dense.append(out)
        dots += dense[0] @ dense[1].T
    # the entries of rare features, pair by pair
    oa, ob = np.argsort(ca, kind="stable"), np.argsort(cb, kind="stable")
    sa, sb = np.r_[0, np.cumsum(xa)], np.r_[0, np.cumsum(xb)]
    rare = np.flatnonzero((xa > 0) & (xb > 0) & (xa * xb <= HOT_PAIRS))
    ends = np.cumsum(xa[rare] * xb[rare])
    at = 0
    while at < len(rare):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + 1_000_000)))
        f = rare[at:upto]
        n = xa[f] * xb[f]
        own = np.repeat(f, n)
        step = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n)
        i, j = oa[sa[own] + step // xb[own]], ob[sb[own] + step % xb[own]]
        cells = a.rows[i] * b.size + b.rows[j]
        first, back = np.unique(cells, return_inverse=True)
        dots.reshape(-1)[first] += np.bincount(back, weights=wa[i] * wb[j]).astype(kind)
        at = upto
    return dots


def _tasks(blocks: Blocks, step: int) -> DataFrame:
    """One row and task per ``step`` blocks of the first side."""
    parts = -(-blocks.counts[0] // step)
    return blocks.spark.range(0, parts, 1, parts).select(F.col("id").alias("part"))


def block_pairs(blocks: Blocks, ones: bool = False) -> DataFrame:
    """(source, target, score): cosines of all pairs with a common feature, rounded to 9 places; with ``ones`` (source, target, n), how many features they share.

    Pairs are neither shuffled nor written before they are returned.
    """
    paths, (_, many) = blocks.paths, blocks.counts

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for number in (n for batch in batches for n in batch.column("part").to_pylist()):
            a = _Block(paths[0], number)
            for b in (_Block(paths[1], y) for y in range(many)) if a.size else ():
                if not b.size:
                    continue
                dots = _products(a, b, ones)
                for at in range(0, a.size, 32):
                    i, j = np.nonzero(dots[at : at + 32] > 0)
                    x = dots[at : at + 32][i, j]
                    x = pa.array(np.rint(x).astype(np.int64)) if ones else pa.array(x / (a.norm[at + i] * b.norm[j]))
                    yield pa.record_batch([a.member.take(pa.array(at + i)), b.member.take(pa.array(j)), x], names=["source", "target", "x"])

    out = _tasks(blocks, 1).mapInArrow(run, f"source string, target string, x {'long' if ones else 'double'}")
    return out.select("source", "target", F.col("x").alias("n") if ones else F.round("x", 9).alias("score"))


class _Best:
    """The k best scores of each member of a block so far, and the pairs that reached them, ties included."""

    def __init__(self, size: int, k: int) -> None:
        self.top, self.k, self.kept = np.full((size, k), -1.0), k, []

    def take(self, score: np.ndarray, other: pa.Array, dots: np.ndarray, norms: np.ndarray) -> None:
        """Scores of the members (rows) with a block of others (columns)."""
        k = min(self.k, score.shape[1])
        best = np.partition(score, -k, axis=1)[:, -k:]
        self.top = np.partition(np.c_[self.top, best], -self.k, axis=1)[:, -self.k :]
        i, j = np.nonzero((score >= self.least()[:, None]) & (score > 0))
        self.kept.append((i, other.take(pa.array(j)), score[i, j], dots[i, j], norms[j]))

    def least(self) -> np.ndarray:
        return self.top.min(axis=1) - 2e-9  # scores are rounded to nine places later

    def rows(self) -> Iterator[tuple]:
        least = self.least()
        for i, other, score, dots, norms in self.kept:
            own = np.flatnonzero(score >= least[i])
            yield i[own], other.take(pa.array(own)), dots[own], norms[own]


def block_best(blocks: Blocks, k: int) -> DataFrame:
    """(source, target, score, forth, back): pairs that may be among the ``k`` best of their source (forth) or target (back).

    A task holds TASK_BLOCKS blocks of the first side and reads all blocks of the other;
    of each row and each of its columns the best are kept, ties included. Only these are
    written. The ranks' ties are left to ``best_of``.
    """
    paths, (few, many) = blocks.paths, blocks.counts
    names = ["source", "target", "dot", "na", "nb", "forth"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (n for batch in batches for n in batch.column("part").to_pylist()):
            held = [b for b in (_Block(paths[0], x) for x in range(part * TASK_BLOCKS, min(few, (part + 1) * TASK_BLOCKS))) if b.size]
            forth = [_Best(a.size, k) for a in held]
            for y in range(many):
                b = _Block(paths[1], y)
                if not b.size:
                    continue
                back = _Best(b.size, k)
                for a, best in zip(held, forth, strict=True):
                    dots = _products(a, b)
                    score = np.where(dots > 0, dots / np.maximum(np.outer(a.norm, b.norm), 1e-300), -1.0)
                    best.take(score, b.member, dots, b.norm)
                    back.take(score.T, a.member, dots.T, a.norm)
                for i, other, dots, norms in back.rows():
                    yield pa.record_batch([other, b.member.take(pa.array(i)), pa.array(dots), pa.array(norms), pa.array(b.norm[i]), pa.array(np.zeros(len(i), dtype=bool))], names=names)
            for a, best in zip(held, forth, strict=True):
                for i, other, dots, norms in best.rows():
                    yield pa.record_batch([a.member.take(pa.array(i)), other, pa.array(dots), pa.array(a.norm[i]), pa.array(norms), pa.array(np.ones(len(i), dtype=bool))], names=names)

    kept = _tasks(blocks, TASK_BLOCKS).mapInArrow(run, "source string, target string, dot double, na double, nb double, forth boolean")
    return kept.select("source", "target", F.round(F.col("dot") / (F.col("na") * F.col("nb")), 9).alias("score"), "forth", (~F.col("forth")).alias("back"))


def best_of(best: DataFrame, k: int) -> DataFrame:
    """(source, target, source_rank, target_rank) out of ``block_best``, as ``bidirectional`` ranks all scores."""
    best = materialize(best)
    forth = top_k(best.filter("forth"), k).select("source", "target", F.col("rank").alias("source_rank"))
    back = top_k(best.filter("back"), k, "target", "source").select("source", "target", F.col("rank").alias("target_rank"))
    return forth.join(back, ["source", "target"], "full")


def top_k(scores: DataFrame, k: int, by: str = "source", other: str = "target", positive: bool = True) -> DataFrame:
    """Scores with rank: the k best per ``by``, ties to the smaller other end; zero and negative scores take no rank."""
    kept = scores.filter("score > 0") if positive else scores
    rank = F.row_number().over(Window.partitionBy(by).orderBy(F.desc("score"), other))
    return kept.withColumn("rank", rank).filter(F.col("rank") <= k)


def bidirectional(scores: DataFrame, k: int) -> DataFrame:
    """(source, target, source_rank, target_rank): pairs among the k best of either side."""
    forth = top_k(scores, k).select("source", "target", F.col("rank").alias("source_rank"))
    back = top_k(scores, k, "target", "source").select("source", "target", F.col("rank").alias("target_rank"))
    return forth.join(back, ["source", "target"], "full")


def mutual_best(ranks: DataFrame) -> DataFrame:
    return ranks.filter("source_rank = 1 AND target_rank = 1").select("source", "target")


def best_ranks(scores: DataFrame, k: int) -> DataFrame:
    """(a, b, rank): the better of both directions per unordered pair, self excluded."""
    pairs = scores.filter("source <> target")
    r = bidirectional(pairs, k)
    return r.select(F.least("source", "target").alias("a"), F.greatest("source", "target").alias("b"), F.least("source_rank", "target_rank").alias("rank")).groupBy("a", "b").agg(F.min("rank").alias("rank"))


def merge_arms(ranks: DataFrame) -> DataFrame:
    """(source, target, rank): the least rank of any arm."""
    return ranks.groupBy("source", "target").agg(F.min("rank").alias("rank"))


def reservoir(pairs: DataFrame, cap: int) -> DataFrame:
    """Each node's neighbours from all arms, both ways, the first ``cap`` in order."""
    both = pairs.select(F.col("source").alias("node"), F.col("target").alias("other")).unionByName(pairs.select(F.col("target").alias("node"), F.col("source").alias("other"))).filter("node <> other").distinct()
    return both.withColumn("_n", F.row_number().over(Window.partitionBy("node").orderBy("other"))).filter(F.col("_n") <= cap).drop("_n")


def rerank(pairs: DataFrame, scores: DataFrame) -> DataFrame:
    """(node, other, rank): a reservoir ranked by another score, ties by id; pairs without score are left out."""
    both = pairs.join(scores.select(F.col("source").alias("node"), F.col("target").alias("other"), "score"), ["node", "other"])
    return both.select("node", "other", F.row_number().over(Window.partitionBy("node").orderBy(F.desc("score"), "other")).alias("rank"))


def exact_identifiers(s: DataFrame, t: DataFrame) -> DataFrame:
    """(source, target, identifier): equal identifiers (member, identifier), the smallest per pair."""
    both = s.select(F.col("member").alias("source"), "identifier").join(t.select(F.col("member").alias("target"), "identifier"), "identifier")
    return both.groupBy("source", "target").agg(F.min("identifier").alias("identifier"))


def graph_neighbours(anchors: DataFrame, s_up: DataFrame, t_up: DataFrame) -> DataFrame:
    """(source, target, anchor_source, anchor_target, path): pairs one hierarchy step from an anchor on either or both sides; least evidence wins.

    s_up and t_up (a, b) point from child to parent within one side.
    """
    a = anchors.select(F.col("source").alias("anchor_source"), F.col("target").alias("anchor_target")).distinct()
    sp, tp = s_up.select(F.col("a").alias("anchor_source"), F.col("b").alias("_s")).distinct(), t_up.select(F.col("a").alias("anchor_target"), F.col("b").alias("_t")).distinct()
    sc, tc = s_up.select(F.col("b").alias("anchor_source"), F.col("a").alias("_s")).distinct(), t_up.select(F.col("b").alias("anchor_target"), F.col("a").alias("_t")).distinct()
    own_s, own_t = F.col("anchor_source").alias("source"), F.col("anchor_target").alias("target")
    s, t = F.col("_s").alias("source"), F.col("_t").alias("target")
    base = [F.col("anchor_source"), F.col("anchor_target")]
    paths = [
        (a.join(sp, "anchor_source"), s, own_t, "sourceParent-to-target"),
        (a.join(sp, "anchor_source").join(tp, "anchor_target"), s, t, "sourceParent-to-targetParent"),
        (a.join(sc, "anchor_source"), s, own_t, "sourceChild-to-target"),
        (a.join(sc, "anchor_source").join(tc, "anchor_target"), s, t, "sourceChild-to-targetChild"),
        (a.join(tp, "anchor_target"), own_s, t, "source-to-targetParent"),
        (a.join(tc, "anchor_target"), own_s, t, "source-to-targetChild"),
    ]
    every = reduce(DataFrame.unionByName, [d.select(x, y, *base, F.lit(p).alias("path")) for d, x, y, p in paths])
    every = every.filter(~((F.col("source") == F.col("anchor_source")) & (F.col("target") == F.col("anchor_target"))))
    best = every.groupBy("source", "target").agg(F.min(F.struct("anchor_source", "anchor_target", "path")).alias("m"))
    return best.select("source", "target", "m.anchor_source", "m.anchor_target", "m.path")


def dense_scores(s: DataFrame, t: DataFrame, block_rows: int = 4096):
    """(source, target, score) of vectors (member, vector): cosines of all queries against all rows, in blocks.

    ``s`` is a stated query set. Its blocks are broadcast one at a time and multiplied
    against partitions of ``t`` in numpy; memory is bounded by a block, whatever the sizes.
    """
    import numpy as np
    import pandas as pd

    n = s.count()
    parts = max(1, -(-n // block_rows))
    out = []
    for i in range(parts):
        rows = s.filter(F.pmod(F.xxhash64("member"), F.lit(parts)) == i).select("member", "vector").collect()  # one block of queries
        if not rows:
            continue
        ids = np.array([r["member"] for r in rows])
        q = np.array([r["vector"] for r in rows], dtype=float)
        q /= np.maximum(np.linalg.norm(q, axis=1, keepdims=True), 1e-12)

        def score(batches, ids=ids, q=q):
            for pdf in batches:
                if not len(pdf):
                    continue
                x = np.array(pdf["vector"].tolist(), dtype=float)
                x /= np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)
                sims = q @ x.T
                yield pd.DataFrame({"source": np.repeat(ids, len(pdf)), "target": np.tile(pdf["member"].to_numpy(), len(ids)), "score": np.round(sims.ravel(), 9)})

        kind = dict(s.dtypes)["member"]
        out.append(t.select("member", "vector").mapInPandas(score, f"source {kind}, target {kind}, score double"))
    return reduce(DataFrame.unionByName, out)


def max_over_labels(scores: DataFrame) -> DataFrame:
    """(source, target, score): the best score of any label of either concept."""
    return scores.groupBy("source", "target").agg(F.max("score").alias("score"))


def seeded_sample(df: DataFrame, key: str, n: int, seed: str) -> DataFrame:
    """n rows of a sorted population, drawn with a seeded generator on positions; the same for any row order."""
    import random

    total = df.count()
    if n >= total:
        return df
    chosen = sorted(random.Random(f"{seed}").sample(range(total), max(n, 0)))
    spark = df.sparkSession
    at = spark.createDataFrame([(i,) for i in chosen], "_at long")
    from lexmesh.operators.ranks import with_rank

    return with_rank(df, [key], "_at").join(F.broadcast(at), "_at").drop("_at")
