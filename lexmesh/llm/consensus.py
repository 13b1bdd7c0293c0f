"""Consensus from several annotators' labels (problem 2).

Messages travel on label edges between items and annotators, once for every class
against the rest. An item tells each of its annotators how far the class holds for
it, judged by the other annotators only; an annotator answers each item with how
much likelier its verdict is where the class holds, judged by its other items only.
They are repeated until they stand still; the six classes meet only at the end.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmesh.operators.skewjoin import join_unique
from lexmesh.storage import discard, materialize

#: The relations an item can have.
RELATIONS = ("same", "near_same", "target_is_broader", "target_is_narrower", "related", "unrelated")
#: The levels of confidence, surest first.
LEVELS = ("high", "medium", "low")
#: Answer tables of up to so many annotators are held in every task (about 4 MB a thousand).
TABLE_ANNOTATORS = 3_000
#: Rounds of full steps, then of half steps; after these each step is a tenth shorter than the last, so messages that swing come to rest.
FULL_ROUNDS, HALF_ROUNDS = 8, 12

_K = len(RELATIONS)
_LEVELS = len(LEVELS) + 1
#: A verdict as seen here: the relation it names or none, and its confidence.
_ANSWERS = (_K + 1) * _LEVELS


def relation_code(best_relation: Column) -> Column:
    """0..5 for a relation in any case and word separation, 6 for none of them."""
    bare = F.lower(F.regexp_replace(best_relation, r"[^A-Za-z]", ""))
    code = F.lit(_K)
    for i, name in enumerate(RELATIONS):
        code = F.when(bare == name.replace("_", ""), i).otherwise(code)
    return code


def verdict_code(exists: Column, best_relation: Column, confidence: Column) -> Column:
    """One integer below 84 for all that a verdict says: relation, existence, confidence."""
    held = F.when(exists.isNull(), 2).otherwise(exists.cast("int"))
    level = F.lit(len(LEVELS))
    for i, name in enumerate(LEVELS):
        level = F.when(F.lower(F.trim(confidence)) == name, i).otherwise(level)
    return (relation_code(best_relation) * 3 + held) * 4 + level


def vote_of(code: Column) -> Column:
    """The relation a verdict names: its own, unrelated where it only denies one, else -1."""
    relation, held = F.floor(code / 12), F.floor(code / 4) % 3
    return F.when(relation < _K, relation).when(held == 0, _K - 1).otherwise(-1)


def latest_verdicts(verdicts: DataFrame) -> DataFrame:
    """(item, annotator, code), each annotator's latest verdict of an item.

    At equal times the greatest code counts. Time and code share one long, so repeats
    are reduced before the shuffle with buffers of fixed width. A null row_id is no
    item; verdicts without reviewer belong to one nameless annotator.
    """
    code = verdict_code(F.col("relation_exists"), F.col("best_relation"), F.col("confidence"))
    at = F.coalesce(F.unix_micros(F.col("judged_at").cast("timestamp")), F.lit(-(2**55)))
    both = verdicts.filter("row_id IS NOT NULL").select(F.col("row_id").alias("item"), F.coalesce(F.trim("reviewer"), F.lit("")).alias("annotator"), (at * 128 + code).alias("_v"))
    return both.groupBy("item", "annotator").agg(F.pmod(F.max("_v"), F.lit(128)).cast("int").alias("code"))


def answer_of(code: Column) -> Column:
    """The verdict as an answer: (relation named + 1, 0 for none) * levels + level of confidence."""
    return ((vote_of(code) + 1) * _LEVELS + code % _LEVELS).cast("int")


def _groups() -> np.ndarray:
    """For class and answer: what the answer is to "does the class hold?" - yes, no or nothing, by level."""
    vote, level = np.divmod(np.arange(_ANSWERS), _LEVELS)
    kind = np.where(vote[None, :] == np.arange(1, _K + 1)[:, None], 0, np.where(vote[None, :] > 0, 1, 2))
    return kind * _LEVELS + level[None, :]


def likelihoods(mass: np.ndarray, strength: float) -> tuple[np.ndarray, np.ndarray]:
    """Counts behind P(answer) for annotators: from mass (annotators, answers, classes) to numerators of that shape and denominators (annotators, classes).

    Answers of one kind count together; every annotator is drawn to all annotators' by
    ``strength`` verdicts.
    """
    group = _groups()
    num = np.empty_like(mass)
    for k in range(_K):
        held = np.zeros((len(mass), group.max() + 1))
        np.add.at(held.T, group[k], mass[:, :, k].T)
        shared = held.sum(0) + 0.01
        num[:, :, k] = (held + strength * shared / shared.sum())[:, group[k]]
    return num, mass.sum(1) + strength


def messages(hold: np.ndarray, yes: tuple[np.ndarray, ...], no: tuple[np.ndarray, ...]) -> np.ndarray:
    """Log-odds that an annotator's answer lends each class, without the item's own part ``hold`` in its counts."""
    floor = 1e-9
    rest = 1 - hold
    return np.log(np.maximum(yes[0] - hold, floor) / np.maximum(yes[1] - hold, floor)) - np.log(np.maximum(no[0] - rest, floor) / np.maximum(no[1] - rest, floor))


def _step(turn: int) -> float:
    return 1.0 if turn < FULL_ROUNDS else 0.5 * 0.9 ** max(0, turn - FULL_ROUNDS - HALF_ROUNDS)


def _prior(share: list[float]) -> np.ndarray:
    at = np.clip(np.asarray(share, dtype=float), 1e-9, 1 - 1e-9)
    return np.log(at / (1 - at))


def _hold(score: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(score, -40, 40)))


def _gather(stats: DataFrame, annotators: int) -> np.ndarray:
    """(annotators, answers, 1 + classes): verdicts and beliefs; at most TABLE_ANNOTATORS * answers rows."""
    out = np.zeros((annotators, _ANSWERS, 1 + _K))
    for r in stats.collect():
        out[r["annotator"], r["answer"]] = r[2:]
    return out


def _sums(df: DataFrame) -> DataFrame:
    return df.groupBy("annotator", "answer").agg(F.sum("n").alias("n"), *[F.sum(f"b{k}").alias(f"b{k}") for k in range(_K)])


_STATS = "annotator int, answer int, n double, " + ", ".join(f"b{k} double" for k in range(_K))
_ITEM = "item long, annotators array<int>, answers array<int>, beliefs array<double>, moved double"


def _unpack(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Sizes of the batch's items, and their edges' annotators, answers and beliefs."""
    who, said, held = (batch.column(c).flatten().to_numpy() for c in ("annotators", "answers", "beliefs"))
    return np.diff(batch.column("annotators").offsets.to_numpy()), who, said, held.reshape(-1, _K)


def _pack(ids, batch, sizes, beliefs, moved) -> pa.RecordBatch:
    ends = np.r_[0, np.cumsum(sizes)]
    lists = lambda values, width, kind: pa.ListArray.from_arrays(pa.array(ends * width, pa.int32()), pa.array(values, kind))
    _, who, said, _ = _unpack(batch)
    return pa.record_batch([ids, lists(who, 1, pa.int32()), lists(said, 1, pa.int32()), lists(beliefs.ravel(), _K, pa.float64()), pa.array(moved, pa.float64())], names=["item", "annotators", "answers", "beliefs", "moved"])


def _votes(said: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """How many of each item's verdicts name each relation."""
    vote = np.zeros((len(said), _K), dtype=np.int32)
    named = said // _LEVELS - 1
    vote[np.flatnonzero(named >= 0), named[named >= 0]] = 1
    return np.add.reduceat(vote, np.r_[0, np.cumsum(sizes)[:-1]]) if len(said) else np.zeros((len(sizes), _K), dtype=np.int32)


def _item_stats(state: DataFrame, annotators: int) -> DataFrame:
    """Verdicts and beliefs by annotator and answer; reduced within each task before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((annotators * _ANSWERS, 1 + _K))
        for batch in batches:
            _, who, said, held = _unpack(batch)
            at = who * _ANSWERS + said
            total[:, 0] += np.bincount(at, minlength=len(total))
            for k in range(_K):
                total[:, 1 + k] += np.bincount(at, weights=held[:, k], minlength=len(total))
        seen = np.flatnonzero(total[:, 0])
        a, c = np.divmod(seen, _ANSWERS)
        yield pa.record_batch([pa.array(a, pa.int32()), pa.array(c, pa.int32()), *[pa.array(total[seen, j]) for j in range(1 + _K)]], names=["annotator", "answer", "n", *[f"b{k}" for k in range(_K)]])

    return _sums(state.select("annotators", "answers", "beliefs").mapInArrow(run, _STATS))


def _table_rounds(edges: DataFrame, names: DataFrame, annotators: int, strength: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """Items' scores and annotators' sums where the answer table fits a task.

    The edges are shuffled by item once; a row holds an item with its edges, at most
    one per annotator, and rounds go over the rows where they lie.
    """
    coded = edges.join(F.broadcast(names), "name").groupBy("item").agg(F.array_sort(F.collect_list(F.struct("annotator", "answer"))).alias("e"))
    lists = coded.select("item", F.col("e.annotator").alias("annotators"), F.col("e.answer").alias("answers"), F.array().cast("array<double>").alias("beliefs"))

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, _, said, _ = _unpack(batch)
            votes = _votes(said, sizes) + 0.1
            shares = votes / votes.sum(1, keepdims=True)
            yield _pack(batch.column("item"), batch, sizes, np.repeat(shares, sizes, 0), np.zeros(len(sizes)))

    state = materialize(lists.mapInArrow(begin, _ITEM))
    for turn in count():
        mass = _gather(_item_stats(state, annotators), annotators)
        step = _step(turn)
        share = mass[:, :, 1:].sum((0, 1)) / max(mass[:, :, 0].sum(), 1)
        tables = *likelihoods(mass[:, :, 1:], strength), *likelihoods(mass[:, :, :1] - mass[:, :, 1:], strength)
        told = _told(tables, share)

        def run(batches: Iterator[pa.RecordBatch], told=told, step=step) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes, _, _, held = _unpack(batch)
                sent, score = told(batch)
                fresh = _hold(np.repeat(score, sizes, 0) - sent)
                moved = np.add.reduceat(np.abs(fresh - held).max(1), np.r_[0, np.cumsum(sizes)[:-1]]) if len(held) else np.zeros(len(sizes))
                yield _pack(batch.column("item"), batch, sizes, held + step * (fresh - held), moved)

        fresh = materialize(state.mapInArrow(run, _ITEM))
        change = (fresh.agg(F.sum("moved")).first()[0] or 0.0) / max(mass[:, :, 0].sum(), 1)
        discard(state)
        state = fresh
        if change * step < tolerance:
            break
    stats = materialize(_item_stats(state, annotators))
    mass = _gather(stats, annotators)
    share = mass[:, :, 1:].sum((0, 1)) / max(mass[:, :, 0].sum(), 1)
    told = _told((*likelihoods(mass[:, :, 1:], strength), *likelihoods(mass[:, :, :1] - mass[:, :, 1:], strength)), share)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, _, said, _ = _unpack(batch)
            votes = _votes(said, sizes)
            _, score = told(batch)
            yield pa.record_batch([batch.column("item"), *[pa.array(score[:, k]) for k in range(_K)], *[pa.array(votes[:, k], pa.int32()) for k in range(_K)], pa.array(sizes.astype(np.int64))], names=_SCORED)

    return state.mapInArrow(finish, _SCORED_TYPES), stats.join(F.broadcast(names), "annotator").drop("annotator")


_SCORED = ["item", *[f"s{k}" for k in range(_K)], *[f"v{k}" for k in range(_K)], "reviewers"]
_SCORED_TYPES = "item long, " + ", ".join(f"s{k} double" for k in range(_K)) + ", " + ", ".join(f"v{k} int" for k in range(_K)) + ", reviewers long"


def _told(tables: tuple[np.ndarray, ...], share: np.ndarray):
    """From a batch of items: what each edge's annotator says, and the items' scores."""
    num_yes, den_yes, num_no, den_no = tables
    prior = _prior(share)

    def run(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        sizes, who, said, held = _unpack(batch)
        sent = messages(held, (num_yes[who, said], den_yes[who]), (num_no[who, said], den_no[who]))
        score = np.add.reduceat(sent, np.r_[0, np.cumsum(sizes)[:-1]]) if len(sent) else np.zeros((len(sizes), _K))
        return sent, score + prior

    return run


def _join_rounds(edges: DataFrame, strength: float, tolerance: float) -> tuple[DataFrame, DataFrame]:
    """The same for more annotators than a task holds: edges meet answers and item sums by joins that survive hot keys."""
    group = [F.array(*[F.lit(int(x)) for x in row]) for row in _groups()]
    at = lambda k: F.get(group[k], F.col("answer"))
    vote = F.floor(F.col("answer") / _LEVELS) - 1
    edges = materialize(edges)
    votes = edges.groupBy("item").agg(*[(F.count_if(vote == k) + 0.1).alias(f"v{k}") for k in range(_K)])
    whole = sum([F.col(f"v{k}") for k in range(1, _K)], F.col("v0"))
    state = materialize(join_unique(edges, votes, "item").select("item", "name", "answer", *[(F.col(f"v{k}") / whole).alias(f"b{k}") for k in range(_K)]))

    def heard(state: DataFrame) -> tuple[DataFrame, np.ndarray]:
        first = state.agg(F.count(F.lit(1)), *[F.avg(f"b{k}") for k in range(_K)]).first()
        out = state.withColumn("_i", F.concat_ws("\x1f", "name", F.col("answer").cast("string")))
        for k in range(_K):
            cell = materialize(state.groupBy("name", at(k).alias("g")).agg(F.sum(f"b{k}").alias("yes"), F.sum(1 - F.col(f"b{k}")).alias("no")))
            shared = {r["g"]: (r["yes"], r["no"]) for r in cell.groupBy("g").agg(F.sum("yes").alias("yes"), F.sum("no").alias("no")).collect()}  # a row per kind of answer
            total = [sum(v[j] for v in shared.values()) + 0.01 * (int(_groups().max()) + 1) for j in (0, 1)]
            drawn = [F.coalesce(*[F.when(F.col("g") == g, strength * (v[j] + 0.01) / total[j]) for g, v in shared.items()]) for j in (0, 1)] if shared else [F.lit(0.0)] * 2
            sums = cell.groupBy("name").agg(F.sum("yes").alias("_ty"), F.sum("no").alias("_tn"))
            table = cell.join(sums, "name").select(F.concat_ws("\x1f", "name", F.col("g").cast("string")).alias("_g"), *[F.struct((F.col(c) + d).alias("num"), (F.col(t) + strength).alias("den")).alias(f"{c}{k}") for c, d, t in (("yes", drawn[0], "_ty"), ("no", drawn[1], "_tn"))])
            out = join_unique(materialize(out.withColumn("_g", F.concat_ws("\x1f", "name", at(k).cast("string")))), materialize(table), "_g").drop("_g")
        floor = F.lit(1e-9)
        part = lambda c, own: F.log(F.greatest(F.col(c)["num"] - own, floor) / F.greatest(F.col(c)["den"] - own, floor))
        return materialize(out.select("item", "name", "answer", *[f"b{k}" for k in range(_K)], *[(part(f"yes{k}", F.col(f"b{k}")) - part(f"no{k}", 1 - F.col(f"b{k}"))).alias(f"m{k}") for k in range(_K)])), _prior([x or 0.5 for x in first[1:]])

    def scored(told: DataFrame, prior: np.ndarray) -> DataFrame:
        return told.groupBy("item").agg(*[(F.sum(f"m{k}") + float(prior[k])).alias(f"s{k}") for k in range(_K)], *[F.count_if(vote == k).cast("int").alias(f"v{k}") for k in range(_K)], F.count(F.lit(1)).alias("reviewers"))

    for turn in count():
        told, prior = heard(state)
        step = _step(turn)
        both = join_unique(told, materialize(scored(told, prior).select("item", *[f"s{k}" for k in range(_K)])), "item")
        fresh = [1 / (1 + F.exp(-F.least(F.greatest(F.col(f"s{k}") - F.col(f"m{k}"), F.lit(-40.0)), F.lit(40.0)))) for k in range(_K)]
        moved = F.greatest(*[F.abs(f - F.col(f"b{k}")) for k, f in enumerate(fresh)])
        nxt = materialize(both.select("item", "name", "answer", *[(F.col(f"b{k}") + step * (f - F.col(f"b{k}"))).alias(f"b{k}") for k, f in enumerate(fresh)], moved.alias("moved")))
        change = nxt.agg(F.avg("moved")).first()[0] or 0.0
        discard(state)
        state = nxt.drop("moved")
        if change * step < tolerance:
            break
    told, prior = heard(state)
    stats = told.groupBy("name", "answer").agg(F.count(F.lit(1)).cast("double").alias("n"), *[F.sum(f"b{k}").alias(f"b{k}") for k in range(_K)])
    return scored(told, prior), stats


def consensus(verdicts: DataFrame, strength: float = 20.0, tolerance: float = 1e-3, table_annotators: int = TABLE_ANNOTATORS) -> tuple[DataFrame, DataFrame]:
    """Items (row_id, best_relation, posterior, agreement, reviewers) and annotators (reviewer, verdicts, reliability).

    best_relation is the relation with the greatest log-odds against the rest, ties
    going to the earlier of RELATIONS; posterior its share of the six probabilities;
    agreement the share of the item's verdicts naming a relation that name this one
    (null where none does). reliability is the mean probability, judged without the
    annotator's own verdict, that the relation it named holds; null where it named
    none. Messages are repeated until they move by less than ``tolerance`` on average.
    Both ways of passing them, by number of annotators, give the same result.
    """
    edges = materialize(latest_verdicts(verdicts).select("item", F.col("annotator").alias("name"), answer_of(F.col("code")).alias("answer")))
    names = edges.select("name").distinct()
    few = [r["name"] for r in names.limit(table_annotators + 1).collect()]
    if len(few) <= table_annotators:
        spark = verdicts.sparkSession
        numbered = spark.createDataFrame([(x, i) for i, x in enumerate(sorted(few))], "name string, annotator int")
        sums, stats = _table_rounds(edges, numbered, len(few), strength, tolerance)
    else:
        sums, stats = _join_rounds(edges, strength, tolerance)
    hold = [1 / (1 + F.exp(-F.col(f"s{k}"))) for k in range(_K)]
    whole = sum(hold[1:], hold[0])
    sums = sums.select("*", F.greatest(*[F.col(f"s{k}") for k in range(_K)]).alias("_top"), whole.alias("_whole"))
    named, own, voted = F.lit(None).cast("string"), F.lit(None).cast("int"), F.lit(0)
    for k in reversed(range(_K)):
        named = F.when(F.col(f"s{k}") == F.col("_top"), RELATIONS[k]).otherwise(named)
        own = F.when(F.col(f"s{k}") == F.col("_top"), F.col(f"v{k}")).otherwise(own)
        voted = voted + F.col(f"v{k}")
    items = sums.select(F.col("item").alias("row_id"), named.alias("best_relation"), (1 / (1 + F.exp(-F.col("_top"))) / F.col("_whole")).alias("posterior"), F.when(voted > 0, own / voted).alias("agreement"), "reviewers")
    relation = F.floor(F.col("answer") / _LEVELS) - 1
    right = F.coalesce(*[F.when(relation == k, F.col(f"b{k}")) for k in range(_K)])
    annotators = stats.groupBy(F.col("name").alias("reviewer")).agg(F.sum("n").cast("long").alias("verdicts"), (F.sum(right) / F.sum(F.when(relation >= 0, F.col("n")))).alias("reliability"))
    return items, annotators
