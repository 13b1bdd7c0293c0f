"""Mixing sources to target weights (problem 9).

Sainte-Lague apportionment gives every source a whole number of equal shares of a
mix, and again every shard of a source its part of them. Documents lie in blocks of
about equal tokens; within a shard, blocks are taken in a seeded order. A quota
beyond the shard's tokens repeats the shard.
"""

from __future__ import annotations

import heapq
import math

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.llm.tokens import VOCABULARY, sized
from lexmesh.storage import materialize

#: Shares a mix is divided into for apportionment.
BLOCKS = 20_000
#: A source has a shard per so many tokens and a shard a block per so many, but at most PARTS of either:
#: beyond that shards and blocks grow, so that the driver plans for PARTS shards a source and a task orders PARTS blocks.
SHARD_TOKENS, BLOCK_TOKENS, PARTS = 2_000_000, 20_000, 1024
#: Share of a shard's quota that may stay unused where documents are taken in seeded order.
LEFT_OVER = 0.01


def sainte_lague(weights: dict[str, float], seats: int, caps: dict[str, int] | None = None) -> dict[str, int]:
    """Whole numbers by highest quotient weight / (2 n + 1), none above its cap; ties go to the smaller name.

    Starts from a safe lower bound and gives the remaining seats one by one, so the
    time does not depend on the number of seats. Fewer seats are given if all caps
    are reached.
    """
    live = {k: w for k, w in weights.items() if w and w > 0}
    caps = {k: (caps or {}).get(k, seats) for k in live}
    total = sum(live.values())
    given = {k: max(0, min(caps[k], math.floor(seats * w / total - len(live)))) for k, w in live.items()}
    left = seats - sum(given.values())
    heap = [(-w / (2 * given[k] + 1), k) for k, w in live.items() if given[k] < caps[k]]
    heapq.heapify(heap)
    while left > 0 and heap:
        if len(heap) == 1:
            k = heap[0][1]
            given[k] += min(left, caps[k] - given[k])
            break
        _, k = heapq.heappop(heap)
        given[k] += 1
        left -= 1
        if given[k] < caps[k]:
            heapq.heappush(heap, (-live[k] / (2 * given[k] + 1), k))
    return {k: given.get(k, 0) for k in weights}


def feasible_total(weights: dict[str, float], caps: dict[str, int]) -> int:
    """The most tokens at which every present source can fill its share within its cap."""
    present = {k: w for k, w in weights.items() if w and w > 0 and caps.get(k, 0) > 0}
    whole = sum(present.values())
    return int(min((caps[k] * whole / w for k, w in present.items()), default=0))


def plan_mix(targets: list[tuple[str, float, int]], shards: dict[str, dict[int, int]], total: int | None, blocks: int) -> tuple[dict[tuple[str, int], float], int]:
    """Quotas in tokens for each (source, shard), and the size of a block."""
    tokens = {s: sum(shards.get(s, {}).values()) for s, _, _ in targets}
    weights = {s: w for s, w, _ in targets if tokens[s] > 0}
    caps = {s: tokens[s] * r for s, _, r in targets}
    total = feasible_total(weights, caps) if total is None else total
    block = max(1, total // blocks)
    seats = total // block
    per_source = sainte_lague(weights, seats, {s: -(-caps[s] // block) for s in weights})
    quotas = {}
    for s, n in per_source.items():
        names = {f"{i:06d}": i for i in shards[s]}
        for name, m in sainte_lague({k: float(shards[s][i]) for k, i in names.items()}, n).items():
            quotas[s, names[name]] = float(m * block)
    return quotas, block


def mix_sources(documents: DataFrame, targets: DataFrame, total_tokens: int | None = None, blocks: int = BLOCKS, seed: int = 11, path: str = VOCABULARY) -> tuple[DataFrame, DataFrame]:
    """Chosen documents (mix_name, doc_id, source, repeats, n_tokens) and shares.

    Shares: (mix_name, source, target_share, actual_share, tokens, documents,
    max_repeats_used). Weights need not sum to 1. Without ``total_tokens`` a mix is as
    large as it can be with every present source still filling its share, so shares
    are met and the scarcest source is used to its cap; with a larger total, sources
    stop at their caps and the shares say so. A source absent from the documents, or
    with texts without tokens only, has share 0 and the others keep their proportion.
    A document appears at most max_repeats times; a repeated doc_id counts as one
    document of its smallest source; documents without source or doc_id join no mix.
    ``targets`` is a small table read by the driver; repeated (mix, source) rows keep
    the largest weight; null or non-positive weights or repeats choose nothing.
    """
    wanted: dict[str, dict[str, tuple[float, int]]] = {}
    for r in targets.select("mix_name", strip_key("source").alias("source"), "target_weight", "max_repeats").collect():
        if r["source"] is not None and r["mix_name"] is not None and (r["target_weight"] or 0) > 0:
            own = wanted.setdefault(r["mix_name"], {})
            own[r["source"]] = max(own.get(r["source"], (0.0, 0)), (r["target_weight"], max(0, r["max_repeats"] or 0)))
    names = sorted({s for of in wanted.values() for s in of})
    named = documents.filter("doc_id IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), strip_key("source").alias("source"), "text").filter(F.col("source").isin(names) if names else F.lit(False))
    tokens = materialize(sized(named, "doc_id", "source", path=path).groupBy("doc_id").agg(F.min("source").alias("source"), F.max("n_tokens").cast("long").alias("n_tokens")).filter("n_tokens > 0"))
    sums = {r["source"]: r["t"] for r in tokens.groupBy("source").agg(F.sum("n_tokens").alias("t")).collect()}
    parts = {s: max(1, min(PARTS, -(-t // SHARD_TOKENS))) for s, t in sums.items()}
    heaps = {s: max(1, min(PARTS, -(-t // (parts[s] * BLOCK_TOKENS)))) for s, t in sums.items()}
    n_parts, n_blocks = F.lit(1), F.lit(1)
    for s in sums:
        n_parts, n_blocks = F.when(F.col("source") == s, parts[s]).otherwise(n_parts), F.when(F.col("source") == s, heaps[s]).otherwise(n_blocks)
    # a document's shard and block depend on its id and the seed alone
    tokens = tokens.withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "doc_id"), n_parts).cast("int")).withColumn("block", F.pmod(F.xxhash64(F.lit(seed + 2), "doc_id"), n_blocks).cast("int"))
    filled = materialize(tokens.groupBy("source", "shard", "block").agg(F.sum("n_tokens").alias("tokens")))
    shards: dict[str, dict[int, int]] = {}
    for r in filled.groupBy("source", "shard").agg(F.sum("tokens").alias("t")).collect():  # at most PARTS rows a source
        shards.setdefault(r["source"], {})[r["shard"]] = r["t"]
    rows = []
    for mix, of in sorted(wanted.items()):
        quotas, block = plan_mix([(s, w, m) for s, (w, m) in sorted(of.items())], shards, total_tokens, blocks)
        rows += [(mix, s, i, q, shards[s][i], of[s][1]) for (s, i), q in sorted(quotas.items()) if q > 0]
    spark = documents.sparkSession
    plan = spark.createDataFrame(rows, "mix_name string, source string, shard int, quota double, shard_tokens long, max_repeats int")
    laps = F.least(F.floor(F.col("quota") / F.col("shard_tokens")), F.col("max_repeats").cast("long"))
    each = filled.join(plan, ["source", "shard"]).withColumn("_laps", laps)
    each = each.withColumn("_gap", F.when(F.col("_laps") < F.col("max_repeats"), F.col("quota") - F.col("_laps") * F.col("shard_tokens")).otherwise(0.0))
    in_order = Window.partitionBy("mix_name", "source", "shard").orderBy(F.xxhash64(F.lit(seed), "source", "shard", "block"), "block").rowsBetween(Window.unboundedPreceding, 0)
    each = each.withColumn("_room", F.col("_gap") - F.sum("tokens").over(in_order) + F.col("tokens"))
    whole = F.col("tokens") <= F.col("_room")
    each = each.select("mix_name", "source", "shard", "block", "_laps", "_gap", whole.alias("_took"), F.when(~whole & (F.col("_room") > 0), F.col("_room")).alias("_room"))
    both = tokens.join(each, ["source", "shard", "block"]).withColumn("_order", F.xxhash64("doc_id", F.lit(seed)))
    cols = ["mix_name", "doc_id", "source", "shard", "n_tokens", "_order", "_laps", "_gap", "_took"]

    def fill(docs: pd.DataFrame) -> pd.DataFrame:
        """Documents of the one block of a shard that its quota ends in, in seeded order while they fit."""
        docs = docs.sort_values(["_order", "doc_id"], kind="stable")
        room, took = docs["_room"].iloc[0], []
        for n in docs["n_tokens"].tolist():
            took.append(n <= room)
            room -= n if took[-1] else 0
        return docs.assign(_took=took)[cols]

    shard = ["mix_name", "source", "shard"]
    part = both.filter("_room IS NOT NULL").groupBy(*shard).applyInPandas(fill, both.select(*cols).schema)
    state = materialize(both.filter("_room IS NULL").select(*cols).unionByName(part))
    # what is left of a quota takes the longest documents that fit, by numbers of documents of each length;
    # where that is much, as with few and long documents, the whole quota of the shard is filled so
    rest = state.groupBy(*shard).agg(F.max("_gap").alias("_all"), (F.max("_gap") - F.sum(F.when(F.col("_took"), F.col("n_tokens")).otherwise(0))).alias("_left"))
    anew = F.col("_left") > LEFT_OVER * F.col("_all")
    rest = rest.select(*shard, anew.alias("_anew"), F.when(anew, F.col("_all")).otherwise(F.col("_left")).alias("_rest"))
    state = materialize(state.join(rest, shard).withColumn("_took", F.col("_took") & ~F.col("_anew")).drop("_anew"))
    open_ = state.filter("NOT _took AND _gap > 0 AND n_tokens <= _rest")

    def top_up(lengths: pd.DataFrame) -> pd.DataFrame:
        lengths = lengths.sort_values("n_tokens", ascending=False)
        room, more = lengths["_rest"].iloc[0], []
        for n, count in zip(lengths["n_tokens"].tolist(), lengths["n"].tolist(), strict=True):
            more.append(int(min(count, room // n)))
            room -= more[-1] * n
        return lengths.assign(_more=more)[[*shard, "n_tokens", "_more"]]

    lengths = open_.groupBy(*shard, "n_tokens", "_rest").agg(F.count(F.lit(1)).alias("n"))
    more = lengths.groupBy(*shard).applyInPandas(top_up, "mix_name string, source string, shard int, n_tokens long, _more long").filter("_more > 0")
    within = Window.partitionBy(*shard, "n_tokens").orderBy("_order", "doc_id")
    added = open_.join(more, [*shard, "n_tokens"]).withColumn("_n", F.row_number().over(within)).filter("_n <= _more").select("mix_name", "doc_id", F.lit(1).alias("_plus"))
    times = (F.col("_laps") + F.col("_took").cast("int") + F.coalesce("_plus", F.lit(0))).cast("int")
    chosen = materialize(state.join(added, ["mix_name", "doc_id"], "left").select("mix_name", "doc_id", "source", times.alias("repeats"), "n_tokens").filter("repeats > 0"))
    goals = [(mix, s, w / sum(x for x, _ in of.values())) for mix, of in sorted(wanted.items()) for s, (w, _) in sorted(of.items())]
    goal = spark.createDataFrame(goals, "mix_name string, source string, target_share double")
    got = chosen.groupBy("mix_name", "source").agg(F.sum(F.col("n_tokens") * F.col("repeats")).alias("tokens"), F.count(F.lit(1)).alias("documents"), F.max("repeats").alias("max_repeats_used"))
    whole = Window.partitionBy("mix_name")
    shares = goal.join(got, ["mix_name", "source"], "left").select(
        "mix_name", "source", "target_share", F.coalesce(F.col("tokens") / F.sum("tokens").over(whole), F.lit(0.0)).alias("actual_share"), F.coalesce("tokens", F.lit(0)).alias("tokens"), F.coalesce("documents", F.lit(0)).alias("documents"), F.coalesce("max_repeats_used", F.lit(0)).alias("max_repeats_used")
    )
    return chosen, shares
