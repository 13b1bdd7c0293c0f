"""Evaluation of candidate arms and judgements: recall, rescues, fronts, covers, rates, agreement."""

from __future__ import annotations

from itertools import product

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmesh.functions.text import wilson
from lexmesh.storage import discard, materialize


def recall_at(gold: DataFrame, ranks: DataFrame, depths: list[int], by: list[str] = [], cartesian: int | None = None) -> DataFrame:  # noqa: B006
    """(by..., k, gold, found, recall[, candidates, share]): gold pairs within each depth, grouped.

    gold (pair, by...), ranks (pair, rank). Ratios have nine places; null for an empty group.
    """
    best = ranks.groupBy("pair").agg(F.min("rank").alias("rank"))
    hits = gold.join(best, "pair", "left").select(*by, "rank", F.explode(F.array(*[F.lit(k) for k in depths])).alias("k"))
    out = hits.groupBy(*by, "k").agg(F.count(F.lit(1)).alias("gold"), F.count_if(F.col("rank") <= F.col("k")).alias("found")).withColumn("recall", F.round(F.col("found") / F.col("gold"), 9))
    if cartesian:
        n = best.select("rank", F.explode(F.array(*[F.lit(k) for k in depths])).alias("k")).filter("rank <= k").groupBy("k").agg(F.count(F.lit(1)).alias("candidates"))
        out = out.join(n, "k", "left").withColumn("candidates", F.coalesce("candidates", F.lit(0))).withColumn("share", F.round(F.col("candidates") / cartesian, 9))
    return out


def misses(gold: DataFrame, ranks: DataFrame, k: int, by: str, examples: int = 12) -> DataFrame:
    """(by, n, pair): gold pairs outside depth k, with their number per group and the first few as examples."""
    lost = gold.join(ranks.filter(F.col("rank") <= k).select("pair").distinct(), "pair", "left_anti")
    per = Window.partitionBy(by)
    return lost.select(by, "pair", F.count(F.lit(1)).over(per).alias("n"), F.row_number().over(per.orderBy("pair")).alias("_r")).filter(F.col("_r") <= examples).drop("_r")


def staged_rescues(stages: list[tuple[str, DataFrame]], gold: DataFrame) -> DataFrame:
    """(stage, name, added_candidates, added_gold, candidates_per_gold): what each stage adds to those before."""
    from functools import reduce

    every = reduce(DataFrame.unionByName, [d.select("pair").distinct().withColumn("stage", F.lit(i)) for i, (_, d) in enumerate(stages)])
    first = every.groupBy("pair").agg(F.min("stage").alias("stage")).join(gold.select("pair").distinct().withColumn("_g", F.lit(1)), "pair", "left")
    n = first.groupBy("stage").agg(F.count(F.lit(1)).alias("added_candidates"), F.count("_g").alias("added_gold"))
    names = gold.sparkSession.createDataFrame([(i, n) for i, (n, _) in enumerate(stages)], "stage int, name string")
    return names.join(n, "stage", "left").fillna(0).withColumn("candidates_per_gold", F.round(F.col("added_candidates") / F.nullif(F.col("added_gold"), F.lit(0)), 9))


def depth_grid(arms: dict[str, DataFrame], depths: list[int], gold: DataFrame) -> DataFrame:
    """(depth per arm..., candidates, found): size and gold of the union of arms for every combination of depths.

    A pair's rank in each arm is gathered once; each combination is a conditional count.
    The number of combinations is a parameter, not data.
    """
    from functools import reduce

    every = reduce(DataFrame.unionByName, [d.select("pair", "rank", F.lit(n).alias("arm")) for n, d in arms.items()])
    wide = every.groupBy("pair").agg(*[F.min(F.when(F.col("arm") == n, F.col("rank"))).alias(f"r_{n}") for n in arms]).join(gold.select("pair").distinct().withColumn("_g", F.lit(1)), "pair", "left")
    hit = lambda combo: F.coalesce(reduce(lambda a, b: a | b, [F.coalesce(F.col(f"r_{n}") <= k, F.lit(False)) for n, k in zip(arms, combo, strict=True)]), F.lit(False))
    combos = list(product(depths, repeat=len(arms)))
    cells = [F.struct(*[F.lit(k).alias(f"k_{n}") for n, k in zip(arms, c, strict=True)], F.count_if(hit(c)).alias("candidates"), F.count_if(hit(c) & F.col("_g").isNotNull()).alias("found")) for c in combos]
    return wide.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def pareto(points: DataFrame, cost: str, value: str) -> DataFrame:
    """Points that no other beats in cost and value; of equal points all stay. Points are configurations, few beside data."""
    best = points.groupBy(cost).agg(F.max(value).alias("_v"))
    before = Window.orderBy(cost).rowsBetween(Window.unboundedPreceding, -1)
    front = best.withColumn("_b", F.max("_v").over(before)).filter(F.col("_b").isNull() | (F.col("_v") > F.col("_b"))).select(cost, F.col("_v").alias(value))
    return points.join(front, [cost, value], "left_semi")


def greedy_cover(options: DataFrame, gold: DataFrame) -> list[tuple[str, int, int]]:
    """[(option, new gold, total)] by greatest gain, ties to the smaller name, until all coverable gold is covered.

    options (option, pair). Only per-option counts reach the driver.
    """
    left = materialize(options.join(gold.select("pair").distinct(), "pair", "left_semi").select("option", "pair").distinct())
    out, total = [], 0
    while True:
        top = left.groupBy("option").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "option").first()
        if top is None:
            return out
        total += top["n"]
        out.append((top["option"], top["n"], total))
        rest = materialize(left.join(left.filter(F.col("option") == top["option"]).select("pair"), "pair", "left_anti"))
        discard(left)
        left = rest


def signatures(options: DataFrame) -> DataFrame:
    """(signature, pairs): pairs counted by the set of options that contain them."""
    return options.groupBy("pair").agg(F.array_join(F.array_sort(F.collect_set("option")), "|").alias("signature")).groupBy("signature").agg(F.count(F.lit(1)).alias("pairs"))


def cheapest_cover(table: dict[str, tuple[int, frozenset[str]]], arms: dict[str, str], needed: dict[str, int]) -> tuple[int, list[str]] | None:
    """The options, at most one per arm, of least total cost that cover all needed signatures; None if none does.

    table: option -> (cost, signatures it contains); arms: option -> arm; needed:
    signature -> weight. Branch and bound on the signature-compressed table, which is
    small however many pairs there are. Ties go to fewer options, then to names.

    A signature whose options include all options of another needs no row of its own.
    Bounds are dual: each row in turn is paid as much as its cheapest option has left.
    """
    names = sorted(table)
    cost = [table[o][0] for o in names]
    rows: dict[str, int] = {s: 0 for s, w in needed.items() if w}
    for i, o in enumerate(names):
        for s in table[o][1]:
            if s in rows:
                rows[s] |= 1 << i
    least: list[int] = []
    for r in sorted(set(rows.values()), key=lambda r: (r.bit_count(), r)):
        if not r:
            return None
        if not any(k & r == k for k in least):
            least.append(r)
    mates = [sum(1 << j for j, x in enumerate(names) if arms[x] == arms[o]) for o in names]
    best: list = [None]

    def bits(r: int) -> list[int]:
        out = []
        while r:
            out.append((r & -r).bit_length() - 1)
            r &= r - 1
        return out

    def go(chosen: list[int], spent: int, open_: int, left: list[int]) -> None:
        if not left:
            key = (spent, len(chosen), sorted(names[i] for i in chosen))
            if best[0] is None or key < best[0]:
                best[0] = key
            return
        left = sorted({r & open_ for r in left}, key=int.bit_count)
        if not left[0]:
            return
        rest, low = cost.copy(), spent
        for r in left:
            has = bits(r)
            pay = min(rest[i] for i in has)
            if pay:
                low += pay
                for i in has:
                    rest[i] -= pay
        if best[0] is not None:
            if (low, len(chosen) + 1) > best[0][:2]:
                return
            # an option that alone lifts the bound over the best is in no better cover
            open_ &= ~sum(1 << i for i in bits(open_) if low + rest[i] > best[0][0])
            left = sorted({r & open_ for r in left}, key=int.bit_count)
            if not left[0]:
                return
        for i in sorted(bits(left[0]), key=lambda i: (cost[i] / sum(r >> i & 1 for r in left), i)):
            go([*chosen, i], spent + cost[i], open_ & ~mates[i], [r for r in left if not r >> i & 1])
            open_ &= ~(1 << i)

    go([], 0, (1 << len(names)) - 1, least)
    return None if best[0] is None else (best[0][0], best[0][2])


def triage(pairs: DataFrame, gold: DataFrame, entailed: DataFrame, sibling: DataFrame) -> DataFrame:
    """(verdict, n): candidates by what they are: gold, entailed, sibling, else neither."""
    flag = lambda d, n: d.select("pair").distinct().withColumn(n, F.lit(1))
    both = pairs.select("pair").distinct().join(flag(gold, "_g"), "pair", "left").join(flag(entailed, "_e"), "pair", "left").join(flag(sibling, "_s"), "pair", "left")
    verdict = F.when(F.col("_g").isNotNull(), "gold").when(F.col("_e").isNotNull(), "entailed").when(F.col("_s").isNotNull(), "sibling").otherwise("neither")
    return both.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("n"))


def rates(df: DataFrame, by: list[str], hit: Column, min_total: int = 1) -> DataFrame:
    """(by..., n, hits, rate, low, high, lift): shares with their Wilson interval and lift over the overall share."""
    n = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("hits")).filter(F.col("n") >= min_total)
    whole = df.agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("h")).first()
    base = whole["h"] / whole["n"] if whole["n"] else None
    low, high = wilson(F.col("hits"), F.col("n"))
    return n.select(*by, "n", "hits", F.round(F.col("hits") / F.col("n"), 9).alias("rate"), F.round(low, 9).alias("low"), F.round(high, 9).alias("high"), F.round(F.col("hits") / F.col("n") / F.lit(base or None), 9).alias("lift"))


def likelihood_ratios(df: DataFrame, feature: str, truth: Column) -> DataFrame:
    """(feature, true, false, ratio): P(feature | true) / P(feature | false); null where a side is empty."""
    n = df.groupBy(feature).agg(F.count_if(truth).alias("true"), F.count_if(~truth).alias("false"))
    w = Window.partitionBy()
    t, f = F.sum("true").over(w), F.sum("false").over(w)
    return n.select(feature, "true", "false", F.round((F.col("true") / F.nullif(t, F.lit(0))) / F.nullif(F.col("false") / F.nullif(f, F.lit(0)), F.lit(0.0)), 9).alias("ratio"))


def agreement(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """One row: n, equal, agreement and Cohen's kappa of two verdict columns; rows with a null verdict are left out."""
    kept = pairs.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    cells = kept.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    total, same = F.sum("n").over(Window.partitionBy()), F.sum(F.when(F.col(a) == F.col(b), F.col("n")).otherwise(0)).over(Window.partitionBy())
    row = cells.select(total.alias("n"), same.alias("equal")).limit(1)
    ma, mb = cells.groupBy(F.col(a).alias("v")).agg(F.sum("n").alias("x")), cells.groupBy(F.col(b).alias("v")).agg(F.sum("n").alias("y"))
    chance = ma.join(mb, "v").agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0)).alias("c"))
    first, c = row.first(), chance.first()["c"]
    if first is None:
        values = (0, 0, None, None)
    else:
        n, e = first["n"], first["equal"]
        p, q = e / n, c / (n * n)
        values = (n, e, round(p, 9), None if q == 1 else round((p - q) / (1 - q), 9))
    return pairs.sparkSession.createDataFrame([values], "n long, equal long, agreement double, kappa double")


def contingency(pairs: DataFrame, a: str, b: str) -> DataFrame:
    return pairs.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))


def flips(first: DataFrame, second: DataFrame, key: list[str], value: str) -> DataFrame:
    """(from, to, n): values of a key in a first and a second pass."""
    both = first.select(*key, F.col(value).alias("from")).join(second.select(*key, F.col(value).alias("to")), key)
    return both.groupBy("from", "to").agg(F.count(F.lit(1)).alias("n"))


def stratified_sample(df: DataFrame, stratum: str, key: Column, quota: int) -> DataFrame:
    """The rows with the lowest SHA-256 of their key per stratum, with eligible and sampled counts."""
    h = df.withColumn("_h", F.sha2(key, 256))
    per = Window.partitionBy(stratum)
    return h.select("*", F.count(F.lit(1)).over(per).alias("eligible"), F.row_number().over(per.orderBy("_h")).alias("_n")).filter(F.col("_n") <= quota).drop("_n", "_h").withColumn("sampled", F.least("eligible", F.lit(quota)))


def short_strata(df: DataFrame, stratum: str, quota: int) -> DataFrame:
    """Strata with fewer rows than the quota."""
    return df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") < quota)


def confusion(df: DataFrame, truth: str, said: str) -> DataFrame:
    """(said, n, right, precision, low, high) of a classifier against an audit."""
    n = df.groupBy(said).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col(truth) == F.col(said)).alias("right"))
    low, high = wilson(F.col("right"), F.col("n"))
    return n.select(said, "n", "right", F.round(F.col("right") / F.col("n"), 9).alias("precision"), F.round(low, 9).alias("low"), F.round(high, 9).alias("high"))
