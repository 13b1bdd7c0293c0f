"""Graph operators on edge tables: components, closure, cycles, paths, derivation by rule.

Loops materialize each level in shared storage; the driver sees only row counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmesh.operators.forests import forest_groups
from lexmesh.storage import discard, materialize


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node connected to each node on an edge to another one, by union-find in cells."""
    return forest_groups(edges.filter(F.col(a) != F.col(b)), a, b)


def component_sizes(found: DataFrame) -> DataFrame:
    """(root, nodes, inferred_pairs): members of each component and the pairs they imply."""
    n = found.groupBy("root").agg(F.count(F.lit(1)).alias("nodes"))
    return n.withColumn("inferred_pairs", (F.col("nodes") * (F.col("nodes") - 1) / 2).cast("long"))


def reachable(edges: DataFrame, depth: int | None = None) -> DataFrame:
    """(a, b, depth): every node reachable from a by at least one edge, with its shortest distance, up to ``depth`` steps.

    Only pairs found last are extended, and pairs known before are dropped, so cycles end.
    """
    step = materialize(edges.select("a", "b").distinct())
    new = materialize(step.withColumn("depth", F.lit(1)))
    known, at = new, 1
    while (depth is None or at < depth) and not new.isEmpty():
        at += 1
        far = new.select("a", F.col("b").alias("m")).join(step.select(F.col("a").alias("m"), "b"), "m").select("a", "b").distinct()
        new = materialize(far.join(known.select("a", "b"), ["a", "b"], "left_anti").withColumn("depth", F.lit(at)))
        known = known.unionByName(new)
    return known


def closure_report(closed: DataFrame) -> DataFrame:
    """(depth, pairs): implied pairs by shortest distance."""
    return closed.groupBy("depth").agg(F.count(F.lit(1)).alias("pairs"))


def cyclic_core(edges: DataFrame) -> DataFrame:
    """Edges left when nodes without in- or out-edges are peeled off again and again; none if there is no cycle."""
    state = materialize(edges.select("a", "b").distinct())
    n = state.count()
    while n:
        kept = state.join(state.select(F.col("b").alias("a")).distinct(), "a", "left_semi").join(state.select(F.col("a").alias("b")).distinct(), "b", "left_semi")
        nxt = materialize(kept.select("a", "b"))
        m = nxt.count()
        discard(state)
        state = nxt
        if m == n:
            break
        n = m
    return state


def related_and_connected(related: DataFrame, hierarchy: DataFrame) -> DataFrame:
    """Associative pairs whose ends the hierarchy connects in either direction.

    Only pairs within one weak component can be, and only their ends are followed.
    """
    pairs = related.select("a", "b").distinct()
    weak = components(hierarchy)
    ra, rb = weak.select(F.col("node").alias("a"), F.col("root").alias("_ra")), weak.select(F.col("node").alias("b"), F.col("root").alias("_rb"))
    pairs = materialize(pairs.join(ra, "a").join(rb, "b").filter("_ra = _rb").select("a", "b"))
    inside = weak.join(pairs.join(ra, "a").select(F.col("_ra").alias("root")).distinct(), "root", "left_semi").select(F.col("node").alias("a"))
    closed = reachable(hierarchy.join(inside, "a", "left_semi")).select("a", "b")
    either = closed.unionByName(closed.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()
    return pairs.join(either, ["a", "b"], "left_semi")


def two_hop_pairs(edges: DataFrame) -> DataFrame:
    """Unordered pairs exactly two undirected steps apart."""
    both = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).filter("a <> b").distinct()
    far = both.select(F.col("a").alias("m"), F.col("b").alias("a")).join(both.select(F.col("a").alias("m"), F.col("b").alias("b")), "m").filter("a < b").select("a", "b").distinct()
    return far.join(both, ["a", "b"], "left_anti")


def siblings(edges: DataFrame) -> DataFrame:
    """Unordered pairs of children (a) that share a parent (b)."""
    kids = edges.select(F.col("a").alias("kid"), F.col("b").alias("up")).distinct()
    return kids.withColumnRenamed("kid", "a").join(kids.withColumnRenamed("kid", "b"), "up").filter("a < b").select("a", "b").distinct()


def degree_report(edges: DataFrame) -> DataFrame:
    """One row: greatest and median degree, and the share of edge ends on the top tenth of nodes."""
    n = edges.select(F.explode(F.array("a", "b")).alias("node")).groupBy("node").agg(F.count(F.lit(1)).alias("degree"))
    # degrees are first counted by value, so ranking handles distinct degrees, not nodes
    hist = n.groupBy("degree").agg(F.count(F.lit(1)).alias("nodes"))
    above = F.coalesce(F.sum("nodes").over(Window.orderBy(F.desc("degree")).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    every = F.sum("nodes").over(Window.partitionBy())
    ranked = hist.withColumn("_above", above).withColumn("_take", F.greatest(F.least(F.col("nodes"), F.ceil(every / 10) - F.col("_above")), F.lit(0)))
    top = ranked.agg(F.sum(F.col("_take") * F.col("degree")).alias("t"), F.sum(F.col("nodes") * F.col("degree")).alias("s"), F.max("degree").alias("max_degree"))
    mid = n.agg(F.median("degree").alias("median_degree"))
    row, med = top.first(), mid.first()
    values = [(row["max_degree"], med["median_degree"], None if not row["s"] else row["t"] / row["s"])]
    return edges.sparkSession.createDataFrame(values, "max_degree long, median_degree double, top_share double")


def typed_paths(edges: DataFrame, moves: list[tuple[str, str, str]], start: str, ends: DataFrame, depth: int = 4) -> DataFrame:
    """(source, target, steps, mode): shortest allowed paths from each source to its targets.

    edges (a, b, kind); ``moves`` (mode, kind, next mode) is the automaton, a small fixed
    table. A path never needs the same (node, mode) twice, so states known are dropped.
    """
    table = F.broadcast(edges.sparkSession.createDataFrame(moves, "mode string, kind string, next string"))
    sources = ends.select("source").distinct()
    new = materialize(sources.select("source", F.col("source").alias("node"), F.lit(start).alias("mode"), F.lit(0).alias("steps")))
    known = new
    for at in range(1, depth + 1):
        far = new.join(edges.select(F.col("a").alias("node"), F.col("b").alias("_b"), "kind"), "node").join(table, ["mode", "kind"])
        far = far.select("source", F.col("_b").alias("node"), F.col("next").alias("mode")).distinct()
        new = materialize(far.join(known.select("source", "node", "mode"), ["source", "node", "mode"], "left_anti").withColumn("steps", F.lit(at)))
        known = known.unionByName(new)
    hits = known.filter("steps > 0").withColumnRenamed("node", "target").join(ends.select("source", "target").distinct(), ["source", "target"])
    return hits.groupBy("source", "target").agg(F.min(F.struct("steps", "mode")).alias("m")).select("source", "target", "m.steps", "m.mode")


def follow_chain(links: DataFrame) -> DataFrame:
    """(start, sink, steps, outcome) of functional chains a -> b: resolved at a node without link, branch at a node with several, cycle if it never ends.

    Doubles the distance each round, so long chains take few rounds. The nodes before a
    chain's end lie at every distance from it, so a round in which no start gets to an
    end leaves only those that go round in cycles.
    """
    out = links.select("a", "b").distinct()
    n = out.groupBy("a").agg(F.count(F.lit(1)).alias("n"), F.min("b").alias("b"))
    single = materialize(n.filter("n = 1").select("a", "b"))
    forks = materialize(n.filter("n > 1").select("a"))
    state = materialize(single.select(F.col("a").alias("start"), F.col("b").alias("at"), F.lit(1).cast("long").alias("steps")))
    going = state.join(single.select(F.col("a").alias("at")), "at", "left_semi").count()
    while going:
        jump = state.select(F.col("start").alias("at"), F.col("at").alias("_to"), F.col("steps").alias("_more"))
        nxt = materialize(state.join(jump, "at", "left").select("start", F.coalesce("_to", "at").alias("at"), (F.col("steps") + F.coalesce("_more", F.lit(0))).alias("steps")))
        discard(state)
        state, before = nxt, going
        going = state.join(single.select(F.col("a").alias("at")), "at", "left_semi").count()
        if going == before:
            break
    open_ = single.select(F.col("a").alias("at")).withColumn("_open", F.lit(1))
    fork = forks.select(F.col("a").alias("at")).withColumn("_fork", F.lit(1))
    both = state.join(open_, "at", "left").join(fork, "at", "left")
    outcome = F.when(F.col("_fork").isNotNull(), "branch").when(F.col("_open").isNotNull(), "cycle").otherwise("resolved")
    return both.select("start", F.when(outcome != "cycle", F.col("at")).alias("sink"), F.when(outcome != "cycle", F.col("steps")).alias("steps"), outcome.alias("outcome"))


def oriented(relations: DataFrame, broader: tuple[str, ...], narrower: tuple[str, ...], related: tuple[str, ...]) -> DataFrame:
    """(kind, a, b, predicates, directions): hierarchy pointed to the broader end, associative pairs sorted, one row per pair."""
    p = F.col("predicate")
    kind = F.when(p.isin(*broader, *narrower), "hierarchy").when(p.isin(*related), "associative")
    flip = p.isin(*narrower) | (p.isin(*related) & (F.col("subject") > F.col("object")))
    a, b = F.when(flip, F.col("object")).otherwise(F.col("subject")), F.when(flip, F.col("subject")).otherwise(F.col("object"))
    rows = relations.withColumn("kind", kind).filter("kind IS NOT NULL AND subject <> object")
    return rows.select("kind", a.alias("a"), b.alias("b"), "predicate", flip.alias("_f")).groupBy("kind", "a", "b").agg(F.array_join(F.array_sort(F.collect_set("predicate")), ",").alias("predicates"), F.count_distinct("_f").alias("directions"))


def prefix_parents(codes: DataFrame, parent: Column) -> DataFrame:
    """(resource, code, parent_code, parent, outcome) by a rule from a code to its parent's: root, missing, ambiguous, self or edge.

    codes (resource, code). A code owned by several resources is ambiguous only where it
    is cited as a parent.
    """
    own = codes.select("resource", "code").distinct()
    cited = own.withColumn("parent_code", parent)
    owner = own.groupBy(F.col("code").alias("parent_code")).agg(F.count(F.lit(1)).alias("_n"), F.min("resource").alias("_owner"))
    both = cited.join(owner, "parent_code", "left")
    outcome = F.when(F.col("parent_code").isNull(), "root").when(F.col("_n").isNull(), "missing").when(F.col("_n") > 1, "ambiguous").when(F.col("_owner") == F.col("resource"), "self").otherwise("edge")
    return both.select("resource", "code", "parent_code", F.when(outcome == "edge", F.col("_owner")).alias("parent"), outcome.alias("outcome"))


def derive_rows(edges: DataFrame, evidence: DataFrame, rule: str, predicate: str, generated_at: str) -> DataFrame:
    """Derived rows of edges (resource, parent) from evidence (resource, assertion, digest).

    Evidence is deduplicated and sorted before hashing; edges without any, or with
    evidence that has no digest, give no row. The id follows from the content.
    """
    if "T" not in generated_at or not (generated_at.endswith("Z") or "+" in generated_at[10:]):
        raise ValueError("generated_at must be a date and time with an offset")
    used = evidence.groupBy("resource").agg(F.array_sort(F.collect_set(F.struct("assertion", "digest"))).alias("used"), F.count_if(F.col("digest").isNull()).alias("_bare")).filter("_bare = 0")
    rows = edges.select("resource", "parent").distinct().join(used, "resource")
    line = F.array_join(F.transform("used", lambda u: F.concat(u["assertion"], F.lit("="), F.hex(u["digest"]))), ";")
    digest = F.sha2(line, 256)
    content = F.sha2(F.concat_ws("|", "resource", F.lit(predicate), "parent", F.lit(rule), digest), 256)
    return rows.select(F.concat(F.lit("urn:derived:"), content).alias("id"), F.col("resource").alias("subject"), F.lit(predicate).alias("predicate"), F.col("parent").alias("object"), F.lit(rule).alias("derivation_rule"), F.array_join(F.col("used.assertion"), ",").alias("derived_from_assertions"), digest.alias("input_digest"), F.lit(generated_at).alias("generated_at"), content.alias("content_digest"))


def projection(statements: DataFrame) -> DataFrame:
    """(subject, predicate, object, assertions, id): distinct triples with the assertions that support them."""
    grouped = statements.groupBy("subject", "predicate", "object").agg(F.array_join(F.array_sort(F.collect_set("id")), ",").alias("assertions"))
    return grouped.withColumn("id", F.sha2(F.concat_ws("|", "subject", "predicate", "object", "assertions"), 256))


def cited_path_faults(rows: DataFrame) -> DataFrame:
    """(id, fault) of inferred rows (id, subject, object, edges[struct(a, b)]) that cite no simple path of two or more edges between their ends.

    A simple path has each end on one edge, every other node on two, and as many nodes as edges plus one.
    """
    ends = rows.select("id", "subject", "object", F.size("edges").alias("n"), F.explode(F.flatten(F.transform("edges", lambda e: F.array(e["a"], e["b"])))).alias("node"))
    deg = ends.groupBy("id", "subject", "object", "n", "node").agg(F.count(F.lit(1)).alias("d"))
    is_end = F.col("node").isin(F.col("subject"), F.col("object"))
    per = deg.groupBy("id", "n").agg(F.count(F.lit(1)).alias("nodes"), F.count_if(is_end & (F.col("d") == 1)).alias("tips"), F.count_if(~is_end & (F.col("d") != 2)).alias("odd"))
    fault = F.when(F.col("n") < 2, "too short").when((F.col("tips") != 2) | (F.col("odd") > 0) | (F.col("nodes") != F.col("n") + 1), "no simple path")
    return per.select("id", fault.alias("fault")).filter("fault IS NOT NULL")
