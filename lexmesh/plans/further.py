"""Further queries: remaining text functions, rank unions, controls, digests and guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F

from lexmesh import rules
from lexmesh.functions import scorers as S
from lexmesh.functions import text as X
from lexmesh.operators import candidates as C
from lexmesh.operators import graph as G
from lexmesh.operators import multiset as M
from lexmesh.operators.explore import check_page
from lexmesh.plans.base import Atlas, Book, digest_sql
from lexmesh.plans.matching import _PAIR, _VEC, TOKS, SQL as MATCHING, _dense, _pairs, _sides, _true_pairs, _up  # noqa: I001
from lexmesh.sources import formats, store
from lexmesh.storage import materialize, scratch_dir

B = Book()

# ---- ranks --------------------------------------------------------------------
_BI = f"v AS ({_VEC}), f AS (SELECT source, target, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS source_rank FROM v WHERE score > 0 QUALIFY source_rank <= 7), k AS (SELECT source, target, row_number() OVER (PARTITION BY target ORDER BY score DESC, source) AS target_rank FROM v WHERE score > 0 QUALIFY target_rank <= 2), u AS (SELECT source, target, source_rank, target_rank FROM f FULL JOIN k USING (source, target))"


def _union(a: Atlas):
    d = materialize(_dense(a))
    f = C.top_k(d, 7).select("source", "target", F.col("rank").alias("source_rank"))
    return f.join(C.top_k(d, 2, "target", "source").select("source", "target", F.col("rank").alias("target_rank")), ["source", "target"], "full")


B.add("wn3_rank_union", f"WITH {_BI} SELECT * FROM u")(_union)
B.add("ev23_union_sizes", f"WITH {_BI} SELECT CAST(k AS INT) AS k, count(*) FILTER (source_rank <= k) AS forward, count(*) FILTER (target_rank <= k) AS backward, count(*) FILTER (source_rank <= k OR target_rank <= k) AS both_ways FROM u, (SELECT unnest([1, 2, 5]) AS k) GROUP BY 1")(
    lambda a: _union(a).select("*", F.explode(F.array(*[F.lit(k) for k in (1, 2, 5)])).alias("k")).groupBy("k").agg(F.count_if(F.col("source_rank") <= F.col("k")).alias("forward"), F.count_if(F.col("target_rank") <= F.col("k")).alias("backward"), F.count_if((F.coalesce("source_rank", F.lit(99)) <= F.col("k")) | (F.coalesce("target_rank", F.lit(99)) <= F.col("k"))).alias("both_ways"))
)
B.add("jn26_blocked_scores", f"SELECT source, count(*) AS n, round(max(score), 6) AS best FROM ({_VEC}) WHERE source <> target AND score > 0 GROUP BY 1")(lambda a: _dense(a).filter("source <> target AND score > 0").groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("score").alias("best")))
B.add("jn23_graph_paths", f"SELECT path, count(*) AS n FROM ({MATCHING['cg6_graph_neighbours']}) GROUP BY 1")(
    lambda a: C.graph_neighbours(a.statements.filter("predicate IN ('skos:exactMatch', 'skos:closeMatch')").select(F.col("subject").alias("source"), F.col("object").alias("target")), _up(a), _up(a)).groupBy("path").agg(F.count(F.lit(1)).alias("n"))
)
B.add("cg14_fuzzy_ranks", f"WITH {_PAIR}, s AS (SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS score FROM pair) SELECT a, b, row_number() OVER (PARTITION BY a ORDER BY score DESC, b) AS rank FROM s WHERE score > 0 QUALIFY rank <= 3")(
    lambda a: C.top_k(_pairs(a).select(F.col("a").alias("source"), F.col("b").alias("target"), F.round(X.jaro_winkler("a", "b"), 6).alias("score")), 3).select(F.col("source").alias("a"), F.col("target").alias("b"), "rank")
)
#: One source and target in so many are queries, each ranked against all of the other side.
_EVERY = 8


def _fuzzy_ranks(a: Atlas, common: bool = False):
    """(scorer, source, target, source_rank, target_rank): a stated query set of either side against the whole other side, the best three by each scorer."""
    s, t = (materialize(d.select("member", X.fold_plain("pref").alias("label"))) for d in _sides(a))
    asked = lambda d: d.filter(F.conv(F.substring(F.md5("member"), 1, 4), 16, 10).cast("int") % _EVERY == 0)
    tokens = lambda c: X.word_tokens(F.col(c))
    scorers = {"jaro_winkler": X.jaro_winkler("x", "y"), "edit_ratio": X.edit_ratio(F.col("x"), F.col("y")), "token_sort": X.edit_ratio(X.sorted_token_text(tokens("x")), X.sorted_token_text(tokens("y"))), "token_set": X.token_set_ratio(tokens("x"), tokens("y"))}
    if common:
        scorers = {n: S.scored(n, F.col("x"), F.col("y")) for n in S.SCORERS}

    def ranked(left, right, by, other, name):
        pairs = left.select(F.col("member").alias("source"), F.col("label").alias("x")).crossJoin(right.select(F.col("member").alias("target"), F.col("label").alias("y")))
        scores = materialize(pairs.select("source", "target", *[F.round(c, 6).alias(n) for n, c in scorers.items()]))
        out = [C.top_k(scores.select("source", "target", F.col(n).alias("score")), 3, by, other, positive=False).select(F.lit(n).alias("scorer"), "source", "target", F.col("rank").alias(name)) for n in scorers]
        return reduce(lambda x, y: x.unionByName(y), out)

    return ranked(asked(s), t, "source", "target", "source_rank").join(ranked(s, asked(t), "target", "source", "target_rank"), ["scorer", "source", "target"], "full")


B.add("cg14_fuzzy_ranks_both_sides")(_fuzzy_ranks)
B.add("cg14_common_scorers_both_sides")(lambda a: _fuzzy_ranks(a, common=True))
B.add("sf17_common_scorers")(lambda a: _true_pairs(a).select("a", "b", *[F.round(S.scored(n, F.col("a"), F.col("b")), 6).alias(n) for n in S.SCORERS]))
B.add("cg17_class_costs", f"SELECT generation_class, count(*) AS n FROM ({MATCHING['cg7_candidate_classes']}) GROUP BY 1")(lambda a: _classes(a).groupBy("generation_class").agg(F.count(F.lit(1)).alias("n")))
B.add("cg17_class_costs_unmasked")(lambda a: _classes(a, "_unmasked").groupBy("generation_class").agg(F.count(F.lit(1)).alias("n")))


def _classes(a: Atlas, kind: str = ""):
    from lexmesh.plans.matching import QUERIES

    return QUERIES[f"cg7_candidate_classes{kind}"](a.spark, a.path)


def _controls(a: Atlas):
    """Seeded pairs of both sides without a shared label word: both sides in a seeded order, paired by position."""
    from lexmesh.operators.ranks import with_rank

    def order(d, seed):
        keyed = d.select(F.sha2(F.concat(F.lit(seed), "member"), 256).alias("_o"), "member", X.word_tokens(X.fold_plain("pref")).alias("toks"))
        return with_rank(keyed, ["_o", "member"], "_n").drop("_o")

    s, t = _sides(a)
    both = order(s, "s").select(F.col("member").alias("source"), F.col("toks").alias("x"), "_n").join(order(t, "t").select(F.col("member").alias("target"), F.col("toks").alias("y"), "_n"), "_n")
    return both.filter(~F.arrays_overlap("x", "y")).orderBy("_n").limit(45).select("source", "target")


B.add("cg8_random_controls")(_controls)
B.add("cg11_order_free_digest", f"SELECT generation_class, count(*) AS n, {digest_sql("source || '>' || target")} AS digest FROM (" + MATCHING["cg7_candidate_classes"] + ") GROUP BY 1")(
    lambda a: _digests(_classes(a))
)
B.add("cg11_order_free_digest_unmasked")(lambda a: _digests(_classes(a, "_unmasked")))


def _digests(pairs):
    return pairs.groupBy("generation_class").agg(F.count(F.lit(1)).alias("n"), *X.digest_sums(F.concat("source", F.lit(">"), "target"))).select("generation_class", "n", X.digest_text().alias("digest"))


B.add("so5_canonical_order", f"SELECT release, count(*) AS n, {digest_sql('l')} AS digest FROM (SELECT DISTINCT release, concat_ws('|', id, resource, label_role, value, language) AS l FROM atlas_labels) GROUP BY 1")(
    lambda a: a.labels.select("release", F.concat_ws("|", "id", "resource", "label_role", "value", "language").alias("l")).distinct().groupBy("release").agg(F.count(F.lit(1)).alias("n"), *X.digest_sums(F.col("l"))).select("release", "n", X.digest_text().alias("digest"))
)

# ---- text ---------------------------------------------------------------------
#: Words that set a property apart.
_MARKS = ("primary", "secondary", "provisional", "revised", "inland", "coastal")
_IN = ", ".join(repr(m) for m in _MARKS)
B.add("sf19_marker_words", f"SELECT DISTINCT value, array_to_string(list_sort(list_distinct(list_filter({TOKS.format('lower(value)')}, lambda x: x IN ({_IN})))), '|') AS marks FROM atlas_labels")(
    lambda a: a.labels.select("value").distinct().withColumn("marks", F.array_join(F.array_sort(F.array_intersect(X.word_tokens(F.lower("value")), F.array(*[F.lit(m) for m in _MARKS]))), "|"))
)
_X, _Y = TOKS.format("lower(a)"), TOKS.format("lower(b)")
_FLAGS = f"concat_ws('|', CASE WHEN lower(a) = lower(b) THEN 'case' END, CASE WHEN list_sort(x) = list_sort(y) THEN 'words' END, CASE WHEN contains(lower(a), lower(b)) OR contains(lower(b), lower(a)) THEN 'contained' END, CASE WHEN len(list_intersect(x, y)) = 0 THEN 'disjoint' END, CASE WHEN levenshtein(a, b) <= 2 THEN 'near' END)"
B.add("sf20_challenge_classes", f"WITH {_PAIR}, k AS (SELECT a, b, {_X} AS x, {_Y} AS y FROM pair) SELECT a, b, {_FLAGS} AS classes FROM k")(lambda a: _challenges(_pairs(a)))
B.add("sf20_challenge_classes_unmasked")(lambda a: _challenges(_true_pairs(a)))


def _challenges(pairs):
    x, y = X.word_tokens(F.lower("a")), X.word_tokens(F.lower("b"))
    la, lb = F.lower("a"), F.lower("b")
    flags = [("case", la == lb), ("words", F.array_sort(x) == F.array_sort(y)), ("contained", F.contains(la, lb) | F.contains(lb, la)), ("disjoint", F.size(F.array_intersect(x, y)) == 0), ("near", F.levenshtein("a", "b") <= 2)]
    return pairs.select("a", "b", F.concat_ws("|", *[F.when(c, F.lit(n)) for n, c in flags]).alias("classes"))


def _sing(e: str) -> str:
    return f"regexp_replace({e}, '([^sui])s$', '\\1')"


_VAR = f"CASE WHEN lower(a) = lower(b) THEN 'case' WHEN {_sing('lower(a)')} = {_sing('lower(b)')} THEN 'number' WHEN replace(replace(lower(a), 'is', 'iz'), 'our', 'or') = replace(replace(lower(b), 'is', 'iz'), 'our', 'or') THEN 'spelling' ELSE 'other' END"


def _variant():
    one = lambda c: F.regexp_replace(F.lower(c), "([^sui])s$", "$1")
    us = lambda c: F.replace(F.replace(F.lower(c), F.lit("is"), F.lit("iz")), F.lit("our"), F.lit("or"))
    return F.when(F.lower("a") == F.lower("b"), "case").when(one("a") == one("b"), "number").when(us("a") == us("b"), "spelling").otherwise("other")


B.add("sf15_variant_classes", f"WITH {_PAIR} SELECT a, b, {_VAR} AS variant FROM pair")(lambda a: _pairs(a).withColumn("variant", _variant()))
B.add("ev14_distance_by_variant", f"WITH {_PAIR} SELECT {_VAR} AS variant, CAST(least(levenshtein(a, b), 5) AS INT) AS distance, count(*) AS n FROM pair GROUP BY ALL")(lambda a: _pairs(a).groupBy(_variant().alias("variant"), F.least(F.levenshtein("a", "b"), F.lit(5)).alias("distance")).agg(F.count(F.lit(1)).alias("n")))
# no SQL: DuckDB lowers a final sigma to another letter
B.add("sf15_variant_classes_unmasked")(lambda a: _true_pairs(a).withColumn("variant", _variant()))
B.add("ev14_distance_by_variant_unmasked")(lambda a: _true_pairs(a).groupBy(_variant().alias("variant"), F.least(F.levenshtein("a", "b"), F.lit(5)).alias("distance")).agg(F.count(F.lit(1)).alias("n")))
_BLANK = "coalesce(trim({0}), '') = ''"
B.add("sf24_level_paths", f"SELECT edge_id, CASE WHEN {_BLANK.format('parent_label')} THEN '' WHEN {_BLANK.format('child_label')} THEN parent_label ELSE parent_label || '>' || child_label END AS path, {_BLANK.format('parent_label')} AND NOT ({_BLANK.format('child_label')}) AS gap FROM gcmd_hierarchy_edges")(lambda a: _levels(a))


def _levels(a: Atlas):
    """Columns up to the first blank one; a value after a blank is a gap."""
    blank = lambda c: F.coalesce(F.trim(c), F.lit("")) == ""
    path = F.when(blank("parent_label"), F.lit("")).when(blank("child_label"), F.col("parent_label")).otherwise(F.concat("parent_label", F.lit(">"), "child_label"))
    return a.table("gcmd_hierarchy_edges").select("edge_id", path.alias("path"), (blank("parent_label") & ~blank("child_label")).alias("gap"))


B.add("sf25_locator_parts", "SELECT DISTINCT child_source_path, split_part(child_source_path, '#', 1) AS file, CASE WHEN contains(child_source_path, '#row=') THEN 'row' ELSE 'other' END AS kind, try_cast(split_part(child_source_path, '#row=', 2) AS BIGINT) AS position FROM gcmd_hierarchy_edges")(
    lambda a: a.table("gcmd_hierarchy_edges").select("child_source_path", F.substring_index("child_source_path", "#", 1).alias("file"), F.when(F.contains("child_source_path", F.lit("#row=")), "row").otherwise("other").alias("kind"), F.try_to_number(F.nullif(F.regexp_extract("child_source_path", "#row=(.*)$", 1), F.lit("")), F.lit("999999999999")).cast("bigint").alias("position")).distinct()
)
_HEX = "right(lower(regexp_replace(child_uuid, '[\\s{}-]', '', 'g')), 32)"
B.add("sf28_uuid_fields", f"SELECT DISTINCT edge_id, substr({_HEX}, 13, 1) AS version, CAST('0x' || substr({_HEX}, 1, 12) AS BIGINT) AS millis FROM gcmd_hierarchy_edges")(lambda a: _uuids(a))


def _uuids(a: Atlas):
    from lexmesh.functions.keys import hex32_uuid

    bare = F.replace(hex32_uuid("child_uuid"), F.lit("-"), F.lit(""))
    return a.table("gcmd_hierarchy_edges").select("edge_id", F.substring(bare, 13, 1).alias("version"), F.conv(F.substring(bare, 1, 12), 16, 10).cast("bigint").alias("millis")).distinct()


# ---- claims, rules and guards -------------------------------------------------
B.add("cg19_identifier_claims", "SELECT id, 'notation' AS kind, unnest(notations) AS value FROM atlas_resources UNION ALL SELECT id, 'source record', source_record FROM atlas_resources")(
    lambda a: a.resources.select("id", F.explode(F.concat(F.transform(F.coalesce("notations", F.array().cast("array<string>")), lambda n: F.struct(F.lit("notation").alias("kind"), n.alias("value"))), F.array(F.struct(F.lit("source record").alias("kind"), F.col("source_record").alias("value"))))).alias("c")).select("id", "c.kind", "c.value")
)
B.add("in4_graph_claims", "SELECT DISTINCT subject, predicate, object AS value, 'iri' AS object_kind FROM atlas_statements WHERE NOT regexp_matches(subject || object, '\\s')")(
    lambda a: formats.parse_nquads(formats.to_nquads(a.statements.filter(~F.concat("subject", "object").rlike(r"\s")).select("subject", "predicate", "object", F.lit("iri").alias("object_kind"), F.lit(None).cast("string").alias("language"), F.lit(None).cast("string").alias("graph")))).select("subject", "predicate", F.col("object").alias("value"), "object_kind").distinct()
)
_CMP = "WITH RECURSIVE x AS (SELECT DISTINCT subject AS a, object AS b FROM atlas_statements WHERE predicate = 'skos:exactMatch' AND subject <> object), u AS (SELECT a, b FROM x UNION SELECT b, a FROM x), w AS (SELECT a, a AS b FROM u UNION SELECT w.a, u.b FROM w JOIN u ON u.a = w.b), comp AS (SELECT a AS node, min(b) AS root FROM w GROUP BY 1), ship AS (SELECT a AS node, least(a, min(b)) AS root FROM u GROUP BY 1)"


def _isolation(a: Atlas):
    """Components recomputed against those one step of neighbours would give."""
    x = a.statements.filter("predicate = 'skos:exactMatch' AND subject <> object").select(F.col("subject").alias("a"), F.col("object").alias("b")).distinct()
    u = x.unionByName(x.select(F.col("b").alias("a"), F.col("a").alias("b")))
    return M.set_difference(G.components(x), u.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.first("a")).alias("root")))


B.add("iv20_reasoning_isolation", f"{_CMP} SELECT node, root, 'missing' AS side FROM (SELECT * FROM comp EXCEPT SELECT * FROM ship) UNION ALL SELECT node, root, 'extra' FROM (SELECT * FROM ship EXCEPT SELECT * FROM comp)")(_isolation)


def _registry(a: Atlas):
    rules.reset()
    for name in ("tree-number", "column-nesting", "compound-heading"):
        rules.register(rules.Rule(name, "skos:broader", G.projection))
    names = rules.names()
    rules.reset()
    return a.spark.createDataFrame([(n,) for n in names], "rule string")


B.add("gr5_rule_registry", "SELECT unnest(['column-nesting', 'compound-heading', 'tree-number']) AS rule")(_registry)


def _refused(a: Atlas):
    rows = []
    for name, args in (("limit 0", {"limit": 0}), ("limit 501", {"limit": 501}), ("limit true", {"limit": True}), ("offset -1", {"offset": -1}), ("status x", {"status": "x"}), ("plain", {})):
        try:
            check_page(**args)
            rows.append((name, False))
        except ValueError:
            rows.append((name, True))
    return a.spark.createDataFrame(rows, "arguments string, refused boolean")


B.add("pf9_argument_guard", "SELECT * FROM (VALUES ('limit 0', true), ('limit 501', true), ('limit true', true), ('offset -1', true), ('status x', true), ('plain', false)) t(arguments, refused)")(_refused)
B.add("sk3_derived_table", "SELECT id, source_concept AS subject, target_concept AS object FROM mapping_assertions")(lambda a: _derived(a))


def _derived(a: Atlas):
    path = f"{scratch_dir(a.spark)}/sk3"
    a.table("mapping_assertions").select("id", F.col("source_concept").alias("subject"), F.col("target_concept").alias("object")).write.mode("overwrite").option("compression", "zstd").parquet(path)
    return a.spark.read.parquet(path)


B.add("sk4_text_table", "SELECT id, to_json(evidence) AS evidence FROM mapping_assertions")(lambda a: _texted(a))


def _texted(a: Atlas):
    path = f"{scratch_dir(a.spark)}/sk4"
    store.write_text_table(a.table("mapping_assertions").select("id", "evidence"), path)
    return a.spark.read.parquet(path)


B.add("sk7_arrow_result", "SELECT scheme, count(*) AS n FROM atlas_resources GROUP BY 1")(lambda a: a.spark.createDataFrame(a.resources.groupBy("scheme").agg(F.count(F.lit(1)).alias("n")).toArrow()))
B.add("in12_catalogue", "SELECT r.scheme, count(DISTINCT r.id) AS resources, count(DISTINCT l.resource) AS labelled FROM atlas_resources r LEFT JOIN atlas_labels l ON l.resource = r.id GROUP BY 1")(
    lambda a: a.resources.select("scheme", "id").distinct().join(a.labels.select(F.col("resource").alias("id")).distinct().withColumn("_l", F.lit(1)), "id", "left").groupBy("scheme").agg(F.count_distinct("id").alias("resources"), F.count("_l").alias("labelled"))
)
QUERIES, SQL = B.queries, B.sql
