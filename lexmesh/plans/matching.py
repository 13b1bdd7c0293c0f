"""Queries of candidate generation, text functions and vectors."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmesh.functions import text as X
from lexmesh.functions.labels import display_labels
from lexmesh.operators import candidates as C
from lexmesh.operators import graph as G
from lexmesh.operators.search import strip_accents
from lexmesh.plans.base import ROLE, SCHEME_A, SCHEME_B, Atlas, Book
from lexmesh.storage import materialize

B = Book()
_DISP = f"disp AS (SELECT resource, first(value ORDER BY {ROLE}, lower(value), value) AS pref FROM atlas_labels WHERE lower(language) = 'en' GROUP BY 1)"
_SIDE = "{0} AS (SELECT r.id AS member, d.pref, min(r.definition) AS definition FROM atlas_resources r JOIN disp d ON d.resource = r.id WHERE r.scheme = '{1}' GROUP BY ALL)"
_SIDES = f"{_DISP}, {_SIDE.format('s', SCHEME_A)}, {_SIDE.format('t', SCHEME_B)}"
FOLD = "replace(lower(trim(regexp_replace({0}, '\\s+', ' ', 'g'), ' ')), 'ς', 'σ')"
TOKS = "list_filter(string_split_regex({0}, '[^0-9a-z]+'), lambda x: x <> '')"


def _sides(a: Atlas):
    return C.concepts(a.resources, a.labels, SCHEME_A), C.concepts(a.resources, a.labels, SCHEME_B)


_LAB = "SELECT {0}.member, " + FOLD.format("l.value") + " AS label, bool_or(l.value = {0}.pref) AS preferred FROM {0} JOIN atlas_labels l ON l.resource = {0}.member WHERE lower(l.language) = 'en' GROUP BY ALL"
B.add("cg10_concepts", f"WITH {_SIDES} SELECT * FROM s")(lambda a: _sides(a)[0])
B.add("cg10_concept_labels", f"WITH {_SIDES} {_LAB.format('s')}")(lambda a: C.concept_labels(_sides(a)[0], a.labels))
_EQ = f"eq AS (SELECT DISTINCT s.member AS source, t.member AS target FROM s JOIN t ON {FOLD.format('s.pref')} = {FOLD.format('t.pref')} WHERE {FOLD.format('s.pref')} <> '')"
B.add("jn16_equal_preferred", f"WITH {_SIDES}, {_EQ} SELECT * FROM eq")(lambda a: C.equal_preferred(*_sides(a)))
_ANY = f"sl AS ({_LAB.format('s')}), tl AS ({_LAB.format('t')}), anyeq AS (SELECT DISTINCT sl.member AS source, tl.member AS target FROM sl JOIN tl USING (label) WHERE label <> '' EXCEPT SELECT * FROM eq)"
B.add("jn17_equal_any", f"WITH {_SIDES}, {_EQ}, {_ANY} SELECT * FROM anyeq")(lambda a: (lambda s, t: C.equal_any(C.concept_labels(s, a.labels), C.concept_labels(t, a.labels), C.equal_preferred(s, t)))(*_sides(a)))
_CUT = "sc AS (SELECT member, ' ' || array_to_string(k, ' ') || ' ' AS x, len(k) AS n FROM (SELECT member, " + TOKS.format(FOLD.format("pref")) + " AS k FROM s) WHERE len(k) > 0), tc AS (SELECT member, ' ' || array_to_string(k, ' ') || ' ' AS x, len(k) AS n FROM (SELECT member, " + TOKS.format(FOLD.format("pref")) + " AS k FROM t) WHERE len(k) > 0)"
_INSIDE = "ins AS (SELECT sc.member AS source, tc.member AS target, 'sourceInsideTarget' AS direction FROM sc JOIN tc ON sc.n < tc.n AND contains(tc.x, sc.x) UNION ALL SELECT sc.member, tc.member, 'targetInsideSource' FROM sc JOIN tc ON tc.n < sc.n AND contains(sc.x, tc.x))"
B.add("jn18_contained", f"WITH {_SIDES}, {_CUT}, {_INSIDE} SELECT * FROM ins")(lambda a: C.contained(*_sides(a)))
_ASCII = "regexp_replace({0}, '[^ -~]', '?', 'g')"


def _plain(d):
    """Labels with one mark for every character outside ASCII, since the check's edit distance counts bytes."""
    return d.withColumn("pref", F.regexp_replace("pref", r"[^ -~]", "?"))


_EDA, _EDB = FOLD.format(_ASCII.format("s.pref")), FOLD.format(_ASCII.format("t.pref"))
B.add("jn19_near_in_edits", f"WITH {_SIDES} SELECT s.member AS source, t.member AS target, CAST(levenshtein({_EDA}, {_EDB}) AS INT) AS distance FROM s, t WHERE levenshtein({_EDA}, {_EDB}) BETWEEN 1 AND 2 AND {_EDA} <> '' AND {_EDB} <> ''")(
    lambda a: C.near_in_edits(*map(_plain, _sides(a)))
)
# the whole job is done by the queries named ..._unmasked; where DuckDB counts bytes they have no SQL
B.add("jn19_near_in_edits_unmasked")(lambda a: C.near_in_edits(*_sides(a)))
_UP = "up AS (SELECT DISTINCT subject AS a, object AS b FROM atlas_statements WHERE predicate = 'skos:broader')"


def _up(a: Atlas):
    return a.statements.filter("predicate = 'skos:broader'").select(F.col("subject").alias("a"), F.col("object").alias("b")).distinct()


_SIB = "sib AS (SELECT DISTINCT eq.source, k.a AS target FROM eq JOIN up p ON p.a = eq.target JOIN up k ON k.b = p.b WHERE k.a <> eq.target)"
B.add("jn20_siblings", f"WITH {_SIDES}, {_EQ}, {_UP}, {_SIB} SELECT * FROM sib")(lambda a: C.sibling_distractors(C.equal_preferred(*_sides(a)), _up(a)))
_NEAR = f"near AS (SELECT s.member AS source, t.member AS target FROM s, t WHERE levenshtein({_EDA}, {_EDB}) BETWEEN 1 AND 2 AND {_EDA} <> '' AND {_EDB} <> '')"
_INUP = "up AS (SELECT DISTINCT subject AS a, object AS b FROM atlas_statements WHERE predicate = 'skos:broader' AND subject IN (SELECT member FROM t) AND object IN (SELECT member FROM t))"
B.add(
    "cg7_candidate_classes",
    f"""WITH {_SIDES.replace("d.pref", _ASCII.format("d.pref") + " AS pref")}, {_EQ}, {_ANY}, {_CUT}, {_INSIDE}, {_NEAR}, {_INUP}, {_SIB},
    every AS (SELECT source, target, 0 AS c FROM eq UNION ALL SELECT source, target, 1 FROM anyeq UNION ALL SELECT source, target, 2 FROM ins UNION ALL SELECT source, target, 3 FROM near UNION ALL SELECT source, target, 4 FROM sib)
    SELECT source, target, ['normalizedLabelEquality', 'alternateLabelEquality', 'substringNearMiss', 'editDistanceNearMiss', 'siblingDistractor'][min(c) + 1] AS generation_class FROM every GROUP BY ALL""",
)(lambda a: C.candidate_pairs(*map(_plain, _sides(a)), a.labels, _up(a)))
B.add("wn12_class_counts", f"""WITH {_SIDES.replace("d.pref", _ASCII.format("d.pref") + " AS pref")}, {_EQ}, {_ANY}, every AS (SELECT source, target, 0 AS c FROM eq UNION ALL SELECT source, target, 1 FROM anyeq) SELECT c AS class, count(*) AS n FROM (SELECT source, target, min(c) AS c FROM every GROUP BY ALL) GROUP BY 1""")(
    lambda a: _class_counts(a, *map(_plain, _sides(a)))
)
B.add("cg7_candidate_classes_unmasked")(lambda a: C.candidate_pairs(*_sides(a), a.labels, _up(a)))
B.add("wn12_class_counts_unmasked", f"""WITH {_SIDES}, {_EQ}, {_ANY}, every AS (SELECT source, target, 0 AS c FROM eq UNION ALL SELECT source, target, 1 FROM anyeq) SELECT c AS class, count(*) AS n FROM (SELECT source, target, min(c) AS c FROM every GROUP BY ALL) GROUP BY 1""")(
    lambda a: _class_counts(a, *_sides(a))
)


def _class_counts(a: Atlas, s, t):
    equal = C.equal_preferred(s, t)
    claimed = C.claim_classes([("0", equal), ("1", C.equal_any(C.concept_labels(s, a.labels), C.concept_labels(t, a.labels), equal))])
    return claimed.groupBy(F.col("generation_class").cast("int").alias("class")).agg(F.count(F.lit(1)).alias("n"))


# sparse cosine: words, bigrams, the phrase and character 3-grams of preferred (4), alternate (2) and definition (1)
_WEIGHTS = {"preferred": 4, "alternate": 2, "definition": 1}


def _feat(side: str) -> str:
    src = f"SELECT member, pref AS v, 4 AS w FROM {side} UNION ALL SELECT DISTINCT {side}.member, l.value, 2 FROM {side} JOIN atlas_labels l ON l.resource = {side}.member WHERE lower(l.language) = 'en' AND l.value <> {side}.pref UNION ALL SELECT member, definition, 1 FROM {side} WHERE definition IS NOT NULL"
    base = f"SELECT member, v, w, k, array_to_string(k, ' ') AS p FROM (SELECT DISTINCT member, v, w, {TOKS.format(FOLD.format('v'))} AS k FROM ({src})) WHERE len(k) > 0"
    word = "SELECT member, v, w, 'word:' || unnest(k) AS f, 1 AS m, true AS cap FROM b"
    bigram = "SELECT member, v, w, 'bigram:' || unnest(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1])) AS f, 1, false FROM b"
    phrase = "SELECT member, v, w, 'phrase:' || p AS f, 2, false FROM b"
    gram = "SELECT member, v, w, 'char3:' || unnest(list_transform(range(1, length(p) + 3), lambda i: substr('  ' || p || '  ', i, 3))) AS f, 1, true FROM b"
    flat = f"SELECT member, v, w, f, m, cap, count(*) AS n FROM ({word} UNION ALL {bigram} UNION ALL {phrase} UNION ALL {gram}) GROUP BY ALL"
    return f"SELECT member, f AS feature, CAST(sum(w * m * CASE WHEN cap THEN least(n, 3) ELSE n END) AS BIGINT) AS value FROM (WITH b AS ({base}) {flat}) GROUP BY ALL"


_FEAT = f"{_SIDES}, sf AS ({_feat('s')}), tf AS ({_feat('t')})"
_W = f"""{_FEAT}, every AS (SELECT * FROM sf UNION ALL SELECT * FROM tf), n AS (SELECT count(DISTINCT member) AS n FROM every), df AS (SELECT feature, count(*) AS df FROM every GROUP BY 1),
    sw AS (SELECT member, feature, value * greatest(1, ((n + 1) * 1024) // (df + 1)) AS w FROM sf JOIN df USING (feature), n), tw AS (SELECT member, feature, value * greatest(1, ((n + 1) * 1024) // (df + 1)) AS w FROM tf JOIN df USING (feature), n)"""
_SCORE = f"""{_W}, sn AS (SELECT member, sqrt(sum(CAST(w AS DOUBLE) * w)) AS x FROM sw GROUP BY 1), tn AS (SELECT member, sqrt(sum(CAST(w AS DOUBLE) * w)) AS x FROM tw GROUP BY 1),
    score AS (SELECT d.source, d.target, round(d.dot / (sn.x * tn.x), 9) AS score FROM (SELECT sw.member AS source, tw.member AS target, sum(CAST(sw.w AS DOUBLE) * tw.w) AS dot FROM sw JOIN tw USING (feature) GROUP BY ALL) d JOIN sn ON sn.member = d.source JOIN tn ON tn.member = d.target)"""
_TOP = f"""{_SCORE}, fr AS (SELECT source, target, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS source_rank FROM score WHERE score > 0 QUALIFY source_rank <= 5), bk AS (SELECT source, target, row_number() OVER (PARTITION BY target ORDER BY score DESC, source) AS target_rank FROM score WHERE score > 0 QUALIFY target_rank <= 5),
    bi AS (SELECT source, target, source_rank, target_rank FROM fr FULL JOIN bk USING (source, target))"""


def _texts(a: Atlas):
    """Texts of both sides, and the sizes of n-grams."""
    return *[C.concept_texts(d, a.labels, _WEIGHTS) for d in _sides(a)], (3,)


def _features(a: Atlas, texts=_texts):
    *sides, grams = texts(a)
    return tuple(C.text_features(d, grams) for d in sides)


#: Weights of the reference's view over labels and context.
_ALL_WEIGHTS = {"preferred": 12, "alternate": 9, "identifier": 7, "definition": 2, "scope": 3, "parent": 5, "child": 5}


def _all_texts(a: Atlas):
    """Texts of every field, with character 3- and 4-grams."""
    notes = a.resources.select(F.col("id").alias("member"), F.explode("notes").alias("value"))
    return *[C.concept_texts(d, a.labels, _ALL_WEIGHTS, notes, _up(a)) for d in _sides(a)], (3, 4)


def _all_features(a: Atlas):
    return _features(a, _all_texts)


def _scores(a: Atlas, texts=_texts):
    return C.block_pairs(C.feature_blocks(*texts(a)))


def _best(a: Atlas, texts=_texts):
    return C.best_of(C.block_best(C.feature_blocks(*texts(a)), 5), 5)


def _norms(w):
    return w.groupBy("member").agg(F.count(F.lit(1)).alias("features"), F.sum("w").alias("weight"))


def _shared(a: Atlas, texts=_texts):
    return C.block_pairs(C.feature_blocks(*texts(a)), ones=True)


B.add("cg1_features", f"WITH {_FEAT} SELECT * FROM sf")(lambda a: _features(a)[0])
B.add("cg2_weighted", f"WITH {_W} SELECT member, feature, CAST(w AS BIGINT) AS w FROM sw")(lambda a: C.weighted(*_features(a))[0])
B.add("ag17_norms", f"WITH {_W} SELECT member, count(*) AS features, CAST(sum(w) AS BIGINT) AS weight FROM sw GROUP BY 1")(lambda a: _norms(C.weighted(*_features(a))[0]))
B.add("cg3_sparse_scores", f"WITH {_SCORE} SELECT source, target, score FROM score")(_scores)
B.add("cg4_bidirectional", f"WITH {_TOP} SELECT * FROM bi")(_best)
B.add("wn2_top_k", f"WITH {_TOP} SELECT source, target, source_rank AS rank FROM fr")(lambda a: _best(a).filter("source_rank IS NOT NULL").select("source", "target", F.col("source_rank").alias("rank")))
B.add("cg21_mutual_best", f"WITH {_TOP} SELECT source, target FROM bi WHERE source_rank = 1 AND target_rank = 1")(lambda a: C.mutual_best(_best(a)))
B.add("jn22_shared_features", f"WITH {_FEAT} SELECT sf.member AS source, tf.member AS target, count(*) AS n FROM sf JOIN tf USING (feature) GROUP BY ALL")(
    _shared
)
# the whole job: every field and both gram sizes, which the queries above leave out as their SQL does
B.add("cg1_features_all_fields")(lambda a: _all_features(a)[0])
B.add("cg2_weighted_all_fields")(lambda a: C.weighted(*_all_features(a))[0])
B.add("ag17_norms_all_fields")(lambda a: _norms(C.weighted(*_all_features(a))[0]))
B.add("cg3_sparse_scores_all_fields")(lambda a: _scores(a, _all_texts))
B.add("cg4_bidirectional_all_fields")(lambda a: _best(a, _all_texts))
B.add("wn2_top_k_all_fields")(lambda a: _best(a, _all_texts).filter("source_rank IS NOT NULL").select("source", "target", F.col("source_rank").alias("rank")))
B.add("cg21_mutual_best_all_fields")(lambda a: C.mutual_best(_best(a, _all_texts)))
B.add("jn22_shared_features_all_fields")(lambda a: _shared(a, _all_texts))
_IDN = "SELECT DISTINCT r.id AS member, unnest(r.notations) AS identifier FROM atlas_resources r WHERE r.scheme = '{0}'"
B.add("cg5_exact_identifiers", f"WITH s AS ({_IDN.format(SCHEME_A)}), t AS ({_IDN.format(SCHEME_B)}) SELECT s.member AS source, t.member AS target, min(identifier) AS identifier FROM s JOIN t USING (identifier) GROUP BY ALL")(
    lambda a: C.exact_identifiers(*[a.resources.filter(F.col("scheme") == x).select(F.col("id").alias("member"), F.explode("notations").alias("identifier")).distinct() for x in (SCHEME_A, SCHEME_B)])
)
_ANCHOR = "a AS (SELECT DISTINCT subject AS anchor_source, object AS anchor_target FROM atlas_statements WHERE predicate IN ('skos:exactMatch', 'skos:closeMatch'))"
_GN = f"""WITH {_ANCHOR}, {_UP}, e AS (
    SELECT p.b AS source, anchor_target AS target, anchor_source, anchor_target, 'sourceParent-to-target' AS path FROM a JOIN up p ON p.a = anchor_source
    UNION ALL SELECT p.b, q.b, anchor_source, anchor_target, 'sourceParent-to-targetParent' FROM a JOIN up p ON p.a = anchor_source JOIN up q ON q.a = anchor_target
    UNION ALL SELECT p.a, anchor_target, anchor_source, anchor_target, 'sourceChild-to-target' FROM a JOIN up p ON p.b = anchor_source
    UNION ALL SELECT p.a, q.a, anchor_source, anchor_target, 'sourceChild-to-targetChild' FROM a JOIN up p ON p.b = anchor_source JOIN up q ON q.b = anchor_target
    UNION ALL SELECT anchor_source, q.b, anchor_source, anchor_target, 'source-to-targetParent' FROM a JOIN up q ON q.a = anchor_target
    UNION ALL SELECT anchor_source, q.a, anchor_source, anchor_target, 'source-to-targetChild' FROM a JOIN up q ON q.b = anchor_target)
    SELECT source, target, anchor_source, anchor_target, path FROM e WHERE NOT (source = anchor_source AND target = anchor_target) QUALIFY row_number() OVER (PARTITION BY source, target ORDER BY anchor_source, anchor_target, path) = 1"""
B.add("cg6_graph_neighbours", _GN)(lambda a: C.graph_neighbours(a.statements.filter("predicate IN ('skos:exactMatch', 'skos:closeMatch')").select(F.col("subject").alias("source"), F.col("object").alias("target")), _up(a), _up(a)))
_BFS = f"WITH {_UP}, u AS (SELECT a, b FROM up UNION SELECT b, a FROM up), d1 AS (SELECT a, b, 1 AS depth FROM u), d2 AS (SELECT DISTINCT x.a, y.b, 2 AS depth FROM u x JOIN u y ON y.a = x.b) SELECT a, b, CAST(min(depth) AS INT) AS depth FROM (SELECT * FROM d1 UNION ALL SELECT * FROM d2) GROUP BY ALL"
B.add("cg13_bounded_neighbourhood", _BFS)(lambda a: G.reachable(_up(a).unionByName(_up(a).select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), 2))
B.add("cg16_label_anchors", f"WITH l AS (SELECT DISTINCT resource AS m, release, {FOLD.format('value')} AS k FROM atlas_labels WHERE lower(language) = 'en') SELECT DISTINCT x.m AS a, y.m AS b FROM l x JOIN l y ON x.k = y.k AND x.release = y.release WHERE x.m < y.m AND x.k <> ''")(lambda a: _anchors(a))


def _anchors(a: Atlas):
    l = a.labels.filter("lower(language) = 'en'").select(F.col("resource").alias("m"), "release", X.fold_plain("value").alias("k")).distinct().filter("k <> ''")
    return l.withColumnRenamed("m", "a").join(l.withColumnRenamed("m", "b"), ["k", "release"]).filter("a < b").select("a", "b").distinct()


# ---- ranks and vectors --------------------------------------------------------
_VEC = "SELECT q.vec_id AS source, d.vec_id AS target, round(list_cosine_similarity(CAST(q.embedding AS DOUBLE[]), CAST(d.embedding AS DOUBLE[])), 6) AS score FROM embeddings q, embeddings d WHERE q.vec_id % 100 = 0"


def _dense(a: Atlas):
    """Every vector whose id is divisible by 100 against all vectors."""
    v = a.table("embeddings").select(F.col("vec_id").alias("member"), F.col("embedding").alias("vector"))
    return C.dense_scores(v.filter("member % 100 = 0"), v).withColumn("score", F.round("score", 6))


B.add("cg15_dense_scores", _VEC)(_dense)
B.add("wn4_best_ranks", f"WITH v AS ({_VEC}), p AS (SELECT * FROM v WHERE source <> target AND score > 0), f AS (SELECT source, target, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS r FROM p QUALIFY r <= 10), k AS (SELECT source, target, row_number() OVER (PARTITION BY target ORDER BY score DESC, source) AS r FROM p QUALIFY r <= 10) SELECT least(source, target) AS a, greatest(source, target) AS b, min(r) AS rank FROM (SELECT * FROM f UNION ALL SELECT * FROM k) GROUP BY ALL")(
    lambda a: C.best_ranks(materialize(_dense(a)), 10)
)
B.add("wn5_positive_ranks", f"WITH v AS ({_VEC}) SELECT source, target, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS rank FROM v WHERE score > 0 QUALIFY rank <= 10")(lambda a: C.top_k(_dense(a), 10).select("source", "target", "rank"))
B.add("wn9_all_ranks", f"WITH v AS ({_VEC}) SELECT source, target, row_number() OVER (PARTITION BY source ORDER BY score DESC, target) AS rank FROM v QUALIFY rank <= 10")(lambda a: C.top_k(_dense(a), 10, positive=False).select("source", "target", "rank"))
B.add("wn6_max_over_labels", f"WITH v AS ({_VEC}) SELECT v.source, e.label AS target, max(v.score) AS score FROM v JOIN embeddings e ON e.vec_id = v.target GROUP BY ALL")(
    lambda a: C.max_over_labels(_dense(a).join(a.table("embeddings").select(F.col("vec_id").alias("target"), "label"), "target").select("source", F.col("label").alias("target"), "score"))
)
_RES = f"v AS ({_VEC}), p AS (SELECT source, target FROM v WHERE score > 0 QUALIFY row_number() OVER (PARTITION BY source ORDER BY score DESC, target) <= 20), both_ AS (SELECT source AS node, target AS other FROM p WHERE source <> target UNION SELECT target, source FROM p WHERE source <> target), res AS (SELECT node, other FROM both_ QUALIFY row_number() OVER (PARTITION BY node ORDER BY other) <= 10)"
B.add("wn8_reservoir", f"WITH {_RES} SELECT * FROM res")(lambda a: C.reservoir(C.top_k(_dense(a), 20), 10))
B.add("wn7_rerank", f"WITH {_RES} SELECT node, other, row_number() OVER (PARTITION BY node ORDER BY v.score DESC, other) AS rank FROM res JOIN v ON v.source = node AND v.target = other")(lambda a: (lambda d: C.rerank(C.reservoir(C.top_k(d, 20), 10), d))(materialize(_dense(a))))
B.add("wn10_merge_arms", "SELECT subject AS source, object AS target, min(CASE statement_type WHEN 'MappingAssertion' THEN 1 WHEN 'NativeRelationAssertion' THEN 2 ELSE 3 END) AS rank FROM atlas_statements GROUP BY ALL")(
    lambda a: C.merge_arms(a.statements.select(F.col("subject").alias("source"), F.col("object").alias("target"), F.when(F.col("statement_type") == "MappingAssertion", 1).when(F.col("statement_type") == "NativeRelationAssertion", 2).otherwise(3).alias("rank")))
)
B.add("wn11_hierarchy_context", f"WITH {_DISP}, k AS (SELECT subject, list_sort(list_distinct(list(object)))[:5] AS m FROM atlas_statements WHERE predicate = 'skos:broader' GROUP BY 1), f AS (SELECT subject, unnest(m) AS member FROM k) SELECT f.subject, f.member, d.pref FROM f JOIN disp d ON d.resource = f.member")(
    lambda a: a.statements.filter("predicate = 'skos:broader'").groupBy("subject").agg(F.slice(F.array_sort(F.collect_set("object")), 1, 5).alias("m")).select("subject", F.explode("m").alias("member")).join(display_labels(a.labels).select(F.col("resource").alias("member"), F.col("label").alias("pref")), "member")
)
B.add("wn13_seeded_sample")(lambda a: C.seeded_sample(a.resources.select("id").distinct(), "id", 40, "sample:control"))

# ---- text functions -----------------------------------------------------------
_VAL = "SELECT DISTINCT value FROM atlas_labels"


def _values(a: Atlas):
    return a.labels.select("value").distinct()


B.add("sf5_label_fold")(lambda a: _values(a).withColumn("folded", X.fold_label("value")))
B.add("sf5_plain_fold", f"SELECT value, {FOLD.format('value')} AS folded FROM ({_VAL})")(lambda a: _values(a).withColumn("folded", X.fold_plain("value")))
B.add("sf6_tokens", f"SELECT value, array_to_string({TOKS.format(FOLD.format('value'))}, '|') AS tokens FROM ({_VAL})")(lambda a: _values(a).withColumn("tokens", F.array_join(X.word_tokens(X.fold_plain("value")), "|")))
B.add("sf7_camel_tokens", "SELECT DISTINCT statement_type AS value, array_to_string(" + TOKS.format("lower(regexp_replace(statement_type, '([a-z0-9])([A-Z])', '\\1 \\2', 'g'))") + ", '|') AS tokens FROM atlas_statements")(lambda a: a.statements.select(F.col("statement_type").alias("value")).distinct().withColumn("tokens", F.array_join(X.camel_tokens("value"), "|")))
B.add("sf8_identifier_tails", "SELECT DISTINCT id, array_to_string(" + TOKS.format("lower(regexp_replace(split_part(id, ':', -1), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'))") + ", ' ') AS tail FROM atlas_releases WHERE length(replace(array_to_string(" + TOKS.format("lower(regexp_replace(split_part(id, ':', -1), '([a-z0-9])([A-Z])', '\\1 \\2', 'g'))") + ", ' '), ' ', '')) >= 3")(
    lambda a: a.releases.select("id", X.identifier_tail("id").alias("tail")).filter("tail IS NOT NULL").distinct()
)
B.add("sf9_accent_fold", f"SELECT value, strip_accents(value) AS folded FROM ({_VAL})")(lambda a: _values(a).withColumn("folded", strip_accents("value")))
B.add("sf10_char_ngrams", f"SELECT value, array_to_string(CASE WHEN length({FOLD.format('value')}) > 0 THEN list_transform(range(1, length({FOLD.format('value')}) + 3), lambda i: substr('  ' || {FOLD.format('value')} || '  ', i, 3)) ELSE [] END, '|') AS grams FROM ({_VAL})")(lambda a: _values(a).withColumn("grams", F.array_join(X.char_ngrams(X.fold_plain("value"), 3), "|")))
B.add("sf11_trigram_sets", f"SELECT value, array_to_string(list_sort(list_distinct(list_transform(range(1, length({FOLD.format('value')}) + 3), lambda i: substr('^^' || {FOLD.format('value')} || '$$', i, 3)))), '|') AS grams FROM ({_VAL})")(lambda a: _values(a).withColumn("grams", F.array_join(F.array_sort(X.trigram_set(X.fold_plain("value"))), "|")))
B.add("sf12_bigrams", f"SELECT value, array_to_string(list_transform(range(1, len(k)), lambda i: k[i] || ' ' || k[i + 1]), '|') AS pairs FROM (SELECT value, {TOKS.format(FOLD.format('value'))} AS k FROM ({_VAL}))")(lambda a: _values(a).withColumn("pairs", F.array_join(X.bigrams(X.word_tokens(X.fold_plain("value"))), "|")))
B.add("sf13_initials", f"SELECT value, array_to_string(list_transform({TOKS.format(FOLD.format('value'))}, lambda x: substr(x, 1, 1)), '') AS initials FROM ({_VAL})")(lambda a: _values(a).withColumn("initials", X.initials(X.word_tokens(X.fold_plain("value")))))
B.add("sf14_singular", f"WITH w AS (SELECT DISTINCT unnest({TOKS.format(FOLD.format('value'))}) AS word FROM atlas_labels) SELECT word, CASE WHEN regexp_matches(word, '[^aeiou]ies$') THEN regexp_replace(word, 'ies$', 'y') WHEN regexp_matches(word, '(s|x|z|ch|sh)es$') THEN regexp_replace(word, 'es$', '') WHEN regexp_matches(word, '[^sui]s$') AND length(word) > 3 THEN regexp_replace(word, 's$', '') ELSE word END AS singular FROM w")(
    lambda a: a.labels.select(F.explode(X.word_tokens(X.fold_plain("value"))).alias("word")).distinct().withColumn("singular", X.singular(F.col("word")))
)
_PAIR = f"pair AS (SELECT DISTINCT {_ASCII.format('x.value')} AS a, {_ASCII.format('y.value')} AS b FROM atlas_labels x JOIN atlas_labels y ON x.resource = y.resource AND x.value < y.value)"


_TRUE_PAIR = "pair AS (SELECT DISTINCT x.value AS a, y.value AS b FROM atlas_labels x JOIN atlas_labels y ON x.resource = y.resource AND x.value < y.value)"


def _true_pairs(a: Atlas):
    """Different values of one resource, as they are."""
    v = a.labels.select("resource", "value").distinct()
    return v.withColumnRenamed("value", "a").join(v.withColumnRenamed("value", "b"), "resource").filter("a < b").select("a", "b").distinct()


def _pairs(a: Atlas):
    """Different values of one resource, one mark for every character outside ASCII."""
    both = _true_pairs(a).select(F.col("a").alias("x"), F.col("b").alias("y"))
    return both.select(F.regexp_replace("x", r"[^ -~]", "?").alias("a"), F.regexp_replace("y", r"[^ -~]", "?").alias("b")).distinct()

def _jaro_winkler(pairs):
    return pairs.withColumn("score", F.round(X.jaro_winkler("a", "b"), 6))


def _edit_ratio(pairs):
    return pairs.withColumn("score", F.round(X.edit_ratio(F.col("a"), F.col("b")), 6))


def _token_sort(pairs):
    return pairs.withColumn("score", F.round(X.edit_ratio(X.sorted_token_text(X.word_tokens(F.lower("a"))), X.sorted_token_text(X.word_tokens(F.lower("b")))), 6))


def _overlap(pairs):
    j = X.jaccard(X.word_tokens(F.lower("a")), X.word_tokens(F.lower("b")))
    return pairs.withColumn("_j", j).select("a", "b", F.round("_j", 6).alias("score"), X.overlap_band(F.col("_j")).alias("band"))


B.add("sf16_edit_distance", f"WITH {_PAIR} SELECT a, b, CAST(levenshtein(a, b) AS INT) AS distance FROM pair")(lambda a: _pairs(a).withColumn("distance", F.levenshtein("a", "b")))
B.add("sf17_jaro_winkler", f"WITH {_PAIR} SELECT a, b, round(jaro_winkler_similarity(a, b), 6) AS score FROM pair")(lambda a: _jaro_winkler(_pairs(a)))
B.add("sf17_edit_ratio", f"WITH {_PAIR} SELECT a, b, round(CASE WHEN greatest(length(a), length(b)) > 0 THEN 1 - levenshtein(a, b) / greatest(length(a), length(b)) ELSE 1 END, 6) AS score FROM pair")(lambda a: _edit_ratio(_pairs(a)))
B.add("sf17_token_sort", f"WITH {_PAIR}, k AS (SELECT a, b, array_to_string(list_sort({TOKS.format('lower(a)')}), ' ') AS x, array_to_string(list_sort({TOKS.format('lower(b)')}), ' ') AS y FROM pair) SELECT a, b, round(CASE WHEN greatest(length(x), length(y)) > 0 THEN 1 - levenshtein(x, y) / greatest(length(x), length(y)) ELSE 1 END, 6) AS score FROM k")(
    lambda a: _token_sort(_pairs(a))
)
B.add("sf17_token_set")(lambda a: _true_pairs(a).withColumn("score", F.round(X.token_set_ratio(X.word_tokens(F.lower("a")), X.word_tokens(F.lower("b"))), 6)))
_JAC = "CASE WHEN len(list_distinct(list_concat(x, y))) > 0 THEN len(list_intersect(x, y)) / len(list_distinct(list_concat(x, y))) ELSE 0 END"
B.add("sf18_jaccard", f"WITH {_PAIR}, k AS (SELECT a, b, {TOKS.format('lower(a)')} AS x, {TOKS.format('lower(b)')} AS y FROM pair), j AS (SELECT a, b, {_JAC} AS j FROM k) SELECT a, b, round(j, 6) AS score, CASE WHEN j = 0 THEN 'none' WHEN j < 0.34 THEN 'low' WHEN j < 0.67 THEN 'middle' WHEN j < 1 THEN 'high' ELSE 'equal' END AS band FROM j")(
    lambda a: _overlap(_pairs(a))
)
B.add("sf16_edit_distance_unmasked")(lambda a: _true_pairs(a).withColumn("distance", F.levenshtein("a", "b")))
B.add("sf17_jaro_winkler_unmasked")(lambda a: _jaro_winkler(_true_pairs(a)))
B.add("sf17_edit_ratio_unmasked")(lambda a: _edit_ratio(_true_pairs(a)))
B.add("sf17_token_sort_unmasked")(lambda a: _token_sort(_true_pairs(a)))
B.add("sf18_jaccard_unmasked", f"WITH {_TRUE_PAIR}, k AS (SELECT a, b, {TOKS.format('lower(a)')} AS x, {TOKS.format('lower(b)')} AS y FROM pair), j AS (SELECT a, b, {_JAC} AS j FROM k) SELECT a, b, round(j, 6) AS score, CASE WHEN j = 0 THEN 'none' WHEN j < 0.34 THEN 'low' WHEN j < 0.67 THEN 'middle' WHEN j < 1 THEN 'high' ELSE 'equal' END AS band FROM j")(lambda a: _overlap(_true_pairs(a)))
B.add("sf21_extracted_text", "SELECT DISTINCT value, replace(replace(replace(replace(regexp_replace(value, chr(173), '', 'g'), 'ﬀ', 'ff'), 'ﬁ', 'fi'), 'ﬂ', 'fl'), 'ﬃ', 'ffi') AS plain FROM atlas_labels")(lambda a: _values(a).withColumn("plain", X.fold_extracted("value")))
B.add("sf22_stable_ids", "SELECT DISTINCT id, sha256(id || chr(31) || value) AS digest, substr(sha256(id), 1, 2) AS shard FROM atlas_labels")(lambda a: a.labels.select("id", X.stable_id(F.col("id"), F.col("value")).alias("digest"), X.shard_key("id").alias("shard")).distinct())
B.add("sf23_json_lists", "SELECT event_id, try_cast(json_extract(props, '$.k') AS BIGINT) AS k, json_valid(props) AS valid FROM events")(lambda a: a.table("events").select("event_id", F.get_json_object("props", "$.k").cast("bigint").alias("k"), F.try_parse_json("props").isNotNull().alias("valid")))
B.add("sf26_compound_head", f"SELECT DISTINCT value, split_part(value, '-', 1) AS head FROM atlas_labels")(lambda a: _values(a).withColumn("head", F.substring_index("value", "-", 1)))
_DATE = "regexp_matches(trim(asserted_at), '^\\d{4}-\\d{2}-\\d{2}(T\\d{2}:\\d{2}:\\d{2}(\\.\\d+)?(Z|[+-]\\d{2}:\\d{2}))?$')"
B.add("sf27_date_shapes", f"SELECT id, {_DATE} AS valid, regexp_matches(trim(asserted_at), '(Z|[+-]\\d{{2}}:\\d{{2}})$') AND contains(asserted_at, 'T') AS has_offset FROM atlas_statements")(
    lambda a: a.statements.select("id", F.trim("asserted_at").rlike(r"^\d{4}-\d{2}-\d{2}(T\d{2}:\d{2}:\d{2}(\.\d+)?(Z|[+-]\d{2}:\d{2}))?$").alias("valid"), (F.trim("asserted_at").rlike(r"(Z|[+-]\d{2}:\d{2})$") & F.contains("asserted_at", F.lit("T"))).alias("has_offset"))
)
B.add("sf29_search_keys", f"WITH w AS (SELECT DISTINCT unnest({TOKS.format('lower(strip_accents(value))')}) AS word FROM atlas_labels) SELECT word, substr(rpad(word, 2, '_'), 1, 2) AS key FROM w")(lambda a: a.labels.select(F.explode(X.word_tokens(F.lower(strip_accents("value")))).alias("word")).distinct().withColumn("key", X.search_key(F.col("word"))))
B.add("sf32_renderings", f"WITH {_SIDES} SELECT member, concat_ws('. ', pref, definition) AS text FROM s")(lambda a: _sides(a)[0].select("member", F.concat_ws(". ", "pref", "definition").alias("text")))
B.add("sf33_cosine", "SELECT a.vec_id, round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 6) AS score FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")(
    lambda a: a.table("embeddings").select("vec_id", "embedding").join(a.table("embeddings").select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("other")), "vec_id").select("vec_id", F.round(X.cosine(F.col("embedding"), F.col("other")), 6).alias("score"))
)

QUERIES, SQL = B.queries, B.sql
