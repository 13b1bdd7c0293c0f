"""Queries of evaluation, restructuring, sources and sinks."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmesh.functions.keys import strip_key
from lexmesh.functions.text import fisher_exact, wilson
from lexmesh.operators import claims as K
from lexmesh.operators import evaluate as V
from lexmesh.operators.ranks import with_rank
from lexmesh.plans.base import RELEASE, Atlas, Book, digest_sql
from lexmesh.sources import formats, store
from lexmesh.storage import materialize, scratch_dir

B = Book()

# ---- evaluation: verdict rows as pairs; "same" verdicts as gold, a reviewer's order of judging as rank ------------
_GOLD = "gold AS (SELECT DISTINCT row_id AS pair, crosswalk FROM relation_verdicts WHERE best_relation = 'same' AND relation_exists)"
_RANK = "ranked AS (SELECT row_id AS pair, CASE confidence WHEN 'high' THEN 1 WHEN 'medium' THEN 5 ELSE 20 END AS rank, reviewer AS arm, crosswalk FROM relation_verdicts)"


def _gold(a: Atlas):
    return a.table("relation_verdicts").filter("best_relation = 'same' AND relation_exists").select(F.col("row_id").alias("pair"), "crosswalk").distinct()


def _ranked(a: Atlas):
    rank = F.when(F.col("confidence") == "high", 1).when(F.col("confidence") == "medium", 5).otherwise(20)
    return a.table("relation_verdicts").select(F.col("row_id").alias("pair"), rank.alias("rank"), F.col("reviewer").alias("arm"), "crosswalk")


_ARM = "arm LIKE '%-0'"
_BEST = f"best AS (SELECT pair, min(rank) AS rank FROM ranked WHERE {_ARM} GROUP BY 1), k AS (SELECT unnest([1, 5, 10, 20]) AS k)"
B.add("ev1_recall_at", f"WITH {_GOLD}, {_RANK}, {_BEST} SELECT CAST(k AS INT) AS k, count(*) AS gold, count(*) FILTER (rank <= k) AS found, round(count(*) FILTER (rank <= k) / count(*), 9) AS recall, (SELECT count(*) FROM best b WHERE b.rank <= k.k) AS candidates, round((SELECT count(*) FROM best b WHERE b.rank <= k.k) / 100000, 9) AS share FROM gold LEFT JOIN best USING (pair), k GROUP BY ALL")(
    lambda a: V.recall_at(_gold(a).select("pair"), _ranked(a).filter(F.col("arm").endswith("-0")), [1, 5, 10, 20], cartesian=100000)
)
B.add("ev3_recall_by_class", f"WITH {_GOLD}, {_RANK}, {_BEST} SELECT crosswalk, CAST(k AS INT) AS k, count(*) AS gold, count(*) FILTER (rank <= k) AS found, round(count(*) FILTER (rank <= k) / count(*), 9) AS recall FROM gold LEFT JOIN best USING (pair), k GROUP BY ALL")(
    lambda a: V.recall_at(_gold(a), _ranked(a).filter(F.col("arm").endswith("-0")), [1, 5, 10, 20], ["crosswalk"])
)
B.add("ev2_misses", f"WITH {_GOLD}, {_RANK}, {_BEST} SELECT crosswalk, pair, count(*) OVER (PARTITION BY crosswalk) AS n FROM gold WHERE pair NOT IN (SELECT pair FROM best WHERE rank <= 5) QUALIFY row_number() OVER (PARTITION BY crosswalk ORDER BY pair) <= 12")(
    lambda a: V.misses(_gold(a), _ranked(a).filter(F.col("arm").endswith("-0")), 5, "crosswalk")
)
_STAGES = [f"-{i}" for i in (0, 1, 2)]
B.add(
    "ev4_staged_rescues",
    f"WITH {_GOLD}, {_RANK}, e AS ("
    + " UNION ALL ".join(f"SELECT pair, {i} AS stage FROM ranked WHERE arm LIKE '%{s}'" for i, s in enumerate(_STAGES))
    + "), f AS (SELECT pair, min(stage) AS stage FROM e GROUP BY 1), n AS (SELECT stage, count(*) AS c, count(g.pair) AS g FROM f LEFT JOIN (SELECT DISTINCT pair FROM gold) g USING (pair) GROUP BY 1) SELECT CAST(stage AS INT) AS stage, ['-0', '-1', '-2'][stage + 1] AS name, c AS added_candidates, g AS added_gold, round(c / nullif(g, 0), 9) AS candidates_per_gold FROM n",
)(lambda a: V.staged_rescues([(s, _ranked(a).filter(F.col("arm").endswith(s))) for s in _STAGES], _gold(a)))
_HIT = "(coalesce(r_a <= k_a, false) OR coalesce(r_b <= k_b, false))"
_GRID = f"WITH {_GOLD}, {_RANK}, w AS (SELECT pair, min(rank) FILTER (arm LIKE '%-0') AS r_a, min(rank) FILTER (arm LIKE '%-1') AS r_b FROM ranked WHERE arm LIKE '%-0' OR arm LIKE '%-1' GROUP BY 1), g AS (SELECT w.*, gg.pair IS NOT NULL AS is_gold FROM w LEFT JOIN (SELECT DISTINCT pair FROM gold) gg USING (pair)), grid AS (SELECT CAST(k_a AS INT) AS k_a, CAST(k_b AS INT) AS k_b, count(*) FILTER {_HIT.join(['(', ')'])} AS candidates, count(*) FILTER ({_HIT} AND is_gold) AS found FROM g, (SELECT unnest([1, 5, 20]) AS k_a), (SELECT unnest([1, 5, 20]) AS k_b) GROUP BY ALL)"


def _grid(a: Atlas):
    return V.depth_grid({"a": _ranked(a).filter(F.col("arm").endswith("-0")), "b": _ranked(a).filter(F.col("arm").endswith("-1"))}, [1, 5, 20], _gold(a))


B.add("ev5_depth_grid", f"{_GRID} SELECT * FROM grid")(_grid)
B.add("ev6_pareto", f"{_GRID} SELECT g.* FROM grid g WHERE NOT EXISTS (SELECT 1 FROM grid h WHERE h.candidates <= g.candidates AND h.found >= g.found AND (h.candidates < g.candidates OR h.found > g.found))")(lambda a: V.pareto(materialize(_grid(a)), "candidates", "found"))


def _options(a: Atlas):
    return _ranked(a).filter("rank <= 5").select(F.col("arm").alias("option"), "pair")


B.add("ev7_greedy_cover")(lambda a: a.spark.createDataFrame([(i, *x) for i, x in enumerate(V.greedy_cover(materialize(_options(a).join(_gold(a).select("pair").distinct(), "pair", "left_semi")), _gold(a)))], "step int, option string, added long, total long"))
B.add("ev9_signatures", f"WITH {_RANK} SELECT signature, count(*) AS pairs FROM (SELECT pair, string_agg(DISTINCT arm, '|' ORDER BY arm) AS signature FROM ranked WHERE rank <= 5 GROUP BY 1) GROUP BY 1")(lambda a: V.signatures(_options(a)))


def _cover(a: Atlas):
    """Least-cost cover, by all reviewers, of the gold that any of them ranks within the stated depth; costs are their candidates."""
    opts = materialize(_options(a))
    gold = opts.join(_gold(a).select("pair").distinct(), "pair", "left_semi")
    cost = {r["option"]: r["n"] for r in opts.groupBy("option").agg(F.count_distinct("pair").alias("n")).collect()}
    sig = {r["signature"]: r["pairs"] for r in V.signatures(gold).collect()}
    holds: dict[str, set[str]] = {o: set() for o in cost}
    for s in sig:
        for o in s.split("|"):
            holds[o].add(s)
    found = V.cheapest_cover({o: (n, frozenset(holds[o])) for o, n in cost.items()}, {o: o for o in cost}, sig)
    return a.spark.createDataFrame([(o, cost[o]) for o in (found[1] if found else [])], "option string, cost long")


B.add("ev8_cheapest_cover")(_cover)
_T = "t AS (SELECT DISTINCT row_id AS pair FROM relation_verdicts), e AS (SELECT DISTINCT row_id AS pair FROM relation_verdicts WHERE best_relation = 'near_same'), b AS (SELECT DISTINCT row_id AS pair FROM relation_verdicts WHERE best_relation = 'related')"
B.add("ev10_triage", f"WITH {_GOLD}, {_T} SELECT CASE WHEN pair IN (SELECT pair FROM gold) THEN 'gold' WHEN pair IN (SELECT pair FROM e) THEN 'entailed' WHEN pair IN (SELECT pair FROM b) THEN 'sibling' ELSE 'neither' END AS verdict, count(*) AS n FROM t GROUP BY 1")(
    lambda a: V.triage(_ranked(a), _gold(a), *[a.table("relation_verdicts").filter(F.col("best_relation") == x).select(F.col("row_id").alias("pair")) for x in ("near_same", "related")])
)
_SAME = "coalesce(best_relation = 'same', false)"


def _wilson(h: str, n: str, sign: str) -> str:
    return f"round(({h} / {n} + 1.9208 / {n} {sign} 1.96 * sqrt({h} / {n} * (1 - {h} / {n}) / {n} + 0.9604 / ({n} * {n}))) / (1 + 3.8416 / {n}), 9)"


B.add("ev13_rates", f"WITH n AS (SELECT crosswalk, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER ({_SAME}) AS DOUBLE) AS h FROM relation_verdicts GROUP BY 1), w AS (SELECT sum(h) / sum(n) AS base FROM n) SELECT crosswalk, CAST(n AS BIGINT) AS n, CAST(h AS BIGINT) AS hits, round(h / n, 9) AS rate, {_wilson('h', 'n', '-')} AS low, {_wilson('h', 'n', '+')} AS high, round(h / n / base, 9) AS lift FROM n, w")(
    lambda a: V.rates(a.table("relation_verdicts"), ["crosswalk"], F.coalesce(F.col("best_relation") == "same", F.lit(False)))
)
B.add("sf30_wilson", f"WITH n AS (SELECT reviewer, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER ({_SAME}) AS DOUBLE) AS h FROM relation_verdicts GROUP BY 1) SELECT reviewer, {_wilson('h', 'n', '-')} AS low, {_wilson('h', 'n', '+')} AS high FROM n")(
    lambda a: (lambda d: d.select("reviewer", F.round(wilson(F.col("h"), F.col("n"))[0], 9).alias("low"), F.round(wilson(F.col("h"), F.col("n"))[1], 9).alias("high")))(a.table("relation_verdicts").groupBy("reviewer").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("best_relation") == "same", F.lit(False))).alias("h")))
)
B.add("sf31_fisher_exact")(
    lambda a: a.table("relation_verdicts").filter("relation_exists IS NOT NULL AND confidence IS NOT NULL").groupBy("reviewer").agg(*[F.count_if((F.col("relation_exists") == x) & ((F.col("confidence") == "high") == y)).alias(n) for n, x, y in (("a", True, True), ("b", True, False), ("c", False, True), ("d", False, False))]).withColumn("p_value", F.round(fisher_exact("a", "b", "c", "d"), 9))
)
_LR = "n AS (SELECT basis_of_association, count(*) FILTER (relation_exists) AS t, count(*) FILTER (NOT relation_exists) AS f FROM relation_verdicts GROUP BY 1)"
B.add("ev12_likelihood_ratios", f"WITH {_LR} SELECT basis_of_association, t AS true, f AS false, round((t / nullif((SELECT sum(t) FROM n), 0)) / nullif(f / nullif((SELECT sum(f) FROM n), 0), 0), 9) AS ratio FROM n")(lambda a: V.likelihood_ratios(a.table("relation_verdicts"), "basis_of_association", F.col("relation_exists")))
_TWO = "p AS (SELECT x.row_id, x.best_relation AS a, y.best_relation AS b FROM (SELECT row_id, min(best_relation) AS best_relation FROM relation_verdicts WHERE reviewer LIKE '%-0' GROUP BY 1) x JOIN (SELECT row_id, min(best_relation) AS best_relation FROM relation_verdicts WHERE reviewer LIKE '%-1' GROUP BY 1) y USING (row_id))"


def _two(a: Atlas):
    v = a.table("relation_verdicts")
    x, y = (v.filter(F.col("reviewer").endswith(s)).groupBy("row_id").agg(F.min("best_relation").alias(n)) for s, n in (("-0", "a"), ("-1", "b")))
    return x.join(y, "row_id")


B.add(
    "ev15_agreement",
    f"WITH {_TWO}, q AS (SELECT a, b FROM p WHERE a IS NOT NULL AND b IS NOT NULL), n AS (SELECT count(*) AS n, count(*) FILTER (a = b) AS e FROM q), c AS (SELECT sum(x.n * y.n) AS c FROM (SELECT a AS v, count(*) AS n FROM q GROUP BY 1) x JOIN (SELECT b AS v, count(*) AS n FROM q GROUP BY 1) y USING (v)) SELECT n, e AS equal, round(e / n, 9) AS agreement, round((e / n - c / (n * n)) / (1 - c / (n * n)), 9) AS kappa FROM n, c",
)(lambda a: V.agreement(_two(a), "a", "b"))
B.add("ev15_contingency", f"WITH {_TWO} SELECT a, b, count(*) AS n FROM p GROUP BY ALL")(lambda a: V.contingency(_two(a), "a", "b"))
B.add("ev16_flips", f'WITH {_TWO} SELECT a AS "from", b AS "to", count(*) AS n FROM p GROUP BY ALL')(lambda a: V.flips(_two(a).select("row_id", F.col("a").alias("v")), _two(a).select("row_id", F.col("b").alias("v")), ["row_id"], "v"))
B.add("ev17_confusion", f"WITH {_TWO}, n AS (SELECT b, CAST(count(*) AS DOUBLE) AS n, CAST(count(*) FILTER (a = b) AS DOUBLE) AS h FROM p GROUP BY 1) SELECT b, CAST(n AS BIGINT) AS n, CAST(h AS BIGINT) AS right, round(h / n, 9) AS precision, {_wilson('h', 'n', '-')} AS low, {_wilson('h', 'n', '+')} AS high FROM n")(lambda a: V.confusion(_two(a), "a", "b"))
B.add("ev18_stratified_sample", "WITH t AS (SELECT DISTINCT row_id, crosswalk FROM relation_verdicts) SELECT crosswalk, row_id, count(*) OVER (PARTITION BY crosswalk) AS eligible, CAST(least(count(*) OVER (PARTITION BY crosswalk), 20) AS BIGINT) AS sampled FROM t QUALIFY row_number() OVER (PARTITION BY crosswalk ORDER BY sha256(CAST(row_id AS VARCHAR))) <= 20")(
    lambda a: V.stratified_sample(a.table("relation_verdicts").select("row_id", "crosswalk").distinct(), "crosswalk", F.col("row_id").cast("string"), 20).withColumn("sampled", F.col("sampled").cast("long"))
)
B.add("ev18_short_strata", "SELECT reviewer, count(*) AS n FROM relation_verdicts GROUP BY 1 HAVING count(*) < 60")(lambda a: V.short_strata(a.table("relation_verdicts"), "reviewer", 60))
B.add("ev21_grouped_yield", f"SELECT crosswalk, confidence, count(*) AS n, count(*) FILTER ({_SAME}) AS potential, round(count(*) FILTER ({_SAME}) / count(*), 9) AS rate FROM relation_verdicts GROUP BY ALL")(
    lambda a: a.table("relation_verdicts").groupBy("crosswalk", "confidence").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.col("best_relation") == "same", F.lit(False))).alias("potential")).withColumn("rate", F.round(F.col("potential") / F.col("n"), 9))
)
B.add("ev22_blind_review", "SELECT crosswalk, count(*) AS n, count(*) FILTER (relation_exists) AS supported, count(*) FILTER (confidence = 'low' AND NOT relation_exists) AS controls_rejected FROM relation_verdicts GROUP BY 1")(
    lambda a: a.table("relation_verdicts").groupBy("crosswalk").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("relation_exists")).alias("supported"), F.count_if((F.col("confidence") == "low") & ~F.col("relation_exists")).alias("controls_rejected"))
)
_IDKIND = "v AS (SELECT DISTINCT scheme AS kind, unnest(notations) AS value, id FROM atlas_resources)"
B.add("jn24_roster_identifiers", f"WITH {_IDKIND} SELECT l.kind AS kind_1, r.kind AS kind_2, count(*) AS edges, count(DISTINCT l.value) AS \"values\" FROM v l JOIN v r ON l.value = r.value AND l.kind < r.kind GROUP BY ALL")(
    lambda a: (lambda v: v.select("value", F.col("kind").alias("kind_1"), F.col("id").alias("i1")).join(v.select("value", F.col("kind").alias("kind_2"), F.col("id").alias("i2")), "value").filter("kind_1 < kind_2").groupBy("kind_1", "kind_2").agg(F.count(F.lit(1)).alias("edges"), F.count_distinct("value").alias("values")))(a.resources.select(F.col("scheme").alias("kind"), F.explode("notations").alias("value"), "id").distinct())
)
B.add("jn27_sealed_key", "SELECT v.row_id, v.reviewer, k.scheme FROM (SELECT DISTINCT row_id, reviewer FROM relation_verdicts) v JOIN (SELECT scheme, row_number() OVER (ORDER BY scheme) AS n FROM (SELECT DISTINCT scheme FROM atlas_resources)) k ON k.n = v.row_id % 7")(
    lambda a: a.table("relation_verdicts").select("row_id", "reviewer").distinct().withColumn("n", F.col("row_id") % 7).join(_numbered(a), "n").select("row_id", "reviewer", "scheme")
)


def _numbered(a: Atlas):
    return with_rank(a.resources.select("scheme").distinct(), ["scheme"], "_n").select("scheme", (F.col("_n") + 1).alias("n"))


B.add("jn29_label_policy", "WITH o AS (SELECT value, min(resource) AS r FROM atlas_labels WHERE label_role = 'preferred' GROUP BY 1), v AS (SELECT replace(lower(value), 'ς', 'σ') AS value, min(resource) AS r, count(DISTINCT resource) AS n FROM atlas_labels WHERE label_role <> 'preferred' GROUP BY 1), q AS (SELECT DISTINCT value FROM atlas_labels) SELECT q.value, CASE WHEN o.r IS NOT NULL THEN 'official' WHEN v.n = 1 THEN 'variant' WHEN v.n > 1 THEN 'open' ELSE 'unresolved' END AS outcome, CASE WHEN o.r IS NOT NULL THEN o.r WHEN v.n = 1 THEN v.r END AS target FROM q LEFT JOIN o USING (value) LEFT JOIN v ON v.value = replace(lower(q.value), 'ς', 'σ')")(
    lambda a: _policy(a)
)


def _policy(a: Atlas):
    o = a.labels.filter("label_role = 'preferred'").groupBy("value").agg(F.min("resource").alias("o"))
    v = a.labels.filter("label_role <> 'preferred'").groupBy(F.replace(F.lower("value"), F.lit("ς"), F.lit("σ")).alias("_k")).agg(F.min("resource").alias("v"), F.count_distinct("resource").alias("n"))
    both = a.labels.select("value").distinct().join(o, "value", "left").withColumn("_k", F.replace(F.lower("value"), F.lit("ς"), F.lit("σ"))).join(v, "_k", "left")
    outcome = F.when(F.col("o").isNotNull(), "official").when(F.col("n") == 1, "variant").when(F.col("n") > 1, "open").otherwise("unresolved")
    return both.select("value", outcome.alias("outcome"), F.when(F.col("o").isNotNull(), F.col("o")).when(F.col("n") == 1, F.col("v")).alias("target"))


# ---- restructuring ------------------------------------------------------------
_FACTS = """claim AS (SELECT id AS subject, 'inScheme' AS predicate, 'iri' AS object_kind, scheme AS value, NULL AS language FROM atlas_resources
    UNION SELECT id, 'definition', 'literal', definition, NULL FROM atlas_resources WHERE definition IS NOT NULL UNION SELECT id, 'note', 'literal', unnest(notes), NULL FROM atlas_resources
    UNION SELECT id, 'notation', 'literal', unnest(notations), NULL FROM atlas_resources UNION SELECT resource, label_role || 'Label', 'literal', value, language FROM atlas_labels)"""
B.add("in3_to_claims", f"WITH {_FACTS} SELECT * FROM claim")(lambda a: K.to_claims(a.resources, a.labels))


def _vals(p: str) -> str:
    return f"coalesce(list_sort(list_distinct(list(trim(value, ' ')) FILTER (predicate = '{p}' AND (language IS NULL OR lower(trim(language)) = '' OR regexp_matches(lower(trim(language)), '^en([-_].*)?$'))))), [])"


B.add("in1_from_claims", f"WITH {_FACTS}, w AS (SELECT subject AS id, min(value) FILTER (predicate = 'inScheme') AS scheme, {_vals('preferredLabel')} AS p, {_vals('alternateLabel')} AS a, {_vals('notation')} AS n, {_vals('definition')} AS d, {_vals('note')} AS o FROM claim GROUP BY 1) SELECT id, scheme, p[1] AS preferred, array_to_string(a, '|') AS alternates, array_to_string(n, '|') AS notations, d[1] AS definition, array_to_string(list_sort(list_concat(o, d[2:])), '|') AS notes FROM w WHERE scheme IS NOT NULL")(
    lambda a: K.from_claims(K.to_claims(a.resources, a.labels), "inScheme")
)
B.add("pf14_claim_text", f"WITH {_FACTS} SELECT subject, array_to_string({_vals('preferredLabel')}, '|') AS texts FROM claim GROUP BY 1")(
    lambda a: (lambda c: c.groupBy("subject").agg(F.array_join(F.array_sort(F.collect_set(F.when((F.col("predicate") == "preferredLabel") & _family(), F.trim("value")))), "|").alias("texts")))(K.to_claims(a.resources, a.labels))
)


def _family():
    from lexmesh.functions.labels import english_family

    return english_family("language", True)


B.add("in2_claim_relations", "SELECT DISTINCT subject, CASE predicate WHEN 'skos:broader' THEN 'broader' ELSE 'related' END AS predicate, object FROM atlas_statements WHERE predicate IN ('skos:broader', 'skos:related') AND subject IN (SELECT id FROM atlas_resources) AND object IN (SELECT id FROM atlas_resources)")(
    lambda a: K.claim_relations(a.statements.select("subject", "predicate", F.lit("iri").alias("object_kind"), F.col("object").alias("value")), a.resources, {"skos:broader": "broader", "skos:related": "related"})
)
B.add("in5_release_digests", f"SELECT release, count(*) AS claims, {digest_sql('concat_ws(chr(31), ' + ', '.join(f'coalesce({c}, chr(30))' for c in ('language', 'release', 'resource', 'value')) + ')')} AS digest FROM atlas_labels GROUP BY 1")(lambda a: K.release_digests(a.labels.select("release", "resource", "value", "language"), "release"))
B.add("in7_language_audit", "SELECT language, count(*) AS labels, count(DISTINCT resource) AS resources, bool_or(regexp_matches(lower(trim(language)), '^en([-_].*)?$')) AS english FROM atlas_labels GROUP BY 1")(lambda a: K.language_audit(a.labels))
_UNITS = ("urn:vx:scheme:brineworks", "urn:vx:scheme:lodestar", "urn:vx:scheme:nowhere")
B.add("in8_unit_selection", f"SELECT scheme, count(*) AS rows, scheme IN {_UNITS} AS selected FROM atlas_resources GROUP BY 1")(lambda a: K.unit_selection(a.resources, "scheme", _UNITS))
B.add("in8_unknown_units", "SELECT 'urn:vx:scheme:nowhere' AS scheme")(lambda a: K.unknown_units(a.resources, "scheme", _UNITS))
B.add("in9_owner_dependencies", "WITH o AS (SELECT DISTINCT id, release FROM atlas_resources) SELECT s.release AS owner, t.release AS needs, count(*) AS edges FROM atlas_statements x JOIN o s ON s.id = x.subject JOIN o t ON t.id = x.object WHERE s.release <> t.release GROUP BY ALL")(lambda a: K.owner_dependencies(a.statements, a.resources))
B.add("in10_pivot_subjects", "SELECT subject, " + ", ".join(f"coalesce(string_agg(DISTINCT object, '|' ORDER BY object) FILTER (predicate = 'skos:{p}'), '') AS {p}" for p in ("broader", "narrower", "related")) + " FROM atlas_statements GROUP BY 1")(lambda a: K.pivot_subjects(a.statements, ["skos:broader", "skos:narrower", "skos:related"]))
_MAP = {"exactmatch": "skos:exactMatch", "closematch": "skos:closeMatch", "broadmatch": "skos:broadMatch", "narrowmatch": "skos:narrowMatch", "relatedmatch": "skos:relatedMatch"}
B.add("in13_relation_map", "SELECT id, CASE lower(regexp_replace(regexp_replace(relation, '^.*[:#/]', ''), '[\\s_-]+', '', 'g')) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in _MAP.items()) + " END AS mapped FROM mapping_assertions")(lambda a: K.map_relations(a.table("mapping_assertions"), "relation", _MAP).select("id", "mapped"))
B.add("in15_spread_positions", "WITH r AS (SELECT release, id, count(*) OVER (PARTITION BY release) AS n, row_number() OVER (PARTITION BY release ORDER BY id) - 1 AS i FROM (SELECT DISTINCT release, id FROM atlas_resources)) SELECT release, id FROM r WHERE i IN (0, (n - 1) // 4, 2 * (n - 1) // 4, 3 * (n - 1) // 4, n - 1)")(lambda a: K.spread_positions(a.resources.select("release", "id").distinct(), "release", "id"))
B.add("in11_supersession_records", "SELECT id, lead(id) OVER (PARTITION BY scheme ORDER BY identifier, id) AS superseded_by FROM atlas_releases QUALIFY superseded_by IS NOT NULL")(lambda a: K.supersession_records(a.releases, "identifier"))
_DG = "SELECT id, min(content_digest) AS d FROM {0} WHERE release LIKE '%:r{1}' GROUP BY 1"
B.add("st10_digest_reconcile", f"SELECT id, CASE WHEN r.id IS NULL THEN 'left only' WHEN l.id IS NULL THEN 'right only' WHEN l.d IS NOT DISTINCT FROM r.d THEN 'equal' ELSE 'differs' END AS state FROM ({_DG.format('resource_snapshots', 1)}) l FULL JOIN ({_DG.format('resource_snapshots', 2)}) r USING (id)")(
    lambda a: K.reconcile_digests(*[a.table("resource_snapshots").filter(F.col("release").endswith(f":r{i}")).groupBy("id").agg(F.min("content_digest").alias("d")) for i in (1, 2)], "id", "d")
)
B.add("cg18_resolved_projection", "WITH d AS (SELECT trim(source_concept, ' ' || chr(9) || chr(10)) AS k, min(trim(target_concept, ' ' || chr(9) || chr(10))) AS t, count(*) AS n FROM mapping_assertions WHERE lifecycle_status = 'current' GROUP BY 1) SELECT r.id, d.t AS target, coalesce(d.n, 0) AS evidence, CASE WHEN d.k IS NULL THEN 'unresolved' ELSE 'resolved' END AS state FROM (SELECT DISTINCT id FROM atlas_resources) r LEFT JOIN d ON d.k = r.id")(
    lambda a: a.resources.select("id").distinct().join(_adopted(a), "id", "left").select("id", "target", F.coalesce("n", F.lit(0)).alias("evidence"), F.when(F.col("n").isNull(), "unresolved").otherwise("resolved").alias("state"))
)


def _adopted(a: Atlas):
    return a.table("mapping_assertions").filter("lifecycle_status = 'current'").groupBy(strip_key("source_concept").alias("id")).agg(F.min(strip_key("target_concept")).alias("target"), F.count(F.lit(1)).alias("n"))


# ---- sources and sinks: written to the shared folder and read back ------------
def _out(a: Atlas, name: str) -> str:
    return f"{scratch_dir(a.spark)}/{name}"


def _written(a: Atlas, name: str, write) -> str:
    path = _out(a, name)
    write(path)
    return path


def _views(a: Atlas):
    store.open_views(a.spark, {n: f"{a.path}/atlas_{n}.parquet" for n in ("resources", "labels", "statements")})
    return a.spark


B.add("sc1_views", f"SELECT count(*) AS n, count(DISTINCT id) AS ids FROM atlas_resources WHERE release = '{RELEASE}'")(lambda a: store.ad_hoc(_views(a), "SELECT count(*) AS n, count(DISTINCT id) AS ids FROM atlas_resources WHERE release = ?", [RELEASE]))
B.add("pf1_parameterised_sql", "SELECT label_role, count(*) AS n FROM atlas_labels WHERE lower(language) = 'en' AND length(value) > 10 GROUP BY 1")(lambda a: store.ad_hoc(_views(a), "SELECT label_role, count(*) AS n FROM atlas_labels WHERE lower(language) = ? AND length(value) > ? GROUP BY 1", ["en", 10]))
B.add("sc3_discovered_columns", "SELECT source_concept AS subject, relation AS predicate, target_concept AS object, CAST(NULL AS VARCHAR) AS rule FROM mapping_assertions")(
    lambda a: store.discover(a.table("mapping_assertions"), {"subject": ("subject", "source_concept"), "predicate": ("predicate", "relation"), "object": ("object", "target_concept"), "rule": ("derivation_rule",)}, ("subject", "predicate", "object"))
)
B.add("sc4_projected_scan", "SELECT id, semantic_ring FROM atlas_resources")(lambda a: a.resources.select("id", "semantic_ring"))
B.add("sc5_set_filter", "SELECT id FROM atlas_labels WHERE resource IN (SELECT subject FROM atlas_statements WHERE predicate = 'vx:about')")(lambda a: a.labels.join(a.statements.filter("predicate = 'vx:about'").select(F.col("subject").alias("resource")), "resource", "left_semi").select("id"))
B.add("sc8_text_table", "SELECT id, record_status, to_json(notations) AS notations FROM atlas_resources")(lambda a: a.spark.read.parquet(_written(a, "sc8", lambda p: store.write_text_table(a.resources.select("id", "record_status", "notations"), p))))
B.add("sk1_typed_table", "SELECT id, release, scheme, semantic_ring, resource_profile, source_record, definition, record_status FROM atlas_resources")(
    lambda a: a.spark.read.parquet(_written(a, "sk1", lambda p: store.write_records(a.resources, "resources", p))).select("id", "release", "scheme", "semantic_ring", "resource_profile", "source_record", "definition", "record_status")
)
B.add("sk2_search_view", "SELECT id, resource, label_role, value, language, release, source_record FROM atlas_labels")(lambda a: a.spark.read.parquet(_written(a, "sk2", lambda p: store.write_search_view(a.labels, "labels", p))))
_NQ = "SELECT trim(resource, ' ' || chr(9) || chr(10)) AS subject, 'urn:vx:' || label_role AS predicate, value AS object, 'literal' AS object_kind, CASE WHEN regexp_matches(language, '^[A-Za-z0-9-]+$') THEN language END AS language, release AS graph FROM atlas_labels"


def _quads(a: Atlas):
    tag = F.when(F.col("language").rlike("^[A-Za-z0-9-]+$"), F.col("language"))
    return a.labels.select(strip_key("resource").alias("subject"), F.concat(F.lit("urn:vx:"), "label_role").alias("predicate"), F.col("value").alias("object"), F.lit("literal").alias("object_kind"), tag.alias("language"), F.col("release").alias("graph"))


B.add("sc9_nquads_scan", f"SELECT DISTINCT subject, predicate, object, object_kind, language, graph FROM ({_NQ}) WHERE predicate = 'urn:vx:preferred'")(
    lambda a: formats.read_nquads(a.spark, _written(a, "sc9", lambda p: formats.to_nquads(_quads(a)).write.mode("overwrite").option("compression", "gzip").text(p)), ["urn:vx:preferred"]).select("subject", "predicate", "object", "object_kind", "language", "graph").distinct()
)
B.add("sc10_nquads_parse", f"SELECT DISTINCT subject, predicate, object, object_kind, language, graph FROM ({_NQ})")(lambda a: formats.parse_nquads(formats.to_nquads(_quads(a))).select("subject", "predicate", "object", "object_kind", "language", "graph").distinct())
B.add("sk5_sorted_lines", f"SELECT count(*) AS lines FROM (SELECT DISTINCT subject, predicate, object, language, graph FROM ({_NQ}))")(lambda a: store.write_sorted_text(formats.to_nquads(_quads(a)), _out(a, "sk5"), 4).agg(F.sum("lines").alias("lines")))
B.add("so4_external_sort", "SELECT value, row_number() OVER (ORDER BY value) - 1 AS position FROM (SELECT DISTINCT value FROM atlas_labels)")(lambda a: with_rank(a.labels.select("value").distinct(), ["value"], "position"))
B.add("sk6_record_shards", "SELECT substr(sha256(id), 1, 2) AS shard, count(*) AS n FROM (SELECT DISTINCT id FROM atlas_resources) GROUP BY 1")(
    lambda a: a.spark.read.schema("id string, shard string").json(_written(a, "sk6", lambda p: store.write_shards(a.resources.select("id").distinct(), "id", p))).groupBy("shard").agg(F.count(F.lit(1)).alias("n"))
)
B.add("sk6_catalog_pages")(lambda a: store.catalog_pages(a.labels.select("id", F.col("value").alias("label")), 50))
B.add("sc12_jsonl", "SELECT row_id, reviewer, best_relation FROM relation_verdicts")(lambda a: formats.read_jsonl(a.spark, _written(a, "sc12", lambda p: a.table("relation_verdicts").select("row_id", "reviewer", "best_relation").write.mode("overwrite").json(p)), "row_id long, reviewer string, best_relation string"))
B.add("sc11_csv", "SELECT keyword_version, revision, CAST(root_count AS VARCHAR) AS root_count FROM gcmd_hierarchies")(lambda a: formats.read_csv(a.spark, _written(a, "sc11", lambda p: a.table("gcmd_hierarchies").select("keyword_version", "revision", "root_count").write.mode("overwrite").option("header", True).csv(p))))
B.add("sc11_xml", "SELECT n_nationkey, n_name FROM nation")(lambda a: formats.read_xml(a.spark, _written(a, "scx", lambda p: a.table("nation").select("n_nationkey", "n_name").coalesce(1).write.mode("overwrite").format("xml").option("rowTag", "nation").save(p)), "nation", "n_nationkey int, n_name string"))
B.add("sc13_claim_release")(lambda a: K.release_digests(K.to_claims(a.resources, a.labels).withColumn("release_id", F.lit("one")), "release_id"))
B.add("sc14_identity_links", "SELECT m.id, s AS old FROM mapping_assertions m, unnest(m.supersedes) AS t(s)")(lambda a: a.table("mapping_assertions").select("id", F.explode("supersedes").alias("old")))
B.add("pf13_retired", "SELECT id FROM atlas_resources WHERE NOT coalesce(lower(trim(record_status)) IN ('deprecated', 'superseded', 'withdrawn', 'removed', 'tombstone'), false)")(lambda a: a.resources.filter(~F.coalesce(F.lower(F.trim("record_status")).isin("deprecated", "superseded", "withdrawn", "removed", "tombstone"), F.lit(False))).select("id"))
B.add("pf15_ring_filter", "SELECT id FROM atlas_statements WHERE coalesce(semantic_ring, source_ring) = 'subject'")(lambda a: a.statements.filter(F.coalesce("semantic_ring", "source_ring") == "subject").select("id"))
B.add("jn21_first_identifier", "SELECT id, list_sort(notations)[1] AS first FROM atlas_resources WHERE len(notations) > 0")(lambda a: a.resources.filter(F.size("notations") > 0).select("id", F.get(F.array_sort("notations"), F.lit(0)).alias("first")))
B.add("jn28_lineage_binding", "SELECT m.id, e.evidence, CAST(e.n AS INT) AS position FROM mapping_assertions m, unnest(m.evidence) WITH ORDINALITY AS e(evidence, n) WHERE m.source_release IN (SELECT id FROM atlas_releases)")(
    lambda a: a.table("mapping_assertions").join(a.releases.select(F.col("id").alias("source_release")).distinct(), "source_release", "left_semi").select("id", F.posexplode("evidence").alias("p", "evidence")).select("id", "evidence", (F.col("p") + 1).alias("position"))
)
QUERIES, SQL = B.queries, B.sql
