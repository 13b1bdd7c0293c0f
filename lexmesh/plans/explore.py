"""Queries of the query API: facets, overview, release graph, neighbourhood, search, look-up, coverage."""

from __future__ import annotations

from pyspark.sql import functions as F

from lexmesh.functions.labels import active, display_labels, english, english_family, local_name, ranked_labels, short_name
from lexmesh.operators import explore as X
from lexmesh.operators.search import bm25, postings, search, search_documents
from lexmesh.plans.base import IDENTIFIERS, LOCAL, RELEASE, RESCISSIONS, ROLE, SOURCE_RECORDS, Book, shown

B = Book()

B.add("jn1_release_counts", "SELECT r.id, r.identifier, r.semantic_ring AS ring, count(s.id) AS count FROM atlas_releases r LEFT JOIN atlas_resources s ON s.release = r.id WHERE r.release_type = 'AtlasRelease' GROUP BY ALL")(
    lambda a: X.release_counts(a.releases, a.resources)
)
B.add("ag1_ring_counts", "SELECT semantic_ring AS id, count(*) AS count FROM atlas_resources GROUP BY 1")(lambda a: X.ring_counts(a.resources))
B.add("st1_endpoints", "SELECT subject AS id FROM atlas_statements WHERE statement_type <> 'SourceAssignment' UNION ALL SELECT object FROM atlas_statements WHERE statement_type <> 'SourceAssignment'")(lambda a: X.relation_endpoints(a.statements))
_DEGREE = "degree AS (SELECT id, count(*) AS degree FROM (SELECT subject AS id FROM atlas_statements WHERE statement_type <> 'SourceAssignment' UNION ALL SELECT object FROM atlas_statements WHERE statement_type <> 'SourceAssignment') GROUP BY id)"
_START = f"""{_DEGREE}, start AS (SELECT id, degree FROM degree ORDER BY CASE WHEN degree BETWEEN 18 AND 48 THEN 0 ELSE 1 END,
    CASE WHEN degree BETWEEN 18 AND 48 AND starts_with(id, 'urn:vx:resource:') THEN 0 ELSE 1 END, degree DESC, id DESC LIMIT 1)"""
B.add("ag2_degrees", f"WITH {_DEGREE} SELECT id, degree FROM degree")(lambda a: X.degrees(a.statements))
B.add("so3_start_node", f"WITH {_START} SELECT id, degree FROM start")(lambda a: X.start_node(a.statements))
B.add("pf2_active_resources", f"SELECT id, record_status FROM atlas_resources WHERE {shown('record_status')}")(lambda a: a.resources.filter(active("record_status")).select("id", "record_status"))
B.add("pf3_release_filter", f"SELECT id FROM atlas_resources WHERE release IN ('{RELEASE}', 'urn:vx:release:lodestar:r1')")(lambda a: a.resources.filter(F.col("release").isin(RELEASE, "urn:vx:release:lodestar:r1")).select("id"))
B.add("pf4_ring_filter", "SELECT id FROM atlas_resources WHERE semantic_ring = 'entity'")(lambda a: a.resources.filter(F.col("semantic_ring") == "entity").select("id"))
B.add("pf5_english_labels", "SELECT id, value FROM atlas_labels WHERE lower(language) = 'en'")(lambda a: a.labels.filter(english("language")).select("id", "value"))
B.add("pf6_english_family", "SELECT id, language FROM atlas_labels WHERE regexp_matches(lower(trim(language)), '^en([-_].*)?$')")(lambda a: a.labels.filter(english_family("language")).select("id", "language"))
B.add("pf7_endpoint_status", "SELECT release, CAST(sum(CASE WHEN lower(record_status) LIKE '%alignmentendpoint%' THEN 1 ELSE 0 END) AS BIGINT) AS endpoint_members FROM atlas_resources GROUP BY release")(
    lambda a: a.resources.groupBy("release").agg(F.count_if(F.coalesce(F.lower("record_status").contains("alignmentendpoint"), F.lit(False))).alias("endpoint_members"))
)
_PAIRS = f"""pairs AS (SELECT least(t.source_release, t.target_release) AS source, greatest(t.source_release, t.target_release) AS target, t.statement_type, count(*) AS count
    FROM atlas_statements t JOIN atlas_resources s ON s.id = t.subject JOIN atlas_resources o ON o.id = t.object WHERE {shown("s.record_status")} AND {shown("o.record_status")} GROUP BY ALL)"""
_NODES = f"""nodes AS (SELECT r.id, r.identifier, r.semantic_ring AS ring, count(s.id) FILTER ({shown("s.record_status")}) AS resources, count(s.release) AS total_members,
    count(*) FILTER (lower(s.record_status) LIKE '%alignmentendpoint%') AS endpoint_members FROM atlas_releases r LEFT JOIN atlas_resources s ON s.release = r.id WHERE r.release_type = 'AtlasRelease' GROUP BY ALL)"""
B.add("ag4_release_pairs", f"WITH {_PAIRS} SELECT * FROM pairs")(lambda a: X.release_pairs(a.statements, a.resources))
B.add("jn3_release_pairs_all", "SELECT least(t.source_release, t.target_release) AS source, greatest(t.source_release, t.target_release) AS target, t.statement_type, count(*) AS count FROM atlas_statements t JOIN atlas_resources s ON s.id = t.subject JOIN atlas_resources o ON o.id = t.object GROUP BY ALL")(
    lambda a: X.release_pairs(a.statements, a.resources, "all")
)
B.add("ag5_internal_relations", f"WITH {_PAIRS} SELECT source AS id, CAST(sum(count) AS BIGINT) AS internal_relations FROM pairs WHERE source = target GROUP BY 1")(lambda a: X.internal_relations(X.release_pairs(a.statements, a.resources)))
B.add("jn2_overview_nodes", f"WITH {_NODES} SELECT * FROM nodes")(lambda a: X.overview_nodes(a.releases, a.resources))
B.add("ag3_endpoint_members", f"WITH {_NODES} SELECT id, endpoint_members FROM nodes")(lambda a: X.overview_nodes(a.releases, a.resources).select("id", "endpoint_members"))
B.add(
    "ag15_satellites",
    f"""WITH {_PAIRS}, {_NODES}, off AS (SELECT * FROM pairs WHERE source <> target),
    side AS (SELECT source AS id, target AS other, statement_type, count FROM off UNION ALL SELECT target, source, statement_type, count FROM off),
    vol AS (SELECT id, other, sum(count) FILTER (statement_type = 'MappingAssertion') AS mapped, sum(count) AS any_ FROM side GROUP BY ALL),
    m AS (SELECT id, other FROM vol WHERE mapped IS NOT NULL QUALIFY row_number() OVER (PARTITION BY id ORDER BY mapped DESC, other DESC) = 1),
    y AS (SELECT id, other FROM vol QUALIFY row_number() OVER (PARTITION BY id ORDER BY any_ DESC, other DESC) = 1),
    f AS (SELECT *, (total_members > 0 AND endpoint_members / greatest(total_members, 1) >= 0.5) OR coalesce(regexp_matches(identifier, '(?i)endpoint'), false) AS satellite FROM nodes)
    SELECT f.id, f.identifier, f.ring, f.resources, f.satellite, CASE WHEN f.satellite THEN coalesce(m.other, y.other) END AS partner FROM f LEFT JOIN m USING (id) LEFT JOIN y USING (id)""",
)(lambda a: X.satellites(X.overview_nodes(a.releases, a.resources), X.release_pairs(a.statements, a.resources)))
_RANKED = f"ranked AS (SELECT resource, value, label_role, row_number() OVER (PARTITION BY resource ORDER BY {ROLE}, lower(value), value) AS label_rank FROM atlas_labels WHERE lower(language) = 'en')"
B.add("wn1_ranked_labels", f"WITH {_RANKED} SELECT * FROM ranked")(lambda a: ranked_labels(a.labels))
_GRAPH = f"""{_RANKED}, kept AS (SELECT id FROM atlas_resources WHERE release = '{RELEASE}' AND {shown("record_status")}),
    named AS (SELECT k.id, coalesce(r.value, nullif({LOCAL.format("k.id")}, ''), k.id) AS label FROM kept k LEFT JOIN ranked r ON r.resource = k.id AND r.label_rank = 1),
    node AS (SELECT row_number() OVER (ORDER BY lower(label), label, id) - 1 AS position, id, label FROM named)"""
B.add("jn4_graph_nodes", f"WITH {_GRAPH} SELECT * FROM node")(lambda a: X.graph_nodes(a.resources, a.labels, RELEASE))
_GRAPH_EDGES = f"""{_GRAPH}, last AS (SELECT id, max(position) AS position FROM node GROUP BY id),
    edge AS (SELECT t.id, s.position AS s, o.position AS o, t.predicate, t.statement_type FROM atlas_statements t LEFT JOIN last s ON s.id = t.subject LEFT JOIN last o ON o.id = t.object WHERE t.source_release = '{RELEASE}' AND t.target_release = '{RELEASE}')"""
B.add("jn4_graph_edges", f"WITH {_GRAPH_EDGES} SELECT * FROM edge")(lambda a: X.graph_edges(a.statements, X.graph_nodes(a.resources, a.labels, RELEASE), RELEASE))
B.add("ag27_predicate_index", f"WITH {_GRAPH_EDGES}, first AS (SELECT predicate, min(id) AS f FROM edge WHERE s IS NOT NULL AND o IS NOT NULL GROUP BY 1) SELECT predicate, row_number() OVER (ORDER BY f, predicate) - 1 AS index FROM first")(
    lambda a: X.first_seen_index(X.graph_edges(a.statements, X.graph_nodes(a.resources, a.labels, RELEASE), RELEASE).filter("s IS NOT NULL AND o IS NOT NULL"), "predicate", "id")
)
_NEAR = f"""{_START}, near AS (SELECT t.* FROM atlas_statements t LEFT JOIN atlas_resources s ON s.id = t.subject LEFT JOIN atlas_resources o ON o.id = t.object
    WHERE (t.subject = (SELECT id FROM start) OR t.object = (SELECT id FROM start)) AND (t.subject = (SELECT id FROM start) OR {shown("s.record_status")}) AND (t.object = (SELECT id FROM start) OR {shown("o.record_status")}))"""


def _near(a, status="active"):
    return X.neighbourhood(a.statements, a.resources, X.start_node(a.statements).first()["id"], status)


B.add("jn5_neighbourhood", f"WITH {_NEAR} SELECT id, subject, predicate, object FROM near")(lambda a: _near(a).select("id", "subject", "predicate", "object"))
B.add("jn6_evidence", f"WITH {_NEAR}, {SOURCE_RECORDS} SELECT e.id, e.statement, e.source_record, r.source_release, r.source_locator FROM atlas_evidence_bindings e LEFT JOIN source_records r ON r.id = e.source_record WHERE e.statement IN (SELECT id FROM near)")(
    lambda a: X.evidence_of(a.evidence_bindings, a.source_records, _near(a)).select("id", "statement", "source_record", "source_release", "source_locator")
)
B.add("jn6_evidence_counts", f"WITH {_NEAR}, n AS (SELECT statement, count(*) AS n FROM atlas_evidence_bindings GROUP BY 1) SELECT near.id, CAST(coalesce(n.n, 0) AS INT) AS evidence_count FROM near LEFT JOIN n ON n.statement = near.id")(
    lambda a: X.nested_evidence(_near(a), a.evidence_bindings).select("id", "evidence_count")
)
B.add(
    "jn7_endpoint_labels",
    f"""WITH {_NEAR}, {_RANKED}, ends AS (SELECT subject AS id FROM near UNION SELECT object FROM near)
    SELECT r.id, r.release, r.semantic_ring, r.resource_profile, coalesce(k.value, {LOCAL.format("r.id")}, r.id) AS label FROM atlas_resources r LEFT JOIN ranked k ON k.resource = r.id AND k.label_rank = 1 WHERE r.id IN (SELECT id FROM ends)""",
)(lambda a: X.endpoint_labels(_near(a), a.resources, a.labels))
_DOCS = f"""{IDENTIFIERS}, lab AS (SELECT resource, first(value ORDER BY {ROLE}, lower(value), value) AS display, string_agg(value, ' ' ORDER BY lower(value), value) AS aliases FROM atlas_labels WHERE lower(language) = 'en' GROUP BY 1),
    idn AS (SELECT identifies, string_agg(identifier_value, ' ' ORDER BY lower(identifier_value), identifier_value) AS identifiers FROM identifiers GROUP BY 1),
    doc AS (SELECT r.id, coalesce(l.display, nullif({LOCAL.format("r.id")}, ''), r.id) AS label, concat_ws(' ', l.aliases, array_to_string(r.notations, ' '), i.identifiers, r.id, r.definition) AS search_text
        FROM atlas_resources r LEFT JOIN lab l ON l.resource = r.id LEFT JOIN idn i ON i.identifies = r.id)"""


def _docs(a):
    return search_documents(a.resources, a.labels, a.identifiers)


B.add("ft1_search_documents", f"WITH {_DOCS} SELECT * FROM doc")(_docs)
B.add("jn9_document_labels", f"WITH {_DOCS} SELECT id, label FROM doc")(lambda a: _docs(a).select("id", "label"))
B.add("ag6_display_labels", f"SELECT resource, first(value ORDER BY {ROLE}, lower(value), value) AS label FROM atlas_labels WHERE lower(language) = 'en' GROUP BY 1")(lambda a: display_labels(a.labels))
B.add("ag7_alias_text", "SELECT resource, string_agg(value, ' ' ORDER BY lower(value), value) AS aliases FROM atlas_labels WHERE lower(language) = 'en' GROUP BY 1")(
    lambda a: a.labels.filter(english("language")).groupBy("resource").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.lower("value"), F.col("value").alias("v")))), lambda x: x["v"]), " ").alias("aliases"))
)
_TOKENS = f"""{_DOCS}, tok AS (SELECT id, label, list_filter(string_split_regex(lower(strip_accents(search_text)), '[^a-z0-9]+'), lambda x: x <> '') AS t FROM doc)"""
B.add("ft2_postings", f"WITH {_TOKENS}, flat AS (SELECT id, unnest(t) AS term FROM tok) SELECT term, id, count(*) AS tf FROM flat GROUP BY ALL")(lambda a: postings(_docs(a))[0])
_QUERY = ("coastal", "register", "kelp")
_BM25 = f"""{_TOKENS}, size AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM tok), flat AS (SELECT id, label, len(t) AS length, unnest(t) AS term FROM tok),
    rows_ AS (SELECT row_number() OVER () AS rn, id, label, t FROM tok), hit AS (SELECT rn, id, label, len(t) AS length, term, len(list_filter(t, lambda x: x = term)) AS tf FROM rows_, (SELECT unnest(['{"', '".join(_QUERY)}']) AS term)),
    df AS (SELECT term, count(*) AS df FROM hit WHERE tf > 0 GROUP BY 1),
    scored AS (SELECT rn, id, label, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * length / mean))) AS score FROM hit JOIN df USING (term), size WHERE tf > 0 GROUP BY ALL)"""
B.add("ft3_bm25", f"WITH {_BM25} SELECT id, label, round(score, 6) AS score FROM scored")(lambda a: bm25(_docs(a), " ".join(_QUERY)).withColumn("score", F.round("score", 6)))
B.add(
    "jn10_ranked_hits",
    f"""WITH {_BM25} SELECT s.id, s.label, round(s.score, 6) AS score, r.release, r.semantic_ring AS ring, r.resource_profile AS profile FROM scored s JOIN atlas_resources r USING (id) WHERE {shown("r.record_status")} ORDER BY round(s.score, 9) DESC, lower(s.label), s.label, s.id LIMIT 100""",
)(lambda a: search(_docs(a), a.resources, " ".join(_QUERY)).withColumn("score", F.round("score", 6)))
B.add(
    "ft4_browse",
    f"WITH {_DOCS} SELECT d.id, d.label, r.release, r.semantic_ring AS ring, r.resource_profile AS profile FROM doc d JOIN atlas_resources r USING (id) WHERE {shown('r.record_status')} ORDER BY lower(d.label), d.label, d.id LIMIT 200 OFFSET 50",
)(lambda a: search(_docs(a), a.resources, limit=200, offset=50))
B.add("ft5_whole_tokens", f"WITH {_TOKENS} SELECT id FROM tok WHERE list_contains(t, 'kel')")(lambda a: bm25(_docs(a), "kel").select("id"))
_FOUND = "SELECT r.id, r.definition, n.k IS NOT NULL AS known FROM atlas_resources r LEFT JOIN (SELECT DISTINCT subject AS k FROM atlas_statements) n ON n.k = r.id WHERE lower(r.definition) LIKE '%kelp%' OR lower(array_to_string(r.notations, ' ')) LIKE '%kelp%' OR lower(array_to_string(r.notes, ' ')) LIKE '%kelp%'"
B.add("pf8_lookup", _FOUND)(lambda a: X.with_known(X.lookup(a.resources, " Kelp ", ["definition"], ["notations", "notes"]).select("id", "definition"), "id", a.statements.select(F.col("subject").alias("id"))))
B.add("jn8_known_objects", "SELECT t.id, r.id IS NOT NULL AS object_known FROM atlas_statements t LEFT JOIN (SELECT DISTINCT id FROM atlas_resources) r ON r.id = t.object")(
    lambda a: X.with_known(a.statements.select("id", "object"), "object", a.resources, "object_known").select("id", "object_known")
)
B.add(
    "jn11_internal_edges",
    "SELECT t.id, s.release FROM atlas_statements t JOIN atlas_resources s ON s.id = t.subject JOIN atlas_resources o ON o.id = t.object WHERE s.release = o.release",
)(
    lambda a: a.statements.select("id", "subject", "object")
    .join(a.resources.select(F.col("id").alias("subject"), F.col("release").alias("release")), "subject")
    .join(a.resources.select(F.col("id").alias("object"), F.col("release").alias("_o")), "object")
    .filter("release = _o")
    .select("id", "release")
)
B.add("jn12_edges_within", f"SELECT id FROM atlas_statements WHERE subject IN (SELECT id FROM atlas_resources WHERE release = '{RELEASE}') AND object IN (SELECT id FROM atlas_resources WHERE release = '{RELEASE}')")(
    lambda a: a.statements.join(a.resources.filter(F.col("release") == RELEASE).select(F.col("id").alias("subject")), "subject", "left_semi").join(a.resources.filter(F.col("release") == RELEASE).select(F.col("id").alias("object")), "object", "left_semi").select("id")
)
B.add("so1_label_order", "SELECT id, label FROM (SELECT id, value AS label FROM atlas_labels ORDER BY lower(value), value, id LIMIT 500)")(lambda a: a.labels.select("id", F.col("value").alias("label")).orderBy(F.lower("label"), "label", "id").limit(500))
B.add("so2_page", "SELECT id, identifier FROM atlas_releases ORDER BY lower(identifier), id LIMIT 20 OFFSET 10")(lambda a: a.releases.select("id", "identifier").orderBy(F.lower("identifier"), "id").offset(10).limit(20))
B.add("sc6_first_rows", "SELECT id FROM atlas_resources ORDER BY id LIMIT 50")(lambda a: a.resources.select("id").orderBy("id").limit(50))
B.add("sf1_local_names", f"SELECT DISTINCT id, {LOCAL.format('id')} AS name FROM atlas_resources")(lambda a: a.resources.select("id", local_name("id").alias("name")).distinct())
B.add("sf2_short_names", "SELECT DISTINCT source_record AS id, split_part(split_part(regexp_replace(split_part(source_record, '#', -1), '/+$', ''), '/', -1), ':', -1) AS name FROM atlas_resources")(lambda a: a.resources.select(F.col("source_record").alias("id"), short_name("source_record").alias("name")).distinct())
B.add("sf3_joined_text", "SELECT id, concat_ws(' | ', definition, array_to_string(notes, ' ')) AS text FROM atlas_resources")(lambda a: a.resources.select("id", F.concat_ws(" | ", "definition", F.array_join("notes", " ")).alias("text")))
B.add("sf4_scalars", "SELECT id, starts_with(id, 'urn:vx') AS vx, lower(record_status) AS status, nullif(record_status, 'active') AS other, CAST(len(notations) AS INT) AS notations FROM atlas_resources")(
    lambda a: a.resources.select("id", F.col("id").startswith("urn:vx").alias("vx"), F.lower("record_status").alias("status"), F.nullif(F.col("record_status"), F.lit("active")).alias("other"), F.when(F.col("notations").isNotNull(), F.size("notations")).alias("notations"))
)
B.add(
    "ag9_coverage",
    """WITH k AS (SELECT 'kind' AS section, statement_type AS key FROM atlas_statements UNION ALL SELECT 'release', source_release FROM atlas_statements
    UNION ALL SELECT 'ring', unnest(CASE WHEN semantic_ring IS NOT NULL THEN [semantic_ring] ELSE list_filter([source_ring, target_ring], lambda x: x IS NOT NULL) END) FROM atlas_statements
    UNION ALL SELECT 'ring pair', concat_ws(' -> ', source_ring, target_ring) FROM atlas_statements WHERE semantic_ring IS NULL AND source_ring IS NOT NULL)
    SELECT section, key, count(*) AS count FROM k GROUP BY ALL""",
)(lambda a: X.coverage(a.statements))
B.add("ag8_group_counts", "SELECT record_status, count(*) AS count FROM atlas_resources WHERE record_status IS NOT NULL GROUP BY 1")(lambda a: a.resources.filter("record_status IS NOT NULL").groupBy("record_status").agg(F.count(F.lit(1)).alias("count")))
B.add(
    "ag10_current_statements",
    f"WITH {RESCISSIONS} SELECT id FROM atlas_statements WHERE id NOT IN (SELECT supersedes_assertion FROM atlas_statements WHERE supersedes_assertion IS NOT NULL) AND id NOT IN (SELECT applies_to FROM rescissions)",
)(lambda a: X.current_statements(a.statements, a.rescissions).select("id"))
B.add(
    "ag29_statement_states",
    f"WITH {RESCISSIONS}, i AS (SELECT DISTINCT id FROM atlas_statements) SELECT id, CASE WHEN id IN (SELECT supersedes_assertion FROM atlas_statements WHERE supersedes_assertion IS NOT NULL) THEN 'superseded' WHEN id IN (SELECT applies_to FROM rescissions) THEN 'rescinded' ELSE 'current' END AS state FROM i",
)(lambda a: X.statement_states(a.statements, a.rescissions))
B.add(
    "ag29_bounded_model",
    f"""WITH {RESCISSIONS}, few AS (SELECT id, subject, object FROM atlas_statements ORDER BY id LIMIT 60), ends AS (SELECT subject AS id FROM few UNION SELECT object FROM few), own AS (SELECT DISTINCT id FROM atlas_resources),
    picked AS (SELECT id FROM (SELECT id, CASE WHEN id IN (SELECT id FROM ends) THEN 0 ELSE 1 END AS p FROM own) ORDER BY p, id LIMIT 150)
    SELECT 'resource' AS kind, id, NULL AS state FROM picked UNION ALL SELECT DISTINCT 'statement', id, CASE WHEN id IN (SELECT supersedes_assertion FROM atlas_statements WHERE supersedes_assertion IS NOT NULL) THEN 'superseded' WHEN id IN (SELECT applies_to FROM rescissions) THEN 'rescinded' ELSE 'current' END FROM few""",
)(lambda a: X.bounded_model(a.statements, a.once, a.rescissions, 60, 150))

QUERIES, SQL = B.queries, B.sql
