"""Queries against their SQL on the smallest tables; LEXMESH_ALL=1 runs every one."""

import glob
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

from .conftest import DATA

SOME = [
    "p3_found", "p3_paths", "p3_cycles", "p3_roots", "p4_found", "p6_found", "p6_report", "jn1_release_counts", "ag15_satellites", "jn4_graph_edges", "jn7_endpoint_labels", "ft3_bm25", "ag9_coverage", "iv4_labels", "iv6_relations",
    "iv9_evidence", "st2_multiset_diff", "st3_paired_residuals", "gr7_components", "gr12_bounded_ancestors", "gr16_typed_paths", "cg7_candidate_classes", "wn8_reservoir", "ev5_depth_grid", "in1_from_claims", "sc9_nquads_scan", "sk6_record_shards",
]

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables are not here")


def plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, bytes | bytearray):
        return bytes(v).hex()
    return round(float(v), 6) if type(v).__name__ == "Decimal" else v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for f in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()) if os.environ.get("LEXMESH_ALL") else SOME)
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, DATA)
    cols = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    found = duck.execute(entry.oracle_sql()[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == cols
    order = [names.index(c) for c in cols]
    assert got == sorted((tuple(plain(r[i]) for i in order) for r in found.fetchall()), key=str)


def test_entry_and_names(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
