import zipfile

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lexmesh.functions import text as X
from lexmesh.functions.labels import active, short_name
from lexmesh.operators import candidates as C
from lexmesh.operators.explore import check_page
from lexmesh.sources import formats, store

from .conftest import rows


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


def test_folds_and_tokens(spark):
    df = spark.createDataFrame([(" Ｓtraße  №1 ",), (None,)], "t string")
    assert [r[0] for r in df.select(X.fold_label("t")).collect()] == ["strasse no1", None]
    assert one(spark, X.word_tokens(F.lit("a-b  c"))) == ["a", "b", "c"]
    assert one(spark, X.camel_tokens(F.lit("fooBar9Baz"))) == ["foo", "bar9", "baz"]
    assert one(spark, X.identifier_tail(F.lit("urn:x:fooBar"))) == "foo bar"
    assert one(spark, X.char_ngrams(F.lit(""), 3)) == []
    assert one(spark, X.bigrams(F.array(F.lit("a")))) == []
    assert one(spark, short_name(F.lit("http://x/y#a/b:c/"))) == "c"
    assert one(spark, X.fold_extracted(F.lit("oﬃce co-\noperate"))) == "office cooperate"


def test_status(spark):
    df = spark.createDataFrame([("active",), ("ACTIVE",), (None,), ("deprecated",), ("deprecatedAlignmentEndpoint",), ("DEPRECATED",)], "s string")
    assert df.filter(active("s")).count() == 3 and df.filter(active("s", "all")).count() == 6
    for bad in ({"limit": True}, {"limit": 501}, {"offset": -1}, {"status": "x"}):
        with pytest.raises(ValueError):
            check_page(**bad)


def test_fisher(spark):
    df = spark.createDataFrame([(3, 1, 1, 3), (0, 0, 0, 0), (10, 0, 0, 10)], "a long, b long, c long, d long")
    got = [r[0] for r in df.select(X.fisher_exact("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(0.485714, abs=1e-6) and got[1] == 1.0 and got[2] == pytest.approx(1.0825e-05, rel=1e-3)


def distance(a, b):
    prev = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(prev[j] + 1, row[-1] + 1, prev[j - 1] + (x != y)))
        prev = row
    return prev[-1]


def test_near_in_edits_finds_all(spark):
    import random

    rng = random.Random(1)
    words = ["".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(120)]
    s, t = (spark.createDataFrame([(f"{p}{i}", w) for i, w in enumerate(ws)], "member string, pref string") for p, ws in (("s", words[:60]), ("t", words[60:])))
    want = {(f"s{i}", f"t{j}", distance(a, b)) for i, a in enumerate(words[:60]) for j, b in enumerate(words[60:]) if 1 <= distance(a, b) <= 2}
    assert {tuple(r) for r in C.near_in_edits(s, t).collect()} == want


def test_contained_runs(spark):
    s = spark.createDataFrame([("a", "Red kelp"), ("b", "kelp"), ("c", "cover of kelp")], "member string, pref string")
    t = spark.createDataFrame([("x", "big red kelp bed"), ("y", "kelp red"), ("z", "kelp")], "member string, pref string")
    assert rows(C.contained(s, t)) == [("a", "x", "sourceInsideTarget"), ("a", "z", "targetInsideSource"), ("b", "x", "sourceInsideTarget"), ("b", "y", "sourceInsideTarget"), ("c", "z", "targetInsideSource")]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_characters="\x00", exclude_categories=["Cs"])), min_size=1, max_size=5))
def test_nquads_round_trip(spark, texts):
    df = spark.createDataFrame([(f"urn:s{i}", "urn:p", t, "literal", "en", "urn:g") for i, t in enumerate(texts)], "subject string, predicate string, object string, object_kind string, language string, graph string")
    back = formats.parse_nquads(formats.to_nquads(df)).select(*df.columns)
    keep = [r for r in rows(df) if not any(c in r[2] for c in "\x0b\x0c\x1c\x1d\x1e\x85  ")]
    assert [r for r in rows(back) if r in keep] == keep


def test_nquads_skips_noise(spark, tmp_path):
    (tmp_path / "x.nt").write_text('# note\n\n<urn:a> <urn:p> <urn:b> .\n<urn:a> <urn:q> "x\\n\\"y\\""@en-GB .\nbroken\n_:b <urn:p> "1"^^<urn:int> <urn:g> . # end\n')
    got = rows(formats.read_nquads(spark, str(tmp_path / "x.nt")))
    assert got == [("_:b", "urn:p", "1", "literal", None, "urn:int", "urn:g"), ("urn:a", "urn:p", "urn:b", "iri", None, None, None), ("urn:a", "urn:q", 'x\n"y"', "literal", "en-GB", None, None)]
    assert formats.read_nquads(spark, str(tmp_path / "x.nt"), ["urn:q"]).count() == 1


def test_html_xml_zip_marc(spark, tmp_path):
    (tmp_path / "a.html").write_text("<title>T &amp; U</title><style>x</style><p>Hello <a href='/l'>link</a></p>")
    r = formats.read_html_text(spark, str(tmp_path / "a.html")).first()
    assert (r.title, r.text, r.links) == ("T & U", "Hello link", ["/l"])
    (tmp_path / "r.xml").write_text('<doc><section identifier="s1"><p><ref href="/us/1"/></p></section><ref href="/x"/></doc>')
    assert {(x.anchor, x.context, x.href) for x in formats.read_xml_references(spark, str(tmp_path / "r.xml")).collect()} == {("s1", "doc/section/p", "/us/1"), (None, "doc", "/x")}
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        z.writestr("in/a.txt", "hi")
    assert bytes(formats.read_zip_members(spark, str(tmp_path / "z.zip"), ".txt").first()["content"]) == b"hi"
    (tmp_path / "m.xml").write_text('<collection><record><controlfield tag="001">c1</controlfield><datafield tag="150"><subfield code="a">Kelp</subfield><subfield code="x">cover</subfield></datafield></record></collection>')
    assert rows(formats.read_marcxml(spark, str(tmp_path / "m.xml"))) == [("c1", "150", "a", "Kelp"), ("c1", "150", "x", "cover")]


def test_manifest_detects_tampering(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    want = store.manifest(spark, {"t": path})
    assert store.verify(spark, {"t": path}, want) == []
    spark.range(6).write.mode("overwrite").parquet(path)
    assert "t: rows differs" in store.verify(spark, {"t": path}, want)
    assert store.verify(spark, {"u": path}, want) == ["unexpected member u", "missing member t"]
    with pytest.raises(ValueError):
        store.optional_pair(spark, path, str(tmp_path / "none"))


def test_canonical_json():
    assert store.canonical_json({"b": [1, True], "a": "é"}) == '{"a":"é","b":[1,true]}'
    for bad in (1.5, 2**60, {"x": [0.1]}):
        with pytest.raises(ValueError):
            store.canonical_json(bad)
