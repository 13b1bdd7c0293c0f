"""Readers of interchange formats into tables, one per format."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: The terms of an N-Quads line: subject, predicate, object, optional graph.
_QUAD = r'^\s*(<[^>]*>|_:\S+)\s+(<[^>]*>)\s+(<[^>]*>|_:\S+|"(?:[^"\\]|\\.)*"(?:@[A-Za-z0-9\-]+|\^\^<[^>]*>)?)\s*(<[^>]*>|_:\S+)?\s*\.\s*(?:#.*)?$'
_LITERAL = r'^"((?:[^"\\]|\\.)*)"(?:@([A-Za-z0-9\-]+)|\^\^<([^>]*)>)?$'


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines with a given schema; malformed lines give nulls."""
    return spark.read.schema(schema).json(path)


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with a header; all columns are text without a schema, which is never inferred."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_xml(spark: SparkSession, path: str, row_tag: str, schema: str) -> DataFrame:
    return spark.read.format("xml").option("rowTag", row_tag).schema(schema).load(path)


def unescape(text: Column) -> Column:
    """The escapes of a literal: quotes, line ends, tabs, backslashes. Code point escapes stay as written."""
    out = F.replace(text, F.lit("\\\\"), F.lit("\x00"))
    for code, plain in (("\\n", "\n"), ("\\r", "\r"), ("\\t", "\t"), ('\\"', '"')):
        out = F.replace(out, F.lit(code), F.lit(plain))
    return F.replace(out, F.lit("\x00"), F.lit("\\"))


def read_nquads(spark: SparkSession, path: str, predicates: list[str] | None = None) -> DataFrame:
    """(subject, predicate, object, object_kind, language, datatype, graph) of N-Triples or N-Quads lines.

    Compressed files are read by their suffix. An allow-list of predicates is applied to
    the text before terms are cut. Comments and blank lines are skipped.
    """
    lines = spark.read.text(path).filter(~F.col("value").rlike(r"^\s*(#|$)"))
    if predicates:
        hit = F.lit(False)
        for p in predicates:
            hit = hit | F.col("value").contains(f"<{p}>")
        lines = lines.filter(hit)
    return parse_nquads(lines, predicates)


def parse_nquads(lines: DataFrame, predicates: list[str] | None = None) -> DataFrame:
    """Terms of lines in a column named value; lines that are no statement are left out."""
    cut = lines.filter(F.col("value").rlike(_QUAD)).select(*[F.regexp_extract("value", _QUAD, i).alias(n) for i, n in enumerate(("s", "p", "o", "g"), 1)])
    bare = lambda c: F.regexp_replace(c, "^<|>$", "")
    kind = F.when(F.col("o").startswith('"'), "literal").when(F.col("o").startswith("_:"), "blank").otherwise("iri")
    literal = F.regexp_extract("o", _LITERAL, 1)
    out = cut.select(
        bare(F.col("s")).alias("subject"),
        bare(F.col("p")).alias("predicate"),
        F.when(kind == "literal", unescape(literal)).otherwise(bare(F.col("o"))).alias("object"),
        kind.alias("object_kind"),
        F.nullif(F.when(kind == "literal", F.regexp_extract("o", _LITERAL, 2)), F.lit("")).alias("language"),
        F.nullif(F.when(kind == "literal", F.regexp_extract("o", _LITERAL, 3)), F.lit("")).alias("datatype"),
        F.nullif(bare(F.col("g")), F.lit("")).alias("graph"),
    )
    return out.filter(F.col("predicate").isin(predicates)) if predicates else out


def to_nquads(triples: DataFrame) -> DataFrame:
    """(value): N-Quads lines of (subject, predicate, object, object_kind, language, graph)."""
    text = F.col("object")
    for plain, code in (("\\", "\\\\"), ('"', '\\"'), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        text = F.replace(text, F.lit(plain), F.lit(code))
    literal = F.concat(F.lit('"'), text, F.lit('"'), F.coalesce(F.concat(F.lit("@"), "language"), F.lit("")))
    iri = lambda c: F.concat(F.lit("<"), c, F.lit(">"))
    graph = F.coalesce(F.concat(F.lit(" "), iri(F.col("graph"))), F.lit(""))
    return triples.select(F.concat(iri(F.col("subject")), F.lit(" "), iri(F.col("predicate")), F.lit(" "), F.when(F.col("object_kind") == "literal", literal).otherwise(iri(F.col("object"))), graph, F.lit(" .")).alias("value"))


def read_html_text(spark: SparkSession, path: str) -> DataFrame:
    """(path, title, text, links) of whole HTML files: visible text and targets of links, parsed per file."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from html.parser import HTMLParser

        class Page(HTMLParser):
            def __init__(self) -> None:
                super().__init__(convert_charrefs=True)
                self.text, self.links, self.title, self.skip, self.in_title = [], [], [], 0, False

            def handle_starttag(self, tag, attrs):
                self.skip += tag in ("script", "style")
                self.in_title |= tag == "title"
                if tag == "a" and dict(attrs).get("href"):
                    self.links.append(dict(attrs)["href"])

            def handle_endtag(self, tag):
                self.skip -= tag in ("script", "style") and self.skip > 0
                self.in_title &= tag != "title"

            def handle_data(self, data):
                if self.in_title:
                    self.title.append(data)
                elif not self.skip and data.strip():
                    self.text.append(data.strip())

        for pdf in batches:
            rows = []
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                page = Page()
                page.feed(bytes(raw).decode("utf-8", "replace"))
                rows.append((p, "".join(page.title).strip(), " ".join(page.text), page.links))
            yield pd.DataFrame(rows, columns=["path", "title", "text", "links"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, title string, text string, links array<string>")


def read_xml_references(spark: SparkSession, path: str, anchor: str = "section") -> DataFrame:
    """(path, anchor, context, href): references in XML files with the identifier and tag of the element around them."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import xml.etree.ElementTree as ET

        for pdf in batches:
            rows = []
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                stack, at = [], [None]
                for event, el in ET.iterparse(io.BytesIO(bytes(raw)), events=("start", "end")):
                    tag = el.tag.rpartition("}")[2]
                    if event == "start":
                        stack.append(tag)
                        at.append(el.get("identifier") or at[-1] if tag == anchor else at[-1])
                        if el.get("href"):
                            rows.append((p, at[-1], "/".join(stack[:-1]), el.get("href")))
                    else:
                        stack.pop()
                        at.pop()
                        el.clear()
            yield pd.DataFrame(rows, columns=["path", "anchor", "context", "href"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, anchor string, context string, href string")


def read_spreadsheet(spark: SparkSession, path: str) -> DataFrame:
    """(path, sheet, row, cells) of XLSX workbooks: cells of each row as text in column order."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import re
        import xml.etree.ElementTree as ET
        import zipfile

        space = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}
        for pdf in batches:
            rows = []
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(raw))) as book:
                    names = book.namelist()
                    shared = ["".join(t.itertext()) for t in ET.fromstring(book.read("xl/sharedStrings.xml")).findall("m:si", space)] if "xl/sharedStrings.xml" in names else []
                    for name in sorted(n for n in names if re.fullmatch(r"xl/worksheets/sheet\d+\.xml", n)):
                        for row in ET.fromstring(book.read(name)).iter(f"{{{space['m']}}}row"):
                            cells: list[str | None] = []
                            for c in row.findall("m:c", space):
                                col = 0
                                for ch in re.sub(r"\d", "", c.get("r", "A")):
                                    col = col * 26 + ord(ch) - 64
                                cells += [None] * (col - 1 - len(cells))
                                v = c.find("m:v", space)
                                text = "".join(c.find("m:is", space).itertext()) if c.get("t") == "inlineStr" else None if v is None else v.text
                                cells.append(shared[int(text)] if c.get("t") == "s" and text is not None else text)
                            rows.append((p, name.rpartition("/")[2][:-4], int(row.get("r", "0")), cells))
            yield pd.DataFrame(rows, columns=["path", "sheet", "row", "cells"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, sheet string, row int, cells array<string>")


def read_zip_members(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, member, content) of ZIP archives."""

    def parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import io
        import zipfile

        for pdf in batches:
            for p, raw in zip(pdf["path"], pdf["content"], strict=True):
                with zipfile.ZipFile(io.BytesIO(bytes(raw))) as z:
                    for n in z.namelist():
                        if n.endswith(suffix) and not n.endswith("/"):
                            yield pd.DataFrame([(p, n, z.read(n))], columns=["path", "member", "content"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(parse, "path string, member string, content binary")


def read_marcxml(spark: SparkSession, path: str) -> DataFrame:
    """(control, tag, code, value): data fields of MARCXML records, one row per subfield."""
    schema = "controlfield array<struct<_VALUE string, _tag string>>, datafield array<struct<_tag string, subfield array<struct<_VALUE string, _code string>>>>"
    rows = spark.read.format("xml").option("rowTag", "record").option("attributePrefix", "_").option("valueTag", "_VALUE").schema(schema).load(path)
    own = F.get(F.filter("controlfield", lambda c: c["_tag"] == "001"), F.lit(0))["_VALUE"]
    fields = rows.select(own.alias("control"), F.explode("datafield").alias("d")).select("control", F.col("d._tag").alias("tag"), F.explode("d.subfield").alias("s"))
    return fields.select("control", "tag", F.col("s._code").alias("code"), F.col("s._VALUE").alias("value"))
