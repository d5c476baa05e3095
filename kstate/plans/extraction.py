"""Queries of the extractors and of signatures: files are built from the documents' lines, and SQL says what must come out."""

from __future__ import annotations

import gzip
import io
import tarfile
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kstate.operators import classify as C
from kstate.operators import extract as X
from kstate.runtime import table

REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    REGISTRY[f.__name__] = f
    return f


def zipped(parts: dict[str, str]) -> bytes:
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name, text)
    return out.getvalue()


def escaped(t: str) -> str:
    return t.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")


def clean(t: str) -> str:
    """What XML can hold: no control characters but tab and line feed."""
    return "".join(c for c in t if c >= " " or c in "\t\n")


def built(spark: SparkSession, d: str, make: Callable[[list[str]], bytes], suffix: str, route: str, notes: bool = False) -> DataFrame:
    """Units of one file a document, made of the document's lines."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"path": [f"{k}.{suffix}" for k in b["doc_id"]], "content": [make(clean(t).split("\n")) for t in b["text"]]})

    f = table(spark, d, "documents").filter("text is not null").select("doc_id", "text").mapInPandas(run, "path string, content binary")
    f = f.withColumn("format", F.lit("gzip" if suffix == "gz" else suffix)).withColumn("route", F.lit(route))
    return X.extract_all(f) if notes else X.extract(f)


def where(name: str, kind: str = "bigint") -> Column:
    return F.get_json_object("native_locator", f"$.{name}").cast(kind).alias(name)


def text_md5() -> Column:
    return F.md5("text").alias("text_md5")


def docx_file(lines: list[str]) -> bytes:
    body = "".join(f"<w:p><w:r><w:t>{escaped(x)}</w:t></w:r></w:p>" if x else "<w:p/>" for x in lines)
    cell = "<w:tc><w:p><w:r><w:t>A</w:t><w:tab/></w:r></w:p><w:p><w:r><w:t>{}</w:t></w:r></w:p></w:tc>"
    return zipped({"word/document.xml": f'<w:document xmlns:w="urn:w"><w:body>{body}<w:tbl><w:tr>{cell.format("x")}{cell.format(len(lines))}</w:tr></w:tbl></w:body></w:document>'})


@query
def docx_rows(spark: SparkSession, d: str) -> DataFrame:
    u = built(spark, d, docx_file, "docx", "office")
    return u.select("path", "kind", where("paragraph"), where("row"), text_md5())


def pptx_file(lines: list[str]) -> bytes:
    slides = [lines[i : i + 3] for i in range(0, len(lines), 3)]
    ids = "".join(f'<p:sldId r:id="r{k}"/>' for k in range(len(slides)))
    rels = "".join(f'<Relationship Id="r{k}" Target="slides/s%20{k}.xml"/>' for k in range(len(slides)))
    parts = {"ppt/presentation.xml": f'<p:presentation xmlns:p="urn:p" xmlns:r="urn:r">{ids}</p:presentation>', "ppt/_rels/presentation.xml.rels": f"<Relationships>{rels}</Relationships>"}
    for k, own in enumerate(slides):
        body = "".join(f"<a:p><a:r><a:t>{escaped(x)}</a:t></a:r></a:p>" if x.strip() else "<a:p><a:r/></a:p>" if x else "<a:p/>" for x in own)
        parts[f"ppt/slides/s {k}.xml"] = f'<p:sld xmlns:p="urn:p" xmlns:a="urn:a">{body}</p:sld>'
    return zipped(parts)


@query
def pptx_paragraphs(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d, pptx_file, "pptx", "office").select("path", where("slide"), where("paragraph"), text_md5())


def xlsx_file(lines: list[str]) -> bytes:
    rows = ""
    for n, x in enumerate(lines, 1):
        index = 999_999 if n % 4 == 0 else n - 1
        rows += f'<row r="{"x" if n % 5 == 0 else n}"><c r="A{n}" t="s"><v>{index}</v></c><c r="B{n}" t="inlineStr"><is><t>{len(x)}</t></is></c><c r="C{n}"><f>LEN(A{n})</f></c></row>'
    return zipped({
        "xl/workbook.xml": '<workbook xmlns="urn:m" xmlns:r="urn:r"><sheets><sheet name="S" r:id="r1"/><sheet r:id="none"/></sheets></workbook>',
        "xl/_rels/workbook.xml.rels": '<Relationships><Relationship Id="r1" Target="/xl/s1.xml"/><Relationship Id="none" Target="http://h/" TargetMode="External"/></Relationships>',
        "xl/sharedStrings.xml": '<sst xmlns="urn:m">' + "".join(f"<si><r><t>{escaped(x)}</t></r><r><t>!</t></r></si>" for x in lines) + "</sst>", "xl/s1.xml": f'<worksheet xmlns="urn:m"><sheetData>{rows}</sheetData></worksheet>',
    })


@query
def xlsx_rows(spark: SparkSession, d: str) -> DataFrame:
    u = built(spark, d, xlsx_file, "xlsx", "office")
    formula = F.get_json_object("data", "$.cells[2].formula").alias("formula")
    return u.select("path", "unit_index", where("row"), F.get_json_object("native_locator", "$.sheet_name").alias("sheet_name"), formula, text_md5())


def odt_file(lines: list[str]) -> bytes:
    body = ""
    for n, x in enumerate(lines):
        p = f"<t:{'h' if n % 3 == 0 else 'p'}>{escaped(x)}</t:{'h' if n % 3 == 0 else 'p'}>"
        body += f"<b:table><b:table-row><b:table-cell><t:p>{n}</t:p></b:table-cell><b:table-cell>{p}</b:table-cell></b:table-row></b:table>" if n % 4 == 3 else p
    return zipped({"content.xml": f'<o:document xmlns:o="urn:o" xmlns:t="urn:t" xmlns:b="urn:b">{body}</o:document>'})


@query
def odt_elements(spark: SparkSession, d: str) -> DataFrame:
    return built(spark, d, odt_file, "odt", "office").select("path", where("element"), "kind", text_md5())


def epub_file(lines: list[str]) -> bytes:
    page = f"<html><h1>{escaped(lines[0])}</h1><p>{escaped(' '.join(lines[1:]))}<br>end</p></html>"
    return zipped({
        "META-INF/container.xml": '<container xmlns="urn:c"><rootfile full-path="in/book.opf"/></container>',
        "in/book.opf": '<package xmlns="urn:p"><manifest><item id="a" href="t%20x/a%26b.xhtml"/><item id="gone" href="gone.xhtml"/></manifest><spine><itemref idref="gone"/><itemref idref="a"/><itemref idref="b"/></spine></package>',
        "in/t x/a&b.xhtml": page,
    })


@query
def epub_items(spark: SparkSession, d: str) -> DataFrame:
    u = built(spark, d, epub_file, "epub", "archive-document", notes=True)
    return u.select("path", "kind", where("spine"), F.get_json_object("native_locator", "$.member").alias("member"), text_md5(), F.array_join("diagnostics", ",").alias("diagnostics"))


def tar_file(lines: list[str]) -> bytes:
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        folder = tarfile.TarInfo("f")
        folder.type = tarfile.DIRTYPE
        t.addfile(folder)
        for name, data in (("f/a.txt", "\n".join(lines).encode()), ("f/b.bin", b"\x00\xff" * len(lines))):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    return out.getvalue()


@query
def tar_entries(spark: SparkSession, d: str) -> DataFrame:
    u = built(spark, d, tar_file, "tar", "archive")
    return u.select("path", "kind", F.get_json_object("native_locator", "$.member").alias("member"), F.get_json_object("metadata", "$.tar_type").alias("tar_type"), F.get_json_object("data", "$.size").cast("long").alias("size"), text_md5(), F.array_join("diagnostics", ",").alias("diagnostics"))


@query
def gzip_members(spark: SparkSession, d: str) -> DataFrame:
    u = built(spark, d, lambda lines: gzip.compress("\n".join(lines).encode()), "gz", "archive")
    return u.select("path", "kind", F.get_json_object("native_locator", "$.member").alias("member"), F.get_json_object("data", "$.sha256").alias("sha256"), text_md5())


@query
def unsupported_files(spark: SparkSession, d: str) -> DataFrame:
    """Files no extractor takes, by route: one unit each, and the same diagnostic for the file."""
    f = table(spark, d, "documents").select(F.concat_ws("/", "source_path", F.col("doc_id").cast("string")).alias("path"), F.encode("text", "UTF-8").alias("content"), F.when(F.col("doc_id") % 2 == 0, "archive").otherwise("image").alias("route"), F.when(F.col("doc_id") % 2 == 0, "7z").otherwise("png").alias("format"))
    u = X.extract_all(f)
    return u.groupBy("kind", F.array_join("diagnostics", ",").alias("diagnostics"), F.get_json_object("metadata", "$.route").alias("route")).agg(F.count("*").alias("n"))


#: How a file of each kind begins, as hex; the extension says something else for every second one.
HEADS = (("png", "89504E470D0A1A0A"), ("gif", "474946383961"), ("pdf", "255044462D312E37"), ("gzip", "1F8B0800"), ("jpeg", "FFD8FFE0"), ("xz", "FD377A585A00"), ("bzip2", "425A6839"), ("binary", "00FF0080"))


@query
def file_signatures(spark: SparkSession, d: str) -> DataFrame:
    """What files with signatures are, before the text of each document."""
    k = F.pmod(F.col("doc_id"), F.lit(len(HEADS))).cast("int")
    head = F.element_at(F.array(*[F.lit(h) for _, h in HEADS]), k + 1)
    # behind a signature the body plays no part; the last kind has none, and its zero and high bytes make it binary
    f = table(spark, d, "documents").select("doc_id", F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.when(F.pmod("doc_id", F.lit(16)) < 8, F.lit(".md")).otherwise(F.lit(".unknown"))).alias("path"), F.concat(F.unhex(head), F.encode(F.coalesce("text", F.lit("")), "UTF-8")).alias("content"))
    return C.classify_files(f).select("doc_id", "format", "basis", "strength", F.array_join("diagnostics", ",").alias("diagnostics"))


@query
def container_formats(spark: SparkSession, d: str) -> DataFrame:
    """What zip and tar containers are by what they hold, named as text, as themselves, or as another container."""

    def make(lines: list[str], k: int) -> bytes:
        types = {"[Content_Types].xml": "<Types/>"}
        if k < 3:
            return zipped(types | {("word/document.xml", "xl/workbook.xml", "ppt/presentation.xml")[k]: escaped(lines[0])})
        if k < 5:
            return zipped({"mimetype": ("application/epub+zip", "application/vnd.oasis.opendocument.text")[k - 3], "x": lines[0]})
        return tar_file(lines) if k == 5 else zipped({"a.txt": lines[0]}) if k == 6 else b"PK\x03\x04" + lines[0].encode()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            names = [f"f{n}.{('md', 'docx', 'zip')[n % 3]}" for n in b["doc_id"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "path": names, "content": [make(clean(t or "").split("\n"), n % 8) for n, t in zip(b["doc_id"], b["text"])]})

    f = table(spark, d, "documents").select("doc_id", "text").mapInPandas(run, "doc_id long, path string, content binary")
    return C.classify_files(f).select("doc_id", "format", "basis", "strength", F.array_join("diagnostics", ",").alias("diagnostics"))


def oracle_sql() -> dict[str, str]:
    # lines as the files have them, numbered from 1
    lines = r"""t AS (SELECT doc_id, regexp_replace(text, '[\x00-\x08\x0B-\x1F]', '', 'g') AS t FROM documents WHERE text IS NOT NULL),
l AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS x, unnest(range(1, len(string_split(t, chr(10))) + 1)) AS n FROM t)"""
    q: dict[str, str] = {}
    q["docx_rows"] = f"""WITH {lines} SELECT doc_id || '.docx' AS path, 'paragraph' AS kind, n AS paragraph, CAST(NULL AS BIGINT) AS row, md5(x) AS text_md5 FROM l
UNION ALL SELECT doc_id || '.docx', 'table-row', NULL, 1, md5('A' || chr(9) || 'x' || chr(9) || 'A' || chr(9) || max(n)) FROM l GROUP BY doc_id"""
    q["pptx_paragraphs"] = f"""WITH {lines}, s AS (SELECT doc_id, (n - 1) // 3 + 1 AS slide, n, x FROM l WHERE x <> '')
SELECT doc_id || '.pptx' AS path, slide, row_number() OVER (PARTITION BY doc_id, slide ORDER BY n) AS paragraph, md5(CASE WHEN regexp_matches(x, '^[\\s\\p{{Z}}]*$') THEN '' ELSE x END) AS text_md5 FROM s"""
    q["xlsx_rows"] = f"""WITH {lines} SELECT doc_id || '.xlsx' AS path, CAST(n - 1 AS INT) AS unit_index, CASE WHEN n % 5 <> 0 THEN n END AS row, 'S' AS sheet_name, 'LEN(A' || n || ')' AS formula,
  md5(CASE WHEN n % 4 = 0 THEN '999999' ELSE x || '!' END || chr(9) || length(x) || chr(9)) AS text_md5 FROM l"""
    q["odt_elements"] = f"""WITH {lines}, e AS (SELECT doc_id, n, x, sum(CASE WHEN n % 4 = 0 THEN 3 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY n) AS last FROM l),
u AS (SELECT doc_id, last AS element, 'paragraph' AS kind, x AS t FROM e UNION ALL SELECT doc_id, last - 1, 'paragraph', CAST(n - 1 AS VARCHAR) FROM e WHERE n % 4 = 0
  UNION ALL SELECT doc_id, last - 2, 'table-row', (n - 1) || chr(9) || x FROM e WHERE n % 4 = 0)
SELECT doc_id || '.odt' AS path, CAST(element AS BIGINT) AS element, kind, md5(t) AS text_md5 FROM u"""
    q["epub_items"] = f"""WITH {lines}, h AS (SELECT doc_id, max(CASE WHEN n = 1 THEN x END) AS head, coalesce(string_agg(CASE WHEN n > 1 THEN x END, ' ' ORDER BY n), '') AS rest FROM l GROUP BY doc_id)
SELECT doc_id || '.epub' AS path, 'epub-spine-item' AS kind, CAST(2 AS BIGINT) AS spine, 'in/t x/a&b.xhtml' AS member, md5(chr(10) || head || chr(10) || chr(10) || rest || chr(10) || 'end' || chr(10)) AS text_md5, '' AS diagnostics FROM h
UNION ALL SELECT doc_id || '.epub', NULL, NULL, NULL, NULL, unnest(['epub-spine-member-missing:in/gone.xhtml', 'epub-spine-missing-manifest-item:b']) FROM h"""
    q["tar_entries"] = f"""WITH {lines}, g AS (SELECT doc_id, t, len(string_split(t, chr(10))) AS n FROM t)
SELECT doc_id || '.tar' AS path, 'archive-entry' AS kind, 'f' AS member, '5' AS tar_type, CAST(NULL AS BIGINT) AS size, CAST(NULL AS VARCHAR) AS text_md5, '' AS diagnostics FROM g
UNION ALL SELECT doc_id || '.tar', 'archive-member', 'f/a.txt', NULL, CAST(strlen(t) AS BIGINT), md5(t), '' FROM g
UNION ALL SELECT doc_id || '.tar', 'archive-member', 'f/b.bin', NULL, CAST(2 * n AS BIGINT), NULL, 'archive-member-binary-not-decoded' FROM g"""
    q["gzip_members"] = f"WITH {lines} SELECT doc_id || '.gz' AS path, 'archive-member' AS kind, CAST(doc_id AS VARCHAR) AS member, sha256(t) AS sha256, md5(t) AS text_md5 FROM t"
    q["unsupported_files"] = """
WITH f AS (SELECT doc_id % 2 = 0 AS even, count(*) AS n FROM documents GROUP BY 1), d AS (SELECT even, n, CASE WHEN even THEN 'archive-format-not-supported:7z' ELSE 'no-stage-04-extractor:image:png' END AS diagnostics FROM f)
SELECT 'unsupported' AS kind, diagnostics, CASE WHEN even THEN 'archive' ELSE 'image' END AS route, n FROM d UNION ALL SELECT NULL, diagnostics, NULL, n FROM d"""
    q["file_signatures"] = """
WITH d AS (SELECT doc_id, doc_id % 8 AS k, doc_id % 16 < 8 AS md FROM documents), f AS (SELECT *, ['png', 'gif', 'pdf', 'gzip', 'jpeg', 'xz', 'bzip2', 'binary'][k + 1] AS format FROM d)
SELECT doc_id, format, CASE WHEN k < 7 THEN 'magic' ELSE 'fallback' END AS basis, CASE WHEN k < 7 THEN 'exact' ELSE 'generic' END AS strength,
  CASE WHEN NOT md THEN '' WHEN k < 7 THEN 'extension-conflict:markdown->' || format ELSE 'extension-binary-conflict:markdown' END AS diagnostics FROM f"""
    q["container_formats"] = """
WITH d AS (SELECT doc_id, doc_id % 8 AS k, ['markdown', 'docx', 'zip'][doc_id % 3 + 1] AS named FROM documents), f AS (SELECT *, ['docx', 'xlsx', 'pptx', 'epub', 'odt', 'tar', 'zip', 'zip'][k + 1] AS format FROM d)
SELECT doc_id, format, CASE WHEN k < 5 THEN 'container' ELSE 'magic' END AS basis, CASE WHEN k < 6 THEN 'exact' ELSE 'supported' END AS strength,
  concat_ws(',', CASE WHEN k = 7 THEN 'zip-container-unreadable' END, CASE WHEN named <> format THEN 'extension-conflict:' || named || '->' || format END) AS diagnostics FROM f"""
    return q
