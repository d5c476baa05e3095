import io
import json
import subprocess
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError
from kstate.operators.classify import classify_files
from kstate.operators.extract import Limits, extract, extract_all, git_units, html_text, over_limit, tree_units, units_of
from kstate.sources import files


def zipped(**parts):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w") as z:
        for name, text in parts.items():
            z.writestr(name.replace("__", "/").replace("_dot_", "."), text)
    return out.getvalue()


def test_classify(spark):
    rows = {
        "paper.zip": b"%PDF-1.7", "a.md": b"hello", "bad.md": b"\x00\xff\x00\x80", "x.docx": zipped(x_dot_txt="1"), "b.zip": b"PK\x03\x04junk", "u.txt": "héé".encode("utf-16"),
        "t": b"ustar".rjust(262, b"\0") + b"\0" * 300, "n": b"", "p.png": b"text only", "d.doc": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1", "o.bin": b"\xd0\xcf\x11\xe0\xa1\xb1\x1a\xe1",
        "s.mp3": b"ID3..", "big.txt": ("a" * 65_535 + "é").encode(), "e.epub": zipped(mimetype="application/epub+zip"), "w.docx": zipped(**{"[Content_Types]_dot_xml": "", "word__document_dot_xml": ""}),
    }
    df = spark.createDataFrame([(k, bytearray(v)) for k, v in rows.items()], "path string, content binary")
    got = {r.path: r for r in classify_files(df).collect()}
    want = {"paper.zip": "pdf", "a.md": "markdown", "bad.md": "binary", "x.docx": "zip", "b.zip": "zip", "u.txt": "text", "t": "tar", "n": "text", "p.png": "text", "d.doc": "doc", "o.bin": "ole-compound", "s.mp3": "mp3", "big.txt": "text", "e.epub": "epub", "w.docx": "docx"}
    assert {k: r.format for k, r in got.items()} == want
    assert got["paper.zip"].diagnostics == ["extension-conflict:zip->pdf"] and got["bad.md"].diagnostics == ["extension-binary-conflict:markdown"]
    assert got["x.docx"].diagnostics == ["extension-conflict:docx->zip"] and got["p.png"].diagnostics == ["extension-signature-mismatch:png"]
    assert got["u.txt"].encoding_hint == "utf-16" and got["e.epub"].strength == "exact"


def test_containers():
    w = 'xmlns:w="urn:w"'
    docx = zipped(word__document_dot_xml=f"<w:document {w}><w:body><w:p><w:r><w:t>Hi</w:t><w:tab/><w:t>you</w:t></w:r></w:p><w:tbl><w:tr><w:tc><w:p><w:r><w:t>A</w:t></w:r></w:p></w:tc><w:tc><w:p><w:r><w:t>B</w:t></w:r></w:p></w:tc></w:tr></w:tbl></w:body></w:document>")
    assert [(u[0], u[1]) for u in units_of(docx, "a.docx", "office", "docx")] == [("paragraph", "Hi\tyou"), ("table-row", "A\tB")]
    m = "http://schemas.openxmlformats.org/spreadsheetml/2006/main"
    xlsx = zipped(
        xl__workbook_dot_xml=f'<workbook xmlns="{m}" xmlns:r="urn:r"><sheets><sheet name="S" r:id="r1"/></sheets></workbook>', xl___rels__workbook_dot_xml_dot_rels='<R><Relationship Id="r1" Target="s1.xml"/></R>',
        xl__s1_dot_xml=f'<worksheet xmlns="{m}"><sheetData><row r="1"><c r="A1" t="s"><v>0</v></c><c r="B1"><f>1+1</f><v>2</v></c></row></sheetData></worksheet>', xl__sharedStrings_dot_xml=f'<sst xmlns="{m}"><si><t>Name</t></si></sst>',
    )
    (row,) = units_of(xlsx, "a.xlsx", "office", "xlsx")
    assert row[1] == "Name\t2" and row[2]["cells"][1]["formula"] == "1+1" and row[3]["sheet_name"] == "S"
    out = io.BytesIO()
    with tarfile.open(fileobj=out, mode="w") as t:
        for name, data in (("a.txt", b"hello"), ("b.bin", b"\0\xff")):
            info = tarfile.TarInfo(name)
            info.size = len(data)
            t.addfile(info, io.BytesIO(data))
    assert [(u[1], u[4]) for u in units_of(out.getvalue(), "x.tar", "archive", "tar")] == [("hello", []), (None, ["archive-member-binary-not-decoded"])]
    assert html_text("<h1>T</h1><p>a &amp;  b<br>c</p>") == "\nT\n\na &  b\nc\n"
    with pytest.raises(KStateError):
        list(units_of(zipped(a="xx", b="y"), "x.zip", "archive", "zip", Limits(members=1)))
    with pytest.raises(KStateError):
        list(units_of(b"PK\x03\x04junk", "x.zip", "archive", "zip"))
    with pytest.raises(KStateError):
        list(units_of(zipped(content_dot_xml='<!DOCTYPE x [<!ENTITY a "b">]><x/>'), "x.odt", "office", "odt"))
    assert next(iter(units_of(b"", "x.7z", "archive", "7z")))[4] == ["archive-format-not-supported:7z"]


def test_container_edges():
    """Empty paragraphs are units, what refers outside a package is refused, what a sheet cannot look up stays as it is written."""
    docx = zipped(word__document_dot_xml='<w:document xmlns:w="urn:w"><w:body><w:p/><w:p><w:r><w:t>x</w:t></w:r></w:p></w:body></w:document>')
    assert [(u[1], u[3]) for u in units_of(docx, "a.docx", "office", "docx")] == [("", {"paragraph": 1}), ("x", {"paragraph": 2})]
    rels = '<R><Relationship Id="r1" Target="{}"/></R>'
    deck = {"ppt__presentation_dot_xml": '<p xmlns:r="urn:r"><sldId r:id="r1"/></p>', "ppt__s_dot_xml": '<s xmlns:a="urn:a"><a:p/><a:p><a:r/></a:p><a:p><a:t>t</a:t></a:p></s>'}
    got = units_of(zipped(**deck, ppt___rels__presentation_dot_xml_dot_rels=rels.format("s.xml")), "a.pptx", "office", "pptx")
    assert [(u[1], u[3]["paragraph"]) for u in got] == [("", 1), ("t", 2)]
    for bad in ("../../x.xml", "/../x.xml", "gone.xml"):
        with pytest.raises(KStateError):
            list(units_of(zipped(**deck, ppt___rels__presentation_dot_xml_dot_rels=rels.format(bad)), "a.pptx", "office", "pptx"))
    with pytest.raises(KStateError):
        list(units_of(zipped(**deck), "a.pptx", "office", "pptx"))
    book = {"META-INF__container_dot_xml": '<c><rootfile full-path="b.opf"/></c>', "b_dot_opf": '<p><item id="a" href="../x"/><itemref idref="a"/></p>'}
    with pytest.raises(KStateError):
        list(units_of(zipped(**book), "a.epub", "archive-document", "epub"))
    assert [u[1] for u in units_of("é".encode("latin-1"), "a.txt", "text", "text", hint="latin-1")] == ["é"]
    with pytest.raises(KStateError):
        list(units_of(b"\xff\x00\xff", "a.txt", "text", "text"))


def test_tree_and_publish(spark, tmp_path):
    src = tmp_path / "src"
    (src / "a").mkdir(parents=True)
    (src / "a" / "x.md").write_text("x")
    (src / "a.txt").write_text("y")
    (src / "link").symlink_to("a.txt")
    e = files.inventory(spark, str(src))
    assert [r.path for r in e.collect()] == [".", "a", "a/x.md", "a.txt", "link"]
    one = files.tree_fingerprint(e.withColumn("s", F.lit(1)), ["s"]).first().fingerprint
    assert one == files.tree_fingerprint(e.repartition(3).withColumn("s", F.lit(1)), ["s"]).first().fingerprint
    assert {r.kind: r.data for r in tree_units(e).collect()}["symlink"] == '{"target":"a.txt"}'
    assert {r.path for r in files.read_files(spark, str(src)).collect()} >= {"a/x.md", "a.txt"}
    receipt = files.acquire("paper", str(src), tmp_path / "out")
    assert receipt["artifact"]["kind"] == "directory" and files.read_manifest(tmp_path / "out/paper/receipt.json") == receipt
    with pytest.raises(KStateError):
        files.acquire("paper", str(src), tmp_path / "out")
    files.acquire("paper", str(src), tmp_path / "out", replace=True)
    with pytest.raises(KStateError):
        files.acquire("../x", str(src), tmp_path / "out")
    assert files.publish(tmp_path / "gen", {"a/b": b"1"}) and not files.publish(tmp_path / "gen", {"a/b": b"1"})
    with pytest.raises(KStateError):
        files.publish(tmp_path / "gen", {"a/b": b"2"})
    with files.exclusive(tmp_path / "lock"):
        files.write_pointer(tmp_path / "current", {"generation_id": "g"})
    assert json.loads((tmp_path / "current").read_text()) == {"generation_id": "g"}


def test_json_lines(spark, tmp_path):
    df = spark.createDataFrame([(2, "é", ["x"]), (1, None, [])], "n long, t string, l array<string>")
    path = str(tmp_path / "rows.jsonl")
    files.write_json_lines(df, path, ["n"])
    assert open(path).read() == '{"l":[],"n":1,"t":null}\n{"l":["x"],"n":2,"t":"\\u00e9"}\n'
    assert files.read_json_lines(spark, path, "n long, t string, l array<string>").orderBy("n").collect() == df.orderBy("n").collect()
    with open(path, "a") as f:
        f.write("{")
    with pytest.raises(KStateError):
        files.read_json_lines(spark, path, "n long")


def test_git(spark, tmp_path):
    work = tmp_path / "w"
    work.mkdir()
    run = lambda *a: subprocess.run(["git", "-c", "user.name=t", "-c", "user.email=t@t", *a], cwd=work, check=True, capture_output=True)
    run("init", "-q")
    (work / "a.txt").write_text("hello")
    (work / "b.bin").write_bytes(b"\0\xff")
    run("add", ".")
    run("commit", "-qm", "m")
    files.acquire("repo", f"git+file://{work}", tmp_path / "out")
    lock = files.git_lock(tmp_path / "out/repo/artifact")
    got = {json.loads(r.native_locator)["path"]: (r.path, r.text, r.diagnostics) for r in git_units(spark, str(tmp_path / "out/repo/artifact"), lock["commit"]).collect()}
    assert got == {"a.txt": (".", "hello", []), "b.bin": (".", None, ["git-binary-blob-not-decoded"])}
    assert files.snapshot_id(lock, None) == files.snapshot_id(lock | {"ref": "other"}, None)


def test_extract_and_guard(spark):
    df = spark.createDataFrame([("a.txt", bytearray(b"\xef\xbb\xbfx\r\n"), "text", "text"), ("b.zip", bytearray(zipped(a="1", b="2")), "archive", "zip")], "path string, content binary, route string, format string")
    got = sorted((r.path, r.unit_index, r.text) for r in extract(df).collect())
    assert got == [("a.txt", 0, "x\r\n"), ("b.zip", 0, "1"), ("b.zip", 1, "2")]
    odd = spark.createDataFrame([("c.7z", None, "archive", "7z")], df.schema)
    assert [(r.kind, r.diagnostics) for r in extract_all(odd).collect()] == [("unsupported", ["archive-format-not-supported:7z"]), (None, ["archive-format-not-supported:7z"])]
    assert extract(odd).count() == 1 and extract(df.limit(0)).count() == 0
    sizes = spark.createDataFrame([("s", n, 10) for n in range(5)], "s string, n long, size long")
    assert [r.n for r in over_limit(sizes, ["s"], ["n"], "size", Limits(total_bytes=35)).orderBy("n").collect()] == [3, 4]
