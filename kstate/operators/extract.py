"""Text units of files: one row a document, page, paragraph, table row, slide line, member or blob.

Containers are parsed in Arrow-fed Python workers, one file a call; text files stay in the JVM. Limits
on members and bytes are enforced while reading.
"""

from __future__ import annotations

import bz2
import functools
import gzip
import hashlib
import importlib.metadata
import io
import lzma
import posixpath
import tarfile
import zipfile
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from html.parser import HTMLParser
from pathlib import PurePosixPath
from urllib.parse import unquote
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from kstate.functions.canon import KStateError, canonical_json
from kstate.runtime import cut

TEXT_ROUTES = ("text", "markdown", "markup", "structured-text", "text-source")
UNIT_SCHEMA = "path string, unit_index int, kind string, text string, data string, native_locator string, metadata string, diagnostics array<string>"
COLUMNS = [f.split()[0] for f in UNIT_SCHEMA.split(", ")]


@dataclass(frozen=True)
class Limits:
    """Most bytes and parts read from one file."""

    text_bytes: int = 256 << 20
    pdf_bytes: int = 512 << 20
    pages: int = 10_000
    page_chars: int = 256 << 20
    members: int = 20_000
    member_bytes: int = 64 << 20
    total_bytes: int = 512 << 20
    blobs: int = 100_000


LIMITS = Limits()
#: kind, text, data, locator, diagnostics, metadata; kind None marks a diagnostic of the file, which is no unit
Unit = tuple[str | None, str | None, dict, dict, list[str], dict]


class Budget:
    """Running total of what a container gives out."""

    def __init__(self, limits: Limits) -> None:
        self.limits, self.total, self.count = limits, 0, 0

    def take(self, size: int) -> None:
        self.count += 1
        self.total += size
        if self.count > self.limits.members or size > self.limits.member_bytes or self.total > self.limits.total_bytes:
            raise KStateError("container exceeds the extraction limits")


def decoded(data: bytes, hint: str | None = None) -> tuple[str, str] | None:
    """Text of bytes and the encoding that reads it: the mark's, the hint's, UTF-8; None if none does."""
    tries = [hint] if hint and hint != "empty" else []
    if data[:2] in (b"\xff\xfe", b"\xfe\xff"):
        tries.insert(0, "utf-16")
    elif data[:3] == b"\xef\xbb\xbf":
        tries.append("utf-8-sig")
    for encoding in dict.fromkeys([*tries, "utf-8"]):
        try:
            return data.decode(encoding), encoding
        except UnicodeDecodeError:
            continue
    return None


def maybe_text(data: bytes) -> str | None:
    """The text of bytes that decode and hold few control characters, else None."""
    got = decoded(data)
    if got is None:
        return None
    head = got[0][:65_536]
    odd = sum(c < " " and c not in "\t\n\r\f\b" for c in head)
    return None if odd > max(1, len(head) // 100) else got[0]


def xml_root(data: bytes) -> ElementTree.Element:
    """Parsed XML; document types and entities are refused."""
    head = data[:4096] if data[:2] not in (b"\xff\xfe", b"\xfe\xff") else data.decode("utf-16", "replace").encode()
    if b"<!DOCTYPE" in head.upper() or b"<!ENTITY" in data.upper():
        raise KStateError("XML with a document type is refused")
    return ElementTree.fromstring(data)


def local(tag: str) -> str:
    return tag.rpartition("}")[2]


def runs(node: ElementTree.Element) -> str:
    """Text of office markup; tab and break elements become their characters."""
    signs = {"tab": "\t", "br": "\n"}
    return "".join(n.text or "" if local(n.tag) == "t" else signs.get(local(n.tag), "") for n in node.iter())


def plain(node: ElementTree.Element) -> str:
    """Text elements alone, as shared and inline strings have them."""
    return "".join(n.text or "" for n in node.iter() if local(n.tag) == "t")


def inside(folder: str, target: str) -> str:
    """A part named from a folder of a package; one that leaves the package is refused."""
    full = posixpath.normpath(target.lstrip("/") if target.startswith("/") else posixpath.join(folder, target))
    if full == ".." or full.startswith(("../", "/")):
        raise KStateError(f"{target} leaves the package")
    return full


def relations(z: zipfile.ZipFile, part: str) -> dict[str, str]:
    """Parts a part refers to inside the package; external ones are left out, escaping ones and a missing list refused."""
    folder, name = posixpath.split(part)
    found = {}
    for r in xml_root(z.read(posixpath.join(folder, "_rels", name + ".rels"))).iter():
        if local(r.tag) == "Relationship" and r.get("Id") and r.get("Target") and r.get("TargetMode") != "External":
            found[r.get("Id")] = inside(folder, unquote(r.get("Target")))
    return found


def referred(z: zipfile.ZipFile, part: str, element: str) -> list[tuple[ElementTree.Element, str]]:
    """Elements of a part, in order, with the package part each refers to; those without one are left out, none at all is an error."""
    parts = relations(z, part)
    found = []
    for n in xml_root(z.read(part)).iter():
        if local(n.tag) == element:
            ident = next((v for k, v in n.attrib.items() if k.endswith("}id")), None)
            if ident in parts:
                found.append((n, parts[ident]))
    if not found:
        raise KStateError(f"{part} refers to no part")
    return found


def docx(z: zipfile.ZipFile) -> Iterator[Unit]:
    """Every paragraph of the body, empty ones too, and every row of its tables."""
    root = xml_root(z.read("word/document.xml"))
    paragraph = table = 0
    for child in next((n for n in root.iter() if local(n.tag) == "body"), root):
        if local(child.tag) == "p":
            paragraph += 1
            yield "paragraph", runs(child), {}, {"paragraph": paragraph}, [], {"format": "docx"}
        elif local(child.tag) == "tbl":
            table += 1
            for n, row in enumerate(child.findall("./{*}tr"), 1):
                cells = [runs(c) for c in row.findall("./{*}tc")]
                yield "table-row", "\t".join(cells), {"cells": cells}, {"table": table, "row": n}, [], {"format": "docx"}


def pptx(z: zipfile.ZipFile) -> Iterator[Unit]:
    """Paragraphs of each slide that hold anything, counted within the slide."""
    for slide, (_, part) in enumerate(referred(z, "ppt/presentation.xml", "sldId"), 1):
        held = (n for n in xml_root(z.read(part)).iter() if local(n.tag) == "p" and (len(n) or runs(n)))
        for k, p in enumerate(held, 1):
            yield "slide-paragraph", runs(p), {}, {"slide": slide, "paragraph": k}, [], {"format": "pptx"}


def xlsx(z: zipfile.ZipFile) -> Iterator[Unit]:
    """Rows of each sheet: values (shared and inline strings looked up) beside formulas."""
    shared = [plain(s) for s in xml_root(z.read("xl/sharedStrings.xml")) if local(s.tag) == "si"] if "xl/sharedStrings.xml" in z.namelist() else []

    def cell(c: ElementTree.Element) -> dict:
        part = {local(n.tag): n for n in reversed(list(c))}
        kind = c.get("t")
        value = part["v"].text if "v" in part else None
        if kind == "inlineStr" and "is" in part:
            value = plain(part["is"])
        elif kind == "s" and value is not None and value.isdigit() and int(value) < len(shared):
            value = shared[int(value)]
        return {"coordinate": c.get("r"), "type": kind, "value": value, "formula": part["f"].text if "f" in part else None}

    for n, (sheet, part) in enumerate(referred(z, "xl/workbook.xml", "sheet"), 1):
        for row in (r for r in xml_root(z.read(part)).iter() if local(r.tag) == "row"):
            cells = [cell(c) for c in row if local(c.tag) == "c"]
            number = row.get("r") or ""
            where = {"sheet": n, "sheet_name": sheet.get("name") or f"Sheet{n}", "row": int(number) if number.isdigit() else None}
            yield "worksheet-row", "\t".join(c["value"] or "" for c in cells), {"cells": cells}, where, [], {"format": "xlsx"}


def odf(z: zipfile.ZipFile, fmt: str) -> Iterator[Unit]:
    """Headings, paragraphs and table rows in document order, each counted."""
    k = 0
    for n in xml_root(z.read("content.xml")).iter():
        if local(n.tag) in ("h", "p"):
            k += 1
            yield "paragraph", "".join(n.itertext()), {}, {"element": k}, [], {"format": fmt}
        elif local(n.tag) == "table-row":
            k += 1
            cells = ["".join(c.itertext()) for c in n if local(c.tag) == "table-cell"]
            yield "table-row", "\t".join(cells), {"cells": cells}, {"element": k}, [], {"format": fmt}


class _PlainText(HTMLParser):
    # The tags that break lines.
    BLOCKS = frozenset("article br div h1 h2 h3 h4 h5 h6 li p section tr".split())

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.out: list[str] = []

    def handle_starttag(self, tag: str, attrs: list) -> None:  # noqa: ARG002
        self.out.append("\n" * (tag in self.BLOCKS))

    def handle_endtag(self, tag: str) -> None:
        self.out.append("\n" * (tag in self.BLOCKS))

    def handle_data(self, data: str) -> None:
        self.out.append(data)


def html_text(html: str) -> str:
    """Text of a page, blanks kept; the start and the end of a block are line breaks."""
    p = _PlainText()
    p.feed(html)
    p.close()
    return "".join(p.out)


def epub(z: zipfile.ZipFile) -> Iterator[Unit]:
    """Chapters in the order of the spine; what the spine names and the book lacks is a diagnostic of the file."""
    package = next(r.get("full-path", "") for r in xml_root(z.read("META-INF/container.xml")).iter() if local(r.tag) == "rootfile")
    root, names = xml_root(z.read(package)), set(z.namelist())
    manifest = {i.get("id"): i.get("href") for i in root.iter() if local(i.tag) == "item" and i.get("id") and i.get("href")}
    for n, item in enumerate((i for i in root.iter() if local(i.tag) == "itemref"), 1):
        href = manifest.get(item.get("idref"))
        if href is None:
            yield None, None, {}, {}, [f"epub-spine-missing-manifest-item:{item.get('idref')}"], {}
            continue
        part = inside(posixpath.dirname(package), unquote(href))
        if part not in names:
            yield None, None, {}, {}, [f"epub-spine-member-missing:{part}"], {}
            continue
        yield "epub-spine-item", html_text(z.read(part).decode("utf-8", "replace")), {}, {"spine": n, "member": part}, [], {"format": "epub"}


def member(name: str, data: bytes) -> Unit:
    text = maybe_text(data)
    return "archive-member", text, {"sha256": hashlib.sha256(data).hexdigest(), "size": len(data)}, {"member": name}, [] if text is not None else ["archive-member-binary-not-decoded"], {}


def zip_members(z: zipfile.ZipFile, limits: Limits) -> Iterator[Unit]:
    guard((i.file_size for i in z.infolist()), limits)
    for info in z.infolist():
        if info.is_dir():
            yield "archive-directory", None, {}, {"member": info.filename}, [], {}
        else:
            yield member(info.filename, z.read(info))


def tar_members(data: bytes, limits: Limits) -> Iterator[Unit]:
    """Files of a tape archive; folders, links and devices are entries without content."""
    with tarfile.open(fileobj=io.BytesIO(data), mode="r:*") as t:
        every = t.getmembers()
        guard((i.size if i.isfile() else 0 for i in every), limits)
        for info in every:
            if info.isfile():
                yield member(info.name, t.extractfile(info).read())
            else:
                yield "archive-entry", None, {}, {"member": info.name}, [], {"tar_type": info.type.decode("latin-1")}


def guard(sizes: Iterable[int], limits: Limits) -> None:
    budget = Budget(limits)
    for n in sizes:
        budget.take(n)


def single(data: bytes, path: str, opener: Callable, limits: Limits) -> Iterator[Unit]:
    with opener(io.BytesIO(data)) as f:
        body = f.read(limits.member_bytes + 1)
    guard([len(body)], limits)
    yield member(PurePosixPath(path).stem, body)


def pdf(data: bytes, path: str, limits: Limits) -> Iterator[Unit]:
    try:
        from pypdf import PdfReader
    except ImportError:
        yield "unsupported", None, {}, {"path": path}, ["pdf-reader-not-installed"], {"format": "pdf"}
        return
    reader = PdfReader(io.BytesIO(data), strict=False)
    if len(data) > limits.pdf_bytes or reader.is_encrypted and not reader.decrypt("") or len(reader.pages) > limits.pages:
        raise KStateError("PDF is encrypted or exceeds the limits")
    chars = 0
    for n, page in enumerate(reader.pages, 1):
        try:
            text = page.extract_text() or ""
        except Exception as e:  # noqa: BLE001 - a page that cannot be read is a diagnostic, the others count
            text = ""
            yield None, None, {}, {}, [f"pdf-page-extraction-failed:{n}:{type(e).__name__}"], {}
        chars += len(text)
        if chars > limits.page_chars:
            raise KStateError("PDF text exceeds the limits")
        yield "page", text, {}, {"page": n}, [] if text.strip() else ["pdf-page-has-no-embedded-text"], {"format": "pdf", "media_type": "application/pdf"}


PACKAGES = {"docx": docx, "pptx": pptx, "xlsx": xlsx, "epub": epub, **{f: functools.partial(odf, fmt=f) for f in ("odt", "ods", "odp")}}
STREAMS = {"gzip": lambda f: gzip.GzipFile(fileobj=f), "bzip2": bz2.BZ2File, "xz": lzma.LZMAFile}
UNREADABLE = (zipfile.BadZipFile, tarfile.TarError, OSError, EOFError, lzma.LZMAError, ElementTree.ParseError, UnicodeDecodeError, KeyError, StopIteration, RuntimeError)


def units_of(data: bytes, path: str, route: str, fmt: str, limits: Limits = LIMITS, media_type: str | None = None, hint: str | None = None) -> Iterator[Unit]:
    """Units of one file by its route and format."""
    try:
        if route in TEXT_ROUTES:
            got = decoded(data, hint)
            if len(data) > limits.text_bytes or got is None:
                raise KStateError(f"{path} exceeds the limits or cannot be decoded as text")
            yield "text-document", got[0], {}, {"path": path}, [], {"format": fmt, "media_type": media_type, "encoding": got[1]}
        elif fmt == "pdf":
            yield from pdf(data, path, limits)
        elif fmt in PACKAGES or fmt == "zip":
            with zipfile.ZipFile(io.BytesIO(data)) as z:
                guard((i.file_size for i in z.infolist()), limits)
                yield from PACKAGES[fmt](z) if fmt in PACKAGES else zip_members(z, limits)
        elif fmt == "tar":
            yield from tar_members(data, limits)
        elif fmt in STREAMS:
            yield from single(data, path, STREAMS[fmt], limits)
        else:
            note = f"archive-format-not-supported:{fmt}" if route == "archive" else f"no-stage-04-extractor:{route}:{fmt}"
            yield "unsupported", None, {}, {"path": path}, [note], {"route": route, "format": fmt} | ({} if route == "archive" else {"media_type": media_type})
            yield None, None, {}, {}, [note], {}
    except UNREADABLE as e:
        raise KStateError(f"{path} cannot be read as {fmt}: {e}") from e


def extract_all(files: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Units of classified files, and the diagnostics of whole files as rows without kind.

    ``files`` has path, content, route, format and may have media_type, encoding_hint. An unreadable file or one beyond
    the limits fails the run; formats without an extractor give one ``unsupported`` unit with a diagnostic; null content is empty.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for path, content, route, fmt, media, hint in b.itertuples(index=False):
                k = 0
                for kind, text, data, where, notes, meta in units_of(bytes(content or b""), path, route, fmt, limits, media, hint):
                    rows.append((path, k if kind else None, kind, text, canonical_json(data), canonical_json(where), canonical_json(meta), notes))
                    k += kind is not None
            yield pd.DataFrame(rows, columns=COLUMNS).astype({"unit_index": "Int32"})

    extra = [F.col(c) if c in files.columns else F.lit(None).cast("string").alias(c) for c in ("media_type", "encoding_hint")]
    return files.select("path", "content", "route", "format", *extra).mapInPandas(run, UNIT_SCHEMA)


def extract(files: DataFrame, limits: Limits = LIMITS) -> DataFrame:
    """Units of classified files alone, numbered within each file (see extract_all)."""
    return extract_all(files, limits).filter("kind is not null")


def tools(formats: set[str]) -> dict[str, str]:
    """Versions of what reads files of these formats."""
    import pyexpat

    found = {}
    if formats & set(PACKAGES):
        found["expat"] = pyexpat.EXPAT_VERSION
    if "pdf" in formats:
        try:
            found["pypdf"] = importlib.metadata.version("pypdf")
        except importlib.metadata.PackageNotFoundError:
            found["pypdf"] = "unavailable"
    if "git" in formats:
        from kstate.sources.files import git

        found["git"] = git("--version").decode().strip().removeprefix("git version ")
    return found


def tree_units(entries: DataFrame) -> DataFrame:
    """Units of folders and links, which hold no content of their own."""
    link = F.col("kind") == "symlink"
    where = F.concat(F.lit('{"path":'), F.to_json(F.struct(F.col("path").alias("p"))).substr(F.lit(6), F.length(F.to_json(F.struct(F.col("path").alias("p")))) - 6), F.lit("}"))
    data = F.when(link, F.to_json(F.struct("target"))).otherwise(F.lit("{}"))
    return entries.filter(F.col("kind") != "file").select(
        "path", F.lit(0).alias("unit_index"), "kind", F.lit(None).cast("string").alias("text"), data.alias("data"), where.alias("native_locator"), F.lit("{}").alias("metadata"),
        F.when(link, F.array(F.lit("symlink-not-dereferenced"))).otherwise(F.array().cast("array<string>")).alias("diagnostics"),
    )


def running(df: DataFrame, by: list[str], order: list, size: str | None = None) -> DataFrame:
    """Adds number, and running (the sum of ``size``), within ``by`` in the given order.

    Rows are placed by ranges of by and order, counted within their range, and set off by what earlier ranges hold, so the
    largest source is spread over all tasks.
    """
    d = cut(df.repartitionByRange(*by, *order).withColumn("_part", F.spark_partition_id()))
    value = F.col(size) if size else F.lit(0)
    own = Window.partitionBy(*by, "_part").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    parts = d.groupBy(*by, "_part").agg(F.count("*").alias("_n"), F.sum(value).alias("_s"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    off = parts.select(*(F.col(c).alias(f"_by{i}") for i, c in enumerate(by)), F.col("_part").alias("_p"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_n"), F.coalesce(F.sum("_s").over(earlier), F.lit(0)).alias("_s"))
    same = functools.reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_by{i}")) for i, c in enumerate(by)), F.col("_part") == F.col("_p"))
    d = d.withColumn("number", F.count("*").over(own)).withColumn("running", F.sum(value).over(own)).join(off, same)
    d = d.withColumn("number", F.col("number") + F.col("_n")).withColumn("running", F.col("running") + F.col("_s"))
    return d.drop("_part", "_p", "_n", "_s", *(f"_by{i}" for i in range(len(by))), *([] if size else ["running"]))


def number_units(units: DataFrame, by: list[str], order: list) -> DataFrame:
    """Adds unit_id u000001, u000002, ... in the given order within a source."""
    return running(units, by, order).withColumn("unit_id", F.format_string("u%06d", "number")).drop("number")


def over_limit(sizes: DataFrame, by: list[str], order: list, size: str, limits: Limits = LIMITS) -> DataFrame:
    """Rows at which a source's members exceed the limits on number, single or running size."""
    return running(sizes, by, order, size).filter((F.col("number") > limits.members) | (F.col(size) > limits.member_bytes) | (F.col("running") > limits.total_bytes))


def git_units(spark, repo: str, commit: str, limits: Limits = LIMITS) -> DataFrame:  # noqa: ANN001
    """Blobs of a commit: names are listed once, contents read in one batch a partition by the workers."""
    from kstate.sources.files import git

    entries = []
    for line in git("ls-tree", "-rlz", "--full-tree", commit, cwd=repo).split(b"\0"):
        if line:
            head, _, name = line.partition(b"\t")
            mode, kind, oid, size = head.decode().split()
            entries.append((len(entries), mode, kind, oid, None if size == "-" else int(size), name.decode("utf-8", "surrogateescape")))
    if len(entries) > limits.blobs:
        raise KStateError("tree exceeds the blob limit")
    if any(not e[5].isprintable() and any(0xDC80 <= ord(c) <= 0xDCFF for c in e[5]) for e in entries):
        raise KStateError("tree holds a name that is not UTF-8")
    listed = spark.createDataFrame(entries, "n int, mode string, kind string, oid string, size long, path string")

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import subprocess

        for b in batches:
            want = [o for o, k, s in zip(b["oid"], b["kind"], b["size"]) if k == "blob" and s <= limits.member_bytes]
            got = subprocess.run(["git", "cat-file", "--batch"], cwd=repo, input="".join(o + "\n" for o in want).encode(), capture_output=True, check=True).stdout
            data, at = {}, 0
            for o in want:
                end = got.index(b"\n", at)
                n = int(got[at:end].split()[2])
                data[o] = got[end + 1 : end + 1 + n]
                at = end + 2 + n
            rows = []
            for r in b.itertuples(index=False):
                where = canonical_json({"commit": commit, "path": r.path})
                if r.kind != "blob":
                    rows.append((".", int(r.n), "git-reference", None, canonical_json({"mode": r.mode, "object_type": r.kind, "oid": r.oid}), where, "{}", []))
                    continue
                body = data.get(r.oid)
                text = None if body is None else maybe_text(body)
                d = {"mode": r.mode, "oid": r.oid, "size": int(r.size)} | ({} if body is None else {"sha256": hashlib.sha256(body).hexdigest()})
                rows.append((".", int(r.n), "git-blob", text, canonical_json(d), where, "{}", [] if text is not None else ["git-blob-size-limit-not-read" if body is None else "git-binary-blob-not-decoded"]))
            yield pd.DataFrame(rows, columns=COLUMNS)

    return listed.mapInPandas(read, UNIT_SCHEMA)
