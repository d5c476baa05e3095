"""What a file is: by container, signature, extension and text probe, in that order."""

from __future__ import annotations

import codecs
import io
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kstate.sources import formats

PROBE_BYTES = 65_536
ZIP_BYTES, ZIP_MEMBERS = 256 << 20, 20_000


def extension(path: Column) -> Column:
    """Lower-case suffix of the last path part, without the dot; none for dot-files and trailing dots."""
    name = F.substring_index(path, "/", -1)
    e = F.lower(F.regexp_extract(name, r"^.*[^.].*?\.([^.]+)$|^[^.]+\.([^.]+)$", 1))
    return F.nullif(F.when(name.rlike(r"^\.*[^.]+$"), F.lit("")).otherwise(F.coalesce(F.nullif(e, F.lit("")), F.lower(F.regexp_extract(name, r"\.([^.]+)$", 1)))), F.lit(""))


@F.pandas_udf(T.StringType())
def utf16_or_null(prefix: pd.Series) -> pd.Series:
    """``utf-16`` for bytes that open with its mark and decode strictly; a code unit cut off at the end is no fault."""

    def one(b: bytes | None) -> str | None:
        if not b or b[:2] not in (codecs.BOM_UTF16_LE, codecs.BOM_UTF16_BE):
            return None
        try:
            codecs.getincrementaldecoder("utf-16")("strict").decode(bytes(b), False)
        except UnicodeDecodeError:
            return None
        return "utf-16"

    return prefix.map(one)


@F.pandas_udf(T.StructType([T.StructField("format", T.StringType()), T.StructField("diagnostic", T.StringType())]))
def zip_format(content: pd.Series) -> pd.DataFrame:
    """Format inside a zip container; null content is no container."""

    def one(b: bytes | None) -> tuple[str | None, str | None]:
        if b is None:
            return None, None
        if len(b) > ZIP_BYTES:
            return "zip", "zip-probe-size-limit"
        try:
            with zipfile.ZipFile(io.BytesIO(b)) as z:
                names = z.namelist()
                if len(names) > ZIP_MEMBERS:
                    return "zip", "zip-probe-member-limit"
                if "[Content_Types].xml" in names:
                    for part, fmt in (("word/", "docx"), ("xl/", "xlsx"), ("ppt/", "pptx")):
                        if any(n.startswith(part) for n in names):
                            return fmt, None
                if "mimetype" in names and z.getinfo("mimetype").file_size <= 128:
                    kind = z.read("mimetype").decode("ascii", "replace").strip()
                    for fmt, media, _, _ in formats.format_rows():
                        if kind == media and fmt in ("epub", "odt", "ods", "odp"):
                            return fmt, None
                return "zip", None
        except (zipfile.BadZipFile, OSError, RuntimeError, NotImplementedError):
            return "zip", "zip-container-unreadable"

    return pd.DataFrame([one(b) for b in content], columns=["format", "diagnostic"])


def control_characters(text: Column) -> Column:
    """How many control characters other than backspace, tab, line feed, form feed and return a text has."""
    return F.length(text) - F.length(F.regexp_replace(text, "[\\x00-\\x07\\x0B\\x0E-\\x1F]", ""))


def text_encoding(prefix: Column) -> Column:
    """Encoding of a probe that reads as text, null for binary ones. A mark decides first, then strict UTF-8."""
    h = F.hex(F.substring(prefix, 1, 3))
    # a character cut off at the end of a full probe is no fault
    body = F.when(F.length(prefix) < PROBE_BYTES, prefix).otherwise(F.unhex(F.regexp_replace(F.hex(prefix), "(F[0-7][89AB].?.?.?.?|E.[89AB].|E.|F[0-7]|[CD].)$", "")))
    utf8 = F.is_valid_utf8(body.cast("string"))
    s = F.when(utf8, body.cast("string"))
    few = control_characters(s) <= F.greatest(F.lit(1), F.floor(F.length(s) / 100))
    nul = F.instr(s, "\x00") > 0
    return (
        F.when(F.length(prefix) == 0, F.lit("empty"))
        .when(h == "EFBBBF", F.when(utf8, F.lit("utf-8-sig")))
        .when(h.rlike("^(FFFE|FEFF)"), utf16_or_null(prefix))
        .when(utf8 & ~nul & few, F.lit("utf-8"))
    )


def classify_files(files: DataFrame) -> DataFrame:
    """Adds extension, format, media_type, family, route, basis, strength, signature, encoding_hint, diagnostics.

    ``files`` has path and content (binary). Content is judged first: containers, then the ordered
    signatures, then the extension if the content can be that, then whether it reads as text. A mark of
    UTF-16 is looked at before the signatures, whose mp3 pattern would match it. Null content is empty content.
    """
    spark = files.sparkSession
    by_ext = spark.createDataFrame([(r[0], r[1], r[5]) for r in formats.extension_rows()], "extension string, ext_format string, evidence string")
    by_format = spark.createDataFrame(list(formats.format_rows()), "format string, media_type string, family string, route string")
    d = files.withColumn("content", F.coalesce("content", F.unhex(F.lit("")))).withColumn("_p", F.substring("content", 1, PROBE_BYTES))
    d = d.withColumn("extension", extension(F.col("path"))).join(F.broadcast(by_ext), "extension", "left")
    h = F.hex(F.substring("_p", 1, 16))
    is_zip, is_ole = h.rlike(formats.ZIP), h.rlike(formats.OLE)
    is_tar = F.hex(F.expr("substring(_p, 258, 5)")) == formats.TAR
    d = d.withColumn("_zip", zip_format(F.when(is_zip, F.col("content")))).withColumn("encoding_hint", text_encoding(F.col("_p")))
    signature = F.lit(None).cast("string")
    for fmt, pattern in reversed(formats.signature_rows()):
        signature = F.when(h.rlike(pattern), F.lit(fmt)).otherwise(signature)
    marked = F.col("encoding_hint") == "utf-16"
    d = d.withColumn("signature", F.when(~is_zip & ~is_ole & ~is_tar & ~F.coalesce(marked, F.lit(False)), signature))
    zip_fmt, ext_fmt = F.col("_zip.format"), F.col("ext_format")
    trusted_zip = (zip_fmt == "zip") & (F.col("evidence") == "zip") & F.col("_zip.diagnostic").isNotNull() & (F.col("_zip.diagnostic") != "zip-container-unreadable")
    text = F.col("encoding_hint").isNotNull()
    d = d.withColumn(
        "format",
        F.when(is_zip, F.when(trusted_zip, ext_fmt).otherwise(zip_fmt))
        .when(is_ole, F.when(F.col("evidence") == "ole", ext_fmt).otherwise(F.lit("ole-compound")))
        .when(is_tar, F.lit("tar"))
        .when(F.col("signature").isNotNull(), F.col("signature"))
        .when((F.col("evidence") == "text") & text, ext_fmt)
        .when(text, F.lit("text"))
        .otherwise(F.lit("binary")),
    )
    magic = is_tar | F.col("signature").isNotNull()
    d = d.withColumn(
        "basis",
        F.when(is_zip, F.when(trusted_zip, F.lit("signature+extension")).when((zip_fmt == "zip"), F.lit("magic")).otherwise(F.lit("container")))
        .when(is_ole, F.when(F.col("evidence") == "ole", F.lit("signature+extension")).otherwise(F.lit("magic")))
        .when(magic, F.lit("magic"))
        .when((F.col("evidence") == "text") & text, F.lit("extension+text"))
        .when(text, F.lit("text-probe"))
        .otherwise(F.lit("fallback")),
    )
    exact = (F.col("basis") == "container") | magic
    d = d.withColumn("strength", F.when(exact, F.lit("exact")).when(F.col("basis").isin("text-probe", "fallback"), F.lit("generic")).otherwise(F.lit("supported")))
    unsure = ~is_zip & ~is_ole & ~magic
    notes = F.array(
        F.when(is_zip, F.col("_zip.diagnostic")),
        F.when((is_zip | magic) & (ext_fmt != F.col("format")), F.concat(F.lit("extension-conflict:"), ext_fmt, F.lit("->"), "format")),
        F.when(unsure & (F.col("evidence") == "text") & ~text, F.concat(F.lit("extension-binary-conflict:"), ext_fmt)),
        F.when(unsure & ext_fmt.isNotNull() & (F.col("evidence") != "text"), F.concat(F.lit("extension-signature-mismatch:"), ext_fmt)),
    )
    d = d.withColumn("diagnostics", F.filter(notes, lambda x: x.isNotNull()))
    d = d.withColumn("encoding_hint", F.when(F.col("basis").isin("extension+text", "text-probe"), F.col("encoding_hint")))
    return d.join(F.broadcast(by_format), "format", "left").drop("_p", "_zip", "ext_format", "evidence")


def classification_summary(entries: DataFrame) -> DataFrame:
    """(kind, value, n): entries by entry_kind, family and format, and in all, from one pass."""
    g = entries.groupingSets([["entry_kind"], ["family"], ["format"], []], "entry_kind", "family", "format")
    g = g.agg(F.count("*").alias("n"), F.grouping("entry_kind").alias("a"), F.grouping("family").alias("b"), F.grouping("format").alias("c"))
    kind = F.when(F.col("a") == 0, "entry_kind").when(F.col("b") == 0, "family").when(F.col("c") == 0, "format").otherwise("all")
    value = F.when(F.col("a") == 0, F.col("entry_kind")).when(F.col("b") == 0, F.col("family")).when(F.col("c") == 0, F.col("format"))
    return g.select(kind.alias("kind"), value.alias("value"), "n")
