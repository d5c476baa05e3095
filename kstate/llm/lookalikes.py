"""Visually identical text with different characters, brought to one form.

Classes of look-alikes are the connected parts of a graph over strings and code points, built by
union-find from the Unicode data (widths, ligatures, blanks, hyphens) and a fixed letter table. The
representative of a class is its most frequent code point over the whole corpus. Texts are rewritten
greedily, leftmost and longest first, by one automaton over all other members.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Letters of Latin, Greek and Cyrillic drawn alike (one class a group, letter case kept).
LOOK_ALIKE_LETTERS = (
    "AΑА BΒВ CСϹ EΕЕ HΗН IΙІ JЈ KΚК MΜМ NΝ OΟО PΡР SЅ TΤТ XΧХ YΥҮ ZΖ GԌ QԚ WԜ ΓГ ΠП ΦФ "
    "aа cсϲ eе iі jјϳ oοо pρр sѕ xх yу vνѵ hһ dԁ qԛ wԝ ΛɅ κк"
)
# Marks and signs that draw nothing. U+200C and U+200D stand apart, see _JOINER.
INVISIBLE = "\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180e\u200b\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2060\u2061\u2062\u2063\u2064\u2066\u2067\u2068\u2069\u206a\u206b\u206c\u206d\u206e\u206f\ufeff\ufff9\ufffa\ufffb"
# Single blanks besides U+0020, hyphens besides U+002D.
BLANKS = "\u00a0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u202f\u205f\u3000"
HYPHENS = "\u2010\u2011\ufe63\u2043"
#: Joiners draw nothing, except between pictographs (one sign or two) and after an Indic virama.
_VIRAMA = "्্੍્୍்్್്්"
_PICTURE = "\U0001f000-\U0001faff☀-➿"
_JOINER = re.compile(
    f"(?<![{_VIRAMA}{_PICTURE}️])[‌‍]|(?<=[{_PICTURE}️])‌|(?<=[{_PICTURE}️])‍(?![{_PICTURE}])"
)


class UnionFind:
    """Plain union-find over hashable members; the smaller member is the root."""

    def __init__(self) -> None:
        self.up: dict[str, str] = {}

    def find(self, x: str) -> str:
        root = x
        while (y := self.up.get(root, root)) != root:
            root = y
        while x != root:
            self.up[x], x = root, self.up.get(x, x)
        return root

    def join(self, x: str, y: str) -> None:
        a, b = sorted((self.find(x), self.find(y)))
        self.up[a] = a
        self.up[b] = a


@lru_cache(maxsize=1)
def variant_links() -> tuple[tuple[str, str], ...]:
    """(code point, string it is drawn as) for widths and ligatures, by rule from the Unicode data."""
    links = []
    for cp in range(0xA0, sys.maxunicode + 1):
        if 0xAC00 <= cp <= 0xD7A3 or 0xD800 <= cp <= 0xDFFF:
            continue
        kind, _, rest = unicodedata.decomposition(c := chr(cp)).partition("> ")
        if kind in ("<wide", "<narrow", "<noBreak"):
            links.append((c, "".join(chr(int(x, 16)) for x in rest.split())))
        elif kind == "<compat" and unicodedata.category(c)[0] == "L":
            whole = "".join(chr(int(x, 16)) for x in rest.split())
            if len(whole) > 1 and whole.isalpha():
                links.append((c, whole))
    return tuple(links)


def look_alike_classes(frequency: dict[str, int]) -> dict[str, str]:
    """Every string that is not its class's representative, with that representative.

    A class is represented by its most frequent code point, ties by the smaller one. Only one with a member of several code
    points is represented by the longest such member (the spelled-out ligature), whatever the frequencies: were the
    ligature the form, the same letters could be left in two ways (ff + i, f + fi).
    The Unicode form is decomposed: a letter with an accent stands for its base and its marks.
    """
    uf = UnionFind()
    for c, whole in variant_links():
        uf.join(c, unicodedata.normalize("NFD", whole))
    for group in LOOK_ALIKE_LETTERS.split():
        for c in group[1:]:
            uf.join(group[0], c)
    for c in BLANKS:
        uf.join(" ", c)
    for c in HYPHENS:
        uf.join("-", c)
    members: dict[str, list[str]] = {}
    for x in list(uf.up):
        members.setdefault(uf.find(x), []).append(x)
    of: dict[str, str] = {}
    for group in members.values():
        long = [x for x in group if len(x) > 1]
        best = min(long, key=lambda x: (-len(x), x)) if long else min(group, key=lambda x: (-frequency.get(x, 0), x))
        of |= {x: best for x in group if x != best}
    # spelled-out members consist of representatives themselves
    spelled = {x: "".join(of.get(c, c) for c in y) for x, y in of.items()}
    spelled |= dict.fromkeys(INVISIBLE, "")
    return spelled


class Rewriter:
    """Greedy leftmost-longest rewriting by one multi-pattern automaton."""

    def __init__(self, classes: dict[str, str]) -> None:
        self.classes = classes
        self.automaton = ahocorasick.Automaton()
        for x, y in classes.items():
            self.automaton.add_word(x, (len(x), y))
        self.automaton.make_automaton()
        self.ascii_matters = any(x.isascii() for x in classes)

    def __call__(self, text: str) -> str:
        if text.isascii() and not self.ascii_matters:
            return text
        if not text.isascii():
            if "‌" in text or "‍" in text:
                text = _JOINER.sub("", text)
            text = unicodedata.normalize("NFD", text)
        out, at = [], 0
        for end, (n, new) in self.automaton.iter_long(text):
            start = end + 1 - n
            out.append(text[at:start])
            out.append(new)
            at = end + 1
        if at:
            out.append(text[at:])
            text = "".join(out)
        return text if text.isascii() else unicodedata.normalize("NFC", unicodedata.normalize("NFD", text))


def code_point_counts(texts: DataFrame, column: str = "text") -> dict[str, int]:
    """How often each code point occurs in all texts. At most one row per code point reaches the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(0x110000, dtype=np.int64)
        for b in batches:
            joined = "".join(x for x in b.column(0).to_pylist() if x)
            for i in range(0, len(joined), 1 << 20):
                cps = np.frombuffer(joined[i : i + (1 << 20)].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
                part = np.bincount(cps)
                total[: len(part)] += part
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(total[seen], pa.int64())], names=["cp", "n"])

    rows = texts.select(column).filter(F.col(column).isNotNull()).mapInArrow(count, "cp int, n long").groupBy("cp").agg(F.sum("n").alias("n")).collect()
    return {chr(r.cp): r.n for r in rows}


def canonical_text(df: DataFrame, column: str = "text", out: str = "canonical", frequency: dict[str, int] | None = None, digest_only: bool = False) -> DataFrame:
    """Adds ``out``: the text in its one form (or, with digest_only, its 16-byte digest).

    Texts equal but for accents composed or not, widths, ligatures, invisible signs, kinds of single
    blank or hyphen and look-alike letters get the same form; letter case, accents and all else stay.
    Null stays null, the empty text stays empty; a text of any length is rewritten whole.
    """
    if frequency is None:
        frequency = code_point_counts(df, column)
    classes = look_alike_classes(frequency)
    position = df.columns.index(column)
    kind = pa.binary() if digest_only else pa.string()

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = Rewriter(classes)
        for b in batches:
            texts = b.column(position).to_pylist()
            new = [None if t is None else r(t) for t in texts]
            if digest_only:
                new = [None if t is None else hashlib.md5(t.encode("utf-8", "surrogatepass")).digest() for t in new]
            cols, names = [], []
            for i, name in enumerate(b.schema.names):
                if i != position or not digest_only:
                    cols.append(b.column(i))
                    names.append(name)
            yield pa.RecordBatch.from_arrays([*cols, pa.array(new, kind)], names=[*names, out])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if not (digest_only and f.name == column))
    return df.mapInArrow(rewrite, f"{schema}, `{out}` {'binary' if digest_only else 'string'}")


def _shared_forms(units: DataFrame, group: str, key: str, column: str) -> DataFrame:
    """(g, form, spelling, k), each once, of the rows whose form has several spellings. Only digests are shuffled."""
    t = units.select(F.col(group).alias("g"), F.col(key).alias("k"), F.col(column).alias("text")).filter("text is not null and k is not null")
    frequency = code_point_counts(t)
    t = t.withColumn("spelling", F.unhex(F.md5("text")))
    t = canonical_text(t, "text", "form", frequency, digest_only=True).select("g", "k", "spelling", "form")
    many = t.groupBy("g", "form").agg(F.min("spelling").alias("lo"), F.max("spelling").alias("hi")).filter("lo <> hi").select("g", "form")
    return t.join(many, ["g", "form"], "left_semi").distinct()


def look_alike_pairs(units: DataFrame, group: str = "table_name", key: str = "unit_no", column: str = "text") -> DataFrame:
    """(group, <key>_a, <key>_b): pairs a < b within a group whose texts differ but share one form.

    Rows with null text or key take no part, a row delivered twice counts once, other columns are
    ignored. Forms with a single spelling drop out before the pairing, and the pairs are formed between
    spellings, so copies of one spelling never meet each other.
    """
    t = _shared_forms(units, group, key, column)
    a = t.select("g", "form", F.col("k").alias("ka"), F.col("spelling").alias("sa"))
    b = t.select("g", "form", F.col("k").alias("kb"), F.col("spelling").alias("sb"))
    pairs = a.join(b, ["g", "form"]).filter("sa <> sb and ka < kb")
    return pairs.select(F.col("g").alias(group), F.col("ka").alias(f"{key}_a"), F.col("kb").alias(f"{key}_b")).distinct()


def look_alike_groups(units: DataFrame, group: str = "table_name", key: str = "unit_no", column: str = "text") -> DataFrame:
    """(group, <key>, class_id, spelling_id): one row for each row whose text has look-alikes, however many.

    class_id is the smallest key with the same form, spelling_id the smallest with the very same text; two rows look alike
    where the class is one and the spellings differ. Odd rows count as in look_alike_pairs.
    """
    t = _shared_forms(units, group, key, column)
    own = t.groupBy("g", "form", "spelling").agg(F.min("k").alias("spelling_id"))
    whole = own.groupBy("g", "form").agg(F.min("spelling_id").alias("class_id"))
    out = t.join(own, ["g", "form", "spelling"]).join(whole, ["g", "form"])
    return out.select(F.col("g").alias(group), F.col("k").alias(key), "class_id", "spelling_id")
