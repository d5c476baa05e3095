"""Text functions: normal forms, labels, keys, tokens, slugs, similarity.

Unicode rules that Spark has no built-in for (NFC, case folding) run as Arrow-batched functions; all
others stay in the JVM.
"""

from __future__ import annotations

import difflib
import unicodedata

import pandas as pd
import regex
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


@F.pandas_udf(T.StringType())
def nfc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFC", t))


def line_ends(text: Column) -> Column:
    """CRLF and CR become LF."""
    return F.regexp_replace(text, "\r\n?", "\n")


def normal_text(text: Column) -> Column:
    """Line ends as LF, then NFC; blanks stay."""
    return nfc(line_ends(text))


def fold(t: str) -> str:
    """NFC, case folded, every run of white space one blank, none outside."""
    return " ".join(unicodedata.normalize("NFC", t).casefold().split())


@F.pandas_udf(T.StringType())
def label(text: pd.Series) -> pd.Series:
    """The form in which names and statements are compared."""
    return text.map(lambda t: None if t is None else fold(t))


@F.pandas_udf(T.StringType())
def path_key(path: pd.Series) -> pd.Series:
    """The form in which canonical paths are compared; null for paths that are absolute or climb."""

    def one(p: str | None) -> str | None:
        parts = [x for x in unicodedata.normalize("NFC", (p or "").replace("\\", "/")).split("/")]
        if not p or parts[0] == "" or any(x in ("", ".", "..") for x in parts):
            return None
        return "/".join(x.casefold() for x in parts)

    return path.map(one)


def path_title(path: Column) -> Column:
    """Label of a path's last part without its .md, hyphens and underscores as blanks."""
    base = F.regexp_replace(F.substring_index(path, "/", -1), r"(?i)\.md$", "")
    return label(F.regexp_replace(base, "[-_]+", " "))


def id_key(c: Column) -> Column:
    """The form in which ids typed by hand are compared: no outer blanks, no letter case; blank counts as null."""
    k = F.lower(F.regexp_replace(c, r"(?U)^[\s\x{200B}\x{FEFF}]+|[\s\x{200B}\x{FEFF}]+$", ""))
    return F.when(k != "", k)


def label_tokens(text: Column) -> Column:
    """Distinct case-folded runs of letters and digits longer than one sign."""
    runs = F.regexp_extract_all(label(text), F.lit(r"([\p{L}\p{N}]+)"), F.lit(1))
    return F.array_distinct(F.filter(runs, lambda t: F.length(t) > 1))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two token sets; 0 if both are empty."""
    union = F.size(F.array_union(a, b))
    return F.when(union > 0, F.size(F.array_intersect(a, b)) / union).otherwise(F.lit(0.0))


_NOT_WORD = regex.compile(r"[^\p{L}\p{N}]+")


def slug_of(text: str) -> str:
    return _NOT_WORD.sub("-", unicodedata.normalize("NFC", text).casefold()).strip("-")


@F.pandas_udf(T.StringType())
def slug(text: pd.Series) -> pd.Series:
    """Case folded letters and digits, every other run one hyphen, none outside."""
    return text.map(lambda t: None if t is None else slug_of(t))


def name_ratio(name: str, keys: list[str]) -> float:
    """Best Ratcliff-Obershelp ratio of a name with any key; not symmetric, the name comes first."""
    return max((difflib.SequenceMatcher(None, name, k).ratio() for k in keys), default=0.0)


@F.pandas_udf(T.DoubleType())
def lexical_similarity(name: pd.Series, keys: pd.Series, overlap: pd.Series) -> pd.Series:
    """0.55 of the name ratio and 0.45 of the token overlap, to six places."""
    return pd.Series([round(0.55 * name_ratio(n or "", list(k)) + 0.45 * o, 6) for n, k, o in zip(name, keys, overlap)], dtype="float64")


def ratio_bound(name: Column, keys: Column) -> Column:
    """What name_ratio cannot exceed, from lengths alone."""
    n = F.length(name)
    one = lambda k: F.when(n + F.length(k) > 0, 2.0 * F.least(n, F.length(k)) / (n + F.length(k))).otherwise(F.lit(1.0))
    return F.coalesce(F.array_max(F.transform(keys, one)), F.lit(0.0))
