"""Canonical JSON, hashes and identifiers.

Identity is the SHA-256 of canonical JSON: sorted keys, no blanks, ASCII escapes, finite numbers only.
"""

from __future__ import annotations

import hashlib
import json
import math
import unicodedata
from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The one place that names our identifiers' scheme.
SCHEME = "kst"
URN = f"urn:{SCHEME}"
UNICODE_VERSION = unicodedata.unidata_version


class KStateError(ValueError):
    """Input that breaks a rule of the model."""


def canonical_json(value: Any) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=True, allow_nan=False)


def digest(value: Any) -> str:
    """``sha256-`` and the hash of the value's canonical JSON."""
    return "sha256-" + hashlib.sha256(canonical_json(value).encode()).hexdigest()


def canonical_value(value: Any) -> Any:
    """Strings and keys in NFC, lists in order; non-finite numbers, lone surrogates and colliding keys are refused."""
    if isinstance(value, str):
        if any(0xD800 <= ord(c) <= 0xDFFF for c in value):
            raise KStateError("text holds a lone surrogate")
        return unicodedata.normalize("NFC", value)
    if isinstance(value, float) and not math.isfinite(value):
        raise KStateError("number is not finite")
    if isinstance(value, list | tuple):
        return [canonical_value(v) for v in value]
    if isinstance(value, dict):
        out = {canonical_value(k): canonical_value(v) for k, v in value.items()}
        if len(out) != len(value):
            raise KStateError("two keys are one in NFC")
        return out
    return value


@F.pandas_udf(T.StringType())
def canonical_json_text(text: pd.Series) -> pd.Series:
    """A JSON text in canonical form; null stays null."""
    return text.map(lambda t: None if t is None else canonical_json(canonical_value(json.loads(t))))


@F.pandas_udf(T.StringType())
def json_string(text: pd.Series) -> pd.Series:
    """A string as a JSON literal with ASCII escapes; null becomes the literal null."""
    return text.map(lambda t: "null" if t is None else json.dumps(t))


@F.pandas_udf(T.StringType())
def json_string_list(items: pd.Series) -> pd.Series:
    """An array of strings as a JSON list."""
    return items.map(lambda x: canonical_json([] if x is None else list(x)))


def json_object(fields: dict[str, Column]) -> Column:
    """Canonical JSON of an object whose values are given as JSON texts."""
    parts: list[Column] = []
    for i, k in enumerate(sorted(fields)):
        parts += [F.lit(("," if i else "{") + json.dumps(k) + ":"), fields[k]]
    return F.concat(*parts, F.lit("}"))


def sha256_id(payload: Column) -> Column:
    return F.concat(F.lit("sha256-"), F.sha2(payload, 256))
