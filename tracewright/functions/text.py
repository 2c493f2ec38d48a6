"""Column builders for text, hashes and JSON fields."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def strip(c: Column | str) -> Column:
    """Without white space at both ends, Unicode white space included."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def sha16(c: Column) -> Column:
    return F.substring(F.sha2(c, 256), 1, 16)


def is_sha256(c: Column) -> Column:
    return c.rlike("^[0-9a-fA-F]{64}$")


def json_at(c: Column | str, path: str) -> Column:
    """The value at a JSON path as text; null where the text is no JSON or the path leads nowhere."""
    return F.get_json_object(c, path)


def is_json(c: Column) -> Column:
    """Whether a text is one JSON value and nothing else; Spark's own parser stops after the first value."""
    listed = F.try_parse_json(F.concat(F.lit("["), c, F.lit("]")))
    return listed.isNotNull() & F.try_variant_get(listed, "$[0]", "variant").isNotNull() & F.try_variant_get(listed, "$[1]", "variant").isNull()


def matches_suffix(c: Column, patterns: list[str]) -> Column:
    """Whether a path ends with a ``*suffix`` pattern or is one of the exact names."""
    test = F.lit(False)
    for p in patterns:
        test = test | (c.endswith(p[1:]) if p.startswith("*") else (F.element_at(F.split(c, "/"), -1) == p))
    return test



def without(value, key: str | None):
    return {k: v for k, v in value.items() if k != key} if key and isinstance(value, dict) else value


def canonical_text(text: str | None, drop: str | None = None) -> str | None:
    """The canonical form of a JSON text: sorted keys, no blanks, other alphabets as they are; None if it doesn't parse."""
    if text is None:
        return None
    try:
        return json.dumps(without(json.loads(text), drop), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    except (ValueError, RecursionError):
        return None


def canonical_json(c: Column | str, drop: str | None = None) -> Column:
    """Canonical JSON, optionally without one top-level key. Byte-stable forms need the parser's own view of numbers and
    repeated keys, which neither ``to_json`` nor variants keep, so this runs over Arrow batches."""

    @F.pandas_udf(T.StringType())
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: canonical_text(x, drop), na_action="ignore")

    return run(c)


def content_hash(c: Column | str) -> Column:
    """The hash that binds an envelope: over its canonical form without the field that carries the hash."""
    return F.sha2(canonical_json(c, "content_sha256"), 256)


def redact(c: Column | str, unicode_space: bool = True) -> Column:
    """Assignments of credentials, bearer tokens and ``sk-`` keys replaced, in this order."""
    u = "(?U)" if unicode_space else ""
    # The patterns whose matches are redacted.
    out = F.regexp_replace(c, u + r"(?i)(api[_-]?key|token|password|secret|passwd)\s*[:=]\s*\S+", r"$1: [REDACTED]")
    out = F.regexp_replace(out, u + r"(?i)bearer\s+[A-Za-z0-9._\-]+", "[REDACTED]")
    return F.regexp_replace(out, u + r"\bsk-[A-Za-z0-9]{10,}\b", "[REDACTED]")


def human_bytes(c: Column) -> Column:
    """1536 -> 1.5 KiB."""
    return (
        F.when(c < 1024, F.format_string("%d B", c.cast("bigint")))
        .when(c < 1 << 20, F.format_string("%.1f KiB", c / 1024.0))
        .when(c < 1 << 30, F.format_string("%.1f MiB", c / float(1 << 20)))
        .otherwise(F.format_string("%.1f GiB", c / float(1 << 30)))
    )


def human_seconds(c: Column) -> Column:
    """93784 -> 1d 2h 3m."""
    s = c.cast("bigint")
    return F.format_string("%dd %dh %dm", F.floor(s / 86400), F.floor(s % 86400 / 3600), F.floor(s % 3600 / 60))


def micros(c: Column | str) -> Column:
    """Microseconds since 1970 of a time with or without zone (UTC)."""
    return F.unix_micros((F.col(c) if isinstance(c, str) else c).cast("timestamp"))
