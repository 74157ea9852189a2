"""Column functions over text, numbers and JSON."""

from __future__ import annotations

from typing import Any

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values: formats -----------------------------------------------------
TIME_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
TOKEN_HOST = "github.com"
TOKEN_PATTERN = r"(?U)ghp_\w+@"
HEADLINE_CHARS = 10
UUID_NOISE = r"urn:|uuid:"
# --------------------------------------------------------------------------------

DIGESTS = {
    "md5": F.md5,
    "sha1": F.sha1,
    "sha224": lambda c: F.sha2(c, 224),
    "sha256": lambda c: F.sha2(c, 256),
    "sha384": lambda c: F.sha2(c, 384),
    "sha512": lambda c: F.sha2(c, 512),
}


def _c(col: str | Column) -> Column:
    return F.col(col) if isinstance(col, str) else col


def hash_item(col: str | Column, fn: str = "md5") -> Column:
    """Hex digest of the value's text."""
    if fn not in DIGESTS:
        raise ValueError(f"unknown digest {fn!r}")
    return DIGESTS[fn](_c(col).cast("string"))


def is_valid_uuid(col: str | Column) -> Column:
    """True when the text reads as a UUID: 32 hex digits once ``urn:``, ``uuid:``, outer braces
    and hyphens are taken away."""
    bare = F.regexp_replace(_c(col), UUID_NOISE, "")
    bare = F.regexp_replace(F.trim(bare, F.lit("{}")), "-", "")
    return F.coalesce(bare.rlike("^[0-9a-fA-F]{32}$"), F.lit(False))


def to_b64(col: str | Column) -> Column:
    """Base64 on one line."""
    return F.translate(F.base64(_c(col).cast("binary")), "\r\n", "")


def from_b64(col: str | Column) -> Column:
    return F.unbase64(_c(col)).cast("string")


def to_json_text(col: str | Column) -> Column:
    """JSON text of a struct, map, array or variant."""
    return F.to_json(_c(col))


def from_json_text(col: str | Column, schema: T.DataType | str | None = None) -> Column:
    """JSON text as ``schema``, or as a variant; null when it does not parse."""
    return F.try_parse_json(_c(col)) if schema is None else F.from_json(_c(col), schema)


def normalize_numbers(col: str | Column, data_type: T.DataType) -> Column:
    """Whole floating numbers become integers, through structs and arrays.

    A column has one type, so a number turns into a variant that holds a BIGINT when it is whole
    and a DOUBLE otherwise; its JSON text is then ``3`` and not ``3.0``.
    """
    col = _c(col)
    if isinstance(data_type, (T.DoubleType, T.FloatType)):
        number = col.cast("double")
        whole = (number == F.floor(number)) & (F.abs(number) < F.lit(2.0**63))
        # Through a JSON number, so that both branches share the variant type.
        return F.when(whole, F.try_parse_json(number.cast("bigint").cast("string"))).otherwise(
            F.try_parse_json(number.cast("string"))
        )
    if isinstance(data_type, T.StructType):
        fields = [
            normalize_numbers(col[f.name], f.dataType).alias(f.name) for f in data_type.fields
        ]
        return F.when(col.isNotNull(), F.struct(*fields))
    if isinstance(data_type, T.ArrayType):
        return F.transform(col, lambda e: normalize_numbers(e, data_type.elementType))
    return col


def epoch_to_time(col: str | Column) -> Column:
    """Epoch seconds to an instant."""
    return F.timestamp_seconds(_c(col))


def time_to_epoch(col: str | Column) -> Column:
    """Whole epoch seconds of an instant."""
    return F.unix_seconds(_c(col).cast("timestamp"))


def time_to_ns(col: str | Column) -> Column:
    """Epoch nanoseconds of an instant (microsecond precision)."""
    return F.unix_micros(_c(col).cast("timestamp")) * 1000


def ns_to_time(col: str | Column) -> Column:
    """Instant of epoch nanoseconds, cut to whole microseconds in integer arithmetic."""
    ns = _c(col)
    return F.timestamp_micros(
        F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000))
    )


def time_text(col: str | Column) -> Column:
    return F.date_format(_c(col), TIME_TEXT)


def scrub_tokens(col: str | Column) -> Column:
    """Take access tokens out of remote URLs."""
    col = _c(col)
    return F.when(
        col.contains(TOKEN_HOST), F.regexp_replace(col, TOKEN_PATTERN, "")
    ).otherwise(col)


@F.pandas_udf(T.DoubleType())
def round_sig4(values: pd.Series) -> pd.Series:
    """Four significant digits of the exact binary value, ties to even.

    The JVM's formatter rounds the shortest decimal text half up, which differs for values such
    as 959.15, so this runs on Arrow batches.
    """
    return values.map(lambda v: float(f"{v:.4g}"), na_action="ignore")


def round_sig4_float(col: str | Column) -> Column:
    """:func:`round_sig4` of a ``float`` column, as double, without leaving the JVM.

    A float widened to double has all its digits in the double's shortest text as far as it matters
    here: a text that ends in a 5 right after the fourth digit is an exact tie, and goes to the even
    neighbour; the formatter, which rounds such ties up, settles all others.
    """
    value = _c(col).cast("double")
    digits = F.format_string("%.17e", value)
    parts = r"^(-?\d\.\d{3})50{13}(e[+-]\d+)$"
    even = F.regexp_like(digits, F.lit(r"^-?\d\.\d{2}[02468]50{13}e"))
    cut = F.regexp_replace(digits, parts, "$1$2")
    text = F.when(even, cut).otherwise(F.format_string("%.3e", value))
    return F.when(value.isNotNull(), text).cast("double")


def message_lines(col: str | Column) -> Column:
    """Lines of a message; a final line break ends the last line and opens none."""
    return F.split(F.regexp_replace(_c(col), r"\r?\n\z", ""), r"\r?\n")


def log_headline(col: str | Column) -> Column:
    """The message itself when it is one line, else the start of its first line."""
    lines = message_lines(col)
    return F.when(F.size(lines) == 1, lines[0]).otherwise(
        F.concat(F.substring(lines[0], 1, HEADLINE_CHARS), F.lit("..."))
    )


def envelope(trace_id: str | Column, body: str | Column) -> Column:
    """``{"id": trace, "out": body}`` around a JSON body, text kept as it is."""
    return F.concat(
        F.lit('{"id":"'), _c(trace_id), F.lit('","out":'), _c(body), F.lit("}")
    )


def resolve_resource(user: str | Column, stored: str | Column, default: Any) -> Column:
    """The user's value, else the stored one, else the default; '' and 0 count as missing."""
    empty = F.lit("") if isinstance(default, str) else F.lit(0)
    return F.coalesce(F.nullif(_c(user), empty), F.nullif(_c(stored), empty), F.lit(default))


def merge_kwargs(defaults: str | Column, passed: str | Column) -> Column:
    """Defaults overlaid by passed values, as maps; passed values win, nulls are kept."""
    defaults, passed = _c(defaults), _c(passed)
    kept = F.map_filter(defaults, lambda k, _: ~F.map_contains_key(passed, k))
    return F.map_concat(kept, passed)
