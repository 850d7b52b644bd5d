"""Column -> Column helpers over VARIANT payloads (E1-E9, E15, F10 of the blueprint).

All helpers are built-in Spark expressions, so they stay inside whole-stage codegen.
Paths use Spark's JSON path syntax (``$.a.b``, ``$[0]``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rawmart.fixed import HEX_TEXT, INTEGER_TEXT, LOCAL_MINUTE_TEXT, NUMBER_TEXT, SPECIAL_NUMBER_TEXT, YEAR_RANGE


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def json_text(v, path: str = "$") -> Column:
    """Text of the node at ``path``: scalars as text, objects/arrays as JSON text, NULL if missing or JSON null."""
    return F.try_variant_get(_col(v), path, "string")


def json_type(v, path: str = "$") -> Column:
    """Type name of the node: OBJECT<..>, ARRAY<..>, STRING, BOOLEAN, BIGINT, DECIMAL(..), DOUBLE, VOID; NULL if missing."""
    return F.schema_of_variant(F.try_variant_get(_col(v), path, "variant"))


def json_scalar(v, path: str = "$") -> Column:
    """Scalar value as text; NULL for JSON null, a missing path and for objects/arrays (warehouse JSON_VALUE rule).

    The type test only runs when the text could be a container, so plain scalars cost one lookup.
    """
    text = json_text(v, path)
    maybe_container = text.startswith("{") | text.startswith("[")
    return F.when(maybe_container & json_type(v, path).rlike("^(OBJECT|ARRAY)"), F.lit(None).cast("string")).otherwise(
        text
    )


def json_array(v, path: str = "$") -> Column:
    """``ARRAY<VARIANT>`` at ``path``; NULL when missing or not an array (elements that are JSON null stay)."""
    return F.try_variant_get(_col(v), path, "array<variant>")


def is_object(v, path: str = "$") -> Column:
    """True when the node is a JSON object (``{}`` included); never NULL."""
    return F.coalesce(json_type(v, path).startswith("OBJECT"), F.lit(False))


def is_array(v, path: str = "$") -> Column:
    """True when the node is a JSON array (``[]`` included); never NULL."""
    return F.coalesce(json_type(v, path).startswith("ARRAY"), F.lit(False))


def truthy(v, path: str = "$") -> Column:
    """Python-style truthiness of a JSON node; never NULL.

    missing / null -> false; object, array -> non-empty; string -> non-empty (so "0" is true);
    boolean -> itself; number -> non-zero.
    """
    kind = json_type(v, path)
    node = _col(v)
    return F.coalesce(
        F.when(kind.isNull() | (kind == "VOID"), F.lit(False))
        .when(kind.startswith("OBJECT"), F.size(F.try_variant_get(node, path, "map<string,variant>")) > 0)
        .when(kind.startswith("ARRAY"), F.size(json_array(node, path)) > 0)
        .when(kind == "STRING", json_text(node, path) != "")
        .when(kind == "BOOLEAN", json_text(node, path) == "true")
        .otherwise(F.try_variant_get(node, path, "double") != 0),
        F.lit(False),
    )


def safe_long(text) -> Column:
    """Text -> BIGINT or NULL: optional sign and digits or ``0x`` hex digits, surrounding blanks allowed; decimals and
    exponents give NULL, and so does what overflows (SAFE_CAST AS INT64, whose documentation takes hex text)."""
    t = _col(text)
    digits = F.conv(F.regexp_extract(t, HEX_TEXT, 2), 16, 10)
    hexed = F.concat(F.regexp_extract(t, HEX_TEXT, 1), digits).try_cast("bigint")
    return F.when(t.rlike(INTEGER_TEXT), F.trim(t).try_cast("bigint")).when(t.rlike(HEX_TEXT), hexed)


def safe_double(text) -> Column:
    """Text -> DOUBLE or NULL for decimal / exponent numbers, and inf, infinity and nan in any letter case with an
    optional sign (SAFE_CAST AS FLOAT64, as its documentation has it).

    Spark's own cast also accepts ``1.5d`` and ``0x1p3``; the patterns keep those out.
    """
    t = _col(text)
    word = F.lower(F.trim(t))
    special = F.when(word.endswith("nan"), F.lit(float("nan"))).when(word.startswith("-"), F.lit(float("-inf"))).otherwise(F.lit(float("inf")))
    return F.when(t.rlike(NUMBER_TEXT), F.trim(t).try_cast("double")).when(t.rlike(SPECIAL_NUMBER_TEXT), special)


def local_ts_to_utc(text, tz: str, strict: bool = False) -> Column:
    """``yyyy-MM-ddTHH:mm`` local wall time in ``tz`` -> UTC instant as TIMESTAMP_NTZ (PARSE_TIMESTAMP).

    Independent of the session time zone. In a DST gap the wall time is shifted forward, in an
    overlap the earlier instant is taken. Bad text gives NULL, or fails the query when ``strict``.
    """
    t = _col(text)
    wall = F.when(t.rlike(LOCAL_MINUTE_TEXT), t.try_cast("timestamp_ntz"))
    utc = F.convert_timezone(F.lit(tz), F.lit("UTC"), wall)
    if strict:
        utc = F.when(t.isNotNull() & utc.isNull(), F.raise_error(F.concat(F.lit("bad local time: "), t))).otherwise(
            utc
        )
    return utc


def year_bucket(year, lo: int = YEAR_RANGE[0], hi: int = YEAR_RANGE[1], step: int = YEAR_RANGE[2]) -> Column:
    """RANGE_BUCKET(year, GENERATE_ARRAY(lo, hi, step)): 0 below ``lo``, 1.. inside, one catch-all above."""
    n = (hi - lo) // step
    return F.width_bucket(_col(year), F.lit(lo), F.lit(lo + n * step), F.lit(n))


def day_of(ts) -> Column:
    """UTC calendar day of a UTC TIMESTAMP_NTZ value (DATE(ts))."""
    return F.to_date(_col(ts))


def parse_once(df, text: str, out: str = "payload", keep=None, strict: bool = False):
    """Add ``out`` = the JSON text column parsed to VARIANT, parsed exactly once per row.

    The parse sits behind a one-element ``explode``: a filter on ``out`` cannot be pushed below a
    Generate, so Catalyst cannot substitute the parse into every predicate (which would re-parse
    the body once per JSON path and bloat generated code). Text that is not JSON gives NULL unless
    ``strict``.
    """
    parse = F.parse_json if strict else F.try_parse_json
    cols = list(keep) if keep is not None else [c for c in df.columns if c != text]
    return df.select(*cols, F.explode(F.array(parse(F.col(text)))).alias(out))
