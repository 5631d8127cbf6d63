"""Reading JSON text: one parse per row, defaults instead of nulls, nothing ever raises.

Parsed fields come out of ``inline(array(from_json(...)))`` instead of a plain projection.  Catalyst
moves filters below projections by repeating the expression, which would parse each message once
more for every predicate; it cannot move them below a generator, so the text is parsed once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ripplelake.schema import FRAME_PREFIX, MAX_EPOCH_SECONDS, WIRE

JSON_SPACE = r" \t\r\n"

_STRICT = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_broken", "allowSingleQuotes": "false"}

# The message stands twice, inside an array and as a member, followed by an end mark.  One that is cut short, or that has
# anything after its closing brace, breaks one of them: closing the array leaves a stray bracket in the member, and
# closing the member a stray brace in the array.
_WRAPPED = T.StructType(
    [
        T.StructField("_items", T.ArrayType(T.StructType([]))),
        T.StructField("_one", T.StructType([])),
        T.StructField("_end", T.IntegerType()),
        T.StructField("_broken", T.StringType()),
    ]
)

_NUMBER = r"^-?[0-9]+([.][0-9]+)?([eE][-+]?[0-9]+)?$"


def spread(df: DataFrame, struct: Column) -> DataFrame:
    """Add the fields of ``struct`` as columns, computing it once per row."""
    return df.select("*", F.inline(F.array(struct)))


def with_error(df: DataFrame, text: str = "raw_message") -> DataFrame:
    """Add ``_error``: empty for a message that is exactly one JSON object, else the reason."""
    wrapped = f"""'{{"_items":[' || {text} || '],"_one":' || {text} || ',"_end":1}}'"""
    one_object = "_broken IS NULL AND _end = 1 AND size(_items) = 1 AND _items[0] IS NOT NULL"
    body = f"ltrim('{JSON_SPACE}', coalesce({text}, ''))"
    error = F.expr(
        f"CASE WHEN {one_object} THEN '' WHEN {body} = '' THEN 'empty message' "
        f"WHEN startswith({body}, '{{') THEN 'malformed JSON' ELSE 'not a JSON object' END AS _error"
    )
    return spread(df, F.from_json(F.expr(wrapped), _WRAPPED, _STRICT)).select(*df.columns, error)


def parse_wire(df: DataFrame, text: str = "raw_message") -> DataFrame:
    """Add the event fields, each null where it is missing or of another type."""
    return spread(df, F.from_json(text, WIRE))


def strict_text(field: str, text: str = "raw_message") -> Column:
    """A parsed text field; missing and non-text values are ``''``.

    Spark reads an unquoted number, boolean, array or object into a string field as its JSON text.  Only
    where the value could be such a text is the message looked at again, for the type of this field.
    """
    doubtful = (
        f"(substring({field}, 1, 1) IN ('-', '0', '1', '2', '3', '4', '5', '6', '7', '8', '9') "
        f"AND {field} RLIKE '{_NUMBER}') OR {field} IN ('true', 'false') "
        f"OR (startswith({field}, '{{') AND endswith({field}, '}}')) "
        f"OR (startswith({field}, '[') AND endswith({field}, ']'))"
    )
    *parents, name = field.split(".")
    schema = f"{name} variant"
    for parent in reversed(parents):
        schema = f"{parent} struct<{schema.replace(' ', ': ', 1)}>"
    kind = f"schema_of_variant(from_json({text}, '{schema}').{field})"
    return F.expr(
        f"CASE WHEN {field} IS NULL THEN '' WHEN ({doubtful}) AND {kind} != 'STRING' THEN '' ELSE {field} END"
    )


def integer(field: str) -> Column:
    return F.expr(f"coalesce({field}, 0)")


def unsigned(field: str) -> Column:
    """Negative and missing values read as 0."""
    return F.expr(f"greatest(coalesce({field}, 0), 0)")


def flag(field: str) -> Column:
    """Boolean as 0/1, missing as 0."""
    return F.expr(f"CAST(coalesce({field}, false) AS INT)")


def difference(a: str, b: str) -> Column:
    return F.expr(f"coalesce(try_subtract({a}, {b}), 0)")


def epoch_to_timestamp(field: str) -> Column:
    """Epoch seconds as a timestamp, kept within the 32-bit range instead of raising."""
    return F.expr(f"timestamp_seconds(least(greatest(coalesce({field}, 0), 0), {MAX_EPOCH_SECONDS}))")


def frame_payload(line: str) -> Column:
    """Text after the frame prefix."""
    return F.expr(f"substring({line}, {len(FRAME_PREFIX) + 1})")


_KEY_FIELDS = "meta struct<id: variant>, title variant, id variant"


def _usable_text(field: str) -> str:
    """Text of a JSON value, null where the value counts as absent (null, '', 0, false, [], {})."""
    kind, text = f"schema_of_variant({field})", f"try_variant_get({field}, '$', 'string')"
    return (
        f"CASE WHEN {field} IS NULL OR {kind} IN ('VOID', 'ARRAY<VOID>', 'OBJECT<>') THEN NULL "
        f"WHEN {kind} = 'STRING' THEN nullif({text}, '') "
        f"WHEN {kind} = 'BOOLEAN' THEN CASE WHEN {text} = 'true' THEN 'True' END "
        f"WHEN try_variant_get({field}, '$', 'double') = 0 THEN NULL ELSE {text} END"
    )


def with_message_key(df: DataFrame, text: str = "raw_message", name: str = "kafka_key") -> DataFrame:
    """Add the message key: first usable of ``meta.id``, ``title``, ``id``, else ``''``."""
    fields = F.from_json(text, _KEY_FIELDS).alias("_key")
    choices = [_usable_text(f"_key.{f}") for f in ("meta.id", "title", "id")]
    key = F.expr(f"coalesce({', '.join(choices)}, '')")
    return spread(df, F.struct(fields)).select(*[c for c in df.columns if c != name], key.alias(name))
