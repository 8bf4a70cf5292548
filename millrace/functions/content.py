"""Content types, decoding and encoding of payloads. All column expressions."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.envelope import CONTENT_TYPE, JSON, header, put_headers

CORRUPT = "_corrupt"
UNSUPPORTED = "ConversionException"
MALFORMED = "MessageConversionException"


def content_type(default: str = JSON) -> Column:
    """Effective content type: the message's header with quotes stripped, else the binding's."""
    return F.coalesce(F.regexp_replace(header(CONTENT_TYPE), '"', ""), F.lit(default))


def media_type(ct: Column) -> Column:
    """Type and subtype without parameters, in lower case."""
    return F.lower(F.trim(F.substring_index(ct, ";", 1)))


def is_json(ct: Column) -> Column:
    media = media_type(ct)
    return (media == JSON) | media.rlike("^application/.*\\+json$")


def is_bytes(ct: Column) -> Column:
    return media_type(ct) == "application/octet-stream"


def is_text(ct: Column) -> Column:
    return media_type(ct).startswith("text/")


def decode_json(value: Column, schema: T.DataType) -> Column:
    """JSON text to a struct, list or map. For a struct, a text that does not parse leaves its
    original in the field `_corrupt`."""
    if isinstance(schema, T.StructType):
        schema = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
        return F.from_json(value, schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return F.from_json(value, schema)


def decode_text(value: Column, listed: bool = False) -> Column:
    """Bytes to a UTF-8 string; a list payload is decoded element by element."""
    return F.transform(value, lambda v: F.decode(v, "UTF-8")) if listed else F.decode(value, "UTF-8")


# What tells by the content type whether a converter takes a message, and how it turns the value into data.
Converter = tuple[Callable[[Column], Column], Callable[[Column], Column]]


def decode(df: DataFrame, schema: T.StructType, default: str = JSON, native: bool = False, converters: Sequence[Converter] = ()) -> DataFrame:
    """Add the decoded payload and what went wrong with it, in one pass.

    The first converter that supports the content type is used: `data` holds the struct of a JSON
    payload, `text` the string of a text one, `bytes` any other supported one; `error` is null for
    good rows and tombstones. `converters` of the caller come before the built-in ones, in their order; the first whose
    test is true for the content type gives `data`, a struct of the schema, from the value, and a value that it turns
    into null is an error. With `native` the framework stays out: `data` is cast from the value."""
    if native:
        value = F.col("value")
        if isinstance(schema, T.StructType) and not isinstance(df.schema["value"].dataType, T.StructType):
            # A declared structure is read from its JSON text, whatever the content type says.
            return _split_parsed(df.withColumn("_parsed", _once(decode_json(value.cast("string"), schema))), schema, F.lit(None).cast("string"), F.lit(True))
        return df.withColumns({"data": value.cast(schema), "error": F.lit(None).cast("string")})
    ct, value = content_type(default), F.col("value").cast("string")
    if not converters:
        out = df.withColumns({
            "_parsed": _once(F.when(is_json(ct), decode_json(value, schema))),
            "text": F.when(is_text(ct), value),
            "bytes": F.when(is_bytes(ct), F.col("value").cast("binary")),
            "error": F.when(F.col("value").isNull(), None)
            .when(~(is_json(ct) | is_text(ct) | is_bytes(ct)), UNSUPPORTED),
        })
        return _split_parsed(out, schema, F.col("error"), is_json(ct))
    # Which converter takes the row: the caller's by number, else none of them.
    which = F.coalesce(*[F.when(F.coalesce(takes(ct), F.lit(False)), n) for n, (takes, _) in enumerate(converters)], F.lit(-1))
    made = reduce(lambda chain, c: chain.when(which == c[0], c[1][1](F.col("value")).cast(schema)), enumerate(converters), F.when(F.lit(False), F.lit(None).cast(schema)))
    rest = decode(df.withColumns({"_which": which, "_made": _once(F.when(F.col("value").isNotNull(), made))}), schema, default)
    own = F.col("_which") >= 0
    failed = F.when(F.col("value").isNotNull() & F.col("_made").isNull(), F.lit(MALFORMED))
    return rest.withColumns({"data": F.when(own, F.col("_made")).otherwise(F.col("data")), "error": F.when(own, failed).otherwise(F.col("error")),
                             **{c: F.when(~own, F.col(c)) for c in ("text", "bytes")}}).drop("_which", "_made")


def _once(parsed: Column) -> Column:
    """The same value, as an element of an array that a generator unpacks: Spark does not copy what it produces into
    filters and later projections, so each payload is parsed once."""
    return F.explode(F.array(parsed))


def _split_parsed(df: DataFrame, schema: T.StructType, error: Column, json: Column) -> DataFrame:
    corrupt = F.col(f"_parsed.{CORRUPT}")
    # An empty text parses to nothing, which is no tombstone.
    empty = F.col("value").isNotNull() & F.col("_parsed").isNull() & (F.trim(F.col("value").cast("string")) == "")
    data = F.when(F.col("_parsed").isNotNull() & corrupt.isNull(),
                  F.struct(*[F.col(f"_parsed.{f.name}") for f in schema.fields]))
    error = F.coalesce(error, F.when(corrupt.isNotNull() | (empty & json), F.lit(MALFORMED)))
    return df.withColumns({"error": error, "data": data}).drop("_parsed")


def encode_payload(data: Column, ct: Column, raw: Column | None = None) -> Column:
    """Struct to payload text by content type: JSON for JSON types, plain text of a single field
    for text types. `raw`, a payload that is bytes already, passes through."""
    encoded = F.when(data.isNull(), None).when(is_json(ct), F.to_json(data))
    encoded = encoded.when(is_text(ct), data.cast("string"))
    return F.coalesce(raw, encoded) if raw is not None else encoded


def encode(df: DataFrame, data: Column, default: str = JSON, raw: Column | None = None) -> DataFrame:
    """Set `value` from `data` by the effective content type, and the header where it is missing.
    Null data stays null, so tombstones go out in the same write. `error` is set where there is data and no way to
    encode it; such a row's null value is no tombstone and must not be sent as one."""
    ct = content_type(default)
    unsupported = data.isNotNull() & ~(is_json(ct) | is_text(ct))
    if raw is not None:
        unsupported &= raw.isNull()
    return df.withColumns({
        "error": F.when(unsupported, F.lit(UNSUPPORTED)),
        "value": encode_payload(data, ct, raw),
        "headers": put_headers({CONTENT_TYPE: F.coalesce(header(CONTENT_TYPE), F.lit(default))}),
    })


def cast_native(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Native coding: declared types instead of the framework's conversion."""
    return df.withColumns({name: F.col(name).cast(dtype) for name, dtype in types.items()})
