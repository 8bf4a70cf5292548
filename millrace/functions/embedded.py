"""Headers carried inside the payload, for logs that have no native headers.

Layout: 0xff, number of headers, then for each header its name's length (1 byte), name, value's
length (4 bytes) and value as JSON; then the body. Built and read with binary built-ins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.envelope import CONTENT_TYPE

# Headers that are always embedded if present.
STANDARD = ["correlationId", "sequenceSize", "sequenceNumber", CONTENT_TYPE]

_ENTRY = "array<struct<k:string,v:string>>"


def _bytes_of(number: Column, width: int) -> Column:
    return F.unhex(F.lpad(F.hex(number.cast("bigint")), 2 * width, "0"))


def _number_at(payload: Column, at: Column, width: int) -> Column:
    return F.conv(F.hex(F.substring(payload, at, F.lit(width))), 16, 10).cast("int")


def _json_string(c: Column) -> Column:
    """A string as a JSON string."""
    return F.regexp_extract(F.to_json(F.array(c)), "(?s)^\\[(.*)\\]$", 1)


def embed_headers(body: Column, headers: Column, names: Sequence[str] = ()) -> Column:
    """The payload with the standard headers and those named put in front of its body. The layout has one byte for
    the number of headers and for the length of a name, so at most 255 of either."""
    wanted = dict.fromkeys([*STANDARD, *names])
    if len(wanted) > 255 or any(len(name.encode()) > 255 for name in wanted):
        raise ValueError("embedded headers hold at most 255 headers, with names of at most 255 bytes")
    count, entries = F.lit(0), []
    for name in wanted:
        value = F.try_element_at(headers, F.lit(name))
        json_value = F.encode(_json_string(value), "UTF-8")
        name_bytes = F.encode(F.lit(name), "UTF-8")
        entry = F.concat(_bytes_of(F.length(name_bytes), 1), name_bytes, _bytes_of(F.length(json_value), 4), json_value)
        count = count + F.when(value.isNotNull(), 1).otherwise(0)
        entries.append(F.when(value.isNotNull(), entry).otherwise(F.lit(b"")))
    return F.concat(F.unhex(F.lit("FF")), _bytes_of(count, 1), *entries, body.cast("binary"))


def may_have_embedded(payload: Column) -> Column:
    return (F.length(payload) > 8) & (F.hex(F.substring(payload, 1, 1)) == "FF")


def extract_headers(payload: Column) -> Column:
    """struct(headers, body) of a payload; one without embedded headers keeps its bytes and has
    no headers."""
    count = F.when(may_have_embedded(payload), _number_at(payload, F.lit(2), 1)).otherwise(0)
    start = F.struct(payload.alias("payload"), F.when(may_have_embedded(payload), 3).otherwise(1).alias("at"),
                     F.array().cast(_ENTRY).alias("found"))

    def step(state: Column, _: Column) -> Column:
        raw = state["payload"]
        name_at = state["at"] + 1
        name_len = _number_at(raw, state["at"], 1)
        value_at = name_at + name_len + 4
        value_len = _number_at(raw, name_at + name_len, 4)
        name = F.decode(F.substring(raw, name_at, name_len), "UTF-8")
        text = F.decode(F.substring(raw, value_at, value_len), "UTF-8")
        # A JSON string comes back unquoted, any other JSON value as its text.
        plain = F.when(text.startswith('"'),
                       F.get(F.from_json(F.concat(F.lit("["), text, F.lit("]")), "array<string>"), F.lit(0))
                       ).otherwise(text)
        found = F.concat(state["found"], F.array(F.struct(name.alias("k"), plain.alias("v"))))
        return F.struct(raw.alias("payload"), (value_at + value_len).alias("at"), found.alias("found"))

    def finish(end: Column) -> Column:
        body = F.substring(end["payload"], end["at"], F.length(end["payload"]))
        return F.struct(F.map_from_entries(end["found"]).alias("headers"), body.alias("body"))

    turns = F.filter(F.sequence(F.lit(0), count), lambda i: i > 0)
    return F.aggregate(turns, start, step, finish)
