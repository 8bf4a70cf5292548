"""The hash the message producers' default partitioning is defined by.

Spark's own `hash` is another function; rows must land in the same partitions as those already
written by JVM producers, so the JVM's documented hash codes are computed with built-ins."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_LOW_32 = 0xFFFFFFFF


def _signed(unsigned: Column) -> Column:
    return F.when(unsigned >= 1 << 31, unsigned - (1 << 32)).otherwise(unsigned)


def _low32(c: Column) -> Column:
    return c.bitwiseAND(F.lit(_LOW_32).cast("bigint"))


def long_hash(c: Column) -> Column:
    """Hash code of a 64-bit integer: upper half xor lower half."""
    c = c.cast("bigint")
    return _signed(_low32(c.bitwiseXOR(F.shiftrightunsigned(c, 32))))


def int_hash(c: Column) -> Column:
    """Hash code of a 32-bit integer: itself."""
    return c.cast("int").cast("bigint")


def string_hash(c: Column) -> Column:
    """Hash code of a string: h = 31 * h + unit over its UTF-16 units, in 32 bits."""

    def add(h: Column, char: Column) -> Column:
        code = F.ascii(char).cast("bigint")  # the code point of the first character
        above = code - 0x10000
        high = F.shiftright(above, 10) + 0xD800
        low = above.bitwiseAND(F.lit(0x3FF).cast("bigint")) + 0xDC00
        pair = _low32(_low32(h * 31 + high) * 31 + low)
        return F.when(code < 0x10000, _low32(h * 31 + code)).otherwise(pair)

    zero = F.lit(0).cast("bigint")
    return _signed(F.when(c == "", zero).otherwise(F.aggregate(F.split(c, ""), zero, add)))


HASHES = {"string": string_hash, "int": int_hash, "bigint": long_hash}


def default_selector(key: Column, dtype: str = "string") -> Column:
    """The default selector: absolute hash code, with the one value that has none mapped to 0."""
    h = HASHES[dtype](key)
    return F.when(h == -(1 << 31), F.lit(0).cast("bigint")).otherwise(F.abs(h))
