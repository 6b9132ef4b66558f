"""Surrogate keys.

The source system fingerprints rows with 32/64-bit non-cryptographic hashes of the
*concatenated* parts.  Two things are deliberately different here:

* the parts are joined with a separator, so (slot 1, member 23) and (slot 12, member 3) do
  not collide the way a plain concatenation does;
* the hash is the first 60 bits of an MD5 digest, which every SQL engine can reproduce, so
  the key is portable between Spark and the SQL oracle.  It is not bit-compatible with the
  original hashes.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def _as_str(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def surrogate_key(*parts) -> Column:
    """bigint key = first 15 hex digits of md5(part1|part2|...).

    A NULL part is the marker ``\\N`` and a separator or backslash inside a part is escaped,
    so no two different rows of parts are joined to one text."""
    def escaped(p) -> Column:
        text = F.replace(F.replace(_as_str(p), F.lit("\\"), F.lit("\\\\")), F.lit(SEPARATOR), F.lit("\\" + SEPARATOR))
        return F.coalesce(text, F.lit("\\N"))

    joined = F.concat_ws(SEPARATOR, *[escaped(p) for p in parts])
    return F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")


_TEXT, _HEX = bytearray(b"\x00"), bytearray(b"\x01")  # first byte of a packed value


def packed_hex(c) -> Column:
    """A hash or address in half its bytes, to shuffle and group by: '0x' and pairs of lower-case
    hex digits as binary, any other text as its own bytes.  Different texts stay different,
    NULL stays NULL; ``unpacked_hex`` gives the text back."""
    c = F.col(c) if isinstance(c, str) else c
    raw = F.unhex(F.substr(c, F.lit(3)))
    return F.when(F.concat(F.lit("0x"), F.lower(F.hex(raw))) == c, F.concat(F.lit(_HEX), raw)) \
        .otherwise(F.concat(F.lit(_TEXT), c.cast("binary")))


def unpacked_hex(c) -> Column:
    """The text that ``packed_hex`` packed."""
    c = F.col(c) if isinstance(c, str) else c
    rest = F.substr(c, F.lit(2))
    return F.when(F.substr(c, F.lit(1), F.lit(1)) == F.lit(_HEX), F.concat(F.lit("0x"), F.lower(F.hex(rest)))) \
        .otherwise(rest.cast("string"))


def naive_concat_key(*parts) -> Column:
    """The separator-free concatenation the source system hashes (NULL propagates)."""
    return F.concat(*[_as_str(p) for p in parts])
