"""Hashes of keys: partition tokens, which place rows on a ring, and fingerprints, which name keys in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The rings of the two token functions, both ends included.
RING64 = (-(1 << 63), (1 << 63) - 1)
RING60 = (0, (1 << 60) - 1)


def token64(*keys: str) -> Column:
    return F.xxhash64(*keys)


def token60(*keys: str | Column) -> Column:
    """The first 60 bits of the md5 of the key's text; other engines compute the same."""
    columns = [k if isinstance(k, Column) else F.col(k) for k in keys]
    text = columns[0].cast("string") if len(columns) == 1 else F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def hashed(*parts: Column) -> Column:
    """A number of 60 bits from the parts' texts, by md5; other engines compute the same."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *(p.cast("string") for p in parts))), 1, 15), 16, 10).cast("long")


def key_digest(*keys: str) -> Column:
    """The first 16 hex digits of the md5 of the key's text (null: no text); other engines compute the same."""
    return F.substring(F.md5(F.concat_ws("|", *(F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys))), 1, 16)


def fingerprint(*keys: str) -> Column:
    return F.lpad(F.lower(F.hex(F.xxhash64(*keys))), 16, "0")
