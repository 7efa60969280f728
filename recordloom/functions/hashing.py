"""Seeded, engine-independent draws: a hash of the key replaces any random generator."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HASH_RANGE = 1 << 32


def key_text(*parts) -> Column:
    cols = [p if isinstance(p, Column) else F.lit(str(p)) for p in parts]
    return F.concat_ws(":", *[c.cast("string") for c in cols])


def digest(*parts) -> Column:
    """Hex MD5 of the colon-joined key parts."""
    return F.md5(key_text(*parts).cast("binary"))


def draw(*parts) -> Column:
    """Integer in [0, 2**32) from the first eight hex digits of the digest."""
    return F.conv(F.substring(digest(*parts), 1, 8), 16, 10).cast("long")
