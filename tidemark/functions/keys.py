"""Surrogate keys: one positive bigint per natural key."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "\x1f"
MODES = ("xxhash64", "md5_60", "murmur3")


def surrogate_key(*parts: Column | str, mode: str = "xxhash64") -> Column:
    """Hash a natural key; NULL when any part is NULL.

    ``xxhash64`` keeps 63 bits and is the default. ``md5_60`` can be recomputed by any SQL engine. ``murmur3`` is the
    32-bit hash with its sign removed: fine for joins on small tables, but it collides from some 100,000 keys on.
    """
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    texts = [c.cast("string") for c in columns]
    if mode == "xxhash64":
        key = F.xxhash64(*texts).bitwiseAND(F.lit(0x7FFFFFFFFFFFFFFF))
    elif mode == "md5_60":
        joined = texts[0] if len(texts) == 1 else F.concat_ws(SEPARATOR, *texts)
        key = F.conv(F.substring(F.md5(joined), 1, 15), 16, 10).cast("bigint")
    elif mode == "murmur3":
        key = F.abs(F.hash(*texts).cast("bigint"))
    else:
        raise ValueError(f"unknown key mode {mode!r}, expected one of {MODES}")
    return F.when(reduce(lambda a, b: a & b, [c.isNotNull() for c in columns]), key)
