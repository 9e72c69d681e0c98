"""Order keys and splits by hash: the same on every run and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def order_key(seed: str | int, *parts: Column | str) -> Column:
    """sha256 of seed:part:part..., nulls as empty text."""
    cols = [F.coalesce((F.col(p) if isinstance(p, str) else p).cast("string"), F.lit("")) for p in parts]
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), *cols), 256)


def bucket(key: Column, buckets: int) -> Column:
    """A 256-bit hash modulo a number of buckets, exactly: folded digit by digit."""
    digits = F.transform(F.split(F.sha2(key.cast("string"), 256), ""), lambda d: F.conv(d, 16, 10).cast("long"))
    return F.aggregate(F.filter(digits, lambda d: d.isNotNull()), F.lit(0).cast("long"), lambda a, d: (a * 16 + d) % buckets)


def stable_int(text: Column) -> Column:
    """A 32-bit integer from the first digits of sha1."""
    return F.conv(F.substring(F.sha1(text), 1, 8), 16, 10).cast("long")
