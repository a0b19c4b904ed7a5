"""Reproducible pseudo-random draws: a digest of the row key and a seed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sorts after every hexadecimal digest.
AFTER_ALL = "g"


def draw(key: str | Sequence[str], seed: int) -> Column:
    """32 hexadecimal digits, uniform over keys, equal in every engine with md5."""
    names = [key] if isinstance(key, str) else list(key)
    parts = [F.coalesce(F.col(name).cast("string"), F.lit("")) for name in names]
    return F.md5(F.concat_ws("|", *parts, F.lit(str(seed))))


def uniform(key: str | Sequence[str], seed: int) -> Column:
    """A double in [0, 1) from the first 12 digits of the draw."""
    head = F.conv(F.substring(draw(key, seed), 1, 12), 16, 10).cast("double")
    return head / F.lit(float(16**12))
