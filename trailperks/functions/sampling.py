"""Reproducible random numbers: a function of a key and a seed, the same on every retry."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def uniform(key: Column, seed: str) -> Column:
    """A number in (0, 1) from the hash of seed and key."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    number = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return (number + 0.5) / float(2**32)
