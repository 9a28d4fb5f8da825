"""Keyed pseudo-randomness: the same row gets the same number on every run, cluster and engine."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def keyed_uniform(salt: str, key: Column) -> Column:
    """A number in [0, 1) from the first 32 bits of md5(salt:key)."""
    digest = F.md5(F.concat(F.lit(f"{salt}:"), key.cast("string")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") / F.lit(4294967296.0)


def keyed_index(salt: str, key: Column, n: int) -> Column:
    """A number from 0 to n - 1."""
    return F.floor(keyed_uniform(salt, key) * n).cast("int")
