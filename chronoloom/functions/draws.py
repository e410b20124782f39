"""Reproducible random draws: a hash of the row's own identity.

The draw of a row depends only on the seed and the named columns, never on
partitioning, task order or retries.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F


def hash32(seed: int, *parts: Column) -> Column:
    """Integer in [0, 2**32)."""
    text = F.concat_ws("|", F.lit(str(seed)), *[p.cast("string") for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("long")


def index_draw(seed: int, n: Column, *parts: Column) -> Column:
    """Integer in [0, n)."""
    return F.pmod(hash32(seed, *parts), n.cast("long"))


def uniform(seed: int, *parts: Column) -> Column:
    """Double strictly inside (0, 1)."""
    return (hash32(seed, *parts) + 0.5) / 4294967296.0


def normal(seed: int, *parts: Column) -> Column:
    """Standard normal by the Box-Muller pair of two uniforms."""
    u = uniform(seed, F.lit("u"), *parts)
    v = uniform(seed, F.lit("v"), *parts)
    return F.sqrt(-2.0 * F.log(u)) * F.cos(2.0 * math.pi * v)
