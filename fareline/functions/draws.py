"""Reproducible pseudo-random columns.

Every draw is a hash of (seed, stream name, row id). Nothing depends on partitioning, so a
recomputed task after an executor loss gives the same rows.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareline.functions.geo import hash32

TWO32 = 4294967296.0


def uniform(row_id: Column, stream: str, seed: int) -> Column:
    """Uniform in [0, 1). The hash of a joined text is never null; saying so keeps joins on a draw from
    hashing every row once more, below the shuffle before them, to look for nulls."""
    hashed = hash32(F.concat_ws("|", F.lit(str(seed)), F.lit(stream), row_id.cast("string"))) / F.lit(TWO32)
    return F.coalesce(hashed, F.lit(0.0))


def gaussian(row_id: Column, stream: str, seed: int, mean: float = 0.0, sigma: float = 1.0) -> Column:
    """Box-Muller on two hashed uniforms; 1 - u keeps the logarithm finite."""
    u1 = F.lit(1.0) - uniform(row_id, stream + ".a", seed)
    u2 = uniform(row_id, stream + ".b", seed)
    z = F.sqrt(F.lit(-2.0) * F.ln(u1)) * F.cos(F.lit(6.283185307179586) * u2)
    return F.lit(mean) + z * sigma


def integer(row_id: Column, stream: str, seed: int, low: int, high: int) -> Column:
    """Integer in [low, high]."""
    return (F.lit(low) + F.floor(uniform(row_id, stream, seed) * (high - low + 1))).cast("int")


def stable_id(*parts: Column) -> Column:
    return F.substring(F.md5(F.concat_ws("-", *parts)), 1, 16)


def half_up(value: Column, digits: int) -> Column:
    """Round half up by arithmetic, identical across engines for decimal-looking doubles."""
    scale = float(10**digits)
    return F.floor(value * scale + 0.5) / scale


def clip(value: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), value))
