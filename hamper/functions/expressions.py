"""Column expressions shared by the operators (all JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that results depend on (reference semantics).
RATING_TOP = 5.0          # rating at position 0
RATING_FLOOR = 1.0        # lowest rating; reached from position 54 on
BASELINE_MAP = 0.005      # "typical baseline" MAP
# quality tiers, checked top-down with a strict ">"
TIERS = ((0.020, "EXCELLENT"), (0.015, "VERY GOOD"), (0.010, "GOOD"), (0.005, "ACCEPTABLE"))
TIER_ELSE = "NEEDS IMPROVEMENT"

_HASH_SPACE = float(2 ** 32)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def implicit_rating(position: str | Column, top: float = RATING_TOP, floor: float = RATING_FLOOR) -> Column:
    """``greatest(floor, top - ln(position + 1))``; a null or negative position gives ``floor``
    because ``ln`` of a non-positive number is null and ``greatest`` skips nulls."""
    return F.greatest(F.lit(float(floor)), F.lit(float(top)) - F.ln(col(position) + F.lit(1)))


def hash_unit(seed: int, *keys: str | Column) -> Column:
    """Deterministic 32-bit hash of ``seed:key1:key2...`` (first 8 hex digits of md5).

    Unlike ``DataFrame.sample`` it does not depend on partitioning, and the same value
    is computable in plain SQL engines, so sampled results can be checked exactly.
    """
    text = F.concat_ws(":", F.lit(str(seed)), *[col(k).cast("string") for k in keys])
    return F.conv(F.substring(F.md5(text), 1, 8), 16, 10).cast("bigint")


def hash_keep(fraction: float | Column, seed: int, *keys: str | Column) -> Column:
    """True for a deterministic ``fraction`` of key values."""
    frac = fraction if isinstance(fraction, Column) else F.lit(float(fraction))
    return hash_unit(seed, *keys) < frac * F.lit(_HASH_SPACE)


def safe_div(num: str | Column, den: str | Column) -> Column:
    """Division that yields null instead of failing (ANSI mode) on a zero denominator."""
    return F.try_divide(col(num).cast("double"), col(den).cast("double"))


def quality_tier(map_value: str | Column) -> Column:
    m = col(map_value)
    expr = None
    for threshold, name in TIERS:
        expr = F.when(m > F.lit(threshold), F.lit(name)) if expr is None else expr.when(m > F.lit(threshold), F.lit(name))
    return expr.otherwise(F.lit(TIER_ELSE))


def improvement(map_value: str | Column, baseline: float = BASELINE_MAP) -> Column:
    """Percent improvement over the baseline; null unless the value beats it."""
    m = col(map_value)
    return F.when(m > F.lit(baseline), (m - F.lit(baseline)) / F.lit(baseline) * F.lit(100.0))
