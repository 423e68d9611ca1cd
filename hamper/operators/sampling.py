"""Deterministic sampling: by key hash, stratified by basket size band, and by file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.functions import expressions as X
from hamper.operators.features import DEFAULT_BANDS, basket_sizes, size_bands

# Fixed values (reference semantics): keep-fraction per size band, and the seed.
DEFAULT_FRACTIONS = {"small": 0.4, "medium": 0.6, "large": 0.3}
SEED = 42


def hash_sample(df: DataFrame, keys: Sequence[str], fraction: float, seed: int = SEED) -> DataFrame:
    """Keep rows whose key hash falls under ``fraction``; the same rows for any partitioning."""
    return df.where(X.hash_keep(fraction, seed, *keys))


def stratified_baskets(df: DataFrame, basket: str = "basket", item: str = "item",
                       bands: Sequence[tuple] = DEFAULT_BANDS,
                       fractions: Mapping[str, float] = DEFAULT_FRACTIONS, seed: int = SEED,
                       size_col: str = "basket_size", band_col: str = "band") -> DataFrame:
    """Baskets kept by a per-band Bernoulli draw on the basket key; baskets outside every
    band are never kept. One pass with a band column replaces the union of band samples."""
    sized = size_bands(basket_sizes(df, basket, item, size_col), size_col, bands, band_col)
    frac = None
    for name, f in fractions.items():
        frac = F.when(F.col(band_col) == name, F.lit(float(f))) if frac is None else \
            frac.when(F.col(band_col) == name, F.lit(float(f)))
    return sized.where(X.hash_keep(frac.otherwise(F.lit(0.0)), seed, basket))


def sample_interactions(df: DataFrame, sampled: DataFrame, basket: str = "basket") -> DataFrame:
    """Rows of the sampled baskets (semi join: no columns added, no duplicates)."""
    return df.join(sampled.select(basket), basket, "left_semi")


def file_sample(df: DataFrame, fraction: float, seed: int = SEED, file_col: str = "_file") -> DataFrame:
    """Keep whole input files by a hash of the file *name* (cluster sample)."""
    return df.where(X.hash_keep(fraction, seed, F.col(file_col)))
