"""Ratings, basket sizes and size bands, item popularity."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.functions import expressions as X
from hamper.session import materialize

# Fixed values (reference semantics): size bands used for stratified sampling, the popularity
# weights for frequency, distinct baskets, mean rating, early share, and the output column
# names of popularity() (frequency, unique_baskets, avg_rating, early_position_count,
# avg_position, stddev_position, popularity_score).
DEFAULT_BANDS = (("small", 5, 20), ("medium", 21, 100), ("large", 101, None))
POPULARITY_WEIGHTS = (0.25, 0.35, 0.25, 0.15)
EARLY_POSITION = 5
UNIQUE_WEIGHT = 0.5


def implicit_rating(df: DataFrame, position: str = "position", out: str = "implicit_rating",
                    top: float = X.RATING_TOP, floor: float = X.RATING_FLOOR) -> DataFrame:
    return df.withColumn(out, X.implicit_rating(position, top, floor))


def basket_sizes(df: DataFrame, basket: str = "basket", item: str = "item", out: str = "basket_size") -> DataFrame:
    """Rows per basket counting non-null items (duplicates count). Partial aggregation
    before the shuffle keeps a hot basket to one row per map task."""
    return df.groupBy(basket).agg(F.count(item).alias(out))


def band_of(size: str, bands: Sequence[tuple] = DEFAULT_BANDS):
    """Band name for a size; ``between`` is inclusive, sizes in no band give null."""
    expr = None
    for name, lo, hi in bands:
        cond = F.col(size) >= F.lit(lo) if hi is None else F.col(size).between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def size_bands(sizes: DataFrame, size: str = "basket_size", bands: Sequence[tuple] = DEFAULT_BANDS,
               out: str = "band", keep_unbanded: bool = False) -> DataFrame:
    df = sizes.withColumn(out, band_of(size, bands))
    return df if keep_unbanded else df.where(F.col(out).isNotNull())


def popularity(df: DataFrame, basket: str = "basket", item: str = "item", position: str = "position",
               rating: str = "implicit_rating", early: int = EARLY_POSITION,
               weights: Sequence[float] = POPULARITY_WEIGHTS, extra_keys: Sequence[str] = ()) -> DataFrame:
    """Per-item features and the weighted popularity score.

    score = w0*freq/max(freq) + w1*uniq/max(uniq) + w2*avg_rating/5 + w3*early/freq,
    then every numeric null (e.g. the sample stddev of a one-row item) becomes 0.
    The item-sized features are stored; both maxima come from the stored rows.
    """
    feats = df.groupBy(item, *extra_keys).agg(
        F.count(basket).alias("frequency"),
        F.count_distinct(basket).alias("unique_baskets"),
        F.avg(rating).alias("avg_rating"),
        F.sum(F.when(F.col(position) < F.lit(early), 1).otherwise(0)).cast("bigint").alias("early_position_count"),
        F.avg(position).alias("avg_position"),
        F.stddev(position).alias("stddev_position"),
    )
    feats = materialize(feats)
    max_freq = feats.select(F.max("frequency")).scalar()
    max_uniq = feats.select(F.max("unique_baskets")).scalar()
    w0, w1, w2, w3 = weights
    score = (X.safe_div("frequency", max_freq) * F.lit(w0)
             + X.safe_div("unique_baskets", max_uniq) * F.lit(w1)
             + F.col("avg_rating") / F.lit(X.RATING_TOP) * F.lit(w2)
             + X.safe_div("early_position_count", "frequency") * F.lit(w3))
    return feats.withColumn("popularity_score", score).fillna(0.0)


def simple_popularity(df: DataFrame, basket: str = "basket", item: str = "item",
                      unique_weight: float = UNIQUE_WEIGHT) -> DataFrame:
    """Fallback score ``frequency + 0.5 * distinct baskets`` per item."""
    return (df.groupBy(item)
            .agg(F.count(basket).alias("frequency"), F.count_distinct(basket).alias("unique_baskets"))
            .withColumn("popularity_score", F.col("frequency") + F.col("unique_baskets") * F.lit(unique_weight)))


def recommendation_scores(recs: DataFrame, basket: str = "basket", item: str = "item",
                          score: str = "final_score") -> DataFrame:
    """Item score from a ranked recommendation table: mean score and how often listed."""
    return recs.groupBy(item).agg(F.avg(score).alias("popularity_score"), F.count(basket).alias("frequency"))
