"""Ranking metrics: hits, precision/recall/coverage at k, average precision, MAP, tier."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hamper.functions import expressions as X
from hamper.session import materialize

# Fixed values (reference semantics): cut-offs reported, and the MAP cut-off.
DEFAULT_KS = (10, 20, 50, 100)
MAP_K = 100


def truth_pairs(test: DataFrame, baskets: DataFrame | None = None, basket: str = "basket",
                item: str = "item") -> DataFrame:
    """Distinct held-out (basket, item) pairs, restricted to the evaluated baskets."""
    pairs = test.select(basket, item).distinct()
    return pairs if baskets is None else pairs.join(baskets.select(basket), basket, "left_semi")


def hits(recs: DataFrame, truth: DataFrame, basket: str = "basket", item: str = "item",
         rank: str = "rank") -> DataFrame:
    """Recommended items that are in the held-out set, with their rank."""
    return recs.select(basket, item, rank).join(truth.select(basket, item), [basket, item], "inner")


def metrics_at_k(hit_rows: DataFrame, baskets: DataFrame, truth: DataFrame, ks: Sequence[int] = DEFAULT_KS,
                 basket: str = "basket", rank: str = "rank") -> DataFrame:
    """One row per k: hits, precision = hits/(baskets*k) (fixed denominator even when a
    basket got fewer than k items), recall = hits/held-out pairs (micro), coverage =
    baskets with a hit / baskets.

    Two histograms hold all that is needed for any k: how many hits have each rank, and how many
    baskets have their first hit at each rank (one row a rank at most). They are cumulated up to
    every k, so the hits are neither repeated per cut-off nor counted distinct."""
    n_baskets = baskets.select(F.count_distinct(basket)).scalar()
    n_truth = truth.select(F.count(F.lit(1))).scalar()
    at_rank = hit_rows.groupBy(F.col(rank).alias("_rank")).agg(F.count(F.lit(1)).alias("hits"))
    first = (hit_rows.groupBy(basket).agg(F.min(rank).alias("_rank"))
             .groupBy("_rank").agg(F.count(F.lit(1)).alias("_covered")))
    histogram = (at_rank.select("_rank", "hits", F.lit(0).cast("long").alias("_covered"))
                 .unionByName(first.select("_rank", F.lit(0).cast("long").alias("hits"), "_covered")))
    upto = lambda c, k: F.coalesce(F.sum(F.when(F.col("_rank") <= F.lit(int(k)), F.col(c))), F.lit(0))
    out = histogram.agg(F.array(*(F.struct(F.lit(int(k)).alias("k"), upto("hits", k).alias("hits"),
                                           upto("_covered", k).alias("_covered")) for k in ks)).alias("_all")).select(
        F.inline("_all"))
    return out.select(
        F.col("k").cast("int").alias("k"),
        F.col("hits").cast("bigint").alias("hits"),
        X.safe_div(F.col("hits"), n_baskets * F.col("k")).alias("precision"),
        X.safe_div(F.col("hits"), n_truth).alias("recall"),
        X.safe_div(F.col("_covered"), n_baskets).alias("coverage"),
    ).fillna(0.0, subset=["precision", "recall", "coverage"])


def average_precision(hit_rows: DataFrame, baskets: DataFrame, truth: DataFrame | None = None, k: int = MAP_K,
                      basket: str = "basket", rank: str = "rank", denominator: str = "hits",
                      out: str = "average_precision") -> DataFrame:
    """Per basket: sum over hits (in rank order) of ``i / rank_i``, divided by the number of
    hits within k (reference form) or by ``min(relevant, k)`` (``denominator="relevant"``).
    Baskets without a hit get 0. A basket has at most k hits, so the window is bounded."""
    within = hit_rows.where(F.col(rank) <= F.lit(k))
    w = Window.partitionBy(basket).orderBy(F.col(rank))
    per = (within.withColumn("_i", F.row_number().over(w))
           .groupBy(basket).agg(F.sum(F.col("_i") / F.col(rank)).alias("_psum"), F.count(F.lit(1)).alias("_n")))
    if denominator == "hits":
        ap = per.select(basket, (F.col("_psum") / F.col("_n")).alias(out))
    elif denominator == "relevant":
        rel = truth.groupBy(basket).agg(F.count(F.lit(1)).alias("_rel"))
        ap = per.join(rel, basket).select(basket, (F.col("_psum") / F.least(F.col("_rel"), F.lit(k))).alias(out))
    else:
        raise ValueError("denominator must be 'hits' or 'relevant'")
    return baskets.select(basket).distinct().join(ap, basket, "left").fillna(0.0, subset=[out])


def baskets_with_recs(recs: DataFrame, baskets: DataFrame, basket: str = "basket") -> DataFrame:
    """One row: evaluated baskets, and how many of them got any recommendation at all."""
    got = recs.select(basket).distinct().join(baskets.select(basket).distinct(), basket, "left_semi")
    return baskets.agg(F.count_distinct(basket).alias("baskets")).select(
        "baskets", got.select(F.count(F.lit(1))).scalar().alias("baskets_with_recs"))


def mean_ap(ap: DataFrame, ap_col: str = "average_precision", basket: str = "basket") -> DataFrame:
    """MAP over every evaluated basket (zeros included), with the basket counts."""
    return ap.agg(F.avg(ap_col).alias("map"), F.count(basket).alias("baskets"),
                  F.count_if(F.col(ap_col) > 0).alias("baskets_with_hits"))


def quality_tier(map_df: DataFrame, map_col: str = "map", baseline: float = X.BASELINE_MAP) -> DataFrame:
    return map_df.select(F.col(map_col).alias("map"), X.improvement(map_col, baseline).alias("improvement"),
                         X.quality_tier(map_col).alias("tier"))


def evaluation_baskets(test: DataFrame, n: int | None = None, basket: str = "basket") -> DataFrame:
    """The baskets to evaluate: all distinct test baskets, or the ``n`` smallest of them."""
    every = test.select(basket).distinct()
    return every if n is None else every.orderBy(basket).limit(int(n))


def evaluation_report(hit_rows: DataFrame, baskets: DataFrame, truth: DataFrame, ks: Sequence[int] = DEFAULT_KS,
                      k: int = MAP_K, basket: str = "basket", rank: str = "rank") -> DataFrame:
    """One row per cut-off with MAP@k, its improvement over the baseline and the tier.

    The hits (few rows a basket) are stored, so both branches share one ranking run."""
    hit_rows = materialize(hit_rows)
    at_k = metrics_at_k(hit_rows, baskets, truth, ks, basket, rank)
    summary = materialize(quality_tier(mean_ap(average_precision(hit_rows, baskets, k=k, basket=basket, rank=rank),
                                               basket=basket)))
    s = summary.select(F.struct("map", "improvement", "tier")).scalar()  # of one stored row
    return at_k.select("*", s["map"].alias(f"map_at_{k}"), s["improvement"].alias("improvement"),
                       s["tier"].alias("tier"))
