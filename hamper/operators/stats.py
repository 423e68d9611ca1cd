"""Dataset statistics in one aggregation pass."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dataset_stats(df: DataFrame, basket: str = "basket", item: str = "item",
                  flag_col: str | None = None) -> DataFrame:
    """One row: distinct baskets, distinct items, interactions, and with a split flag the
    train and test row counts — one job instead of one count per figure."""
    per = [F.count(F.lit(1)).alias("interactions")]
    if flag_col is not None:
        per += [F.count_if(F.col(flag_col)).alias("train_rows"), F.count_if(~F.col(flag_col)).alias("test_rows")]
    figures = ["interactions", "train_rows", "test_rows"][: 3 if flag_col else 1]
    # one row per basket before the total: no row is expanded for a distinct count
    by_basket = df.groupBy(basket).agg(*per)
    n_items = df.select(item).where(F.col(item).isNotNull()).distinct().select(F.count(F.lit(1))).scalar()
    return by_basket.agg(F.count(basket).alias("baskets"), *(F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in figures)).select(
        "baskets", n_items.alias("items"), *figures)


#: log2 of a sketch's cells; the standard error of an estimate is about 1.04 / sqrt(2^12) = 1.6 %.
SKETCH_BITS = 12
SKETCH_ERROR = 1.04 / 2 ** (SKETCH_BITS / 2)


def distinct_sketches(df: DataFrame, part: Column, columns: Sequence[str]) -> DataFrame:
    """One row per ``part`` of a stage table: part, rows, and a HyperLogLog sketch of the distinct values
    of each of ``columns``. Sketches of parts that arrive later are added by union, without the
    rows of the earlier ones; a part that is written again replaces its own row."""
    return df.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("rows"),
                                              *(F.hll_sketch_agg(c, SKETCH_BITS).alias(c) for c in columns))


def estimated_distinct(sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row over all parts: rows, and the estimated number of distinct values of each column."""
    return sketches.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
                        *(F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(c)), F.lit(0)).alias(c) for c in columns))
