"""Writers for stage tables, recommendation lists and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_table(df: DataFrame, path: str, mode: str = "overwrite", partition_by: list[str] | None = None) -> None:
    """Parquet, snappy; overwrite replaces the whole stage table."""
    w = df.write.mode(mode).option("compression", "snappy")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def recommendation_lists(recs: DataFrame, baskets: DataFrame | None = None, basket: str = "basket",
                         item: str = "item", rank: str = "rank", basket_out: str = "playlist_id") -> DataFrame:
    """One row per basket: its items ordered by rank and their count.

    A list holds at most k items, so collecting it is bounded. With ``baskets`` every
    listed basket appears, an empty list (count 0) when it got no recommendation.
    """
    lists = (recs.groupBy(basket)
             .agg(F.sort_array(F.collect_list(F.struct(F.col(rank).alias("_k"), F.col(item).cast("string").alias("_v")))).alias("_l"))
             .select(basket, F.transform("_l", lambda s: s["_v"]).alias("recommended_tracks")))
    if baskets is not None:
        lists = baskets.select(basket).distinct().join(lists, basket, "left")
    items = F.coalesce(F.col("recommended_tracks"), F.array().cast(T.ArrayType(T.StringType())))
    return lists.select(F.col(basket).cast("string").alias(basket_out), items.alias("recommended_tracks"),
                        F.size(items).cast("bigint").alias("total_recommendations"))


def write_recommendations(lists: DataFrame, path: str, k: int, model_type: str) -> None:
    """JSON lines, one object per basket, plus a one-row manifest next to them (count of
    baskets, list length, model type, time) — no single document is built on the driver."""
    lists.write.mode("overwrite").json(f"{path}/playlists")
    written = read_back_count(lists.sparkSession, path)  # counted in the files: the lists are computed once
    manifest = written.select(F.col("playlists").alias("total_playlists")).select(
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
        "total_playlists", F.lit(int(k)).alias("recommendations_per_playlist"),
        F.lit(model_type).alias("model_type"))
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/submission_info")


def read_back_count(spark: SparkSession, path: str) -> DataFrame:
    """Re-open written lists and count them."""
    return spark.read.schema("playlist_id string").json(f"{path}/playlists").agg(F.count(F.lit(1)).alias("playlists"))
