"""The four batch stages as Spark jobs over stage tables.

``preprocess``: nested basket documents -> dense ids -> ordered split -> stage tables.
``train``: ratings, stratified basket sample, ALS, popularity, item pairs, run metadata.
``evaluate``: ALS candidates blended with popularity, seen items removed, ranked and
scored (precision/recall/coverage at k, MAP@100, tier) into one report table.
``submit``: request baskets -> first k popular items each has not seen -> JSON lists.

Each stage returns a small DataFrame describing what it wrote; all heavy work stays in
Spark and moves between stages as Parquet.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hamper.operators import als as A
from hamper.operators import features as FE
from hamper.operators import metrics as M
from hamper.operators import ranking as R
from hamper.operators.cooccurrence import cooccurrence, excluded_baskets
from hamper.operators.interactions import build_indexes, drop_null_keys, encode, to_interactions
from hamper.operators.sampling import sample_interactions, stratified_baskets
from hamper.operators.split import split_ordered
from hamper.operators.stats import dataset_stats
from hamper.session import materialize
from hamper.sinks.snapshots import load_model, save_model, write_snapshot
from hamper.sinks.writers import read_back_count, recommendation_lists, write_recommendations, write_table
from hamper.sources.baskets import read_baskets, read_request_baskets, read_table, read_with_fallback

STAGE_COLUMNS = ["basket_idx", "item_idx", "item", "position"]


def preprocess(spark: SparkSession, raw: str, out: str, pattern: str | None = "*.json",
               sample: float | None = None, sample_level: str = "file", multiline: bool = True) -> DataFrame:
    """Write ``train``, ``test``, ``basket_index``, ``item_index`` under ``out``; return stats.

    The documents are parsed once: the flattened interactions are written as a Parquet
    stage table and every later step (index building, sizing, split) reads its columns
    from there instead of re-parsing JSON."""
    parsed = to_interactions(read_baskets(spark, raw, pattern, sample, sample_level, multiline=multiline))
    write_table(parsed, f"{out}/interactions")
    inter = drop_null_keys(spark.read.parquet(f"{out}/interactions"), ["basket", "item"])
    bidx, iidx = build_indexes(inter)
    # split by the basket key (one-to-one with its id): the window reuses the partitioning
    # left by the basket join instead of shuffling all interactions once more
    split = split_ordered(encode(inter, bidx, iidx), basket="basket", position="position",
                          tiebreak=("item_idx",))
    split = materialize(split)
    write_table(split.where("is_train").select(*STAGE_COLUMNS), f"{out}/train")
    write_table(split.where("not is_train").select(*STAGE_COLUMNS), f"{out}/test")
    write_table(bidx, f"{out}/basket_index")
    write_table(iidx, f"{out}/item_index")
    stats = dataset_stats(split, "basket_idx", "item_idx", flag_col="is_train")
    write_table(stats, f"{out}/dataset_stats")
    return spark.read.parquet(f"{out}/dataset_stats")


def train(spark: SparkSession, stage: str, out: str, sample: Mapping[str, float] | None = None,
          pair_fraction: float | None = None, max_size: int | None = None, rank: int = A.ALS_RANK, max_iter: int = A.ALS_ITERS,
          reg: float = A.ALS_REG, alpha: float = A.ALS_ALPHA, seed: int = A.ALS_SEED) -> DataFrame:
    """Write the ALS model, item popularity, item pairs and the run metadata row.

    All rows train by default. ``sample`` (keep-fraction by size band), ``pair_fraction`` (row
    sample before pairing) and ``max_size`` (largest basket that is paired) are the caller's
    choice; the source run used DEFAULT_FRACTIONS, 0.3 and 200. Baskets that the pair window
    leaves out are counted in ``excluded_baskets``."""
    rated = FE.implicit_rating(spark.read.parquet(f"{stage}/train"))
    sampled = rated if sample is None else sample_interactions(
        rated, stratified_baskets(rated, basket="basket_idx", item="item_idx", fractions=sample), basket="basket_idx")
    sampled = materialize(sampled)
    model = A.fit_als(sampled, rank=rank, max_iter=max_iter, reg=reg, alpha=alpha, seed=seed)
    save_model(model, f"{out}/als_model", spark)
    write_snapshot(FE.popularity(sampled, basket="basket_idx", item="item_idx", extra_keys=["item"]),
                   f"{out}/item_popularity")
    write_snapshot(cooccurrence(sampled, basket="basket_idx", item="item_idx", fraction=pair_fraction, max_size=max_size,
                                sample_keys=("basket_idx", "position")), f"{out}/item_pairs")
    write_snapshot(excluded_baskets(sampled, "basket_idx", "item_idx", max_size=max_size), f"{out}/excluded_baskets")
    pairs = read_table(spark, f"{out}/item_pairs")
    counts = sampled.agg(F.count_distinct("basket_idx").alias("sample_baskets"),
                         F.count(F.lit(1)).alias("sample_interactions"),
                         F.count_distinct("item_idx").alias("total_items")) \
        .select("*", pairs.select(F.count(F.lit(1))).scalar().alias("similarities_count"))
    write_table(A.run_metadata(counts, rank=rank, reg=reg, alpha=alpha), f"{out}/training_metadata", mode="append")
    return spark.read.parquet(f"{out}/training_metadata")


def evaluate(spark: SparkSession, stage: str, model_dir: str, ks: Sequence[int] = M.DEFAULT_KS,
             k: int = R.TOP_K, out: str | None = None, n_baskets: int | None = None) -> DataFrame:
    """Report per cut-off k (hits, precision, recall, coverage) with MAP@k and its tier.

    All test baskets are evaluated (``n_baskets``: the first so many by id); candidates come from the factors (top-k, seen items
    included, so many more that k remain), are blended with popularity, lose the items seen
    in train, and are re-ranked. ``recommendation_coverage`` counts the baskets with a list."""
    from pyspark.ml.recommendation import ALSModel

    model = load_model(ALSModel, f"{model_dir}/als_model", spark)
    pop = read_table(spark, f"{model_dir}/item_popularity").select("item_idx", "popularity_score")
    test = spark.read.parquet(f"{stage}/test")
    seen = spark.read.parquet(f"{stage}/train").select("basket_idx", "item_idx")
    baskets = M.evaluation_baskets(test, n_baskets, "basket_idx")
    test = test if n_baskets is None else test.join(baskets, "basket_idx", "left_semi")
    cands = A.over_fetch(model, baskets, seen, k=k)
    ranked = R.rank_unseen(R.blend(cands, pop, item="item_idx"), seen, basket="basket_idx", item="item_idx", k=k)
    ranked = materialize(ranked)
    truth = M.truth_pairs(test, basket="basket_idx", item="item_idx")
    hit_rows = M.hits(ranked, truth, basket="basket_idx", item="item_idx")
    report = M.evaluation_report(hit_rows, baskets, truth, ks=ks, k=k, basket="basket_idx")
    if out:
        write_snapshot(ranked, f"{out}/recommendations_final")
        write_snapshot(report, f"{out}/evaluation_report")
        write_snapshot(M.baskets_with_recs(ranked, baskets, "basket_idx"), f"{out}/recommendation_coverage")
        return read_table(spark, f"{out}/evaluation_report")
    return report


def submit(spark: SparkSession, requests: str, stage: str, out: str, k: int = R.TOP_K,
           model_dir: str | None = None, multiline: bool = True, n_candidates: int | None = None) -> DataFrame:
    """First ``k`` items per request basket that it does not already hold, most popular
    first. Popularity comes from a written ranked recommendation table when one exists
    (mean final score per item), else from the train table (frequency + 0.5 * baskets).
    By default every ranked item is a candidate (exact); ``n_candidates=10000`` limits
    candidates to the top of the list as the reference does, so a basket holding most of
    them gets fewer than ``k``. Writes JSON lists and a manifest; returns the manifest."""
    reqs = materialize(read_request_baskets(spark, requests, multiline=multiline))  # parsed once
    seen = reqs.select("request_key", F.explode("tracks").alias("_t")).select("request_key", F.col("_t.track_uri")
                                                                              .alias("item"))
    primary = f"{model_dir}/recommendations_final" if model_dir else None
    scores, source = read_with_fallback(spark, primary, f"{stage}/train")
    if source == "primary":
        index = spark.read.parquet(f"{stage}/item_index")
        scored = FE.recommendation_scores(scores.join(index, "item_idx"), basket="basket_idx", item="item")
        model_type = "hybrid_als_popularity"
    else:
        scored = FE.simple_popularity(scores, basket="basket_idx", item="item")
        model_type = "popularity"
    ranked = R.top_candidates(scored, item="item", n=n_candidates)
    recs = R.recommend_popular(reqs.select("request_key"), seen, ranked, basket="request_key", item="item", k=k)
    # one list per request, named by its test_id; the key tells requests of one name apart
    lists = (recommendation_lists(recs, reqs.select("request_key"), basket="request_key", basket_out="request_key")
             .join(reqs.select("request_key", F.col("test_id").alias("playlist_id")), "request_key")
             .select("playlist_id", "recommended_tracks", "total_recommendations", "request_key"))
    write_recommendations(lists, out, k=k, model_type=model_type)
    info = spark.read.json(f"{out}/submission_info")
    return info.withColumn("read_back", read_back_count(spark, out).select("playlists").scalar())
