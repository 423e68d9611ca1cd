"""hamper: Spark-native recommendations from ordered baskets.

Operators take and return DataFrames; see README.md for which of them store rows on the way.
The names below load on first use, so that a Python worker that needs one module does not
import them all.
"""

import importlib

_WHERE = {
    "hamper.operators.als": ["FactorSearch", "als_candidates", "als_loss", "fit_als", "over_fetch", "run_metadata"],
    "hamper.operators.cooccurrence": ["cooccurrence", "excluded_baskets", "possible_partners"],
    "hamper.operators.features": ["basket_sizes", "implicit_rating", "popularity", "recommendation_scores",
                                  "simple_popularity", "size_bands"],
    "hamper.operators.interactions": ["build_indexes", "drop_null_keys", "encode", "null_key_counts", "to_interactions"],
    "hamper.operators.metrics": ["average_precision", "baskets_with_recs", "evaluation_baskets", "evaluation_report", "hits",
                                 "mean_ap", "metrics_at_k", "quality_tier", "truth_pairs"],
    "hamper.operators.ordering": ["dense_index", "ordered_rank"],
    "hamper.operators.ranking": ["at_ranks", "blend", "rank_slots", "rank_unseen", "recommend_popular", "top_candidates"],
    "hamper.operators.sampling": ["file_sample", "hash_sample", "sample_interactions", "stratified_baskets"],
    "hamper.operators.split": ["split_numbered", "split_ordered", "test_part", "train_part"],
    "hamper.operators.stats": ["dataset_stats", "distinct_sketches", "estimated_distinct"],
    "hamper.session": ["drop_folders", "drop_scratch", "ensure_checkpoint_dir", "local_session", "materialize", "materialize_bucketed",
                       "recorded_scratch"],
    "hamper.sinks.snapshots": ["load_model", "save_model", "write_snapshot"],
    "hamper.sinks.writers": ["read_back_count", "recommendation_lists", "write_recommendations", "write_table"],
    "hamper.sources.baskets": ["numbered_lines", "read_baskets", "read_request_baskets", "read_table", "read_with_fallback"],
    "hamper.sources.inventory": ["file_inventory", "inventory_totals"],
    "hamper.streaming.ingest": ["ingest_increment", "read_ingested", "read_manifest"],
}
_HOME = {name: module for module, names in _WHERE.items() for name in names}
__all__ = sorted(_HOME)


def __getattr__(name: str):
    if name not in _HOME:
        raise AttributeError(f"module 'hamper' has no attribute {name!r}")
    return getattr(importlib.import_module(_HOME[name]), name)
