"""Hand-made edge fixtures (FIXTURES §4)."""

import json
import math
import os

import pytest
from pyspark.sql import functions as F

from hamper.operators import features as FE
from hamper.operators import metrics as M
from hamper.operators import ranking as R
from hamper.operators.cooccurrence import cooccurrence
from hamper.operators.interactions import build_indexes, encode, null_key_counts, to_interactions
from hamper.operators.split import split_ordered
from hamper.sinks.writers import recommendation_lists
from hamper.sources.baskets import read_baskets, read_request_baskets, read_with_fallback
from hamper.streaming.ingest import ingest_increment


def test_implicit_rating_values(spark):
    df = spark.createDataFrame([(0,), (53,), (54,), (-1,), (None,)], "position int")
    got = [r.implicit_rating for r in FE.implicit_rating(df).collect()]
    assert got[0] == 5.0
    assert math.isclose(got[1], 1.0110159534, abs_tol=1e-9)
    assert got[2:] == [1.0, 1.0, 1.0]


def test_split_sizes_one_to_ten(spark):
    rows = [(n, i, i) for n in range(1, 11) for i in range(n)]
    df = spark.createDataFrame(rows, "basket int, item int, position int")
    s = split_ordered(df)
    train = {r.basket: r.c for r in s.where("is_train").groupBy("basket").agg(F.count("*").alias("c")).collect()}
    assert [train.get(n, 0) for n in range(1, 11)] == [0, 1, 2, 3, 4, 4, 5, 6, 7, 8]
    # train rows are the earliest positions of each basket
    assert s.where("is_train and split_rank != position + 1").count() == 0


def _write(path, name, text):
    with open(os.path.join(path, name), "w") as f:
        f.write(text)


def test_nested_json_edges(spark, tmp_dir):
    doc = {"playlists": [
        {"pid": 1, "name": "a", "tracks": [{"track_uri": "t1", "pos": 0}, None, {"track_uri": "t2", "pos": 2}],
         "extra_key": 5},
        {"pid": 2, "tracks": []},
        {"pid": 3, "tracks": None},
        {"pid": 4},
    ], "info": {"ignored": True}}
    _write(tmp_dir, "baskets.part.0-1.json", json.dumps(doc, indent=2))
    _write(tmp_dir, "baskets.part.2-3.json", "{ this is not json")
    baskets = read_baskets(spark, tmp_dir, pattern="baskets.part.*.json")
    assert sorted(r.pid for r in baskets.collect()) == [1, 2, 3, 4]
    rows = to_interactions(baskets).collect()
    assert len(rows) == 3  # empty/null track lists dropped, the null element kept
    assert sorted((r.item, r.position) for r in rows if r.item) == [("t1", 0), ("t2", 2)]
    assert [r for r in rows if r.item is None][0].position is None


def test_null_keys_dropped_and_counted(spark):
    df = spark.createDataFrame([(1, 10, 0), (None, 11, 1), (2, None, 0), (2, 12, 1)],
                               "basket long, item long, position int")
    counts = null_key_counts(df, ["basket", "item"]).first()
    assert (counts.null_basket, counts.null_item, counts.rows) == (1, 1, 4)
    bidx, iidx = build_indexes(df)
    enc = encode(df, bidx, iidx)
    assert enc.count() == 2
    assert enc.where("basket_idx is null or item_idx is null").count() == 0


def test_one_row_item_stddev_is_zero(spark):
    df = spark.createDataFrame([(1, 7, 0), (1, 8, 1), (2, 8, 3)], "basket long, item long, position int")
    pop = {r.item: r for r in FE.popularity(FE.implicit_rating(df)).collect()}
    assert pop[7].stddev_position == 0.0
    assert pop[8].stddev_position > 0


@pytest.mark.parametrize("ranks,expected", [([1, 3], (1 / 1 + 2 / 3) / 2), ([], 0.0), ([101], 0.0)])
def test_average_precision_cases(spark, ranks, expected):
    hits = spark.createDataFrame([(1, 100 + i, r) for i, r in enumerate(ranks)], "basket long, item long, rank long")
    baskets = spark.createDataFrame([(1,)], "basket long")
    ap = M.average_precision(hits, baskets).first().average_precision
    assert math.isclose(ap, expected, abs_tol=1e-12)


def test_candidates_exhausted(spark):
    ranked = spark.createDataFrame([(i, float(100 - i)) for i in range(1, 51)], "item long, popularity_score double")
    ranked = R.top_candidates(ranked, n=None)
    seen = spark.createDataFrame([(1, i) for i in range(1, 21)] + [(2, 999)], "basket long, item long")
    baskets = spark.createDataFrame([(1,), (2,), (3,)], "basket long")
    recs = R.recommend_popular(baskets, seen, ranked, k=100)
    per = {r.basket: sorted(x.rank for x in recs.where(f"basket = {r.basket}").collect())
           for r in baskets.collect()}
    assert per[1] == list(range(1, 31))  # 50 items, 20 seen
    assert per[2] == list(range(1, 51)) and per[3] == list(range(1, 51))
    assert recs.join(seen, ["basket", "item"]).count() == 0
    first = {r.rank: r.item for r in recs.where("basket = 1").collect()}
    assert first[1] == 21  # the first unseen item in popularity order


def test_empty_recommendation_list_export(spark):
    recs = spark.createDataFrame([(1, 5, 1), (1, 6, 2)], "basket long, item long, rank long")
    baskets = spark.createDataFrame([(1,), (2,)], "basket long")
    out = {r.playlist_id: r for r in recommendation_lists(recs, baskets).collect()}
    assert out["1"].recommended_tracks == ["5", "6"] and out["1"].total_recommendations == 2
    assert out["2"].recommended_tracks == [] and out["2"].total_recommendations == 0


def test_duplicates_counted_per_copy(spark):
    rows = [(1, "A", 0), (1, "A", 1), (1, "B", 2), (1, "C", 3), (1, "D", 4)]
    df = spark.createDataFrame(rows, "basket long, item string, position int")
    got = {(r.item1, r.item2): r.cooccur_count for r in cooccurrence(df, min_count=1).collect()}
    assert got[("A", "B")] == 2 and got[("B", "C")] == 1
    assert ("A", "A") not in got
    deduped = {(r.item1, r.item2): r.cooccur_count for r in cooccurrence(df, min_count=1, dedupe=True).collect()}
    assert deduped[("A", "B")] == 1


def test_both_request_roots(spark, tmp_dir):
    reqs = [{"test_id": "x1", "collaborative": "false", "tracks": [{"track_uri": "u1"}, {"track_uri": "u2"}]},
            {"collaborative": "true", "tracks": [{"track_uri": "u3"}]},
            {"test_id": "x3", "tracks": None}]
    a, b = os.path.join(tmp_dir, "a"), os.path.join(tmp_dir, "b")
    os.makedirs(a)
    os.makedirs(b)
    _write(a, "req.json", json.dumps(reqs, indent=1))
    _write(b, "req.json", json.dumps({"playlists": reqs}, indent=1))
    ra = read_request_baskets(spark, a).drop("_file")
    rb = read_request_baskets(spark, b).drop("_file")
    assert ra.count() == 3 and ra.exceptAll(rb).count() == 0 and rb.exceptAll(ra).count() == 0
    assert sorted(r.request_key for r in ra.collect()) == ["req.json:0:0", "req.json:0:1", "req.json:0:2"]
    rows = {r.test_id: r for r in ra.collect()}
    assert rows["x3"].tracks == []
    assert len([k for k in rows if k.startswith("unknown_")]) == 1


def test_incremental_ingest(spark, tmp_dir):
    src, dst, ck = (os.path.join(tmp_dir, n) for n in ("src", "dst", "ck"))
    os.makedirs(src)

    def deliver(i):
        doc = {"playlists": [{"pid": 3 * i + j, "tracks": [{"track_uri": f"t{j}", "pos": 0}]} for j in range(3)]}
        _write(src, f"baskets.part.{i}.json", json.dumps(doc, indent=2))

    deliver(0)
    deliver(1)
    counts = [ingest_increment(spark, src, dst, ck, max_files=1).first().baskets]
    deliver(2)
    counts.append(ingest_increment(spark, src, dst, ck).first().baskets)
    last = ingest_increment(spark, src, dst, ck).first()
    counts.append(last.baskets)
    assert counts == [6, 9, 9] and last.new_baskets == 0 and last.files == 3


def test_read_with_fallback(spark, tmp_dir):
    spark.range(3).write.parquet(os.path.join(tmp_dir, "train"))
    df, used = read_with_fallback(spark, os.path.join(tmp_dir, "missing"), os.path.join(tmp_dir, "train"))
    assert used == "fallback" and df.count() == 3


def test_recommend_popular_hot_basket_spans_chunks(spark):
    """A basket holding most of the catalogue expands to more than one chunk of rank slots;
    results equal a brute-force exclusion."""
    n_items = 6000
    scored = spark.range(1, n_items + 1).select(F.col("id").alias("item"),
                                                 ((F.col("id") * 7919) % 1000).cast("double").alias("popularity_score"))
    ranked = R.top_candidates(scored, n=None)
    hot_seen = spark.range(1, n_items + 1).where("id % 10 != 3").select(F.lit(1).cast("long").alias("basket"),
                                                                      F.col("id").alias("item"))
    small_seen = spark.createDataFrame([(2, 5), (2, 6)], "basket long, item long")
    seen = hot_seen.unionByName(small_seen)
    baskets = spark.createDataFrame([(1,), (2,), (3,)], "basket long")
    recs = R.recommend_popular(baskets, seen, ranked, k=100)
    order = [r.item for r in ranked.orderBy("cand_rank").collect()]
    held = {1: {r.item for r in hot_seen.collect()}, 2: {5, 6}, 3: set()}
    for b in (1, 2, 3):
        expect = [i for i in order if i not in held[b]][:100]
        got = [r.item for r in recs.where(f"basket = {b}").orderBy("rank").collect()]
        assert got == expect, b


def test_ingest_batches_follow_max_files(spark, tmp_dir):
    src, dst, ck = (os.path.join(tmp_dir, n) for n in ("src", "dst", "ck"))
    os.makedirs(src)
    for i in range(5):
        doc = {"playlists": [{"pid": i, "tracks": [{"track_uri": "t", "pos": 0}]}]}
        _write(src, f"baskets.part.{i}.json", json.dumps(doc))
    run = ingest_increment(spark, src, dst, ck, max_files=2).first()
    assert (run.files, run.baskets, run.new_baskets, run.batches) == (5, 5, 5, 3)  # 2 + 2 + 1 files


def test_equal_and_empty_requests_stay_apart(spark, tmp_dir):
    """Two equal unnamed requests, an empty one and two with one id: five outputs in either root."""
    one = {"tracks": [{"track_uri": "u1"}]}
    reqs = [one, one, {}, {"test_id": "a", "tracks": []}, {"test_id": "a", "tracks": []}, None]
    for name, root in (("a", reqs), ("b", {"playlists": reqs})):
        os.makedirs(os.path.join(tmp_dir, name))
        _write(os.path.join(tmp_dir, name), "r.json", json.dumps(root))
        _write(os.path.join(tmp_dir, name), "bad.json", "{ not json")
        rows = read_request_baskets(spark, os.path.join(tmp_dir, name)).collect()
        assert len(rows) == len({r.request_key for r in rows}) == 5
        assert len({r.test_id for r in rows}) == 4


def test_each_request_gets_a_list(spark, tmp_dir):
    from hamper.plans import jobs
    one = {"tracks": [{"track_uri": "u1"}]}
    _write(tmp_dir, "r.json", json.dumps([one, one, {}]))
    spark.createDataFrame([(1, "u1"), (1, "u2"), (2, "u2")], "basket_idx long, item string").write.parquet(
        os.path.join(tmp_dir, "stage", "train"))
    info = jobs.submit(spark, os.path.join(tmp_dir, "r.json"), os.path.join(tmp_dir, "stage"), os.path.join(tmp_dir, "out")).first()
    lists = spark.read.json(os.path.join(tmp_dir, "out", "playlists")).collect()
    assert (info.total_playlists, info.read_back) == (3, 3)
    assert sorted(tuple(r.recommended_tracks) for r in lists) == [("u2",), ("u2",), ("u2", "u1")]


def test_ingest_counts_beyond_the_progress_window(spark, tmp_dir):
    """More batches than the session keeps progress entries for; three baskets a file; a file
    that fails, and comes again whole under its name; a name that was read already."""
    src, dst, ck = (os.path.join(tmp_dir, n) for n in ("src", "dst", "ck"))
    os.makedirs(src)

    def deliver(folder, i):
        os.makedirs(os.path.join(src, folder), exist_ok=True)
        doc = {"playlists": [{"pid": 3 * i + j, "tracks": [{"track_uri": "t", "pos": 0}] * j} for j in range(3)]}
        _write(os.path.join(src, folder), f"baskets.{i}.json", json.dumps(doc))
    for i in range(6):
        deliver("one", i)
    _write(os.path.join(src, "one"), "baskets.9.json", "{ damaged")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "2")
    try:
        first = ingest_increment(spark, src + "/*", dst, ck, max_files=1).first()
    finally:
        spark.conf.unset("spark.sql.streaming.numRecentProgressUpdates")
    assert (first.files, first.failed, first.baskets, first.interactions) == (6, 1, 18, 18)
    assert (first.new_files, first.new_failed, first.new_baskets, first.batches) == (6, 1, 18, 7)
    deliver("two", 9)
    deliver("two", 0)   # known by name
    second = ingest_increment(spark, src + "/*", dst, ck).first()
    assert (second.files, second.failed, second.baskets, second.new_files, second.new_baskets) == (7, 1, 21, 1, 3)
    from hamper.streaming.ingest import read_ingested
    assert read_ingested(spark, dst).count() == 21


def test_damaged_primary_is_an_error(spark, tmp_dir):
    spark.range(3).write.parquet(os.path.join(tmp_dir, "train"))
    os.makedirs(os.path.join(tmp_dir, "empty"))
    with pytest.raises(Exception, match="UNABLE_TO_INFER_SCHEMA"):
        read_with_fallback(spark, os.path.join(tmp_dir, "empty"), os.path.join(tmp_dir, "train"))
    assert read_with_fallback(spark, None, os.path.join(tmp_dir, "train"))[1] == "fallback"


def test_cooccurrence_supp_all_keeps_pairs_from_the_own_threshold_on(spark, tmp_dir):
    """The registered query on large baskets returns pairs seen 3 to 17 times too."""
    from collections import Counter
    from itertools import combinations

    from hamper.plans.catalog import QUERIES
    baskets = {s: [p for p in range(260) if s == 0 or p % (s + 1) == 0] for s in range(8)}
    rows = [(i, p, s, i % 4) for s, items in baskets.items() for i, p in enumerate(items)]
    (spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int")
     .selectExpr("*", "timestamp_seconds(l_orderkey) AS l_shipdate").write.parquet(f"{tmp_dir}/lineitem.parquet"))
    seen = Counter(p for items in baskets.values() for p in combinations(items, 2))
    expected = {p: n for p, n in seen.items() if n >= 3}
    assert expected and max(expected.values()) < 18
    got = {(r.item1, r.item2): r.cooccur_count for r in QUERIES["cooccurrence_supp_all"](spark, tmp_dir).collect()}
    assert got == expected


def test_cooccurrence_supp_counts_each_copy(spark, tmp_dir):
    """A supplier that delivers an item three times and another once makes a pair of three (F8)."""
    from datetime import date

    from hamper.plans.catalog import QUERIES

    lines = [(n, item, 1, n, date(1995, 1, n)) for n, item in enumerate((5, 5, 5, 8, 9), 1)]
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_shipdate date") \
        .write.parquet(f"{tmp_dir}/lineitem.parquet")
    got = {(r.item1, r.item2): r.cooccur_count for r in QUERIES["cooccurrence_supp"](spark, tmp_dir).collect()}
    assert got == {(5, 8): 3, (5, 9): 3}
