"""Invariants of the pipeline on the CUST binding (sf0.001)."""

import pytest
from pyspark.sql import functions as F

from hamper.operators import metrics as M
from hamper.plans import catalog as C
from tests.conftest import SF001


@pytest.fixture(scope="module")
def split(spark):
    return C.cust_split(spark, SF001)


def test_split_partitions_every_basket(split):
    per = split.groupBy("basket").agg(F.count("*").alias("n"), F.count_if("is_train").alias("t"),
                                      F.max("basket_size").alias("size"))
    assert per.where("n != size or t != floor(n * 4 / 5)").count() == 0
    # train rows come strictly before test rows inside a basket
    bad = split.groupBy("basket").agg(F.max(F.when(F.col("is_train"), F.col("position"))).alias("a"),
                                      F.min(F.when(~F.col("is_train"), F.col("position"))).alias("b"))
    assert bad.where("a >= b").count() == 0


def test_recs_exclude_seen_and_ranks_contiguous(spark):
    recs = C.cust_recs(spark, SF001)
    train = C.cust_train(spark, SF001)
    assert recs.join(train, ["basket", "item"], "left_semi").count() == 0
    per = recs.groupBy("basket").agg(F.count("*").alias("n"), F.max("rank").alias("m"),
                                     F.count_distinct("item").alias("d"))
    assert per.where("n != m or d != n or n > 100").count() == 0


def test_metrics_bounds_and_monotone_recall(spark):
    rows = C.q_metrics_at_k(spark, SF001).orderBy("k").collect()
    assert all(0 <= r[c] <= 1 for r in rows for c in ("precision", "recall", "coverage"))
    recalls = [r.recall for r in rows]
    assert recalls == sorted(recalls)
    mp = C.q_map_at_100(spark, SF001).first()
    assert 0 <= mp.map <= 1 and mp.baskets == 150


def test_partition_invariance(spark):
    """Same rows with 1 and 8 shuffle partitions (sampling and numbering included)."""
    out = {}
    for parts in ("1", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        C.clear_memo()
        try:
            out[parts] = [sorted(map(tuple, C.QUERIES[q](spark, SF001).collect()))
                          for q in ("split_train", "row_sample", "stratified_sample", "recs_unseen", "cooccurrence")]
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", "4")
    C.clear_memo()
    assert out["1"] == out["8"]


def test_precision_uses_fixed_denominator(spark):
    hits = spark.createDataFrame([(1, 10, 1)], "basket long, item long, rank long")
    baskets = spark.createDataFrame([(1,), (2,)], "basket long")
    truth = spark.createDataFrame([(1, 10), (2, 11)], "basket long, item long")
    r = {x.k: x for x in M.metrics_at_k(hits, baskets, truth, ks=(10,)).collect()}[10]
    assert (r.hits, r.precision, r.recall, r.coverage) == (1, 1 / 20, 0.5, 0.5)


def test_fused_split_equals_general_split(spark):
    from hamper.operators.split import split_ordered
    from hamper.plans import bindings as B
    general = split_ordered(B.cust(spark, SF001)).select("basket", "item", "position", "split_rank",
                                                         "basket_size", "is_train")
    fused = C.cust_split(spark, SF001)
    assert general.exceptAll(fused).count() == 0 and fused.exceptAll(general).count() == 0


def test_items_below_the_bound_leave_before_pairing(spark):
    """The pairing sees only items that may reach the threshold, and the counts stay the same."""
    from itertools import combinations
    from collections import Counter
    import random

    from hamper.operators import cooccurrence as CO
    rng = random.Random(4)
    rows = [(b, rng.choice(range(40)) if rng.random() < 0.6 else 1000 + rng.randrange(4000), n)
            for b in range(80) for n in range(rng.randint(5, 12))]
    df = spark.createDataFrame(rows, "basket long, item long, position int")
    bags = {}
    for b, i, _ in rows:
        bags.setdefault(b, Counter())[i] += 1
    for low in (1, 2, 3, 5):
        counts = Counter()
        for bag in bags.values():
            for a, b in combinations(sorted(bag), 2):
                counts[a, b] += bag[a] * bag[b]
        got = {(r.item1, r.item2): r.cooccur_count for r in CO.cooccurrence(df, min_count=low).collect()}
        assert got == {p: n for p, n in counts.items() if n >= low}
        folded = df.groupBy("basket", "item").count().withColumnRenamed("count", "_copies")
        kept = {r.item for r in CO.possible_partners(folded, low).collect()}
        assert {i for p in got for i in p} <= kept
        pairs = sum(1 for bag in bags.values() for _ in combinations(sorted(bag), 2))
        left = sum(1 for bag in bags.values() for _ in combinations(sorted(kept & set(bag)), 2))
        assert low < 3 or left < 0.6 * pairs


def test_metrics_at_any_cut_off(spark):
    """The histograms against a plain count, with ranks beyond, ties of baskets, and no hits at all."""
    import random

    from hamper.operators import metrics as M
    rng = random.Random(2)
    hits = [(b, i, rng.randint(1, 120)) for b in range(30) for i in range(rng.randint(0, 6))]
    baskets = spark.range(40).withColumnRenamed("id", "basket")
    truth = spark.createDataFrame([(b, i) for b, i, _ in hits] + [(99, 1)], "basket long, item long")
    frame = spark.createDataFrame(hits, "basket long, item long, rank long")
    ks = (1, 7, 50, 100)
    for r in M.metrics_at_k(frame, baskets, truth, ks).collect():
        near = [(b, i) for b, i, rank in hits if rank <= r.k]
        assert (r.hits, r.precision, r.recall, r.coverage) == (
            len(near), len(near) / (40 * r.k), len(near) / (len(hits) + 1), len({b for b, _ in near}) / 40)
    plan = M.metrics_at_k(frame, baskets, truth, ks)._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan and "Generate explode" not in plan
    none = M.metrics_at_k(frame.limit(0), baskets, truth, ks).orderBy("k").collect()
    assert [(r.k, r.hits, r.precision, r.recall, r.coverage) for r in none] == [(k, 0, 0.0, 0.0, 0.0) for k in ks]
