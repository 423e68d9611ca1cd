"""A basket holding a third of all rows goes through split, ranking and metrics on the
range-partitioned path; results equal a plain pandas computation."""

import numpy as np
import pandas as pd

from pyspark.sql import functions as F

from hamper.operators import features as FE
from hamper.operators import metrics as M
from hamper.operators import ranking as R
from hamper.operators.split import split_ordered


def _interactions(seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for b in range(1, 301):  # ordinary baskets of 1..30 rows
        n = int(rng.integers(1, 31))
        rows += [(b, int(rng.integers(1, 400)), p) for p in range(n)]
    hot = len(rows) // 2  # basket 0 ends up with a third of all rows
    rows += [(0, int(rng.integers(1, 400)), p) for p in range(hot)]
    return pd.DataFrame(rows, columns=["basket", "item", "position"])


def test_hot_basket_end_to_end(spark):
    pdf = _interactions()
    assert (pdf.basket == 0).mean() > 0.3
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "11")  # the hot basket spans several range partitions
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = spark.createDataFrame(pdf).repartition(5)
        split = split_ordered(df)
        train = split.where("is_train").select("basket", "item", "position")
        test = split.where("not is_train").select("basket", "item", "position")
        ranked = R.top_candidates(FE.simple_popularity(train), n=None)
        baskets = test.select("basket").distinct()
        recs = R.recommend_popular(baskets, train, ranked, k=20)
        truth = M.truth_pairs(test)
        hit_rows = M.hits(recs, truth)
        at_k = {r.k: r for r in M.metrics_at_k(hit_rows, baskets, truth, ks=(5, 20)).collect()}
        got_recs = recs.toPandas()
        got_split = split.toPandas()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")

    # reference computation in pandas
    exp = pdf.sort_values(["basket", "position", "item"]).copy()
    exp["rank"] = exp.groupby("basket").cumcount() + 1
    exp["size"] = exp.groupby("basket")["item"].transform("size")
    exp["is_train"] = exp["rank"] <= exp["size"] * 0.8
    merged = got_split.merge(exp, on=["basket", "position", "item"])
    assert len(merged) == len(pdf) and (merged.is_train_x == merged.is_train_y).all()
    assert (merged.split_rank == merged["rank"]).all() and (merged.basket_size == merged["size"]).all()

    tr, te = exp[exp.is_train], exp[~exp.is_train]
    pop = tr.groupby("item").agg(f=("basket", "size"), u=("basket", "nunique"))
    pop["score"] = pop.f + 0.5 * pop.u
    order = pop.reset_index().sort_values(["score", "item"], ascending=[False, True]).item.tolist()
    seen = tr.groupby("basket").item.apply(set).to_dict()
    for b in te.basket.unique():
        want = [i for i in order if i not in seen.get(b, set())][:20]
        got = got_recs[got_recs.basket == b].sort_values("rank").item.tolist()
        assert got == want, b

    pairs = te[["basket", "item"]].drop_duplicates()
    n_b = te.basket.nunique()
    for k in (5, 20):
        top = got_recs[got_recs["rank"] <= k]
        h = top.merge(pairs, on=["basket", "item"])
        assert at_k[k].hits == len(h)
        assert abs(at_k[k].precision - len(h) / (n_b * k)) < 1e-12
        assert abs(at_k[k].recall - len(h) / len(pairs)) < 1e-12
        assert abs(at_k[k].coverage - h.basket.nunique() / n_b) < 1e-12


def test_hot_basket_join_is_split_by_aqe(spark):
    """encode's shuffled join on a basket key holding half the rows is split by AQE's
    skew-join handling (thresholds lowered so it triggers at test size)."""
    from pyspark.sql import functions as F

    from hamper.operators.interactions import build_indexes, encode

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1",
            "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        rows = spark.range(20000).select(
            F.when(F.col("id") % 2 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("basket"),
            (F.col("id") % 301).alias("item"), F.col("id").cast("int").alias("position"))
        bidx, iidx = build_indexes(rows)
        enc = encode(rows, bidx, iidx)
        assert len(enc.collect()) == 20000  # runs enc's own plan, so its AQE plan is final
        final = enc._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert any("SortMergeJoin" in ln and "skew=true" in ln.replace(" ", "").lower() or "isSkewJoin=true" in ln
               for ln in final.splitlines()), final


def test_rank_lookup_is_salted(spark):
    """Every basket asks for the same first ranks. Without AQE's skew handling, the lookup's
    shuffle still deals them to many tasks."""
    from pyspark.sql import functions as F

    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false",
            "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        ranked = R.top_candidates(spark.range(50).select(F.col("id").alias("item"), (-F.col("id")).cast("double").alias(
            "popularity_score")), n=None)
        baskets = spark.range(4000).select(F.col("id").alias("basket"))
        seen = spark.createDataFrame([], "basket long, item long")
        recs = R.recommend_popular(baskets, seen, ranked, k=2)   # 8,000 rows on two ranks
        sizes = [r["n"] for r in recs.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert sum(sizes) == 8000 and len(sizes) > 8 and max(sizes) < 2000


def test_hot_basket_pairs_match_plain_count(spark, monkeypatch):
    from collections import Counter
    from itertools import combinations

    from hamper.operators import cooccurrence as C

    monkeypatch.setattr(C, "BLOCK_ITEMS", 7)
    pdf = _interactions(3)
    df = spark.createDataFrame(pdf[pdf.basket < 40])
    got = {(r.item1, r.item2): r.cooccur_count for r in C.cooccurrence(df, max_size=None, min_count=2).collect()}
    want = Counter()
    for _, items in pdf[pdf.basket < 40].groupby("basket").item:
        if len(items) >= 5:
            want.update((min(a, b), max(a, b)) for a, b in combinations(items, 2) if a != b)
    assert got == {p: n for p, n in want.items() if n >= 2}
    out = C.excluded_baskets(df, max_size=100).first()
    sizes = pdf[pdf.basket < 40].groupby("basket").size()
    assert (out.small_baskets, out.large_baskets) == ((sizes < 5).sum(), (sizes > 100).sum())
    assert (out.small_rows, out.large_rows) == (sizes[sizes < 5].sum(), sizes[sizes > 100].sum())


def test_pairs_are_counted_without_being_shuffled(spark, monkeypatch):
    """Pairs in large baskets come out of their group counted: no exchange above it, and no task pairs more than two blocks."""
    import random
    from collections import Counter
    from itertools import combinations

    from hamper.operators import cooccurrence as C

    rng = random.Random(7)
    rows = [(b, f"i{rng.randrange(60)}", n) for b in range(30) for n in range(rng.randint(20, 60))]
    rows += [(b, "everywhere", 99) for b in range(30)]
    df = spark.createDataFrame(rows, "basket long, item string, position int")
    bags = {}
    for b, i, _ in rows:
        bags.setdefault(b, Counter())[i] += 1
    want = Counter()
    for bag in bags.values():
        for x, y in combinations(sorted(bag), 2):
            want[x, y] += bag[x] * bag[y]
    count = lambda: C.cooccurrence(df, max_size=None, min_count=2)
    got = lambda out: {(r.item1, r.item2): r.cooccur_count for r in out.collect()}
    n = sum(map(len, bags.values()))
    layouts = []
    plain = C._layout
    monkeypatch.setattr(C, "_layout", lambda *a: layouts.append(plain(*a)) or layouts[-1])
    for block, pairs, classes in ((n // 3, 1000, 4), (n // 20, 1000, 4), (n // 20, 1000, 64), (10 ** 6, 10 ** 6, 4)):
        monkeypatch.setattr(C, "BLOCK_ITEMS", block)
        monkeypatch.setattr(C, "SLICE_PAIRS", pairs)
        monkeypatch.setattr(C, "_CHUNK", 50)
        monkeypatch.setattr(C, "MAX_CLASSES", classes)
        out = count()
        assert got(out) == {p: c for p, c in want.items() if c >= 2}
        if layouts[-1][2] > 1 == layouts[-1][3]:
            plan = out._jdf.queryExecution().executedPlan().toString()
            assert plan.index("FlatMapGroupsInArrow") < plan.index("Exchange")
    assert {(k > 1, s > 1) for _, _, k, s in layouts} == {(True, False), (True, True), (False, True), (False, False)}


def test_recommendations_gather_only_seen_rows_near_the_top(spark, monkeypatch):
    """Few or many of the first ranks seen: the same lists as a plain walk (F9, F15)."""
    import random

    rng = random.Random(5)
    ranked = R.top_candidates(spark.range(300).select(F.col("id").alias("item"), (-F.col("id")).cast("double").alias(
        "popularity_score")), n=None)
    seen = {b: {rng.randrange(300) for _ in range(b * 8)} for b in range(30)} | {30: set(range(290))}
    rows = [(b, i) for b, items in seen.items() for i in items for _ in range(1 + i % 2)] + [(None, 1), (2, None)]
    pairs = spark.createDataFrame(rows, "basket long, item long")
    baskets = spark.createDataFrame([(b,) for b in [*seen, *seen, None, 77]], "basket long")
    want = {(b, i, n) for b in [*seen, None, 77] for n, i in enumerate([i for i in range(300) if i not in seen.get(b, ())][:20], 1)}
    for near in (4096, 3, 0):
        monkeypatch.setattr(R, "NEAR", near)
        recs = R.recommend_popular(baskets, pairs, ranked, k=20)
        assert sorted(map(tuple, recs.collect()), key=str) == sorted(want, key=str)
    monkeypatch.setattr(R, "NEAR", 4096)
    lists = R.recommend_popular(baskets, pairs, ranked, k=20).groupBy("basket").count()
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and plan.count("Exchange hashpartitioning") <= 1


def test_offers_within_a_chunk_and_beyond_are_equal(spark, monkeypatch):
    """Offered rows are the ranks up to each basket's reach, and frames keep only offered items (F12, F13)."""
    from hamper.session import materialize

    ranked = spark.range(1, 200).select((F.col("id") * 3).alias("item"), F.col("id").alias("cand_rank"), (1 / F.col("id")).alias("x"))
    reach = materialize(spark.range(40).select(F.col("id").alias("basket"), (F.col("id") * 3).alias("reach")))
    frame = spark.range(700).select(F.col("id").alias("item"), (F.col("id") % 5).alias("basket"))
    for chunk in (4096, 50):
        monkeypatch.setattr(R, "_CHUNK", chunk)
        cands, kept = R.offer(reach, ranked, [frame])
        assert sorted(map(tuple, cands.select("basket", "item", "x").collect())) == sorted(
            (b, 3 * n, 1 / n) for b in range(40) for n in range(1, 3 * b + 1))
        assert {r.item for r in kept.collect()} == {3 * n for n in range(1, 118)}


def test_pairs_on_lines_and_items_of_many_rows(spark, monkeypatch):
    """Baskets of any kind (numbers, negative and far apart, names, dates), and an item whose pairs
    fill many chunks, on lines of two to five classes (F8, F9)."""
    import datetime
    import random
    from collections import Counter
    from itertools import combinations

    from hamper.operators import cooccurrence as C

    rng = random.Random(8)
    bags = [Counter(rng.choices(range(70), k=rng.randint(8, 30)) + [70]) for _ in range(60)]
    want = Counter()
    for bag in bags:
        for x, y in combinations(sorted(bag), 2):
            want[x, y] += bag[x] * bag[y]
    monkeypatch.setattr(C, "SLICE_PAIRS", 500)
    monkeypatch.setattr(C, "_CHUNK", 40)
    monkeypatch.setattr(C, "PACK_ROWS", 50)
    rows = sum(map(len, bags))
    kinds = {"long": lambda b: (b - 30) * (1 << 58) + b, "int": lambda b: b * 7 - 90, "string": lambda b: f"b{b % 10}-{b}",
             "date": lambda b: datetime.date(2000, 1, 1) + datetime.timedelta(days=b)}
    for (kind, name), lines in zip(kinds.items(), (2, 3, 4, 5)):
        monkeypatch.setattr(C, "BLOCK_ITEMS", -(-rows // lines))
        df = spark.createDataFrame([(name(b), i) for b, bag in enumerate(bags) for i, n in bag.items() for _ in range(n)],
                                   f"basket {kind}, item int")
        got = {(r.item1, r.item2): r.cooccur_count for r in C.cooccurrence(df, max_size=None, min_count=2).collect()}
        assert got == {p: n for p, n in want.items() if n >= 2}, kind


def test_rows_travel_packed_and_fewer_times(spark, monkeypatch):
    """A row is copied once more than a line has classes, in a few bytes; what it came from is gone by then (F8, F9)."""
    from hamper.operators import cooccurrence as C
    from hamper.session import recorded_scratch

    monkeypatch.setattr(C, "SLICE_PAIRS", 20_000)
    monkeypatch.setattr(C, "BLOCK_ITEMS", 8_000)
    df = spark.range(40_000).selectExpr("id % 100 as basket", "pmod(xxhash64(id), 3000) as item")
    with recorded_scratch() as folders:
        out = C.cooccurrence(df, max_size=None, min_count=2)
    jvm, left = spark._jvm.org.apache.hadoop.fs.Path, []
    for f in folders:
        path = jvm(f)
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        left += [f] if fs.exists(path) else []
    assert len(folders) == 3 and len(left) == 1
    packs = spark.read.parquet(left[0])
    rows = packs.selectExpr("sum(_n) n", "sum(octet_length(_steps) + octet_length(_places) + octet_length(_more)) bytes").first()
    assert rows.bytes < 5 * rows.n
    assert out.count() > 0
