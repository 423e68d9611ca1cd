"""Exact top-k against a numpy brute force."""

import random

from pyspark.sql import functions as F

from hamper.llm import topk as X


def brute(rows, queries, k):
    rows = [(i, v) for i, v in rows if v is not None and None not in v]
    first = {}
    for i, v in queries:
        if i is not None and v is not None and None not in v:
            first[i] = min(first.get(i, v), v)
    out = []
    for q, w in first.items():
        scored = [(-sum(a * b for a, b in zip(w, v)), i is None, i or 0, i) for i, v in rows if i is None or i != q]
        out += [(q, n + 1, i, -s) for n, (s, _, _, i) in enumerate(sorted(scored, key=lambda t: t[:3])[:k])]
    return sorted(out, key=repr)


def check(spark, rows, queries, k):
    schema = "vec_id long, vector array<bigint>"
    got = X.exact_topk(spark.createDataFrame(rows, schema).repartition(3), spark.createDataFrame(queries, schema), k)
    assert sorted(map(tuple, got.collect()), key=repr) == brute(rows, queries, k)


def test_topk_matches_brute_force(spark, monkeypatch):
    monkeypatch.setattr(X, "CANDIDATES", 16)   # many blocks on either side
    monkeypatch.setattr(X, "QUERIES", 4)
    rng = random.Random(5)
    rows = [(i, [rng.choice([0, 0, 0, 1, -2, 7]) for _ in range(rng.choice([6, 6, 4]))]) for i in range(120)]
    rows += [(None, [1] * 6), (3, [9] * 6), (3, [9] * 6), (200, None), (201, [1, None]), (202, []), (203, [0] * 6)]
    check(spark, rows, [r for r in rows if r[0] is None or r[0] % 10 in (0, 3)], 5)


def test_few_candidates_and_empty_sides(spark):
    rows = [(1, [1, 2]), (2, [3, 4])]
    check(spark, rows, rows, 5)
    check(spark, rows, [], 5)
    check(spark, [], rows, 5)
    check(spark, [], [], 5)


def test_quantize_and_usable(spark):
    rows = [(1, [0.5, -0.001, 1.0]), (2, None), (3, [1.0, None]), (4, [float("nan")]), (5, [float("-inf")]), (6, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").where(X.usable(F.col("embedding")))
    got = {r.vec_id: r.v for r in df.select("vec_id", X.quantize(F.col("embedding")).alias("v")).collect()}
    assert got == {1: [128, -1, 256], 6: []}


def test_huge_weights_score_exactly(spark, monkeypatch):
    """Sums beyond a long: ranked exactly, beside blocks that stay within it."""
    monkeypatch.setattr(X, "CANDIDATES", 8)
    rng = random.Random(9)
    rows = [(i, [rng.randint(-3, 3) for _ in range(5)]) for i in range(30)]
    rows += [(100 + i, [rng.choice([1 << 40, -(1 << 40), 3]) + rng.randint(-9, 9) for _ in range(5)]) for i in range(12)]
    queries = [(i, [rng.randint(-5, 5) for _ in range(5)]) for i in range(4)]
    check(spark, rows, queries, 6)                          # 2**40 against small weights
    schema = "vec_id long, vector array<bigint>"
    asked = [(900, [1 << 40, 1 << 39, -(1 << 40), 7, 0])]
    got = X.exact_topk(spark.createDataFrame(rows, schema), spark.createDataFrame(asked, schema), 40).collect()
    exact = {(q, n): (i, s) for q, n, i, s in brute(rows, asked, 40)}
    top, low = (1 << 63) - 1, -(1 << 63)
    assert {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in got} == {
        k: (i, min(top, max(low, s))) for k, (i, s) in exact.items()}
    assert any(not low <= s <= top for _, s in exact.values())


def test_candidates_are_moved_once(spark, monkeypatch):
    """Candidate blocks are shuffled to their number and scored there."""
    schema = "vec_id long, vector array<bigint>"
    df = spark.createDataFrame([(i, [i, 1]) for i in range(50)], schema)
    plan = X.exact_topk(df, df.limit(3), 2)._jdf.queryExecution().executedPlan().toString()
    below = plan[plan.index("MapInArrow"):]
    assert "Cartesian" not in plan and below.count("Exchange hashpartitioning") + below.count("BroadcastExchange") <= 2
    assert "q_block" not in "".join(line for line in below.splitlines() if "Exchange" in line)


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, [1, 2], 5, "x"), (2, [2, 2], 6, "y")], "key long, w array<bigint>, vec_id int, block string")
    got = X.exact_topk(df, df, 1, "key", "w").collect()
    assert sorted((r.query_id, r.vec_id, r.score) for r in got) == [(1, 2, 6), (2, 1, 6)]


def test_queries_are_not_collected_on_the_driver(spark, monkeypatch):
    """The copies of the queries are merged with the candidate blocks, a copy a cell of blocks (F1)."""
    monkeypatch.setattr(X, "CANDIDATES", 8)
    schema = "vec_id long, vector array<bigint>"
    df = spark.createDataFrame([(i, [i % 7, 1, -i]) for i in range(400)], schema).repartition(2)
    out = X.exact_topk(df, df.where("vec_id % 10 = 0"), 2)
    rows = out.count()
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert rows == 80 and "Broadcast" not in plan[plan.index("MapInArrow"):] and "SortMergeJoin" in plan
    blocks = 50
    assert f"sequence(0, {max(-(-blocks // X.CELL), 4) - 1}" in out._jdf.queryExecution().analyzed().toString()


def test_common_terms_are_added_up_like_rare_ones(spark, monkeypatch):
    """Terms of most rows, of few, and sums that doubles no longer hold (F1)."""
    rng = random.Random(11)
    rows = [(i, [rng.choice([0, 1, -3]), 5 * (i % 40 == 0), rng.randint(-9, 9), i]) for i in range(200)]
    for terms, common in ((2, 16), (128, 1), (1, 10 ** 6)):
        monkeypatch.setattr(X, "TERMS", terms)
        monkeypatch.setattr(X, "COMMON", common)
        check(spark, rows, rows[::9], 4)
    near = [(i, [(1 << 26) + rng.randint(0, 3), (1 << 27) - rng.randint(0, 3)]) for i in range(40)]
    check(spark, near, near[::5], 4)
