"""BagMinHash: unbiased estimates; classes equal all-pairs brute force."""

import os
import random
from collections import Counter, defaultdict

import numpy as np

from hamper.llm import bagminhash as X
from hamper.session import recorded_scratch

SCHEMA = "doc_id long, text string, key string, gone int"


def bag(text):
    w = (text or "").encode().lower().split()
    return Counter([tuple(w)] if 0 < len(w) < 5 else [tuple(w[i:i + 5]) for i in range(len(w) - 4)])


def brute(rows):
    """class of each row by connected components over all pairs."""
    bags = [bag(t) for _, t in rows]
    index, parent = defaultdict(list), list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for n, b in enumerate(bags):
        if rows[n][0] is None:
            continue
        for m in {m for s in b for m in index[s]}:
            if 5 * sum((b & bags[m]).values()) >= 4 * sum((b | bags[m]).values()):
                parent[find(n)] = find(m)
        for s in b:
            index[s].append(n)
    least = defaultdict(list)
    for n, (i, _) in enumerate(rows):
        least[find(n)].append(i)
    return sorted(((i, None if i is None else min(least[find(n)])) for n, (i, _) in enumerate(rows)), key=repr)


def near(text, rng, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
    return " ".join(w)


def corpus(seed=6):
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = [" ".join(word() for _ in range(rng.randint(5, 120))) for _ in range(60)]
    hot = " ".join(word() for _ in range(150))
    texts += [near(hot, rng, rng.randint(1, 3)) for _ in range(120)] + [hot] * 20
    shared = " ".join(word() for _ in range(60))     # a long passage in otherwise different texts
    texts += [shared + " " + " ".join(word() for _ in range(rng.randint(6, 60))) for _ in range(60)]
    for t in list(texts[:40]):
        texts += [near(t, rng, 1) for _ in range(2)]
    chain = texts[5] + " " + texts[6]
    for _ in range(12):                              # links run on from text to text
        chain = near(chain, rng, 2)
        texts.append(chain)
    texts += ["same words " * n for n in (3, 5, 50, 51, 60, 90)] + ["a b", "a  B\n", "a b c", "", None, "  ", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    return [(i * 3 + 1, t) for i, t in rows] + [(None, hot), (None, None), (4, texts[1])]


def classes(spark, rows):
    df = spark.createDataFrame([(*r, "k", 1) for r in rows], SCHEMA).repartition(4)
    return df, X.near_duplicates(df).cache()


def test_classes_match_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(X, "TILE", 8)     # buckets of several tiles
    rows = corpus()
    df, found = classes(spark, rows)
    got = sorted(map(tuple, found.select("doc_id", "class_id").collect()), key=repr)
    assert got == brute(rows)
    assert all(r.kept == (r.doc_id == r.class_id) for r in found.where("doc_id is not null").collect())
    kept = X.drop_near_duplicates(df)
    ids = Counter(r.doc_id for r in kept.collect())
    assert kept.columns == df.columns and ids[None] == 2
    by = dict(brute(rows))
    assert {i for i in ids if i is not None} == {c for c in by.values() if c is not None}


def test_shuffled_join_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(X, "BROADCAST_ROWS", 0)
    rows = corpus(9)[:150]
    assert sorted(map(tuple, classes(spark, rows)[1].select("doc_id", "class_id").collect()), key=repr) == brute(rows)


def test_overfull_filter_loses_no_link(spark, monkeypatch):
    monkeypatch.setattr(X, "BLOOM_KEYS", 1)     # a filter that lets nearly every band and text pass
    monkeypatch.setattr(X, "BROADCAST_ROWS", 0)
    rows = corpus(12)
    assert sorted(map(tuple, classes(spark, rows)[1].select("doc_id", "class_id").collect()), key=repr) == brute(rows)


def unlike(n, words=60):
    rng = random.Random(n)
    return [(i, " ".join(f"w{rng.randrange(10**6)}" for _ in range(words))) for i in range(n)]


def rows_shuffled(df):
    """Rows that the run of ``df`` wrote for its shuffles."""
    df.collect()
    todo, n = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                n += node.metrics().apply("shuffleRecordsWritten").value()
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_bands_of_unlike_texts_are_not_moved_to_the_shared_buckets(spark, monkeypatch):
    """All 32 bands of every document were shuffled a second time, to the few buckets that are
    shared, as soon as those were too many to broadcast."""
    real, moved = X.stage, []

    def stage(df, name, *more):
        if name == "near-held":
            moved.append(rows_shuffled(df))
        return real(df, name, *more)
    monkeypatch.setattr(X, "stage", stage)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = unlike(1500)
        rng = random.Random(2)
        rows += [(5000 + i, near(rows[i][1], rng, 1)) for i in range(5)]
        assert sorted(map(tuple, classes(spark, rows)[1].select("doc_id", "class_id").collect()), key=repr) == brute(rows)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    assert len(moved) == 1 and moved[0] < 3000      # of 48,160 bands


def test_a_signature_is_stored_once(spark):
    """Signatures and their bands (576 bytes a document) stayed on disk twice, to the end."""
    rows = unlike(2000)
    with recorded_scratch() as folders:
        assert classes(spark, rows)[1].count() == len(rows)
    files = [os.path.join(at, f) for path in folders for at, _, names in os.walk(path.removeprefix("file:"))
             for f in names if f.endswith(".parquet")]
    assert 0 < sum(map(os.path.getsize, files)) / len(rows) < 700


def test_empty_and_unlinked_tables(spark):
    assert classes(spark, [])[1].count() == 0
    rows = [(1, "one text"), (2, "another text"), (3, None)]
    assert sorted(map(tuple, classes(spark, rows)[1].collect())) == [(1, 1, True), (2, 2, True), (3, 3, True)]


def test_signatures_estimate_weighted_jaccard():
    rng = random.Random(1)
    errors = []
    for changed in range(24):
        a = {rng.getrandbits(63): rng.choice([1, 1, 2, 3, 5, 9, 40, 700]) for _ in range(40)}
        b = dict(a)
        for w in rng.sample(sorted(a), changed):
            b[w] = rng.choice([1, 2, 6, 33])
        el = lambda d: (np.array(sorted(d), np.uint64), np.array([d[k] for k in sorted(d)]))
        (ea, wa), (eb, wb) = el(a), el(b)
        s = X.signatures(np.r_[np.zeros(len(ea), int), np.ones(len(eb), int)], np.r_[ea, eb], np.r_[wa, wb], 3, m=2048)
        assert np.isinf(s[2]).all()
        errors.append((s[0] == s[1]).mean() - X.weighted_jaccard((ea, wa), (eb, wb)))
    assert abs(np.mean(errors)) < 0.01 and np.abs(errors).max() < 0.06


def test_shingles_match_plain_python():
    texts = ["a b c d e f a b c d e f", "", "x y", "\n ", "A\tB c  d e\x0bf g", "é " * 30, "b" * 5000 + " c"]
    doc, h, c = X.shingles([t.encode() for t in texts])
    for n, t in enumerate(texts):
        assert sorted(c[doc == n]) == sorted(bag(t).values())
    assert len(set(h[doc == 0]) & set(h[doc == 4])) == 2   # "a b c d e", "b c d e f"
