"""Toxicity: held-out accuracy, offending sentences, odd rows."""

import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from conftest import SF001
from hamper.llm import toxicity as X

CLEAN = "the house stands near river green hill water boat morning street window table garden letter music paper stone".split()


def corpus(n, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        toxic = rng.random() < 0.25
        parts = [" ".join(rng.choice(CLEAN) for _ in range(rng.randint(3, 9))) for _ in range(rng.randint(1, 8))]
        if toxic:  # an insult, or an unseen form of a known stem
            at = rng.randrange(len(parts))
            parts[at] += " " + rng.choice(["moron", "scum", "zorkel" + "".join(rng.choice("abcdefgh") for _ in range(4))])
        rows.append((i, ". ".join(parts).capitalize() + ".", int(toxic)))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    rows = corpus(1500)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (3, None), (9_999_999, 1)], "doc_id long, toxic int")
    return X.train(docs, labels)


def test_held_out_accuracy(spark, model):
    rows = corpus(600, seed=8)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    got = {r.doc_id: r for r in X.score_documents(docs, model).collect()}
    wrong = sum((got[i].score >= X.THRESHOLD) != bool(y) for i, _, y in rows)
    assert wrong <= 6
    for i, text, y in rows:
        spans = got[i].offending
        if y and got[i].score > 0.9:   # located: the sentence that holds the word
            assert any(w in text[s.start:s.end].lower() for s in spans for w in ("moron", "scum", "zorkel"))
        if not y and got[i].score < X.THRESHOLD:
            assert not spans


def test_training_skips_held_out_rows(spark):
    rows = [(i, "moron here" if i % 2 else "house there", i % 2) for i in range(400)]
    kept = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    docs = spark.createDataFrame([r[:2] for r in kept], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in kept], "doc_id long, toxic int")
    assert len(X.train(docs, labels)[0]) == 0
    flags = docs.select("doc_id", X.held_out().alias("h")).collect()
    assert flags and all(r.h for r in flags)
    ids = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long").select("doc_id", X.held_out().alias("h"))
    assert all(r.h == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in ids.collect())


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, " \n.!"), (4, "moron"), (4, "moron"), (None, "scum"), (5, "house " * 60_000 + "moron"),
            (6, "house. " * 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = X.score_documents(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    by = {r.doc_id: r.score for r in got}
    assert by[1] == by[2] == by[3] == 0.0 and by[4] > 0.3 and by[None] > 0.3 and by[5] > 0.3 and by[6] < 0.3
    assert X.score_documents(docs.limit(0), model).count() == 0
    scored = docs.withColumn("s", X.score_column(model, spark)(F.col("text"))).collect()
    assert sorted(r.s for r in scored) == pytest.approx(sorted(r.score for r in got))


def test_no_labels_or_one_class(spark):
    docs = spark.createDataFrame([(1, "a house")], "doc_id long, text string")
    none = X.train(docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert X.score_documents(docs, none).first().score < X.THRESHOLD
    clean = X.train(docs, spark.createDataFrame([(1, 0)], "doc_id long, toxic int"))
    assert X.score_documents(docs, clean).first().score < X.THRESHOLD


def test_copies_are_no_evidence():
    f, w, b = X.fit(["rare stone here"] * 50 + ["house there"] * 50, [1] * 50 + [0] * 50)
    assert len(f) == 0


def test_long_letter_runs_count_whole(spark, model):
    """A toxic stem behind a glued run of letters, in Latin letters and in three-byte ones."""
    rows = [(1, "x" * 100 + "zorkelabcd"), (2, "\u0e01" * 100 + "zorkelabcd" + "\u0e02" * 100_000), (3, "x" * 100),
            (4, "\u0e01" * 300_000)]
    got = {r.doc_id: r for r in X.score_documents(spark.createDataFrame(rows, "doc_id long, text string"), model).collect()}
    assert got[1].score >= X.THRESHOLD and got[2].score >= X.THRESHOLD
    assert got[3].score < X.THRESHOLD and got[4].score < X.THRESHOLD


def test_pieces_of_a_long_word_give_all_its_features(monkeypatch):
    word = "".join(random.Random(4).choice("abcde\u0e01\u0e02") for _ in range(5000))
    for size in (1, 7, 1000, 1 << 16):
        monkeypatch.setattr(X, "PIECE_BYTES", size)
        assert set().union(*X.long_word_features(word)) == X.word_features(word)


def test_fitting_reads_long_runs_whole():
    run = "\u0e01\u0e02\u0e03" * 40
    rng = random.Random(6)
    tail = lambda: "".join(rng.choice("\u0e04\u0e05\u0e06\u0e07") for _ in range(12))
    texts = [run + tail() + "zorkel" + tail() for _ in range(200)] + [run + tail() + tail() for _ in range(200)]
    scorer = X.Scorer(*X.fit(texts, [1] * 200 + [0] * 200, rounds=200))
    assert scorer(run + tail() + "zorkel" + tail())[0] > 0.5 > scorer(run + tail() + tail())[0]


def plain_features(word):
    w = f"<{word}>".encode()
    return {zlib.crc32(w[a:b]) % X.BUCKETS for a in range(len(w)) for b in range(a + 3, min(a + 6, len(w)) + 1)} | {zlib.crc32(w) % X.BUCKETS}


def plain_sentences(text):
    """Distinct words of each sentence, longer ones cut after 48 words."""
    for part in re.split(r"[.!?\n]", text):
        words = re.findall(r"[^\W\d_]+", part.lower())
        yield from (set(words[i:i + 48]) for i in range(0, len(words), 48))


def plain_score(text, weights, bias):
    clean = 1.0
    for words in plain_sentences(text):
        z = bias + sum(weights.get(f, 0.0) for w in words for f in plain_features(w))
        clean *= 1 - 1 / (1 + math.exp(-max(-30, min(30, z))))
    return 1 - clean


def test_scores_equal_a_plain_noisy_or(spark, model):
    """Every document of the smallest table, word by word and sentence by sentence."""
    weights = dict(zip(model[0].tolist(), model[1].tolist()))
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    odd = spark.createDataFrame([(-1, "moron. house\n\nscum! " * 30), (-2, "zorkelabcd " + "tree " * 100)], "doc_id long, text string")
    rows = docs.unionByName(odd)
    got = {r.doc_id: r.score for r in X.score_documents(rows, model).collect()}
    for r in rows.collect():
        assert got[r.doc_id] == pytest.approx(plain_score(r.text or "", weights, model[2]), abs=1e-9)


def plain_fit(texts, labels, rounds):
    """The fit one document, sentence, word and feature at a time."""
    docs = [[[sorted(f for w in words for f in plain_features(w)) for words in [s]][0] for s in plain_sentences(t)] for t in texts]
    seen = [{f for s in d for f in s} for d in docs]
    n1, n0 = sum(labels), len(labels) - sum(labels)
    chosen = []
    for f in sorted(set().union(*seen)):
        a, b = sum(f in s for s, y in zip(seen, labels) if y), sum(f in s for s, y in zip(seen, labels) if not y)
        rate, part = (a + b) / (n1 + n0), lambda k, e: k * math.log(k / e) if k else 0.0
        g = 2 * (part(a, n1 * rate) + part(b, n0 * rate) + part(n1 - a, n1 * (1 - rate)) + part(n0 - b, n0 * (1 - rate)))
        if a * n0 > b * n1 and g >= X.EVIDENCE:
            chosen.append(f)
    w, sq, bias, sq_b = dict.fromkeys(chosen, 0.0), dict.fromkeys(chosen, 1e-10), -4.0, 1e-10
    for _ in range(rounds):
        grad, grad_b = {f: X.PENALTY * w[f] for f in chosen}, 0.0
        for doc, y in zip(docs, labels):
            p = [1 / (1 + math.exp(-(bias + sum(w.get(f, 0.0) for f in s)))) for s in doc]
            total = 1 - math.prod(1 - x for x in p)
            for s, x in zip(doc, p):
                g = x / len(docs) * (-(1 - total) / total if y else 1.0)
                grad_b += g
                for f in s:
                    if f in grad:
                        grad[f] += g
        for f in chosen:
            sq[f] += grad[f] ** 2
            w[f] -= 0.5 * grad[f] / math.sqrt(sq[f])
        sq_b += grad_b ** 2
        bias -= 0.5 * grad_b / math.sqrt(sq_b)
    return w, bias


def test_fit_equals_a_plain_one():
    rows = list({r[1]: r for r in corpus(160, seed=12)}.values())
    texts, labels = [r[1] for r in rows], [r[2] for r in rows]
    features, weights, bias = X.fit(texts, labels, rounds=12)
    w, b = plain_fit(texts, labels, 12)
    assert sorted(w) == features.tolist() and len(w) > 3
    assert [w[f] for f in features.tolist()] == pytest.approx(weights.tolist(), rel=1e-6) and b == pytest.approx(bias, rel=1e-6)


def test_documents_are_scanned_by_all_tasks_and_the_fit_sees_the_sample(spark, monkeypatch):
    monkeypatch.setattr(X, "TRAIN_DOCS", 30)
    tasks, seen = spark.sparkContext.accumulator(0), []
    rows = corpus(400)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(6)

    def counted(batches):
        tasks.add(1)
        yield from batches
    real = X.stage
    monkeypatch.setattr(X, "stage", lambda df, name: seen.append(real(df, name)) or seen[-1])
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    X.train(docs.mapInArrow(counted, docs.schema), labels)
    assert tasks.value == 6 and seen[0].count() == 60


def test_clashing_columns(spark, model):
    docs = spark.createDataFrame([(1, "moron", 0.1, "t", 3)], "key long, body string, score double, text string, doc_id int")
    assert [r.doc_id for r in X.score_documents(docs, model, "key", "body").collect()] == [1]
    labels = spark.createDataFrame([(1, 1, "x")], "doc_id long, toxic int, text string")
    assert X.train(docs, labels, "key", "body")[2] != 0
