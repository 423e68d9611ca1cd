"""Licence scans: base places against brute force; notices by position; odd rows."""

import random

import pytest

from conftest import SF001, SF01
from hamper.llm import licenses as X

PHRASES = [(p.split(), label) for p, label in X.BASE]
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words(text):
    import re
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(WORD, lower)


def base(text):
    w = words(text)
    places = sorted((i, label) for p, label in PHRASES for i in range(len(w)) if w[i:i + len(p)] == p)
    at = [i for i, _ in places]
    return (len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places})))


TEXTS = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.", "Licensed under CC BY-NC 4.0", None, "",
         "under the mit under the mit license cc by nc cc by nc", "under-the/MIT*license", "under the mité license", "CC\nBY\x00NC",
         "mit " * 50_000 + "under the mit license", "apache license version 22", "license version 2 apache license version 2", "É ÀB c",
         "This work is licensed under the GNU General Public License, version 3."]


def scan(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    return X.scan_licenses(df).collect()


def test_base_places_match_brute_force(spark):
    rng = random.Random(3)
    vocab = "under the mit license apache version 2 cc by nc gnu x y".split()
    rows = list(enumerate(TEXTS)) + [(i, " ".join(rng.choice(vocab) for _ in range(rng.randint(1, 400)))) for i in range(100, 160)]
    rows += [(0, TEXTS[0]), (None, TEXTS[1])]
    got = scan(spark, rows)
    assert sorted(((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got), key=repr) == \
        sorted(((i, *base(t)) for i, t in rows), key=repr)
    for r in got:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(",")))
        assert 0 <= r.score <= 1 and (r.score == 1 or not r.n_base)


def test_notices_by_position(spark):
    texts = {label + str(n): t for n, (label, t, _) in enumerate(X.TEMPLATES)}
    rows = [(n, "intro words " + t.upper() + " tail") for n, t in enumerate(texts.values())]
    edited = [(100 + n, " ".join(["blah"] * 7 + t.split()[:5] + ["EDIT"] + t.split()[6:])) for n, t in enumerate(texts.values())]
    clean = [(200, "the house of the public under general terms license of work " * 30), (201, "licensed under a friendly licence")]
    got = {r.doc_id: r for r in scan(spark, rows + edited + clean)}
    for n, (label, t, _) in enumerate(X.TEMPLATES):
        assert label in got[n].labels.split(",")
        m = [x for x in got[n].matches if x.label == label][0]
        assert m.start == 2 and m.end == 2 + len(t.split()) and m.coverage == pytest.approx(1.0)
        if t.split()[5] not in " ".join(k for k in X.TEMPLATES[n][2]).split():
            assert label in got[100 + n].labels.split(",")
    assert got[200].labels == got[201].labels == "" and got[200].score == 0


def test_document_frequency_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "MIT mit"), (2, "mit the"), (3, None)], "doc_id long, text string")
    found, n = X.document_frequency(docs, [b"mit", b"the", b"gnu"])
    assert (found, n) == ({b"mit": 2, b"the": 1}, 3)
    assert scan(spark, []) == []


def brute_notices(index, text):
    """All labels and the score, trying every template at every start."""
    w = [x.encode() for x in words(text)]
    found = []
    for e, (label, template, keys, exact) in enumerate(index.entries):
        for start in range(1 - len(template), len(w)):
            share = index.coverage(e, w, start)
            near = w[max(0, start - X.SLACK):max(0, start + len(template) + X.SLACK)]
            if exact and start >= 0 and w[start:start + len(template)] == template:
                found.append((label, 1.0))
            elif not exact and share >= X.MIN_COVERAGE and all(X._stands(k, near) for k in keys):
                found.append((label, share))
    return ",".join(sorted({x for x, _ in found})), max((s for _, s in found), default=0.0)


def without_rarest(index, label, n):
    """A notice whose n rarest words outside the key phrases are replaced."""
    _, template, keys, _ = next(e for e in index.entries if e[0] == label and not e[3])
    kept = {w for k in keys for w in k}
    rare = sorted(set(template) - kept, key=lambda w: (-index.idf[w], w))[:n]
    return " ".join("other" if w in rare else w.decode() for w in template)


def test_labels_equal_a_try_of_every_start(spark):
    """The documents of the smallest table, notices with their rarest words replaced, and mixtures."""
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    frequency, n = X.document_frequency(docs, X.vocabulary())
    index = X.Index(X.BASE, X.TEMPLATES, frequency, n)
    rng, texts = random.Random(11), [r.text for r in docs.collect()]
    labels = [t[0] for t in X.TEMPLATES]
    texts += [without_rarest(index, label, k) for label in labels for k in (1, 2, 4, 6, 9)]
    for _ in range(80):                                        # words lost at random, up to half
        _, t, _ = rng.choice(X.TEMPLATES)
        lost = rng.uniform(0, 0.5)
        texts.append("go " * rng.randint(0, 3) + " ".join("qq" if rng.random() < lost else w for w in t.split()) + " end")
    found = 0
    for text in texts:
        w = [x.encode() for x in words(text)]
        places, notices = index.scan(w)
        got = ",".join(sorted({x for _, x in places} | {m[2] for m in notices}))
        score = 1.0 if places else max((m[3] for m in notices), default=0.0)
        want, best = brute_notices(index, text)
        assert got == want and score == pytest.approx(best)
        found += bool(notices)
    assert found > 40      # notices there are


def test_notices_without_their_rarest_words_are_found(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "text")
    index = X.Index(X.BASE, X.TEMPLATES, *X.document_frequency(docs, X.vocabulary()))
    for label in ("mit", "apache-2", "gpl"):
        text = without_rarest(index, label, 4)
        assert label in {m[2] for m in index.scan([x.encode() for x in words(text)])[1]}


def test_clashing_columns(spark):
    df = spark.createDataFrame([(1, "under the MIT license", 3, "x")], "key long, body string, n_words int, label string")
    assert [(r.doc_id, r.labels) for r in X.scan_licenses(df, id_col="key", text_col="body").collect()] == [(1, "mit")]
