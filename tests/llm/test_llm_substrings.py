"""Substring dedup: exact windows against brute force, and the sketch's promises."""

import re

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from conftest import SF01
from hamper.llm import substrings as S

SCHEMA = "doc_id long, text string"


def brute(rows, window=S.WINDOW):
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, words in split:
        for k in range(len(words) - window + 1) if i is not None else ():
            key = tuple(words[k:k + window])
            first[key] = min(first.get(key, i), i)
    out = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1) if i is not None else ():
            if first[tuple(words[k:k + window])] < i:
                gone.update(range(k, k + window))
        out.append((i, len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return sorted(out, key=repr)


def run(spark, rows, **options):
    got = S.remove_repeats(spark.createDataFrame(rows, SCHEMA), **options)
    return sorted((tuple(r) for r in got.drop("spans").collect()), key=repr)


@pytest.mark.parametrize("block_bytes", [1 << 14, S.BLOCK_BYTES])
def test_equals_brute_force_on_the_documents(spark, block_bytes):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF01}/documents.parquet'").fetchall()
    got = run(spark, rows, block_bytes=block_bytes)
    assert got == brute(rows) and sum(r[2] for r in got) > 1000


def test_defined_cases(spark):
    text = " ".join(f"w{k}" for k in range(30))
    other = " ".join(f"v{k}" for k in range(13))
    rows = [(1, None), (2, ""), (3, " \t\r\n"), (5, text), (4, text.replace(" ", "\n \t")), (4, text), (None, text),
            (None, None), (6, "w0 w1 w2"), (7, other + " x " + other), (8, "a " * 200), (-9, "a " * 200), (10, "ü" * 3000),
            (11, "é " + text[:-1] + " "), (12, "tail " + " ".join(text.split()[17:]))]
    got = run(spark, rows, block_bytes=200)
    assert got == brute(rows)
    by_id = {r[0]: r for r in got}
    assert by_id[5][2:] == (30, "") and by_id[7][2] == 0 and by_id[8][2] == 200


def test_other_columns_and_empty_table(spark):
    rows = spark.createDataFrame([(1, "a b", 5, b"x", 7)], "key long, body string, block long, cells binary, doc_id long")
    assert [tuple(r) for r in S.remove_repeats(rows, "key", "body").collect()] == [(1, 2, 0, "a b", [])]
    assert S.remove_repeats(spark.createDataFrame([], SCHEMA)).count() == 0


def test_hot_passage_and_long_text(spark):
    """A passage in a third of all documents, and one text of many blocks' length."""
    hot = " ".join(f"h{k}" for k in range(40))
    rows = [(i, f"p{i} {hot} q{i}" if i % 3 == 0 else f"only {i}") for i in range(600)]
    rows.append((1000, " ".join(f"x{k}" for k in range(60_000)) + " " + hot))
    got = run(spark, rows, block_bytes=1 << 12)
    assert got == brute(rows) and sum(r[2] == 40 for r in got) == 200


def test_spans(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(20)) for c in "ab")
    rows = spark.createDataFrame([(1, a), (2, b), (3, f"x {a} y {b} z")], SCHEMA)
    spans = {r.doc_id: [tuple(s) for s in r.spans] for r in S.remove_repeats(rows).collect()}
    assert spans == {1: [], 2: [], 3: [(1, 21), (22, 42)]}


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(0, 2**60), unique=True), st.integers(1, 400))
def test_gaps_and_estimates(values, spread):
    values = np.sort(np.array(values, np.uint64))
    assert (S.unpack_gaps(S.pack_gaps(values)) == values).all()
    cells = values % np.uint64(spread)
    counts = 1 + (values & np.uint64(1)).astype(np.int64)
    if len(cells):
        true = {c: int(counts[cells == c].sum()) for c in cells}
        assert all(e >= true[c] for c, e in zip(cells, S.estimates(cells, counts)))


def test_texts_are_not_shuffled_for_the_answers(spark):
    """The blocks' table is bucketed by block: only the answers travel."""
    docs = spark.createDataFrame([(i, "a b c " * 20) for i in range(20)], SCHEMA)
    plan = S.remove_repeats(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "text" not in plan.split("Exchange")[1]
