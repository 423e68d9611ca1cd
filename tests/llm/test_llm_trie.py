"""Prefix trie of conversations against a plain dictionary of prefixes."""

import hashlib
import zlib
from collections import defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF01
from hamper.llm import prefix_trie as T

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def step_digest(role, text):
    return hashlib.sha256(f"{len(role.encode())}:{role}{text}".encode()).digest()[:16]


def brute(rows, share=True):
    turns = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            turns[c].append((turn is not None, turn or 0, step_digest(role, text), (role, text)))
    own = {c: [x[3] for x in sorted(t)] for c, t in turns.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        path = own[c]
        if share and c % 5:
            h = zlib.crc32(str(c).encode()) % 9
            path = own.get(c - c % 5, [])[:h] + path[h:]
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(c)
        ends[tuple(path)].append(c)
    kids, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in members:
        if node:
            kids[node[:-1]] += 1
    for node in members:
        value = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += not kids[node]
            saved[node[:d]] += value
    return sorted(((m[0], len(n), members[n[:-1]][0] if n else None, len(m), kids[n], leaves[n], saved[n],
                    hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest()) for n, m in members.items()), key=repr)


def run(spark, rows, share=True, **sizes):
    c = F.col("conv")
    rebuild = {"base": c - c % 5, "head": F.crc32(c.cast("string").cast("binary")) % 9} if share else {}
    nodes = T.conversation_trie(spark.createDataFrame(rows, SCHEMA), **rebuild, **sizes)
    return sorted((tuple(r) for r in nodes.select(*COLUMNS).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"band": 2, "shard_rows": 30}])
def test_equals_a_dictionary_of_prefixes(spark, sizes):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{SF01}/conversations.parquet' WHERE conv_id < 60").fetchall()
    assert run(spark, rows, **sizes) == brute(rows)


def test_defined_cases(spark):
    rows = [(5, 1, "user", "b"), (5, None, "system", "a"), (5, 1, "user", "b"), (5, 2, None, None), (6, 0, "", ""),
            (6, 9, "x", "é"), (7, 3, "user", "only"), (8, 0, "user", "b"), (None, 0, "user", "b"), (None, None, None, None),
            (11, 0, "user", "no base"), (9, 0, "u", "t"), (9, 0, "u", "t")]
    assert run(spark, rows) == brute(rows)
    assert run(spark, rows, share=False, band=1) == brute(rows, share=False)
    # two steps that would be one string if role and text were simply joined
    assert len(run(spark, [(0, 0, "ab", "c"), (1, 0, "a", "bc")], share=False)) == 3


def test_turnless_conversations_and_empty_table(spark):
    c = next(c for c in range(1, 500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(c, 0, "user", "within the first h turns")]      # no base: the rebuilt conversation has no turn
    assert run(spark, rows) == brute(rows) and run(spark, rows)[0][1:6] == (0, None, 1, 0, 1)
    assert run(spark, []) == []


def test_hot_beginnings_and_long_conversations(spark):
    """A third of all conversations are equal, another third share a first turn, one is very long."""
    rows = [(i, t, "user", f"same {t}") for i in range(0, 150) for t in range(3)]
    rows += [(i, 0, "user", "hello") for i in range(150, 300)] + [(i, 1, "bot", f"r {i % 40}") for i in range(150, 300)]
    rows += [(900, t, "user", f"turn {t % 7}") for t in range(500)] + [(901, t, "user", f"turn {t % 7}") for t in range(300)]
    rows += [(902, t, "user", f"turn {t % 7}") for t in range(256)] + [(903, t, "user", f"turn {t % 7 + (t > 255)}") for t in range(300)]
    expected = brute(rows, share=False)
    assert run(spark, rows, share=False, band=32, shard_rows=64) == expected
    assert run(spark, rows, share=False) == expected


def test_slots_are_minimal_and_verified():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, (5000, 2)).astype(np.uint64), axis=0)
    table = T.SlotTable(keys[:4000])
    slots = table.slots(keys)
    assert sorted(slots[:4000]) == list(range(4000)) and (slots[4000:] == -1).all()
    assert len(T.SlotTable(keys[:0]).slots(keys)) == len(keys)


def test_two_prefixes_with_one_digest_are_refused(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(T, "band_digests", lambda seed, steps, band: [bytes([1]) * 16] * len(steps))
    rows = pa.table({"shard": pa.array([0, 0], pa.int32()), "conv": [1, 2], "depth": [1, 1], "length": [1, 1], "band": [0, 0],
                     "size": [3, 3], "step": [b"a" * 16, b"b" * 16], "seed": pa.array([None, None], pa.binary())})
    with pytest.raises(ValueError):
        T._local(4)(rows)


def test_other_columns(spark):
    rows = spark.createDataFrame([(1, 0, "u", "hi", 5, 6)], "key long, n long, who string, body string, depth long, conv long")
    got = T.conversation_trie(rows, conv_col="key", turn_col="n", role_col="who", text_col="body")
    assert sorted(r.depth for r in got.collect()) == [0, 1]
