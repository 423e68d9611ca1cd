"""Streaming Viterbi against the full recurrence; exact round trips."""

import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from conftest import SF001
from hamper.llm import spm as X

PATH = public_tokenizers.path("piece_bpe_32k.model")


def full(p, s):
    """Viterbi over the whole text, ties to the longer last piece."""
    best, back = [0.0] + [None] * len(s), [None] * (len(s) + 1)
    for k in range(1, len(s) + 1):
        for i in range(max(0, k - p.longest), k):
            e = p.table.get(s[i:k])
            got = (best[i] + e[0], e[1]) if e else (best[i] + p.unknown, -1) if k - i == 1 else None
            if got and (best[k] is None or got[0] > best[k]):
                best[k], back[k] = got[0], (i, got[1])
    out, k = [], len(s)
    while k:
        i, piece = back[k]
        out.append(p.fallback(s[i]) if piece < 0 else [piece])
        k = i
    return [x for ids in reversed(out) for x in ids]


def random_pieces(rng, letters):
    found = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 5))) for _ in range(rng.randint(1, 10))}
    return X.Pieces({x: (-float(rng.randint(1, 9)), 1000 + j) for j, x in enumerate(sorted(found))}, list(range(256)))


@pytest.mark.parametrize("seed", range(60))
def test_stream_equals_full_viterbi(seed, monkeypatch):
    rng = random.Random(seed)
    letters = ["a", "ab", "abé"][seed % 3]
    p = random_pieces(rng, letters)
    s = "".join(rng.choice(letters + "c" * (seed % 2)) for _ in range(rng.randint(1, 400)))
    expected = full(p, s)
    monkeypatch.setattr(X, "CACHE_SPANS", 5)
    spans = X.Spans()
    for spans in (None, spans, spans):        # the last time some spans come from the cache
        v, out, step = X.StreamingViterbi(p, spans), b"", rng.randint(1, 30)
        for i in range(0, len(s), step):
            out += v.push(s[i:i + step])
        assert ids_of(out + v.finish()) == expected
    w, out = X.Window(p), b""
    w.TRIM = rng.randint(1, 50)
    for i in range(0, len(s), step):
        out += w.feed(s[i:i + step])
    assert ids_of(out + w.finish()) == expected


def ids_of(data):
    return np.frombuffer(data, "<i4").tolist()


def test_window_stays_bounded():
    """Pieces over every pair of letters: no boundary is forced, the paths have to meet."""
    rng = random.Random(1)
    p = X.Pieces({"a": (-1.0, 1), "b": (-1.0, 2), "ab": (-1.5, 3), "ba": (-1.4, 4), "bb": (-1.2, 5), "aa": (-1.9, 6),
                  "aba": (-1.6, 7), "bab": (-1.7, 8)}, list(range(256)))
    v, n, s = X.StreamingViterbi(p), 0, ""
    for _ in range(500):
        s += (chars := "".join(rng.choice("ab") for _ in range(40)))
        n += len(v.push(chars)) // 4
        assert len(v.window.text) < X.Window.TRIM + 500
    assert n > 7000 and v.window.peak < 400 and v.window.commits > 1000   # 20,000 characters were never held together
    v2 = X.StreamingViterbi(p)
    assert ids_of(v2.push(s) + v2.finish()) == full(p, s)


def test_all_ids_of_the_query_come_from_commits(monkeypatch):
    """Every document of the smallest table: ids as of the whole text's Viterbi, and each of them
    handed out by a commit of the stream or kept from one."""
    committed, real = Counter(), X.Window._commit

    def commit(self, end):
        ids = real(self, end)
        committed[id(self)] += len(ids) // 4
        return ids
    run, kept = X.StreamingViterbi._run, []

    def checked(self, span):
        committed.clear()
        known = span in self.spans.old
        ids = run(self, span)
        assert known or sum(committed.values()) == len(ids) // 4 > 0
        kept.append(span)
        return ids
    monkeypatch.setattr(X.Window, "_commit", commit)
    monkeypatch.setattr(X.StreamingViterbi, "_run", checked)
    e = X.Encoder(X.Pieces.load(PATH))
    texts = [t or "" for t, in duckdb.sql(f"SELECT text FROM '{SF001}/documents.parquet'").fetchall()]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(len(texts))), "text": texts})
    monkeypatch.setitem(X._ENCODERS, PATH, e)
    monkeypatch.setattr(e, "forget", lambda: None)     # the spans are looked at below
    rows = next(X._check_batches(PATH)(iter([batch]))).to_pylist()
    memo = {}
    for r, t in zip(rows, texts):
        chars = X.MARK + t.replace(X.MARK, X.OWN_MARK).replace(" ", X.MARK)
        expected = []
        for w in X.StreamingViterbi.WORDS.findall(chars) if t else []:    # no piece goes over a word's end
            if w not in memo:
                memo[w] = full(e.p, w)
            expected += memo[w]
        assert (r["n_ids"], r["ids_crc32"]) == (len(expected), zlib.crc32(np.array(expected, "<u4").tobytes()))
        assert r["round_trip"]
    assert {*e.spans.young, *e.spans.old} <= {w for t in texts for w in X.StreamingViterbi.WORDS.findall(X.MARK + t.replace(" ", X.MARK))} | set(kept)
    some = [t for t in texts if 0 < len(t) < 1500][:12]
    for t in some:                                                         # and over whole texts
        assert e.encode(t).tolist() == full(e.p, X.MARK + t.replace(" ", X.MARK))


def test_round_trips_and_words():
    e = X.encoder(PATH)
    texts = ["", " ", "  a  b\n c ", "▁x▁ ▁▁", "漢字 é \U0001F600\x00", "a" * 5000, "\n\n\t", "Hello world", "x▁y", " " * 100,
             "word " * 2000 + "z" * 700]
    for t in texts:
        ids = e.encode(t)
        assert e.decode(ids.tolist()) == t
        chars = X.MARK + t.replace(X.MARK, X.OWN_MARK).replace(" ", X.MARK)
        assert ids.tolist() == (full(e.p, chars) if t else [])
    assert e.p.marks_first


def test_dataframes(spark):
    rows = [(1, "Hello  world", "i"), (2, None, "i"), (3, "", None), (3, "", None), (None, "▁ é", "i"), (5, "ab " * 50_000, "i")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    enc = X.encode_documents(docs, PATH, ["doc_id"]).cache()
    back = X.decode_documents(enc, PATH, ["doc_id"])
    assert sorted(map(tuple, back.collect()), key=repr) == sorted(((i, t or "") for i, t, _ in rows), key=repr)
    ids = {r.doc_id: list(r.ids) for r in enc.collect()}
    assert ids[2] == ids[3] == [] and ids[1] == X.encoder(PATH).encode("Hello  world").tolist()
    checked = X.check_documents(docs, PATH).collect()
    assert len(checked) == len(rows) and all(r.round_trip for r in checked)
    assert {r.doc_id: r.n_ids for r in checked} == {k: len(v) for k, v in ids.items()}
    assert X.check_documents(docs.limit(0), PATH).count() == X.encode_documents(docs.limit(0), PATH, ["doc_id"]).count() == 0


def test_kept_spans_stay_small():
    """Both generations of spans, full, take less than 100 MB of a worker (pipeline in the check tool)."""
    import tracemalloc

    from hamper.llm import spm

    tracemalloc.start()
    spans = spm.Spans()
    for n in range(2 * spm.CACHE_SPANS):
        spans.keep(f"\u2581span{n}", n.to_bytes(8, "little"))
    held, _ = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    assert len(spans.young) + len(spans.old) == 2 * spm.CACHE_SPANS and held < 100e6
