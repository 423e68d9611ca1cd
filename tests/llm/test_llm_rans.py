"""Token files: coder round trips, damage, and equality with whole-text tokenization."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hamper.llm import rans as X

PATH = public_tokenizers.path("word_bpe_49k.json")


def blocks_of(sizes, symbols, seed=1):
    rng = np.random.default_rng(seed)
    return [np.minimum(rng.zipf(1.4, n) - 1, symbols - 1).astype(np.uint16) for n in sizes]


@pytest.mark.parametrize("sizes,symbols", [([0, 1, 31, 32, 33, 8191, 8192, 8193, 40_000], 900), ([5000], 1), ([70_000, 3], 49_000)])
def test_frames_round_trip(sizes, symbols):
    blocks = blocks_of(sizes, symbols)
    counts = np.bincount(np.concatenate(blocks), minlength=symbols)
    freq = X.scale_frequencies(counts)
    assert freq.sum() == 1 << X.PRECISION and ((freq > 0) == (counts > 0)).all()
    table = X.Table(freq)
    frames = X.encode_frames(table, [(b, X.pack_index([7, None], [len(b), 0]), 2, 5) for b in blocks])
    parsed = [X.parse_frame(f, table) for f in frames]
    for b, got in zip(blocks, X.decode_frames(table, parsed)):
        assert np.array_equal(b, got)
    assert [list(p["nulls"]) for p in parsed] == [[0, 1]] * len(blocks)
    alone = X.decode_frames(table, [parsed[-1]])[0]   # any frame decodes by itself
    assert np.array_equal(alone, blocks[-1])
    if symbols == 900:  # close to the entropy
        p = counts[counts > 0] / counts.sum()
        assert len(frames[-1]) * 8 < 1.1 * len(blocks[-1]) * -(p * np.log2(p)).sum() + 8000


def test_damage_is_found():
    block = blocks_of([3000], 50)[0]
    table = X.Table(X.scale_frequencies(np.bincount(block)))
    frame = X.encode_frames(table, [(block, X.pack_index([1], [3000]), 1, 0)])[0]
    for at in (0, len(frame) // 2, len(frame) - 1):
        bad = bytearray(frame)
        bad[at] ^= 1
        with pytest.raises(ValueError):
            X.parse_frame(bytes(bad), table)
    with pytest.raises(ValueError):
        X.parse_frame(frame, X.Table(X.scale_frequencies(np.bincount(block) + 1)))


TEXTS = ["Hello, world! it's  a\ttest.", "", " \n ", None, "The the THE the, the.", "don't 're 's",
         "<|endoftext|> x<|startoftext|>y", "é e\u0301 ÉÀ ñandú 漢字 \U0001F600", "a\u0301 \u0301b", "\x00\x1c\x85\u00a0z", "word " * 40_000,
         "x" * 30_000, "1234 v2.0 ³ ½", "İstanbul ΑΣ ΑΣ. ß"]


def test_chunks_equal_whole_texts():
    whole, chunks = Tokenizer.from_file(PATH), X.ChunkTokenizer(PATH, cache_entries=50)
    rng = random.Random(2)
    texts = [t for t in TEXTS if t] + [" ".join("".join(rng.choice("aBé',.1 \u0301ñ") for _ in range(9)) for _ in range(80)) for _ in range(30)]
    for t in texts:
        assert np.frombuffer(chunks(t.encode()), chunks.dtype).tolist() == whole.encode(t, add_special_tokens=False).ids


def test_files_read_back(spark, tmp_dir):
    rows = [(i * 3, t) for i, t in enumerate(TEXTS)] + [(None, "null id"), (3, "twice"), (3, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    X.write_token_files(docs, PATH, f"{tmp_dir}/f", end_id=1)
    tok = Tokenizer.from_file(PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    expected, at = [], 0
    for d, t in order:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        expected.append((d, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()), ids))
        at += len(ids)
    got = sorted(map(tuple, X.read_token_digests(spark, f"{tmp_dir}/f").collect()), key=lambda r: r[1])
    assert got == [e[:4] for e in expected]
    back = sorted(map(tuple, X.read_token_files(spark, f"{tmp_dir}/f").collect()), key=lambda r: r[1])
    assert [(r[0], r[1], list(r[2])) for r in back] == [(e[0], e[1], e[4]) for e in expected]


def test_empty_table(spark, tmp_dir):
    X.write_token_files(spark.createDataFrame([], "doc_id long, text string"), PATH, f"{tmp_dir}/f")
    assert X.read_token_digests(spark, f"{tmp_dir}/f").count() == 0


def test_many_texts_at_a_time_and_the_end_id():
    whole, chunks = Tokenizer.from_file(PATH), X.ChunkTokenizer(PATH, cache_entries=30)
    texts = [t or "" for t in TEXTS]
    for some in (texts, texts[::-1], [""], ["", "", "a"], texts[:1]):
        ids, counts = chunks.encode_texts([t.encode() for t in some], (1).to_bytes(2, "little"))
        expected = [[*whole.encode(t, add_special_tokens=False).ids, 1] for t in some]
        assert counts.tolist() == list(map(len, expected)) and ids.tolist() == sum(expected, [])
    assert len(chunks.cache) <= 30


def test_a_document_of_three_million_ids_beside_others(spark, tmp_dir):
    rows = [(i, f"some words {i} " * 400) for i in range(200)] + [(50_000, "the cat " * 1_500_000), (50_001, "end")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    X.write_token_files(docs, PATH, f"{tmp_dir}/f")
    tok, got = Tokenizer.from_file(PATH), {r.doc_id: r for r in X.read_token_digests(spark, f"{tmp_dir}/f").collect()}
    cat = tok.encode("the cat", add_special_tokens=False).ids
    assert got[50_000].n_tokens == 3_000_001
    assert got[50_000].ids_crc32 == zlib.crc32(np.array(cat * 1_500_000 + [1], "<u4").tobytes())
    assert got[50_001].start == got[50_000].start + 3_000_001 and len(got) == 202


def test_long_blocks_are_coded_by_themselves(monkeypatch):
    """What the coder's arrays hold is bounded by the longest block times the blocks of a group."""
    import pyarrow as pa

    groups, real = [], X.encode_frames
    monkeypatch.setattr(X, "encode_frames", lambda table, blocks: groups.append([len(b[0]) for b in blocks]) or real(table, blocks))
    sizes = [X.BLOCK_IDS] * 40 + [40 * X.BLOCK_IDS] + [X.BLOCK_IDS] * 5
    rows = {"shard": [0] * 46, "block": list(range(46)), "n_ids": sizes, "doc_ids": [[1]] * 46, "lengths": [[n] for n in sizes],
            "ids": [bytes(2 * n) for n in sizes], "position": [0] * 46}
    freq = X.scale_frequencies(np.array([5]))
    frames = [f for b in X._encode_blocks(freq, 2)([pa.RecordBatch.from_pydict(rows)]) for f in b["frame"].to_pylist()]
    assert len(frames) == 46 and [len(g) for g in groups] == [32, 8, 1, 5]
    assert all(len(g) == 1 or len(g) * max(g) <= 2 * X.GROUP * X.BLOCK_IDS for g in groups)


def test_clashing_columns(spark, tmp_dir):
    docs = spark.createDataFrame([(1, "some text", 5, 6, "x")], "key long, body string, shard int, block int, ids string")
    X.write_token_files(docs, PATH, f"{tmp_dir}/f", id_col="key", text_col="body")
    assert [r.doc_id for r in X.read_token_digests(spark, f"{tmp_dir}/f").collect()] == [1]
