"""Cross-tokenizer alignment against a plain walk over both token lists."""

import hashlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF001
from hamper.llm import alignment as A

A_PATH, B_PATH = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
ODD = ["<|endoftext|> x", "a<s>b </s> <unk> <0x41>", "▁mark", "two  spaces\n\ttab ", " ", "\x00\x7f", "日本語 ไทย 🙂🙃 é",
       "I'll we've 12345 x's", "  wide", "a" * 3000, "", None]


def brute(rows):
    """Figures of (id, text) rows, token by token, with the tokenizers themselves."""
    ta, tb = Tokenizer.from_file(A_PATH), sentencepiece.SentencePieceProcessor(model_file=B_PATH)
    ta.encode_special_tokens = True
    alphabet = A.byte_level_alphabet()
    done, total = [], Counter()
    for i, text in rows:
        want = (" " + text).encode() if text else b""
        a = [(t, bytes(alphabet[c] for c in ta.id_to_token(t))) for t in ta.encode(" " + text, add_special_tokens=False).ids] if text else []
        b = [(t, bytes((int(tb.id_to_piece(t)[1:-1], 16),)) if tb.is_byte(t) else tb.id_to_piece(t).replace("▁", " ").encode())
             for t in tb.encode(text)] if text else []
        if b"".join(x for _, x in a) != want or b"".join(x for _, x in b) != want:
            a, b = [], []
        links, groups, ga, gb, ia, ib, ea, eb = [], [], [], [], 0, 0, 0, 0
        while ia < len(a):
            links.append((a[ia][0], b[ib][0]))
            na, nb = ea + len(a[ia][1]), eb + len(b[ib][1])
            if na <= nb:
                ga.append(a[ia][0])
                ia, ea = ia + 1, na
            if nb <= na:
                gb.append(b[ib][0])
                ib, eb = ib + 1, nb
            if na == nb:
                groups.append(f"{','.join(map(str, ga))}|{','.join(map(str, gb))}")
                ga, gb = [], []
        total.update(links)
        done.append((i, len(a), len(b), len(groups), links, ";".join(groups)))
    most = Counter()
    for (_, b), n in total.items():
        most[b] = max(most[b], n)
    return sorted(((i, na, nb, ng, len(links), sum(total[x] == most[x[1]] for x in links), sum(total[x] for x in links),
                    hashlib.sha256(g.encode()).hexdigest() if g else "") for i, na, nb, ng, links, g in done), key=repr)


def run(spark, rows, **sizes):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return sorted((tuple(r) for r in A.linked_documents(docs, A_PATH, B_PATH, **sizes).collect()), key=repr)


@pytest.mark.parametrize("sizes", [{}, {"block_bytes": 20_000, "slice_bytes": 3_000, "piece": 7}])
def test_equals_a_walk_over_the_tokens(spark, sizes):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    rows += [(10_000 + k, t) for k, t in enumerate(ODD)] + [(None, "no id"), (None, None), (7, "again"), (7, "again")]
    assert run(spark, rows, **sizes) == brute(rows)


def test_unspelled_texts_have_no_tokens(spark):
    got = {r[0]: r[1:] for r in run(spark, [(1, "▁mark"), (2, None), (3, ""), (4, "ok")])}
    assert got[1] == got[2] == got[3] == (0, 0, 0, 0, 0, 0, "") and got[4][0] > 0


def test_other_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "some words", 3, "x")], "key long, body string, block long, codes string")
    assert A.linked_documents(docs, A_PATH, B_PATH, "key", "body").count() == 1
    assert A.linked_documents(spark.createDataFrame([], "doc_id long, text string"), A_PATH, B_PATH).count() == 0


def test_groups_are_given_as_text(spark):
    docs = spark.createDataFrame([(1, "hello world")], "doc_id long, text string")
    row = A.aligned(docs, A_PATH, B_PATH).where("doc_id = 1").first()
    assert len(row.groups.split(";")) == row.n_groups
    assert hashlib.sha256(row.groups.encode()).hexdigest() == run(spark, [(1, "hello world")])[0][-1]


@settings(max_examples=150, deadline=None)
@given(st.sets(st.integers(1, 80)), st.sets(st.integers(1, 80)), st.integers(1, 9))
def test_pieces_of_any_size_give_one_merge(x, y, piece):
    a, b = np.array(sorted(x | {81})), np.array(sorted(y | {81}))
    i, j = A.split_path(a, b, piece)
    assert (np.diff(i + j)[:-1] == piece).all() and i[-1] == len(a) and j[-1] == len(b)
    la, lb, ga, gb = A.align(a, b, piece)
    ends = sorted({*a, *b})
    assert la.tolist() == [int(np.searchsorted(a, e)) for e in ends]
    assert lb.tolist() == [int(np.searchsorted(b, e)) for e in ends]
    shared = np.array(sorted({*a.tolist()} & {*b.tolist()}))
    assert ga.tolist() == np.searchsorted(shared, a).tolist() and gb.tolist() == np.searchsorted(shared, b).tolist()


def test_long_text_is_many_pieces(spark):
    text = "The quick brown fox, naïve café 12345. " * 30_000
    assert run(spark, [(1, text), (2, "short")]) == brute([(1, text), (2, "short")])
