"""Registered queries: contract columns, and values against SQL or brute force on the small tables."""

import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from oracle_harness import compare, duck
from tokenizers import Tokenizer

from conftest import SF001, SF01
from hamper.llm import queries as Q

TYPES = {
    "op11_prefix_trie": {"conv_id": "bigint", "depth": "bigint", "parent_conv_id": "bigint", "n_convs": "bigint", "n_children": "bigint",
                         "n_leaves": "bigint", "saved_tokens": "bigint", "ends_sha256": "string"},
    "op12_token_alignment": {"doc_id": "bigint", "n_a": "bigint", "n_b": "bigint", "n_groups": "bigint", "n_links": "bigint",
                             "n_best": "bigint", "count_sum": "bigint", "groups_sha256": "string"},
    "op13_substring_dedup": {"doc_id": "bigint", "n_words": "bigint", "n_removed": "bigint", "kept_sha256": "string"},
    "op2_mix_sources": {"doc_id": "bigint", "size": "bigint", "source_size": "bigint", "target": "double", "taken": "bigint"},
    "op3_exact_topk": {"query_id": "bigint", "rank": "int", "vec_id": "bigint", "score": "bigint"},
    "op4_token_files": {"doc_id": "bigint", "start": "bigint", "n_tokens": "bigint", "ids_crc32": "bigint"},
    "op5_toxicity": {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"},
    "op6_bagminhash": {"doc_id": "bigint", "class_id": "bigint", "kept": "boolean"},
    "op7_license_scan": {"doc_id": "bigint", "n_words": "bigint", "n_base": "bigint", "first_word": "bigint", "last_word": "bigint",
                         "base_labels": "string", "labels": "string", "score": "double"},
    "op8_url_rules": {"page_id": "bigint", "host": "string", "path": "string", "rule": "string", "verdict": "string"},
    "op9_exact_dedup": {"doc_id": "bigint", "keep_id": "bigint", "group_size": "bigint", "kept": "boolean", "text_sha256": "string"},
}


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_oracle(spark, name):
    assert compare(spark, SF001, name, Q.QUERIES[name], Q.ORACLE[name], duck(SF001))["status"] == "match"


@pytest.mark.parametrize("name", sorted(TYPES))
def test_contract_types(spark, name):
    """The contract's columns; and no plan holds a Cartesian product or a nested-loop join."""
    df = Q.QUERIES[name](spark, SF001)
    kinds = dict(df.dtypes)
    assert {k: kinds[k] for k in TYPES[name]} == TYPES[name]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_token_files_equal_the_tokenizer(spark):
    got = {r.doc_id: r for r in Q.QUERIES["op4_token_files"](spark, SF001).collect()}
    tok, at = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json")), 0
    for i, text in duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet' ORDER BY 1").fetchall():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        r = got.pop(i)
        assert (r.start, r.n_tokens, r.ids_crc32) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert not got


def test_near_duplicates_equal_all_pairs(spark):
    from test_llm_near import brute

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    got = sorted((tuple(r) for r in Q.QUERIES["op6_bagminhash"](spark, SF001).select("doc_id", "class_id").collect()), key=repr)
    assert got == brute(rows)


def test_licence_base_columns(spark):
    from test_llm_licenses import base

    rows = duckdb.sql(f"SELECT doc_id, text FROM '{SF001}/documents.parquet'").fetchall()
    got = Q.QUERIES["op7_license_scan"](spark, SF001).collect()
    assert sorted((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got) == \
        sorted((i, *base(t)) for i, t in rows)


def test_mix_comes_near_its_targets(spark):
    got = Q.QUERIES["op2_mix_sources"](spark, SF01).collect()
    for s in {r.source for r in got}:
        rows = [r for r in got if r.source == s]
        assert abs(sum(r.taken for r in rows) - rows[0].target) <= min(r["size"] for r in rows if r["size"]) + 0.02 * rows[0].target


def test_sentencepiece_round_trip(spark):
    got = Q.QUERIES["op10_sentencepiece"](spark, SF001).collect()
    assert got and all(r.round_trip for r in got)


def test_toxicity_ranks_held_out_rows(spark):
    got = {r.doc_id: r for r in Q.QUERIES["op5_toxicity"](spark, SF01).collect()}
    rows = duckdb.sql(f"SELECT doc_id, toxic FROM '{SF01}/labels.parquet'").fetchall()
    held = [(got[i].score, y) for i, y in rows if got[i].held_out]
    pairs = [(a > b) + 0.5 * (a == b) for a, y in held if y for b, z in held if not z]
    assert sum(pairs) / len(pairs) > 0.85    # 37 toxic documents to learn from at this size


def test_mix_equals_brute_force(spark):
    """Taken words of every document of the smallest table, by the driver-side version of the same rules."""
    from test_llm_mixing import brute

    from hamper.llm import mixing
    from hamper.llm.common import word_count

    text = F.col("text")
    rows = [tuple(r) for r in spark.read.parquet(f"{SF001}/documents.parquet").select(
        "doc_id", "source", word_count(text), mixing.exponential_key(F.col("doc_id"), F.xxhash64("text"), mixing.quality_weight(text))).collect()]
    copies, _, _ = brute(rows)
    got = {r.doc_id: r.taken for r in Q.QUERIES["op2_mix_sources"](spark, SF001).collect()}
    assert got == {r[0]: c * r[2] for r, c in zip(rows, copies)}
