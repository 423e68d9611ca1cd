"""The pipeline against a brute-force version of each stage; odd and empty documents."""

from collections import Counter, defaultdict

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from test_llm_mixing import brute as brute_mix
from test_llm_near import brute as brute_near

import corpus_pipeline as P
from conftest import SF001
from hamper.llm import mixing, spm, toxicity
from hamper.llm.common import stage, word_count

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stage_names():
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near-duplicates", "mixing sources", "sentencepiece"]


def test_run_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    model = toxicity.train(docs, spark.read.parquet(f"{SF001}/labels.parquet"))
    scorer = toxicity.Scorer(*model)
    rows = duckdb.sql(f"SELECT doc_id, text, lang, source FROM '{SF001}/documents.parquet'").fetchall()
    rows = [r for r in rows if scorer(r[1] or "")[0] < toxicity.THRESHOLD]
    groups = defaultdict(list)
    for r in rows:
        groups[r[1] or ""].append(r[0])
    rows = [r for r in rows if r[0] == max(groups[r[1] or ""])]
    keep = dict(brute_near([r[:2] for r in rows]))
    rows = [r for r in rows if keep[r[0]] == r[0]]
    weights = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").select(
        "doc_id", "source", word_count(F.col("text")).alias("size"),
        mixing.exponential_key(F.col("doc_id"), F.xxhash64("text"), mixing.quality_weight(F.col("text"))).alias("k")).collect()
    copies, _, _ = brute_mix([tuple(r) for r in weights])
    times = {r.doc_id: c for r, c in zip(weights, copies)}
    enc = spm.encoder(public_tokenizers.path("piece_bpe_32k.model"))
    expected = Counter()
    for i, text, lang, source in rows:
        if times[i]:
            expected[(i, lang, source, tuple(enc.encode(text or "").tolist()))] += times[i]
    got = Counter((r.doc_id, r.lang, r.source, tuple(r.ids)) for r in P.run(spark, SF001).collect())
    assert got == expected and len(got) > 50


ODD = [(1, None, "en", "a", None), (2, "", None, None, 0), (3, " \n", "en", "a", 2), (4, "x" * 300_000, "en", "b", 300_000),
       (5, "the same few words here", "en", "a", 5), (6, "the same few words here", "en", "a", 5), (6, "the same few words here", "en", "a", 5),
       (None, "a text without an id", "de", "b", 1), (None, None, None, None, None), (7, "ein anderer Text ▁ " * 9, "de", None, 9)]


@pytest.mark.parametrize("rows", [ODD, []])
def test_stages_on_odd_documents(spark, rows):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for extra in (False, True):
        docs = spark.createDataFrame(rows, schema)
        if extra:  # names that the operators use inside
            docs = docs.selectExpr("*", "1 AS row", "'k' AS key", "2 AS size", "'s' AS gone", "3 AS copies", "0.5 AS score")
        columns = docs.columns
        for n, (name, step) in enumerate(P.STAGES):
            docs = stage(step(spark, docs, SF001), "test")
            if n < len(P.STAGES) - 1:
                assert docs.columns == columns
            if name == "exact dedup" and rows:
                assert Counter(r.doc_id for r in docs.collect()) == {2: 1, 3: 1, 4: 1, 6: 2, None: 1, 7: 1}
        assert docs.columns == ["doc_id", "lang", "source", "ids"]
        assert (docs.count() > 0) == bool(rows)
