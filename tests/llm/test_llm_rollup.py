"""Token rollups: replays, deletes, revisions, half-written batches, compaction."""

from pyspark.sql import functions as F

from hamper.llm import token_rollup as X

SCHEMA = "doc_id long, source string, lang string, n long, m long, tokenizer string"
ROWS = [(1, "a", "en", 5, 3, "own"), (2, "a", "en", 7, 7, "own"), (3, None, None, 4, 4, None), (4, "b", "de", None, 0, "x"),
        (4, "b", "de", None, 0, "x"), (None, "b", "de", 10**12, 1, "x")]


def totals(roll):
    return sorted(map(tuple, roll.totals().collect()), key=repr)


def test_batches_commit_once(spark, tmp_dir):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    roll = X.TokenRollup(spark, f"{tmp_dir}/r")
    assert totals(roll) == []
    assert roll.commit("b/1", X.inserts(docs, "t1", F.col("n"))) is True
    first = sorted([("a", "en", "t1", 2, 12), (None, None, "t1", 1, 4), ("b", "de", "t1", 3, 10**12)], key=repr)
    assert totals(roll) == first
    assert roll.commit("b/1", X.inserts(docs, "t1", F.col("n"))) is False and totals(roll) == first
    roll.commit("2", X.deletes(docs.where("doc_id = 3"), "t1", F.col("n")))
    roll.commit("3", X.revisions(docs.where("doc_id = 1"), "t1", F.col("n"), "t2", F.col("m")))
    roll.commit("4", X.inserts(docs.where("false"), "t1", F.col("n")))
    after = sorted([("a", "en", "t1", 1, 7), ("a", "en", "t2", 1, 3), ("b", "de", "t1", 3, 10**12)], key=repr)
    assert totals(roll) == after
    roll.compact()
    assert totals(roll) == after
    assert roll.commit("3", X.deletes(docs, "t1", F.col("n"))) is False   # folded, still known
    roll.commit("5", X.deletes(docs.where("doc_id = 1"), "t2", F.col("m")))
    roll.compact()
    assert totals(roll) == [r for r in after if r[2] == "t1"]


def test_half_written_batch_does_not_count(spark, tmp_dir):
    docs = spark.createDataFrame(ROWS, SCHEMA)
    roll = X.TokenRollup(spark, f"{tmp_dir}/r")
    X.inserts(docs, "t1", F.col("n")).groupBy(*X.KEYS).agg(
        F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens")).write.option(
        "mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{tmp_dir}/r/deltas/b")
    assert totals(roll) == []
    assert roll.commit("b", X.inserts(docs.where("doc_id = 1"), "t1", F.col("n")))
    assert totals(roll) == [("a", "en", "t1", 1, 5)]
