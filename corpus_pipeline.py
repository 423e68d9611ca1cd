"""A corpus pipeline over ``documents``: five stages, each calling one operator of ``hamper.llm``.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet
and read again as the next stage's docs. All but the last return the columns of documents.
A stage that starts deletes what the stage before it stored for its own work: by then that
one's result is written.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hamper.llm import bagminhash, exact_dedup, mixing, spm, toxicity
from hamper.llm.common import shared_dir, word_count
from hamper.session import drop_folders, recorded_scratch

Step = Callable[[SparkSession, DataFrame, str], DataFrame]
_LEFT: list[str] = []   # folders that the last stage worked with


def _clear(spark: SparkSession) -> None:
    drop_folders(spark, _LEFT)
    _LEFT.clear()


def _stage(step: Step) -> Step:
    @wraps(step)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        _clear(spark)
        with recorded_scratch() as folders:
            result = step(spark, docs, sf_dir)
        _LEFT.extend(folders)
        return result
    return run_stage


@_stage
def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose noisy-or over their sentences reaches the threshold go. A null or empty
    text scores 0 and stays; without labels nothing is learnt and all stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    model = toxicity.train(docs.select("doc_id", "text"), labels)
    return docs.where(toxicity.score_column(model, spark)(F.col("text")) < toxicity.THRESHOLD)


@_stage
def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with identical texts, the one with the largest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates, the document with the smallest doc_id stays."""
    return bagminhash.drop_near_duplicates(docs)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: a document in n copies is n equal rows."""
    text = F.col("text")
    mixed = mixing.mix(docs, word_count(text), mixing.quality_weight(text), text_hash=F.xxhash64(text))
    return mixing.repeat_rows(mixed)


@_stage
def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the SentencePiece ids of the whole text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    return spm.encode_documents(docs, model, ["doc_id", "lang", "source"])


STAGES = [
    ("toxicity", reject_toxic),
    ("exact dedup", drop_copies),
    ("near-duplicates", drop_near_copies),
    ("mixing sources", mix_sources),
    ("sentencepiece", encode),
]

#: The stages that train and encode have no SQL form; tests compare the run with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, step in STAGES:
        path = shared_dir(spark, "pipeline-" + name.replace(" ", "-"))
        step(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        _clear(spark)
        drop_folders(spark, [held] if held else [])   # the input is consumed
        held = path
    return docs
