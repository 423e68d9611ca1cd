"""Delta-maintained token counts.

A change row is a signed count: +1 row and its tokens for an insert, -1 for a delete, and a
pair (minus the old count, plus the new one) for a revision, which may move a document to
another tokenizer version. A batch of changes is summed by (source, lang, tokenizer) and
committed once under its batch id; totals are the sum of the committed deltas, so they never
need the documents again.

Layout below the root: ``deltas/<batch id>/`` holds one small Parquet table per batch.
Spark's job commit writes its ``_SUCCESS`` marker last; a batch without the marker never
counts and is overwritten by the next attempt, a batch with it is not applied again.
``compact`` folds committed batches into one snapshot that lists the batch ids it contains.
One writer at a time per root.
"""

from __future__ import annotations

from collections.abc import Iterable
from urllib.parse import quote, unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hamper.llm.common import delete_dir, path_exists

KEYS = ("source", "lang", "tokenizer")
SCHEMA = "source string, lang string, tokenizer string, n_docs long, n_tokens long"


def inserts(docs: DataFrame, tokenizer: str, tokens: Column, sign: int = 1) -> DataFrame:
    """Signed change rows for ``docs`` under one tokenizer version; sign -1 deletes.

    A null count is 0 tokens: the document still counts as a document.
    """
    return docs.select("source", "lang", F.lit(tokenizer).alias("tokenizer"), F.lit(sign).cast("long").alias("n_docs"),
                       (F.lit(sign) * F.coalesce(tokens, F.lit(0))).cast("long").alias("n_tokens"))


def deletes(docs: DataFrame, tokenizer: str, tokens: Column) -> DataFrame:
    return inserts(docs, tokenizer, tokens, sign=-1)


def revisions(docs: DataFrame, old: str, old_tokens: Column, new: str, new_tokens: Column) -> DataFrame:
    """Takes back the old count and adds the new one."""
    return deletes(docs, old, old_tokens).unionByName(inserts(docs, new, new_tokens))


class TokenRollup:
    """Totals by source, language and tokenizer version under ``root`` (a folder all nodes share).

    Defined cases: null source or lang is a key of its own; a batch with no rows commits and
    changes nothing; a batch id commits once, however often it is sent; keys whose documents
    and tokens both come to zero leave the totals; counts may turn negative if a delete comes
    without its insert, and the totals show it; rows that repeat count each; texts play no part but
    by the caller's counts, so their length doesn't matter (totals are longs); other columns of
    the changed rows are left out, whatever their names.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, batch: str) -> str:
        return f"{self.root}/deltas/{quote(batch, safe='')}"

    def committed(self, batch: str) -> bool:
        return path_exists(self.spark, f"{self._path(batch)}/_SUCCESS") or batch in self._folded()

    def _list(self, folder: str) -> list[str]:
        """Committed folders below ``folder``."""
        if not path_exists(self.spark, folder):
            return []
        jpath = self.spark._jvm.org.apache.hadoop.fs.Path(folder)
        fs = jpath.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in fs.listStatus(jpath)]
        return sorted(n for n in names if path_exists(self.spark, f"{folder}/{n}/_SUCCESS"))

    def _snapshot(self) -> str | None:
        found = self._list(f"{self.root}/snapshots")
        return f"{self.root}/snapshots/{found[-1]}" if found else None

    def _folded(self) -> set[str]:
        snap = self._snapshot()
        if snap is None:
            return set()
        rows = self.spark.read.schema(SCHEMA + ", batches array<string>").parquet(snap).where("batches is not null")
        return {b for r in rows.collect() for b in r["batches"]}  # one row: the batch ids

    def commit(self, batch: str, changes: DataFrame) -> bool:
        """Apply a batch; False if it had been applied before."""
        if self.committed(batch):
            return False
        delta = changes.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        delta.write.mode("overwrite").parquet(self._path(batch))
        return True

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens over all committed batches."""
        snap, folded = self._snapshot(), self._folded()
        paths = [f"{self.root}/deltas/{n}" for n in self._list(f"{self.root}/deltas") if unquote(n) not in folded]
        paths += [snap] if snap else []
        if not paths:
            return self.spark.createDataFrame([], SCHEMA)
        both = self.spark.read.schema(SCHEMA + ", batches array<string>").parquet(*paths).where("batches is null")
        return (both.groupBy(*KEYS).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
                .where("n_docs <> 0 or n_tokens <> 0"))

    def compact(self) -> None:
        """Fold all committed batches into a new snapshot, then drop what it replaces."""
        old, folded = self._snapshot(), self._folded()
        fresh = [unquote(n) for n in self._list(f"{self.root}/deltas") if unquote(n) not in folded]
        ids = sorted(folded | set(fresh))
        marker = self.spark.range(1).select(
            *(F.lit(None).cast("string").alias(k) for k in KEYS), F.lit(0).cast("long").alias("n_docs"),
            F.lit(0).cast("long").alias("n_tokens"), F.array(*map(F.lit, ids)).cast("array<string>").alias("batches"))
        rows = self.totals().withColumn("batches", F.lit(None).cast("array<string>"))
        number = 1 + (int(old.rsplit("/", 1)[1]) if old else 0)
        rows.unionByName(marker).write.mode("overwrite").parquet(f"{self.root}/snapshots/{number:012d}")
        self._drop([old] if old else [], fresh)

    def _drop(self, snapshots: Iterable[str], batches: Iterable[str]) -> None:
        for path in [*snapshots, *map(self._path, batches)]:
            delete_dir(self.spark, path)
