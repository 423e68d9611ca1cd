"""Incremental ingest of basket documents with Structured Streaming.

Each run picks up the files that arrived since the last one (``trigger(availableNow=True)``
processes everything new and stops) and keys them on their *name*: a name that an earlier
batch has read well is skipped, a file that failed to parse may be delivered again under
the same name.

A micro-batch is known by its stream and its number in that stream. The stream is the id that
Spark keeps in the checkpoint, so a new or a lost checkpoint is another stream and never
meets the batches of an earlier one. A batch writes its baskets to a folder of its own and
then one manifest row per file; only batches with manifest rows count, and a batch that is
run again replaces what it wrote itself, nothing else. Totals are sums over the manifest.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hamper.session import drop_dir, scratch_dir
from hamper.sources.baskets import BASKET_SCHEMA, DOCUMENT_SCHEMA

MANIFEST = "file_name string, ok boolean, baskets long, interactions long, run string, stream string, batch long"
_CORRUPT = "_corrupt_record"
#: Local property under which a streaming query's batches carry the id kept in its checkpoint.
_STREAM_ID = "sql.streaming.queryId"


def _read_folders(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """Rows of the folders ``stream=/batch=`` below ``path``; none before the first batch."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_manifest(spark: SparkSession, dst: str) -> DataFrame:
    """One row per file and batch that read it."""
    return _read_folders(spark, f"{dst}/files", MANIFEST)


def read_ingested(spark: SparkSession, dst: str) -> DataFrame:
    """All ingested baskets with their file name. Folders of batches that the manifest doesn't
    know (an attempt ended between the two writes) are left out."""
    key = [T.StructField("stream", T.StringType()), T.StructField("batch", T.LongType())]
    schema = T.StructType([*BASKET_SCHEMA.fields, T.StructField("_file", T.StringType()), *key])
    committed = read_manifest(spark, dst).select("stream", "batch").distinct()   # prunes the folders
    return _read_folders(spark, f"{dst}/baskets", schema).join(committed, ["stream", "batch"], "left_semi").drop(
        "stream", "batch")


def ingest_increment(spark: SparkSession, src: str, dst: str, checkpoint: str, pattern: str | None = "*.json",
                     max_files: int | None = None, multiline: bool = True) -> DataFrame:
    """Run one increment; returns one row: files, failed, baskets, interactions over all runs,
    and new_files, new_failed, new_baskets, batches of this run. A file fails if any of its
    documents does; its readable baskets are not taken."""
    schema = T.StructType([*DOCUMENT_SCHEMA.fields, T.StructField(_CORRUPT, T.StringType())])
    reader = (spark.readStream.schema(schema).option("multiLine", multiline)
              .option("columnNameOfCorruptRecord", _CORRUPT))
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", int(max_files))
    run = uuid.uuid4().hex

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        stream = session.sparkContext.getLocalProperty(_STREAM_ID)
        place = f"stream={stream}/batch={number}"
        mine = (F.col("stream") == stream) & (F.col("batch") == number)
        known = read_manifest(session, dst).where(F.col("ok") & ~mine).select("file_name")
        # parsed once: the manifest and the baskets both come from the stored documents
        parsed, path = batch.select("playlists", F.col(_CORRUPT).isNull().alias("ok"),
                                    F.col("_metadata.file_name").alias("file_name")), scratch_dir(session, "ingest")
        parsed.join(known.distinct(), "file_name", "left_anti").write.parquet(path)
        docs = session.read.schema(parsed.schema).parquet(path)
        tracks = F.aggregate("playlists", F.lit(0).cast("long"), lambda n, b: n + F.greatest(F.size(b["tracks"]), F.lit(0)))
        files = docs.groupBy("file_name").agg(
            F.bool_and("ok").alias("ok"), F.sum(F.greatest(F.size("playlists"), F.lit(0))).alias("baskets"),
            F.sum(F.coalesce(tracks, F.lit(0))).alias("interactions"))
        counted = F.when(F.col("ok"), 1).otherwise(0)
        good = files.where("ok").select("file_name")
        (docs.join(good, "file_name", "left_semi").select(F.explode("playlists").alias("_b"), F.col("file_name").alias("_file"))
         .select("_b.*", "_file").write.mode("overwrite").parquet(f"{dst}/baskets/{place}"))
        (files.select("file_name", "ok", (F.col("baskets") * counted).alias("baskets"),
                      (F.col("interactions") * counted).alias("interactions"), F.lit(run).alias("run"))
         .write.mode("overwrite").parquet(f"{dst}/files/{place}"))
        drop_dir(session, path)

    query = (reader.json(src).select("*", "_metadata").writeStream.foreachBatch(take)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    query.awaitTermination()
    mine = F.col("run") == run
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint")
    return read_manifest(spark, dst).agg(
        F.count_if("ok").alias("files"), F.count_if(~F.col("ok")).alias("failed"), zero(F.sum("baskets")).alias("baskets"),
        zero(F.sum("interactions")).alias("interactions"), F.count_if(mine & F.col("ok")).alias("new_files"),
        F.count_if(mine & ~F.col("ok")).alias("new_failed"), zero(F.sum(F.when(mine, F.col("baskets")))).alias("new_baskets"),
        F.count_distinct(F.when(mine, F.struct("stream", "batch"))).alias("batches"))
