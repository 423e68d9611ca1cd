"""Readers for nested basket documents and stage tables."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hamper.functions import expressions as X
from hamper.operators.sampling import SEED, hash_sample
from hamper.session import materialize
from hamper.sinks import snapshots

S, I, L = T.StringType(), T.IntegerType(), T.LongType()

# The raw document layout (field names and types of the source format).
ITEM_SCHEMA = T.StructType([
    T.StructField("track_uri", S), T.StructField("track_name", S), T.StructField("artist_uri", S),
    T.StructField("artist_name", S), T.StructField("album_uri", S), T.StructField("album_name", S),
    T.StructField("duration_ms", I), T.StructField("pos", I),
])
BASKET_SCHEMA = T.StructType([
    T.StructField("pid", L), T.StructField("name", S), T.StructField("collaborative", S),
    T.StructField("modified_at", L), T.StructField("num_albums", I), T.StructField("num_tracks", I),
    T.StructField("num_followers", I), T.StructField("num_edits", I), T.StructField("duration_ms", L),
    T.StructField("num_artists", I), T.StructField("tracks", T.ArrayType(ITEM_SCHEMA)),
    T.StructField("description", S),
])
DOCUMENT_SCHEMA = T.StructType([T.StructField("playlists", T.ArrayType(BASKET_SCHEMA))])

# Request documents (baskets to recommend for) — a root list of requests
# or an object with a "playlists" list of them.
REQUEST_ITEM_SCHEMA = T.StructType([
    T.StructField("track_uri", S), T.StructField("track_name", S), T.StructField("artist_name", S),
])
REQUEST_SCHEMA = T.StructType([
    T.StructField("test_id", S), T.StructField("collaborative", S),
    T.StructField("tracks", T.ArrayType(REQUEST_ITEM_SCHEMA)),
])


def _json(spark: SparkSession, schema: T.StructType, multiline: bool, pattern: str | None):
    reader = spark.read.schema(schema).option("multiLine", multiline).option("mode", "PERMISSIVE")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader


def read_baskets(spark: SparkSession, path: str, pattern: str | None = None, sample: float | None = None,
                 sample_level: str = "file", seed: int = SEED, multiline: bool = True,
                 file_key: Column | None = None) -> DataFrame:
    """One row per basket (all basket fields + ``_file``) from documents ``{"playlists": [...]}``.

    Unknown keys are ignored by the explicit schema; a malformed file parses to a null
    row that the explode drops. ``sample`` keeps a deterministic share of whole files
    (``sample_level="file"``, like sampling documents before the explode) or of baskets
    (``"basket"``, by a hash of the basket id). ``file_key`` replaces the file name as the
    file-level sampling key (a column over ``_metadata``, e.g. a stable part of
    ``_metadata.file_path``). Files left out are not opened.
    """
    docs = _json(spark, DOCUMENT_SCHEMA, multiline, pattern).json(path)
    if sample is not None and sample_level == "file":
        # a condition on the file alone is tested on the listing: other files are not opened
        docs = docs.where(X.hash_keep(sample, seed, F.col("_metadata.file_name") if file_key is None else file_key))
    docs = docs.select("playlists", F.col("_metadata.file_name").alias("_file"))
    baskets = docs.select(F.explode("playlists").alias("_b"), "_file").select("_b.*", "_file")
    if sample is not None and sample_level == "basket":
        baskets = hash_sample(baskets, ["pid"], sample, seed)
    elif sample is not None and sample_level != "file":
        raise ValueError("sample_level must be 'file' or 'basket'")
    return baskets


def numbered_lines(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Lines of text files with their place: _file (name), _doc (number of the line in its file, from 0,
    empty lines counted) and _v (without a closing carriage return).

    Large files are read as several splits. The lines are stored with the start of their split
    and their place in the task, which keeps a split's lines together and in order; the lines
    of a file's earlier splits, a running sum over one row per split, are added.
    """
    reader = spark.read.option("lineSep", "\n")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    lines = materialize(reader.text(path).select(
        F.regexp_replace("value", "\r$", "").alias("_v"), F.col("_metadata.file_name").alias("_file"),
        F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_start"), place.alias("_at")))
    splits = lines.groupBy("_path", "_start").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("_path").orderBy("_start").rowsBetween(Window.unboundedPreceding, -1)
    shift = splits.select("_path", "_start", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"))
    return (lines.join(shift, ["_path", "_start"])
            .select("_file", (F.col("_at") + F.col("_shift")).alias("_doc"), "_v"))


def read_request_baskets(spark: SparkSession, path: str, pattern: str | None = None,
                         multiline: bool = True) -> DataFrame:
    """Requests from documents that are either a root list of requests or an object with a
    ``playlists`` list; both shapes may be mixed.

    A request is identified by its place, ``request_key`` = file, document in the file (0 with
    ``multiline``, else the line) and position in the document, so equal requests, empty ones
    (``{}``) and requests that share a ``test_id`` stay apart and each gets its own output. A
    missing ``test_id`` is named ``unknown_<place>``; missing ``tracks`` become an empty list;
    null list elements and malformed documents are dropped. With ``multiline`` a file is one
    document and read as one text; else files are split and read by line (``numbered_lines``).
    """
    if multiline:
        reader = spark.read
        if pattern:
            reader = reader.option("pathGlobFilter", pattern)
        docs = reader.text(path, wholetext=True).select(
            F.col("_metadata.file_name").alias("_file"), F.lit(0).alias("_doc"), F.col("value").alias("_v"))
    else:
        docs = numbered_lines(spark, path, pattern)
    as_list = F.from_json("_v", T.ArrayType(REQUEST_SCHEMA))
    as_object = F.from_json("_v", T.StructType([T.StructField("playlists", T.ArrayType(REQUEST_SCHEMA))]))["playlists"]
    items = F.when(F.ltrim("_v").startswith("["), as_list).otherwise(as_object)
    rows = docs.select("_file", "_doc", F.posexplode(items).alias("_pos", "_r")).where(F.col("_r").isNotNull())
    place = F.concat_ws(":", "_file", "_doc", "_pos")
    return rows.select(
        place.alias("request_key"),
        F.coalesce(F.col("_r.test_id"), F.concat(F.lit("unknown_"), place)).alias("test_id"),
        F.col("_r.collaborative").alias("collaborative"),
        F.coalesce(F.col("_r.tracks"), F.array().cast(T.ArrayType(REQUEST_ITEM_SCHEMA))).alias("tracks"),
        "_file")


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """A stage table: the current version of a snapshot table, or plain Parquet files."""
    return spark.read.parquet(snapshots.current(spark, path) or path)


def read_with_fallback(spark: SparkSession, primary: str | None, fallback: str) -> tuple[DataFrame, str]:
    """Open ``primary``; if there is none, or nothing at its path, open ``fallback``. Returns the
    frame and the name of the source used. Any other failure to read ``primary`` is raised: a
    damaged table must not silently turn into the fallback."""
    if primary is None:
        return read_table(spark, fallback), "fallback"
    try:
        return read_table(spark, primary), "primary"
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return read_table(spark, fallback), "fallback"
