"""Helpers shared by the operators: staged tables in the cluster's shared folder, row packing."""

from __future__ import annotations

import contextlib
import ctypes

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hamper.session import scratch_dir

#: White space of the word definition: space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, the folder driver and executors share;
    ``hamper.session.drop_scratch`` removes it with the application's other stored rows."""
    return scratch_dir(spark, f"llm-{name}")


def stage(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage as a reliable checkpoint does (a lost executor costs no recomputation),
    but compressed, with column pruning, and with a size that the planner knows.
    """
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pack(df: DataFrame, **derived: Column) -> DataFrame:
    """The whole row as struct ``row``, beside own derived columns.

    The caller's columns stay inside ``row``, so none of them can clash with ours.
    """
    return df.select(F.struct("*").alias("row"), *(c.alias(k) for k, c in derived.items()))


#: Keys of rows to drop that are sent to every executor at most: about 80 bytes each there.
BROADCAST_KEYS = 2_000_000


def drop_rows(docs: DataFrame, gone: DataFrame, **keys: Column) -> DataFrame:
    """The rows of ``docs`` whose ``keys`` (columns over docs, named as those of ``gone``; null equals
    null) are not in ``gone``. Up to BROADCAST_KEYS of them travel to the rows, which are then not
    shuffled; more are joined by a shuffle."""
    gone = stage(gone.select(*keys).distinct(), "gone")
    small = gone.count() <= BROADCAST_KEYS
    rows = pack(docs, **{f"k_{k}": c for k, c in keys.items()})
    match = None
    for k in keys:
        same = F.col(f"k_{k}").eqNullSafe(F.col(f"g.{k}"))
        match = same if match is None else match & same
    return rows.join((F.broadcast(gone) if small else gone).alias("g"), match, "left_anti").select("row.*")


def word_count(text: Column) -> Column:
    """Number of words (runs without white space); a null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def trim() -> None:
    """Give memory that a Python worker no longer uses back to the machine: workers are kept between
    tasks, so what one task frees would add to what the next one of another kind needs."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):   # not every C library has it
        ctypes.CDLL(None).malloc_trim(0)


def delete_dir(spark: SparkSession, path: str) -> None:
    """Remove a staged folder through Spark's own file system layer."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    jpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jpath, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath))


def pack_gaps(values: np.ndarray) -> bytes:
    """Sorted unsigned numbers as gaps of seven bits a byte, the last byte of a gap above 127."""
    gaps = np.diff(values, prepend=np.uint64(0)).astype(np.uint64)
    size = np.ones(len(gaps), np.int64)
    for k in range(1, 10):
        size += gaps >= np.uint64(1 << (7 * k))
    at = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint8)
    for k in range(int(size.max()) if len(size) else 0):
        has = size > k
        out[at[has] + k] = ((gaps[has] >> np.uint64(7 * k)) & np.uint64(127)).astype(np.uint8)
    out[at + size - 1] |= 128
    return out.tobytes()


def unpack_gaps(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8)
    if not len(raw):
        return np.zeros(0, np.uint64)
    at = np.r_[0, np.flatnonzero(raw >= 128)[:-1] + 1]
    place = np.arange(len(raw)) - np.repeat(at, np.diff(np.r_[at, len(raw)]))
    return np.add.accumulate(np.add.reduceat((raw & 127).astype(np.uint64) << (place * 7).astype(np.uint64), at))


def byte_level_alphabet() -> dict[str, int]:
    """The letters by which byte-level vocabularies write bytes: printable Latin-1 as it is,
    the other bytes from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + k): b for k, b in enumerate(other)}}
