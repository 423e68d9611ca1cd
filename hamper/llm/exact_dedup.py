"""Exact deduplication by counting quotient filters and byte verification.

1. Each input partition builds a counting quotient filter of its text fingerprints: the
   fingerprint's high half is the quotient, the low half the remainder, kept sorted per
   quotient with a counter. Equal texts of a partition become one counter. Quotients travel as
   gaps, run lengths and counters as single bytes mostly: about nine bytes a fingerprint.
2. The filters are cut by leading quotient bits into segments; the segments of all
   partitions are merged by their sorted remainders, counters added. Quotient and remainder
   together are the whole fingerprint, so merging loses nothing.
3. Fingerprints counted above one send their documents to byte verification: grouping by
   the text itself, with map-side combining, so that a group of copies reaches a reducer as
   one row per map task. All other documents are unique and skip it.

No step holds a group of copies in one task; the only per-task memory is one partition's
fingerprints, or one segment's (the number of segments follows the shuffle partitions).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hamper.llm.common import drop_rows, pack, pack_gaps, stage, unpack_gaps

FILTER_SCHEMA = "segment int, quotients binary, runs binary, remainders binary, counters binary"


def build_filter(fingerprints: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, ...]:
    """Counting quotient filter of unsigned 64-bit fingerprints.

    Returns (quotients, run lengths, remainders, counters): the occupied quotients in order,
    how many remainders each one holds, and the remainders, sorted within each run, with
    their counters.
    """
    order = np.argsort(fingerprints, kind="stable")
    fps = fingerprints[order]
    cnt = np.ones(len(fps), np.int64) if counts is None else counts[order]
    first = np.flatnonzero(np.r_[True, fps[1:] != fps[:-1]]) if len(fps) else np.zeros(0, np.int64)
    fps, cnt = fps[first], np.add.reduceat(cnt, first) if len(first) else cnt
    quotients, runs = np.unique(fps >> np.uint64(32), return_counts=True)
    return quotients.astype(np.uint32), runs.astype(np.uint32), fps.astype(np.uint32), cnt


def filter_items(quotients: np.ndarray, runs: np.ndarray, remainders: np.ndarray) -> np.ndarray:
    """The fingerprints held by a filter."""
    return (np.repeat(quotients, runs).astype(np.uint64) << np.uint64(32)) | remainders


def merge_filters(filters: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """One filter with the counters of all: equal (quotient, remainder) add up."""
    return build_filter(np.concatenate([filter_items(q, r, m) for q, r, m, _ in filters]),
                        np.concatenate([c for *_, c in filters]))


def _partition_filters(bits: int):
    """Filters of one partition, one row per segment (the leading ``bits`` of the quotient)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            got = build_filter(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64))
            held = got if held is None else merge_filters([held, got])
        if held is None or not len(held[0]):
            return
        q, runs, rem, cnt = held
        segment = (q >> np.uint32(32 - bits)).astype(np.int32)
        starts = np.flatnonzero(np.r_[True, segment[1:] != segment[:-1]])
        item_at = np.r_[0, np.cumsum(runs, dtype=np.int64)]
        rows = []
        for a, b in zip(starts, np.r_[starts[1:], len(q)]):
            i, j = item_at[a], item_at[b]
            rows.append((int(segment[a]), pack_gaps(q[a:b].astype(np.uint64)), _pack_counts(runs[a:b]), rem[i:j].tobytes(),
                         _pack_counts(cnt[i:j])))
        cols = list(zip(*rows))
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32())] + [pa.array(c, pa.binary()) for c in cols[1:]],
                                         names=["segment", "quotients", "runs", "remainders", "counters"])
    return run


def _pack_counts(counts: np.ndarray) -> bytes:
    """Counts of one or more, mostly small: a byte each up to 127."""
    return pack_gaps(np.cumsum(counts, dtype=np.uint64))


def _unpack_counts(data: bytes) -> np.ndarray:
    return np.diff(unpack_gaps(data).astype(np.int64), prepend=0)


def _merge_segment(parts: pd.DataFrame) -> pd.DataFrame:
    q, runs, rem, cnt = merge_filters([(unpack_gaps(a).astype(np.uint32), _unpack_counts(b).astype(np.uint32),
                                        np.frombuffer(c, np.uint32), _unpack_counts(d)) for a, b, c, d in zip(
        parts["quotients"], parts["runs"], parts["remainders"], parts["counters"])])
    many = cnt > 1
    return pd.DataFrame({"fp": filter_items(q, runs, rem)[many].view(np.int64), "counted": cnt[many]})


def repeated_fingerprints(fingerprints: DataFrame) -> DataFrame:
    """Fingerprints (first column, long) that occur more than once: fp long, counted long."""
    spark = fingerprints.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    bits = max(4, math.ceil(math.log2(4 * parts)))
    filters = fingerprints.mapInArrow(_partition_filters(bits), FILTER_SCHEMA)
    return filters.groupBy("segment").applyInPandas(_merge_segment, "fp long, counted long")


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its group of byte-identical texts.

    Returns row struct (the input row), doc_id, keep_id (largest id of the group), group_size,
    kept (the row's id is keep_id), text_sha256 (lower-case hex of the UTF-8 bytes), fp (a 64-bit
    hash of the text). The row is carried only if it is asked for.

    Defined cases: a null text is the empty text; texts are compared byte by byte, nothing is
    normalised. Null ids are ignored in keep_id, so it is null only if the whole group has
    none, and then all its rows are kept. Rows that repeat both id and text are one document
    listed twice: each counts in group_size and carries the same kept flag. Texts of any length
    are compared whole. Other columns stay in ``row``, whatever their names. An empty table
    gives an empty result.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    repeated = stage(repeated_fingerprints(docs.select(F.xxhash64(text).alias("fp"))), "cqf")

    # byte verification of the texts behind a fingerprint counted more than once
    suspects = (docs.select(F.col(id_col).alias("doc_id"), text.alias("body"), F.xxhash64(text).alias("fp"))
                .join(repeated.select("fp"), "fp"))
    verified = suspects.groupBy("fp", "body").agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size"))
    by_digest = (verified.select("fp", F.sha2("body", 256).alias("sha"), "keep_id", "group_size")
                 .groupBy("fp", "sha")
                 .agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"),
                      F.count("*").alias("texts"))
                 # two texts with one SHA-256 would need the text in the join below: refuse, don't merge
                 .where(F.when(F.col("texts") > 1, F.raise_error(F.lit("two texts share a SHA-256")).cast("boolean"))
                        .otherwise(F.lit(True)))
                 .select("fp", "sha", "keep_id", "group_size"))
    by_digest = stage(by_digest, "copies")

    rows = pack(docs, doc_id=F.col(id_col), fp=F.xxhash64(text), sha=F.sha2(text, 256))
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return (rows.join(by_digest, ["fp", "sha"], "left")
            .select("row", "doc_id", keep.alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.col("doc_id").eqNullSafe(keep).alias("kept"),
                    F.col("sha").alias("text_sha256"), "fp"))


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The kept rows, with the columns of ``docs``. The rows that go are named by id and text hash (the
    hash parts rows that share an id), so the texts of the others stay where they are."""
    gone = exact_groups(docs, id_col, text_col).where("not kept").select("doc_id", "fp")
    return drop_rows(docs, gone, doc_id=F.col(id_col), fp=F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
