"""Skew-safe numbering of rows inside groups, and dense ids (DataFrame functions only).

``Window.partitionBy(g).orderBy(o)`` sends every row of one group to one task, and a global
``row_number()`` sends *everything* to one task. Here rows are range-partitioned and sorted
on ``(group, order)``: the range bounds split a hot group over consecutive partitions. The
sorted rows are stored with their partition number and place, so that all passes see the
same partitions whatever happens to executors in between, and bucketed by partition number, so
that the windows over (partition, group) read them back without another shuffle. A group that
crosses partitions is numbered on from one to the next. Only the first and the last group of a
partition can: their rows are counted, and running sums over those counts (two rows a
partition) are added to the numbers inside the partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hamper.session import is_plain_read, materialize, materialize_bucketed

# own column names beside the caller's
_PID, _AT, _BEFORE, _TOTAL, _N, _LOW, _HIGH, _LAST = (
    "__hamper_" + n for n in ("pid", "at", "before", "total", "n", "low", "high", "last"))
_PLACES = (1 << 33) - 1  # monotonically_increasing_id keeps the place in a partition in its low 33 bits


def _named(column: str, side: str = "") -> Column:
    """The column of exactly this name, dots included."""
    quoted = "`" + column.replace("`", "``") + "`"
    return F.col(f"{side}.{quoted}" if side else quoted)


def ordered_rank(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[str | Column],
                 rank_col: str = "rank", size_col: str | None = None,
                 num_partitions: int | None = None) -> DataFrame:
    """``row_number()`` (1-based, long) within ``partition_by`` ordered by ``order_by``.

    Equal to ``row_number() over (partition by g order by o)`` when ``o`` has no ties inside a
    group; with ties the numbers of tied rows are assigned in arbitrary order, as with the
    window. Null and NaN groups are groups of their own, as in a window. With ``size_col`` the
    group's row count is added too. No group is ever held by one task, and all rows are
    shuffled once.

    The sorted rows are stored, and so is the input unless it is a plain read of files (the
    range bounds are sampled from it); both live in the session's scratch folder until
    ``drop_scratch``. ``num_partitions`` defaults to the session's shuffle partitions.
    """
    groups = [_named(c) for c in partition_by]
    keys = groups + [_named(c) if isinstance(c, str) else c for c in order_by]
    stored = df if is_plain_read(df) else materialize(df)
    ranged = stored.repartitionByRange(num_partitions, *keys) if num_partitions else stored.repartitionByRange(*keys)
    placed = materialize_bucketed(
        ranged.sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id())
        .withColumn(_AT, F.monotonically_increasing_id().bitwiseAND(F.lit(_PLACES))), _PID, num_partitions)

    counts = placed.groupBy(_PID, *groups).agg(F.count(F.lit(1)).alias(_N), F.min(_AT).alias(_LOW), F.max(_AT).alias(_HIGH))
    last = F.max(_HIGH).over(Window.partitionBy(_PID)).alias(_LAST)  # where the rows already are
    edges = counts.select("*", last).where((F.col(_LOW) == 0) | (F.col(_HIGH) == F.col(_LAST)))
    group = Window.partitionBy(*groups)
    earlier = group.orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    spans = edges.select(_PID, *groups, F.coalesce(F.sum(_N).over(earlier), F.lit(0)).alias(_BEFORE),
                         F.sum(_N).over(group).alias(_TOTAL), _N)
    # at most two rows per range partition, so broadcast is safe
    crossing = materialize(spans.where(F.col(_TOTAL) > F.col(_N)).drop(_N))

    if groups:
        here = Window.partitionBy(_PID, *groups)
        rows = placed.withColumn(_AT, F.row_number().over(here.orderBy(_AT)).cast("long"))
        rows = rows.withColumn(_N, F.count(F.lit(1)).over(here)) if size_col else rows
        at, own = _named(_AT, "r"), _named(_N, "r") if size_col else None
    else:
        rows, at = placed, _named(_AT, "r") + 1
        own = placed.select(F.count(F.lit(1))).scalar() if size_col else None
    match = _named(_PID, "r") == _named(_PID, "c")
    for c in partition_by:
        match = match & _named(c, "r").eqNullSafe(_named(c, "c"))
    joined = rows.alias("r").join(F.broadcast(crossing.alias("c")), match, "left")
    out = [_named(c, "r") for c in df.columns]
    out.append((at + F.coalesce(_named(_BEFORE, "c"), F.lit(0))).alias(rank_col))
    if size_col:
        out.append(F.coalesce(_named(_TOTAL, "c"), own).cast("long").alias(size_col))
    return joined.select(*out)


def dense_index(df: DataFrame, key: str, out: str, num_partitions: int | None = None,
                as_int: bool = True) -> DataFrame:
    """Dense 0-based id over the distinct non-null values of ``key``, in ``key`` order.

    Equal to ``row_number() over (order by key) - 1`` on ``select distinct key``, but the
    numbering is spread over range partitions instead of one task. Null keys get no id
    (the caller drops and counts them). ``as_int`` keeps ids in the int range ALS needs.
    """
    keys = df.select(key).where(F.col(key).isNotNull()).distinct()
    ranked = ordered_rank(keys, [], [key], rank_col="_rn", num_partitions=num_partitions)
    idx = F.col("_rn") - 1
    if as_int:
        idx = F.when(idx <= F.lit(2**31 - 1), idx).otherwise(F.raise_error(F.lit("dense id exceeds int"))).cast("int")
    return ranked.select(key, idx.alias(out))
