"""Mixing sources to target weights by Efraimidis-Spirakis sampling (DataFrame functions only).

Each source gets a word budget. Whole epochs of the source come first; the rest of the
budget is a weighted sample without replacement: every document draws the exponential key
``-ln(u) / weight`` (u from a hash of its id and text, so reruns agree) and the smallest
keys are taken until the budget is full.

A hot source is never sorted as a whole. Keys fall into ranges by a monotone map; word
totals per (source, range) are summed first, then prefix-summed, which names the one range
per source in which the budget ends. All ranges below are taken, all above are not, and
only the rows of that one range are taken in key order, each document that still fits.

Weights other than 1 crowd keys into the first or the last range, so that one range may hold
much of a source. Its rows are numbered in key order by ``ordered_rank`` and cut into steps of
``RANGE_DOCS`` rows; step totals and running sums inside the steps give the first document
that no longer fits. Of the documents behind it only the first ``room // size`` of each size can
still be taken, which leaves a list bounded by the length of that one document (about
``room * ln(room)`` entries), however many rows the range holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hamper.llm.common import pack, stage
from hamper.operators.ordering import ordered_rank

WEIGHTS = (5.0, 2.0, 1.0)   # of the sources in code point order, repeating
MAX_EPOCHS = 3              # a target is at most this many times its source
RANGE_DOCS = 128            # mean number of documents in a key range at weight 1; rows of a step
SEED = 20_011


def exponential_key(doc_id: Column, text_hash: Column, weight: Column) -> Column:
    """``-ln(u) / weight``; the smaller, the earlier the document is taken."""
    h = F.shiftrightunsigned(F.xxhash64(F.lit(SEED), doc_id, text_hash), 11)
    u = (h.cast("double") + 0.5) / float(1 << 53)
    return -F.log(u) / weight


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = 1.0,
                   cap: float = MAX_EPOCHS) -> DataFrame:
    """Word targets by source: ``sizes`` (source, source_size, ...) plus target double.

    Targets share ``share`` of all words by weight; none exceeds ``cap`` times its source, and
    what is cut is shared again by weight among the others. That fixed point is
    ``min(cap * size, level * weight)`` for the one level at which the targets use up the
    total, found by a running sum over the sources ordered by ``cap * size / weight``. One
    row per source, so the ordering windows stay small.
    """
    order = Window.orderBy(F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    turn = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights))).cast("int")
    s = sizes.withColumn("w", F.element_at(F.array(*map(F.lit, weights)), turn + 1))
    s = s.withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    s = s.withColumn("total", F.lit(float(share)) * F.sum("source_size").over(everything))
    by_level = Window.orderBy(F.col("most") / F.col("w"), F.col("source").asc_nulls_last())
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_level.rowsBetween(0, Window.unboundedFollowing)
    left = F.col("total") - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    s = s.withColumn("capped", F.col("most") * F.sum("w").over(onward) <= left * F.col("w"))
    used = F.sum(F.when(F.col("capped"), F.col("most")).otherwise(0.0)).over(everything)
    open_w = F.sum(F.when(F.col("capped"), 0.0).otherwise(F.col("w"))).over(everything)
    level = (F.col("total") - used) / F.when(open_w > 0, open_w)
    target = F.when(F.col("capped"), F.col("most")).otherwise(F.least(F.col("most"), level * F.col("w")))
    return s.withColumn("target", target).drop("w", "most", "total", "capped")


def taken_in_order(rows: DataFrame) -> DataFrame:
    """What fits when each source's rows are taken in order ``n``, each that still fits.

    ``rows``: source, n (1, 2, ...), size, room (of the source). Returns source, stop and last: taken are the
    rows before ``stop``, the first that does not fit, and behind it those with ``n <= last[size]``
    (when a size no longer fits, it never fits again). A source whose rows all fit is left out.
    """
    rows = stage(rows.withColumn("step", F.floor((F.col("n") - 1) / RANGE_DOCS)), "mix-steps")
    same = F.col("r.source").eqNullSafe(F.col("s.source"))
    earlier = Window.partitionBy("source").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    steps = (rows.groupBy("source", "step").agg(F.sum("size").alias("words"), F.first("room").alias("room"))
             .withColumn("room", F.col("room") - F.coalesce(F.sum("words").over(earlier), F.lit(0))))
    # the one step per source in which the room ends: its rows alone are summed one by one
    ends = steps.where("words > room").groupBy("source").agg(F.min(F.struct("step", "room")).alias("e"))
    here = (rows.alias("r").join(F.broadcast(ends.alias("s")), same & (F.col("r.step") == F.col("s.e.step")))
            .select("r.source", "r.n", "r.size", (F.col("s.e.room") - F.sum("r.size").over(
                Window.partitionBy("r.source").orderBy("r.n")) + F.col("r.size")).alias("room")))
    stops = stage(here.where("size > room").groupBy("source").agg(F.min(F.struct("n", "room")).alias("e"))
                  .select("source", F.col("e.n").alias("stop"), F.col("e.room").alias("room")), "mix-stops")
    behind = (rows.alias("r").join(F.broadcast(stops.alias("s")), same & (F.col("r.n") > F.col("s.stop")))
              .where("r.size > 0 and r.size <= s.room").select("r.source", "r.n", "r.size", "r.step", "s.room"))
    # of a size only the first room // size rows; whole steps are left out by their counts
    sized = Window.partitionBy("source", "size").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)
    per_step = (behind.groupBy("source", "size", "step", "room")
                .agg(F.sort_array(F.collect_list("n")).alias("ns"), F.count("*").alias("k"))
                .withColumn("most", F.floor(F.col("room") / F.col("size")) - F.coalesce(F.sum("k").over(sized), F.lit(0)))
                .where("most > 0"))
    able = per_step.select("source", "size", F.explode(F.slice("ns", F.lit(1), F.col("most").cast("int"))).alias("n"))
    lists = able.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("n", "size"))).alias("able"))
    start = F.struct(F.col("room").alias("left"),
                     F.expr("cast(array() as array<struct<size:bigint,n:bigint>>)").alias("last"))

    def turn(acc: Column, x: Column) -> Column:
        fits = x["size"] <= acc["left"]
        last = F.concat(F.filter(acc["last"], lambda e: e["size"] != x["size"]),
                        F.array(F.struct(x["size"].alias("size"), x["n"].alias("n"))))
        return F.struct(F.when(fits, acc["left"] - x["size"]).otherwise(acc["left"]).alias("left"),
                        F.when(fits, last).otherwise(acc["last"]).alias("last"))
    found = stops.alias("s").join(lists.alias("r"), same, "left").select(
        "s.source", "s.stop", "s.room", F.coalesce("r.able", F.expr("cast(array() as array<struct<n:bigint,size:bigint>>)")).alias("able"))
    return stage(found.select("source", "stop", F.map_from_entries(F.aggregate("able", start, turn, lambda a: a["last"]))
                              .alias("last")), "mix-taken")


def mix(docs: DataFrame, size: Column, weight: Column, id_col: str = "doc_id", source_col: str = "source",
        text_hash: Column | None = None, **shares) -> DataFrame:
    """Every row of ``docs`` with how often the mix takes it.

    Returns row struct (the input row), doc_id, source, size, source_size, target, copies
    (0 to ``cap``) and taken = copies * size. A source's taken words miss its target by less
    than the smallest document left over in the range where its budget ends.

    Defined cases: a null source is a source of its own, last in order; a null text has size 0
    and a document without words is never taken; a null, zero or negative weight counts as 1;
    rows that repeat are separate documents with equal keys, taken in turn; a very long document
    is taken whole or not, and is what the list of later candidates is bounded by; the caller's
    columns stay in ``row``, whatever their names; an empty table gives an empty result.
    """
    good = F.coalesce(F.when(weight > 0, weight.cast("double")), F.lit(1.0))
    key = exponential_key(F.col(id_col), F.lit(0) if text_hash is None else text_hash, good)
    rows = pack(docs, doc_id=F.col(id_col), source=F.col(source_col), size=F.coalesce(size, F.lit(0)).cast("long"),
                key=key)
    light = stage(rows.select("source", "size", "key"), "mix")
    sizes = light.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    per_source = source_targets(sizes, **shares).select(
        "source", "source_size", "target",
        F.greatest(F.lit(1), F.floor(F.col("n_docs") / RANGE_DOCS)).cast("long").alias("n_ranges"),
        F.coalesce(F.floor(F.col("target") / F.when(F.col("source_size") > 0, F.col("source_size"))), F.lit(0))
        .cast("long").alias("epochs"))
    per_source = stage(per_source.withColumn("rest", F.col("target") - F.col("epochs") * F.col("source_size")),
                       "mix-targets")

    def with_range(df: DataFrame, info: DataFrame) -> DataFrame:
        joined = df.alias("d").join(info.alias("s"), F.col("d.source").eqNullSafe(F.col("s.source")), "left")
        mapped = F.lit(1.0) - F.exp(-F.col("d.key"))
        at = F.least(F.floor(mapped * F.col("s.n_ranges")), F.col("s.n_ranges") - 1).cast("long")
        return joined.select("d.*", *(f"s.{c}" for c in info.columns if c != "source"), at.alias("at"))

    # where each source's budget ends: prefix sums over range totals, not over documents
    ranges = (with_range(light, per_source).groupBy("source", "at")
              .agg(F.sum("size").alias("words"), F.first("rest").alias("rest")))
    upto = Window.partitionBy("source").orderBy("at")
    ends = (ranges.select("source", "at", "rest", "words", F.sum("words").over(upto).alias("upto"))
            .where("upto > rest").groupBy("source")
            .agg(F.min(F.struct("at", (F.col("rest") - F.col("upto") + F.col("words")).alias("gap"))).alias("e")))
    plan = stage(per_source.alias("p").join(ends.alias("e"), F.col("p.source").eqNullSafe(F.col("e.source")), "left")
                 .select("p.*", F.coalesce("e.e.at", F.col("n_ranges")).alias("end_at"),
                         F.coalesce("e.e.gap", F.lit(0.0)).alias("gap")), "mix-plan")

    placed = with_range(rows, plan)
    kept = ["row", "doc_id", "source", "size", "source_size", "target", "epochs"]
    whole = placed.where("at <> end_at").select(*kept, (F.col("at") < F.col("end_at")).cast("long").alias("extra"))
    ranked = ordered_rank(placed.where("at = end_at").select(*kept, "key", F.floor("gap").alias("room")),
                          ["source"], ["key", "doc_id", "size"], rank_col="n")
    taken = taken_in_order(ranked.select("source", "n", "size", "room"))
    extra = (F.col("c.n") < F.col("t.stop")) | (F.col("c.n") <= F.coalesce(F.col("t.last")[F.col("c.size")], F.lit(0)))
    cut = (ranked.alias("c").join(taken.alias("t"), F.col("c.source").eqNullSafe(F.col("t.source")), "left")
           .select(*(f"c.{c}" for c in kept), F.coalesce(extra, F.lit(True)).cast("long").alias("extra")))
    copies = F.when(F.col("size") > 0, F.col("epochs") + F.col("extra")).otherwise(0).cast("int")
    return (whole.unionByName(cut)
            .select("row", "doc_id", "source", "size", "source_size", "target", copies.alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken")))


def repeat_rows(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row of ``mix``'s result as often as it is taken, input columns only."""
    return (mixed.where("copies > 0")
            .select("row", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")).select("row.*"))


#: ASCII signs that prose seldom holds (fixed value); their share lowers a document's weight.
SIGNS = "#$%&*+/<=>@[\\]^_`{|}~"


def quality_weight(text: Column) -> Column:
    """1 for plain prose, falling with the share of signs in the text to 0.1 (share 0.18 and more)."""
    plain = F.length(F.translate(text, SIGNS, ""))
    share = F.lit(1.0) - plain / F.when(F.length(text) > 0, F.length(text))
    return F.greatest(F.lit(0.1), F.lit(1.0) - F.lit(5.0) * F.coalesce(share, F.lit(0.0)))
