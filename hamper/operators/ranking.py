"""Candidate ranking: global candidate order, blending, top-k of unseen items."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hamper.operators.ordering import ordered_rank
from hamper.session import materialize

# Fixed values (reference semantics): list length, blend weights, candidate cap.
TOP_K = 100
MODEL_WEIGHT, POPULARITY_WEIGHT = 0.7, 0.3
REFERENCE_CANDIDATES = 10_000

# Candidate slots of one basket are generated in chunks of this many, and chunks are
# spread over tasks, so a basket with a huge seen set is not expanded by one task.
_CHUNK = 4096
# Seen ranks among the first k + NEAR are gathered per basket, up to NEAR of them.
NEAR = 4096
# Rows that a task expands its baskets to.
TASK_ROWS = 2_000_000
# Ranks up to HOT_RANKS * k are wanted by almost every basket; their lookup rows are copied.
HOT_RANKS, SALTS = 4, 32


def top_candidates(scored: DataFrame, item: str = "item", score: str = "popularity_score",
                   n: int | None = None, out: str = "cand_rank") -> DataFrame:
    """Items in order of ``score`` desc, ``item`` asc, numbered 1..N.

    With ``n`` the list is cut to the top ``n`` (``TakeOrderedAndProject``: partial
    top-n per task) and the ≤ n rows are numbered in one task. Without ``n`` every
    item is numbered with the distributed numbering.
    """
    order = [F.col(score).desc_nulls_last(), F.col(item).asc()]
    if n is not None:
        top = scored.orderBy(*order).limit(int(n))
        return top.withColumn(out, F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    return ordered_rank(scored, [], order, rank_col=out)


def blend(cands: DataFrame, pop: DataFrame, item: str = "item", model_score: str = "model_score",
          pop_score: str = "popularity_score", w_model: float = MODEL_WEIGHT,
          w_pop: float = POPULARITY_WEIGHT, out: str = "final_score") -> DataFrame:
    """``w_model*model + w_pop*popularity``; items without popularity count 0."""
    return (cands.join(pop.select(item, pop_score), item, "left")
            .fillna(0.0, subset=[pop_score])
            .withColumn(out, F.col(model_score) * F.lit(w_model) + F.col(pop_score) * F.lit(w_pop)))


def rank_unseen(cands: DataFrame, seen: DataFrame, basket: str = "basket", item: str = "item",
                score: str = "final_score", k: int = TOP_K, out: str = "rank") -> DataFrame:
    """Drop items already in the basket, then keep the top ``k`` by score (item breaks ties).

    ``row_number() <= k`` becomes a ``WindowGroupLimit``, applied before the shuffle too,
    so a basket is cut to ``k`` rows per task before it is gathered.
    """
    unseen = cands.join(seen.select(basket, item), [basket, item], "left_anti")
    w = Window.partitionBy(basket).orderBy(F.col(score).desc_nulls_last(), F.col(item).asc())
    return unseen.withColumn(out, F.row_number().over(w).cast("bigint")).where(F.col(out) <= F.lit(k))


def rank_slots(reach: DataFrame, basket: str = "basket", reach_col: str = "reach", cand_rank: str = "cand_rank") -> DataFrame:
    """Rows (basket, rank) for the ranks 1 to ``reach`` of each basket, generated in chunks that are
    spread over tasks, so that a basket with a long reach is not expanded by one task."""
    chunks = (reach.select(basket, F.col(reach_col).alias("_reach")).where(F.col("_reach") > 0)
              .select(basket, "_reach",
                      F.explode(F.sequence(F.lit(0).cast("bigint"),
                                           F.floor((F.col("_reach") - 1) / F.lit(_CHUNK)).cast("bigint"))).alias("_c"))
              .repartition(basket, "_c"))
    lo = F.col("_c") * F.lit(_CHUNK) + 1
    hi = F.least((F.col("_c") + 1) * F.lit(_CHUNK), F.col("_reach"))
    return chunks.select(basket, F.explode(F.sequence(lo, hi)).alias(cand_rank))


def at_ranks(asked: DataFrame, ranked: DataFrame, basket: str = "basket", k: int = TOP_K, cand_rank: str = "cand_rank") -> DataFrame:
    """``asked`` (basket, rank, ...) with the columns of ``ranked`` at each rank. Every basket asks for
    the first ranks: each of those is looked up under SALTS keys."""
    hot = F.col(cand_rank) <= F.lit(HOT_RANKS * k)
    salted = asked.withColumn("_salt", F.when(hot, F.pmod(F.xxhash64(basket), F.lit(SALTS))).otherwise(F.lit(0).cast("long")))
    held_at = F.when(hot, F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(
        F.array(F.lit(0).cast("long")))
    return salted.join(ranked.withColumn("_salt", F.explode(held_at)), [cand_rank, "_salt"]).drop("_salt")


def _gathered(rows: DataFrame, basket: str, each: int) -> DataFrame:
    """Stored rows, one a basket, where each will be expanded to about ``each`` rows: gathered by basket in
    tasks of about ``TASK_ROWS`` such rows."""
    least = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return rows.repartition(max(least, -(-rows.count() * each // TASK_ROWS)), basket)


def offer(reach: DataFrame, ranked: DataFrame, frames: Sequence[DataFrame] = (), basket: str = "basket", item: str = "item",
          reach_col: str = "reach", cand_rank: str = "cand_rank") -> tuple[DataFrame, ...]:
    """``ranked`` rows up to the rank ``reach`` for each basket (of stored rows ``reach``, one a basket), and of
    ``frames`` the rows of items that any basket is offered, stored, so that the planner knows how few they are.

    While no basket reaches beyond a chunk, the few ranked rows go to where the baskets are, already gathered
    by basket; else the slots are spread over tasks and looked up under salted keys."""
    longest = int(reach.select(F.max(reach_col)).first()[0] or 0)
    few = materialize(ranked.where(F.col(cand_rank) <= F.lit(longest)))
    if longest > _CHUNK:
        cands = at_ranks(rank_slots(reach, basket, reach_col, cand_rank), few, basket, cand_rank=cand_rank)
    else:
        few = F.broadcast(few)
        slots = _gathered(reach.where(F.col(reach_col) > 0), basket, longest).select(
            basket, F.explode(F.sequence(F.lit(1).cast("bigint"), F.col(reach_col))).alias(cand_rank))
        cands = slots.join(few, cand_rank)
    return cands.drop(cand_rank), *(materialize(df.join(few.select(item), item, "left_semi")) for df in frames)


def _spread_unseen(baskets: DataFrame, seen_ranked: DataFrame, n_cand: int, basket: str, k: int, cand_rank: str,
                   out: str) -> DataFrame:
    """The first ``k`` ranks that each of ``baskets`` has not seen, from rank slots spread over tasks: a basket
    with ``m`` seen ranks needs the first ``k + m``."""
    held = seen_ranked.groupBy(basket).agg(F.count(F.lit(1)).alias("_m"))
    reach = F.least(F.lit(k).cast("bigint") + F.coalesce(F.col("_m"), F.lit(0)), F.lit(n_cand).cast("bigint"))
    slots = rank_slots(baskets.join(held, basket, "left").select(basket, reach.alias("_r")), basket, "_r", cand_rank)
    unseen = slots.join(seen_ranked, [basket, cand_rank], "left_anti")
    w = Window.partitionBy(basket).orderBy(F.col(cand_rank))
    return unseen.withColumn(out, F.row_number().over(w).cast("bigint")).where(F.col(out) <= F.lit(k))


def recommend_popular(baskets: DataFrame, seen: DataFrame, ranked: DataFrame, basket: str = "basket",
                      item: str = "item", k: int = TOP_K, cand_rank: str = "cand_rank",
                      out: str = "rank") -> DataFrame:
    """For every basket, the first ``k`` ranked candidates it does not already hold.

    A basket that has seen ``s`` of the first ``k + NEAR`` ranks, ``s`` at most ``NEAR``, finds its ``k`` among the
    first ``k + s``, however much it holds beyond. So only seen rows of those few items are gathered, as a
    list of at most ``k + NEAR`` ranks a basket, and its ranks leave as one row that is expanded where it is. The
    rest (more than ``NEAR`` of the first ranks seen) goes by rank slots spread over tasks. Exact: no cap on
    candidates. Baskets with no seen items get ``k`` rows; baskets that have seen nearly
    everything get fewer, numbered 1..n.
    """
    cand = materialize(ranked.select(item, cand_rank))  # read by the maximum, the seen join and the lookup
    n_cand = int(cand.select(F.max(cand_rank)).first()[0] or 0)
    first = F.broadcast(cand.where(F.col(cand_rank) <= F.lit(k + NEAR)))   # k + NEAR rows at most
    pairs = seen.select(basket, item).where(F.col(item).isNotNull())
    near = pairs.join(first, item).groupBy(basket).agg(F.collect_set(cand_rank).alias("_near"))
    asked = materialize(baskets.select(basket).distinct().join(near, basket, "left"))
    many = F.coalesce(F.size("_near") > F.lit(NEAR), F.lit(False))
    held = F.coalesce("_near", F.array().cast("array<bigint>"))
    upto = F.least(F.lit(k) + F.size(held), F.lit(n_cand)).cast("bigint")
    ranks = F.when(upto > 0, F.array_except(F.sequence(F.lit(1).cast("bigint"), upto), held))
    w = Window.partitionBy(basket).orderBy(F.col(cand_rank))   # where the rows already are
    top = (_gathered(asked.where(~many), basket, k).select(basket, F.explode(ranks).alias(cand_rank))
           .withColumn(out, F.row_number().over(w).cast("bigint")).where(F.col(out) <= F.lit(k)))
    recs = top.join(first, cand_rank).select(basket, item, out)
    heavy = asked.where(many).select(basket)
    if heavy.isEmpty():
        return recs
    heavy = materialize(heavy)
    seen_ranked = materialize(pairs.join(heavy, basket, "left_semi").join(cand, item).select(basket, cand_rank))
    spread = _spread_unseen(heavy, seen_ranked, n_cand, basket, k, cand_rank, out)
    return recs.unionByName(at_ranks(spread, cand, basket, k, cand_rank).select(basket, item, out))
