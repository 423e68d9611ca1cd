"""Bindings of the generic basket model onto the driver's tables.

Each binding yields interactions ``(basket, item, position)``: which column is the
basket, which the item, and the order that defines positions inside a basket.

* CUST  — basket ``o_custkey``, item ``l_partkey``, by order date, order, line, part.
* ORDER — basket ``l_orderkey``, item ``l_partkey``, by line, part.
* SUPP  — basket ``l_suppkey``, item ``l_partkey``, by ship date, order, line, part.
* EVT   — basket ``user_id``, item ``event_type``, by time and event id.
* MIX   — ORDER, CUST and SUPP together with basket id ``3*key + {0, 1, 2}``, so every
  size band is present.

Positions are numbered with the skew-safe :func:`ordered_rank`, so even a customer
holding a third of all lines is numbered by many tasks. Only the needed columns are
read (the Parquet scan prunes the rest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hamper.operators.ordering import ordered_rank


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _positions(df: DataFrame, order: list[str], with_size: bool = False) -> DataFrame:
    """Dense 0-based positions; with ``with_size`` also the basket size from the same pass."""
    ranked = ordered_rank(df, ["basket"], order, rank_col="_rn", size_col="basket_size" if with_size else None)
    cols = ["basket", "item", (F.col("_rn") - 1).cast("int").alias("position")]
    return ranked.select(*cols, "basket_size") if with_size else ranked.select(*cols)


def cust_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    od = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return li.join(od, li.l_orderkey == od.o_orderkey)


def cust_outer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' lines with the gaps kept: a customer without orders has a null item, an order
    of a customer missing from the table a null basket."""
    cu = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("basket"))
    lines = cust_lines(spark, sf_dir).select("o_custkey", F.col("l_partkey").alias("item"))
    return cu.join(lines, cu.basket == lines.o_custkey, "full").select("basket", "item")


def cust(spark: SparkSession, sf_dir: str, with_size: bool = False) -> DataFrame:
    lines = cust_lines(spark, sf_dir).select(F.col("o_custkey").alias("basket"), F.col("l_partkey").alias("item"),
                                             "o_orderdate", "o_orderkey", "l_linenumber")
    return _positions(lines, ["o_orderdate", "o_orderkey", "l_linenumber", "item"], with_size)


def order(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("basket"),
                                                 F.col("l_partkey").alias("item"), "l_linenumber")
    return _positions(li, ["l_linenumber", "item"])


def supp(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("basket"), F.col("l_partkey").alias("item"),
                                                 "l_shipdate", "l_orderkey", "l_linenumber")
    return _positions(li, ["l_shipdate", "l_orderkey", "l_linenumber", "item"])


def evt(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events").select(F.col("user_id").alias("basket"), F.col("event_type").alias("item"),
                                               "ts", "event_id")
    return _positions(ev, ["ts", "event_id"])


def mix_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """MIX without positions (sizes and bands need none): ``basket, item``."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_suppkey", "l_partkey")
    by_order = li.select((F.col("l_orderkey") * 3).alias("basket"), F.col("l_partkey").alias("item"))
    by_supp = li.select((F.col("l_suppkey") * 3 + 2).alias("basket"), F.col("l_partkey").alias("item"))
    by_cust = cust_lines(spark, sf_dir).select((F.col("o_custkey") * 3 + 1).alias("basket"),
                                               F.col("l_partkey").alias("item"))
    return by_order.unionByName(by_cust).unionByName(by_supp)
