"""Skew-safe numbering against the window functions it replaces."""

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hamper.operators.ordering import dense_index, ordered_rank


def _data(spark, n=2000):
    # group 0 holds a third of all rows (a hot key), some groups are null
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).when(F.col("id") % 17 == 0, F.lit(None))
        .otherwise(F.col("id") % 53).alias("g"),
        (F.col("id") * 7919 % 2003).alias("o"), F.col("id"), (F.col("id") % 5).cast("string").alias("payload"))


def _same(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.mark.parametrize("parts", [1, 3, 8])
def test_group_rank_and_size_equal_window(spark, parts):
    df = _data(spark)
    got = ordered_rank(df, ["g"], ["o", "id"], size_col="size", num_partitions=parts)
    exp = df.select("*", F.row_number().over(W.partitionBy("g").orderBy("o", "id")).cast("long").alias("rank"),
                    F.count("*").over(W.partitionBy("g")).alias("size"))
    assert got.columns == exp.columns
    assert _same(got, exp)


def test_small_arrow_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        df = _data(spark, 900)
        got = ordered_rank(df, ["g"], ["o", "id"], size_col="size", num_partitions=5)
        exp = df.select("*", F.row_number().over(W.partitionBy("g").orderBy("o", "id")).cast("long").alias("rank"),
                        F.count("*").over(W.partitionBy("g")).alias("size"))
        assert _same(got, exp)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_global_numbering_and_union(spark):
    df = _data(spark, 1000)
    got = ordered_rank(df, [], ["id"], size_col="size", num_partitions=6)
    assert got.where("rank != id + 1 or size != 1000").count() == 0
    # numbering survives being one branch of a union (task ids are renumbered there)
    assert got.unionByName(got).where("rank != id + 1").count() == 0


def test_multi_column_group_and_desc_order(spark):
    df = _data(spark).withColumn("h", F.col("id") % 2)
    got = ordered_rank(df, ["g", "h"], [F.col("o").desc(), F.col("id")], num_partitions=4)
    exp = df.select("*", F.row_number().over(W.partitionBy("g", "h").orderBy(F.col("o").desc(), "id"))
                    .cast("long").alias("rank"))
    assert _same(got, exp)


def test_dense_index_is_ordered_bijection(spark):
    df = _data(spark).select(F.col("o").alias("key"))
    idx = dense_index(df.union(spark.createDataFrame([(None,)], "key long")), "key", "key_idx", num_partitions=5)
    rows = idx.orderBy("key").collect()
    assert [r.key_idx for r in rows] == list(range(len(rows)))
    assert len(rows) == df.distinct().count()  # null key gets no id
    assert dict(idx.dtypes)["key_idx"] == "int"


def test_no_single_partition_exchange(spark):
    df = _data(spark)
    plan = ordered_rank(df, [], ["id"], num_partitions=4)._jdf.queryExecution().executedPlan().toString()
    assert "SinglePartition" not in plan


def _window(df):
    return df.select("*", F.row_number().over(W.partitionBy("g").orderBy("o", "id")).cast("long").alias("rank"),
                     F.count("*").over(W.partitionBy("g")).alias("size"))


@pytest.mark.parametrize("parts", [1, 4])
def test_null_and_huge_ids(spark, parts):
    """Ids beyond 2^53 stay apart when null groups are around."""
    rows = [(g, i % 2, i) for i, g in enumerate([None, 2**53, 2**53 + 1, None, 2**53, 2**53 + 1, -(2**63), 2**63 - 1])]
    df = spark.createDataFrame(rows, "g long, o long, id long")
    assert _same(ordered_rank(df, ["g"], ["o", "id"], size_col="size", num_partitions=parts), _window(df))


@pytest.mark.parametrize("parts", [1, 5])
def test_nan_groups(spark, parts):
    vals = [float("nan"), None, 0.0, -0.0, 1.5, float("inf"), float("nan"), None]
    df = spark.createDataFrame([(v, i % 3, i) for i, v in enumerate(vals * 20)], "g double, o long, id long")
    assert _same(ordered_rank(df, ["g"], ["o", "id"], size_col="size", num_partitions=parts), _window(df))


def test_input_is_evaluated_once(spark):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b
    df = spark.range(1000).select((F.col("id") % 7).alias("g"), F.col("id").alias("o"), "id")
    df = df.mapInArrow(count, df.schema)
    ordered_rank(df, ["g"], ["o", "id"], size_col="size", num_partitions=4).count()
    assert seen.value == 1000


def test_no_python_and_no_driver_rows(spark):
    plan = ordered_rank(_data(spark), ["g"], ["o", "id"], size_col="size")._jdf.queryExecution().executedPlan().toString()
    assert "Arrow" not in plan and "Python" not in plan


from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(sizes=st.lists(st.integers(min_value=1, max_value=40), min_size=1, max_size=12),
       hot=st.integers(min_value=0, max_value=400), parts=st.integers(min_value=1, max_value=9),
       batch=st.integers(min_value=1, max_value=50))
def test_random_groups_property(spark, sizes, hot, parts, batch):
    rows = [(g, (i * 37) % 11, i) for g, n in enumerate(sizes) for i in range(n)]
    rows += [(-1, i % 5, 10_000 + i) for i in range(hot)]  # one hot group
    df = spark.createDataFrame(rows, "g long, o long, id long")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch))
    try:
        got = ordered_rank(df, ["g"], ["o", "id"], size_col="size", num_partitions=parts)
        res = {(r.g, r.id): (r.rank, r.size) for r in got.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    expected = {}
    by_group = {}
    for g, o, i in rows:
        by_group.setdefault(g, []).append((o, i))
    for g, members in by_group.items():
        for r, (o, i) in enumerate(sorted(members), start=1):
            expected[(g, i)] = (r, len(members))
    assert res == expected


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("size", [None, "size"])
def test_rows_are_shuffled_once(spark, size):
    """The stored rows are read back by their buckets: the windows over (partition, group) need no
    exchange. The one shuffle is the range partitioning before the rows were stored."""
    plan = _plan(ordered_rank(_data(spark), ["g"], ["o", "id"], size_col=size))
    rows = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in rows and "Bucketed: true" in rows and rows.count("Window") == (2 if size else 1)
    assert rows.count("Sort") == 1


def test_plain_reads_are_not_stored_first(spark, tmp_dir):
    from hamper import session

    _data(spark).write.parquet(tmp_dir + "/t")
    files = spark.read.parquet(tmp_dir + "/t")
    assert session.is_plain_read(files.where("o > 3").select("g", (F.col("o") + 1).alias("o")))
    assert not session.is_plain_read(files.where(F.rand() < 0.5))
    assert not session.is_plain_read(files.join(files.select("id"), "id")) and not session.is_plain_read(files.distinct())
    assert not session.is_plain_read(_data(spark))
    got = ordered_rank(files, ["g"], ["o", "id"], size_col="size", num_partitions=3)
    assert _same(got, _window(files))


def test_columns_with_dots_and_backticks(spark):
    df = spark.createDataFrame([(i % 3, i, "x") for i in range(30)], "`a.b` long, `o``c` long, `d.e` string")
    got = ordered_rank(df, ["a.b"], ["o`c"], size_col="n", num_partitions=4).collect()
    assert sorted((r["a.b"], r["o`c"], r["rank"], r["n"]) for r in got) == [(i % 3, i, i // 3 + 1, 10) for i in sorted(
        range(30), key=lambda i: (i % 3, i))]


def test_scratch_tables_go_with_the_scratch(spark):
    from hamper import session

    ordered_rank(_data(spark, 50), ["g"], ["o", "id"]).count()
    assert any(t.name.startswith("hamper_rows_") for t in spark.catalog.listTables())
    session.drop_scratch(spark)
    assert not any(t.name.startswith("hamper_rows_") for t in spark.catalog.listTables())
