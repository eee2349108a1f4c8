"""Numbering by range partitions: dense numbers and even partitions whatever the times."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwatch.operators.blocks import PLACE_BITS, number_in_order, number_rows, placed
from tickwatch.schema import Layout, events_ticks, orders_ticks

ROWS = 20_000


def _outlier(spark):
    """One series whose last tick lies in the year 9999."""
    far = int(dt.datetime(9999, 1, 1, tzinfo=dt.timezone.utc).timestamp()) * 1_000_000
    return spark.range(ROWS).select(F.lit("s").alias("series"), F.col("id").alias("seq"),
                                    F.when(F.col("id") == ROWS - 1, far).otherwise(F.col("id") * 1000).alias("t_us"))


def _equal_times(spark):
    """One series with all ticks at one time."""
    return spark.range(ROWS).select(F.lit("s").alias("series"), F.col("id").alias("seq"), F.lit(5).cast("long").alias("t_us"))


@pytest.mark.parametrize("probe", [_outlier, _equal_times])
def test_no_partition_above_twice_the_target(spark, probe):
    target = 1000
    at = placed(probe(spark).repartition(7), ["series"], ["t_us", "seq"], ROWS // target)
    sizes = [r["count"] for r in at.groupBy(F.shiftright("_at", PLACE_BITS).alias("p")).count().collect()]
    assert sum(sizes) == ROWS and max(sizes) <= 2 * target
    got = number_rows(probe(spark).repartition(7), Layout(bucket_rows=target)).agg(
        F.min(F.col("rn") - F.col("seq")).alias("lo"), F.max(F.col("rn") - F.col("seq")).alias("hi"),
        F.count_distinct("rn").alias("n"), F.max("_n").alias("size")).first()
    assert tuple(got) == (1, 1, ROWS, ROWS)


@pytest.mark.parametrize("ticks", [events_ticks, orders_ticks])
def test_equals_row_number_over_the_series(spark, ticks):
    from pyspark.sql import Window
    t = ticks(spark, "/root/testdata/sf0.01")
    w = Window.partitionBy("series").orderBy("t_us", "seq")
    want = t.select("series", "seq", F.row_number().over(w).alias("rn"))
    got = number_rows(t, Layout(bucket_rows=700)).select("series", "seq", F.col("rn").cast("int").alias("rn"))
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def test_empty_null_and_repeated_rows(spark):
    rows = [(1, None), (1, 2), (1, 2), (2, 5), (None, 1)]
    df = spark.createDataFrame(rows, "k long, o long")
    got = number_in_order(df, ["k"], ["o"], 3).orderBy("k", "rn").collect()
    assert [(r["k"], r["o"], r["rn"], r["_n"]) for r in got] == [(1, None, 1, 3), (1, 2, 2, 3), (1, 2, 3, 3), (2, 5, 1, 1)]
    assert number_in_order(df.where("k = 9"), ["k"], ["o"], 3).count() == 0


def test_no_window_over_rows(spark):
    """Only the counts pass through windows: the plan sorts no series in one task."""
    df = number_rows(_equal_times(spark), Layout(bucket_rows=1000))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Window") <= 2 and "row_number" not in plan and "Aggregate" in plan
