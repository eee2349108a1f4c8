"""Sessions of a series, that is runs of ticks with gaps of at most so many seconds."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.operators.blocks import block_window, number_rows, to_blocks
from tickwatch.schema import Layout


def tick_sessions(ticks: DataFrame, gap_seconds: float, layout: Layout = Layout()) -> DataFrame:
    """series, session (from 1), first_ts, last_ts, ticks, lo, hi of every session.

    A tick more than ``gap_seconds`` after the one before begins a session.  Begun sessions are counted
    within blocks of rows, then over the blocks of a series, so neither a hot series nor a session of
    any length comes into one task; parts of a session in several blocks are added up."""
    rows = to_blocks(number_rows(ticks.select("series", "ts", "t_us", "seq", "price"), layout), 1)
    w = block_window()
    gap = F.col("t_us") - F.lag("t_us").over(w)
    rows = rows.withColumn("_begins", F.coalesce(gap > F.lit(int(round(gap_seconds * 1e6))), F.col("rn") == 1).cast("long"))
    rows = rows.where("own").withColumn("_k", F.sum("_begins").over(w))
    parts = rows.groupBy("series", "block", "_k").agg(
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"), F.count(F.lit(1)).alias("ticks"),
        F.min("price").alias("lo"), F.max("price").alias("hi"))
    begun = parts.groupBy("series", "block").agg(F.max("_k").alias("_n"))
    before = Window.partitionBy("series").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    begun = begun.select("series", "block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    return (parts.join(begun, ["series", "block"]).withColumn("session", F.col("_before") + F.col("_k"))
            .groupBy("series", "session").agg(
                F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
                F.sum("ticks").cast("long").alias("ticks"), F.min("lo").alias("lo"), F.max("hi").alias("hi")))
