"""Exact quantiles of any number of rows by distributed selection.

A value's rank is found by counting.  An approximate quantile of the range that holds the rank gives a pivot
and a narrow bracket around it; the rows of the range are counted below, inside and above these (five counts a
group), and the part with the rank becomes the next range.  A round leaves a few rows in ten thousand, whatever
the distribution, and always takes the pivot out or ends on it; at most ``KEPT`` values are sorted at the end.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.session import written

#: Relative rank error of the approximate quantiles is at most 1 / ACCURACY.
ACCURACY = 10_000
KEPT = 4096


def exact_quantile(rows: DataFrame, by: str, value: str, q: float, name: str = "quantile") -> DataFrame:
    """``by``, ``name``: the linearly interpolated ``q`` quantile of ``value`` in each group.

    Nulls and NaN don't count; a group without other values has no row.  Eager: a job for each pass.
    ``rows`` is read once a pass, so it should be a table or a checkpoint."""
    x = rows.select(by, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull() & ~F.isnan("_x"))
    h = F.lit(float(q)) * (F.col("_n") - 1)
    state = x.groupBy(by).agg(F.count(F.lit(1)).alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi")) \
        .select(by, h.alias("_h"), F.floor(h).cast("long").alias("_k"), "_lo", "_hi", F.lit(0).cast("long").alias("_below"),
                F.col("_n").alias("_in"))
    state = written(state)
    while not state.where((F.col("_in") > KEPT) & (F.col("_lo") < F.col("_hi"))).isEmpty():
        state = written(_narrowed(x, state, by))
    inside = (F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi"))
    last = x.join(state, by).where(F.col("_x") >= F.col("_lo")).groupBy(by).agg(
        F.max("_h").alias("_h"), F.max("_k").alias("_k"), F.max("_below").alias("_below"), F.max("_in").alias("_in"),
        F.max("_lo").alias("_lo"), F.max("_hi").alias("_hi"),
        F.sort_array(F.collect_list(F.when(inside & (F.col("_lo") < F.col("_hi")), F.col("_x")))).alias("_list"),
        F.min(F.when(F.col("_x") > F.col("_hi"), F.col("_x"))).alias("_next"))

    def ranked(k: Column) -> Column:
        """The value of rank k (from 0), which is in the range or the next value above it."""
        place = k - F.col("_below")
        return F.when(place >= F.col("_in"), F.coalesce("_next", "_hi")) \
            .when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise(F.get("_list", place.cast("int")))

    v0, v1 = ranked(F.col("_k")), ranked(F.col("_k") + 1)
    return last.select(by, (v0 + (F.col("_h") - F.col("_k")) * (v1 - v0)).alias(name))


def _narrowed(x: DataFrame, state: DataFrame, by: str) -> DataFrame:
    """The state with each range cut down to the part that holds its rank."""
    rows = x.join(state, by).where((F.col("_x") >= F.col("_lo")) & (F.col("_x") <= F.col("_hi")))
    ranges = written(rows.groupBy(by).agg(
        F.percentile_approx("_x", [i / ACCURACY for i in range(ACCURACY + 1)], ACCURACY).alias("_p"),
        *[F.max(c).alias(c) for c in ("_h", "_k", "_below", "_in")]))
    at = F.floor((F.col("_k") - F.col("_below")) * ACCURACY / F.col("_in")).cast("int")
    cuts = ranges.select(by, "_h", "_k", "_below", F.get("_p", F.greatest(F.lit(0), at - 2)).alias("_from"),
                         F.get("_p", at).alias("_pivot"), F.get("_p", F.least(F.lit(ACCURACY), at + 3)).alias("_to"))
    cuts = written(cuts)
    part = F.when(F.col("_x") < F.col("_from"), 0).when(F.col("_x") < F.col("_pivot"), 1).when(F.col("_x") == F.col("_pivot"), 2) \
        .when(F.col("_x") <= F.col("_to"), 3).otherwise(4)
    counts = rows.select(by, "_x").join(cuts, by).groupBy(by, part.alias("_part")).agg(
        F.count(F.lit(1)).alias("_c"), F.min("_x").alias("_least"), F.max("_x").alias("_most"))
    up_to = F.sum("_c").over(Window.partitionBy(by).orderBy("_part"))
    found = cuts.select(by, "_h", "_k", "_below").join(counts.withColumn("_to", up_to), by)
    after = F.col("_below") + F.col("_to")
    found = found.where((after > F.col("_k")) & (after - F.col("_c") <= F.col("_k")))
    return found.select(by, "_h", "_k", F.col("_least").alias("_lo"), F.col("_most").alias("_hi"),
                        (after - F.col("_c")).alias("_below"), F.col("_c").alias("_in"))
