"""Window statistics over a blocked tick frame (see ``blocks``).

All windows share one spec, ``partitionBy(series, block).orderBy(rn)``, so
Spark plans one Exchange and one Sort for all of them.  Guards use the global
row number ``rn`` ("at least k previous prices" is ``rn > k``), which is exact
on the block's own rows whatever the block boundary.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.operators.blocks import block_window
from tickwatch.schema import RuleParams


def _w(lo: int, hi: int):
    return block_window().rowsBetween(lo, hi)


def producer_change(df: DataFrame) -> DataFrame:
    """Percent change against the previous tick, 0.0 when none or zero."""
    prev = F.lag("price").over(block_window())
    return df.withColumn(
        "change",
        F.coalesce(F.try_divide(F.col("price") - prev, F.when(prev != 0, prev)) * F.lit(100.0), F.lit(0.0)),
    )


def gated_change(df: DataFrame, params: RuleParams) -> DataFrame:
    """W1 + P4 + F2: previous tick, time gap gate, gated absolute / percent change."""
    w = block_window()
    df = df.withColumns({"prev_price": F.lag("price").over(w),
                         "dt": (F.col("t_us") - F.lag("t_us").over(w)) / F.lit(1e6)})
    gate = (F.col("prev_price").isNotNull() & (F.col("dt") > 0) & (F.col("dt") <= F.lit(float(params.max_dt))))
    diff = F.col("price") - F.col("prev_price")
    gated = F.coalesce(gate, F.lit(False))
    return df.withColumns({
        "gated": gated,
        "diff": diff,
        "abs_change": F.when(gated, diff).otherwise(F.lit(0.0)),
        "pct_change": F.when(gated, F.try_divide(diff, F.col("prev_price")) * F.lit(100.0)).otherwise(F.lit(0.0)),
    })


@dataclass(frozen=True)
class Sliding:
    """Moments of ``column`` over the rows from ``first`` to ``last`` rows before the current one (0: itself);
    they become ``name``_n, ``name``_mean and ``name``_var (population)."""

    name: str
    column: str
    first: int
    last: int = 0


def sliding_moments(df: DataFrame, frames: list[Sliding]) -> DataFrame:
    """Count, mean and population variance over sliding frames at a cost per row that doesn't grow with the frame.

    Rows are cut into sub-blocks of the longest frame's length, so a frame is the end of one sub-block and the
    beginning of the next.  Running moments forwards give the beginnings, backwards the ends, and one merge
    of (n, mean, M2) joins the two: differences of means only, no sums of squares that cancel.  The shorter
    frames must not be more than one row shorter."""
    length = max(f.first - f.last + 1 for f in frames)
    if any(f.first - f.last + 1 < length - 1 for f in frames):
        raise ValueError("frames of one call differ by at most one row in length")
    sub = F.expr(f"(rn - 1) div {length}")
    forwards = Window.partitionBy("series", "block", "_sub").orderBy("rn")
    backwards = Window.partitionBy("series", "block", "_sub").orderBy(F.desc("rn"))
    rows = Window.partitionBy("series", "block").orderBy("_sub", "rn")
    columns = list({f.column: 0 for f in frames})

    def running(over, last: int = 0):
        return over.rowsBetween(Window.unboundedPreceding, -last)

    def moments(column: str, ref: str, over) -> Column:
        # differences from a value of the frame: equal values have exactly that mean and variance 0
        x = F.col(column) - F.col(ref)
        n = F.count(x).over(over)
        return F.struct(n.alias("n"), (F.avg(x).over(over) + F.first(ref, ignorenulls=True).over(over)).alias("mean"),
                        (F.var_pop(x).over(over) * n).alias("m2"))

    df = df.withColumn("_sub", sub)
    df = df.withColumns({f"_ref_{c}": F.first(c, ignorenulls=True).over(running(backwards)) for c in columns})
    df = df.withColumns({f"_end_{c}": moments(c, f"_ref_{c}", running(backwards)) for c in columns})
    df = df.withColumns({f"_ref_{c}": F.first(c, ignorenulls=True).over(running(forwards)) for c in columns})
    df = df.withColumns({f"_begin_{f.name}": moments(f.column, f"_ref_{f.column}", running(forwards, f.last)) for f in frames})
    df = df.withColumns({f"_tail_{f.name}": F.lag(F.struct(F.col("_sub").alias("sub"), F.col(f"_end_{f.column}").alias("m")), f.first).over(rows)
                         for f in frames})
    out = {}
    for f in frames:
        b, tail = F.col(f"_begin_{f.name}"), F.col(f"_tail_{f.name}")
        # a frame that begins in the current sub-block begins with it
        before = F.coalesce(tail["sub"] < F.col("_sub"), F.lit(False))
        n1 = F.when(before, tail["m"]["n"]).otherwise(F.lit(0))
        n2 = b["n"]
        n = n1 + n2
        delta = b["mean"] - tail["m"]["mean"]
        out[f"{f.name}_n"] = n
        out[f"{f.name}_mean"] = F.when(n1 == 0, b["mean"]).when(n2 == 0, tail["m"]["mean"]).otherwise(tail["m"]["mean"] + delta * (n2 / n))
        out[f"{f.name}_var"] = F.when(n1 == 0, b["m2"] / F.when(n2 > 0, n2)).when(n2 == 0, tail["m"]["m2"] / n1) \
            .otherwise((tail["m"]["m2"] + b["m2"] + delta * delta * (n1 * n2 / n)) / n)
    return df.withColumns(out).drop("_sub", *[f"_{part}_{c}" for c in columns for part in ("ref", "end")],
                                    *[f"_{part}_{f.name}" for f in frames for part in ("begin", "tail")])


def rolling_stats(df: DataFrame) -> DataFrame:
    """W2 + W3 + W10: mean / population sigma of the previous <= 120 prices and
    population sigma of the previous <= 119 one-step differences (current row excluded).
    Needs ``diff`` (from ``gated_change``)."""
    n = C.PRICE_WINDOW
    df = sliding_moments(df, [Sliding("_p", "price", n, 1), Sliding("_d", "diff", n - 1, 1)])
    return df.withColumns({
        "n_prev": F.least(F.col("rn") - 1, F.lit(n)),
        "n_frame": F.col("_p_n"),
        "mean120": F.col("_p_mean"),
        "sd120": F.sqrt("_p_var"),
        "sd_ret119": F.sqrt("_d_var"),
    }).drop(*[f"{m}_{k}" for m in ("_p", "_d") for k in ("n", "mean", "var")])


def if_features(df: DataFrame, window_rows: int = C.IF_WINDOW, training: bool = False) -> DataFrame:
    """[price, r1, r5, sigma, z] over the last ``window_rows`` prices
    including the current one (online variant, from row 20) or ``window_rows+1``
    prices (training variant, from row 21).  NULL where not defined."""
    span = window_rows + 1 if training else window_rows
    first = window_rows + 1 if training else window_rows
    frame = _w(-(span - 1), 0)
    w = block_window()
    ok = F.col("rn") >= F.lit(first)
    sd = F.stddev_pop("price").over(frame)
    sigma = F.when(sd == 0, F.lit(C.SIGMA_EPS)).otherwise(sd)
    mu = F.avg("price").over(frame)
    lag1 = F.lag("price", 1).over(w)
    lag5 = F.lag("price", 5).over(w)

    def ret(lagged: Column) -> Column:
        return (F.col("price") - lagged) / F.when(lagged == 0, F.lit(C.SIGMA_EPS)).otherwise(lagged)

    return df.withColumns({
        "f_price": F.when(ok, F.col("price")),
        "f_r1": F.when(ok, ret(lag1)),
        "f_r5": F.when(ok, ret(lag5)),
        "f_sigma": F.when(ok, sigma),
        "f_z": F.when(ok, (F.col("price") - mu) / sigma),
    })


FEATURES = ["f_price", "f_r1", "f_r5", "f_sigma", "f_z"]


def price_sequences(df: DataFrame, length: int = C.SEQ_LEN) -> DataFrame:
    """The last ``length`` prices including the current one, from row ``length``."""
    # the frame count guard also blanks early halo rows whose window is cut by the block start
    frame = _w(-(length - 1), 0)
    return df.withColumn("seq_prices", F.when((F.col("rn") >= F.lit(length))
                                              & (F.count("price").over(frame) == F.lit(length)),
                                              F.collect_list("price").over(frame)))


def sequence_variance(df: DataFrame, length: int = C.SEQ_LEN) -> DataFrame:
    """Population variance of the last ``length`` prices: a model-free error used
    wherever the reconstruction error must be checkable in plain SQL."""
    df = sliding_moments(df, [Sliding("_v", "price", length - 1)])
    whole = (F.col("rn") >= F.lit(length)) & (F.col("_v_n") == F.lit(length))
    return df.withColumn("var_err", F.when(whole, F.col("_v_var"))).drop("_v_n", "_v_mean", "_v_var")


def dynamic_threshold(df: DataFrame, error: str, base_threshold: Column,
                      first_rn: int = C.SEQ_LEN) -> DataFrame:
    """W9 + M10: mean + 2 sigma (population) of the last <= 300 errors including
    the current one once more than 50 errors exist, else the base threshold;
    ratio = error / (threshold or 1e-10); flag when error > threshold."""
    n_err = F.col("rn") - F.lit(first_rn - 1)
    df = sliding_moments(df, [Sliding("_e", error, C.ERR_WINDOW - 1)])
    dyn = F.col("_e_mean") + F.lit(C.ERR_K) * F.sqrt("_e_var")
    thr = F.when(F.col(error).isNull(), F.lit(None)).when(n_err > F.lit(C.ERR_MIN), dyn).otherwise(base_threshold)
    df = df.withColumn("threshold", thr).drop("_e_n", "_e_mean", "_e_var")
    return df.withColumns({
        "ratio": F.col(error) / F.when(F.col("threshold") == 0, F.lit(C.THRESH_EPS)).otherwise(F.col("threshold")),
        "err_flag": F.col(error) > F.col("threshold"),
    })
