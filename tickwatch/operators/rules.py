"""The four rule detectors, the edge-triggered latch and the fired list."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.operators.blocks import block_window
from tickwatch.schema import RuleParams


def rule_flags(df: DataFrame, params: RuleParams) -> DataFrame:
    """Needs ``gated_change`` and ``rolling_stats`` columns.

    pct_spike / abs_jump / vol_breakout are gated by the time gap;
    ``mr_cond`` is the un-latched mean-reversion condition, NULL when the row
    cannot be evaluated (fewer than 10 previous prices or sigma = 0).
    """
    if params.mr_k * math.sqrt(C.PRICE_WINDOW - 1) <= 1:
        # one odd price among 120 could then be a breach, and the latch would need a look-back without bound
        raise ValueError(f"mr_k must be above {1 / math.sqrt(C.PRICE_WINDOW - 1):.4f}, got {params.mr_k}")
    enough = F.col("rn") > F.lit(C.MIN_HISTORY)
    pct = F.coalesce(F.col("gated") & (F.abs("pct_change") >= F.lit(float(params.min_pct))), F.lit(False))
    absj = F.col("gated") & (F.abs("abs_change") >= F.lit(float(params.min_abs)))
    vol = (F.col("gated") & enough & (F.col("sd_ret119") > 0)
           & (F.abs("abs_change") >= F.greatest(F.lit(float(params.vol_k)) * F.col("sd_ret119"),
                                                 F.lit(float(params.vol_floor)))))
    mr_cond = F.when(enough & (F.col("sd120") > 0),
                     F.abs(F.col("price") - F.col("mean120"))
                     >= F.greatest(F.lit(float(params.mr_k)) * F.col("sd120"), F.lit(float(params.mr_floor))))
    return df.withColumns({
        "pct_spike": pct,
        "abs_jump": F.coalesce(absj, F.lit(False)),
        "vol_breakout": F.coalesce(vol, F.lit(False)),
        "mr_cond": mr_cond,
        # the row's 120-price window lies entirely inside its block partition
        "mr_reliable": F.col("n_frame") == F.col("n_prev"),
    })


def latch(df: DataFrame) -> DataFrame:
    """Fire on the first breach, re-arm when back inside.

    The latch before row i is the last non-NULL ``mr_cond`` before i (false if
    none).  ``mr_cond`` is NULL past row 10 only when the previous <= 120 prices
    are all equal; the last evaluable row before such a flat stretch has exactly
    one other price x in its window, so |p - mean| = |x - c| / 120 < 2 sigma and
    its condition is false.  Hence "last non-NULL before i, else false" only
    needs rows whose 120-row window is complete inside the block
    (``mr_reliable``); a halo of >= 121 rows always holds one, so the latch is
    exact per block with no cross-block carry.
    """
    prev = F.last(F.when(F.col("mr_reliable"), F.col("mr_cond")), ignorenulls=True).over(
        block_window().rowsBetween(Window.unboundedPreceding, -1))
    armed = F.coalesce(prev, F.lit(False))
    return df.withColumn("mean_reversion_break", F.coalesce(F.col("mr_cond") & ~armed, F.lit(False)))


def fired_types(flags: list[tuple[str, Column]]) -> Column:
    """Ordered list of fired detector names."""
    return F.filter(F.array(*[F.when(c, F.lit(name)) for name, c in flags]), lambda x: x.isNotNull())


def rule_types() -> Column:
    return fired_types([(C.PCT_SPIKE, F.col("pct_spike")), (C.ABS_JUMP, F.col("abs_jump")),
                        (C.VOL_BREAKOUT, F.col("vol_breakout")),
                        (C.MEAN_REVERSION_BREAK, F.col("mean_reversion_break"))])
