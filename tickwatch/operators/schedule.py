"""M4 + W11 + J3: the walk-forward retrain schedule in closed form.

Feature row index ``n`` (1-based) = rn - 19 (features need 20 prices).
Cold start: fit k >= 1 at n_k = 300 + 500 (k - 1) on rows max(1, n_k - 799) .. n_k;
row n >= 300 is scored by fit floor((n - 300) / 500) + 1, rows before by none (0).
Pre-trained start: model 0 scores from the first feature row; fit k at 500 k.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickwatch import constants as C

TRAIN_SPAN = C.IF_RETRAIN + C.IF_KEEP  # 800 rows seen by every refit


def feature_index(rn: Column, window_rows: int = C.IF_WINDOW) -> Column:
    return F.when(rn >= window_rows, rn - F.lit(window_rows - 1))


def fit_point(k: Column, pretrained: bool = False) -> Column:
    if pretrained:
        return k * F.lit(C.IF_RETRAIN)
    return F.lit(C.IF_WARMUP) + (k - 1) * F.lit(C.IF_RETRAIN)


def scoring_epoch(n: Column, pretrained: bool = False) -> Column:
    """Model id that scores feature row ``n`` (0 = none in cold start / the pre-trained model)."""
    if pretrained:
        return F.floor(n / F.lit(C.IF_RETRAIN)).cast("long")
    return F.when(n >= C.IF_WARMUP, F.floor((n - F.lit(C.IF_WARMUP)) / F.lit(C.IF_RETRAIN)) + 1) \
        .otherwise(F.lit(0)).cast("long")


def train_range(k: Column, pretrained: bool = False) -> tuple[Column, Column]:
    nk = fit_point(k, pretrained)
    return F.greatest(F.lit(1), nk - F.lit(TRAIN_SPAN - 1)), nk


def training_epochs(n: Column, pretrained: bool = False) -> Column:
    """Fits whose training range contains row ``n`` (at most two): array<long>."""
    if pretrained:
        lo = F.ceil(n / F.lit(C.IF_RETRAIN))
        hi = F.floor((n + F.lit(TRAIN_SPAN - 1)) / F.lit(C.IF_RETRAIN))
    else:
        lo = F.greatest(F.lit(1), F.ceil((n - F.lit(C.IF_WARMUP)) / F.lit(C.IF_RETRAIN)) + 1)
        hi = F.floor((n + F.lit(TRAIN_SPAN - 1 - C.IF_WARMUP)) / F.lit(C.IF_RETRAIN)) + 1
    lo = F.greatest(lo, F.lit(1)).cast("long")
    hi = hi.cast("long")
    return F.when(hi >= lo, F.sequence(lo, hi)).otherwise(F.array().cast("array<long>"))
