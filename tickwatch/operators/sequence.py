"""M6-M10 + W9: the sequence-reconstruction detector.

A window is the last 60 prices, standardised with one scalar scaler per series (M6); its error is the
mean squared difference between it and its reconstruction by a model (M9).  No row carries its window:
prices travel one a row, in blocks sorted by row number, and a task slides over them, a batch of rows at a
time (``sliding``).

The model is any function from windows to reconstructed windows (M7), made once in each Python worker by a
``make_predict_fn`` as in ``pyspark.ml.functions.predict_batch_udf``.  The built-in one is a linear
autoencoder: the ``k`` principal components of the training windows (pooled over series), whose 60 x 60
covariance the tasks add up from their windows' products.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.operators.blocks import block_window
from tickwatch.session import written

#: A model: makes a function from windows (rows, seq_len) to their reconstructions.
MakePredict = Callable[[], Callable[[np.ndarray], np.ndarray]]
#: Windows formed at once in a task.
BATCH_ROWS = 4096


def training_weight(rn: Column, length: Column, seq_len: int = C.SEQ_LEN) -> Column:
    """Number of training windows containing row ``rn`` (1-based) of a series of ``length`` rows.

    Training windows end at rows seq_len .. length - 1 (the last row is left out)."""
    hi = F.least(length - 1, rn + F.lit(seq_len - 1))
    lo = F.greatest(F.lit(seq_len), rn)
    return F.greatest(F.lit(0), hi - lo + 1)


def series_lengths(numbered: DataFrame) -> DataFrame:
    """``_len``: rows of each series.  Written: read with its true size, it is broadcast unless the series are very
    many, and the rows of a series don't meet in one task for a join."""
    return written(numbered.groupBy("series").agg(F.max("rn").alias("_len")))


def sequence_scaler(numbered: DataFrame, seq_len: int = C.SEQ_LEN, lengths: DataFrame | None = None) -> DataFrame:
    """M6: per series, mean and population sigma of all values of all training windows
    (each price weighted by the number of windows containing it; no 60x explode)."""
    if lengths is None:
        lengths = series_lengths(numbered)
    w = numbered.join(lengths, "series").withColumn("_w", training_weight(F.col("rn"), F.col("_len"), seq_len))
    w = w.where(F.col("_w") > 0)
    means = written(w.groupBy("series").agg((F.sum(F.col("_w") * F.col("price")) / F.sum("_w")).alias("seq_mean")))
    var = w.join(means, "series").groupBy("series", "seq_mean").agg(
        (F.sum(F.col("_w") * (F.col("price") - F.col("seq_mean")) ** 2) / F.sum("_w")).alias("_var"))
    return var.select("series", "seq_mean", F.sqrt("_var").alias("seq_sd"))


@dataclass
class SequenceModel:
    make_predict: MakePredict
    base_threshold: float
    scaler: DataFrame  # series, seq_mean, seq_sd
    seq_len: int = C.SEQ_LEN


def linear_autoencoder(mean: np.ndarray, components: np.ndarray) -> MakePredict:
    """Reconstruction from principal components (columns): one dot product a component and row."""
    def make() -> Callable[[np.ndarray], np.ndarray]:
        return lambda windows: mean + ((windows - mean) @ components) @ components.T

    return make


# ------------------------------------------------------------------------------ sliding over blocks

def scaled(frame: DataFrame, scaler: DataFrame) -> DataFrame:
    """Adds ``_place`` (row of the block, from 1) and ``_x`` (standardised price; null without a scaler), rows of a
    block together and in order: a window function over the block asks Spark for that."""
    sd = F.when((F.col("seq_sd") == 0) | F.col("seq_sd").isNull(), F.lit(1.0)).otherwise(F.col("seq_sd"))
    j = frame.join(scaler, "series", "left").withColumn("_x", (F.col("price") - F.col("seq_mean")) / sd)
    return j.drop("seq_mean", "seq_sd").withColumn("_place", F.row_number().over(block_window()))


def reconstruction_error(make_predict: MakePredict, seq_len: int):
    """M9: pandas UDF over (place, value) of rows in block order: each row's error, NaN before a block's first window.

    Not deterministic for the optimizer: rows filtered out before it would be missing in others' windows."""
    @F.pandas_udf("double")
    def recon_error(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        predict = make_predict()
        for place, x in _with_carry(batches, seq_len):
            yield pd.Series(_errors(predict, place, x, seq_len))

    return recon_error.asNondeterministic()


def _with_carry(batches, seq_len: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, values) of each batch, the values behind the last ``seq_len`` - 1 of the batch before."""
    carry = np.empty(0)
    for place, x in batches:
        values = np.concatenate([carry, np.asarray(x, dtype=np.float64)])
        yield np.asarray(place), values
        carry = values[max(0, len(values) - (seq_len - 1)):]


def _windows(place: np.ndarray, values: np.ndarray, seq_len: int, wanted: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, windows) of a batch's rows that end a window within their block, a piece at a time."""
    before = len(values) - len(place)
    at = np.flatnonzero(place >= seq_len if wanted is None else wanted & (place >= seq_len))
    if len(at):
        views = np.lib.stride_tricks.sliding_window_view(values, seq_len)
        for i in range(0, len(at), BATCH_ROWS):
            piece = at[i:i + BATCH_ROWS]
            yield piece, views[piece + before - (seq_len - 1)]


def _errors(predict, place: np.ndarray, values: np.ndarray, seq_len: int) -> np.ndarray:
    out = np.full(len(place), np.nan)
    for at, w in _windows(place, values, seq_len):
        out[at] = np.mean((w - predict(w)) ** 2, axis=1)
    return out


def window_products(seq_len: int):
    """Per task: number, sum and product of the training windows (``_train``), as rows (i, n, s, row of the product)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total, product = 0, np.zeros(seq_len), np.zeros((seq_len, seq_len))
        read = []

        def columns():
            for b in batches:
                read.append(b.column("_train").to_numpy(zero_copy_only=False))
                yield b.column("_place").to_numpy(zero_copy_only=False), b.column("_x").to_numpy(zero_copy_only=False)

        for place, values in _with_carry(columns(), seq_len):
            for _, w in _windows(place, values, seq_len, read.pop()):
                n, total, product = n + len(w), total + w.sum(0), product + w.T @ w
        if n:
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(seq_len), pa.int32()), "n": pa.array([n] * seq_len, pa.int64()),
                                              "s": pa.array(total), "row": pa.array(list(product), pa.list_(pa.float64()))})

    return run


# ------------------------------------------------------------------------------ fit and score

def training_frame(blocked: DataFrame, scaler: DataFrame, seq_len: int, lengths: DataFrame | None = None) -> DataFrame:
    """The blocked rows with ``_train``: does a training window end here?  (All but each series' last row.)"""
    if lengths is None:
        lengths = series_lengths(blocked.where("own"))
    rows = blocked.select("series", "block", "own", "rn", "price").join(lengths, "series", "left")
    return scaled(rows.withColumn("_train", F.col("own") & (F.col("rn") < F.col("_len"))), scaler)


def principal_components(train: DataFrame, k: int, seq_len: int) -> tuple[np.ndarray, np.ndarray]:
    """Mean and first ``k`` components (columns) of the training windows.

    The windows are standardised, so their plain products keep their digits; 60 x 61 numbers come to the driver."""
    parts = train.select("_place", "_x", "_train").mapInArrow(window_products(seq_len), "i int, n long, s double, row array<double>")
    parts = parts.select("i", "n", "s", F.posexplode("row").alias("j", "v"))
    mean, product, n = np.zeros(seq_len), np.zeros((seq_len, seq_len)), 0
    for r in parts.groupBy("i", "j").agg(F.sum("n").alias("n"), F.sum("s").alias("s"), F.sum("v").alias("v")).collect():
        n, mean[r["i"]], product[r["i"], r["j"]] = r["n"], r["s"] / r["n"], r["v"] / r["n"]
    if not n:
        raise ValueError(f"no series has a window of {seq_len} prices before its last row")
    _, vectors = np.linalg.eigh(product - np.outer(mean, mean))
    return mean, vectors[:, ::-1][:, :k]


def fit_sequence_model(blocked: DataFrame, scaler: DataFrame | None = None, k: int = 8, seq_len: int = C.SEQ_LEN,
                       make_predict: MakePredict | None = None) -> SequenceModel:
    """M6 + M7 + M8: per-series scaler, the model and the base threshold mean + 3 sigma of the training errors.

    ``blocked``: rows in blocks with a halo of ``seq_len`` (see ``blocks.to_blocks``).  ``make_predict`` plugs in
    another model, trained elsewhere; else principal components are fitted here.  The fit is eager, like an MLlib
    estimator; the (one row per series) scaler is written, so scoring plans don't read the history again."""
    own = blocked.where("own").select("series", "rn", "price")
    lengths = series_lengths(own)
    if scaler is None:
        scaler = sequence_scaler(own, seq_len, lengths)
    scaler = written(scaler)
    train = training_frame(blocked, scaler, seq_len, lengths)
    if make_predict is None:
        make_predict = linear_autoencoder(*principal_components(train, k, seq_len))
    error = reconstruction_error(make_predict, seq_len)
    errors = train.withColumn("e", error("_place", "_x")).where(F.col("_train") & ~F.isnan("e"))
    st = errors.agg(base_threshold_expr(F.col("e")).alias("base")).first()
    return SequenceModel(make_predict, float(st["base"]), scaler, seq_len)


def score_sequences(frame: DataFrame, model: SequenceModel, out: str = "seq_err") -> DataFrame:
    """Reconstruction error of every row of a blocked frame that ends a whole window (NULL otherwise)."""
    j = scaled(frame, model.scaler)
    j = j.withColumn(out, reconstruction_error(model.make_predict, model.seq_len)("_place", "_x"))
    j = j.withColumn(out, F.when(~F.isnan(out), F.col(out))).drop("_place", "_x")
    # Spark forgets how the rows lie over a Python function: dealt out once, not once for each kind of window to come
    return j.repartition("series", "block")


def base_threshold_expr(errors: Column) -> Column:
    """M8: mean + 3 sigma (population) of training errors."""
    return F.avg(errors) + F.lit(C.BASE_K) * F.stddev_pop(errors)
