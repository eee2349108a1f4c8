"""Sliding moments by merged sub-blocks against a plain computation of every frame."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwatch.operators.blocks import number_rows, to_blocks
from tickwatch.operators.stats import Sliding, sliding_moments
from tickwatch.schema import Layout


def frame(spark, values):
    rows = [("s", i, float(i), v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "series string, t_us long, price double, x double").withColumn("seq", F.col("t_us"))
    return number_rows(df, Layout(block_rows=37, bucket_rows=50, min_block_rows=1))


@pytest.mark.parametrize("first,last", [(7, 1), (6, 0), (29, 0), (1, 1), (0, 0)])
def test_equals_every_frame(spark, first, last):
    """Values far from zero that vary little (sums of squares would cancel), flat runs, nulls."""
    rng = np.random.default_rng(first)
    values = [None if i % 11 == 3 else 1e9 + float(rng.normal()) if i < 90 else 0.1 for i in range(170)]
    halo = first + 1
    got = sliding_moments(to_blocks(frame(spark, values), halo), [Sliding("m", "x", first, last)]).where("own").orderBy("rn")
    for r in got.collect():
        i = r["rn"] - 1
        w = [v for v in values[max(0, i - first):max(0, i - last + 1)] if v is not None]
        assert r["m_n"] == len(w)
        if not w:
            assert r["m_mean"] is None and r["m_var"] is None
            continue
        mean = math.fsum(w) / len(w)
        var = math.fsum((v - mean) ** 2 for v in w) / len(w)
        assert r["m_mean"] == pytest.approx(mean, rel=1e-15, abs=1e-300)
        assert r["m_var"] == pytest.approx(var, rel=1e-6, abs=1e-6)
        if len(set(w)) == 1:
            assert r["m_var"] == 0 and r["m_mean"] == pytest.approx(w[0], rel=1e-15)


def test_two_frames_in_one_call(spark):
    values = [float(i * i % 23) for i in range(120)]
    got = sliding_moments(to_blocks(frame(spark, values), 12), [Sliding("a", "x", 10, 1), Sliding("b", "price", 9, 1)]).where("own")
    for r in got.collect():
        i = r["rn"] - 1
        a, b = values[max(0, i - 10):i], [float(j) for j in range(max(0, i - 9), i)]
        assert (r["a_n"], r["b_n"]) == (len(a), len(b))
        if i:
            assert r["a_var"] == pytest.approx(np.var(a)) and r["b_mean"] == pytest.approx(np.mean(b))
    with pytest.raises(ValueError):
        sliding_moments(frame(spark, values), [Sliding("a", "x", 10), Sliding("b", "x", 5)])
