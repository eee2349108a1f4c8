"""Exact quantiles against NumPy, below and above the size at which values are kept."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwatch.operators import quantiles
from tickwatch.operators.quantiles import exact_quantile

RNG = np.random.default_rng(5)
GROUPS = {
    "one": [3.5], "two": [1.0, 2.0], "small": RNG.normal(size=999).tolist(),
    "large": (RNG.normal(size=30_000) * 1e-3 + 1e6).tolist(),
    "tails": np.concatenate([np.exp(RNG.normal(size=20_000) * 40), [-1e300, 1e300]]).tolist(),
    "ties": np.repeat([0.5, 0.25, 7.0], [15_000, 9_000, 6_000]).tolist(),
}


@pytest.fixture(scope="module")
def values(spark):
    rows = [(g, float(v)) for g, vs in GROUPS.items() for v in vs] + [("none", None), ("none", float("nan")), ("two", None)]
    return spark.createDataFrame(rows, "g string, v double").repartition(5).checkpoint()


@pytest.mark.parametrize("q", [0.0, 0.5, 0.95, 1.0])
def test_equals_linear_quantile(values, q):
    got = {r["g"]: r["quantile"] for r in exact_quantile(values, "g", "v", q).collect()}
    assert got.keys() == GROUPS.keys()
    for g, vs in GROUPS.items():
        assert got[g] == pytest.approx(np.quantile(vs, q), rel=1e-14, abs=0), g


def test_passes_and_bounds(values, monkeypatch):
    """Few values kept: more passes, the same result."""
    monkeypatch.setattr(quantiles, "KEPT", 50)
    monkeypatch.setattr(quantiles, "ACCURACY", 20)
    got = exact_quantile(values.where("g IN ('large', 'ties', 'small')"), "g", "v", 0.95)
    for r in got.collect():
        assert r["quantile"] == pytest.approx(np.quantile(GROUPS[r["g"]], 0.95), rel=1e-14)
    assert exact_quantile(values.where(F.lit(False)), "g", "v", 0.5).collect() == []
