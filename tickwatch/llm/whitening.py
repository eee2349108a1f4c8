"""Embedding whitening (operator 12): weighted covariance over distinct vectors, one projection a distinct vector.

1. Entries are put on a grid: x = floor(scale * c) + offset, a long; rows with a null vector or with a
   null or non-finite entry are left out.
2. Equal x vectors are grouped (a partial count in each task first, so a vector that a third of all
   rows have is no hot group) and each gets a fit weight, one or its count.
3. Two passes over the distinct vectors fit a model: weighted sums, exact in integers, then the
   centred weighted product of each batch with itself (one matrix product a batch), added up by entry.
4. Components are unit eigenvectors of the covariance by falling eigenvalue, their sign set so that the
   entry of largest size is positive.  Each distinct vector is projected once, and rows get the
   result by a join on x.

Only d x d numbers a task and one model are gathered, where d is the dimension.

Defined results: vectors of different dimensions are fitted apart, each dimension a model of its own;
vectors without entries give no rows; an entry beyond 2^53 / scale counts as that bound; repeated rows
are kept; a component without variance (eigenvalue up to d * 2^-52 of the largest) has null
``whitened`` and share 0 (null if nothing varies); ``deviation`` is null where it exceeds a long;
columns other than the id and the vector are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch.llm.common import written

#: Largest size of a scaled entry: up to here doubles are exact whole numbers.
LARGEST = float(1 << 53)
#: Numbers that a task turns into a matrix at once.
BATCH_ENTRIES = 1 << 20


@dataclass(frozen=True)
class WhiteningParams:
    scale: float = 64.0
    offset: int = 1_000_000
    components: int = 16
    #: "one": each distinct vector counts once; "count": as often as it occurs.
    weights: str = "one"


@dataclass(frozen=True)
class Model:
    """Covariance of the vectors of one dimension: weight n, integer sums, eigenvalues falling, components as columns."""

    n: int
    sums: list[int]
    covariance: np.ndarray
    values: np.ndarray
    vectors: np.ndarray


# ------------------------------------------------------------------------------ rows

def gridded(rows: DataFrame, p: WhiteningParams, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id and x of every row whose vector is whole."""
    entries = F.transform(F.col(embedding), lambda c: c.cast("double"))
    whole = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))

    def on_grid(c: Column) -> Column:
        scaled = F.greatest(F.lit(-LARGEST), F.least(F.lit(LARGEST), c * p.scale))
        return F.floor(scaled).cast("long") + F.lit(p.offset).cast("long")

    return rows.select(F.col(vec_id).alias("vec_id"), entries.alias("c")).where(F.col("c").isNotNull() & whole & (F.size("c") > 0)) \
        .select("vec_id", F.transform("c", on_grid).alias("x"))


def distinct_vectors(rows: DataFrame, p: WhiteningParams) -> DataFrame:
    """x and its fit weight, once for each distinct x."""
    weight = F.lit(1) if p.weights == "one" else F.count(F.lit(1))
    return rows.groupBy("x").agg(weight.cast("long").alias("weight"))


# ------------------------------------------------------------------------------ covariance

def matrices(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """(rows, their vectors as a matrix) for rows of one dimension at a time, few enough for the memory of a task."""
    for batch in batches:
        sizes = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
        for d in np.unique(sizes):
            at = np.flatnonzero(sizes == d)
            step = max(1, BATCH_ENTRIES // int(d))
            for i in range(0, len(at), step):
                part = batch.take(pa.array(at[i:i + step]))
                yield part, part.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, d)


def weighted_sums(column: str) -> Callable:
    """Per task and dimension: the weights and each entry's weighted sum, in Python's whole numbers or doubles, as text."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for part, x in matrices(batches, column):
            w = part.column("weight").to_numpy(zero_copy_only=False)
            whole = x.dtype.kind == "i"
            if whole and len(w) * int(w.max()) >= 1 << 30:
                w = w.astype(object)
            # halves of 32 bits, so that the sums of a batch stay within a long
            found = [int(h) << 32 for h in ((x >> 32) * w[:, None]).sum(0)] if whole else (x * w[:, None]).sum(0).tolist()
            if whole:
                found = [a + int(b) for a, b in zip(found, ((x & 0xFFFFFFFF) * w[:, None]).sum(0))]
            total = totals.setdefault(x.shape[1], [0, [0] * x.shape[1]])
            total[0] += int(w.sum())
            total[1] = [a + b for a, b in zip(total[1], found)]
        for d, (n, sums) in totals.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()),
                                              "n": pa.array([n] * d, pa.int64()), "s": pa.array([repr(s) for s in sums])})
    return run


def centred_products(column: str, means: dict[int, tuple[int, list]]) -> Callable:
    """Per task and dimension: the weighted product of the centred vectors with themselves, row by row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for part, x in matrices(batches, column):
            n, sums = means[x.shape[1]]
            # whole part and rest of the mean apart: the difference of whole numbers is exact
            base = [s // n if isinstance(s, int) else 0 for s in sums]
            rest = np.array([(s - b * n) / n for s, b in zip(sums, base)])
            c = (x - np.array(base, x.dtype)).astype(float) - rest
            w = part.column("weight").to_numpy(zero_copy_only=False).astype(float)
            totals[x.shape[1]] = totals.get(x.shape[1], 0.0) + (c * w[:, None]).T @ c
        for d, m in totals.items():
            yield pa.RecordBatch.from_pydict({"d": pa.array([d] * d, pa.int32()), "i": pa.array(range(d), pa.int32()),
                                              "row": pa.array(list(m), pa.list_(pa.float64()))})
    return run


def weighted_covariance(vectors: DataFrame, column: str = "x") -> dict[int, Model]:
    """A model for each dimension of ``column`` (whole numbers or doubles), over the column ``weight``."""
    means: dict[int, tuple[int, list]] = {}
    sums = vectors.select(column, "weight").mapInArrow(weighted_sums(column), "d int, i int, n long, s string")
    # decimal digits of whole numbers are added exactly, doubles as doubles
    kind = "decimal(38,0)" if vectors.schema[column].dataType.elementType.typeName() == "long" else "double"
    added = sums.groupBy("d", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast(kind)).alias("s")).orderBy("d", "i").collect()
    for r in added:
        means.setdefault(r["d"], (r["n"], []))[1].append(int(r["s"]) if kind != "double" else r["s"])
    products = vectors.select(column, "weight").mapInArrow(centred_products(column, means), "d int, i int, row array<double>")
    entries = products.select("d", "i", F.posexplode("row").alias("j", "v")).groupBy("d", "i", "j").agg(F.sum("v").alias("v"))
    found = {d: np.zeros((d, d)) for d in means}
    for r in entries.collect():
        found[r["d"]][r["i"], r["j"]] = r["v"]
    models = {}
    for d, (n, s) in means.items():
        cov = (found[d] + found[d].T) / 2 / n
        values, vecs = np.linalg.eigh(cov)
        values, vecs = values[::-1], vecs[:, ::-1]
        vecs = vecs * np.where(vecs[np.abs(vecs).argmax(0), np.arange(d)] < 0, -1.0, 1.0)
        models[d] = Model(n, s, cov, values, vecs)
    return models


def varying(m: Model, k: int) -> int:
    """How many of the first k components have variance."""
    return int((m.values[:k] > m.values[0] * len(m.values) * 2.0 ** -52).sum()) if m.values[0] > 0 else 0


# ------------------------------------------------------------------------------ projection

def deviations(x: np.ndarray, m: Model) -> list[int | None]:
    """Sum over the dimensions of (n * x - S)^2 for each row, exact; None beyond a long."""
    top = max(int(np.abs(x).max()), 1) * m.n + max(map(abs, m.sums))
    if top * top * x.shape[1] < 1 << 63:
        c = x * m.n - np.array(m.sums, np.int64)
        return (c * c).sum(1).tolist()
    base = np.array([s // m.n for s in m.sums], np.int64)  # near the mean the differences are small again
    rest = [s - int(b) * m.n for s, b in zip(m.sums, base)]
    c = x - base
    if int(np.abs(c).max() + 1) ** 2 * m.n ** 2 * x.shape[1] < 1 << 63:
        c = c * m.n - np.array(rest, np.int64)
        return (c * c).sum(1).tolist()
    exact = ((sum((v * m.n - r) ** 2 for v, r in zip(row, rest))) for row in c.tolist())
    return [v if v < 1 << 63 else None for v in exact]


def projected(models: dict[int, Model], k: int) -> Callable:
    """x, weight, deviation and whitened (null where a component has no variance) of each vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, x in matrices(batches, "x"):
            d = x.shape[1]
            m = models[d]
            live, most = varying(m, k), min(k, d)
            base = np.array([s // m.n for s in m.sums], np.int64)
            rest = np.array([(s - int(b) * m.n) / m.n for s, b in zip(m.sums, base)])
            z = ((x - base).astype(float) - rest) @ (m.vectors[:, :live] / np.sqrt(m.values[:live]))
            yield pa.RecordBatch.from_arrays(
                [part.column("x"), part.column("weight"), pa.array(deviations(x, m), pa.int64()),
                 pa.array(list(z), pa.list_(pa.float64())), pa.array([most] * len(x), pa.int32())],
                ["x", "weight", "deviation", "whitened", "n_components"])
    return run


def whitened(rows: DataFrame, p: WhiteningParams = WhiteningParams(), vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """vec_id, n, deviation, whitened (array), n_components, explained (array) and identity_error of every whole row."""
    spark = rows.sparkSession
    grid = written(gridded(rows, p, vec_id, embedding))
    vectors = written(distinct_vectors(grid, p))
    models = weighted_covariance(vectors)
    out = written(vectors.mapInArrow(projected(models, p.components),
                                     "x array<long>, weight long, deviation long, whitened array<double>, n_components int"))
    # the whitened vectors' own covariance, measured by the same two passes; whitened vectors of
    # different dimensions may have one length, so each dimension is measured apart
    facts = []
    for d, m in models.items():
        live, shown = varying(m, p.components), min(p.components, d)
        error = None
        if live:
            white = weighted_covariance(out.where(F.size("x") == d).select("whitened", "weight"), "whitened")[live]
            error = float(np.abs(white.covariance - np.eye(live)).max())
        total = float(np.trace(m.covariance))
        share = [float(v) / total if i < live else 0.0 for i, v in enumerate(m.values[:shown])] if total > 0 else [None] * shown
        facts.append((d, m.n, share, error))
    fact = spark.createDataFrame(facts, "d int, n long, explained array<double>, identity_error double")  # a row a dimension
    return grid.join(out.drop("weight"), "x").withColumn("d", F.size("x")).join(F.broadcast(fact), "d") \
        .select("vec_id", "n", "deviation", "whitened", "n_components", "explained", "identity_error")


def by_component(white: DataFrame) -> DataFrame:
    """One row for each row and component of ``whitened``'s result."""
    rows = white.select("*", F.explode(F.sequence(F.lit(1), F.col("n_components"))).alias("component"))
    return rows.select("vec_id", "component", "n", "deviation", F.get("whitened", F.col("component") - 1).alias("whitened"),
                       F.get("explained", F.col("component") - 1).alias("explained"), "identity_error")
