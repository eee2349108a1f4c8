"""M1-M5 + J3 + M11: Isolation Forest as Spark jobs.

Walk-forward (the online detector): every feature row is exploded to the fits
that train on it (<= 2) plus the fit that scores it (closed-form schedule in
``schedule``), then ``groupBy(series, epoch).applyInArrow`` standardises, fits
100 trees and scores in one pass.  Each group holds at most 800 training and
500 scoring rows whatever the size of the series, so a hot series simply makes
more groups.

Static model (offline training over a whole history): each tree draws its
<= 256 rows by hashing (series, tree, seq); only hits are exploded, the draw is
capped per tree with ``row_number`` (bounded window partitions of ~1.5 x 256
rows), and ``groupBy(series, tree).applyInPandas`` builds one tree per group.
Output is a node table ``(series, tree, node, feature, threshold, left, right,
size, depth)``.
"""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tickwatch import constants as C
from tickwatch.functions import isoforest as isf
from tickwatch.operators import schedule as S
from tickwatch.operators.stats import FEATURES


def standardize(df: DataFrame, cols: list[str], by: list[str], prefix: str = "s_") -> DataFrame:
    """M1: (x - mean) / population sigma per group, zero sigma -> 1 (as a standard scaler).

    The statistics are one small row per group (partial aggregation, then a join
    that Spark broadcasts when small)."""
    stats = df.groupBy(*by).agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                                *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])
    j = df.join(stats, by)
    for c in cols:
        sd = F.col(f"_s_{c}")
        j = j.withColumn(f"{prefix}{c[2:] if c.startswith('f_') else c}",
                         (F.col(c) - F.col(f"_m_{c}")) / F.when((sd == 0) | sd.isNull(), F.lit(1.0)).otherwise(sd))
    return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])


def group_seed(seed: int, *parts) -> int:
    h = hashlib.blake2b("|".join(str(p) for p in (seed, *parts)).encode(), digest_size=8).digest()
    return int.from_bytes(h, "little") & ((1 << 63) - 1)


EPOCH_MODEL = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("_epoch", T.LongType()),
    T.StructField("mu", T.ArrayType(T.DoubleType())), T.StructField("sd", T.ArrayType(T.DoubleType())),
    T.StructField("cut", T.DoubleType()), T.StructField("n_trees", T.LongType()), T.StructField("subsample", T.LongType()),
    *[T.StructField(f, T.ArrayType(T.LongType())) for f in ("feature", "left", "right", "size", "depth", "tree")],
    T.StructField("threshold", T.ArrayType(T.DoubleType()))])


@dataclass
class EpochModel:
    """A fitted epoch: scaler, forest, and the score above which a row is flagged."""

    mu: np.ndarray
    sd: np.ndarray
    forest: isf.Forest
    cut: float

    @classmethod
    def fit(cls, train: np.ndarray, contamination: float, n_trees: int, subsample: int, seed: int) -> "EpochModel":
        mu, sd = train.mean(axis=0), train.std(axis=0)
        sd[sd == 0] = 1.0
        x = (train - mu) / sd
        forest = isf.fit_forest(x, n_trees, subsample, seed)
        return cls(mu, sd, forest, isf.flag_threshold(isf.forest_score(x, forest), contamination))

    def score(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and flag of each row of features ``x`` (no score where one is missing)."""
        ok = ~np.isnan(x).any(axis=1)
        scores, flags = np.zeros(len(x)), np.zeros(len(x), dtype=bool)
        scores[ok] = isf.forest_score((x[ok] - self.mu) / self.sd, self.forest)
        flags[ok] = scores[ok] > self.cut
        return scores, flags

    def row(self, series: str, epoch: int) -> pd.DataFrame:
        """The model as one row of a table of ``EPOCH_MODEL``."""
        f = self.forest
        arrays = {k: [getattr(f, k)] for k in ("feature", "left", "right", "size", "depth", "tree", "threshold")}
        return pd.DataFrame({"series": [series], "_epoch": [epoch], "mu": [self.mu], "sd": [self.sd], "cut": [self.cut],
                             "n_trees": [f.n_trees], "subsample": [f.subsample], **arrays})[EPOCH_MODEL.names]

    @classmethod
    def of(cls, row: pd.Series) -> "EpochModel":
        forest = isf.Forest(*[np.asarray(row[k]) for k in ("feature", "threshold", "left", "right", "size", "depth", "tree")],
                            int(row["n_trees"]), int(row["subsample"]))
        return cls(np.asarray(row["mu"]), np.asarray(row["sd"]), forest, float(row["cut"]))


def _roles(frame: DataFrame, pretrained: DataFrame | None, score_rows: str | None) -> DataFrame:
    """Each row once for every fit that trains on it and, unless ``score_rows`` is false, once for the one that
    scores it: ``_epoch``, ``_scoring``; columns that training doesn't need are in ``_row``, null in training rows."""
    rest = [c for c in frame.columns if c not in ("series", "rn", *FEATURES)]
    n = S.feature_index(F.col("rn"))
    if pretrained is not None:
        # M5 fallback: a series without a saved model warms up online (cold schedule)
        has_model = pretrained.select("series").distinct().withColumn("_pre", F.lit(True))
        frame = frame.join(has_model, "series", "left")
        is_pre = F.coalesce(F.col("_pre"), F.lit(False))
        sched_score = F.when(is_pre, S.scoring_epoch(n, True)).otherwise(S.scoring_epoch(n, False))
        sched_train = F.when(is_pre, S.training_epochs(n, True)).otherwise(S.training_epochs(n, False))
    else:
        sched_score, sched_train = S.scoring_epoch(n, False), S.training_epochs(n, False)
    score_epoch = F.when(n.isNull(), F.lit(0)).otherwise(sched_score).cast("long")
    train_epochs = F.when(n.isNull(), F.array().cast("array<long>")).otherwise(sched_train)
    score_role = F.array(F.struct(score_epoch.alias("_epoch"), F.lit(True).alias("_scoring")))
    if score_rows:
        score_role = F.when(F.col(score_rows), score_role).otherwise(
            F.array().cast("array<struct<_epoch:bigint,_scoring:boolean>>"))
    roles = F.concat(score_role,
                     F.transform(train_epochs, lambda e: F.struct(e.alias("_epoch"), F.lit(False).alias("_scoring"))))
    return frame.withColumn("_role", F.explode(roles)).select(
        "series", "rn", *FEATURES, *[F.when(F.col("_role._scoring"), F.struct(*rest)).alias("_row")] * bool(rest),
        F.col("_role._epoch").alias("_epoch"), F.col("_role._scoring").alias("_scoring"))


def _sorted(table: pa.Table, scoring: bool) -> pa.Table:
    """The rows that are scored, or those that train, by ``rn``: shuffles deliver a group's rows in any order, and a
    recomputed task must grow the same trees."""
    rows = table.filter(table["_scoring"] if scoring else pc.invert(table["_scoring"])).combine_chunks()
    return rows.take(pa.array(np.argsort(rows["rn"].to_numpy(), kind="stable")))


def _matrix(rows: pa.Table, cols: list[str] = FEATURES) -> np.ndarray:
    """The columns as doubles, NaN where one is missing."""
    return np.stack([rows[c].to_numpy() for c in cols]).astype(np.float64, copy=False).T


def walk_forward(frame: DataFrame, contamination: float = C.IF_CONTAMINATION_ONLINE,
                 n_trees: int = C.IF_TREES, subsample: int = C.IF_SUBSAMPLE, seed: int = C.IF_SEED,
                 score_rows: str | None = None, pretrained: DataFrame | None = None) -> DataFrame:
    """Score every row of ``frame`` (own rows with ``rn`` and the 5 feature columns)
    with the model in force at that row.  Adds ``if_score`` (0.0 when no model),
    ``if_flag`` and ``if_ready``; the rest of each row passes through unchanged.
    Cold start: no model (score 0) before the 300th feature row.
    ``score_rows``: optional boolean column; rows where it is false only train.
    ``pretrained``: a model table from ``train_static``; then the pre-trained
    schedule applies (model 0 scores until the first refit at feature row 500;
    a series missing from the table gets no score until then).
    """
    x = _roles(frame, pretrained, score_rows)
    out = [c for c in x.columns if c not in ("_epoch", "_scoring")]
    out_schema = _scored_schema(x.select(*out))

    def fit_score(group: pa.Table, model: pa.Table | None = None) -> pa.Table:
        if group.num_rows == 0:  # a model-only cogroup group: nothing to score
            return out_arrow.empty_table()
        scoring = _sorted(group, True)
        epoch = group["_epoch"][0].as_py()
        if scoring.num_rows == 0:
            return out_arrow.empty_table()
        features, ready = _matrix(scoring), True
        if epoch > 0:
            fitted = EpochModel.fit(_matrix(_sorted(group, False)), contamination, n_trees, subsample,
                                    group_seed(seed, scoring["series"][0].as_py(), epoch))
            scores, flags = fitted.score(features)
        elif model is not None and model.num_rows:
            scores, flags = score_with_model(features, model)
        else:
            scores, flags, ready = np.zeros(len(features)), np.zeros(len(features), dtype=bool), False
        return pa.table([*scoring.select(out).columns, pa.array(scores), pa.array(flags), pa.array(np.full(len(scores), ready))],
                        names=out_arrow.names)

    out_arrow = to_arrow_schema(out_schema)
    # Python-heavy groups: spread them over at least a few tasks per core (AQE would
    # otherwise coalesce the small shuffle into about one partition per core)
    spread = _spread(x, ["series", "_epoch"])
    if pretrained is None:
        # one-argument function: applyInArrow would pass the group key to a two-argument one
        def fit_score_cold(group: pa.Table) -> pa.Table:
            return fit_score(group, None)
        scored = spread.groupBy("series", "_epoch").applyInArrow(fit_score_cold, out_schema)
    else:
        m0 = pretrained.withColumn("_epoch", F.lit(0).cast("long"))
        scored = spread.groupBy("series", "_epoch").cogroup(m0.groupBy("series", "_epoch")).applyInArrow(fit_score, out_schema)
    return scored.select(*[c if c in out else F.col("_row")[c].alias(c) for c in frame.columns], "if_score", "if_flag", "if_ready")


def _scored_schema(frame: DataFrame) -> T.StructType:
    return T.StructType(list(frame.schema.fields) + [
        T.StructField("if_score", T.DoubleType()), T.StructField("if_flag", T.BooleanType()),
        T.StructField("if_ready", T.BooleanType())])


def fit_epochs(frame: DataFrame, contamination: float = C.IF_CONTAMINATION_ONLINE, n_trees: int = C.IF_TREES,
               subsample: int = C.IF_SUBSAMPLE, seed: int = C.IF_SEED) -> DataFrame:
    """M5 + J3: the cold schedule's models as a table, one row a (series, epoch), each scoring the same as in
    ``walk_forward``.  Save it (``save_model``) and later score the same or corrected history without fitting.

    Columns that aren't features don't take part.  An epoch that scores no row yet is fitted as well once its
    training rows are there."""
    rows = _roles(frame.select("series", "rn", *FEATURES), None, None)
    fits = rows.where(~F.col("_scoring"))

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        series, epoch = pdf["series"].iloc[0], int(pdf["_epoch"].iloc[0])
        m = EpochModel.fit(_matrix(_sorted(pa.Table.from_pandas(pdf[["rn", "_scoring", *FEATURES]]), False)), contamination, n_trees, subsample, group_seed(seed, series, epoch))
        return m.row(series, epoch)

    # an epoch is there once its last training row is
    last = F.max(F.when(S.feature_index(F.col("rn")) == S.fit_point(F.col("_epoch")), F.lit(True)))
    whole = fits.groupBy("series", "_epoch").agg(last.alias("_whole")).where("_whole").select("series", "_epoch")
    return _spread(fits.join(whole, ["series", "_epoch"]), ["series", "_epoch"]).groupBy("series", "_epoch").applyInPandas(fit, EPOCH_MODEL)


def score_epochs(frame: DataFrame, models: DataFrame) -> DataFrame:
    """The rows of ``frame`` scored by the saved models of their epochs (see ``fit_epochs``): ``if_score``,
    ``if_flag``, ``if_ready``; rows of an epoch without a model get no score."""
    carry = frame.columns
    n = S.feature_index(F.col("rn"))
    rows = frame.withColumn("_epoch", F.when(n.isNull(), F.lit(0)).otherwise(S.scoring_epoch(n, False)).cast("long"))

    def score(pdf: pd.DataFrame, model: pd.DataFrame) -> pd.DataFrame:
        if len(pdf) == 0:
            return pd.DataFrame({c: pd.Series([], dtype=object) for c in carry + ["if_score", "if_flag", "if_ready"]})
        out = pdf[carry].copy()
        if len(model) == 0:
            return out.assign(if_score=0.0, if_flag=False, if_ready=False)
        scores, flags = EpochModel.of(model.iloc[0]).score(out[FEATURES].to_numpy(dtype=np.float64))
        return out.assign(if_score=scores, if_flag=flags, if_ready=True)

    return _spread(rows, ["series", "_epoch"]).groupBy("series", "_epoch").cogroup(
        models.groupBy("series", "_epoch")).applyInPandas(score, _scored_schema(frame))


def _trees(nodes: pa.Table) -> list[isf.Tree]:
    """The trees of one series' node table."""
    cols = {c: nodes[c].to_numpy() for c in NODE_SCHEMA.names if c != "series"}
    order = np.argsort(cols["tree"], kind="stable")
    ends = np.flatnonzero(np.diff(cols["tree"][order])) + 1
    return [isf.tree_from_nodes({c: v[at] for c, v in cols.items()}) for at in np.split(order, ends)]


def _drawn(nodes: pa.Table) -> int:
    """Rows of the largest root."""
    return int(nodes["size"].to_numpy()[nodes["node"].to_numpy() == 0].max())


def score_with_model(X: np.ndarray, model: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Score and flag of each row by a static model table (one series): its scaler, trees and cut."""
    mu, sd = (np.array(model[c][0].as_py(), dtype=np.float64) for c in ("mu", "sd"))
    ok = ~np.isnan(X).any(axis=1)
    scores = np.zeros(len(X))
    flags = np.zeros(len(X), dtype=bool)
    s = isf.anomaly_score((X[ok] - mu) / sd, _trees(model), _drawn(model))
    scores[ok] = s
    flags[ok] = s > model["cut"][0].as_py()
    return scores, flags


#: Rows scored with one copy of a static forest: 7 doubles each, so a task holds some 15 MB of them.
ROWS_PER_TASK = 1 << 18


def train_static(features: DataFrame, contamination: float = C.IF_CONTAMINATION_OFFLINE,
                 n_trees: int = C.IF_TREES, subsample: int = C.IF_SUBSAMPLE, seed: int = C.IF_SEED,
                 rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """M2 + M3 + M5 (offline): per series, scaler + forest + flag cut over all feature rows.

    Returns the model table (node rows carrying ``mu``/``sd`` arrays and ``cut``),
    checkpointed to the shared checkpoint folder so it is computed once and can
    be saved/loaded as Parquet.  The cut is the (1 - contamination) quantile of
    the training scores, linear and exact at any size (``exact_quantile``)."""
    from tickwatch.operators.quantiles import exact_quantile
    from tickwatch.session import checkpoint_dir
    checkpoint_dir(features.sparkSession)
    cols = ["s_" + c[2:] for c in FEATURES]
    # an eager fit: the feature rows are read several times (scaler, sizes, sampling, scoring)
    feats = features.select("series", "seq", *FEATURES).checkpoint()
    stats = feats.groupBy("series").agg(
        F.array(*[F.avg(c) for c in FEATURES]).alias("mu"),
        F.array(*[F.when(F.stddev_pop(c) > 0, F.stddev_pop(c)).otherwise(F.lit(1.0)) for c in FEATURES])
        .alias("sd"),
        F.count(F.lit(1)).alias("_n")).checkpoint()
    scaled = feats.join(stats, "series").select(
        "series", "seq", *[((F.col(c) - F.col("mu")[i]) / F.col("sd")[i]).alias(o)
                           for i, (c, o) in enumerate(zip(FEATURES, cols))])
    nodes = fit_static(scaled, n_trees, subsample, seed, sizes=stats.select("series", "_n")).checkpoint()
    scores = score_static(scaled, nodes, subsample, rows_per_task, sizes=stats.select("series", "_n"))
    cut = exact_quantile(scores.select("series", "if_score").checkpoint(), "series", "if_score", 1.0 - contamination, "cut")
    model = nodes.join(stats.drop("_n"), "series").join(cut, "series").checkpoint()
    return model


def _spread(df: DataFrame, keys: list[str]) -> DataFrame:
    spark = df.sparkSession
    from tickwatch.session import default_parallelism
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * default_parallelism(spark))
    return df.repartition(n, *keys)


NODE_SCHEMA = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("tree", T.LongType()),
    T.StructField("node", T.LongType()), T.StructField("feature", T.LongType()),
    T.StructField("threshold", T.DoubleType()), T.StructField("left", T.LongType()),
    T.StructField("right", T.LongType()), T.StructField("size", T.LongType()),
    T.StructField("depth", T.LongType())])


def fit_static(features: DataFrame, n_trees: int = C.IF_TREES, subsample: int = C.IF_SUBSAMPLE,
               seed: int = C.IF_SEED, oversample: float = 1.5, sizes: DataFrame | None = None) -> DataFrame:
    """M2 (static): one forest per series over all its scaled feature rows
    (columns ``s_price .. s_z``, see ``standardize``); returns the node table.

    Sampling is two-stage so that most rows cost one hash: a row enters the
    series' pool with probability q = min(1, trees x c / n) (c = oversample x
    subsample), and a pool row joins tree t with probability c / (n q); overall
    each tree sees each row with probability c / n, about c candidates, of which
    the first ``subsample`` by hash are kept (``row_number`` per (series, tree))."""
    cols = ["s_" + c[2:] for c in FEATURES]
    c = oversample * subsample
    unit = float(1 << 30)
    if sizes is None:  # rows per series; any close count works (it only sets sampling rates)
        sizes = features.groupBy("series").agg(F.count(F.lit(1)).alias("_n"))
    x = features.join(sizes.select("series", "_n"), "series")
    q = F.least(F.lit(1.0), F.lit(n_trees * c) / F.col("_n"))
    p = F.least(F.lit(1.0), F.lit(c) / (F.col("_n") * q))

    def u(*parts):
        return (F.abs(F.xxhash64(*parts)) % F.lit(1 << 30)).cast("double") / F.lit(unit)

    pool = x.where(u(F.lit(seed), F.col("series"), F.col("seq")) < q)
    hits = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(n_trees - 1).cast("long")),
                    lambda t: u(F.lit(seed + 1), t, F.col("series"), F.col("seq")) < p)
    ex = pool.select("series", "seq", *cols, F.explode(hits).alias("tree"))
    ex = ex.withColumn("_h", F.xxhash64(F.lit(seed + 2), F.col("tree"), F.col("series"), F.col("seq")))
    ranked = ex.withColumn("_k", F.row_number().over(Window.partitionBy("series", "tree").orderBy("_h", "seq")))
    picked = ranked.where(F.col("_k") <= subsample).drop("_k", "_h")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("seq", kind="stable")
        X = pdf[cols].to_numpy(dtype=np.float64)
        series, tree = pdf["series"].iloc[0], int(pdf["tree"].iloc[0])
        m = X.shape[0]
        import math
        t = isf.build_tree(X, np.random.default_rng(group_seed(seed, series, "tree", tree)),
                           int(math.ceil(math.log2(max(min(m, subsample), 2)))))
        nodes = pd.DataFrame(isf.tree_nodes(t))
        nodes.insert(0, "tree", tree)
        nodes.insert(0, "series", series)
        return nodes

    return _spread(picked, ["series", "tree"]).groupBy("series", "tree").applyInPandas(build, NODE_SCHEMA)


def score_static(rows: DataFrame, nodes: DataFrame, subsample: int = C.IF_SUBSAMPLE,
                 rows_per_task: int = ROWS_PER_TASK, sizes: DataFrame | None = None) -> DataFrame:
    """M3 (static): anomaly score of every row against its series' forest.

    Rows are spread over ``parts(series) = ceil(n_series / rows_per_task)``
    hash parts; the (bounded, <= trees x 511 nodes) forest is replicated once per
    part and cogrouped, so a hot series is scored by many tasks.  Replication adds
    at most 51,100 node rows per ``rows_per_task`` scored rows (~20 % at 2^18)."""
    cols = ["s_" + c[2:] for c in FEATURES]
    if sizes is None:
        sizes = rows.groupBy("series").agg(F.count(F.lit(1)).alias("_n"))
    sizes = sizes.select("series", F.greatest(F.lit(1), F.ceil(F.col("_n") / F.lit(rows_per_task)))
                         .cast("long").alias("_parts"))
    r = rows.join(sizes.select("series", "_parts"), "series") \
        .withColumn("_part", F.pmod(F.xxhash64(F.col("seq")), F.col("_parts")))
    node_parts = sizes.select(F.col("series").alias("_ns"), F.col("_parts").alias("_np"))
    reps = nodes.join(node_parts, nodes["series"] == node_parts["_ns"]).drop("_ns") \
        .select(*nodes.columns, F.explode(F.sequence(F.lit(0).cast("long"), F.col("_np") - 1)).alias("_part"))
    schema = T.StructType(list(rows.schema.fields) + [T.StructField("if_score", T.DoubleType())])
    keep, arrow = rows.columns, to_arrow_schema(schema)

    def score(group: pa.Table, forest: pa.Table) -> pa.Table:
        if group.num_rows == 0:
            return arrow.empty_table()
        s = isf.anomaly_score(_matrix(group, cols), _trees(forest), min(subsample, _drawn(forest))) if forest.num_rows \
            else np.zeros(group.num_rows)
        return pa.table([*group.select(keep).columns, pa.array(s)], names=arrow.names)

    return r.groupBy("series", "_part").cogroup(reps.groupBy("series", "_part")).applyInArrow(score, schema)
