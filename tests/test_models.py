"""Retrain schedule (closed form vs the buffer simulation), forest properties,
walk-forward shape, sequence model shape."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.functions import isoforest as isf
from tickwatch.operators import schedule as S


def simulate(n_rows, pretrained):
    """Buffer simulation of the online retrain rule: returns fits (n, first, last) and scorer per row."""
    buf, ticks, model, fits, scorer = [], 0, (0 if pretrained else None), [], {}
    for n in range(1, n_rows + 1):
        buf.append(n)
        ticks += 1
        if (model is None and len(buf) >= C.IF_WARMUP) or (model is not None and ticks >= C.IF_RETRAIN):
            fits.append((n, buf[0], buf[-1]))
            model = len(fits)
            ticks = 0
            buf = buf[-C.IF_KEEP:]
        scorer[n] = model
    return fits, scorer


@pytest.mark.parametrize("pretrained,n_rows", [(False, 1400), (True, 1599), (False, 5000), (True, 5000)])
def test_schedule_closed_form(spark, pretrained, n_rows):
    fits, scorer = simulate(n_rows, pretrained)
    if not pretrained and n_rows == 1400:
        assert fits == [(300, 1, 300), (800, 1, 800), (1300, 501, 1300)]
    if pretrained and n_rows == 1599:
        assert fits == [(500, 1, 500), (1000, 201, 1000), (1500, 701, 1500)]
    df = spark.range(1, n_rows + 1).select(F.col("id").alias("n"))
    lo, hi = S.train_range(S.scoring_epoch(F.col("n"), pretrained), pretrained)
    rows = df.select("n", S.scoring_epoch(F.col("n"), pretrained).alias("e"), lo.alias("lo"), hi.alias("hi"),
                     S.training_epochs(F.col("n"), pretrained).alias("tr")).collect()
    for r in rows:
        exp = scorer[r["n"]]
        assert r["e"] == (exp or 0)
        if r["e"]:
            assert (r["hi"], r["lo"], r["hi"]) == fits[r["e"] - 1]
        members = [k + 1 for k, (_, a, b) in enumerate(fits) if a <= r["n"] <= b]
        assert [k for k in r["tr"] if k <= len(fits)] == members


def test_forest_properties():
    rng = np.random.default_rng(0)
    X = rng.normal(size=(800, 5))
    X[0] = 8.0  # planted outlier
    forest = isf.fit_forest(X, 100, 256, 42)
    s = isf.forest_score(X, forest)
    assert forest.size[:100].tolist() == [256] * 100 and forest.depth.max() <= 8
    assert np.all((s > 0) & (s <= 1))
    assert int(np.argmax(s)) == 0
    thr = isf.flag_threshold(s, 0.01)
    assert 5 <= int((s > thr).sum()) <= 9
    assert np.allclose(s, isf.forest_score(X, isf.fit_forest(X, 100, 256, 42)))
    # every leaf size sums back to the subsample per tree
    leaves = forest.feature < 0
    assert np.bincount(forest.tree[leaves], weights=forest.size[leaves]).tolist() == [256.0] * 100


def test_walk_forward_shape(spark):
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    f = detect.iforest_frame(events_ticks(spark, "/root/testdata/sf0.01"), EVENTS_PARAMS, Layout(block_rows=500))
    g = f.groupBy("series").agg(F.count("*").alias("n"), F.sum(F.col("if_ready").cast("int")).alias("ready"),
                                F.sum(F.col("if_flag").cast("int")).alias("flags"),
                                F.min(F.when(F.col("if_ready"), F.col("rn"))).alias("first"),
                                F.max("if_score").alias("mx")).collect()
    for r in g:
        assert r["first"] == C.IF_WARMUP + C.IF_WINDOW - 1
        assert r["ready"] == r["n"] - (C.IF_WARMUP + C.IF_WINDOW - 2)
        assert 0 < r["flags"] < 0.05 * r["ready"]
        assert 0 < r["mx"] <= 1


def test_static_forest_nodes(spark):
    from tickwatch.operators.iforest import fit_static, score_static, standardize
    from tickwatch.operators.stats import FEATURES, if_features
    from tickwatch.plans import detect
    from tickwatch.schema import Layout, events_ticks
    b = detect.blocked(events_ticks(spark, "/root/testdata/sf0.01"), Layout(), 21)
    f = if_features(b, training=True).where(F.col("own") & F.col("f_price").isNotNull())
    s = standardize(f, FEATURES, ["series"])
    nodes = fit_static(s, n_trees=20)
    per_tree = nodes.groupBy("series", "tree").agg(F.max(F.when(F.col("node") == 0, F.col("size"))).alias("root"))
    assert {r["root"] for r in per_tree.collect()} == {256}
    scored = score_static(s.select("series", "seq", *[c for c in s.columns if c.startswith("s_")]), nodes,
                          rows_per_task=300)
    r = scored.agg(F.count("*").alias("n"), F.min("if_score").alias("lo"), F.max("if_score").alias("hi")).first()
    assert r["n"] == s.count() and 0 < r["lo"] <= r["hi"] <= 1


def test_sequence_model(spark):
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    fr = detect.full_frame(events_ticks(spark, "/root/testdata/sf0.01"), EVENTS_PARAMS, Layout(block_rows=700),
                           iforest=False, sequence_k=4)
    r = fr.agg(F.count("seq_err").alias("n"), F.min("seq_err").alias("lo"),
               F.sum(F.col("err_flag").cast("int")).alias("flags")).first()
    assert r["n"] == 10000 - 5 * (C.SEQ_LEN - 1)
    assert r["lo"] >= 0 and r["flags"] > 0


def test_pretrained_schedule_scores_from_first_row(spark):
    from __spark_entry__ import queries
    df = queries()["iforest_scores_pretrained"](spark, "/root/testdata/sf0.01")
    r = df.agg(F.count("*").alias("n"), F.sum(F.col("if_ready").cast("int")).alias("ready"),
               F.sum((F.col("if_score") > 0).cast("int")).alias("scored"),
               F.sum(F.col("if_flag").cast("int")).alias("flags")).first()
    assert r["n"] == 10000 and r["ready"] == 10000
    assert r["scored"] == 10000 - 5 * (C.IF_WINDOW - 1)
    assert 0 < r["flags"] < 1000


def test_pretrained_fallback_for_series_without_model(spark):
    """A series missing from the model table follows the cold schedule (M5 fallback)."""
    from tickwatch.operators.iforest import train_static, walk_forward
    from tickwatch.operators.stats import FEATURES, if_features
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    t = events_ticks(spark, "/root/testdata/sf0.01")
    b = detect.blocked(t, Layout(), 21)
    f = if_features(b, training=True).where(F.col("own") & F.col("f_price").isNotNull())
    model = train_static(f.where(F.col("series") != "click"), n_trees=20)
    fr = detect.rule_frame(t, EVENTS_PARAMS, Layout(), features="online")
    out = walk_forward(fr.select("series", "seq", "rn", *FEATURES), pretrained=model)
    g = {r["series"]: r for r in out.groupBy("series").agg(
        F.min(F.when(F.col("if_ready"), F.col("rn"))).alias("first")).collect()}
    assert g["click"]["first"] == C.IF_WARMUP + C.IF_WINDOW - 1
    assert all(g[s]["first"] == 1 for s in g if s != "click")


def test_walk_forward_independent_of_partitioning(spark):
    """Same seed, same rows -> same scores whatever the block size / shuffle layout."""
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    t = events_ticks(spark, "/root/testdata/sf0.01")
    a = detect.iforest_frame(t, EVENTS_PARAMS, Layout(block_rows=4096)).select("series", "seq", "if_score")
    b = detect.iforest_frame(t.repartition(3), EVENTS_PARAMS, Layout(block_rows=700, bucket_rows=333)) \
        .select("series", "seq", "if_score")
    assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))


def _windows(t, n=C.SEQ_LEN):
    """Per series of a pandas table of ticks: standardised windows by the scaler over all training windows."""
    out = {}
    for s, g in t.sort_values(["t_us", "seq"]).groupby("series"):
        w = np.lib.stride_tricks.sliding_window_view(g["price"].to_numpy(), n)
        train = w[:-1]
        out[s] = (g["seq"].to_numpy()[n - 1:], (w - train.mean()) / train.std())
    return out


@pytest.fixture(scope="module")
def ticks():
    import pyarrow.parquet as pq
    t = pq.read_table("/root/testdata/sf0.01/events.parquet").to_pandas()
    t = t[t["value"].notna()]
    return t.assign(series=t["event_type"], seq=t["event_id"], price=t["value"], t_us=t["ts"].astype("int64"))


def test_recon_scores_equal_brute_force(spark, ticks):
    """Errors of the principal components of all training windows, and no window in the plan."""
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    w = _windows(ticks)
    train = np.concatenate([x[:-1] for _, x in w.values()])
    mean = train.mean(0)
    _, v = np.linalg.eigh(np.cov(train.T, bias=True))
    p = v[:, ::-1][:, :8]

    def errors(x):
        return np.mean(((x - mean) - (x - mean) @ p @ p.T) ** 2, axis=1)
    want = {(s, q): e for s, (seq, x) in w.items() for q, e in zip(seq, errors(x))}
    base = errors(train)
    fr = detect.full_frame(events_ticks(spark, "/root/testdata/sf0.01"), EVENTS_PARAMS, Layout(block_rows=700), iforest=False)
    assert "collect_list" not in fr._jdf.queryExecution().optimizedPlan().toString()
    got = {(r["series"], r["seq"]): r["seq_err"] for r in fr.where("seq_err IS NOT NULL").select("series", "seq", "seq_err").collect()}
    assert got.keys() == want.keys()
    assert max(abs(got[k] - want[k]) for k in want) < 1e-9
    model = detect.fit_sequence(events_ticks(spark, "/root/testdata/sf0.01"))
    assert model.base_threshold == pytest.approx(base.mean() + 3 * base.std(), rel=1e-9)


def test_plug_in_model(spark, ticks):
    """Any function of windows made once a worker: here each price is foretold by the one before."""
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks

    def make_predict():
        import numpy as np
        return lambda windows: np.concatenate([windows[:, :1], windows[:, :-1]], axis=1)

    t = events_ticks(spark, "/root/testdata/sf0.01")
    model = detect.fit_sequence(t, Layout(block_rows=700), make_predict=make_predict)
    fr = detect.full_frame(t, EVENTS_PARAMS, Layout(block_rows=300), iforest=False, sequence_model=model)
    got = {(r["series"], r["seq"]): r["seq_err"] for r in fr.where("seq_err IS NOT NULL").select("series", "seq", "seq_err").collect()}
    want = {(s, q): e for s, (seq, x) in _windows(ticks).items() for q, e in zip(seq, (np.diff(x, axis=1) ** 2).sum(1) / C.SEQ_LEN)}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < 1e-9


def test_sequence_model_needs_a_window(spark):
    from tickwatch.plans import detect
    from tickwatch.schema import events_ticks
    with pytest.raises(ValueError, match="window"):
        detect.fit_sequence(events_ticks(spark, "/root/testdata/sf0.001").limit(20))


def _online_features(spark, sf="/root/testdata/sf0.01"):
    from tickwatch.operators.stats import FEATURES
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    fr = detect.rule_frame(events_ticks(spark, sf), EVENTS_PARAMS, Layout(block_rows=900), features="online")
    return fr.select("series", "seq", "rn", "price", *FEATURES).checkpoint()


def test_saved_epoch_models_score_the_same(spark, tmpdir_path):
    """History scored from the saved table of (series, epoch) models equals the walk-forward scores."""
    from tickwatch.operators.iforest import fit_epochs, score_epochs, walk_forward
    from tickwatch.sources.files import load_model, save_model
    fr = _online_features(spark)
    want = walk_forward(fr)
    save_model(fit_epochs(fr), tmpdir_path + "/m")
    models = load_model(spark, tmpdir_path + "/m")
    got = score_epochs(fr, models)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    # one model a fit of the schedule
    n = {r["series"]: r["n"] for r in fr.groupBy("series").agg((F.max("rn") - 19).alias("n")).collect()}
    assert models.count() == sum(max(0, (v - C.IF_WARMUP) // C.IF_RETRAIN + 1) for v in n.values())
    # without its model an epoch isn't scored
    cut = score_epochs(fr, models.where("_epoch < 2"))
    assert cut.where("if_ready").count() == want.where((F.col("rn") < C.IF_WARMUP + C.IF_RETRAIN + 19) & F.col("if_ready")).count()


def test_scores_by_sql_over_the_node_table(spark):
    """The tree walk and the score as a recursive query in another engine give the scores and flags."""
    import duckdb
    from tickwatch.operators.iforest import fit_epochs, walk_forward
    fr = _online_features(spark).where("series = 'view'")
    scored = walk_forward(fr, n_trees=7).toPandas()
    models = fit_epochs(fr, n_trees=7).toPandas()
    rows = scored[scored["if_ready"]].sample(120, random_state=1)
    con = duckdb.connect()
    con.register("m", models)
    con.register("r", rows)
    got = con.execute("""
        WITH RECURSIVE e AS (SELECT *, (rn - 19 - 300) // 500 + 1 AS epoch FROM r),
        x AS (SELECT seq, epoch, [(f_price - mu[1]) / sd[1], (f_r1 - mu[2]) / sd[2], (f_r5 - mu[3]) / sd[3],
                                  (f_sigma - mu[4]) / sd[4], (f_z - mu[5]) / sd[5]] AS v FROM e JOIN m ON m._epoch = e.epoch),
        n AS (SELECT _epoch, generate_subscripts(feature, 1) - 1 AS node, unnest(feature) AS f, unnest(threshold) AS t,
                     unnest("left") AS l, unnest("right") AS rt, unnest(size) AS size, unnest(depth) AS depth FROM m),
        w AS (SELECT x.seq, x.epoch, x.v, tree AS node FROM x, range(7) q(tree)
              UNION ALL
              SELECT w.seq, w.epoch, w.v, CASE WHEN w.v[n.f + 1] < n.t THEN n.l ELSE n.rt END
              FROM w JOIN n ON n._epoch = w.epoch AND n.node = w.node WHERE n.f >= 0),
        leaf AS (SELECT w.seq, w.epoch, n.depth, n.size FROM w JOIN n ON n._epoch = w.epoch AND n.node = w.node WHERE n.f < 0),
        h AS (SELECT seq, epoch, avg(depth + CASE WHEN size > 2 THEN 2 * (ln(size - 1) + 0.5772156649015329) - 2 * (size - 1) / size
                                               WHEN size = 2 THEN 1 ELSE 0 END) AS h, count(*) AS n FROM leaf GROUP BY ALL)
        SELECT seq, pow(2, -h / (2 * (ln(subsample - 1) + 0.5772156649015329) - 2 * (subsample - 1) / subsample)) AS score,
               score > cut AS flag, n FROM h JOIN m ON m._epoch = h.epoch""").fetchdf().set_index("seq")
    rows = rows.set_index("seq")
    assert (got["n"] == 7).all() and len(got) == len(rows)
    assert np.abs(got["score"] - rows["if_score"].loc[got.index]).max() < 1e-12
    assert (got["flag"] == rows["if_flag"].loc[got.index]).all()


def test_static_scores_in_bounded_memory():
    """Scoring holds no path length for every row and tree at once, and equals the mean over single trees."""
    import tracemalloc
    rng = np.random.default_rng(0)
    X = rng.normal(size=(40_001, 5))
    trees = [isf.build_tree(X[i * 64:(i + 1) * 64], np.random.default_rng(i), 6) for i in range(100)]
    tracemalloc.start()
    s = isf.anomaly_score(X, trees, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6  # 100 x 40,001 doubles are 32 MB
    h = np.mean([isf.path_lengths(X, t) for t in trees], axis=0)
    assert np.array_equal(s, np.power(2.0, -h / isf.c_factor([64])[0]))


def test_forest_is_that_of_single_nodes():
    """The forest grown in segments splits each node's rows at its threshold: sizes as counted row by row."""
    rng = np.random.default_rng(3)
    for X in (rng.normal(size=(200, 5)), np.round(rng.normal(size=(150, 5))), np.ones((9, 5)), rng.normal(size=(1, 5))):
        f = isf.fit_forest(X, 10, 256, 7)
        size = np.zeros(len(f.feature), dtype=int)
        for tree in range(10):
            for x in X:
                node = tree
                size[node] += 1
                while f.feature[node] >= 0:
                    node = f.left[node] if x[f.feature[node]] < f.threshold[node] else f.right[node]
                    size[node] += 1
        assert size.tolist() == f.size.tolist()


def test_walk_forward_carries_columns(spark):
    """Columns that aren't features come out as they went in, arrays, times and nulls too, with a model or without."""
    from tickwatch.operators.iforest import train_static, walk_forward
    fr = _online_features(spark, "/root/testdata/sf0.001").withColumns({
        "tags": F.when(F.col("seq") % 3 > 0, F.array(F.col("series"), F.lit(None).cast("string"))),
        "at": F.timestamp_micros("seq").cast("timestamp_ntz"), "none": F.lit(None).cast("double")})
    model = train_static(fr.where("f_price IS NOT NULL AND series <> 'view'"), n_trees=5)
    for out in (walk_forward(fr), walk_forward(fr, n_trees=5, pretrained=model)):
        assert out.columns == [*fr.columns, "if_score", "if_flag", "if_ready"]
        back = out.drop("if_score", "if_flag", "if_ready")
        assert back.exceptAll(fr).isEmpty() and fr.exceptAll(back).isEmpty()


def test_full_frame_exchanges(spark):
    """Joins with what is known of each series don't gather a series' rows, and all windows of the blocks after the
    sequence model's errors share one exchange."""
    import re
    from tickwatch.plans import detect
    from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64k")
    try:
        fr = detect.full_frame(events_ticks(spark, "/root/testdata/sf0.01"), EVENTS_PARAMS, Layout(block_rows=700), iforest=False)
        plan = fr._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    keys = [re.sub(r"#\d+L?|, \d+$", "", d) for d in dealt]
    assert keys.count("series") == 1  # the counts that number the rows
    assert "series, block, _sub" not in keys
    assert keys.count("series, block") == 2
