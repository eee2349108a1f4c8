"""Stream = batch: the same ticks split into time-ordered files, rows shuffled
inside each file, processed with availableNow, give the batch result; a
restart from the checkpoint neither loses nor duplicates rows."""

import os
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from tickwatch.plans import detect
from tickwatch.schema import EVENTS_PARAMS, Layout, events_ticks
from tickwatch.streaming.stream import StreamDetector, lifetime_totals, parquet_file_ticks, read_events, read_feed

SF = "/root/testdata/sf0.001"
COLS = ["series", "price", "pct_change", "abs_change", "severity"]


def _write_chunks(spark, root, n_files):
    t = events_ticks(spark, SF).select("series", "ts", "seq", "price").toPandas()
    t = t.sort_values(["ts", "seq"]).reset_index(drop=True)
    os.makedirs(root, exist_ok=True)
    bounds = [round(i * len(t) / n_files) for i in range(n_files + 1)]
    base = time.time() - 1000
    for i in range(n_files):
        part = t.iloc[bounds[i]:bounds[i + 1]].sample(frac=1.0, random_state=i)
        path = os.path.join(root, f"part-{i:03d}.parquet")
        part.to_parquet(path, index=False, coerce_timestamps="us")
        os.utime(path, (base + i, base + i))


def _batch_events(spark):
    ev = detect.rule_events(events_ticks(spark, SF), EVENTS_PARAMS, Layout(block_rows=64))
    return sorted(map(tuple, ev.select(*COLS, F.array_join("types", ",")).collect()))


def _stream_events(spark, out):
    ev = read_events(spark, out)
    return sorted(map(tuple, ev.select(*COLS, F.array_join("types", ",")).collect()))


def test_stream_equals_batch(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    _write_chunks(spark, src, 7)
    out = os.path.join(tmpdir_path, "events")
    det = StreamDetector(events_path=out, feed_path=os.path.join(tmpdir_path, "feed"),
                         params=EVENTS_PARAMS,
                         layout=Layout(block_rows=64))
    q = det.start(parquet_file_ticks(spark, src, max_files_per_trigger=1),
                  checkpoint=os.path.join(tmpdir_path, "ckpt"), available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    assert _stream_events(spark, out) == _batch_events(spark)
    from tickwatch.streaming.stream import run_stats
    st = run_stats(q)
    assert st["batches"] == 7 and st["total_rows"] == events_ticks(spark, SF).count()
    feed = read_feed(spark, os.path.join(tmpdir_path, "feed"))
    assert feed.count() == events_ticks(spark, SF).count()  # < 500 ticks per series at sf0.001


def test_restart_no_duplicates(spark, tmpdir_path):
    src = os.path.join(tmpdir_path, "src")
    _write_chunks(spark, src, 4)
    out = os.path.join(tmpdir_path, "events")
    kw = dict(events_path=out, params=EVENTS_PARAMS,
              layout=Layout(block_rows=64))
    ckpt = os.path.join(tmpdir_path, "ckpt")
    # first run sees only the first two files
    src2 = os.path.join(tmpdir_path, "src2")
    os.makedirs(src2)
    files = sorted(os.listdir(src))
    for f in files[:2]:
        os.link(os.path.join(src, f), os.path.join(src2, f))
    q = StreamDetector(**kw).start(parquet_file_ticks(spark, src2, 1), checkpoint=ckpt, available_now=True)
    q.awaitTermination(600)
    for f in files[2:]:
        os.link(os.path.join(src, f), os.path.join(src2, f))
    q = StreamDetector(**kw).start(parquet_file_ticks(spark, src2, 1), checkpoint=ckpt, available_now=True)
    q.awaitTermination(600)
    assert _stream_events(spark, out) == _batch_events(spark)


def test_failed_batch_is_replayed(spark, tmpdir_path):
    """A batch that fails after its events are written runs again from the state before it: nothing lost or doubled."""
    src = os.path.join(tmpdir_path, "src")
    _write_chunks(spark, src, 4)
    out, ckpt = os.path.join(tmpdir_path, "events"), os.path.join(tmpdir_path, "ckpt")
    kw = dict(events_path=out, feed_path=os.path.join(tmpdir_path, "feed"), params=EVENTS_PARAMS, layout=Layout(block_rows=64))

    class Failing(StreamDetector):
        def process(self, batch, batch_id):
            super().process(batch, batch_id)
            if batch_id == 2:
                raise RuntimeError("lost")

    q = Failing(**kw).start(parquet_file_ticks(spark, src, 1), checkpoint=ckpt, available_now=True)
    with pytest.raises(Exception, match="lost"):
        q.awaitTermination(600)
    q = StreamDetector(**kw).start(parquet_file_ticks(spark, src, 1), checkpoint=ckpt, available_now=True)
    q.awaitTermination(600)
    assert _stream_events(spark, out) == _batch_events(spark)
    # totals live on over the restart, and count the replayed batch once
    ticks, events = events_ticks(spark, SF).count(), len(_batch_events(spark))
    totals = lifetime_totals(spark, os.path.join(ckpt, "tickwatch-totals")).first()
    assert tuple(totals) == (4, ticks, events, events / ticks)
    assert read_feed(spark, kw["feed_path"], None).count() == ticks


def _seconds(spark, root, name, rows, order):
    """A file of ticks (seq, second, price) of one series."""
    import datetime as dt
    os.makedirs(root, exist_ok=True)
    path = os.path.join(root, name)
    pd.DataFrame([("s", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), i, p) for i, s, p in rows],
                 columns=["series", "ts", "seq", "price"]).to_parquet(path, index=False, coerce_timestamps="us")
    os.utime(path, (time.time() - 1000 + order,) * 2)


@pytest.mark.parametrize("late", ["as_arrived", "drop"])
def test_late_tick(spark, tmpdir_path, late):
    """Case K: a tick older than those of earlier batches skips the gated rules but counts as the newest row;
    with late="drop" the watermark keeps it out, but not a tick of the newest time."""
    src = os.path.join(tmpdir_path, "src")
    _seconds(spark, src, "a.parquet", [(0, 10, 100.0), (1, 20, 100.0)], 0)
    _seconds(spark, src, "b.parquet", [(2, 15, 200.0), (3, 20, 100.5)], 1)
    _seconds(spark, src, "c.parquet", [(4, 25, 101.0)], 2)
    feed = os.path.join(tmpdir_path, "feed")
    det = StreamDetector(events_path=os.path.join(tmpdir_path, "ev"), feed_path=feed, late=late)
    q = det.start(parquet_file_ticks(spark, src, 1), checkpoint=os.path.join(tmpdir_path, "ckpt"), available_now=True)
    q.awaitTermination(600)
    assert q.exception() is None
    got = [(r["seq"], r["rn"], r["anomaly"]) for r in read_feed(spark, feed).orderBy("rn").collect()]
    if late == "drop":
        assert got == [(0, 1, False), (1, 2, False), (3, 3, False), (4, 4, True)]
    else:
        # numbered as it arrived; the tick after it sees a change of -99.5 %
        assert got == [(0, 1, False), (1, 2, False), (2, 3, False), (3, 4, True), (4, 5, True)]
    assert [r["seq"] for r in read_feed(spark, feed, 2).orderBy("rn").collect()] == [3, 4]


def test_state_is_the_engines_own(spark, tmpdir_path):
    """Each series' last row number and last ticks can be read from the query's state store."""
    src = os.path.join(tmpdir_path, "src")
    _write_chunks(spark, src, 3)
    ckpt = os.path.join(tmpdir_path, "ckpt")
    det = StreamDetector(events_path=os.path.join(tmpdir_path, "events"), params=EVENTS_PARAMS)
    det.start(parquet_file_ticks(spark, src, 1), checkpoint=ckpt, available_now=True).awaitTermination(600)
    state = spark.read.format("statestore").load(ckpt)
    got = {r["s"]: (r["rn"], r["n"]) for r in state.select(
        F.col("key.series").alias("s"), F.col("value.groupState.rn").alias("rn"), F.size("value.groupState.price").alias("n")).collect()}
    sizes = {r["series"]: r["count"] for r in events_ticks(spark, SF).groupBy("series").count().collect()}
    assert got == {s: (n, min(n, det.tail_rows())) for s, n in sizes.items()}


def test_stream_equals_batch_with_forest(spark, tmpdir_path):
    """Walk-forward forest in a stream: context rows only train, new rows are scored by
    the same fits (same rows, same seeds) as in the batch plan."""
    from tickwatch.plans.detect import iforest_frame
    sf = "/root/testdata/sf0.01"
    t = events_ticks(spark, sf).select("series", "ts", "seq", "price").toPandas()
    t = t.sort_values(["ts", "seq"]).reset_index(drop=True)
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = time.time() - 1000
    for i, part in enumerate([t.iloc[:2500], t.iloc[2500:7000], t.iloc[7000:]]):
        p = os.path.join(src, f"part-{i}.parquet")
        part.sample(frac=1.0, random_state=i).to_parquet(p, index=False, coerce_timestamps="us")
        os.utime(p, (base + i, base + i))
    out = os.path.join(tmpdir_path, "events")
    det = StreamDetector(events_path=out, params=EVENTS_PARAMS,
                         layout=Layout(block_rows=1000), iforest=True)
    q = det.start(parquet_file_ticks(spark, src, 1), checkpoint=os.path.join(tmpdir_path, "ckpt"),
                  available_now=True)
    q.awaitTermination(900)
    assert q.exception() is None
    got = read_events(spark, out).select("series", "price", "if_score", F.array_join("types", ",").alias("t"))
    b = iforest_frame(events_ticks(spark, sf), EVENTS_PARAMS, Layout(block_rows=1000))
    from tickwatch.operators.rules import fired_types
    b = b.withColumn("types", F.concat("rule_types", fired_types([("iforest_anomaly", F.col("if_flag"))])))
    exp = detect.event_record(b, types="types", if_score="if_score").select(
        "series", "price", "if_score", F.array_join("types", ",").alias("t"))
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, exp.collect()))


def test_minute_counts_stream(spark, tmpdir_path):
    """Watermark + tumbling window over a file stream of events, memory sink."""
    from tickwatch.streaming.stream import minute_counts_stream
    src = os.path.join(tmpdir_path, "src")
    _write_chunks(spark, src, 3)
    ticks = parquet_file_ticks(spark, src, 1)
    q = (minute_counts_stream(ticks, "1 day").writeStream.outputMode("append").format("memory")
         .queryName("tw_minutes").option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.table("tw_minutes").groupBy().sum("count").first()[0] or 0
    # append mode emits only minutes closed by the watermark: never more than all ticks
    total = events_ticks(spark, SF).count()
    assert 0 < got <= total


def test_stream_equals_batch_with_sequence_model(spark, tmpdir_path):
    """Sequence model in a stream: errors, adaptive threshold and flags equal the batch plan
    (context rows give the 60-price windows and the last 300 errors)."""
    sf = "/root/testdata/sf0.01"
    model = detect.fit_sequence(events_ticks(spark, sf), Layout(), 4)
    t = events_ticks(spark, sf).select("series", "ts", "seq", "price").toPandas()
    t = t.sort_values(["ts", "seq"]).reset_index(drop=True)
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = time.time() - 1000
    for i, part in enumerate([t.iloc[:3000], t.iloc[3000:6500], t.iloc[6500:]]):
        p = os.path.join(src, f"part-{i}.parquet")
        part.sample(frac=1.0, random_state=i).to_parquet(p, index=False, coerce_timestamps="us")
        os.utime(p, (base + i, base + i))
    out = os.path.join(tmpdir_path, "events")
    det = StreamDetector(events_path=out, params=EVENTS_PARAMS,
                         layout=Layout(block_rows=1000), sequence_model=model)
    q = det.start(parquet_file_ticks(spark, src, 1), checkpoint=os.path.join(tmpdir_path, "ckpt"),
                  available_now=True)
    q.awaitTermination(900)
    assert q.exception() is None
    got = read_events(spark, out).select("series", "price", "lstm_score", F.array_join("types", ",").alias("t"))
    fr = detect.full_frame(events_ticks(spark, sf), EVENTS_PARAMS, Layout(block_rows=1000), iforest=False,
                           sequence_model=model)
    from tickwatch.operators.rules import fired_types
    fr = fr.withColumn("types", F.concat("rule_types", fired_types([("lstm_anomaly", F.coalesce("err_flag", F.lit(False)))]))) \
        .withColumn("lstm_score", F.coalesce("ratio", F.lit(0.0)))
    exp = detect.event_record(fr, types="types", lstm_score="lstm_score").select(
        "series", "price", "lstm_score", F.array_join("types", ",").alias("t"))
    a, b = sorted(map(tuple, got.collect())), sorted(map(tuple, exp.collect()))
    assert len(a) == len(b) and any("lstm_anomaly" in r[3] for r in b)
    assert a == b


def test_stream_equals_batch_with_pretrained_forest(spark, tmpdir_path):
    from tickwatch.operators.iforest import train_static, walk_forward
    from tickwatch.operators.stats import FEATURES, if_features
    sf = "/root/testdata/sf0.01"
    b = detect.blocked(events_ticks(spark, sf), Layout(), 21)
    model = train_static(if_features(b, training=True).where(F.col("own") & F.col("f_price").isNotNull()),
                         n_trees=20)
    t = events_ticks(spark, sf).select("series", "ts", "seq", "price").toPandas()
    t = t.sort_values(["ts", "seq"]).reset_index(drop=True)
    src = os.path.join(tmpdir_path, "src")
    os.makedirs(src)
    base = time.time() - 1000
    for i, part in enumerate([t.iloc[:1200], t.iloc[1200:5000], t.iloc[5000:]]):
        p = os.path.join(src, f"part-{i}.parquet")
        part.sample(frac=1.0, random_state=i).to_parquet(p, index=False, coerce_timestamps="us")
        os.utime(p, (base + i, base + i))
    out = os.path.join(tmpdir_path, "events")
    det = StreamDetector(events_path=out, params=EVENTS_PARAMS,
                         layout=Layout(block_rows=1000), iforest=True, iforest_model=model)
    q = det.start(parquet_file_ticks(spark, src, 1), checkpoint=os.path.join(tmpdir_path, "ckpt"),
                  available_now=True)
    q.awaitTermination(900)
    assert q.exception() is None
    got = read_events(spark, out).select("series", "price", "if_score", F.array_join("types", ",").alias("t"))
    fr = detect.rule_frame(events_ticks(spark, sf), EVENTS_PARAMS, Layout(block_rows=1000), features="online")
    keep = ["series", "seq", "ts", "t_us", "rn", "price", "pct_change", "abs_change", "rule_types", *FEATURES]
    bw = walk_forward(fr.select(*keep), pretrained=model)
    from tickwatch.operators.rules import fired_types
    bw = bw.withColumn("types", F.concat("rule_types", fired_types([("iforest_anomaly", F.col("if_flag"))])))
    exp = detect.event_record(bw, types="types", if_score="if_score").select(
        "series", "price", "if_score", F.array_join("types", ",").alias("t"))
    a, e = sorted(map(tuple, got.collect())), sorted(map(tuple, exp.collect()))
    assert a == e and any("iforest_anomaly" in r[3] for r in e)


def test_session_stream_equals_batch(spark, tmpdir_path):
    """Sessions in append mode are the batch sessions; a last far tick closes those of all series."""
    from tickwatch.operators.sessions import tick_sessions
    from tickwatch.streaming.stream import tick_sessions_stream
    src = os.path.join(tmpdir_path, "src")
    _write_chunks(spark, src, 3)
    _seconds(spark, src, "y.parquet", [(i, 31 * 86400 + at, 1.0) for i, at in enumerate([0, 6 * 3600, 12 * 3600 + 1])], 500)
    _seconds(spark, src, "z.parquet", [(9, 400 * 86400 * 30, 1.0)], 600)
    gap = 3600.0 * 6
    ticks = parquet_file_ticks(spark, src, 1)
    q = (tick_sessions_stream(ticks, gap, "30000 days").writeStream.outputMode("append").format("memory")
         .queryName("tw_sessions").option("checkpointLocation", os.path.join(tmpdir_path, "ck"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    # the watermark lags so far that nothing is late or closed yet
    assert spark.table("tw_sessions").count() == 0
    q = (tick_sessions_stream(ticks, gap, "1 day").writeStream.outputMode("append").format("memory")
         .queryName("tw_sessions2").option("checkpointLocation", os.path.join(tmpdir_path, "ck2"))
         .trigger(availableNow=True).start())
    q.awaitTermination(600)
    assert q.exception() is None
    from tickwatch.schema import t_us
    static = spark.read.parquet(*[os.path.join(src, f) for f in sorted(os.listdir(src)) if f != "z.parquet"])
    want = tick_sessions(static.withColumn("t_us", t_us(F.col("ts"))), gap, Layout(block_rows=50))
    cols = ["series", "first_ts", "last_ts", "ticks", "lo", "hi"]
    got = sorted(map(tuple, spark.table("tw_sessions2").where("first_ts < '2050-01-01'").select(cols).collect()))
    assert got == sorted(map(tuple, want.select(cols).collect())) and len(got) > 10
    # ticks exactly the gap apart are one session, a second more parts them
    assert [r[3] for r in got if r[0] == "s"] == [2, 1]


def test_payload_file_stream(spark, tmpdir_path):
    """S1 + S2 as a stream: JSON-lines files of (series, seq, payload text), bad lines dropped."""
    from tickwatch.sources.decode import encode_ticks
    from tickwatch.streaming.stream import payload_file_ticks
    t = events_ticks(spark, SF)
    src = os.path.join(tmpdir_path, "payloads")
    enc = encode_ticks(t.withColumn("change", F.lit(0.0))).select("series", "seq", "value")
    enc.coalesce(2).write.json(src)
    with open(os.path.join(src, "bad.json"), "w") as fh:
        fh.write('{"series": "x", "seq": 1, "value": "{\\"event\\":\\"heartbeat\\"}"}\nnot json\n')
    q = (payload_file_ticks(spark, src).writeStream.format("memory").queryName("tw_payloads")
         .option("checkpointLocation", os.path.join(tmpdir_path, "ck")).trigger(availableNow=True).start())
    q.awaitTermination(600)
    got = spark.table("tw_payloads")
    assert got.count() == t.count()
    assert got.where(F.col("series") == "x").count() == 0
