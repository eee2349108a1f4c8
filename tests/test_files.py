"""File sources and sinks: round trips through a scratch folder."""

import os

from pyspark.sql import functions as F

from tickwatch.plans import detect
from tickwatch.schema import ANOMALY_EVENT, EVENTS_PARAMS, Layout, events_ticks
from tickwatch.sources import files

SF = "/root/testdata/sf0.001"


def _events(spark):
    return detect.rule_events(events_ticks(spark, SF), EVENTS_PARAMS, Layout())


def test_anomaly_log_round_trip_tolerates_bad_lines(spark, tmpdir_path):
    ev = _events(spark)
    path = os.path.join(tmpdir_path, "log")
    files.write_anomaly_log(ev, path)
    # blank and malformed lines next to the good ones (S7: skipped, not fatal)
    junk_dir = os.path.join(path, "series=junk", "date=2024-01-02")
    os.makedirs(junk_dir)
    with open(os.path.join(junk_dir, "junk.json"), "w") as fh:
        fh.write("\n{not json\n" + '{"timestamp": "2024-01-02T00:00:00+00:00", "price": "x", "types": "nope"}\n')
    back = files.read_anomaly_log(spark, path, max_rows=None)
    good = back.where(F.col("series") != "junk")
    assert good.count() == ev.count()
    junk = back.where(F.col("series") == "junk").collect()
    assert len(junk) == 1 and junk[0]["price"] is None and list(junk[0]["types"]) == []
    assert junk[0]["primary_type"] == "unknown" and junk[0]["severity"] == "LOW"
    exp = sorted((r["series"], r["price"], r["severity"]) for r in ev.collect())
    assert sorted((r["series"], r["price"], r["severity"]) for r in good.collect()) == exp


def test_last_n_per_series_on_read(spark, tmpdir_path):
    ev = _events(spark)
    path = os.path.join(tmpdir_path, "log")
    files.write_anomaly_log(ev, path)
    back = files.read_anomaly_log(spark, path, max_rows=5)
    per = {r["series"]: r["count"] for r in back.groupBy("series").count().collect()}
    assert set(per.values()) == {5}


def test_price_feed_round_trip(spark, tmpdir_path):
    fr = detect.rule_frame(events_ticks(spark, SF), EVENTS_PARAMS, Layout())
    feed = detect.feed_frame(fr)
    path = os.path.join(tmpdir_path, "feed")
    files.write_price_feed(feed, path, n=50)
    back = files.read_price_feed(spark, path)
    assert back.count() == 5 * 50
    assert back.where(F.col("price").isNull() | F.col("ts").isNull()).count() == 0


def test_csv_export_and_history(spark, tmpdir_path):
    from tickwatch.plans.report import event_log
    table = event_log(_events(spark))
    out = os.path.join(tmpdir_path, "csv")
    files.export_csv(table, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == table.count() and "all_detectors" in back.columns
    hist = os.path.join(tmpdir_path, "hist")
    t = events_ticks(spark, SF)
    files.save_history(t, hist)
    h = files.load_history(spark, hist)
    assert h.count() == t.count() and "t_us" in h.columns
    last = files.last_n_closes(h, 10)
    assert last.count() == 50


def test_truncate(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "log")
    files.write_anomaly_log(_events(spark), path)
    files.truncate(spark, path, ANOMALY_EVENT)
    assert files.read_anomaly_log(spark, path, max_rows=None).count() == 0


def test_feed_with_bad_fields_keeps_its_rows(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "feed.json")
    with open(path, "w") as f:
        f.write('{"timestamp": "2024-01-01T00:00:00", "price": 1.5, "if_score": "n/a", "anomaly": true, "if_ready": 3}\n')
        f.write('{"timestamp": "2024-01-01T00:00:01", "price": "2.5", "if_score": 0.5}\n')
        f.write('{"timestamp": "?", "price": 3.0}\n')
    rows = files.read_price_feed(spark, path).collect()
    assert [(r.price, r.if_score, r.anomaly) for r in rows] == [(1.5, 0.0, True), (2.5, 0.5, False)]


def test_log_rows_without_a_time_count_as_oldest(spark):
    from tickwatch.plans.report import last_n
    df = spark.createDataFrame([("a", 5, 1, 1.0), ("a", None, 2, 2.0), ("a", None, 3, 3.0), ("b", None, 4, 4.0)],
                               "series string, t_us long, seq long, price double")
    for n in (2, 3, 2000):
        got = {(r.series, r.price) for r in last_n(df, n).collect()}
        assert got == {("a", 1.0), ("a", 3.0), ("b", 4.0)} | ({("a", 2.0)} if n > 2 else set())


def test_model_table_saved_and_loaded(spark, tmpdir_path):
    path = os.path.join(tmpdir_path, "model")
    assert files.load_model(spark, path) is None
    files.save_model(spark.createDataFrame([("a", [1.0], 0.5)], "series string, mu array<double>, cut double"), path)
    assert files.load_model(spark, path).collect()[0].cut == 0.5
