"""Wire formats, severity table and report operators on the FIXTURES.md small cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickwatch.functions.numeric import fround

from tickwatch.functions.severity import severity
from tickwatch.plans import report
from tickwatch.sources import decode


def test_raw_messages(spark):
    msgs = [
        '{"event":"heartbeat"}',
        '[1,[["5541.2","0.15","1534614057.321597","s","l",""],["5541.3","0.10","1534614058.0","b","m",""]],"trade","ABC/USD"]',
        '[1,[["5541.2"]],"spread","ABC/USD"]',
        '[1,[]]',
        'not json',
    ]
    df = spark.createDataFrame([(i, m) for i, m in enumerate(msgs)], "id long, raw string")
    out = decode.decode_trades(df).orderBy("id", "pos").collect()
    assert [(r["id"], r["pos"]) for r in out] == [(1, 0), (1, 1)]
    assert out[0]["ts_iso"] == "2018-08-18T17:40:57.321597+00:00"
    assert out[0]["price"] == 5541.2 and out[0]["pair"] == "ABC/USD"


def test_tick_payloads(spark):
    rows = [
        '{"timestamp":"2024-01-01T00:00:00+00:00","price":1.0,"change":0.0}',
        '{"timestamp":"2024-01-01T00:00:00","price":1.0}',
        '{"timestamp":"bad","price":1.0}',
        '{"timestamp":"2024-01-01T00:00:00","price":"1.0"}',
        '{"price":3}', '{bad', None,
        '{"timestamp":"2024-01-01T02:00:00+02:00","price":2.0}',
    ]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], "id long, value string")
    out = {r["id"]: r["ts"] for r in decode.decode_ticks(df).collect()}
    assert set(out) == {0, 1, 7}
    assert out[0] == out[1] == out[7] == dt.datetime(2024, 1, 1)


def test_encode_round_trip(spark):
    t = spark.createDataFrame([("s", dt.datetime(2024, 1, 1, 0, 0, 7, 179575), 1, 12.345, 0.1234567)],
                              "series string, ts timestamp_ntz, seq long, price double, change double")
    v = decode.encode_ticks(t).first()["value"]
    assert v == '{"timestamp":"2024-01-01T00:00:07.179575+00:00","price":12.35,"change":0.123457}' or \
        v == '{"timestamp":"2024-01-01T00:00:07.179575+00:00","price":12.34,"change":0.123457}'


def test_ohlc(spark):
    body = ('{"error": [], "result": {"ABCUSD": [[1700000000, "1", "2", "0.5", "1.5", "1.2", "3", 7],'
            ' [1700000060, "1.5", "2", "1", "1.75", "1.6", "2", 4]], "last": 1700000060}}')
    out = decode.decode_ohlc(spark.createDataFrame([(body,)], "body string")).orderBy("ts").collect()
    assert [(r["pair"], r["close"]) for r in out] == [("ABCUSD", 1.5), ("ABCUSD", 1.75)]
    assert out[0]["ts"] == dt.datetime(2023, 11, 14, 22, 13, 20)


@pytest.mark.parametrize("types,full,fallback,rules_only", [
    ([], "LOW", "LOW", "LOW"),
    (["mean_reversion_break"], "LOW", "LOW", "LOW"),
    (["vol_breakout", "mean_reversion_break"], "MED", "MED", "MED"),
    (["iforest_anomaly"], "MED", "MED", "LOW"),
    (["lstm_anomaly"], "HIGH", "HIGH", "LOW"),
    (["mean_reversion_break", "pct_spike"], "HIGH", "HIGH", "HIGH"),
    (["something_else"], "LOW", "LOW", "LOW"),
])
def test_severity_table(spark, types, full, fallback, rules_only):
    df = spark.createDataFrame([(types,)], "types array<string>")
    r = df.select(severity(F.col("types"), "full").alias("a"), severity(F.col("types"), "fallback").alias("b"),
                  severity(F.col("types"), "rules_only").alias("c")).first()
    assert (r["a"], r["b"], r["c"]) == (full, fallback, rules_only)


def _events(spark, rows):
    return spark.createDataFrame(
        [("s", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s), i, 1.0, 0.1, 0.1, t, sev, 0.0, 0.0)
         for i, (s, t, sev) in enumerate(rows)],
        "series string, ts timestamp_ntz, seq long, price double, pct_change double, abs_change double, "
        "types array<string>, severity string, if_score double, lstm_score double",
    ).withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp")))


def test_events_per_minute_zero_filled(spark):
    ev = _events(spark, [(10, ["pct_spike"], "HIGH"), (50, ["pct_spike"], "HIGH"), (185, ["abs_jump"], "HIGH")])
    out = [(r["minute"].strftime("%H:%M"), r["count"]) for r in report.events_per_minute(ev).orderBy("minute").collect()]
    assert out == [("00:00", 2), ("00:01", 0), ("00:02", 0), ("00:03", 1)]


def test_empty_selection_selects_nothing(spark):
    ev = _events(spark, [(10, ["pct_spike"], "HIGH")])
    assert report.filter_view(ev, severities=[], types=["pct_spike"]).count() == 0
    assert report.filter_view(ev, severities=["HIGH"], types=[]).count() == 0
    assert report.filter_view(ev, "high").count() == 1
    assert report.filter_view(ev, "ml").count() == 0


def test_top_detector_tie_first_seen(spark):
    ev = _events(spark, [(1, ["abs_jump"], "HIGH"), (2, ["pct_spike"], "HIGH"), (3, ["pct_spike", "abs_jump"], "HIGH")])
    assert report.top_detector(ev).first()["top_type"] == "abs_jump"


def test_elapsed_label_and_band(spark):
    df = spark.createDataFrame([(3599.0, 4.9), (3600.0, 5.0), (7325.0, 20.1)], "s double, r double")
    out = df.select(report.elapsed_label(F.col("s")).alias("l"), report.rate_band(F.col("r")).alias("b")).collect()
    assert [(r["l"], r["b"]) for r in out] == [("59m 59s", "quiet"), ("1h 0m", "normal"), ("2h 2m", "high")]


def test_nice_step(spark):
    df = spark.createDataFrame([(0.0, 1.0), (-3.0, 5.0), (0.0, 0.37)], "lo double, hi double")
    got = [r[0] for r in df.select(report.nice_step(F.col("lo"), F.col("hi"))).collect()]
    assert got == pytest.approx([0.05, 0.2, 0.01])


def test_sql_views(spark):
    from tickwatch.plans.report import severity_counts
    from tickwatch.plans.views import register_views
    from tickwatch.schema import EVENTS_PARAMS, events_ticks
    v = register_views(spark, events_ticks(spark, "/root/testdata/sf0.001"), EVENTS_PARAMS)
    got = {(r[0], r[1], r[2]) for r in spark.sql(
        "SELECT series, severity, count(*) FROM tw_anomalies GROUP BY series, severity").collect()}
    exp = {(r["series"], r["severity"], r["count"]) for r in severity_counts(v["anomalies"]).collect() if r["count"]}
    assert got == exp
    n = spark.sql("SELECT count(*) FROM tw_ticks WHERE size(types) > 0").first()[0]
    assert n == spark.sql("SELECT count(*) FROM tw_anomalies").first()[0]


def test_kafka_records_decode(spark):
    """S1 decode step on Kafka-shaped records (the connector itself is not available here)."""
    from tickwatch.streaming.stream import decode_kafka_records
    rows = [
        (b"s1", b'{"timestamp":"2024-01-01T00:00:01+00:00","price":10.5,"change":0.0}', "prices", 7),
        (None, b'{"timestamp":"2024-01-01T00:00:02","price":11.0}', "prices", 8),
        (b"s1", b'{"event":"heartbeat"}', "prices", 9),
    ]
    df = spark.createDataFrame(rows, "key binary, value binary, topic string, offset long")
    out = sorted((r["series"], r["seq"], r["price"]) for r in decode_kafka_records(df).collect())
    assert out == [("prices", 8, 11.0), ("s1", 7, 10.5)]


def test_panel_gate_and_detector_dim(spark):
    from tickwatch.functions.severity import detector_dim
    ev = _events(spark, [(1, ["pct_spike"], "HIGH"), (2, ["lstm_anomaly"], "HIGH")])
    assert report.recon_panel_active(ev).first()["active"] is False
    ev2 = ev.withColumn("lstm_score", F.when(F.col("seq") == 1, F.lit(1.2)).otherwise(F.lit(0.0)))
    assert report.recon_panel_active(ev2).first()["active"] is True
    dim = {r["type"]: (r["layer"], r["severity"], r["is_ml"]) for r in detector_dim(spark).collect()}
    assert len(dim) == 6 and dim["iforest_anomaly"] == ("ML", "MED", True) and dim["abs_jump"][2] is False


def test_minutes_up_to_a_far_time(spark):
    """A tick of the year 9999 fills no array of all minutes before it; gaps keep their places."""
    from tickwatch.plans.report import DAY, events_per_minute
    t = dt.datetime(2024, 1, 1, 0, 0, 30)
    gap = DAY * DAY + DAY + 7  # a piece of each size
    rows = [("a", t), ("a", t), ("a", t + dt.timedelta(minutes=gap)), ("b", t), ("c", t), ("c", dt.datetime(9999, 12, 31))]
    out = events_per_minute(spark.createDataFrame(rows, "series string, ts timestamp_ntz"))
    a = out.where("series = 'a'")
    assert a.count() == gap + 1 and a.select("minute").distinct().count() == gap + 1
    assert sorted((r["minute"], r["count"]) for r in a.where("count > 0").collect()) == \
        [(t.replace(second=0), 2), (t.replace(second=0) + dt.timedelta(minutes=gap), 1)]
    assert out.where("series = 'b'").count() == 1
    assert len(out.where("series = 'c'").limit(3).collect()) == 3


def test_severity_rules_differ_on_model_types(spark):
    from __spark_entry__ import queries
    rows = queries()["severity_with_model"](spark, "/root/testdata/sf0.01").where("types LIKE '%lstm%'").collect()
    assert rows and any(r["full_sev"] != r["rules_only_sev"] for r in rows)


def test_feed_sink_rounds_like_the_query(spark, tmpdir_path):
    from tickwatch.sources.files import read_price_feed, write_price_feed
    feed = spark.createDataFrame([("a", dt.datetime(2024, 1, 1), 0, 1, 2.675, 0.12345, True, False)],
                                 "series string, ts timestamp_ntz, t_us long, seq long, price double, if_score double, anomaly boolean, if_ready boolean")
    write_price_feed(feed, tmpdir_path + "/feed")
    got = read_price_feed(spark, tmpdir_path + "/feed").first()
    assert got["price"] == feed.select(fround("price", 2)).first()[0]
