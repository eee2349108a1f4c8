"""Registered queries: one Spark plan and (where SQL can say it) one DuckDB oracle each.

Every query reads the driver tables in ``sf_dir`` (``events`` through the
canonical tick adapter unless stated) and runs over the whole table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.functions.numeric import fround
from tickwatch.plans import detect
from tickwatch.plans import sql as Q
from tickwatch.schema import EVENTS_PARAMS, ORDERS_PARAMS, Layout, events_ticks, orders_ticks
from tickwatch.session import ensure_utc, ship_package

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

LAYOUT = Layout()


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ensure_utc(spark)
            ship_package(spark)
            return fn(spark, sf_dir)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql.strip()
        return run
    return deco


def _fmt_ts(col: str = "ts"):
    return F.date_format(col, detect.TS_FORMAT)


def _events_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return detect.rule_frame(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT)


# --------------------------------------------------------------------------- rules

@register("anomaly_events", f"""
WITH {Q.rule_events_cte()}
SELECT series, seq, {Q.fmt_ts()} AS ts, price, pct_change, abs_change, types, severity FROM ev""")
def anomaly_events(spark, sf_dir):
    """Rules-only anomaly events over ``events``."""
    ev = detect.event_record(_events_rules(spark, sf_dir), types="rule_types")
    return ev.select("series", "seq", _fmt_ts().alias("ts"), "price", "pct_change", "abs_change",
                     F.array_join("types", ",").alias("types"), "severity")


@register("anomaly_events_orders", f"""
WITH {Q.rule_events_cte(ORDERS_PARAMS, "orders")}
SELECT series, seq, {Q.fmt_ts()} AS ts, price, pct_change, abs_change, types, severity FROM ev""")
def anomaly_events_orders(spark, sf_dir):
    """R5 over ``orders`` (many equal timestamps: exercises the dt <= 0 path, X4)."""
    fr = detect.rule_frame(orders_ticks(spark, sf_dir), ORDERS_PARAMS, LAYOUT)
    ev = detect.event_record(fr, types="rule_types")
    return ev.select("series", "seq", _fmt_ts().alias("ts"), "price", "pct_change", "abs_change",
                     F.array_join("types", ",").alias("types"), "severity")


def _rule_query(flag: str):
    def q(spark, sf_dir):
        fr = _events_rules(spark, sf_dir)
        return fr.where(F.col(flag)).select("series", "seq")
    q.__name__ = f"rule_{flag}"
    q.__doc__ = f"Ticks on which {flag} fires."
    return q


for _key, _flag in [("rule_pct_spike", "pct_spike"), ("rule_abs_jump", "abs_jump"),
                    ("rule_vol_breakout", "vol_breakout"), ("rule_mean_reversion", "mean_reversion_break")]:
    register(_key, f"WITH {Q.rules_ctes()} SELECT series, seq FROM r WHERE {_flag}")(_rule_query(_flag))


@register("gated_change", f"""
WITH {Q.rules_ctes()}
SELECT series, seq, gated, round(abs_change, 6) AS abs_change, round(pct_change, 6) AS pct_change FROM r""")
def gated_change(spark, sf_dir):
    """Gap gate and gated changes for every tick."""
    fr = _events_rules(spark, sf_dir)
    return fr.select("series", "seq", "gated", fround("abs_change", 6).alias("abs_change"),
                     fround("pct_change", 6).alias("pct_change"))


@register("rolling_stats", f"""
WITH {Q.rules_ctes()}
SELECT series, seq, CAST(least(rn - 1, {C.PRICE_WINDOW}) AS BIGINT) AS n,
       round(mean120 * least(rn - 1, {C.PRICE_WINDOW}), 4) AS sum120,
       round(sd120, 6) AS sd120, round(sd_ret119, 6) AS sd_ret119 FROM r""")
def rolling_stats(spark, sf_dir):
    """Rolling mean / sigma of previous prices and of one-step differences."""
    fr = _events_rules(spark, sf_dir)
    # the oracle compares the window sum (exact to the cent) rather than the mean,
    # whose 6th decimal can sit on a rounding tie
    return fr.select("series", "seq", F.col("n_prev").cast("long").alias("n"),
                     fround(F.col("mean120") * F.col("n_prev"), 4).alias("sum120"),
                     fround("sd120", 6).alias("sd120"), fround("sd_ret119", 6).alias("sd_ret119"))


# --------------------------------------------------------------------------- events + feed helpers

def _events(spark, sf_dir):
    """Rules-only anomaly records of ``events`` (types kept as an array)."""
    return detect.event_record(_events_rules(spark, sf_dir), types="rule_types")


EV = f"WITH {Q.rule_events_cte()}"
EVF = f"WITH {Q.rule_events_cte()}, {Q.feed_cte()}"


@register("severity", f"""{EV}
SELECT series, seq, severity AS full_sev,
  CASE WHEN list_has_any(type_list, {C.FALLBACK_HIGH}) THEN 'HIGH'
       WHEN list_has_any(type_list, {C.FALLBACK_MED}) THEN 'MED' ELSE 'LOW' END AS fallback_sev,
  CASE WHEN list_has_any(type_list, {C.RULES_ONLY_HIGH}) THEN 'HIGH'
       WHEN list_has_any(type_list, {C.RULES_ONLY_MED}) THEN 'MED' ELSE 'LOW' END AS rules_only_sev
FROM ev""")
def severity(spark, sf_dir):
    """The three severity rules on every event's fired list."""
    from tickwatch.functions.severity import severity as sev
    ev = _events(spark, sf_dir)
    return ev.select("series", "seq", sev(F.col("types"), "full").alias("full_sev"),
                     sev(F.col("types"), "fallback").alias("fallback_sev"),
                     sev(F.col("types"), "rules_only").alias("rules_only_sev"))


@register("price_feed_last_n", f"""{EVF}
SELECT series, seq, round(price, 2) AS price, anomaly, if_ready
FROM {Q.last_n_sql('feed', C.MAX_PRICE_HISTORY)}""")
def price_feed_last_n(spark, sf_dir):
    """Last 500 ticks per series with anomaly and model-ready flags."""
    from tickwatch.plans.report import last_n
    fr = _events_rules(spark, sf_dir)
    feed = last_n(detect.feed_frame(fr), C.MAX_PRICE_HISTORY)
    return feed.select("series", "seq", fround("price", 2).alias("price"), "anomaly", "if_ready")


LAST_CLOSES = 3000


@register("last_n_closes", f"""
WITH t AS ({Q.ticks_cte()})
SELECT series, seq, price FROM {Q.last_n_sql('t', LAST_CLOSES)}""")
def last_n_closes(spark, sf_dir):
    """The last 3000 closes per series."""
    from tickwatch.sources.files import last_n_closes as lnc
    return lnc(events_ticks(spark, sf_dir), LAST_CLOSES).select("series", "seq", "price")


@register("history_summary", f"""
WITH t AS ({Q.ticks_cte()})
SELECT series, count(*) AS n, min(price) AS min_price, max(price) AS max_price,
       round(avg(price), 6) AS mean_price FROM t GROUP BY series""")
def history_summary(spark, sf_dir):
    """History size, min, max, mean per series."""
    t = events_ticks(spark, sf_dir)
    return t.groupBy("series").agg(F.count(F.lit(1)).alias("n"), F.min("price").alias("min_price"),
                                   F.max("price").alias("max_price"),
                                   fround(F.avg("price"), 6).alias("mean_price"))


@register("anomaly_log_view", f"""{EV}
SELECT series, {Q.iso()} AS ts, coalesce(type_list[1], 'unknown') AS primary_type, price, pct_change,
       abs_change, if_score, lstm_score, severity, CAST(len(type_list) AS BIGINT) AS n_types
FROM {Q.last_n_sql('ev', C.ANOMALY_LOG_ROWS)}""")
def anomaly_log_view(spark, sf_dir):
    """Events written as log lines (JSON text), read back tolerantly and coerced."""
    from tickwatch.sources.files import anomaly_json, coerce_anomaly_log
    lines = anomaly_json(_events(spark, sf_dir)).select(
        F.to_json(F.struct("timestamp", "price", "pct_change", "abs_change", "types", "severity",
                           "if_score", "lstm_score", "series")).alias("line"))
    from tickwatch.schema import ANOMALY_LOG_TEXT
    raw = lines.select(F.from_json("line", ANOMALY_LOG_TEXT).alias("r")).select("r.*")
    v = coerce_anomaly_log(raw, C.ANOMALY_LOG_ROWS)
    return v.select("series", F.col("ts_iso").alias("ts"), "primary_type", "price", "pct_change", "abs_change",
                    "if_score", "lstm_score", "severity", F.size("types").cast("long").alias("n_types"))


@register("price_feed_view", """
SELECT event_type AS series, epoch_us(ts) AS t_us, value AS price,
       CASE WHEN event_id % 3 = 0 THEN 0.0 ELSE 0.25 END AS if_score,
       event_id % 4 = 0 AS anomaly, event_id % 2 = 0 AS if_ready
FROM events WHERE event_id % 7 <> 0 AND event_id % 5 <> 0 AND value IS NOT NULL""")
def price_feed_view(spark, sf_dir):
    """Feed lines with bad times, prices, scores and flags put in, read back and coerced."""
    from tickwatch.sources.decode import iso_utc
    from tickwatch.sources.files import coerce_price_feed
    k = F.col("event_id")
    raw = spark.read.parquet(f"{sf_dir}/events.parquet").select(
        F.col("event_type").alias("series"),
        F.when(k % 7 == 0, F.lit("bad")).otherwise(iso_utc(F.col("ts"))).alias("timestamp"),
        F.when(k % 5 == 0, F.lit("n/a")).otherwise(F.col("value").cast("string")).alias("price"),
        F.when(k % 3 == 0, F.lit("n/a")).otherwise(F.lit("0.25")).alias("if_score"),
        F.when(k % 4 == 0, F.lit("true")).when(k % 4 == 1, F.lit("false")).otherwise(F.lit("?")).alias("anomaly"),
        F.when(k % 2 == 0, F.lit("true")).alias("if_ready"))
    return coerce_price_feed(raw).select("series", "t_us", "price", "if_score", "anomaly", "if_ready")


@register("filter_view", f"""{EV}
SELECT series, seq, severity, types FROM {Q.last_n_sql('ev', C.VIEW_ROWS_DEFAULT,
    "severity IN ('HIGH') AND list_has_any(type_list, ['pct_spike', 'abs_jump', 'lstm_anomaly'])")}""")
def filter_view(spark, sf_dir):
    """HIGH preset, last 200 matching events per series."""
    from tickwatch.plans.report import filter_view as fv
    v = fv(_events(spark, sf_dir), "high", C.VIEW_ROWS_DEFAULT)
    return v.select("series", "seq", "severity", F.array_join("types", ",").alias("types"))


@register("active_alert", f"""{EV}
SELECT series, seq, strftime(ts, '%H:%M:%S') AS time, printf('$%,.2f', round(price, 2)) AS price,
       printf('%+.4f%%', round(pct_change, 4)) AS delta_pct,
       array_to_string(list_transform(type_list, lambda x: '`' || x || '`'), ' · ') AS detectors
FROM {Q.last_n_sql('ev', 1, "severity = 'HIGH'")}""")
def active_alert(spark, sf_dir):
    """latest HIGH event per series, formatted."""
    from tickwatch.plans.report import active_alert as aa
    return aa(_events(spark, sf_dir))


@register("anomalies_in_window", f"""{EVF},
first_tick AS (SELECT series, min(t_us) AS t0 FROM {Q.last_n_sql('feed', C.MAX_PRICE_HISTORY)} GROUP BY series)
SELECT f.series, count(ev.series) AS count FROM first_tick f LEFT JOIN ev ON ev.series = f.series AND ev.t_us >= f.t0
GROUP BY f.series""")
def anomalies_in_window(spark, sf_dir):
    """Anomalies at or after the first tick of the 500-tick feed, per series."""
    from tickwatch.plans.report import anomalies_in_window as aiw, last_n
    # the feed's first tick depends only on tick order: take it from the ticks
    # (scan + partial top-k), so the rule plan runs once
    feed = last_n(events_ticks(spark, sf_dir).select("series", "t_us", "seq"), C.MAX_PRICE_HISTORY)
    return aiw(_events(spark, sf_dir), feed)


@register("severity_counts", f"""{EV},
g AS (SELECT series, count_if(severity = 'HIGH') AS h, count_if(severity = 'MED') AS m,
             count_if(severity = 'LOW') AS l, count(*) AS tot FROM ev GROUP BY series)
SELECT series, 'HIGH' AS severity, 0 AS rank, CAST(h AS BIGINT) AS count, round(h / tot * 100.0, 1) AS pct FROM g
UNION ALL SELECT series, 'MED', 1, CAST(m AS BIGINT), round(m / tot * 100.0, 1) FROM g
UNION ALL SELECT series, 'LOW', 2, CAST(l AS BIGINT), round(l / tot * 100.0, 1) FROM g""")
def severity_counts(spark, sf_dir):
    """Zero-filled HIGH/MED/LOW counts and percent per series."""
    from tickwatch.plans.report import severity_counts as sc
    return sc(_events(spark, sf_dir))


@register("type_counts", f"""{EV},
x AS (SELECT unnest(type_list) AS type FROM ev),
c AS (SELECT type, count(*) AS count FROM x GROUP BY type)
SELECT type, count,
  CASE type {' '.join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in C.TYPE_META.items())} ELSE '?' END AS layer,
  CASE type {' '.join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in C.TYPE_META.items())} ELSE 'LOW' END AS severity,
  CASE WHEN type IN ('iforest_anomaly', 'lstm_anomaly') THEN 'ml' ELSE 'rule' END AS layer_tag,
  CASE type {' '.join(f"WHEN '{k}' THEN '{v[2]}'" for k, v in C.TYPE_META.items())} ELSE '' END AS description
FROM c""")
def type_counts(spark, sf_dir):
    """Fired-detector counts with layer / severity metadata."""
    from tickwatch.plans.report import type_counts as tc
    return tc(_events(spark, sf_dir))


@register("top_detector", f"""{EV},
x AS (SELECT series, t_us, seq, unnest(type_list) AS type, generate_subscripts(type_list, 1) AS p FROM ev),
c AS (SELECT series, type, count(*) AS count, min(t_us) AS ft FROM x GROUP BY series, type),
c2 AS (SELECT c.*, (SELECT min(seq * 100 + p) FROM x WHERE x.series = c.series AND x.type = c.type
                      AND x.t_us = c.ft) AS fk FROM c)
SELECT series, type AS top_type, count FROM (
  SELECT *, row_number() OVER (PARTITION BY series ORDER BY count DESC, ft, fk) AS k FROM c2) WHERE k = 1""")
def top_detector(spark, sf_dir):
    """A3: most frequent detector per series (tie: first seen)."""
    from tickwatch.plans.report import top_detector as td
    return td(_events(spark, sf_dir))


def _kpi_sql(feed: str, ev: str) -> str:
    return f"""{EVF},
f AS (SELECT series, count(*) AS ticks, max(price) AS hi, min(price) AS lo, (max(t_us) - min(t_us)) / 1e6 AS span_s,
             bool_or(if_ready) AS if_ready FROM {feed} GROUP BY series),
e AS (SELECT series, count(*) AS anomalies, count_if(severity = 'HIGH') AS high, count_if(severity = 'MED') AS med
      FROM {ev} GROUP BY series),
j AS (SELECT f.*, coalesce(e.anomalies, 0) AS anomalies, coalesce(e.high, 0) AS high, coalesce(e.med, 0) AS med,
             coalesce(e.anomalies, 0) / greatest(f.ticks, 1) * 100.0 AS rate,
             greatest((f.hi - f.lo) * {C.CHART_PAD_FRACTION}, {C.CHART_PAD_MIN}) AS pad
      FROM f LEFT JOIN e ON f.series = e.series)
SELECT series, CAST(ticks AS BIGINT) AS ticks, CAST(anomalies AS BIGINT) AS anomalies, CAST(high AS BIGINT) AS high,
  CAST(med AS BIGINT) AS med, round(rate, 4) AS rate,
  CASE WHEN rate >= {C.RATE_NORMAL_LO} AND rate <= {C.RATE_NORMAL_HI} THEN 'normal'
       WHEN rate > {C.RATE_NORMAL_HI} THEN 'high' ELSE 'quiet' END AS band,
  hi, lo, round(hi - lo, 6) AS range, round(lo - pad, 6) AS y_min, round(hi + pad, 6) AS y_max,
  round(span_s, 6) AS span_s,
  CASE WHEN span_s >= 3600 THEN printf('%dh %dm', CAST(floor(span_s / 3600) AS BIGINT),
                                       CAST(floor(fmod(span_s, 3600) / 60) AS BIGINT))
       ELSE printf('%dm %ds', CAST(floor(span_s / 60) AS BIGINT), CAST(floor(fmod(span_s, 60)) AS BIGINT)) END
    AS elapsed,
  round(least(ticks / {float(C.IF_WARMUP)}, 1.0), 6) AS warmup, if_ready
FROM j"""


@register("session_kpis_mixed", _kpi_sql(f"(SELECT * FROM {Q.last_n_sql('feed', C.MAX_PRICE_HISTORY)})",
                                         f"(SELECT * FROM {Q.last_n_sql('ev', C.ANOMALY_LOG_ROWS)})"))
def session_kpis_mixed(spark, sf_dir):
    """A5 with the mixed windows of a live view: the last 500 ticks, the last 3000 events."""
    from tickwatch.plans.report import mixed_window_kpis
    fr = _events_rules(spark, sf_dir)
    return mixed_window_kpis(detect.feed_frame(fr), detect.event_record(fr, types="rule_types"))


@register("session_kpis", _kpi_sql("feed", "ev"))
def session_kpis(spark, sf_dir):
    """Per-series KPIs over the whole series."""
    from tickwatch.functions.severity import top_severity
    from tickwatch.plans.report import session_kpis as sk
    fr = _events_rules(spark, sf_dir)
    feed = detect.feed_frame(fr.withColumn("severity", top_severity(F.col("rule_types"))), extra=["severity"])
    return sk(feed)


@register("latest_delta", f"""{EVF},
l AS (SELECT series, max(CASE WHEN pos = 1 THEN price END) AS price, max(CASE WHEN pos = 2 THEN price END) AS p2
      FROM {Q.last_n_sql('feed', 2)} GROUP BY series)
SELECT series, price, coalesce(p2, price) AS prev, round(price - coalesce(p2, price), 6) AS delta,
  round(CASE WHEN coalesce(p2, price) = 0 THEN 0.0
             ELSE (price - coalesce(p2, price)) / coalesce(p2, price) * 100.0 END, 6) AS delta_pct
FROM l""")
def latest_delta(spark, sf_dir):
    """Latest price, previous price and their delta per series."""
    from tickwatch.plans.report import latest_delta as ld
    return ld(detect.feed_frame(_events_rules(spark, sf_dir)))


@register("events_per_minute", f"""{EV},
c AS (SELECT series, date_trunc('minute', ts) AS minute, count(*) AS count FROM ev GROUP BY ALL),
b AS (SELECT series, min(minute) AS lo, max(minute) AS hi FROM c GROUP BY series),
d AS (SELECT series, unnest(generate_series(lo, hi, INTERVAL 1 MINUTE)) AS minute FROM b)
SELECT d.series, strftime(d.minute, '%Y-%m-%d %H:%M') AS minute, CAST(coalesce(c.count, 0) AS BIGINT) AS count
FROM d LEFT JOIN c ON d.series = c.series AND d.minute = c.minute""")
def events_per_minute(spark, sf_dir):
    """Events per minute per series, empty minutes as 0."""
    from tickwatch.plans.report import events_per_minute as epm
    out = epm(_events(spark, sf_dir))
    return out.select("series", F.date_format("minute", "yyyy-MM-dd HH:mm").alias("minute"), "count")


@register("pct_histogram", f"""{EV},
x AS (SELECT * FROM ev WHERE abs(pct_change) > 0),
s AS (SELECT {Q.nice_step_sql('min(pct_change)', 'max(pct_change)')} AS step FROM x)
SELECT severity, round(coalesce(floor(pct_change / step) * step, pct_change), 6) AS bin_start,
       count(*) AS count FROM x, s GROUP BY ALL""")
def pct_histogram(spark, sf_dir):
    """Histogram of non-zero percent changes by severity (<= 40 nice bins)."""
    from tickwatch.plans.report import pct_histogram as ph
    return ph(_events(spark, sf_dir))


@register("event_log", f"""{EV}
SELECT series, pos, strftime(ts, '%H:%M:%S') AS time_utc,
  CASE WHEN price IS NULL THEN '—' ELSE printf('$%,.2f', round(price, 2)) END AS price,
  printf('%+.4f%%', round(pct_change, 4)) AS delta_pct, '$' || printf('%+.2f', round(abs_change, 2)) AS delta_abs,
  severity, coalesce(type_list[1], 'unknown') AS main_detector,
  CASE WHEN if_score > 0 THEN printf('%.3f', round(if_score, 3)) ELSE '—' END AS if_score,
  CASE WHEN lstm_score > 0 THEN printf('%.3f', round(lstm_score, 3)) ELSE '—' END AS lstm_score,
  array_to_string(type_list, ' · ') AS all_detectors
FROM {Q.last_n_sql('ev', C.VIEW_ROWS_DEFAULT)}""")
def event_log(spark, sf_dir):
    """Formatted event log, newest first, last 200 per series."""
    from tickwatch.plans.report import event_log as el
    return el(_events(spark, sf_dir))


@register("recent_alerts", f"""{EV},
t AS (SELECT *, {Q.iso()} AS ts_iso FROM {Q.last_n_sql('ev', C.ALERT_LOG_ROWS)}),
a AS (SELECT *, count(*) OVER (PARTITION BY series) AS total,
             max(CASE WHEN pos = 1 THEN substr(ts_iso, 1, 19) END) OVER (PARTITION BY series) AS last_time FROM t)
SELECT series, pos, CAST(total AS BIGINT) AS total, last_time, substr(ts_iso, 1, 19) AS time,
  CASE WHEN price IS NULL THEN 'n/a' ELSE printf('%,.2f', round(price, 2)) END AS price,
  CASE WHEN pct_change IS NULL THEN 'n/a' ELSE printf('%+.4f%%', round(pct_change, 4)) END AS pct,
  CASE WHEN abs_change IS NULL THEN 'n/a' ELSE printf('%+.2f', round(abs_change, 2)) END AS abs,
  CASE WHEN list_has_any(type_list, {C.RULES_ONLY_HIGH}) THEN 'HIGH'
       WHEN list_has_any(type_list, {C.RULES_ONLY_MED}) THEN 'MED' ELSE 'LOW' END AS severity,
  CASE WHEN len(type_list) > 0 THEN array_to_string(type_list, ',') ELSE '-' END AS types
FROM a WHERE pos <= {C.ALERT_SHOW_ROWS}""")
def recent_alerts(spark, sf_dir):
    """Plain alert lines, 15 newest of the last 50 per series."""
    from tickwatch.plans.report import recent_alerts as ra
    return ra(_events(spark, sf_dir))


# --------------------------------------------------------------------------- wire formats

def _changes(spark, sf_dir):
    from tickwatch.operators.stats import producer_change
    b = detect.blocked(events_ticks(spark, sf_dir), LAYOUT, 1)
    return producer_change(b).where(F.col("own"))


CHANGE_SQL = ("coalesce((CASE WHEN lag(price) OVER (PARTITION BY series ORDER BY t_us, seq) = 0 THEN NULL ELSE "
              "(price - lag(price) OVER (PARTITION BY series ORDER BY t_us, seq)) / "
              "lag(price) OVER (PARTITION BY series ORDER BY t_us, seq) END) * 100.0, 0.0)")


@register("tick_change", f"""
WITH tk AS ({Q.ticks_cte()})
SELECT series, seq, round({CHANGE_SQL}, 6) AS change FROM tk""")
def tick_change(spark, sf_dir):
    """Producer-side percent change against the previous tick."""
    return _changes(spark, sf_dir).select("series", "seq", fround("change", 6).alias("change"))


@register("encode_ticks", f"""
WITH tk AS ({Q.ticks_cte()})
SELECT series, seq, {Q.iso()} AS timestamp, round(price, 2) AS price, round({CHANGE_SQL}, 6) AS change FROM tk""")
def encode_ticks(spark, sf_dir):
    """JSON payloads {timestamp, price, change}; checked by decoding the JSON text back."""
    from tickwatch.schema import TICK_PAYLOAD
    from tickwatch.sources.decode import encode_ticks as enc
    v = enc(_changes(spark, sf_dir))
    d = F.from_json("value", TICK_PAYLOAD)
    return v.select("series", "seq", d["timestamp"].alias("timestamp"), d["price"].alias("price"),
                    d["change"].alias("change"))


@register("decode_ticks", f"""
WITH tk AS ({Q.ticks_cte()})
SELECT series, seq, {Q.fmt_ts()} AS ts, round(price, 2) AS price FROM tk""")
def decode_ticks(spark, sf_dir):
    """Decode payloads (valid ticks plus every row's ``props`` text, which is not a tick)."""
    from tickwatch.sources.decode import decode_ticks as dec, encode_ticks as enc
    t = events_ticks(spark, sf_dir).withColumn("change", F.lit(0.0))
    good = enc(t).select("series", "seq", F.col("value").cast("binary").alias("value"))
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    bad = ev.select(F.col("event_type").alias("series"), F.col("event_id").alias("seq"),
                    F.col("props").cast("binary").alias("value"))
    out = dec(good.unionByName(bad))
    return out.select("series", "seq", F.date_format("ts", detect.TS_FORMAT).alias("ts"), "price")


@register("decode_trades", f"""
WITH tk AS ({Q.ticks_cte()})
SELECT series, seq, CAST(0 AS BIGINT) AS pos, price, {Q.iso()} AS ts_iso FROM tk""")
def decode_trades(spark, sf_dir):
    """Raw trade messages (one per tick) mixed with control messages (``props``
    objects) -> trade rows."""
    from tickwatch.sources.decode import decode_trades as dec, trade_message
    msgs = trade_message(events_ticks(spark, sf_dir)).select("raw")
    ev = spark.read.parquet(f"{sf_dir.rstrip('/')}/events.parquet")
    ctrl = ev.select(F.col("props").alias("raw"))
    out = dec(msgs.unionByName(ctrl))
    raw_ch = F.from_json("raw", "array<string>")
    return out.select(F.col("pair").alias("series"), F.element_at(raw_ch, 1).cast("long").alias("seq"), "pos",
                      "price", "ts_iso")


# --------------------------------------------------------------------------- features / schedule

def _feature_sql(training: bool) -> str:
    span = C.IF_WINDOW + 1 if training else C.IF_WINDOW
    first = C.IF_WINDOW + 1 if training else C.IF_WINDOW
    s = "PARTITION BY series ORDER BY t_us, seq"
    return f"""
WITH tk AS ({Q.ticks_cte()}),
fw AS (SELECT *, row_number() OVER ({s}) AS rn, lag(price, 1) OVER ({s}) AS l1, lag(price, 5) OVER ({s}) AS l5,
  avg(price) OVER ({s} ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW) AS mu,
  CASE WHEN stddev_pop(price) OVER ({s} ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW) = 0 THEN {C.SIGMA_EPS}
       ELSE stddev_pop(price) OVER ({s} ROWS BETWEEN {span - 1} PRECEDING AND CURRENT ROW) END AS sg FROM tk)
SELECT series, seq, price AS f_price,
  round((price - l1) / (CASE WHEN l1 = 0 THEN {C.SIGMA_EPS} ELSE l1 END), 6) + 0.0 AS f_r1,
  round((price - l5) / (CASE WHEN l5 = 0 THEN {C.SIGMA_EPS} ELSE l5 END), 6) + 0.0 AS f_r5,
  round(sg, 6) + 0.0 AS f_sigma, round((price - mu) / sg, 6) + 0.0 AS f_z
FROM fw WHERE rn >= {first}"""


def _features(spark, sf_dir, variant: str):
    from tickwatch.operators.stats import if_features
    b = detect.blocked(events_ticks(spark, sf_dir), LAYOUT, C.IF_WINDOW + 1)
    f = if_features(b, training=(variant == "training")).where(F.col("own") & F.col("f_price").isNotNull())
    return f


def _feature_cols(f):
    return f.select("series", "seq", "f_price", *[fround(c, 6).alias(c) for c in ["f_r1", "f_r5", "f_sigma", "f_z"]])


@register("if_features", _feature_sql(False))
def if_features(spark, sf_dir):
    """Online features [price, r1, r5, sigma20, z20] from row 20."""
    return _feature_cols(_features(spark, sf_dir, "online"))


@register("if_features_train", _feature_sql(True))
def if_features_train(spark, sf_dir):
    """Training-variant features (21-row window) from row 21."""
    return _feature_cols(_features(spark, sf_dir, "training"))


def _scaled_sql() -> str:
    inner = _feature_sql(False).replace("round((price - l1)", "((price - l1)").replace(
        "round((price - l5)", "((price - l5)").replace("round(sg, 6) + 0.0", "sg").replace(
        "round((price - mu) / sg, 6) + 0.0", "(price - mu) / sg").replace(
        ", 6) + 0.0 AS f_r1", ") AS f_r1").replace(", 6) + 0.0 AS f_r5", ") AS f_r5")
    cols = ["f_price", "f_r1", "f_r5", "f_sigma", "f_z"]
    scaled = ", ".join(
        f"round(({c} - avg({c}) OVER (PARTITION BY series)) / (CASE WHEN stddev_pop({c}) OVER (PARTITION BY series) = 0 "
        f"THEN 1.0 ELSE stddev_pop({c}) OVER (PARTITION BY series) END), 6) + 0.0 AS s_{c[2:]}" for c in cols)
    return f"WITH feat AS ({inner}) SELECT series, seq, {scaled} FROM feat"


@register("scaled_features", _scaled_sql())
def scaled_features(spark, sf_dir):
    """M1: standardise the 5 features per series (population sigma, zero sigma -> 1)."""
    from tickwatch.operators.iforest import standardize
    f = _features(spark, sf_dir, "online")
    s = standardize(f, ["f_price", "f_r1", "f_r5", "f_sigma", "f_z"], by=["series"])
    return s.select("series", "seq", *[fround(f"s_{c[2:]}", 6).alias(f"s_{c[2:]}")
                                       for c in ["f_price", "f_r1", "f_r5", "f_sigma", "f_z"]])


@register("if_epochs", f"""
WITH tk AS ({Q.ticks_cte()}),
n0 AS (SELECT series, seq, row_number() OVER (PARTITION BY series ORDER BY t_us, seq) - {C.IF_WINDOW - 1} AS n FROM tk),
e AS (SELECT series, seq, n, CASE WHEN n >= {C.IF_WARMUP} THEN CAST(floor((n - {C.IF_WARMUP}) / {C.IF_RETRAIN}) AS BIGINT) + 1
                                 ELSE 0 END AS epoch FROM n0 WHERE n >= 1)
SELECT series, seq, CAST(n AS BIGINT) AS n, epoch,
  CASE WHEN epoch > 0 THEN CAST(greatest(1, {C.IF_WARMUP} + (epoch - 1) * {C.IF_RETRAIN} - 799) AS BIGINT) END AS train_from,
  CASE WHEN epoch > 0 THEN CAST({C.IF_WARMUP} + (epoch - 1) * {C.IF_RETRAIN} AS BIGINT) END AS train_to
FROM e""")
def if_epochs(spark, sf_dir):
    """Feature row index, scoring model and that model's training range (cold start)."""
    from tickwatch.operators import schedule as S
    from tickwatch.operators.blocks import number_rows
    t = number_rows(events_ticks(spark, sf_dir), LAYOUT)
    n = S.feature_index(F.col("rn"))
    e = t.withColumn("n", n).where(F.col("n").isNotNull()).withColumn("epoch", S.scoring_epoch(F.col("n")))
    lo, hi = S.train_range(F.col("epoch"))
    return e.select("series", "seq", F.col("n").cast("long").alias("n"), "epoch",
                    F.when(F.col("epoch") > 0, lo).cast("long").alias("train_from"),
                    F.when(F.col("epoch") > 0, hi).cast("long").alias("train_to"))


# --------------------------------------------------------------------------- sequences and thresholds

_SEQ_S = "PARTITION BY series ORDER BY t_us, seq"
_SEQ_BASE = f"""
WITH tk AS ({Q.ticks_cte()}),
v0 AS (SELECT *, row_number() OVER ({_SEQ_S}) AS rn, count(*) OVER (PARTITION BY series) AS len,
  var_pop(price) OVER ({_SEQ_S} ROWS BETWEEN {C.SEQ_LEN - 1} PRECEDING AND CURRENT ROW) AS v60 FROM tk),
v AS (SELECT *, CASE WHEN rn >= {C.SEQ_LEN} THEN v60 END AS err FROM v0),
bt AS (SELECT series, avg(err) + {C.BASE_K} * stddev_pop(err) AS base FROM v
       WHERE rn >= {C.SEQ_LEN} AND rn < len GROUP BY series)"""


@register("price_sequences", f"""
WITH tk AS ({Q.ticks_cte()}),
s AS (SELECT *, row_number() OVER ({_SEQ_S}) AS rn,
  count(*) OVER ({_SEQ_S} ROWS BETWEEN {C.SEQ_LEN - 1} PRECEDING AND CURRENT ROW) AS length,
  first_value(price) OVER ({_SEQ_S} ROWS BETWEEN {C.SEQ_LEN - 1} PRECEDING AND CURRENT ROW) AS first_price,
  sum(price) OVER ({_SEQ_S} ROWS BETWEEN {C.SEQ_LEN - 1} PRECEDING AND CURRENT ROW) AS total FROM tk)
SELECT series, seq, length, first_price, price AS last_price, round(total, 4) AS total FROM s
WHERE rn >= {C.SEQ_LEN}""")
def price_sequences(spark, sf_dir):
    """Sliding 60-price windows including the current tick (from row 60)."""
    from tickwatch.operators.stats import price_sequences as ps
    b = detect.blocked(events_ticks(spark, sf_dir), LAYOUT, C.SEQ_LEN)
    s = ps(b).where(F.col("own") & F.col("seq_prices").isNotNull())
    return s.select("series", "seq", F.size("seq_prices").cast("long").alias("length"),
                    F.element_at("seq_prices", 1).alias("first_price"),
                    F.element_at("seq_prices", -1).alias("last_price"),
                    fround(F.aggregate("seq_prices", F.lit(0.0), lambda a, x: a + x), 4).alias("total"))


@register("sequence_scaler", f"""
WITH tk AS ({Q.ticks_cte()}),
n AS (SELECT *, row_number() OVER ({_SEQ_S}) AS rn, count(*) OVER (PARTITION BY series) AS len FROM tk),
w AS (SELECT *, greatest(0, least(len - 1, rn + {C.SEQ_LEN - 1}) - greatest({C.SEQ_LEN}, rn) + 1) AS wt FROM n),
m AS (SELECT series, sum(wt * price) / sum(wt) AS mu FROM w WHERE wt > 0 GROUP BY series)
SELECT w.series, round(m.mu, 6) AS seq_mean, round(sqrt(sum(wt * (price - m.mu) * (price - m.mu)) / sum(wt)), 6) AS seq_sd
FROM w JOIN m ON w.series = m.series WHERE wt > 0 GROUP BY w.series, m.mu""")
def sequence_scaler(spark, sf_dir):
    """M6: scalar scaler over all values of all training windows, per series."""
    from tickwatch.operators.blocks import number_rows
    from tickwatch.operators.sequence import sequence_scaler as ss
    s = ss(number_rows(events_ticks(spark, sf_dir), LAYOUT))
    return s.select("series", fround("seq_mean", 6).alias("seq_mean"), fround("seq_sd", 6).alias("seq_sd"))


def _var_frame(spark, sf_dir):
    """Blocked frame with the variance stand-in error and the per-series base threshold."""
    from tickwatch.operators.stats import sequence_variance
    b = sequence_variance(detect.blocked(events_ticks(spark, sf_dir), LAYOUT, C.SEQ_LEN + C.ERR_WINDOW))
    lengths = b.where(F.col("own")).groupBy("series").agg(F.max("rn").alias("_len"))
    train = b.where(F.col("own")).join(lengths, "series").where(
        (F.col("rn") >= C.SEQ_LEN) & (F.col("rn") < F.col("_len")))
    from tickwatch.operators.sequence import base_threshold_expr
    base = train.groupBy("series").agg(base_threshold_expr(F.col("var_err")).alias("base"))
    return b, base


@register("base_threshold", f"""{_SEQ_BASE}
SELECT series, round(base, 6) AS threshold FROM bt""")
def base_threshold(spark, sf_dir):
    """M8: mean + 3 sigma of training errors per series (error = variance of the 60 prices)."""
    _, base = _var_frame(spark, sf_dir)
    return base.select("series", fround("base", 6).alias("threshold"))


@register("dynamic_threshold", f"""{_SEQ_BASE},
d AS (SELECT v.*, bt.base,
  avg(err) OVER ({_SEQ_S} ROWS BETWEEN {C.ERR_WINDOW - 1} PRECEDING AND CURRENT ROW)
    + {C.ERR_K} * stddev_pop(err) OVER ({_SEQ_S} ROWS BETWEEN {C.ERR_WINDOW - 1} PRECEDING AND CURRENT ROW) AS dyn
  FROM v JOIN bt USING (series)),
e AS (SELECT *, CASE WHEN rn - {C.SEQ_LEN - 1} > {C.ERR_MIN} THEN dyn ELSE base END AS thr FROM d
      WHERE rn >= {C.SEQ_LEN})
SELECT series, seq, round(err, 6) AS error, round(thr, 6) AS threshold,
  round(err / (CASE WHEN thr = 0 THEN {C.THRESH_EPS} ELSE thr END), 6) AS ratio, err > thr AS flag FROM e""")
def dynamic_threshold(spark, sf_dir):
    """Adaptive threshold over the last <= 300 errors, ratio and flag."""
    from tickwatch.operators.stats import dynamic_threshold as dt
    b, base = _var_frame(spark, sf_dir)
    d = dt(b.join(base, "series", "left"), "var_err", F.col("base"))
    d = d.where(F.col("own") & F.col("var_err").isNotNull())
    return d.select("series", "seq", fround("var_err", 6).alias("error"), fround("threshold", 6).alias("threshold"),
                    fround("ratio", 6).alias("ratio"), F.col("err_flag").alias("flag"))


_WITH_MODEL = f"""{_SEQ_BASE},
d AS (SELECT v.*, bt.base,
  avg(err) OVER ({_SEQ_S} ROWS BETWEEN {C.ERR_WINDOW - 1} PRECEDING AND CURRENT ROW)
    + {C.ERR_K} * stddev_pop(err) OVER ({_SEQ_S} ROWS BETWEEN {C.ERR_WINDOW - 1} PRECEDING AND CURRENT ROW) AS dyn
  FROM v JOIN bt USING (series)),
th AS (SELECT *, CASE WHEN rn - {C.SEQ_LEN - 1} > {C.ERR_MIN} THEN dyn ELSE base END AS thr FROM d WHERE rn >= {C.SEQ_LEN}),
{Q.rules_ctes().replace("tk AS (", "tk2 AS (", 1).replace("FROM tk)", "FROM tk2)", 1)},
m AS (SELECT r.series, r.seq, th.err / (CASE WHEN th.thr = 0 THEN {C.THRESH_EPS} ELSE th.thr END) AS ratio,
        list_filter([CASE WHEN pct_spike THEN 'pct_spike' END, CASE WHEN abs_jump THEN 'abs_jump' END,
                     CASE WHEN vol_breakout THEN 'vol_breakout' END,
                     CASE WHEN mean_reversion_break THEN 'mean_reversion_break' END,
                     CASE WHEN th.err > th.thr THEN 'lstm_anomaly' END], lambda x: x IS NOT NULL) AS types
      FROM r LEFT JOIN th ON r.series = th.series AND r.seq = th.seq)"""


def _with_model(spark, sf_dir):
    """Rules and a sequence detector whose error is the windows' variance (a stand-in that SQL can express)."""
    from tickwatch.operators.rules import fired_types
    from tickwatch.operators.sequence import base_threshold_expr
    from tickwatch.operators.stats import dynamic_threshold as dt
    fr = detect.rule_frame(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT, var_err=True, own_only=False)
    own = fr.where("own")
    lengths = own.groupBy("series").agg(F.max("rn").alias("_len"))
    base = own.join(lengths, "series").where((F.col("rn") >= C.SEQ_LEN) & (F.col("rn") < F.col("_len"))) \
        .groupBy("series").agg(base_threshold_expr(F.col("var_err")).alias("base"))
    fr = dt(fr.join(base, "series", "left"), "var_err", F.col("base")).where("own")
    lstm = fired_types([(C.LSTM_ANOMALY, F.coalesce("err_flag", F.lit(False)))])
    return fr.select("series", "seq", "ratio", F.concat("rule_types", lstm).alias("types"))


@register("severity_with_model", f"""{_WITH_MODEL}
SELECT series, seq, array_to_string(types, ',') AS types,
  CASE WHEN list_has_any(types, ['pct_spike', 'abs_jump', 'lstm_anomaly']) THEN 'HIGH'
       WHEN list_has_any(types, ['vol_breakout', 'iforest_anomaly']) THEN 'MED' ELSE 'LOW' END AS full_sev,
  CASE WHEN list_has_any(types, {C.FALLBACK_HIGH}) THEN 'HIGH'
       WHEN list_has_any(types, {C.FALLBACK_MED}) THEN 'MED' ELSE 'LOW' END AS fallback_sev,
  CASE WHEN list_has_any(types, {C.RULES_ONLY_HIGH}) THEN 'HIGH'
       WHEN list_has_any(types, {C.RULES_ONLY_MED}) THEN 'MED' ELSE 'LOW' END AS rules_only_sev
FROM m WHERE len(types) > 0""")
def severity_with_model(spark, sf_dir):
    """P6-P9 on fired lists that hold a model's detector, where the three severity rules differ."""
    from tickwatch.functions.severity import severity as sev
    ev = _with_model(spark, sf_dir).where(F.size("types") > 0)
    return ev.select("series", "seq", F.array_join("types", ",").alias("types"), *[
        sev(F.col("types"), v).alias(f"{v}_sev") for v in ("full", "fallback", "rules_only")])


@register("recon_panel", f"""{_WITH_MODEL}
SELECT series, bool_or(coalesce(ratio, 0) > 0) AS active FROM m WHERE len(types) > 0 GROUP BY series""")
def recon_panel(spark, sf_dir):
    """does any event of a series carry a sequence score?"""
    from tickwatch.plans.report import recon_panel_active
    ev = _with_model(spark, sf_dir).where(F.size("types") > 0)
    return recon_panel_active(ev.withColumn("lstm_score", F.coalesce("ratio", F.lit(0.0))))


# --------------------------------------------------------------------------- sessions

@register("tick_sessions", f"""
WITH tk AS ({Q.ticks_cte()}),
g AS (SELECT *, CASE WHEN (t_us - lag(t_us) OVER ({_SEQ_S})) <= {EVENTS_PARAMS.max_dt} * 1e6 THEN 0 ELSE 1 END AS begins FROM tk),
s AS (SELECT *, sum(begins) OVER ({_SEQ_S}) AS session FROM g)
SELECT series, session::BIGINT AS session, {Q.fmt_ts('min(ts)')} AS first_ts, {Q.fmt_ts('max(ts)')} AS last_ts,
       count(*) AS ticks, min(price) AS lo, max(price) AS hi FROM s GROUP BY series, session""")
def tick_sessions(spark, sf_dir):
    """Sessions of each series: runs of ticks with gaps of at most ``max_dt``."""
    from tickwatch.operators.sessions import tick_sessions as ts
    out = ts(events_ticks(spark, sf_dir), EVENTS_PARAMS.max_dt, LAYOUT)
    return out.select("series", "session", _fmt_ts("first_ts").alias("first_ts"), _fmt_ts("last_ts").alias("last_ts"),
                      "ticks", "lo", "hi")


# --------------------------------------------------------------------------- models (rows-only checks)

@register("iforest_scores")
def iforest_scores(spark, sf_dir):
    """Walk-forward Isolation Forest score and flag of every tick."""
    f = detect.iforest_frame(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT)
    return f.select("series", "seq", fround("if_score", 4).alias("if_score"), "if_flag", "if_ready")


@register("iforest_trees")
def iforest_trees(spark, sf_dir):
    """M1 M2 (offline): one 100-tree forest per series over all training-variant feature rows."""
    from tickwatch.operators.iforest import fit_static, standardize
    from tickwatch.operators.stats import FEATURES
    f = _features(spark, sf_dir, "training")
    # sampling rates only need the rows per series: count the ticks, not the feature plan
    sizes = events_ticks(spark, sf_dir).groupBy("series").agg(F.count(F.lit(1)).alias("_n"))
    return fit_static(standardize(f, FEATURES, ["series"]), sizes=sizes)


@register("if_score_stats")
def if_score_stats(spark, sf_dir):
    """Average and max model score over events that carry one."""
    from tickwatch.plans.report import if_score_stats as iss
    return iss(detect.full_events(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT, sequence_k=None))


@register("recon_scores")
def recon_scores(spark, sf_dir):
    """Sequence-model error, adaptive threshold, ratio and flag per tick."""
    fr = detect.full_frame(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT, iforest=False)
    return fr.where(F.col("seq_err").isNotNull()).select(
        "series", "seq", fround("seq_err", 6).alias("error"), fround("threshold", 6).alias("threshold"),
        fround("ratio", 4).alias("ratio"), F.col("err_flag").alias("flag"))


@register("anomaly_events_full")
def anomaly_events_full(spark, sf_dir):
    """R5 with all six detectors (rules, walk-forward forest, sequence model)."""
    ev = detect.full_events(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT)
    return ev.select("series", "seq", "price", "pct_change", "abs_change",
                     F.array_join("types", ",").alias("types"), "severity", "if_score", "lstm_score")


@register("iforest_scores_pretrained")
def iforest_scores_pretrained(spark, sf_dir):
    """M2-M5 pre-trained start: a static model trained offline on the history
    (training-variant features, contamination 0.05) scores until the first refit."""
    from tickwatch.operators.iforest import train_static, walk_forward
    model = train_static(_features(spark, sf_dir, "training"))
    fr = detect.rule_frame(events_ticks(spark, sf_dir), EVENTS_PARAMS, LAYOUT, features="online")
    keep = ["series", "seq", "rn", "f_price", "f_r1", "f_r5", "f_sigma", "f_z"]
    out = walk_forward(fr.select(*keep), pretrained=model)
    return out.select("series", "seq", fround("if_score", 4).alias("if_score"), "if_flag", "if_ready")
