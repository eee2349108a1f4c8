"""Report operators over an anomaly-event table and a tick feed (A1-A15, P16-P20,
F4-F11, J1, O2-O5).  Everything is keyed by ``series``; per-series "last N"
uses ``row_number`` (planned as WindowGroupLimit: partial top-k before the
shuffle) and zero-filled domains are generated from per-series bounds, never by
joining against a cross product.

``events``: series, seq, ts, t_us, price, pct_change, abs_change, types
(array<string>), severity, if_score, lstm_score.
``feed``: series, seq, ts, t_us, price, if_score, anomaly, if_ready.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.functions.numeric import fround
from tickwatch.functions.severity import layer_tag, rules_only_severity, type_description, type_layer, type_meta_severity
from tickwatch.schema import Layout
from tickwatch.session import checkpoint_dir

def newest() -> list[Column]:
    return [F.col("t_us").desc(), F.col("seq").desc()]


def last_n(df: DataFrame, n: int, keys: tuple[str, ...] = ("series",)) -> DataFrame:
    """O3: the last ``n`` rows per key by (t_us, seq); keeps ``pos`` (1 = newest).

    Up to Spark's window-group-limit threshold the ``row_number <= n`` filter is
    planned as WindowGroupLimit (partial top-k before the shuffle).  Beyond it a
    plain window would move a whole series into one task, so the bucketed row
    numbering is used instead: pos = rows of series - rn + 1.  Rows without a time
    are the oldest of their series, whatever ``n`` is."""
    limit = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
    if n <= limit or tuple(keys) != ("series",):
        w = Window.partitionBy(*keys).orderBy(*newest())
        return df.withColumn("pos", F.row_number().over(w).cast("long")).where(F.col("pos") <= n)
    from tickwatch.operators.blocks import number_rows
    # counted, sampled for the ranges' bounds and dealt out: evaluate the rows once
    checkpoint_dir(df.sparkSession)
    df = df.checkpoint()
    cols = df.columns
    stash = {c: f"_keep_{c}" for c in ("rn", "_n", "_B", "pos") if c in cols}
    for c, t in stash.items():
        df = df.withColumnRenamed(c, t)
    numbered = number_rows(df.where(F.col("t_us").isNotNull()), Layout())
    out = numbered.withColumn("pos", (F.col("_n") - F.col("rn") + 1).cast("long")).where(F.col("pos") <= n) \
        .drop("rn", "_n", "_B")
    # rows without a time, numbered by their own order (as if it were the time) and put behind the others
    timed = df.where(F.col("t_us").isNotNull()).groupBy("series").agg(F.count(F.lit(1)).alias("_timed"))
    untimed = df.where(F.col("t_us").isNull()).withColumn("t_us", F.col("seq"))
    untimed = number_rows(untimed, Layout()).join(timed, "series", "left") \
        .withColumn("pos", (F.coalesce("_timed", F.lit(0)) + F.col("_n") - F.col("rn") + 1).cast("long")) \
        .where(F.col("pos") <= n).drop("rn", "_n", "_B", "_timed").withColumn("t_us", F.lit(None).cast("long"))
    out = out.unionByName(untimed)
    for c, t in stash.items():
        out = out.withColumnRenamed(t, c)
    return out.select(*cols, "pos")


# ------------------------------------------------------------------ filters F4-F6, F11

def filter_predicate(severities: list[str] | None, types: list[str] | None) -> Column:
    """F4 + F5 + F11: severity IN set AND any fired type in set; an empty set selects nothing."""
    if not severities or not types:
        return F.lit(False)
    return F.col("severity").isin(*severities) & F.coalesce(
        F.arrays_overlap(F.col("types"), F.array(*[F.lit(t) for t in types])), F.lit(False))


def preset(name: str) -> Column:
    """named presets 'all', 'high', 'ml'."""
    types, sevs = C.PRESETS[name]
    return filter_predicate(sevs, types)


def filter_view(events: DataFrame, preset_name: str = "all", max_rows: int = C.VIEW_ROWS_DEFAULT,
                severities: list[str] | None = None, types: list[str] | None = None) -> DataFrame:
    pred = preset(preset_name) if severities is None and types is None else filter_predicate(severities, types)
    return last_n(events.where(pred), max_rows)


# ------------------------------------------------------------------ counts A1-A4, P15, P21

def severity_counts(events: DataFrame) -> DataFrame:
    """A1 + A4: HIGH, MED, LOW counts per series (always three rows), percent of total to 1 decimal."""
    agg = events.groupBy("series").agg(
        *[F.count_if(F.col("severity") == s).alias(s) for s in C.SEVERITIES],
        F.count(F.lit(1)).alias("_total"))
    stacked = agg.select("series", "_total", F.inline(F.array(*[
        F.struct(F.lit(s).alias("severity"), F.lit(i).alias("rank"), F.col(s).alias("count"))
        for i, s in enumerate(C.SEVERITIES)])))
    return stacked.select("series", "severity", "rank", F.col("count").cast("long").alias("count"),
                          fround(F.col("count").cast("double") / F.col("_total") * F.lit(100.0), 1).alias("pct"))


def type_counts(events: DataFrame, per_series: bool = False) -> DataFrame:
    """A2 + P15 + P21 + O5: fired-detector counts (exploded list) with metadata, most frequent first."""
    keys = ["series", "type"] if per_series else ["type"]
    ex = events.select("series", "t_us", "seq", F.explode("types").alias("type"))
    c = ex.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    layer = type_layer(F.col("type"))
    return (c.select(*keys, "count", layer.alias("layer"), type_meta_severity(F.col("type")).alias("severity"),
                     layer_tag(layer).alias("layer_tag"), type_description(F.col("type")).alias("description"))
            .orderBy(F.col("count").desc(), "type"))


def top_detector(events: DataFrame) -> DataFrame:
    """A3: most frequent detector per series; a tie goes to the type seen first."""
    ex = events.select("series", "t_us", "seq", F.posexplode("types").alias("p", "type"))
    c = ex.groupBy("series", "type").agg(F.count(F.lit(1)).alias("count"),
                                         F.min(F.struct("t_us", "seq", "p")).alias("first"))
    best = F.max_by(F.struct("type", "count"),
                    F.struct(F.col("count"), F.lit(0) - F.col("first.t_us"), F.lit(0) - F.col("first.seq"),
                             F.lit(0) - F.col("first.p")))
    return c.groupBy("series").agg(best.alias("b")).select(
        "series", F.col("b.type").alias("top_type"), F.col("b.count").cast("long").alias("count"))


# ------------------------------------------------------------------ KPIs A5-A8, A12, P18-P20

def elapsed_label(seconds: Column) -> Column:
    """P18: 'Xh Ym' from one hour on, else 'Xm Ys'."""
    s = seconds
    return F.when(s >= 3600, F.format_string("%dh %dm", F.floor(s / 3600).cast("long"),
                                             F.floor((s % 3600) / 60).cast("long"))) \
        .otherwise(F.format_string("%dm %ds", F.floor(s / 60).cast("long"), F.floor(s % 60).cast("long")))


def rate_band(rate: Column) -> Column:
    """5-20 % normal, above high, else quiet."""
    return F.when((rate >= C.RATE_NORMAL_LO) & (rate <= C.RATE_NORMAL_HI), F.lit("normal")) \
        .when(rate > C.RATE_NORMAL_HI, F.lit("high")).otherwise(F.lit("quiet"))


def session_kpis(feed: DataFrame, events: DataFrame | None = None) -> DataFrame:
    """A5-A7, A12, P18-P20 per series: the feed gives ticks / price range / span /
    model readiness, the event table gives anomaly counts (same time range).

    With ``events=None`` the feed itself carries ``anomaly`` and ``severity`` per
    tick and everything is one aggregation (one pass over the detector plan)."""
    feed_aggs = [F.count(F.lit(1)).alias("ticks"),
                 F.max("price").alias("hi"), F.min("price").alias("lo"),
                 ((F.max("t_us") - F.min("t_us")) / F.lit(1e6)).alias("span_s"),
                 F.max_by("if_ready", F.struct("t_us", "seq")).alias("if_ready")]
    if events is None:
        anom = F.col("anomaly")
        j = feed.groupBy("series").agg(
            *feed_aggs, F.count_if(anom).alias("anomalies"),
            F.count_if(anom & (F.col("severity") == "HIGH")).alias("high"),
            F.count_if(anom & (F.col("severity") == "MED")).alias("med"))
    else:
        f = feed.groupBy("series").agg(*feed_aggs)
        e = events.groupBy("series").agg(
            F.count(F.lit(1)).alias("anomalies"),
            F.count_if(F.col("severity") == "HIGH").alias("high"),
            F.count_if(F.col("severity") == "MED").alias("med"))
        j = f.join(e, "series", "left")
    rate = F.coalesce(F.col("anomalies"), F.lit(0)).cast("double") / F.greatest(F.col("ticks"), F.lit(1)) * 100.0
    pad = F.greatest((F.col("hi") - F.col("lo")) * F.lit(C.CHART_PAD_FRACTION), F.lit(C.CHART_PAD_MIN))
    return j.select(
        "series", F.col("ticks").cast("long").alias("ticks"),
        F.coalesce("anomalies", F.lit(0)).cast("long").alias("anomalies"),
        F.coalesce("high", F.lit(0)).cast("long").alias("high"),
        F.coalesce("med", F.lit(0)).cast("long").alias("med"),
        fround(rate, 4).alias("rate"), rate_band(rate).alias("band"),
        "hi", "lo", fround(F.col("hi") - F.col("lo"), 6).alias("range"),
        fround(F.col("lo") - pad, 6).alias("y_min"), fround(F.col("hi") + pad, 6).alias("y_max"),
        fround("span_s", 6).alias("span_s"), elapsed_label(F.col("span_s")).alias("elapsed"),
        fround(F.least(F.col("ticks") / F.lit(float(C.IF_WARMUP)), F.lit(1.0)), 6).alias("warmup"),
        F.col("if_ready"))


def mixed_window_kpis(feed: DataFrame, events: DataFrame, ticks: int = C.MAX_PRICE_HISTORY,
                      log_rows: int = C.ANOMALY_LOG_ROWS) -> DataFrame:
    """A5 as a live view shows it: the last ``ticks`` of the feed against the last ``log_rows`` of the event log,
    whatever their times, so the rate can exceed 100 %."""
    return session_kpis(last_n(feed, ticks), last_n(events, log_rows))


def latest_delta(feed: DataFrame) -> DataFrame:
    """Latest and previous price per series (previous = latest for a single row);
    percent delta is 0 when the previous price is 0."""
    top2 = last_n(feed, 2)
    g = top2.groupBy("series").agg(
        F.max(F.when(F.col("pos") == 1, F.col("price"))).alias("price"),
        F.max(F.when(F.col("pos") == 2, F.col("price"))).alias("_prev"))
    prev = F.coalesce(F.col("_prev"), F.col("price"))
    delta = F.col("price") - prev
    return g.select("series", "price", prev.alias("prev"), fround(delta, 6).alias("delta"),
                    fround(F.coalesce(F.try_divide(delta, F.when(prev != 0, prev)) * 100.0, F.lit(0.0)), 6)
                    .alias("delta_pct"))


# ------------------------------------------------------------------ J1, A9, A10, A11, A15

def anomalies_in_window(events: DataFrame, feed: DataFrame) -> DataFrame:
    """Per series of the feed, anomalies at or after its first tick (0 without any)."""
    first = feed.groupBy("series").agg(F.min("t_us").alias("_first"))
    counted = anomaly_rows_in_window(events, feed).groupBy("series").agg(F.count(F.lit(1)).alias("_n"))
    return first.join(counted, "series", "left").select("series", F.coalesce("_n", F.lit(0)).cast("long").alias("count"))


def anomaly_rows_in_window(events: DataFrame, feed: DataFrame) -> DataFrame:
    """The anomalies at or after the first tick of their series' feed."""
    first = feed.groupBy("series").agg(F.min("t_us").alias("_first"))
    return events.join(first, "series").where(F.col("t_us") >= F.col("_first")).drop("_first")


#: Minutes of a day: the most elements of an array while empty minutes are filled in.
DAY = 1440


def events_per_minute(events: DataFrame) -> DataFrame:
    """Events per minute per series, empty minutes included as 0, between the
    first and last event minute of the series.

    Each minute with events is followed by its own gap up to the next one, cut into pieces of 1440 days,
    days and minutes.  Pieces are dealt out anew before they are cut further: a far time makes many rows,
    but neither a long array nor a long task (Spark holds all rows that a row explodes to within a stage)."""
    us = F.unix_micros(F.col("ts").cast("timestamp_ntz").cast("timestamp"))
    minute = F.expr("(_us - pmod(_us, 60000000)) div 60000000")
    counts = events.select("series", us.alias("_us")).groupBy("series", minute.alias("_m")).agg(F.count(F.lit(1)).alias("_c"))
    after = F.lead("_m").over(Window.partitionBy("series").orderBy("_m"))
    rows = counts.withColumn("_n", F.coalesce(after - F.col("_m"), F.lit(1)))
    rows = rows.withColumn("_at", F.lit(0).cast("long")).withColumn("_left", F.col("_n"))
    for size in (DAY * DAY, DAY, 1):
        if size < DAY * DAY:
            rows = rows.repartition("series", "_m", "_at")
        piece = F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(_left - 1) div {size}")))
        rows = rows.select("series", "_m", "_c", "_at", "_left", piece.alias("_i")).select(
            "series", "_m", "_c", (F.col("_at") + F.col("_i") * size).alias("_at"),
            F.least(F.lit(size), F.col("_left") - F.col("_i") * size).alias("_left"))
    return rows.select("series", F.timestamp_micros((F.col("_m") + F.col("_at")) * 60_000_000).cast("timestamp_ntz").alias("minute"),
                       F.when(F.col("_at") == 0, F.col("_c")).otherwise(F.lit(0)).cast("long").alias("count"))


def nice_step(lo: Column, hi: Column, maxbins: int = C.HIST_MAXBINS) -> Column:
    """Bin width: (hi - lo) / maxbins rounded up to 1, 2 or 5 times a power of ten."""
    raw = (hi - lo) / F.lit(float(maxbins))
    p = F.pow(F.lit(10.0), F.floor(F.log10(raw)))
    return F.when(raw <= 0, F.lit(None).cast("double")) \
        .when(raw <= p, p).when(raw <= 2 * p, 2 * p).when(raw <= 5 * p, 5 * p).otherwise(10 * p)


def pct_histogram(events: DataFrame, maxbins: int = C.HIST_MAXBINS) -> DataFrame:
    """A10 + F7: histogram of non-zero percent changes by severity, <= ``maxbins`` nice bins."""
    x = events.where(F.abs("pct_change") > 0)
    bounds = x.agg(F.min("pct_change").alias("lo"), F.max("pct_change").alias("hi"))
    step = bounds.select(nice_step(F.col("lo"), F.col("hi"), maxbins)).scalar()
    b = F.coalesce(F.floor(F.col("pct_change") / step) * step, F.col("pct_change"))
    return x.groupBy("severity", fround(b, 6).alias("bin_start")).agg(
        F.count(F.lit(1)).cast("long").alias("count"))


def if_score_stats(events: DataFrame) -> DataFrame:
    """A11 + F8: average and max model score over events that carry one."""
    return events.where(F.col("if_score") > 0).groupBy("series").agg(
        F.avg("if_score").alias("avg_if"), F.max("if_score").alias("max_if"),
        F.count(F.lit(1)).cast("long").alias("n"))


def active_alert(events: DataFrame) -> DataFrame:
    """latest HIGH event per series."""
    h = last_n(events.where(F.col("severity") == "HIGH"), 1)
    return h.select("series", "seq", F.date_format("ts", "HH:mm:ss").alias("time"),
                    F.format_string("$%,.2f", fround("price", 2)).alias("price"),
                    F.format_string("%+.4f%%", fround("pct_change", 4)).alias("delta_pct"),
                    F.array_join(F.transform("types", lambda t: F.concat(F.lit("`"), t, F.lit("`"))), " · ")
                    .alias("detectors"))


# ------------------------------------------------------------------ P16, P17, O4

def event_log(events: DataFrame, max_rows: int = C.VIEW_ROWS_DEFAULT) -> DataFrame:
    """P16 + O4: formatted event log, newest first (``pos`` 1 = newest)."""
    v = last_n(events, max_rows)
    dash = F.lit("—")
    return v.select(
        "series", "pos",
        F.date_format("ts", "HH:mm:ss").alias("time_utc"),
        F.when(F.col("price").isNull(), dash).otherwise(F.format_string("$%,.2f", fround("price", 2))).alias("price"),
        F.format_string("%+.4f%%", fround("pct_change", 4)).alias("delta_pct"),
        F.concat(F.lit("$"), F.format_string("%+.2f", fround("abs_change", 2))).alias("delta_abs"),
        "severity",
        F.coalesce(F.try_element_at("types", F.lit(1)), F.lit("unknown")).alias("main_detector"),
        F.when(F.col("if_score") > 0, F.format_string("%.3f", fround("if_score", 3))).otherwise(dash).alias("if_score"),
        F.when(F.col("lstm_score") > 0, F.format_string("%.3f", fround("lstm_score", 3))).otherwise(dash)
        .alias("lstm_score"),
        F.array_join("types", " · ").alias("all_detectors"))


def recent_alerts(events: DataFrame, read_rows: int = C.ALERT_LOG_ROWS, show: int = C.ALERT_SHOW_ROWS) -> DataFrame:
    """P17 + A15: of the last ``read_rows`` events per series, the ``show`` newest as
    plain alert lines (rules-only severity), with the window's total and last time."""
    tail = last_n(events, read_rows)
    w = Window.partitionBy("series")
    na = F.lit("n/a")
    out = tail.withColumn("total", F.count(F.lit(1)).over(w).cast("long")) \
        .withColumn("last_time", F.max(F.when(F.col("pos") == 1, F.substring(F.col("ts_iso"), 1, 19))).over(w))
    return out.where(F.col("pos") <= show).select(
        "series", "pos", "total", "last_time",
        F.substring("ts_iso", 1, 19).alias("time"),
        F.when(F.col("price").isNull(), na).otherwise(F.format_string("%,.2f", fround("price", 2))).alias("price"),
        F.when(F.col("pct_change").isNull(), na).otherwise(F.format_string("%+.4f%%", fround("pct_change", 4)))
        .alias("pct"),
        F.when(F.col("abs_change").isNull(), na).otherwise(F.format_string("%+.2f", fround("abs_change", 2)))
        .alias("abs"),
        rules_only_severity(F.col("types")).alias("severity"),
        F.when(F.size("types") > 0, F.array_join("types", ",")).otherwise(F.lit("-")).alias("types"))


def recon_panel_active(events: DataFrame) -> DataFrame:
    """per series, whether any event carries a sequence-model score (> 0)."""
    return events.groupBy("series").agg(F.bool_or(F.col("lstm_score") > 0).alias("active"))
