"""S1 + X1-X9: detection over a stream with Structured Streaming.

A stateful operator (``applyInPandasWithState``) keeps, in the query's own state
store, each series' last row number and its last K ticks.  For every micro-batch
it numbers the series' new ticks and hands them on behind those K context rows;
``foreachBatch`` then runs the *same* Spark plan as the batch path on them:

* the engine versions, checkpoints and prunes the state; a batch replayed after
  a failure starts from the state before it and overwrites its own outputs, so
  nothing is lost or doubled (X6, X8);
* a hot series inside one batch is still split into row blocks for the windows
  (its ticks of one micro-batch, which the source's rate options bound, are
  sorted in one task, as a keyed operator sees them);
* only new scored ticks are written, never the tail of a series again.

Order semantics (X4): ``late="as_arrived"`` numbers a batch's rows after all
earlier batches' rows (ordered by time inside the batch), as the live detector
does; a tick older than its predecessor then has dt < 0, skips the gated rules,
but still updates the rolling state.  ``late="drop"`` puts a watermark on the
ticks' time: the engine drops ticks more than ``max_lateness`` older than the
newest tick of all series in earlier batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tickwatch import constants as C
from tickwatch.operators import stats
from tickwatch.operators.rules import fired_types
from tickwatch.plans import detect
from tickwatch.schema import Layout, RuleParams
from tickwatch.session import checkpoint_dir
from tickwatch.sources.decode import decode_ticks
from tickwatch.sources.files import anomaly_json

STREAM_BLOCK_ROWS = 1 << 16

#: What the state store keeps of a series: its rows so far, and its last ticks.
SERIES_STATE = "rn long, t_us array<long>, seq array<long>, price array<double>"
NUMBERED = "series string, t_us long, seq long, price double, rn long, ctx boolean"

#: A scored tick as the feed log keeps it.
FEED_TICK = T.StructType([
    T.StructField("series", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("t_us", T.LongType()), T.StructField("seq", T.LongType()),
    T.StructField("price", T.DoubleType()), T.StructField("rn", T.LongType()),
    T.StructField("if_score", T.DoubleType()), T.StructField("anomaly", T.BooleanType()),
    T.StructField("if_ready", T.BooleanType())])


# ----------------------------------------------------------------------------- sources

def kafka_ticks(spark: SparkSession, servers: str, topic: str, starting: str = "latest",
                fail_on_data_loss: bool = False, **options: str) -> DataFrame:
    """Stream of ticks from a Kafka topic (payload = tick JSON, key = series, else the topic)."""
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers).option("subscribe", topic)
              .option("startingOffsets", starting).option("failOnDataLoss", str(fail_on_data_loss).lower()))
    for k, v in options.items():
        reader = reader.option(k, v)
    return decode_kafka_records(reader.load())


def decode_kafka_records(raw: DataFrame) -> DataFrame:
    """Kafka records (key, value, topic, offset, ...) -> canonical ticks: payload JSON in
    ``value``, series = key (else the topic), seq = offset."""
    series = F.coalesce(F.col("key").cast("string"), F.col("topic"))
    if "partition" in raw.columns:
        # without a key all partitions of a topic are one series, and offsets are unique in a partition only
        seq = F.when(F.col("key").isNull(), F.shiftleft("offset", 16) + F.col("partition")).otherwise(F.col("offset"))
    else:
        seq = F.col("offset")
    return decode_ticks(raw.withColumn("_seq", seq), "value", series=series).select(
        "series", "ts", "t_us", F.col("_seq").alias("seq"), "price")


def payload_file_ticks(spark: SparkSession, path: str, series: str = "series",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of tick payloads from JSON-lines files with ``series``, ``seq`` and ``value`` (payload text)."""
    schema = T.StructType([T.StructField(series, T.StringType()), T.StructField("seq", T.LongType()),
                           T.StructField("value", T.StringType())])
    r = spark.readStream.schema(schema).option("mode", "DROPMALFORMED")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = r.json(path)
    return decode_ticks(raw, "value", series=F.col(series)).select("series", "ts", "t_us", "seq", "price")


def parquet_file_ticks(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Stream of canonical ticks (series, ts, seq, price) from Parquet files."""
    schema = T.StructType([T.StructField("series", T.StringType()), T.StructField("ts", T.TimestampNTZType()),
                           T.StructField("seq", T.LongType()), T.StructField("price", T.DoubleType())])
    r = spark.readStream.schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.parquet(path).where(F.col("series").isNotNull() & F.col("ts").isNotNull() & F.col("price").isNotNull())
    return df.withColumn("t_us", F.unix_micros(F.col("ts").cast("timestamp")))


# ----------------------------------------------------------------------------- state

def numbering(keep_rows: int, drop_late: bool = False) -> Callable:
    """The stateful function: a series' new ticks numbered behind its last ``keep_rows`` ticks, which are
    sent first as context (``ctx``).  ``drop_late`` leaves out ticks up to the watermark (the engine's own
    filter before this operator uses the watermark of one batch earlier)."""
    def run(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        new = pd.concat([f[["t_us", "seq", "price"]] for f in frames], ignore_index=True)
        if drop_late:
            new = new[new["t_us"] > state.getCurrentWatermarkMs() * 1000]
        if new.empty:
            return
        rn, t_us, seq, price = state.get if state.exists else (0, [], [], [])
        new = new.sort_values(["t_us", "seq"], kind="stable", ignore_index=True)
        context = pd.DataFrame({"t_us": t_us, "seq": seq, "price": price}).astype(new.dtypes.to_dict())
        rows = pd.concat([context, new], ignore_index=True)
        rows.insert(0, "series", key[0])
        rows["rn"] = range(rn - len(context) + 1, rn + len(new) + 1)
        rows["ctx"] = rows.index < len(context)
        last = rows.tail(keep_rows)
        state.update((int(rows["rn"].iloc[-1]), last["t_us"].tolist(), last["seq"].tolist(), last["price"].tolist()))
        yield rows

    return run


# ----------------------------------------------------------------------------- detector

@dataclass
class StreamDetector:
    """Keyed stream detector; ``process`` is the ``foreachBatch`` callback.

    ``events_path`` gets the anomaly records, ``feed_path`` every scored tick (``read_feed`` gives the
    last ones of each series), ``totals_path`` a row of totals a batch (default: under the checkpoint),
    each in a folder ``batch_id=N`` that a replayed batch overwrites."""

    events_path: str
    feed_path: str | None = None
    totals_path: str | None = None
    params: RuleParams = field(default_factory=RuleParams)
    layout: Layout = field(default_factory=Layout)
    iforest: bool = False
    iforest_model: DataFrame | None = None  # from operators.iforest.train_static: pre-trained schedule
    sequence_model: object | None = None  # operators.sequence.SequenceModel
    late: str = "as_arrived"
    max_lateness: str = "1 millisecond"  # for late="drop"; a watermark drops the ticks at its own time as well

    def tail_rows(self) -> int:
        k = detect.needed_halo(self.sequence_model is not None)
        if self.iforest:
            k = max(k, C.IF_WINDOW + C.IF_RETRAIN + C.IF_WARMUP + C.IF_RETRAIN)  # fit window + open epoch
        return k

    def numbered(self, ticks: DataFrame) -> DataFrame:
        """The stream of numbered ticks with their context, from the engine's keyed state."""
        drop = self.late == "drop"
        rows = ticks.select("series", F.col("ts").cast("timestamp").alias("ts"), "t_us",
                            F.coalesce("seq", F.lit(0)).alias("seq"), "price")  # ticks without a number: 0
        if drop:
            rows = rows.withWatermark("ts", self.max_lateness)
        return rows.groupBy("series").applyInPandasWithState(
            numbering(self.tail_rows(), drop), NUMBERED, SERIES_STATE, "append",
            GroupStateTimeout.EventTimeTimeout if drop else GroupStateTimeout.NoTimeout)

    # -- one micro-batch ---------------------------------------------------------------
    def detect_batch(self, numbered: DataFrame) -> DataFrame:
        """All detector columns for the new rows (``ctx`` false) of a batch with its context."""
        # context and new rows must share one block size: micro-batches are bounded, use a fixed one
        block = int(self.layout.block_rows or STREAM_BLOCK_ROWS)
        rows = numbered.withColumn("ts", F.timestamp_micros("t_us").cast("timestamp_ntz")) \
            .withColumn("_B", F.lit(block).cast("long"))
        seq_on = self.sequence_model is not None
        fr = detect.rules_on_numbered(rows, self.params, self.layout,
                                      features="online" if self.iforest else None, sequences=seq_on,
                                      own_only=not seq_on)
        if seq_on:
            from tickwatch.operators.sequence import score_sequences
            fr = score_sequences(fr, self.sequence_model)
            fr = stats.dynamic_threshold(fr, "seq_err", F.lit(self.sequence_model.base_threshold)) \
                .where(F.col("own"))
        else:
            fr = fr.withColumn("ratio", F.lit(None).cast("double")).withColumn("err_flag", F.lit(None).cast("boolean"))
        keep = ["series", "seq", "ts", "t_us", "rn", "price", "pct_change", "abs_change", "rule_types",
                "mr_cond", "ratio", "err_flag", "ctx"]
        if self.iforest:
            from tickwatch.operators.iforest import walk_forward
            fr = fr.withColumn("_new", ~F.col("ctx"))
            out = walk_forward(fr.select(*keep, *stats.FEATURES, "_new"), score_rows="_new",
                               pretrained=self.iforest_model).drop("_new")
        else:
            out = fr.where(~F.col("ctx")).select(*keep).withColumn("if_score", F.lit(0.0)) \
                .withColumn("if_flag", F.lit(False)) \
                .withColumn("if_ready", F.col("rn") >= F.lit(C.IF_WARMUP + C.IF_WINDOW - 1))
        types = F.concat(F.col("rule_types"), fired_types([(C.IFOREST_ANOMALY, F.col("if_flag")),
                                                            (C.LSTM_ANOMALY, F.coalesce("err_flag", F.lit(False)))]))
        return out.withColumn("types", types).withColumn("lstm_score", F.coalesce("ratio", F.lit(0.0)))

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        # several scans below: evaluate the stateful operator once
        rows = batch.checkpoint()
        if rows.isEmpty():  # X7: nothing to do
            return
        seen = Observation()
        scored = self.detect_batch(rows).observe(seen, F.count(F.lit(1)).alias("ticks"),
                                                 F.count_if(F.size("types") > 0).alias("anomalies"))
        scored = scored.select("series", "ts", "t_us", "seq", "price", "rn", "if_score", "if_ready", "pct_change",
                               "abs_change", "types", "lstm_score", (F.size("types") > 0).alias("anomaly"))
        if self.feed_path:
            # the whole batch is written once; its events are read from there
            folder = f"{self.feed_path}/batch_id={batch_id}"
            scored.write.mode("overwrite").parquet(folder)
            scored = spark.read.schema(scored.schema).parquet(folder)
        events = detect.event_record(scored, types="types", if_score="if_score", lstm_score="lstm_score")
        anomaly_json(events).write.mode("overwrite").json(f"{self.events_path}/batch_id={batch_id}")
        if self.totals_path:
            totals = spark.range(1).select(*[F.lit(v).cast("long").alias(k) for k, v in seen.get.items()])
            totals.write.mode("overwrite").json(f"{self.totals_path}/batch_id={batch_id}")

    def start(self, ticks: DataFrame, checkpoint: str | None = None, trigger: str | None = "3 seconds",
              available_now: bool = False):
        """Run ``process`` per micro-batch (processing-time trigger, or availableNow).

        ``checkpoint`` is a lasting path of this query's own: it holds the offsets and the state, so a
        restarted application finds both."""
        if not checkpoint:
            raise ValueError("a checkpoint path is needed: without it a restart finds neither offsets nor state")
        checkpoint_dir(ticks.sparkSession)
        if not self.totals_path:
            self.totals_path = checkpoint.rstrip("/") + "/tickwatch-totals"
        w = self.numbered(ticks).writeStream.outputMode("append").foreachBatch(self.process) \
            .option("checkpointLocation", checkpoint)
        w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=trigger)
        return w.start()


def read_events(spark: SparkSession, events_path: str) -> DataFrame:
    """Read back the anomaly log written by ``StreamDetector``."""
    from tickwatch.schema import ANOMALY_EVENT
    schema = T.StructType(list(ANOMALY_EVENT.fields) + [T.StructField("series", T.StringType()),
                                                        T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).json(events_path)


def read_feed(spark: SparkSession, feed_path: str, n: int | None = C.MAX_PRICE_HISTORY) -> DataFrame:
    """The last ``n`` scored ticks of each series (all with None) from the feed log of a detector, by arrival."""
    ticks = spark.read.schema(FEED_TICK).parquet(feed_path)
    if n is None:
        return ticks
    newest = ticks.groupBy("series").agg(F.max("rn").alias("_last"))
    return ticks.join(newest, "series").where(F.col("rn") > F.col("_last") - n).drop("_last")


def lifetime_totals(spark: SparkSession, totals_path: str) -> DataFrame:
    """Batches, ticks, anomalies and their rate over the whole life of a detector query, restarts included."""
    rows = spark.read.schema("ticks long, anomalies long, batch_id long").json(totals_path)
    return rows.agg(F.count(F.lit(1)).alias("batches"), F.coalesce(F.sum("ticks"), F.lit(0)).alias("total_rows"),
                    F.coalesce(F.sum("anomalies"), F.lit(0)).alias("total_anomalies")) \
        .withColumn("anomaly_rate", F.coalesce(F.try_divide("total_anomalies", "total_rows"), F.lit(0.0)))


# ----------------------------------------------------------------------------- sinks and run statistics

def kafka_sink(ticks: DataFrame, servers: str, topic: str, checkpoint: str | None = None):
    """Publish tick payloads {timestamp, price, change} to Kafka (key = series, acks=all).

    Works for static frames (``write``) and streams (``writeStream``); the
    producer-side change (P3) is expected in a ``change`` column when present."""
    from tickwatch.sources.decode import encode_ticks
    enc = encode_ticks(ticks, "change" if "change" in ticks.columns else None).select(
        F.col("key").cast("string").alias("key"), F.col("value"))
    if ticks.isStreaming:
        ckpt = checkpoint or checkpoint_dir(ticks.sparkSession).rstrip("/") + "/tickwatch-kafka-sink"
        return (enc.writeStream.format("kafka").option("kafka.bootstrap.servers", servers)
                .option("topic", topic).option("kafka.acks", "all").option("checkpointLocation", ckpt).start())
    enc.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic) \
        .option("kafka.acks", "all").save()
    return None


def run_stats(query) -> dict:
    """Rows and rate of a running detector query from its newest progress reports
    (``lifetime_totals`` has those of its whole life)."""
    progress = query.recentProgress or []
    total = sum(int(p.get("numInputRows", 0)) for p in progress)
    last = progress[-1] if progress else {}
    return {"batches": len(progress), "total_rows": total,
            "input_rows_per_second": last.get("inputRowsPerSecond"),
            "processed_rows_per_second": last.get("processedRowsPerSecond")}


def minute_counts_stream(events: DataFrame, watermark: str = "10 minutes") -> DataFrame:
    """X5 + A9 (streaming form): events per series and 1-minute tumbling window, with a
    watermark so late events are bounded and append mode emits each closed minute once
    (empty minutes produce no row here; the batch form zero-fills)."""
    ts = F.col("ts").cast("timestamp")
    return (events.withColumn("_ts", ts).withWatermark("_ts", watermark)
            .groupBy("series", F.window("_ts", "1 minute").alias("w"))
            .agg(F.count(F.lit(1)).alias("count"))
            .select("series", F.col("w.start").alias("minute"), F.col("count").cast("long").alias("count")))


def tick_sessions_stream(ticks: DataFrame, gap_seconds: float, watermark: str = "10 minutes") -> DataFrame:
    """Sessions of each series in event time: runs of ticks at most ``gap_seconds`` apart.

    Append mode gives each session once, when the watermark has passed its end.  The batch form is
    ``report.tick_sessions``.  (Spark's session windows end a gap after their last tick, so ticks
    exactly that gap apart would part; one microsecond more keeps them together.)"""
    gap = F.lit(f"{int(round(gap_seconds * 1e6)) + 1} microseconds")
    return (ticks.select("series", F.col("ts").cast("timestamp").alias("_ts"), "price").withWatermark("_ts", watermark)
            .groupBy("series", F.session_window("_ts", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("ticks"), F.min("_ts").alias("first_ts"), F.max("_ts").alias("last_ts"),
                 F.min("price").alias("lo"), F.max("price").alias("hi"))
            .select("series", F.col("first_ts").cast("timestamp_ntz").alias("first_ts"),
                    F.col("last_ts").cast("timestamp_ntz").alias("last_ts"), F.col("ticks").cast("long").alias("ticks"), "lo", "hi"))
