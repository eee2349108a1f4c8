"""File sources and sinks.

Readers use explicit schemas (no inference) and tolerate bad lines; writers are
plain DataFrame writers, partitioned so later reads prune by series/date.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch import constants as C
from tickwatch.functions.numeric import fround
from tickwatch.functions.severity import fallback_severity, primary_type
from tickwatch.plans.report import last_n
from tickwatch.schema import ANOMALY_LOG_TEXT, PRICE_FEED_ROW, t_us
from tickwatch.sources.decode import iso_utc, parse_iso


def anomaly_json(events: DataFrame) -> DataFrame:
    """D6 record layout of an event table (timestamp text + numbers + types + severity + scores)."""
    return events.select(
        "series", iso_utc(F.col("ts")).alias("timestamp"), "price", "pct_change", "abs_change", "types",
        "severity", "if_score", "lstm_score", F.to_date("ts").alias("date"))


def write_anomaly_log(events: DataFrame, path: str, mode: str = "append") -> None:
    """Append events as JSON lines, partitioned by series and date."""
    anomaly_json(events).write.mode(mode).partitionBy("series", "date").json(path)


def truncate(spark: SparkSession, path: str, schema) -> None:
    """Start a fresh session: replace the output with an empty one (opt-in)."""
    spark.createDataFrame([], schema).write.mode("overwrite").json(path)


def read_anomaly_log(spark: SparkSession, path: str, max_rows: int | None = C.ANOMALY_LOG_ROWS) -> DataFrame:
    """S7 / S9 + P10-P12 + O2: tolerant read of the JSON-lines log; blank and
    malformed lines are skipped, numbers coerce with 0.0 default (price stays
    NULL), non-list types become [], missing severity is derived (P8); last
    ``max_rows`` per series by time."""
    raw = (spark.read.schema(ANOMALY_LOG_TEXT).option("mode", "DROPMALFORMED").json(path))
    return coerce_anomaly_log(raw, max_rows)


def coerce_anomaly_log(raw: DataFrame, max_rows: int | None = C.ANOMALY_LOG_ROWS) -> DataFrame:
    types = F.coalesce(F.from_json(F.col("types"), "array<string>"), F.array().cast("array<string>"))
    ts = parse_iso(F.col("timestamp"))

    def num(c: str, default: float | None = 0.0):
        v = F.col(c).try_cast("double")
        return F.coalesce(v, F.lit(default)) if default is not None else v

    out = raw.select(
        F.coalesce(F.col("series"), F.lit("")).alias("series"), ts.alias("ts"), types.alias("types"),
        num("price", None).alias("price"), num("pct_change").alias("pct_change"),
        num("abs_change").alias("abs_change"), num("if_score").alias("if_score"),
        num("lstm_score").alias("lstm_score"),
        F.coalesce(F.col("severity"), fallback_severity(types)).alias("severity"),
        F.col("timestamp").alias("ts_iso"))
    out = out.withColumn("primary_type", primary_type(F.col("types"))) \
        .withColumn("t_us", t_us(F.col("ts")))
    # the log has no sequence number: equal times are ordered by content, the same in every run
    out = out.withColumn("seq", F.xxhash64(*out.columns))
    if max_rows:
        out = last_n(out, max_rows).drop("pos")
    return out.orderBy("series", "t_us", "seq")


def write_price_feed(feed: DataFrame, path: str, n: int = C.MAX_PRICE_HISTORY) -> None:
    """Overwrite the last ``n`` ticks per series (D7 rows)."""
    last = last_n(feed, n)
    last.select("series", iso_utc(F.col("ts")).alias("timestamp"), fround("price", C.ROUND_PRICE).alias("price"),
                fround("if_score", C.ROUND_SCORE).alias("if_score"), "anomaly", "if_ready") \
        .write.mode("overwrite").partitionBy("series").json(path)


def read_price_feed(spark: SparkSession, path: str, multiline: bool = False) -> DataFrame:
    """Read the feed as text fields and coerce them (bad scores 0.0, bad flags false),
    drop rows without time or price, order by time."""
    schema = T.StructType([T.StructField(f.name, T.StringType()) for f in PRICE_FEED_ROW.fields]
                          + [T.StructField("series", T.StringType())])
    return coerce_price_feed(spark.read.schema(schema).option("multiLine", multiline).option("mode", "DROPMALFORMED").json(path))


def coerce_price_feed(raw: DataFrame) -> DataFrame:
    ts = parse_iso(F.col("timestamp"))

    def flag(c: str):
        return F.coalesce(F.col(c).try_cast("boolean"), F.lit(False)).alias(c)

    return (raw.select(F.coalesce("series", F.lit("")).alias("series"), ts.alias("ts"),
                       F.col("price").try_cast("double").alias("price"),
                       F.coalesce(F.col("if_score").try_cast("double"), F.lit(0.0)).alias("if_score"),
                       flag("anomaly"), flag("if_ready"))
            .where(F.col("ts").isNotNull() & F.col("price").isNotNull())
            .withColumn("t_us", t_us(F.col("ts"))).orderBy("series", "t_us"))


def export_csv(table: DataFrame, path: str) -> None:
    """filtered/formatted events as CSV with a header."""
    table.write.mode("overwrite").option("header", True).csv(path)


def last_n_closes(ticks: DataFrame, n: int) -> DataFrame:
    """The last ``n`` closes per series, in time order."""
    return last_n(ticks, n).drop("pos")


def save_history(ticks: DataFrame, path: str) -> None:
    """Persist a close history (series, ts, seq, price) as Parquet partitioned by series."""
    ticks.select("series", "ts", "seq", "price").write.mode("overwrite").partitionBy("series").parquet(path)


def save_model(model: DataFrame, path: str) -> None:
    """M5: persist a model table (of ``train_static``) as Parquet."""
    model.write.mode("overwrite").parquet(path)


def load_model(spark: SparkSession, path: str) -> DataFrame | None:
    """M5: the model table saved at ``path``; None where there is none, so that a detector starts cold."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def load_history(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.parquet(path)
    return df.withColumn("t_us", t_us(F.col("ts")))
