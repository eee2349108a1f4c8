"""Schemas, parameters and adapters from driver tables to canonical ticks.

Canonical tick: ``series STRING, ts TIMESTAMP_NTZ (UTC wall clock), seq BIGINT,
price DOUBLE`` plus ``t_us BIGINT`` (epoch microseconds) used for arithmetic.
Every per-series order is ``(t_us, seq)``; ``seq`` makes it total.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickwatch import constants as C

TICK_PAYLOAD = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("change", T.DoubleType()),
])

ANOMALY_EVENT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("pct_change", T.DoubleType()),
    T.StructField("abs_change", T.DoubleType()),
    T.StructField("types", T.ArrayType(T.StringType())),
    T.StructField("severity", T.StringType()),
    T.StructField("if_score", T.DoubleType()),
    T.StructField("lstm_score", T.DoubleType()),
])

# Loose reader schema for the anomaly log: every field as text so that bad
# values coerce instead of failing the scan.
ANOMALY_LOG_TEXT = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.StringType()),
    T.StructField("pct_change", T.StringType()),
    T.StructField("abs_change", T.StringType()),
    T.StructField("types", T.StringType()),
    T.StructField("severity", T.StringType()),
    T.StructField("if_score", T.StringType()),
    T.StructField("lstm_score", T.StringType()),
    T.StructField("series", T.StringType()),
])

PRICE_FEED_ROW = T.StructType([
    T.StructField("timestamp", T.StringType()),
    T.StructField("price", T.DoubleType()),
    T.StructField("if_score", T.DoubleType()),
    T.StructField("anomaly", T.BooleanType()),
    T.StructField("if_ready", T.BooleanType()),
])

TICKS = T.StructType([
    T.StructField("series", T.StringType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
    T.StructField("price", T.DoubleType()),
])


@dataclass(frozen=True)
class RuleParams:
    """Thresholds of the four rules (defaults are the detector's own)."""

    max_dt: float = C.MAX_DT
    min_pct: float = C.MIN_PCT
    min_abs: float = C.MIN_ABS
    vol_k: float = C.VOL_K
    vol_floor: float = C.VOL_FLOOR
    mr_k: float = C.MR_K
    mr_floor: float = C.MR_FLOOR

    def with_(self, **kw) -> "RuleParams":
        return replace(self, **kw)


# The driver's ``events`` table has a median gap of 90-900 s per series and
# values in the tens to hundreds, so the per-tick gate and floors are rescaled.
EVENTS_PARAMS = RuleParams(max_dt=900.0, min_pct=150.0, min_abs=100.0)
# ``orders`` are daily: allow one day between ticks.
ORDERS_PARAMS = RuleParams(max_dt=86400.0, min_pct=150.0, min_abs=100000.0)


@dataclass(frozen=True)
class Layout:
    """How a series is cut into row blocks for window work.

    ``block_rows`` None means adaptive: about ``blocks_per_core`` blocks per
    core of the session, clamped to [min_block_rows, max_block_rows]; each window
    over blocks buffers one block, so the upper bound also bounds a task's memory.
    ``bucket_rows`` sizes the coarse time buckets used to number rows.
    """

    block_rows: int | None = None
    bucket_rows: int = 1_000_000
    min_block_rows: int = 4096
    max_block_rows: int = 1 << 17
    blocks_per_core: int = 3


def t_us(ts: Column) -> Column:
    """Epoch microseconds of a UTC wall-clock timestamp (ntz or ltz)."""
    return F.unix_micros(ts.cast("timestamp"))


def to_ticks(df: DataFrame, series: str, ts: str, seq: str, price: str) -> DataFrame:
    """Project any table onto canonical ticks; rows without time/price/series (or NaN price) are dropped."""
    out = df.select(
        F.col(series).cast("string").alias("series"),
        F.col(ts).cast("timestamp_ntz").alias("ts"),
        F.col(seq).cast("long").alias("seq"),
        F.col(price).cast("double").alias("price"),
    ).where(F.col("series").isNotNull() & F.col("ts").isNotNull() & F.col("price").isNotNull()
            & ~F.isnan("price"))
    return out.withColumn("t_us", t_us(F.col("ts")))


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def events_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events``: series = event_type, ts, seq = event_id, price = value."""
    return to_ticks(read_table(spark, sf_dir, "events"), "event_type", "ts", "event_id", "value")


def orders_ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders``: series = o_orderpriority, o_orderdate, seq = o_orderkey, price = o_totalprice."""
    return to_ticks(read_table(spark, sf_dir, "orders"), "o_orderpriority", "o_orderdate",
                    "o_orderkey", "o_totalprice")
