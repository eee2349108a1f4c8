"""Wire formats: tick payload JSON (S2, S4), raw trade messages (S3), OHLC
responses (S11), and the timestamp conversions they need (P1, P2, F1, F3).

All decoding is built-in expressions (``from_json`` PERMISSIVE, ``try_cast``,
``try_to_timestamp``), so bad input becomes NULL and is filtered instead of
failing the job.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.functions.numeric import fround
from tickwatch.schema import TICK_PAYLOAD, t_us

ISO_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def iso_utc(ts: Column) -> Column:
    """UTC wall-clock timestamp -> ISO-8601 text with +00:00 (microseconds always printed)."""
    return F.concat(F.date_format(ts, ISO_FORMAT), F.lit("+00:00"))


def epoch_text_to_ts(x: Column) -> Column:
    """Epoch seconds (text or double) -> UTC wall-clock timestamp, microsecond precision."""
    secs = x.cast("string").try_cast("double")
    return F.timestamp_micros(F.round(secs * F.lit(1e6)).cast("long")).cast("timestamp_ntz")


def parse_iso(text: Column) -> Column:
    """ISO text -> UTC wall-clock timestamp; naive text means UTC; unparsable -> NULL."""
    return F.try_to_timestamp(text).cast("timestamp_ntz")


def encode_ticks(ticks: DataFrame, change: str | None = "change") -> DataFrame:
    """``value`` = JSON {timestamp, price (2 dp), change (6 dp)} per tick (plus key = series)."""
    chg = fround(change, C.ROUND_PCT) if change else F.lit(0.0)
    payload = F.struct(iso_utc(F.col("ts")).alias("timestamp"),
                       fround("price", C.ROUND_PRICE).alias("price"), chg.alias("change"))
    return ticks.select("series", "seq", F.col("series").alias("key"), F.to_json(payload).alias("value"))


def decode_ticks(df: DataFrame, value: str = "value", series: Column | None = None) -> DataFrame:
    """S2 + P2 + F1: payload bytes/text -> ticks; malformed JSON, NULL price, NULL or
    unparsable time are dropped.  Keeps every other input column."""
    d = F.from_json(F.col(value).cast("string"), TICK_PAYLOAD)
    out = df.withColumn("_d", d).withColumn("ts", parse_iso(F.col("_d.timestamp"))) \
        .withColumn("price", F.col("_d.price")).withColumn("change", F.col("_d.change"))
    if series is not None:
        out = out.withColumn("series", series)
    out = out.where(F.col("price").isNotNull() & F.col("ts").isNotNull()).drop("_d")
    return out.withColumn("t_us", t_us(F.col("ts")))


def trade_message(ticks: DataFrame, channel: Column | None = None) -> DataFrame:
    """Build raw exchange-style trade messages
    ``[channel, [[price, volume, time, side, type, misc]], "trade", pair]`` (for tests and replays)."""
    ch = channel if channel is not None else F.col("seq")
    secs = F.concat((F.col("t_us") / 1000000).cast("long").cast("string"), F.lit("."),
                    F.lpad(F.pmod(F.col("t_us"), F.lit(1000000)).cast("string"), 6, "0"))
    trade = F.array(F.col("price").cast("string"), F.lit("0"), secs, F.lit("b"), F.lit("m"), F.lit(""))
    msg = F.concat(F.lit("["), ch.cast("string"), F.lit(","), F.to_json(F.array(trade)), F.lit(',"trade",'),
                   F.regexp_extract(F.to_json(F.array(F.col("series"))), r"^\[(.*)\]$", 1), F.lit("]"))
    return ticks.select("series", "seq", msg.alias("raw"))


def decode_trades(df: DataFrame, raw: str = "raw") -> DataFrame:
    """S3 + F3 + P1: keep list messages with >= 4 elements whose second-last element is
    "trade"; one row per trade (``pos`` = index in the message) with price, time and pair."""
    a = F.from_json(F.col(raw), "array<string>")
    kind = F.try_element_at(F.col("_a"), F.lit(-2))
    ok = (F.size("_a") >= 4) & (kind == F.lit("trade"))
    trades = F.from_json(F.try_element_at(F.col("_a"), F.lit(2)), "array<array<string>>")
    x = (df.withColumn("_a", a).where(F.coalesce(ok, F.lit(False)))
         .select("*", F.try_element_at(F.col("_a"), F.lit(-1)).alias("pair"),
                 F.posexplode(trades).alias("pos", "_t")))
    out = (x.withColumn("price", F.try_element_at("_t", F.lit(1)).try_cast("double"))
           .withColumn("ts", epoch_text_to_ts(F.try_element_at("_t", F.lit(3))))
           .where(F.col("price").isNotNull() & F.col("ts").isNotNull())
           .withColumn("pos", F.col("pos").cast("long"))
           .withColumn("ts_iso", iso_utc(F.col("ts")))
           .drop("_a", "_t"))
    return out.withColumn("t_us", t_us(F.col("ts")))


def decode_ohlc(df: DataFrame, body: str = "body") -> DataFrame:
    """OHLC response ``{"error": [], "result": {"<pair>": [[time, o, h, l, c, vwap, vol, n], ...],
    "last": n}}`` -> one row per bar: pair, ts, close (index 4).  The ``last`` key is skipped."""
    parsed = F.from_json(F.col(body), "struct<error:array<string>, result:map<string,string>>")
    x = df.withColumn("_r", parsed).where(F.coalesce(F.size("_r.error") == 0, F.lit(True)))
    pairs = x.select("*", F.explode(F.map_filter("_r.result", lambda k, v: k != F.lit("last")))
                     .alias("pair", "_bars"))
    bars = pairs.select("*", F.explode(F.from_json("_bars", "array<array<string>>")).alias("_bar"))
    out = bars.select(*[c for c in df.columns if c != body], "pair",
                      epoch_text_to_ts(F.try_element_at("_bar", F.lit(1))).alias("ts"),
                      F.try_element_at("_bar", F.lit(5)).try_cast("double").alias("close"))
    return out.where(F.col("ts").isNotNull() & F.col("close").isNotNull())
