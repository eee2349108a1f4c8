"""SQL access: register the detector outputs as temporary views.

``register_views`` builds the plans lazily and names them, so SQL users query
the same Catalyst plans as DataFrame users::

    register_views(spark, ticks, EVENTS_PARAMS)
    spark.sql("SELECT severity, count(*) FROM tw_anomalies GROUP BY severity")
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwatch.functions.severity import top_severity
from tickwatch.plans import detect
from tickwatch.schema import Layout, RuleParams


def register_views(spark: SparkSession, ticks: DataFrame, params: RuleParams = RuleParams(),
                   layout: Layout = Layout(), prefix: str = "tw_") -> dict[str, DataFrame]:
    """Views ``<prefix>ticks`` (every tick with its rule outputs), ``<prefix>anomalies``
    (event records) and ``<prefix>feed`` (per-tick anomaly / readiness flags)."""
    fr = detect.rule_frame(ticks, params, layout)
    views = {
        "ticks": fr.select("series", "seq", "ts", "rn", "price", "gated", "pct_change", "abs_change",
                           "pct_spike", "abs_jump", "vol_breakout", "mean_reversion_break",
                           F.col("rule_types").alias("types"), top_severity(F.col("rule_types")).alias("severity")),
        "anomalies": detect.event_record(fr, types="rule_types"),
        "feed": detect.feed_frame(fr),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(prefix + name)
    return views
