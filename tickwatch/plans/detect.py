"""Detection plans: ticks -> blocked windows -> rules (+ models) -> events."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickwatch import constants as C
from tickwatch.functions.numeric import fround
from tickwatch.functions.severity import top_severity
from tickwatch.operators import stats
from tickwatch.operators.blocks import number_rows, to_blocks
from tickwatch.operators.rules import latch, rule_flags, rule_types
from tickwatch.schema import Layout, RuleParams

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def blocked(ticks: DataFrame, layout: Layout, halo: int) -> DataFrame:
    """Number rows per series and lay them out in blocks with ``halo`` rows of context."""
    return to_blocks(number_rows(ticks, layout), halo)


def needed_halo(sequences: bool = False, var_err: bool = False) -> int:
    """Context rows each block needs: 121 for the rules (120-price windows plus one
    row with a complete window for the latch), 360 with the error threshold."""
    rules = C.PRICE_WINDOW + 1
    return max(rules, C.SEQ_LEN + C.ERR_WINDOW) if (sequences or var_err) else rules


def rule_frame(ticks: DataFrame, params: RuleParams = RuleParams(), layout: Layout = Layout(),
               features: str | None = None, sequences: bool = False, var_err: bool = False,
               own_only: bool = True) -> DataFrame:
    """All rule columns for every tick (R1-R4, W1-W3, W7), optionally IF features
    (W4-W6, ``features`` = "online" | "training"); ``sequences``: blocks with the context that the sequence
    model needs.  One Exchange for all windows."""
    df = blocked(ticks, layout, needed_halo(sequences, var_err))
    return rules_on_blocks(df, params, features, var_err, own_only)


def rules_on_numbered(numbered: DataFrame, params: RuleParams, layout: Layout, features: str | None = None,
                      sequences: bool = False, own_only: bool = True) -> DataFrame:
    """Same as ``rule_frame`` for rows that already carry ``rn`` (and ``ctx``)."""
    df = to_blocks(numbered, needed_halo(sequences))
    return rules_on_blocks(df, params, features, False, own_only)


def rules_on_blocks(df: DataFrame, params: RuleParams, features: str | None = None, var_err: bool = False,
                    own_only: bool = True) -> DataFrame:
    df = stats.gated_change(df, params)
    df = stats.rolling_stats(df)
    df = rule_flags(df, params)
    if features:  # "online" (20 rows incl. current) or "training" (21 rows)
        df = stats.if_features(df, training=(features == "training"))
    if var_err:
        df = stats.sequence_variance(df)
    df = latch(df)
    df = df.withColumn("rule_types", rule_types())
    return df.where(F.col("own")) if own_only else df


def event_record(df: DataFrame, types: str = "types", if_score: str | None = None,
                 lstm_score: str | None = None) -> DataFrame:
    """R5 + P5: one record per tick that fired at least one detector."""
    zero = F.lit(0.0)
    return (df.where(F.size(types) > 0)
            .select("series", "seq", "ts", "t_us", "rn",
                    F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+00:00")).alias("ts_iso"),
                    fround("price", C.ROUND_PRICE).alias("price"),
                    fround("pct_change", C.ROUND_PCT).alias("pct_change"),
                    fround("abs_change", C.ROUND_ABS).alias("abs_change"),
                    F.col(types).alias("types"),
                    top_severity(F.col(types)).alias("severity"),
                    fround(F.col(if_score) if if_score else zero, C.ROUND_SCORE).alias("if_score"),
                    fround(F.col(lstm_score) if lstm_score else zero, C.ROUND_SCORE).alias("lstm_score")))


def rule_events(ticks: DataFrame, params: RuleParams = RuleParams(), layout: Layout = Layout()) -> DataFrame:
    """Rules-only anomaly events (the flagship query)."""
    return event_record(rule_frame(ticks, params, layout), types="rule_types")


def feed_frame(frame: DataFrame, types: str = "rule_types", if_score: str | None = None,
               if_ready: str | None = None, extra: list[str] | None = None) -> DataFrame:
    """Every tick with its anomaly flag, model score and model-ready flag.

    Without a model column, readiness follows the cold-start schedule: the first
    fit happens once 300 feature rows exist (feature rows start at row 20).
    """
    ready = F.col(if_ready) if if_ready else F.col("rn") >= F.lit(C.IF_WARMUP + C.IF_WINDOW - 1)
    return frame.select("series", "seq", "ts", "t_us", "rn", "price",
                        (F.col(if_score) if if_score else F.lit(0.0)).alias("if_score"),
                        (F.size(types) > 0).alias("anomaly"), ready.alias("if_ready"), *(extra or []))


def iforest_frame(ticks: DataFrame, params: RuleParams = RuleParams(), layout: Layout = Layout(),
                  contamination: float = C.IF_CONTAMINATION_ONLINE) -> DataFrame:
    """Rules + online features + walk-forward Isolation Forest for every tick."""
    from tickwatch.operators.iforest import walk_forward
    fr = rule_frame(ticks, params, layout, features="online")
    keep = ["series", "seq", "ts", "t_us", "rn", "price", "pct_change", "abs_change", "rule_types",
            "f_price", "f_r1", "f_r5", "f_sigma", "f_z"]
    return walk_forward(fr.select(*keep), contamination)


def fit_sequence(history: DataFrame, layout: Layout = Layout(), k: int = 8, make_predict=None):
    """Fit the sequence model (M6-M8) on a tick history; ``make_predict`` plugs in a model of one's own."""
    from tickwatch.operators.sequence import fit_sequence_model
    return fit_sequence_model(blocked(history, layout, C.SEQ_LEN), k=k, make_predict=make_predict)


def full_frame(ticks: DataFrame, params: RuleParams = RuleParams(), layout: Layout = Layout(),
               iforest: bool = True, sequence_k: int | None = 8, history: DataFrame | None = None,
               contamination: float = C.IF_CONTAMINATION_ONLINE, sequence_model=None) -> DataFrame:
    """Every tick with all detector outputs: rules, walk-forward forest (``if_*``) and the
    sequence model (``seq_err``, ``threshold``, ``ratio``, ``err_flag``).

    The sequence model is trained on ``history`` (default: the same ticks)."""
    from tickwatch.operators.iforest import walk_forward
    from tickwatch.operators.sequence import fit_sequence_model, score_sequences

    seq_on = sequence_k is not None or sequence_model is not None
    features = "online" if iforest else None
    numbered = number_rows(ticks, layout)
    if seq_on:
        if sequence_model is not None:
            model = sequence_model
        elif history is not None:
            model = fit_sequence(history, layout, sequence_k)
        else:
            model = fit_sequence_model(to_blocks(numbered, C.SEQ_LEN), k=sequence_k)
        # scored first, while the rows are narrow: one more exchange, then all windows
        fr = rules_on_blocks(score_sequences(to_blocks(numbered, needed_halo(True)), model), params, features, own_only=False)
        fr = stats.dynamic_threshold(fr, "seq_err", F.lit(model.base_threshold)).where(F.col("own"))
    else:
        fr = rules_on_numbered(numbered, params, layout, features)
        fr = fr.withColumn("seq_err", F.lit(None).cast("double")).withColumn("threshold", F.lit(None).cast("double")) \
            .withColumn("ratio", F.lit(None).cast("double")).withColumn("err_flag", F.lit(None).cast("boolean"))
    keep = ["series", "seq", "ts", "t_us", "rn", "price", "pct_change", "abs_change", "rule_types",
            "seq_err", "threshold", "ratio", "err_flag"]
    if iforest:
        keep += list(stats.FEATURES)
        out = walk_forward(fr.select(*keep), contamination)
    else:
        out = fr.select(*keep).withColumn("if_score", F.lit(0.0)).withColumn("if_flag", F.lit(False)) \
            .withColumn("if_ready", F.lit(False))
    return out


def full_events(ticks: DataFrame, params: RuleParams = RuleParams(), layout: Layout = Layout(),
                iforest: bool = True, sequence_k: int | None = 8, history: DataFrame | None = None) -> DataFrame:
    """Anomaly events from all six detectors (types in detector order)."""
    from tickwatch.operators.rules import fired_types
    fr = full_frame(ticks, params, layout, iforest, sequence_k, history)
    types = F.concat(F.col("rule_types"), fired_types([(C.IFOREST_ANOMALY, F.col("if_flag")),
                                                        (C.LSTM_ANOMALY, F.coalesce("err_flag", F.lit(False)))]))
    fr = fr.withColumn("types", types).withColumn("lstm_score", F.coalesce("ratio", F.lit(0.0)))
    return event_record(fr, types="types", if_score="if_score", lstm_score="lstm_score")
