"""Fixed values that must equal the detector semantics being reproduced.

Everything in this module is a constant of the detection model (names,
thresholds, window lengths, severity tables).  Keep them here, together and
in their natural order, so every operator reads the same values.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES: detector names, in the order a tick's fired list is built.
# ---------------------------------------------------------------------------
PCT_SPIKE = "pct_spike"
ABS_JUMP = "abs_jump"
VOL_BREAKOUT = "vol_breakout"
MEAN_REVERSION_BREAK = "mean_reversion_break"
IFOREST_ANOMALY = "iforest_anomaly"
LSTM_ANOMALY = "lstm_anomaly"

ALL_TYPES = [
    "pct_spike",
    "abs_jump",
    "vol_breakout",
    "mean_reversion_break",
    "iforest_anomaly",
    "lstm_anomaly",
]

# FIXED VALUES: severity of each detector type (unknown type -> LOW).
TYPE_SEVERITY = {
    "pct_spike": "HIGH",
    "abs_jump": "HIGH",
    "lstm_anomaly": "HIGH",
    "vol_breakout": "MED",
    "iforest_anomaly": "MED",
    "mean_reversion_break": "LOW",
}
SEV_RANK = {"HIGH": 3, "MED": 2, "LOW": 1}
SEVERITIES = ["HIGH", "MED", "LOW"]

# FIXED VALUES: detector metadata type -> (layer, severity, description);
# missing type -> ("?", "LOW", "").
TYPE_META = {
    "pct_spike": ("Rule", "HIGH", "Price moved ≥ 0.15% in one tick"),
    "abs_jump": ("Rule", "HIGH", "Price moved ≥ $20 in one tick"),
    "vol_breakout": ("Rule", "MED", "Move ≥ 2.5× usual volatility"),
    "mean_reversion_break": ("Rule", "LOW", "Price drifted ≥ 2σ from rolling mean"),
    "iforest_anomaly": ("ML", "MED", "Isolation Forest flagged unusual pattern"),
    "lstm_anomaly": ("Deep ML", "HIGH", "LSTM sequence model: high reconstruction error"),
}
META_DEFAULT = ("?", "LOW", "")
ML_LAYERS = ("ML", "Deep ML")

# FIXED VALUES: severity variants.
# fallback (severity column missing): HIGH if any of the first set, MED if any
# of the second, else LOW.
FALLBACK_HIGH = ["pct_spike", "abs_jump", "lstm_anomaly"]
FALLBACK_MED = ["vol_breakout", "iforest_anomaly"]
# rules-only classifier: HIGH if any of the first set, MED if any of the
# second, else LOW (model types count as LOW here).
RULES_ONLY_HIGH = ["pct_spike", "abs_jump"]
RULES_ONLY_MED = ["vol_breakout"]

# FIXED VALUES: filter presets (detector types, severities).
PRESETS = {
    "all": (ALL_TYPES, ["HIGH", "MED", "LOW"]),
    "high": (["pct_spike", "abs_jump", "lstm_anomaly"], ["HIGH"]),
    "ml": (["iforest_anomaly", "lstm_anomaly"], ["HIGH", "MED"]),
}

# FIXED VALUES: rule thresholds (defaults).
MAX_DT = 10.0  # seconds; gate for pct/abs/vol rules is 0 < dt <= MAX_DT
MIN_PCT = 0.15  # percent
MIN_ABS = 20.0
VOL_K = 2.5
VOL_FLOOR = 10.0
MR_K = 2.0
MR_FLOOR = 20.0

# FIXED VALUES: window lengths and guards.
PRICE_WINDOW = 120  # previous prices kept for the rolling rules
MIN_HISTORY = 10  # rolling rules need at least this many previous prices
IF_WINDOW = 20  # feature window (online variant; training uses 21 rows)
SEQ_LEN = 60  # sequence model input length
ERR_WINDOW = 300  # dynamic threshold looks at the last 300 errors
ERR_MIN = 50  # dynamic threshold used once more than 50 errors exist
ERR_K = 2.0  # dynamic threshold = mean + 2 sigma
BASE_K = 3.0  # base threshold = mean + 3 sigma of training errors
SIGMA_EPS = 1e-8  # zero sigma / zero denominator replacement in features
THRESH_EPS = 1e-10  # zero threshold replacement in the error ratio

# FIXED VALUES: Isolation Forest schedule and parameters.
IF_WARMUP = 300
IF_RETRAIN = 500
IF_KEEP = 300  # rows kept in the buffer after each fit
IF_TREES = 100
IF_SUBSAMPLE = 256
IF_SEED = 42
IF_CONTAMINATION_ONLINE = 0.01
IF_CONTAMINATION_OFFLINE = 0.05

# FIXED VALUES: report constants.
MAX_PRICE_HISTORY = 500  # ticks kept in the live feed snapshot
ANOMALY_LOG_ROWS = 3000  # rows read back from the anomaly log
ALERT_LOG_ROWS = 50  # rows read by the plain alert view
ALERT_SHOW_ROWS = 15  # alerts printed newest first
VIEW_ROWS_DEFAULT = 200  # filtered view size (20..500)
HIST_MAXBINS = 40
RATE_NORMAL_LO = 5.0
RATE_NORMAL_HI = 20.0
CHART_PAD_FRACTION = 0.4
CHART_PAD_MIN = 30.0

# FIXED VALUES: output rounding digits.
ROUND_PRICE = 2
ROUND_PCT = 6
ROUND_ABS = 2
ROUND_SCORE = 4
