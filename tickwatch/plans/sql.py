"""DuckDB-runnable SQL for the same semantics (the correctness oracle).

Plain whole-series windows: the reference formulation our block/halo plans must
reproduce exactly.
"""

from __future__ import annotations

from tickwatch import constants as C
from tickwatch.schema import EVENTS_PARAMS, RuleParams

S = "PARTITION BY series ORDER BY t_us, seq"


def ticks_cte(table: str = "events") -> str:
    if table == "events":
        return ("SELECT event_type AS series, ts, event_id AS seq, value AS price, epoch_us(ts) AS t_us "
                "FROM events WHERE event_type IS NOT NULL AND ts IS NOT NULL AND value IS NOT NULL AND NOT isnan(value)")
    if table == "orders":
        return ("SELECT o_orderpriority AS series, o_orderdate AS ts, o_orderkey AS seq, o_totalprice AS price, "
                "epoch_us(o_orderdate) AS t_us FROM orders WHERE o_orderpriority IS NOT NULL "
                "AND o_orderdate IS NOT NULL AND o_totalprice IS NOT NULL AND NOT isnan(o_totalprice)")
    raise ValueError(table)


def fmt_ts(col: str = "ts") -> str:
    return f"strftime({col}, '%Y-%m-%d %H:%M:%S.%f')"


def rules_ctes(p: RuleParams = EVENTS_PARAMS, table: str = "events") -> str:
    """CTE chain ending in ``r`` with every rule column of ``rule_frame``."""
    n = C.PRICE_WINDOW
    return f"""
tk AS ({ticks_cte(table)}),
w1 AS (
  SELECT *,
    row_number() OVER ({S}) AS rn,
    lag(price) OVER ({S}) AS prev_price,
    (t_us - lag(t_us) OVER ({S})) / 1e6 AS dt,
    price - lag(price) OVER ({S}) AS diff,
    avg(price) OVER ({S} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS mean120,
    stddev_pop(price) OVER ({S} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING) AS sd120
  FROM tk),
w2 AS (
  SELECT *,
    coalesce(prev_price IS NOT NULL AND dt > 0 AND dt <= {p.max_dt}, false) AS gated,
    stddev_pop(diff) OVER ({S} ROWS BETWEEN {n - 1} PRECEDING AND 1 PRECEDING) AS sd_ret119
  FROM w1),
w3 AS (
  SELECT *,
    CASE WHEN gated THEN diff ELSE 0.0 END AS abs_change,
    CASE WHEN gated THEN (CASE WHEN prev_price = 0 THEN NULL ELSE diff / prev_price END) * 100.0
         ELSE 0.0 END AS pct_change,
    CASE WHEN rn > {C.MIN_HISTORY} AND sd120 > 0
         THEN abs(price - mean120) >= greatest({p.mr_k} * sd120, {p.mr_floor}) END AS mr_cond
  FROM w2),
r AS (
  SELECT *,
    coalesce(gated AND abs(pct_change) >= {p.min_pct}, false) AS pct_spike,
    coalesce(gated AND abs(abs_change) >= {p.min_abs}, false) AS abs_jump,
    coalesce(gated AND rn > {C.MIN_HISTORY} AND sd_ret119 > 0
             AND abs(abs_change) >= greatest({p.vol_k} * sd_ret119, {p.vol_floor}), false) AS vol_breakout,
    coalesce(mr_cond AND NOT coalesce(last_value(mr_cond IGNORE NULLS) OVER
             ({S} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false), false) AS mean_reversion_break
  FROM w3)"""


RULE_TYPES_SQL = ("concat_ws(',', CASE WHEN pct_spike THEN 'pct_spike' END, CASE WHEN abs_jump THEN 'abs_jump' END, "
                  "CASE WHEN vol_breakout THEN 'vol_breakout' END, "
                  "CASE WHEN mean_reversion_break THEN 'mean_reversion_break' END)")
ANY_RULE_SQL = "(pct_spike OR abs_jump OR vol_breakout OR mean_reversion_break)"
RULE_SEVERITY_SQL = ("CASE WHEN pct_spike OR abs_jump THEN 'HIGH' WHEN vol_breakout THEN 'MED' "
                     "ELSE 'LOW' END")


def rule_events_cte(p: RuleParams = EVENTS_PARAMS, table: str = "events") -> str:
    """``ev``: the rules-only anomaly log (one row per fired tick)."""
    return rules_ctes(p, table) + f""",
ev AS (
  SELECT series, seq, ts, t_us, rn, round(price, 2) AS price, round(pct_change, 6) AS pct_change,
         round(abs_change, 2) AS abs_change, {RULE_TYPES_SQL} AS types,
         list_filter([CASE WHEN pct_spike THEN 'pct_spike' END, CASE WHEN abs_jump THEN 'abs_jump' END,
                      CASE WHEN vol_breakout THEN 'vol_breakout' END,
                      CASE WHEN mean_reversion_break THEN 'mean_reversion_break' END], lambda x: x IS NOT NULL)
           AS type_list,
         {RULE_SEVERITY_SQL} AS severity, 0.0 AS if_score, 0.0 AS lstm_score
  FROM r WHERE {ANY_RULE_SQL})"""


def feed_cte() -> str:
    """``feed``: every tick with anomaly flag and cold-start model readiness (needs ``r``)."""
    return f"""
feed AS (
  SELECT series, seq, ts, t_us, rn, price, 0.0 AS if_score, {ANY_RULE_SQL} AS anomaly,
         rn >= {C.IF_WARMUP + C.IF_WINDOW - 1} AS if_ready
  FROM r)"""


def iso(col: str = "ts") -> str:
    return f"(strftime({col}, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00')"


def last_n_sql(src: str, n: int, extra_where: str = "TRUE") -> str:
    return (f"(SELECT *, row_number() OVER (PARTITION BY series ORDER BY t_us DESC, seq DESC) AS pos "
            f"FROM {src} WHERE {extra_where}) WHERE pos <= {n}")


def nice_step_sql(lo: str, hi: str, maxbins: int = C.HIST_MAXBINS) -> str:
    raw = f"(({hi}) - ({lo})) / {float(maxbins)}"
    p = f"pow(10.0, floor(log10({raw})))"
    return (f"CASE WHEN {raw} <= 0 THEN NULL WHEN {raw} <= {p} THEN {p} WHEN {raw} <= 2 * {p} THEN 2 * {p} "
            f"WHEN {raw} <= 5 * {p} THEN 5 * {p} ELSE 10 * {p} END")
