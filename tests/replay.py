"""The four rules stated row by row over whole arrays, as an oracle for the window plans.

Every row is judged by itself from the rows before it, found by index: nothing is carried along.
The latch of a row is the breach state of the last earlier row that could be judged.
"""

from __future__ import annotations

import numpy as np

HISTORY, LEAST = 120, 10


def breach(price: np.ndarray, i: int, k: float, floor: float) -> bool | None:
    """Is row i out of the band around the mean of its history? None where that can't be judged."""
    past = price[max(0, i - HISTORY):i]
    if len(past) < LEAST or past.std() == 0:
        return None
    return bool(abs(price[i] - past.mean()) >= max(k * past.std(), floor))


def replay(rows, max_dt=10.0, min_pct=0.15, min_abs=20.0, vol_k=2.5, vol_floor=10.0, mr_k=2.0, mr_floor=20.0):
    """rows: (seconds, price) in processing order -> (fired types, percent change, change) of each."""
    seconds, price = (np.array([r[c] for r in rows], float) for c in (0, 1))
    judged = [breach(price, i, mr_k, mr_floor) for i in range(len(price))]
    out = []
    for i in range(len(price)):
        near = i > 0 and 0 < seconds[i] - seconds[i - 1] <= max_dt
        change = price[i] - price[i - 1] if near else 0.0
        percent = (None if price[i - 1] == 0 else change / price[i - 1] * 100.0) if near else 0.0
        spread = np.diff(price[max(0, i - HISTORY):i]).std() if i >= LEAST else 0.0
        before = [x for x in judged[:i] if x is not None][-1:]
        rules = {
            "pct_spike": near and percent is not None and abs(percent) >= min_pct,
            "abs_jump": near and abs(change) >= min_abs,
            "vol_breakout": near and spread > 0 and abs(change) >= max(vol_k * spread, vol_floor),
            "mean_reversion_break": judged[i] is True and before != [True],
        }
        out.append(([name for name, holds in rules.items() if holds], percent, change))
    return out
