"""Numeric helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fround(x: Column | str, digits: int) -> Column:
    """Round half away from zero on the binary value: ``sign(x) * floor(|x| * 10^d + 0.5) / 10^d``.

    Spark's ``round`` rounds the shortest decimal string (2.675 -> 2.68); this
    scales the double itself, like DuckDB, so a value prints the same whichever
    engine computed it.  All in doubles: from 2^52 / 10^d on a double has no
    further digit to round, so such values, infinities and NaN stay as they are.
    """
    c = F.col(x) if isinstance(x, str) else x
    m = F.lit(float(10 ** digits))
    y = F.abs(c) * m + F.lit(0.5)
    # "+ 0.0" turns a rounded -0.0 into 0.0
    return F.when(F.abs(c) * m < F.lit(2.0 ** 52), F.signum(c) * (y - F.pmod(y, F.lit(1.0))) / m + F.lit(0.0)) \
        .otherwise(c.cast("double"))
