"""Row numbering in a total order, and block/halo layout.

A series is one logical ordered sequence, but a single series may hold a large
share of all rows, so no window here is ever partitioned by ``series`` alone:

1. ``number_in_order``: rows are range-partitioned by (keys, order), so that a
   partition holds about ``part_rows`` consecutive rows whatever the
   distribution of times (outliers, bursts, equal times), and sorted inside
   each partition.  A row's place in its partition, the first place of its key
   there and the prefix sum of the (partition, key) counts give its number: a
   dense 1-based ``rn`` per key.  Only the table of counts, one row per
   partition and key, passes through a window.
2. ``to_blocks``: rows are cut into blocks of exactly ``B`` rows by ``rn``; each
   row is also copied (``own = false``) into the following block(s) when it is
   among the ``halo`` rows preceding that block's first row.  A window with a
   frame reaching back at most ``halo`` rows therefore gives, on the block's own
   rows, exactly the result of the whole-series window.
3. Scans that reach back without bound (the mean-reversion latch) are reduced
   to a bounded look-back (see ``rules.latch``), so no cross-block carry is needed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickwatch.schema import Layout
from tickwatch.session import checkpoint_dir, default_parallelism

#: monotonically_increasing_id() keeps a row's place in its partition in the lower bits.
PLACE_BITS = 33


def placed(df: DataFrame, keys: list[str], order: list[str], parts: int) -> DataFrame:
    """The rows range-partitioned and sorted by (keys, order), with ``_at``: partition and place in it.

    The places must not change between the reads that follow, so the rows are checkpointed (the range
    bounds come from a sample, which another evaluation would draw anew)."""
    checkpoint_dir(df.sparkSession)
    by = [*keys, *order]
    return (df.repartitionByRange(parts, *by).sortWithinPartitions(*by)
            .withColumn("_at", F.monotonically_increasing_id()).checkpoint())


def number_in_order(df: DataFrame, keys: list[str], order: list[str], parts: int,
                    number: str = "rn", size: str = "_n") -> DataFrame:
    """Adds ``number`` (dense, from 1, by ``order`` within ``keys``) and ``size`` (rows of the key).

    Eager: the rows are written once to the checkpoint folder.  Rows without a key are left out; rows
    equal in ``keys`` and ``order`` are numbered in any order, once and for all.  Nulls come first."""
    at = placed(df, keys, order, parts).withColumn("_part", F.shiftright("_at", PLACE_BITS))
    counts = at.groupBy(*keys, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_cnt"))
    of_key = Window.partitionBy(*keys)
    before = of_key.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_part", F.sum("_cnt").over(of_key).alias(size),
                            (F.coalesce(F.sum("_cnt").over(before), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return at.join(offsets, [*keys, "_part"]).withColumn(number, F.col("_at") + F.col("_shift")) \
        .drop("_part", "_at", "_shift")


def number_rows(ticks: DataFrame, layout: Layout = Layout(), base: DataFrame | None = None,
                parallelism: int | None = None) -> DataFrame:
    """Add ``rn`` (1-based, per series, ordered by ``t_us, seq``), ``_B`` (block rows)
    and ``_n`` (rows of the series in this frame).

    ``base`` (series, rn0) shifts numbering per series (continuation of earlier rows).
    Partitions hold about ``layout.bucket_rows`` rows, fewer where the cores would idle.
    Block rows: ``layout.block_rows`` or, adaptively, total rows / (cores x
    blocks_per_core), clamped.
    """
    cores = parallelism or default_parallelism(ticks.sparkSession)
    total = ticks.count()
    parts = max(1, -(-total // layout.bucket_rows), min(cores, -(-total // layout.min_block_rows)))
    block = layout.block_rows or min(max(-(-total // (cores * layout.blocks_per_core)), layout.min_block_rows),
                                     layout.max_block_rows)
    out = number_in_order(ticks, ["series"], ["t_us", "seq"], parts).withColumn("_B", F.lit(int(block)).cast("long"))
    if base is None:
        return out
    out = out.join(base.select("series", F.col("rn0").alias("_rn0")), "series", "left")
    return out.withColumn("rn", F.col("rn") + F.coalesce("_rn0", F.lit(0))).drop("_rn0")


def to_blocks(numbered: DataFrame, halo: int, block_rows: Column | None = None) -> DataFrame:
    """Assign ``block`` and replicate halo rows; ``own`` marks the block's own rows.
    Block size: ``block_rows`` or the ``_B`` column left by ``number_rows``."""
    if block_rows is None:
        block_rows = F.col("_B")
    i = F.col("rn") - 1
    own_block = F.floor(i / block_rows).cast("long")
    last_block = F.floor((i + F.lit(int(halo))) / block_rows).cast("long")
    keep = [c for c in numbered.columns if c not in ("_B", "_n")]
    return (numbered
            .select(*keep, own_block.alias("_own_block"), F.explode(F.sequence(own_block, last_block)).alias("block"))
            .select(*keep, "block", (F.col("block") == F.col("_own_block")).alias("own")))


def block_window() -> Window:
    return Window.partitionBy("series", "block").orderBy("rn")
