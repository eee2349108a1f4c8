"""Session helpers: a sensible local/cluster session and a checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def ensure_utc(spark: SparkSession) -> SparkSession:
    """All tick times are UTC wall clock; pin the session time zone."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def default_parallelism(spark: SparkSession) -> int:
    """Cores available to the session (falls back to configuration where no SparkContext is exposed)."""
    try:
        return int(spark.sparkContext.defaultParallelism)
    except Exception:  # e.g. a remote (Connect) session
        for key in ("spark.default.parallelism", "spark.sql.shuffle.partitions"):
            v = spark.conf.get(key, None)
            if v:
                return int(v)
        return 8


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared checkpoint folder named by the cluster (``spark.checkpoint.dir``).

    Only a local session that names none (tests) gets a folder of its own; on a cluster
    that is an error, as executors don't share the driver's folders.
    """
    try:
        sc = spark.sparkContext
        current = sc._jsc.sc().getCheckpointDir()
    except Exception:  # no SparkContext handle (e.g. a remote session): use the session conf
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares") from None
        return configured
    if current.isDefined():
        return current.get()
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        if sc.master.startswith("local-cluster") or not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the cluster shares")
        configured = tempfile.mkdtemp(prefix="tickwatch-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc._jsc.sc().getCheckpointDir().get()


def written(df: DataFrame) -> DataFrame:
    """The rows written to a table in the shared checkpoint folder and read again.

    For loops: unlike a checkpoint, whose plan carries on (and in a loop of joins squares) the size estimates of
    the plan that it replaces, a table is read with its true size."""
    path = f"{checkpoint_dir(df.sparkSession).rstrip('/')}/table-{uuid.uuid4()}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tickwatch", **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf)
    for k, v in settings.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ship_package(spark)
    return ensure_utc(spark)


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in executor Python workers (pandas UDFs, grouped maps).

    Zips the package once per application and registers it with ``addPyFile``
    (``addArtifacts`` on sessions without a SparkContext handle), the usual way to
    ship Python code to a cluster."""
    import zipfile
    try:
        sc = spark.sparkContext
        key = sc.applicationId
    except Exception:
        sc, key = None, "remote:" + str(id(spark))
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    fd, path = tempfile.mkstemp(prefix="tickwatch-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as z:
        for dirpath, _, names in os.walk(pkg):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(dirpath, name)
                    z.write(full, os.path.relpath(full, root))
    if sc is not None:
        sc.addPyFile(path)
    else:
        spark.addArtifacts(path, pyfile=True)
    _SHIPPED.add(key)
