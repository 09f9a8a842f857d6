"""Session helpers: one place for the settings every job here relies on."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings the operators depend on for correct results (not just speed).
REQUIRED_CONF = {
    # Python's json keeps the last of duplicate keys; Spark's variant parser
    # rejects them unless this is on.
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int = 8, app: str = "quarry") -> SparkSession:
    """Build (or reuse) a session with AQE on and the UI off.

    On a cluster, pass ``master=None`` and let spark-submit decide; the
    shuffle-partition count is only a starting point because AQE coalesces
    and splits partitions at runtime from real shuffle statistics.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    b = (
        b.config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("QUARRY_DRIVER_MEMORY", "16g"))
    )
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_conf(spark)
    return spark


def ensure_conf(spark: SparkSession) -> None:
    """Apply the runtime settings the operators need to an existing session."""
    for k, v in REQUIRED_CONF.items():
        if spark.conf.get(k, None) != v:
            spark.conf.set(k, v)


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for reliable checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; we read that and only
    choose a folder ourselves when it is unset (local runs and tests).
    """
    sc = spark.sparkContext
    d = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not d and sc.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not d:
        d = tempfile.mkdtemp(prefix="quarry-ckpt-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", d)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for a written table."""
    import uuid

    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}-{uuid.uuid4().hex[:12]}"


_SHIPPED: set = set()


def ship_package(spark: SparkSession) -> None:
    """Make the ``quarry`` package importable in Python workers (what
    ``--py-files`` does on a cluster): zip it in memory, write the zip into
    the shared checkpoint folder through Hadoop's FileSystem API (any scheme
    Spark can write), and register it with ``addPyFile``, once per context."""
    import io
    import os
    import zipfile

    sc = spark.sparkContext
    key = sc.applicationId
    if key in _SHIPPED:
        return
    pkg = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg)
    buf = io.BytesIO()
    with zipfile.ZipFile(buf, "w") as z:
        for d, _, files in os.walk(pkg):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(d, f)
                    z.write(full, os.path.relpath(full, root))
    jvm = sc._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{checkpoint_dir(spark).rstrip('/')}/quarry-{key}.zip")
    fs = path.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(path, True)
    out.write(bytearray(buf.getvalue()))
    out.close()
    sc.addPyFile(path.toString())
    _SHIPPED.add(key)
