"""SparkSession construction with the settings the engine relies on."""

from __future__ import annotations

import os
import tempfile
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job needs for the semantics in this package: naive timestamps
# are compared in UTC, ANSI casts raise (so all text casts are try_*), and AQE
# re-plans shuffles at runtime (partition coalescing, skew-join splitting).
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "staylens", extra: dict | None = None) -> SparkSession:
    """Return (or create) a session configured for this engine.

    On a cluster ``master`` stays ``None`` so spark-submit decides. Locally
    (tests, bench) pass ``local[N]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(ENGINE_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.serializer"] = "org.apache.spark.serializer.KryoSerializer"
    conf["spark.ui.showConsoleProgress"] = "false"
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    if master and master.startswith("local"):
        # Local runs keep the (in-memory) catalog's default folder out of the
        # working directory; a cluster names its own warehouse.
        conf["spark.sql.warehouse.dir"] = os.path.join(
            os.environ.get("TMPDIR", "/tmp"), "staylens-warehouse")
    if extra:
        conf.update(extra)
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    for key, value in ENGINE_CONF.items():
        spark.conf.set(key, value)
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the session.

    On a cluster ``spark.checkpoint.dir`` names shared storage and is used as
    is; a cluster session without it is an error, since a machine-local
    folder would not survive the loss of that machine. Only a local-mode
    session (tests, a laptop) without the setting gets a private temp folder.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not current:
        current = sc.getCheckpointDir()
    if not current:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder for this cluster")
        current = tempfile.mkdtemp(prefix="staylens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


#: Bytes of large rows that are given to Python at a time, or one row.
BATCH_BYTES = 4 << 20


@contextmanager
def small_batches(spark: SparkSession):
    """Plans that run meanwhile give Python about `BATCH_BYTES` at a time, not
    ten thousand rows of whatever size."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, BATCH_BYTES)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)
