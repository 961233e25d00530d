"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job wants: adaptive execution (coalescing, skew-join split,
# runtime broadcast conversion on measured sizes) and a pinned time zone.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # independent jobs submitted from threads share the executors fairly;
    # pools (weights) come from the allocation file shipped with the package
    "spark.scheduler.mode": "FAIR",
    "spark.scheduler.allocation.file": os.path.join(os.path.dirname(os.path.abspath(__file__)),
                                                    "fairscheduler.xml"),
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "venuescope", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session.  On a cluster ``master`` stays None and the
    cluster's own settings win; locally pass ``local[N]``."""
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


_OWN_CKPT: dict = {}   # SparkContext id -> folder we made (only when none is configured)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a shared folder there (read from the session); only
    when it is unset (tests, a laptop) do we make one of our own and
    register it with the SparkContext (a core setting cannot be changed
    through ``spark.conf`` at runtime)."""
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not d:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        d = _OWN_CKPT.get(id(sc))
        if d is None:
            d = _OWN_CKPT.setdefault(id(sc), tempfile.mkdtemp(prefix="venuescope-ckpt-"))
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def in_pool(spark: SparkSession, pool: str | None) -> None:
    """Route the calling thread's jobs to a FAIR pool (None: default)."""
    spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A folder under the shared checkpoint dir for staged tables."""
    return os.path.join(ensure_checkpoint_dir(spark), "venuescope", name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once under the shared checkpoint dir: what reads it several times neither repeats the
    joins behind it nor carries its expressions into every filter."""
    path = scratch_path(df.sparkSession, f"{name}/{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
