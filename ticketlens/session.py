"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on. AQE re-plans joins by measured size (broadcast only when the
# runtime size is under spark.sql.autoBroadcastJoinThreshold, sort-merge otherwise), coalesces
# small shuffle partitions and splits skewed join partitions (a hot key holding a third of rows).
BASE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app_name: str = "ticketlens", extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the settings above.

    On a cluster pass ``master=None`` and let spark-submit decide; ``shuffle_partitions`` should
    then be sized to roughly input bytes / 128 MB (AQE coalesces the rest).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for written tables and checkpoints.

    Read from ``spark.checkpoint.dir`` (set by the cluster). Unset, there is no folder that all
    executors share, so this raises; only a session with a ``local`` master, whose driver and
    executors are one process on one machine, gets a fresh folder of its own.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - remote session: the server owns spark.checkpoint.dir
        path, one_machine = spark.conf.get("spark.checkpoint.dir", None), False
    else:
        path = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
        one_machine = sc.master == "local" or sc.master.startswith("local[")
    if not path and not one_machine:
        raise RuntimeError("spark.checkpoint.dir is not set: name a folder that all executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="ticketlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        sc.setCheckpointDir(path)
    return path


def materialise(df: DataFrame, label: str = "t") -> DataFrame:
    """Cut lineage by writing ``df`` once as a Parquet table in the shared checkpoint folder and
    reading it back.

    Unlike ``Dataset.checkpoint(eager=True)``, whose eager count and checkpoint write each compute
    the plan, the upstream runs once; the stored copy is columnar and compressed, and a lost
    executor re-reads it instead of recomputing (possibly differently partitioned) upstream rows.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder for a table this application writes and reads back (removed by
    :func:`drop_materialised`)."""
    return f"{_tables_root(spark)}/{label}-{uuid.uuid4().hex}"


def _tables_root(spark: SparkSession) -> str:
    """This application's folder of written tables: one subfolder per application id, so that
    :func:`drop_materialised` never touches another job's tables in the shared folder."""
    app = spark.conf.get("spark.app.id", None) or "app"
    return f"{checkpoint_dir(spark).rstrip('/')}/tables/{app}"


_DROPS = 0


def store_key(spark: SparkSession) -> tuple[str, int]:
    """Names this application's written tables as long as they exist (it changes when they are
    dropped), for callers that keep a stored table for later use."""
    return _tables_root(spark), _DROPS


def drop_materialised(spark: SparkSession) -> bool:
    """Delete every table this application wrote with :func:`materialise`.

    At scale these are full copies of fact-sized frames, so a batch job calls this once at its end,
    after the last action. Frames that read the dropped tables can no longer be evaluated.
    Returns False when there is nothing to drop or no JVM file system (a remote session)."""
    try:
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
    except Exception:  # noqa: BLE001 - remote session: the server owns the folder
        return False
    global _DROPS
    _DROPS += 1
    path = jvm.org.apache.hadoop.fs.Path(_tables_root(spark))
    fs = path.getFileSystem(conf)
    return bool(fs.exists(path) and fs.delete(path, True))
