"""Session helpers: local sessions for tests/bench and the checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(cpus: int | str | None = None, app: str = "postwise", shuffle_partitions: int | None = None,
              extra: dict | None = None) -> SparkSession:
    """A local session configured the way the library expects (tests, bench).

    On a cluster, build the session with the cluster's own settings instead;
    the library only needs AQE on and ``spark.checkpoint.dir`` pointing at a
    shared folder.
    """
    cpus = cpus or os.environ.get("BENCH_CPUS") or "*"
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions or 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
    )
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    A cluster names a shared folder in ``spark.checkpoint.dir``; that is
    used as is. Only a session within one process (local tests) gets a fresh
    temporary folder when nothing is configured; on a cluster every node
    would write to a folder of its own, so that is an error.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - no driver-side context: the server's setting applies
        return spark.conf.get("spark.checkpoint.dir", None) or ""
    current = sc.getCheckpointDir()
    if current:
        return current
    conf = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise ValueError(f"master {sc.master}: set spark.checkpoint.dir to a folder that all nodes share")
        conf = tempfile.mkdtemp(prefix="postwise-ckpt-", dir="/tmp")
    sc.setCheckpointDir(conf)
    return sc.getCheckpointDir() or conf


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path under the shared checkpoint folder for written intermediate tables."""
    base = ensure_checkpoint_dir(spark)
    return "/".join([base.rstrip("/")] + [p.strip("/") for p in parts])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared checkpoint folder and read back.

    Like an eager checkpoint it fixes the rows and cuts the lineage, but as compressed Parquet, of which later
    steps read only the columns that they use.
    """
    path = scratch_path(df.sparkSession, "postwise-tables", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
