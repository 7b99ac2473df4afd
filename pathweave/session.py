"""Spark session helpers.

The library never creates its own scratch space on a cluster: lineage is cut
with ``checkpoint()`` into the shared folder named by ``spark.checkpoint.dir``.
Only a local master (tests, bench) may fall back to a fresh temp folder.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Arrays of contexts can be wide; keep parquet batches moderate.
    "spark.sql.parquet.columnarReaderBatchSize": "2048",
}


def build_session(master: str | None = None, app: str = "pathweave",
                  shuffle_partitions: int | None = None,
                  driver_memory: str | None = None,
                  extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    if driver_memory:
        b = b.config("spark.driver.memory", driver_memory)
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting it from the session conf.

    On a cluster ``spark.checkpoint.dir`` must name a shared folder; only a
    local master may fall back to a temp folder (tests, bench).
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    master = sc.master or ""
    if not master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a shared folder before running iterative jobs")
    local_dir = tempfile.mkdtemp(prefix="pathweave-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Cut lineage by writing the rows as parquet into the shared checkpoint folder.

    Survives executor loss (unlike ``localCheckpoint``), computes the plan once
    (``checkpoint()`` on an unpersisted plan computes it twice: once to count,
    once to save) and stores columns compressed instead of serialised rows.
    """
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark)
    path = f"{root.rstrip('/')}/pw-{uuid.uuid4().hex}"
    df.write.mode("error").option("compression", "zstd").parquet(path)
    return spark.read.parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
