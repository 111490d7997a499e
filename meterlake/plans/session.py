"""Session settings and the shared folder for checkpoints."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def build_session(cores: str = "*", shuffle_partitions: int = 8, app: str = "meterlake") -> SparkSession:
    """Local session for tests and benchmarks; on a cluster pass your own session to the operators."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.driver.bindAddress", "127.0.0.1")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; a fresh local one only where none is configured and executors are local too."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not only_local(sc.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="meterlake-checkpoint-"))
    return sc.getCheckpointDir()


def only_local(master: str) -> bool:
    """Whether tasks run in the driver's own process."""
    return master == "local" or master.startswith("local[")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write the rows to the shared checkpoint folder and read them back from there."""
    checkpoint_folder(df.sparkSession)
    return df.checkpoint(eager=True)
