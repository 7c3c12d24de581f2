"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def build_session(master: str = "local[8]", shuffle_partitions: int = 8, app: str = "aspectra") -> SparkSession:
    """Session with AQE (coalesce + skew join) on and the UI off.

    On a cluster the caller owns the session; this is for tests and bench.py.
    """
    spark = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.aspectra.spread.partitions", str(2 * shuffle_partitions))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for written intermediate tables.

    Uses the cluster's ``spark.checkpoint.dir``. Only where it is unset and the master is
    local (tests) a folder of our own is created and registered; on a cluster a folder of the
    driver would not be seen by the executors, so that is an error.
    """
    conf_dir = spark.conf.get("spark.checkpoint.dir", None)
    sc_dir = spark.sparkContext.getCheckpointDir()
    base = conf_dir or sc_dir
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="aspectra-ckpt-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def new_scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh sub-path of the shared scratch folder (never reused, never cleared)."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex[:12]}"


def spread(df, partitions: int | None = None):
    """``df`` dealt round-robin into ``partitions`` before heavy per-row work.

    The number is the setting ``spark.aspectra.spread.partitions`` unless given. Without either it is three
    for each core, or the session's shuffle partitions if they are more: a file's row group is read by one task however many cores there
    are, so a table of few row groups would leave all text work to a few tasks. 0: the scan's own partitions stay.
    """
    session = df.sparkSession
    least = max(3 * session.sparkContext.defaultParallelism, int(session.conf.get("spark.sql.shuffle.partitions")))
    n = partitions or int(session.conf.get("spark.aspectra.spread.partitions", str(least)))
    return df.repartition(n) if n else df
