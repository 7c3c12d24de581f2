"""Materialise an intermediate used by several branches of one plan.

The table is written as Parquet under the cluster's shared checkpoint folder (see
``aspectra.session.scratch_dir``) and read back, which cuts the lineage: every branch reads
the same files instead of recomputing the scan and parse, and a lost executor costs a
re-read of files, not a recomputation of the whole upstream plan.
"""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from aspectra.session import new_scratch_path  # noqa: F401  (re-exported)

#: (application, label, source) -> path of a table that several queries of a session read.
_SHARED: dict[tuple[str, str, str], str] = {}


#: Large tables that a session keeps are packed by zstd, which takes a third less disk than the default for the same time.
KEPT = {"split-sentences": "zstd", "examples": "zstd"}


def write_table(df: DataFrame, label: str) -> str:
    """Path of a new scratch table that holds ``df``."""
    path = new_scratch_path(df.sparkSession, label)
    written = df.write.option("compression", KEPT[label]) if label in KEPT else df.write
    written.mode("errorifexists").parquet(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    return df.sparkSession.read.parquet(write_table(df, label))


def shared(spark: SparkSession, label: str, source: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The table that ``build`` gives for ``source``, written once in a session and read by each query.

    ``source`` names the input, which must not change while the session lasts; ``release`` drops
    what was written."""
    key = (spark.sparkContext.applicationId, label, source)
    if key not in _SHARED:
        _SHARED[key] = write_table(build(), label)
    return spark.read.parquet(_SHARED[key])


def release(spark: SparkSession) -> None:
    """Delete the shared tables of this session; later queries write them again."""
    app = spark.sparkContext.applicationId
    for key in [k for k in _SHARED if k[0] == app]:
        target = spark._jvm.org.apache.hadoop.fs.Path(_SHARED.pop(key))
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
