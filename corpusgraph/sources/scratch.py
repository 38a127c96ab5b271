"""Where intermediate tables go.

On a cluster the folder is the one named in ``spark.checkpoint.dir``, which all
executors share, so a lost executor costs no data. Only a local session without that
setting gets a temporary folder of its own.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession

# Texts take less than two thirds of what they take in the default codec.
TEXT_CODEC = "zstd"
_SETTING = "spark.checkpoint.dir"
_local_roots: dict[str, str] = {}


def _configured(spark: SparkSession) -> str | None:
    return spark.conf.get(_SETTING, None) or spark.sparkContext.getConf().get(_SETTING)


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables."""
    root = _configured(spark)
    if root:
        return root.rstrip("/")
    context = spark.sparkContext
    if context.master.startswith("local-cluster") or not context.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder that all executors share")
    if context.applicationId not in _local_roots:
        _local_roots[context.applicationId] = tempfile.mkdtemp(prefix="corpusgraph-")
    return _local_roots[context.applicationId]


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A folder name below the shared root that no other run uses."""
    return f"{scratch_root(spark)}/scratch/{label}-{uuid.uuid4().hex}"


def materialize(
    df: DataFrame,
    label: str = "step",
    partition_by: Sequence[str] = (),
    compression: str | None = None,
) -> DataFrame:
    """Cut the lineage: write the frame to the shared folder and read it back.

    Unlike an RDD checkpoint, the copy is columnar, so later steps read only the
    columns they need and count rows from file footers. ``compression`` is the session's
    codec unless given; ``TEXT_CODEC`` is for whole texts.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.partitionBy(*partition_by).parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)


def materialize_measured(
    df: DataFrame, label: str, partition_by: Sequence[str] = (), **metrics: Column
) -> tuple[DataFrame, dict]:
    """``materialize``, with aggregates over the rows taken during the write."""
    seen = Observation()
    named = [value.alias(name) for name, value in metrics.items()]
    return materialize(df.observe(seen, *named), label, partition_by), seen.get
