"""Session helpers. The library never creates a SparkSession; callers pass one.

Intermediate data that must outlive an executor goes to the cluster's shared
checkpoint folder (``spark.checkpoint.dir``), never to a machine-local
temporary folder. Only when the setting is absent and the master is local is a
local folder created and registered; on a cluster its absence is an error.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

import mdmspark

CHECKPOINT_CONF = "spark.checkpoint.dir"


def shared_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder named by the cluster."""
    sc = spark.sparkContext
    d = sc.getConf().get(CHECKPOINT_CONF, None) or spark.conf.get(CHECKPOINT_CONF, None)
    if d:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(d)
        return d.rstrip("/")
    current = sc.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="mdmspark-checkpoint-")
    sc.setCheckpointDir(local)
    return sc.getCheckpointDir().rstrip("/")


def map_arrow(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    """``df.mapInArrow``, with this package's folder on the workers' import
    path where they share it (on a cluster the package comes by ``--py-files``)."""
    env, root = df.sparkSession.sparkContext.environment, str(Path(mdmspark.__file__).resolve().parent.parent)
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        env["PYTHONPATH"] = os.pathsep.join([*paths, root])
    return df.mapInArrow(run, schema)


def spread(df: DataFrame) -> DataFrame:
    """A frame read from fewer files than tasks can run at once, dealt to that
    many. A row group is one task's whatever its length, so a file of one keeps
    one core busy. Frames that a shuffle has dealt, and those of twice as many
    splits, stay as they are; the splits are planned on the driver, no job runs."""
    n = df.sparkSession.sparkContext.defaultParallelism
    if not 0 < len(df.inputFiles()) < n or "Exchange" in df._jdf.queryExecution().executedPlan().toString():
        return df
    return df if df.rdd.getNumPartitions() >= 2 * n else df.repartition(n)


_SCRATCH: dict[str, list[str]] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unused path under the shared folder."""
    path = f"{shared_dir(spark)}/mdmspark-scratch/{name}-{uuid.uuid4().hex}"
    _SCRATCH.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def release_scratch(spark: SparkSession) -> int:
    """Delete the scratch tables that this application made so far, on whatever
    store they are; how many there were. Call it once no result that reads
    them is needed any more: until then they are what lets a lost executor's
    work be read again."""
    paths = _SCRATCH.pop(spark.sparkContext.applicationId, [])
    return sum(_delete(spark, path) for path in paths)


def discard_scratch(spark: SparkSession, path: str) -> bool:
    """Delete one scratch table that nothing reads any more (a round of an
    iteration whose successor is written); whether it was there."""
    own = _SCRATCH.get(spark.sparkContext.applicationId, [])
    if path not in own:
        raise ValueError(f"not a scratch table of this application: {path}")
    own.remove(path)
    return _delete(spark, path)


def _delete(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True))
