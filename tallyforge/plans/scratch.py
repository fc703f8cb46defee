"""Where intermediate tables go.

Lineage is cut by writing a parquet table in the folder that the cluster names in
``spark.checkpoint.dir``: every executor can read it, so a lost executor costs a retry
of one task and nothing upstream.  Without that setting a temporary folder is made, but
only on a local master; a cluster without a shared folder is an error, not a guess.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    sc = spark.sparkContext
    root = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if sc.applicationId not in _local:
        _local[sc.applicationId] = tempfile.mkdtemp(prefix="tallyforge-")
        atexit.register(shutil.rmtree, _local[sc.applicationId], ignore_errors=True)
    return _local[sc.applicationId]


def staged(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return the written table."""
    spark = df.sparkSession
    path = f"{scratch_root(spark)}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
