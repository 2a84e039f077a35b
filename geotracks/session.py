"""Cutting lineage safely."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def materialize(df: DataFrame) -> DataFrame:
    """``df`` written once as parquet in the shared checkpoint folder, and read back.

    For intermediate tables that are read several times. It survives lost executors, and
    later joins see the true size, so a side is broadcast only when it is really small.
    """
    path = f"{work_folder(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def work_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session that names none gets one of its own, as in tests.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            context.setCheckpointDir(configured)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="geotracks-"))
        else:
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return context.getCheckpointDir()
