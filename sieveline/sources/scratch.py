"""Tables that a job writes for itself, in the folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """spark.checkpoint.dir. Only a local session, whose executors are here, gets a folder of its own where it is unset."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            return kept.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="sieveline-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/sieveline-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df, cut from its lineage as a Parquet table in the shared folder."""
    path = new_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
