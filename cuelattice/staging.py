"""Lineage cuts between the stages of a long job."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: the session's spark.checkpoint.dir. A
    folder of this session is set where it is unset in local mode (tests); on a cluster
    it has to be set."""
    sc = spark.sparkContext
    found = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="spark-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def stage(df: DataFrame) -> DataFrame:
    """df written to the shared folder as Parquet and read from there, so that later steps
    that use it more than once don't repeat what made it, each reads only its columns, sizes
    are known to joins, and a lost executor costs no more than its own tasks."""
    path = f"{folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
