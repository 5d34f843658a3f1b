"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

OWN_FOLDERS: dict[str, str] = {}  # by application, where the setting is unset


def scratch(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, or below a temporary one where that is unset on one machine."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        folder = OWN_FOLDERS.get(spark.sparkContext.applicationId) or tempfile.mkdtemp(prefix="periodica-")
        OWN_FOLDERS[spark.sparkContext.applicationId] = folder
    return f"{folder.rstrip('/')}/periodica/query-{uuid.uuid4().hex}"


def stored(frame: DataFrame) -> DataFrame:
    """`frame`, written and read back: its lineage ends there."""
    path = scratch(frame.sparkSession)
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)
