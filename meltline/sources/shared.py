"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession, tag: str) -> str:
    """A new path in spark.checkpoint.dir; only in local mode, where none is named, in a folder of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        path = "file://" + tempfile.mkdtemp(prefix="meltline-")
        spark.conf.set("spark.checkpoint.dir", path)
    return f"{path.rstrip('/')}/meltline/{tag}-{uuid.uuid4().hex}"
