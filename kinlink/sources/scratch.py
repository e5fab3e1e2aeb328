"""A shared folder for tables that a query writes and reads again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, label: str) -> str:
    """An unused path in the cluster's checkpoint folder; a local one only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = "file://" + tempfile.mkdtemp(prefix="kinlink-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/scratch/{label}-{uuid.uuid4().hex}"
