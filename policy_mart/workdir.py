"""Shared folder for written intermediate tables and stream checkpoints."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh path below the folder that `spark.checkpoint.dir` names.

    Every executor must see it, so a machine-local folder is used only on a local master.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="policy-mart-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
