"""Where tables go that are written only to be read again."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path nobody else uses, below the folder that the cluster shares.

    Without that setting only a local session gets a folder of its own machine.
    """
    base = spark.conf.get(SETTING, None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="terrace-")
    return f"{base}/terrace/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"
