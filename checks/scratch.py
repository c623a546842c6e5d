"""A fresh folder for tables a check writes and reads back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTING = "spark.checkpoint.dir"


def scratch(spark: SparkSession) -> str:
    """New path in the shared folder the session names; a local one only where none is named."""
    shared = spark.conf.get(SETTING, None)
    if shared is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        shared = tempfile.mkdtemp(prefix="ledgerloom-")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}"
