"""Session with the settings the plans rely on."""

from __future__ import annotations

import os
from collections.abc import Mapping

from pyspark.sql import SparkSession

from ledgerloom.sources.object_store import s3a_options

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def build_session(
    name: str = "ledgerloom",
    env: Mapping[str, str] = os.environ,
    options: Mapping[str, str] | None = None,
) -> SparkSession:
    """Session for the reports; ``options`` override the defaults, for instance the number of
    shuffle partitions or the bytes per scan task on a large cluster."""
    builder = SparkSession.builder.appName(name)
    for key, value in {**DEFAULTS, **s3a_options(env), **(options or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    # A session that already ran ignores what the builder says about its file systems.
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for key, value in s3a_options(env).items():
        hadoop.set(key.removeprefix("spark.hadoop."), value)
    return spark
