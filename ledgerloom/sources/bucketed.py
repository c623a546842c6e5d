"""Typed copies stored in buckets of a key, for joins by that key that shuffle no fact.

Rows are dealt to files by the hash of the key when the copy is written, once. A key with more rows
than an even bucket holds would make its bucket as large as all of its rows, so such keys are kept
apart: their rows stay as they come, and there are fewer of these keys than buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.buckets import BucketedRows
from ledgerloom.sources.lines import LINE
from ledgerloom.sources.tables import (
    BEYOND, WITHIN, Table, load_table, parse_tolerant, schema_of, wide_writers,
)

BUCKETS, HOT, KEYS = "buckets", "hot", "hot_keys"


def save_bucketed(
    source: DataFrame, table: Table, path: str, key: str = "address", buckets: int = 200
) -> None:
    """Stores a typed copy of ``source`` (raw lines, or a typed copy, which is cheaper to read the
    three times this takes) in ``buckets`` files.

    One aggregate counts the rows of each key. Keys with more than an even share of all rows are
    hot. Take as many buckets as a join has shuffle partitions, at least: with fewer, Spark
    shuffles the facts after all.
    """
    spark, path = source.sparkSession, path.rstrip("/")
    if source.columns == [LINE]:
        rows = parse_tolerant(source, table)
    else:
        rows = source if BEYOND in source.columns else source.withColumn(BEYOND, F.lit(WITHIN))
    counts = rows.groupBy(key).agg(F.count("*").alias("times")).persist()
    total = counts.agg(F.sum("times")).first()[0] or 0
    counts.where(F.col("times") * buckets > total).select(key).coalesce(1).write.parquet(f"{path}/{KEYS}")
    counts.unpersist()
    hot = F.broadcast(spark.read.schema(f"{key} string").parquet(f"{path}/{KEYS}"))
    cold = rows.join(hot, key, "left_anti").repartition(buckets, key)  # a bucket is one task's file
    name = f"bucketed_{uuid.uuid4().hex}"
    with wide_writers(spark, table):
        rows.join(hot, key, "left_semi").write.partitionBy(BEYOND).parquet(f"{path}/{HOT}")
    cold = cold.select(*table.columns, BEYOND).write.partitionBy(BEYOND).bucketBy(buckets, key)
    cold.option("path", f"{path}/{BUCKETS}={buckets}").saveAsTable(name)
    spark.sql(f"drop table {name}")  # an external table: its files stay


def load_bucketed(
    spark: SparkSession, table: Table, path: str, key: str = "address"
) -> BucketedRows:
    """The copy at ``path``. Only tables have buckets, so the session's catalog gets one over the
    files; nothing of it outlives the session."""
    path = path.rstrip("/")
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{BUCKETS}=*")
    found = pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern)
    if not found:
        raise FileNotFoundError(f"no bucketed copy in {path}")
    folder = found[0].getPath()
    name = f"bucketed_{uuid.uuid4().hex}"
    spark.sql(
        f"create table {name} ({schema_of(table)}, {BEYOND} string) using parquet"
        f" partitioned by ({BEYOND}) clustered by ({key})"
        f" into {folder.getName().split('=')[1]} buckets location '{folder.toString()}'"
    )
    spark.sql(f"msck repair table {name}")
    rows = spark.table(name)
    long = any(r[0] != f"{BEYOND}={WITHIN}" for r in spark.sql(f"show partitions {name}").collect())
    hot_keys = spark.read.schema(f"{key} string").parquet(f"{path}/{KEYS}")
    hot = load_table(spark, table, f"{path}/{HOT}")
    buckets = rows if long else rows.select(*table.columns)
    if long != (BEYOND in hot.columns):  # both alike, so that they can be one frame
        buckets, hot = (
            r if BEYOND in r.columns else r.withColumn(BEYOND, F.lit(WITHIN)) for r in (buckets, hot)
        )
    return BucketedRows(key, buckets, hot, hot_keys)
