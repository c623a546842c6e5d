"""Saved results: JSON lines of [key, value] pairs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: run stamp in the result name, with dashes for colons so that every file system
# takes it.
STAMP = "%d-%m-%Y_%H-%M-%S"

PAIRS = "array<array<string>>"


def _json(name: str) -> Column:
    # to_json needs a container: take the element out of a one-element list.
    listed = F.to_json(F.array(F.col(name)))
    return F.substring(listed, F.lit(2), F.length(listed) - 2)


def pairs_text(df: DataFrame, limit: int | None = None) -> DataFrame:
    """One line ``["key", value]`` for each row, or for the first ``limit`` rows, of ``df``."""
    key, value = df.columns
    pair = F.concat(F.lit("["), _json(key), F.lit(", "), _json(value), F.lit("]"))
    return (df if limit is None else df.limit(limit)).select(pair.alias("value"))


def write_result(
    df: DataFrame,
    base: str,
    name: str,
    limit: int | None = None,
    now: datetime | None = None,
) -> str:
    """Writes every row of a two-column result, or its first ``limit`` rows; returns the new
    directory. Part files follow one another in the order of ``df``."""
    stamp = (now or datetime.now()).strftime(STAMP)
    path = f"{base.rstrip('/')}/{name}{stamp}"
    pairs_text(df, limit).write.text(path)
    return path


def read_pairs(
    spark: SparkSession, path: str, kind: str = "double", ordered: bool = False
) -> DataFrame:
    """``key`` and ``value`` of a saved result, in lines of one pair or of a list of pairs; other
    text raises. ``ordered`` sorts them as they were written: by part file, by the split of it and
    by the line, whatever tasks read them."""
    line = F.trim(F.col("value"))
    text = spark.read.text(path)
    if ordered:
        text = text.select(
            "value", F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("line"),
        )
    text = text.where(F.length(line) > 0)
    whole = line.startswith("[[") | (line == "[]")  # the older form: all pairs in one line
    listed = F.when(whole, line).otherwise(F.concat(F.lit("["), line, F.lit("]")))
    pairs = F.from_json(listed, PAIRS, {"mode": "FAILFAST"})
    places = ["file", "block", "line"] if ordered else []
    exploded = text.select(*places, F.posexplode(pairs).alias("place", "pair"))
    if ordered:
        exploded = exploded.orderBy(*places, "place")
    return exploded.select(
        F.trim(F.col("pair")[0]).alias("key"), F.col("pair")[1].cast(kind).alias("value")
    )
