"""Helpers shared by the operators: reliable checkpoints, words, packed integers."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"
#: ASCII white space, the only separators of words.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder in the session's setting; only a local session without it gets one of its own."""
    folder = spark.conf.get(SETTING, None)
    if folder is None:
        context = spark.sparkContext
        if not context.master.startswith("local["):
            raise ValueError(f"set {SETTING} to a folder that all executors share")
        folder = context.getCheckpointDir() or tempfile.mkdtemp(prefix="checkpoints-")
    return folder.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut, kept in the shared folder that the session names."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))
    return df.checkpoint()


def shared_table(df: DataFrame, with_path: bool = False):
    """``df`` written as Parquet to the shared folder and read again; on wish with its path, for
    ``dropped_table``."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{uuid.uuid4().hex}"
    df.write.parquet(path)
    read = spark.read.schema(df.schema).parquet(path)
    return (read, path) if with_path else read


def dropped_table(spark: SparkSession, path: str) -> None:
    """Removes a table that ``shared_table`` wrote and that nothing reads any more."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    free_shuffles(spark)


def free_shuffles(spark: SparkSession) -> None:
    """Spark removes shuffle files when the driver collects the frames they belong to; this asks for
    it where large ones are done with."""
    gc.collect()
    spark._jvm.System.gc()


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str | Column) -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def remainder(column: str, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % divisor


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered: what bytes.lower and bytes.split do."""
    return (text or "").encode().lower().split()


def hashes(tokens: list[bytes]) -> np.ndarray:
    """64-bit hash of each token."""
    return np.fromiter(map(xxhash.xxh64_intdigest, tokens), np.uint64, len(tokens))


def mixed(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over all output bits (a bijection on 64 bits)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def compressed_text(text: Column) -> Column:
    """A text as compressed bytes, for a shuffle that carries whole texts."""

    @F.pandas_udf("binary")
    def small(texts: pd.Series) -> pd.Series:
        compressor = zstandard.ZstdCompressor(level=1)
        return pd.Series([compressor.compress(t.encode()) for t in texts], dtype=object)

    return small(text)


def plain_text(data: bytes) -> str:
    return zstandard.decompress(data).decode()


def packed(sorted_values: np.ndarray) -> bytes:
    """Sorted 64-bit integers as differences, by byte planes, compressed."""
    return packed_counts(np.diff(sorted_values, prepend=np.uint64(0)))


def unpacked(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked_counts(data).view(np.uint64), dtype=np.uint64)


def packed_counts(values: np.ndarray) -> bytes:
    """64-bit integers by byte planes, compressed: small ones take little."""
    planes = np.ascontiguousarray(values.astype("<u8").view(np.uint8).reshape(-1, 8).T)
    return zstandard.compress(planes.tobytes(), 1)


def unpacked_counts(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1)
    return np.ascontiguousarray(planes.T).view("<i8").ravel()


def place(values: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of a 64-bit hash; buckets follow the order of the hashes."""
    return ((values >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
