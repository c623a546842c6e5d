"""SimHash near-duplicates: 64-bit fingerprints, pigeonhole blocks, Hamming distance."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed, words
from ledgerloom.llm.components import components

BITS = 64
SEED = 42


def fingerprint(text: str | None, width: int = 3) -> int:
    """Signed 64-bit SimHash over shingles of ``width`` words, repeats included.

    A bit is set if more than half the shingles' XXH64 values set it. A shorter text is one shingle
    of all its words; a text without words, empty or null, has fingerprint zero.
    """
    own = words(text)
    if not own:
        return 0
    if len(own) <= width:
        shingles = [b" ".join(own)]
    else:
        shingles = map(b" ".join, zip(*(own[i:] for i in range(width))))
    digest = xxhash.xxh64_intdigest
    values = np.fromiter((digest(s, SEED) for s in shingles), np.uint64)
    counts = np.zeros(BITS, np.int64)
    for start in range(0, len(values), 65536):  # a long text needs no large bit matrix
        part = values[start : start + 65536].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(values), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprint_column(text, width: int = 3):
    @F.pandas_udf("long")
    def of(texts: pd.Series) -> pd.Series:
        return pd.Series([fingerprint(t, width) for t in texts], dtype="int64")

    return of(text)


def masks(max_bits: int, blocks: int) -> list[int]:
    """Bit masks of all choices of ``blocks - max_bits`` out of ``blocks`` blocks.

    ``max_bits`` differing bits touch at most that many blocks, so a close pair agrees on all of
    at least one choice.
    """
    if not 0 <= max_bits < blocks <= BITS:
        raise ValueError("0 <= max_bits < blocks <= 64 is needed")
    edge = [BITS * i // blocks for i in range(blocks + 1)]
    part = [((1 << edge[i + 1]) - (1 << edge[i])) for i in range(blocks)]
    choices = (sum(part[i] for i in c) for c in combinations(range(blocks), blocks - max_bits))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in choices]


def links(prints: DataFrame, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """Distinct pairs a < b out of the distinct fingerprints ``fp`` that differ in at most
    ``max_bits`` bits. Three of six blocks make keys of about 32 bits, so a bucket holds little
    but true neighbours at any size; adaptive execution splits the buckets that are large."""
    keys = F.array(
        *(
            F.struct(F.lit(i).alias("choice"), F.col("fp").bitwiseAND(F.lit(m)).alias("block"))
            for i, m in enumerate(masks(max_bits, blocks))
        )
    )
    rows = prints.select("fp", F.explode(keys).alias("k")).select("k.*", "fp")
    left, right = rows.withColumnRenamed("fp", "a"), rows.withColumnRenamed("fp", "b")
    close = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits
    pairs = left.join(right, ["choice", "block"]).where((F.col("a") < F.col("b")) & close)
    return pairs.select("a", "b").distinct()


def component_map(keyed: DataFrame, max_bits: int = 3, blocks: int = 6) -> DataFrame:
    """Rows (fp, id) to one row (fp, component) for each fingerprint: component is the smallest id
    that links reach, null only if all those ids are null."""
    nodes = checkpointed(keyed.groupBy("fp").agg(F.min("id").alias("least")))
    roots = components(links(nodes.select("fp"), max_bits, blocks))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left")
    rooted = rooted.select("fp", "least", F.coalesce("root", "fp").alias("root"))
    best = rooted.groupBy("root").agg(F.min("least").alias("component"))
    return checkpointed(rooted.join(best, "root").select("fp", "component"))


def near_duplicates(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    max_bits: int = 3,
    blocks: int = 6,
) -> DataFrame:
    """One row per row of ``df``: its id, fingerprint (16 hex digits) and component_id.

    Equal fingerprints meet in one aggregate before any join, so copies are never paired. Null and
    empty texts have fingerprint zero and link to one another; repeated rows keep a row each; rows
    with a null id take part and never lend it to a component; an empty table gives no rows; other
    columns are ignored. Texts are read whole.
    """
    keyed = checkpointed(
        df.select(
            F.col(id_col).alias("id"), fingerprint_column(F.col(text_col), width).alias("fp")
        )
    )
    found = component_map(keyed, max_bits, blocks)
    return keyed.join(found, "fp").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def one_of_each(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 3,
    max_bits: int = 3,
    blocks: int = 6,
) -> DataFrame:
    """The rows of ``df``, all columns unchanged, with one left of each group of near-duplicates.

    The row with the smallest id stays (null last), then the one with the smallest hash of its
    columns; of fully equal rows one. Texts are shuffled once, for the last join.
    """
    row = F.struct("*")
    rows = df.select(row.alias("row"), F.xxhash64(row).alias("hash"), F.col(id_col).alias("id"))
    keyed = checkpointed(
        rows.select("id", "hash", fingerprint_column(F.col("row")[text_col], width).alias("fp"))
    )
    nodes = checkpointed(
        keyed.groupBy("fp").agg(
            F.min(F.struct(F.col("id").isNull().alias("n"), "id", "hash")).alias("best")
        )
    )
    roots = components(links(nodes.select("fp"), max_bits, blocks))
    stays = (
        nodes.join(roots, nodes["fp"] == roots["node"], "left")
        .groupBy(F.coalesce("root", "fp"))
        .agg(F.min("best").alias("best"))
        .select(F.col("best.id").alias("kept"), F.col("best.hash").alias("kept_hash"))
    )
    stays = checkpointed(stays)
    chosen = rows.join(
        stays, F.col("id").eqNullSafe(F.col("kept")) & (F.col("hash") == F.col("kept_hash")),
        "left_semi",
    )
    return chosen.dropDuplicates(["id", "hash"]).select("row.*")
