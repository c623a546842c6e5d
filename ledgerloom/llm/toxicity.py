"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams and skip-grams."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import hashes, mixed, remainder, text_of

BITS = 20
#: Most labelled rows that a fit reads: the documented bound of the training sample.
SAMPLE = 20_000
FOLDS = 5
#: Lengths of the stems that stand beside the words, for inflected forms that no label has shown.
STEMS = (4, 5)
_WORD = re.compile(r"\w+")
_PAIR, _SKIP = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def features(
    texts: list[str | None], bits: int = BITS, used: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """(text, coordinate) pairs, distinct and in order: words, their STEMS first letters, word pairs
    and pairs with one word between them, each hashed to one of 2**bits coordinates. Only those that
    ``used`` marks, if given: few have a weight, and the others need no sorting."""
    split = [_WORD.findall((t or "").lower()) for t in texts]
    own = np.repeat(np.arange(len(split)), [len(s) for s in split])
    coded = pa.array([w for s in split for w in s], pa.string()).dictionary_encode()
    at, distinct = coded.indices.to_numpy(), coded.dictionary.to_pylist()
    h = hashes([w.encode() for w in distinct])[at]
    stems = [hashes([f"{w[:n]} {n}".encode() for w in distinct]) for n in STEMS]
    near, far = own[1:] == own[:-1], own[2:] == own[:-2]
    pairs = mixed(h[:-1] * _PAIR + h[1:])[near]
    skips = mixed(h[:-2] * _SKIP + h[2:])[far]
    kinds = [(own, mixed(h)), *((own, mixed(s)[at]) for s in stems)]
    kinds += [(own[1:][near], pairs), (own[2:][far], skips)]
    keys = []
    for text, value in kinds:
        coordinate = (value >> np.uint64(64 - bits)).astype(np.int64)
        if used is not None:
            kept = used[coordinate]
            text, coordinate = text[kept], coordinate[kept]
        keys.append(text.astype(np.int64) << bits | coordinate)
    keys = np.unique(np.concatenate(keys))
    return keys >> bits, keys & ((1 << bits) - 1)


class Ftrl:
    """Per-coordinate learning rates, L1 and L2 penalties; the last coordinate is the bias."""

    def __init__(
        self, bits: int = BITS, alpha: float = 0.3, beta: float = 1.0, l1: float = 4.0, l2: float = 0.5
    ) -> None:
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        w = (np.sign(z) * self.l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)
        return np.where(np.abs(z) <= self.l1, 0.0, w)

    def step(self, i: np.ndarray, label: float) -> None:
        w = self.weights(i)
        g = 1 / (1 + np.exp(-np.clip(w.sum(), -35, 35))) - label
        n = self.n[i]
        self.z[i] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha * w
        self.n[i] = n + g * g


def fit(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    sample: int = SAMPLE,
    epochs: int = 4,
    bits: int = BITS,
) -> dict[int, float]:
    """Non-zero weights by coordinate, learned from labelled rows outside the held-out fold.

    At most ``sample`` labelled ids are used, those with the smallest hashes, so reruns agree.
    Several labels of one id count as their majority, ties as 1; null labels and ids are ignored.
    Tasks extract the features; one task, whose input the sample bounds, does the sequential steps.
    L1 leaves few weights, of at most 2**bits, so they can be collected and broadcast.
    """
    own = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
    own = own.where(remainder(id_col, FOLDS) != 0).groupBy(F.col(id_col).alias("_id"))
    own = own.agg((F.avg(label_col) >= 0.5).cast("int").alias("_label"))
    chosen = own.orderBy(F.xxhash64("_id"), "_id").limit(sample)
    rows = df.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    rows = rows.join(F.broadcast(chosen), "_id")  # at most ``sample`` rows of two numbers

    @F.pandas_udf("array<int>")
    def extracted(texts: pd.Series) -> pd.Series:
        at, coordinate = features(list(texts), bits)
        cut = np.searchsorted(at, np.arange(1, len(texts)))
        return pd.Series([x.astype(np.int32) for x in np.split(coordinate, cut)])

    def learned(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        examples = [pair for b in batches for pair in zip(b["_features"], b["_label"])]
        if not examples:
            return
        model, bias = Ftrl(bits), np.array([1 << bits])
        for _ in range(epochs):
            for own, label in examples:
                for _ in range(1 + label):  # label 1 is the rare one and steps twice
                    model.step(np.concatenate([own, bias]), label)
        w = model.weights()
        keep = np.union1d(np.flatnonzero(w), bias)
        yield pd.DataFrame({"coordinate": keep.astype(np.int64), "weight": w[keep]})

    # Copies of an id beyond its first rows add nothing; the bound holds for rows, not only ids.
    ready = rows.withColumn("_order", F.xxhash64("_id", text_of("_text")))
    ready = ready.orderBy("_order").limit(sample)
    ready = ready.repartition(64, "_order").select(
        "_order", "_label", extracted(F.col("_text")).alias("_features")
    )
    single = ready.repartition(1).sortWithinPartitions("_order", "_label")
    found = single.mapInPandas(learned, "coordinate long, weight double")
    return {int(r[0]): float(r[1]) for r in found.collect()}


def score_column(spark, text, weights: dict[int, float], bits: int = BITS):
    """Probability of label 1; without any weight (nothing to learn from) it is 0."""
    dense = np.zeros((1 << bits) + 1, np.float32)
    for i, w in weights.items():
        dense[i] = w
    model = spark.sparkContext.broadcast((np.flatnonzero(dense), dense[np.flatnonzero(dense)]))

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        w = np.zeros((1 << bits) + 1)
        w[model.value[0]] = model.value[1]
        used = w[:-1] != 0
        for texts in batches:
            out = []
            for start in range(0, len(texts), 500):
                part = list(texts[start : start + 500])
                at, coordinate = features(part, bits, used)
                z = np.bincount(at, w[coordinate], minlength=len(part)) + w[-1]
                out.append(1 / (1 + np.exp(-np.clip(z, -35, 35))))
            scores = np.concatenate(out) if out else np.empty(0)
            yield pd.Series(scores if weights else np.zeros(len(texts)))

    return scored(text)


def toxicity(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    sample: int = SAMPLE,
) -> DataFrame:
    """One row per row of ``df``: its id, held_out, score and predicted.

    The score depends on the text alone. Null and empty texts have the score of the bias; a text
    is read whole; repeated rows and null ids (counted as the empty text for the fold) keep a row
    each; without training rows every score is 0; other columns are ignored.
    """
    weights = fit(df, labels, id_col, text_col, sample=sample)
    score = score_column(df.sparkSession, F.col(text_col), weights)
    rows = df.select(
        F.col(id_col), (remainder(id_col, FOLDS) == 0).alias("held_out"), score.alias("score")
    )
    return rows.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
