"""Language-model scoring by deleted interpolation of unigram and bigram estimates."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    checkpointed, compressed_text, hashes, mixed, packed, packed_counts, place, plain_text, remainder,
    text_of, unpacked, unpacked_counts, words,
)

FOLDS = 10
#: Of the training texts, those with this remainder tune the mixture weights.
TUNING = 1
#: Text bytes and texts that one task holds at once, on average.
CHUNK_BYTES, CHUNK_ROWS = 16 << 20, 8192
#: Context-frequency buckets: 0 for unseen contexts, then by the bits of the frequency.
BUCKETS = 40
#: Estimates are gathered in cells of this width in log2 for the maximisation; 0 is a cell apart.
CELLS = 60
#: Stands for the end of a text, and for its start as a context; no word hashes a blank.
END = hashes([b" "])[0]
_FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Chunk:
    """The tokens of some texts, end to end, and their distinct unigrams and bigrams."""

    def __init__(self, texts) -> None:
        """``texts``: compressed ones. A few at a time are words; the rest of the time, hashes."""
        parts, sizes = [], []
        for low in range(0, len(texts), 200):
            split = [words(plain_text(t)) for t in texts[low : low + 200]]
            ends = np.cumsum([len(s) for s in split])
            own = hashes([w for s in split for w in s])
            parts.append(np.insert(own, ends, END))
            sizes += [len(s) + 1 for s in split]
        token = np.concatenate(parts) if parts else np.empty(0, np.uint64)
        self.sizes = np.array(sizes, np.int64)
        self.ends = np.cumsum(self.sizes)
        self.starts = self.ends - self.sizes
        context = np.concatenate([[END], token[:-1]]).astype(np.uint64)  # an end starts the next
        self.doc = np.repeat(np.arange(len(sizes)), self.sizes)
        self.unigrams, self.at1 = np.unique(token, return_inverse=True)
        self.bigrams, self.at2 = np.unique(mixed(context * _FACTOR + token), return_inverse=True)
        self.context = np.concatenate([[0], self.at1[:-1]])
        if len(token):
            self.context[0] = np.searchsorted(self.unigrams, END)

    def levels(self):
        return ((1, self.unigrams, self.at1), (2, self.bigrams, self.at2))


def bucket_of(frequency: np.ndarray) -> np.ndarray:
    bits = np.log2(np.maximum(frequency, 1)).astype(int) + 1
    return np.where(frequency > 0, np.minimum(bits, BUCKETS - 1), 0)


def _requests(group: pd.DataFrame, buckets: int) -> pd.DataFrame:
    """One row per level and bucket: the distinct n-grams of a chunk that fall there, and how often
    they occur in its training texts."""
    chunk, train = Chunk(group["text"].tolist()), group["train"].to_numpy(bool)
    rows = []
    for level, values, at in chunk.levels():
        counts = np.bincount(at, train[chunk.doc], minlength=len(values)).astype(np.int64)
        own = place(values, buckets)
        cut = np.flatnonzero(np.diff(own)) + 1
        for v, c, b in zip(np.split(values, cut), np.split(counts, cut), np.split(own, cut)):
            if len(v):
                rows.append((level, int(b[0]), packed(v), packed_counts(c)))
    out = pd.DataFrame(rows, columns=["level", "bucket", "values", "counts"])
    out["chunk"] = group["chunk"].iloc[0]
    return out


def _replies(group: pd.DataFrame) -> pd.DataFrame:
    """For each chunk that asked, the counts over all chunks, in the order it asked."""
    values = [unpacked(v) for v in group["values"]]
    counts = [unpacked_counts(c) for c in group["counts"]]
    distinct, at = np.unique(np.concatenate(values), return_inverse=True)
    # Integer weights: float sums of bincount are exact up to 2**53.
    total = np.bincount(at, np.concatenate(counts), minlength=len(distinct)).astype(np.int64)
    out = group[["level", "bucket", "chunk"]].copy()
    ends = np.cumsum([len(v) for v in values])
    out["counts"] = [packed_counts(total[a]) for a in np.split(at, ends[:-1])]
    out["distinct"], out["total"] = 0, 0
    out.iloc[0, out.columns.get_loc("distinct")] = int((total > 0).sum())
    out.iloc[0, out.columns.get_loc("total")] = int(total.sum())
    return out


def _counts(replies: pd.DataFrame, level: int) -> np.ndarray:
    own = replies[replies["level"] == level].sort_values("bucket")
    parts = [unpacked_counts(c) for c in own["counts"]]
    return np.concatenate(parts) if parts else np.empty(0, np.int64)


def _tuning_cells(texts: pd.DataFrame, replies: pd.DataFrame, n: int, v: int) -> pd.DataFrame:
    """Held-out counts: how often which estimates met, with each text's own counts deleted."""
    chunk = Chunk(texts["text"].tolist())

    def others(at: np.ndarray, counts: np.ndarray, of: np.ndarray) -> np.ndarray:
        """Counts of the n-grams ``of`` less those in the same text; ``at``: all n-grams."""
        width = len(counts)
        own, size = np.unique(chunk.doc * width + at, return_counts=True)
        where = np.searchsorted(own, chunk.doc * width + of)
        where = np.minimum(where, len(own) - 1)
        mine = np.where(own[where] == chunk.doc * width + of, size[where], 0)
        return np.maximum(counts[of] - mine, 0)

    c1, c2 = _counts(replies, 1), _counts(replies, 2)
    seen = others(chunk.at1, c1, chunk.context)
    rest = np.maximum(n - chunk.sizes[chunk.doc], 1)
    p1 = others(chunk.at1, c1, chunk.at1) / rest
    p2 = np.minimum(others(chunk.at2, c2, chunk.at2) / np.maximum(seen, 1), 1.0)
    cell = lambda p: np.where(p > 0, np.clip(np.log2(np.maximum(p, 1e-30)) + CELLS, 1, CELLS), 0)
    return (
        pd.DataFrame(
            {
                "bucket": bucket_of(seen), "x": cell(p2).astype(int), "y": cell(p1).astype(int),
                "times": 1, "p2": p2, "p1": p1,
            }
        ).groupby(["bucket", "x", "y"], as_index=False).sum()
    )


def mixture(cells: pd.DataFrame, v: int, rounds: int = 100) -> np.ndarray:
    """Weights of (bigram, unigram, uniform) by context bucket, by expectation-maximisation.

    A bucket without held-out tokens has the weights of all of them together. The uniform part
    keeps a little weight, so that no token is impossible.
    """

    def learn(part: pd.DataFrame, use: np.ndarray) -> np.ndarray:
        w = use / use.sum()
        if not len(part):
            return w
        times = part["times"].to_numpy(float)
        p = np.stack(
            [part["p2"] / part["times"], part["p1"] / part["times"], np.full(len(part), 1 / (v + 1))],
            axis=1,
        )
        for _ in range(rounds):
            share = p * w
            share /= share.sum(1, keepdims=True)
            w = (share * times[:, None]).sum(0) / times.sum()
        w = np.maximum(w, 1e-6 * use)
        return w / w.sum()

    seen = cells[cells["bucket"] > 0]
    out = np.tile(learn(seen, np.ones(3)), (BUCKETS, 1))
    unseen = cells[cells["bucket"] == 0]
    out[0] = learn(unseen if len(unseen) else cells, np.array([0.0, 1.0, 1.0]))
    for bucket, part in seen.groupby("bucket"):
        out[int(bucket)] = learn(part, np.ones(3))
    return out


def _scores(texts: pd.DataFrame, replies: pd.DataFrame, n: int, v: int, weights: np.ndarray):
    chunk = Chunk(texts["text"].tolist())
    c1, c2 = _counts(replies, 1), _counts(replies, 2)
    token, pair, seen = c1[chunk.at1], c2[chunk.at2], c1[chunk.context]
    w = weights[bucket_of(seen)]
    p = w[:, 0] * (pair / np.maximum(seen, 1)) + w[:, 1] * (token / max(n, 1)) + w[:, 2] / (v + 1)
    base = np.log10((token + 0.1) / (n + 0.1 * (v + 1)))
    sums = lambda x: np.add.reduceat(x, chunk.starts)  # noqa: E731  every text has its end
    return pd.DataFrame(
        {
            "id": texts["id"], "held_out": texts["held_out"], "n_tokens": chunk.sizes,
            "n_known": sums((token > 0).astype(np.int64)), "train_tokens": n,
            "base_score": sums(base), "score": sums(np.log10(p)),
        }
    )


def score_texts(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chunk_bytes: int = CHUNK_BYTES,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """One row per row of ``df``: its id, held_out, n_tokens, n_known, train_tokens, base_score and
    score, the model's log10 probability of the text with its end.

    P(w | v) mixes the bigram estimate c(v, w) / c(v), the unigram estimate c(w) / N and a uniform
    part, with weights for the bucket of c(v). One tenth of the texts are held out of all counts;
    the counts are those of all others, and of these one part tunes the weights, each text with its
    own counts deleted. Null texts are empty, one end token; null ids count as the empty text for
    the fold; repeated rows keep a row each; without training texts the uniform part alone counts;
    an empty table gives no rows; other columns are ignored. N-grams are told apart by 64-bit
    hashes.

    Texts are dealt by hash to chunks of bounded size, in bytes and in rows. A chunk asks for the counts of its distinct
    n-grams only, packed by hash range, and each range answers every chunk in its order: what is
    shuffled is one packed number per distinct n-gram of a chunk, and a word that is in every text
    is as light as any other.
    """
    fold = remainder(id_col, FOLDS)
    rows = df.select(
        F.col(id_col).cast("string").alias("id"), text_of(text_col).alias("text"), (fold == 0).alias("held_out"),
        (fold != 0).alias("train"), (fold == TUNING).alias("tuning"),
    )
    sizes = rows.groupBy("tuning").agg(F.sum(F.octet_length("text")), F.count("*")).collect()
    chunks = {
        kind: max(1, math.ceil(size / chunk_bytes), math.ceil(n / chunk_rows)) for kind, size, n in sizes
    }
    main, tune = chunks.get(False, 1), chunks.get(True, 1)
    buckets = main + tune
    spread = F.xxhash64("id", "text")
    chunk = F.when(F.col("tuning"), main + F.pmod(spread, F.lit(tune))).otherwise(
        F.pmod(spread, F.lit(main))
    )
    rows = rows.withColumn("chunk", chunk.cast("int"))

    # Compressed after the size and the chunk are known, which need the text itself.
    rows = rows.withColumn("text", compressed_text(F.col("text")))
    asked = rows.select("chunk", "text", "train").groupBy("chunk").applyInPandas(
        lambda group: _requests(group, buckets),
        "level int, bucket int, values binary, counts binary, chunk int",
    )
    replies = asked.groupBy("level", "bucket").applyInPandas(
        _replies, "level int, bucket int, chunk int, counts binary, distinct long, total long"
    )
    replies = checkpointed(replies)
    known = replies.where("level = 1").agg(F.sum("total"), F.sum("distinct")).first()
    n, v = known[0] or 0, known[1] or 0
    answers = replies.select("chunk", "level", "bucket", "counts")

    tuning = rows.where("tuning").select("chunk", "text").groupBy("chunk")
    cells = tuning.cogroup(answers.where(F.col("chunk") >= main).groupBy("chunk")).applyInPandas(
        lambda texts, own: _tuning_cells(texts, own, n, v) if len(texts) else _NO_CELLS,
        "bucket int, x int, y int, times long, p2 double, p1 double",
    )
    cells = cells.groupBy("bucket", "x", "y").agg(*(F.sum(c).alias(c) for c in ("times", "p2", "p1")))
    weights = mixture(cells.orderBy("bucket", "x", "y").toPandas(), v)  # at most one row per cell
    if not n:
        weights[:] = [0, 0, 1]

    texts = rows.select("chunk", "id", "text", "held_out").groupBy("chunk")
    kind = df.select(F.col(id_col).alias("id")).schema["id"].dataType
    scored = texts.cogroup(answers.groupBy("chunk")).applyInPandas(
        lambda own, replied: _scores(own, replied, n, v, weights),
        "id string, held_out boolean, n_tokens long, n_known long, train_tokens long,"
        " base_score double, score double",
    )
    rest = [c for c in scored.columns if c != "id"]
    return scored.select(F.col("id").cast(kind).alias(id_col), *rest)


_NO_CELLS = pd.DataFrame({c: [] for c in ("bucket", "x", "y", "times", "p2", "p1")})
