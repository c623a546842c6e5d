"""Benchmark decontamination: spaced seeds find overlaps that survive substituted words."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed, hashes, mixed, text_of

#: Positions that a mask reads; the others may hold any word. Of 12 to 20 words, some
#: mask reads equal ones only, whichever fifth of them is replaced.
MASKS = (
    (0, 1, 3, 6, 7, 9), (0, 2, 3, 5, 8, 9), (0, 1, 2, 3, 4, 5), (0, 1, 2, 3, 4, 8),
    (0, 1, 4, 5, 8, 9),
)
SPAN = 10
#: An overlap counts from so many aligned words (all of a shorter item), so many of them equal.
MIN_WORDS, SIMILARITY = 12, 0.8
#: Words kept around a hit on either side; longer overlaps are found piece by piece.
AROUND = 48
BLOOM_BITS = 25
_WORD = re.compile(r"\w+")


def word_hashes(text: str | None) -> np.ndarray:
    return hashes([w.encode() for w in _WORD.findall((text or "").lower())])


def shapes(n: int | None = None) -> list[tuple[int, ...]]:
    """The masks of a text of ``n`` words: one shorter than the span is read as a whole."""
    if n is None or n >= SPAN:
        return [tuple(m) for m in MASKS]
    return [tuple(range(n))] if n else []


def seeds(h: np.ndarray, shape: tuple[int, ...], kind: int) -> np.ndarray:
    """Hash of the words under the mask at each position where it fits."""
    n = len(h) - max(shape)
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.full(n, 0x9E3779B97F4A7C15 * (kind + 1) & (1 << 64) - 1, np.uint64)
    for place in shape:
        total = mixed(total + h[place : place + n])
    return total


def _bloom_places(seed: np.ndarray, bits: int) -> list[np.ndarray]:
    low = np.uint64((1 << bits) - 1)
    return [(seed >> np.uint64(s)) & low for s in (0, 19, 38)]


def overlap(doc: np.ndarray, item: np.ndarray, diagonal: int, at: int) -> tuple[int, int] | None:
    """Ends (in ``doc``) of the aligned overlap around position ``at``, or None.

    ``diagonal``: position in ``doc`` less that in ``item``. The overlap grows to either side while
    a score of 1 for an equal word and -2 for another one has not dropped by more than 6. If what it
    grows to is too short or not equal enough, it is the longest part that is neither, from an equal
    word to an equal word, with some of the SPAN words from ``at`` on.
    """
    low, high = max(0, diagonal), min(len(doc), diagonal + len(item))
    same = doc[low:high] == item[low - diagonal : high - diagonal]
    at -= low
    if not 0 <= at < len(same):
        return None

    def reach(flags: np.ndarray) -> int:
        gain = np.cumsum(np.where(flags, 1, -2))
        if not len(gain):
            return 0
        fallen = np.flatnonzero(np.maximum.accumulate(gain) - gain > 6)
        gain = gain[: fallen[0]] if len(fallen) else gain
        return int(gain.argmax()) + 1 if len(gain) and gain.max() > 0 else 0

    start, end = at - reach(same[:at][::-1]), at + reach(same[at:])
    least = min(MIN_WORDS, len(item))
    if end - start < least or same[start:end].mean() < SIMILARITY:
        part = longest_part(same, at, least)
        if part is None:
            return None
        start, end = part
    return low + start, low + end


def longest_part(same: np.ndarray, at: int, least: int) -> tuple[int, int] | None:
    """Ends of the longest part (the first one) of at least ``least`` words, SIMILARITY of them
    equal, the ends among them, with some of the SPAN words from ``at`` on; or None."""
    score = np.concatenate([[0.0], np.cumsum(same - SIMILARITY)])
    equal = np.flatnonzero(same)
    starts, ends = equal[equal < at + SPAN], equal[equal >= at] + 1
    # The lowest score at or before a start; a part of at least 0 ends at its first start that low.
    lowest = np.minimum.accumulate(score[starts])
    first = np.searchsorted(-lowest, -(score[ends] + 1e-9))
    found = [
        (int(e - starts[f]), -int(starts[f]))
        for e, f in zip(ends, first)
        if f < len(starts) and e - starts[f] >= least
    ]
    if not found:
        return None
    length, start = max(found)
    return -start, length - start


def _seed_table(items: DataFrame) -> DataFrame:
    @F.pandas_udf("array<struct<seed:long,length:int,position:int>>")
    def of(texts: pd.Series) -> pd.Series:
        out = []
        for text in texts:
            h = word_hashes(text)
            out.append(
                [
                    {"seed": int(s), "length": min(len(h), SPAN), "position": i}
                    for kind, shape in enumerate(shapes(len(h)))
                    for i, s in enumerate(seeds(h, shape, kind).view(np.int64))
                ]
            )
        return pd.Series(out)

    rows = items.select("item_key", F.explode(of(F.col("item"))).alias("s"))
    return rows.select("item_key", "s.*").distinct()


def _bloom(seed_table: DataFrame, bits: int) -> bytes:
    """Bit map of all seeds. Its size is fixed; the more seeds, the more hits pass it in vain."""

    def filled(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = [b["seed"].to_numpy().view(np.uint64) for b in batches]
        seed = np.concatenate(own) if own else np.empty(0, np.uint64)
        places = np.unique(np.concatenate([p >> np.uint64(3) for p in _bloom_places(seed, bits)]))
        bit = np.zeros(1 << (bits - 3), np.uint8)
        for p in _bloom_places(seed, bits):
            np.bitwise_or.at(bit, p >> np.uint64(3), np.uint8(1) << (p & np.uint64(7)).astype(np.uint8))
        yield pd.DataFrame({"place": places.astype(np.int64), "bits": bit[places].astype(np.int32)})

    parts = seed_table.select("seed").mapInPandas(filled, "place long, bits int")
    merged = parts.groupBy("place").agg(F.bit_or("bits").alias("bits")).toArrow()
    out = np.zeros(1 << (bits - 3), np.uint8)
    out[merged["place"].to_numpy()] = merged["bits"].to_numpy().astype(np.uint8)
    return out.tobytes()


def find_overlaps(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    bloom_bits: int = BLOOM_BITS,
) -> DataFrame:
    """Rows (id, text_hash, item_id, start, end): verified overlaps of documents with test items,
    in words. Documents are told apart by id and text; a null id is one like any other.

    The seeds of all positions of all documents pass a bit map of fixed size, broadcast, of the
    test seeds; the few that pass are joined with the test seeds by shuffle, whatever the size of
    the benchmark, and verified on the words around them.
    """
    spark = df.sparkSession
    own = benchmark.select(F.col(item_col).alias("item_id"), F.col(item_text_col).alias("item"))
    own = own.distinct().withColumn("item_key", F.xxhash64("item_id", "item"))
    seed_table = checkpointed(_seed_table(own))
    lengths = [r[0] for r in seed_table.select("length").distinct().collect()]  # at most SPAN
    short = sorted(n for n in lengths if n < SPAN)
    bloom = spark.sparkContext.broadcast(_bloom(seed_table, bloom_bits))
    all_shapes = [(k, s) for k, s in enumerate(shapes())] if SPAN in lengths else []
    all_shapes += [(0, tuple(range(n))) for n in short]

    @F.pandas_udf("array<struct<start:int,words:binary,hits:array<struct<seed:long,position:int>>>>")
    def scanned(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        bits = np.frombuffer(bloom.value, np.uint8)
        for texts in batches:
            out = []
            for start in range(0, len(texts), 200):
                out += segments(list(texts[start : start + 200]), bits)
            yield pd.Series(out, dtype=object)

    def segments(texts: list[str | None], bits: np.ndarray) -> list[list[dict]]:
        split = [_WORD.findall((t or "").lower()) for t in texts]
        ends = np.cumsum([len(s) for s in split])
        h = hashes([w.encode() for s in split for w in s])
        found = []
        for kind, shape in all_shapes:
            seed = seeds(h, shape, kind)
            passed = np.ones(len(seed), bool)
            for p in _bloom_places(seed, bloom_bits):
                passed &= (bits[p >> np.uint64(3)] >> (p & np.uint64(7)).astype(np.uint8)) & 1 == 1
            at = np.flatnonzero(passed)
            doc = np.searchsorted(ends, at, side="right")
            inside = at + max(shape) < ends[doc] if len(at) else np.zeros(0, bool)
            found += zip(doc[inside].tolist(), at[inside].tolist(), seed[at[inside]].view(np.int64).tolist())
        out: list[list[dict]] = [[] for _ in texts]
        for doc, at, seed in sorted(found):
            low = int(ends[doc]) - len(split[doc])
            own = out[doc]
            if not own or at - low > own[-1]["last"] + AROUND:
                own.append({"start": max(0, at - low - AROUND), "hits": [], "offset": low})
            own[-1]["last"] = at - low
            own[-1]["hits"].append({"seed": seed, "position": at - low})
        for own in out:
            for s in own:
                low = s.pop("offset")
                stop = s.pop("last") + AROUND + SPAN
                doc = int(np.searchsorted(ends, low, side="right"))
                s["words"] = h[low + s["start"] : min(low + stop, int(ends[doc]))].tobytes()
        return out

    key = [F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash")]
    found = df.select(*key, F.explode(scanned(F.col(text_col))).alias("s"))
    found = found.select("id", "text_hash", "s.*")
    found = found.withColumn("segment", F.xxhash64("id", "text_hash", "start", "words"))
    found = checkpointed(found)
    hits = found.select("segment", F.explode("hits").alias("h")).select("segment", "h.*")
    pairs = hits.join(seed_table.select("seed", "item_key", F.col("position").alias("there")), "seed")
    # One hit of each segment, item and diagonal in each stretch of words is enough to verify it.
    pairs = pairs.groupBy(
        "segment", "item_key", (F.col("position") - F.col("there")).alias("diagonal"),
        F.floor(F.col("position") / SPAN).alias("stretch"),
    ).agg(F.min("position").alias("position"))
    ids = found.drop("hits").dropDuplicates(["segment"])
    pairs = pairs.join(ids, "segment").join(own, "item_key")

    @F.pandas_udf("struct<start:int,end:int>")
    def verified(
        words: pd.Series, start: pd.Series, item: pd.Series, diagonal: pd.Series, position: pd.Series
    ) -> pd.DataFrame:
        rows, known = [], {}
        for w, s, text, d, p in zip(words, start, item, diagonal, position):
            if text not in known:
                known[text] = word_hashes(text)
            got = overlap(np.frombuffer(w, np.uint64), known[text], int(d - s), int(p - s))
            rows.append((None, None) if got is None else (got[0] + s, got[1] + s))
        return pd.DataFrame(rows, columns=["start", "end"]).astype("Int32")

    args = [F.col(c) for c in ("words", "start", "item", "diagonal", "position")]
    done = pairs.select("id", "text_hash", "item_id", verified(*args).alias("o"))
    done = done.select("id", "text_hash", "item_id", "o.start", "o.end").where("start is not null")
    return done.distinct()


def decontaminate(
    df: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row per row of ``df``: its id, contaminated (0 or 1), n_items (distinct test items that
    it overlaps) and items, "item:start:end" in words, by item and start.

    Words are runs of letters, digits and underscores, lower case. Null and empty texts are clean;
    so is everything beside an empty benchmark; null and empty items overlap nothing; repeated rows
    keep a row each, with equal results; other columns are ignored.
    """
    found = find_overlaps(df, benchmark, id_col, text_col, item_col, item_text_col)
    spans = F.array_sort(F.collect_set(F.struct("item_id", "start", "end")))
    joined = lambda s: F.concat_ws(":", s["item_id"], s["start"], s["end"])
    found = found.groupBy("id", "text_hash").agg(spans.alias("spans"))
    found = found.select(
        F.col("id").alias("i"),
        F.col("text_hash").alias("t"),
        F.size(F.array_distinct(F.transform("spans", lambda s: s["item_id"]))).alias("n_items"),
        F.array_join(F.transform("spans", joined), ",").alias("items"),
    )
    rows = df.select(F.col(id_col).alias("id"), F.xxhash64(text_of(text_col)).alias("text_hash"))
    rows = rows.join(
        found, F.col("id").eqNullSafe(F.col("i")) & (F.col("text_hash") == F.col("t")), "left"
    )
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n_items").isNotNull().cast("int").alias("contaminated"),
        F.coalesce(F.col("n_items").cast("long"), F.lit(0)).alias("n_items"),
        F.coalesce("items", F.lit("")).alias("items"),
    )


def clean_rows(
    df: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``df``, all columns unchanged, that overlap no test item."""
    row = F.struct("*")
    rows = df.select(row.alias("row"), F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    found = find_overlaps(rows, benchmark, "id", "text").select("id", "text_hash").distinct()
    found = checkpointed(found).select(F.col("id").alias("i"), F.col("text_hash").alias("t"))
    same = F.col("id").eqNullSafe(F.col("i")) & (F.xxhash64(text_of("text")) == F.col("t"))
    return rows.join(found, same, "left_anti").select("row.*")
