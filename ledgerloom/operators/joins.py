"""Joins of a large fact table with a list of keys.

The reports only need totals over the join. An inner join repeats a fact for every time its key is
listed; here the list is counted per key first, and that number is a factor of the fact's amount,
so repeated entries never multiply rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.integers import INTEGER
from ledgerloom.functions.labels import ratio
from ledgerloom.operators.buckets import BucketedRows, Rows
from ledgerloom.operators.grouping import known_sum

BROADCAST_SETTING = "spark.ledgerloom.broadcastBytes"
BROADCAST_BYTES = 64 * 1024 * 1024
ROW_OVERHEAD = 64

# A fact row meets at most this many rows of a broadcast list; beyond it facts are summed per key
# first.
DIRECT_LABELS = 8

# Parts that the facts of every key are dealt into where they meet a large list; each row of the list
# is sent to all of them. A key with a large share of the facts is that many sorts, not one.
SPREAD = 8


# A list that the planner estimates at more than this many times the limit is not measured at all.
UNMEASURED = 4

# The planner's estimate where it knows nothing is the largest 64-bit number, or near it.
UNKNOWN_ESTIMATE = 1 << 62


class ListSize(NamedTuple):
    """Bytes of a counted list, and the largest number of rows a key has in it."""

    bytes: int
    labels: int


def broadcast_limit(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get(BROADCAST_SETTING, str(BROADCAST_BYTES)))


def _width(columns: Sequence[str]) -> Column:
    width = F.lit(ROW_OVERHEAD).cast("bigint")
    for name in columns:
        width = width + F.coalesce(F.octet_length(F.col(name).cast("string")), F.lit(0))
    return width


def list_size(copies: DataFrame, key: str) -> ListSize:
    """Measures a counted list with one aggregate over its rows.

    The file size is no bound (compressed text, Parquet dictionaries), so rows and bytes are
    counted. One row of numbers comes back.
    """
    per_key = copies.groupBy(key).agg(
        F.sum(_width(copies.columns)).alias("bytes"), F.count("*").alias("labels")
    )
    size = per_key.agg(F.sum("bytes").alias("bytes"), F.max("labels").alias("labels")).first()
    return ListSize(size["bytes"] or 0, size["labels"] or 0)


def estimated_bytes(df: DataFrame) -> int | None:
    """The planner's estimate from file sizes, without a job; None where it has none. It is no
    bound: good enough to take the way that needs none."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return None if size >= UNKNOWN_ESTIMATE else size


def small_list(listed: DataFrame, key: str, list_keys: Sequence[str], limit: int) -> ListSize | None:
    """The size of the list, counted per ``key`` and ``list_keys``, if it is proven to be within
    ``limit``; otherwise None.

    By its files clearly too large: no job. Without labels the rows as they stand are a bound, which
    is one narrow aggregate; only if that is over the limit, or labels must be counted, the list
    is grouped.
    """
    if limit <= 0:
        return None
    estimate = estimated_bytes(listed)
    if estimate is not None and estimate > UNMEASURED * limit:
        return None
    if not list_keys:
        keys = listed.select(key)
        # 20 bytes more: the number of copies that the counted list carries.
        bound = keys.agg(F.sum(_width(keys.columns) + 20).alias("bytes")).first()["bytes"] or 0
        if bound <= limit:
            return ListSize(bound, 1)
    copies = listed.groupBy(key, *list_keys).agg(F.count("*").alias("copies"))
    size = list_size(copies, key)
    return size if size.bytes <= limit else None


def only_listed(df: DataFrame, listed: DataFrame, key: str) -> DataFrame:
    """Rows whose key is listed, each once; for frames already grouped by ``key``, which then need
    no further shuffle.

    An inner join with distinct keys: a semi join would be pushed below the grouping and shuffle
    the ungrouped rows.
    """
    keys = listed.select(key).distinct().hint("merge")
    return df.join(keys, key, "inner")


def matched_totals(
    facts: Rows,
    listed: DataFrame,
    key: str,
    amount: str,
    fact_keys: Sequence[str] = (),
    list_keys: Sequence[str] = (),
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """``total`` and ``n`` of the inner join on ``key``, grouped by ``fact_keys`` + ``list_keys``.

    Four exact ways, chosen by the size of the counted list; in each, only sums of listed keys can
    exceed 38 digits and raise:

    * small, few labels per key: the counted list is broadcast and facts go from the scan straight
      into the partial sums of the result; no fact row is shuffled;
    * small, some key with many labels: the keys are broadcast to drop unlisted facts, and facts
      are summed per key before they meet the labels;
    * large, without labels: facts are shuffled once, by key and one of SPREAD parts, meet the one row
      of their key there, and go into the partial sums of the result;
    * large, with labels: facts are summed per key first, so a key with a large share of the facts
      and of the labels is a handful of rows by the time of the sorted join.

    The hint keeps the planner from a broadcast on its estimate in the large ways. Facts in buckets
    of ``key`` are not shuffled in the large ways either.
    """
    limit = broadcast_limit(listed) if broadcast_bytes is None else broadcast_bytes
    size = small_list(listed, key, list_keys, limit)
    if isinstance(facts, BucketedRows):
        if size is None and facts.key == key:
            return _bucketed_totals(facts, listed, amount, fact_keys, list_keys)
        facts = facts.all()
    amounts = _amounts(facts, key, amount, fact_keys)
    if size is None and not list_keys:
        return _spread_totals(amounts, listed, key, fact_keys)
    copies = listed.groupBy(key, *list_keys).agg(F.count("*").alias("copies"))
    copies = F.broadcast(copies) if size is not None else copies.hint("merge")
    direct = size is not None and size.labels <= DIRECT_LABELS
    if not direct:
        if size is not None:
            amounts = amounts.join(F.broadcast(copies.select(key)), key, "left_semi")
        amounts = _summed(amounts, key, fact_keys)
    return _joined_totals(amounts, copies, key, [*fact_keys, *list_keys], summed=not direct)


def _amounts(facts: DataFrame, key: str, amount: str, fact_keys: Sequence[str]) -> DataFrame:
    whole = F.col(amount).cast(INTEGER).alias("sum_amount")
    return facts.select(key, *fact_keys, whole)


def _partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def spread(amounts: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """Facts shuffled by key and ``sum_part``. A fact's part follows from its task and its values, so
    neither a key that one task holds nor one with equal facts stays whole."""
    dealt = F.xxhash64(F.spark_partition_id(), *values)
    amounts = amounts.withColumn("sum_part", F.pmod(dealt, F.lit(SPREAD)).cast("int"))
    return amounts.repartition(_partitions(amounts), key, "sum_part")


def _spread_totals(
    amounts: DataFrame, listed: DataFrame, key: str, fact_keys: Sequence[str]
) -> DataFrame:
    """A large list without labels meets the facts in parts of their keys.

    The list's parts are shuffled before they are counted: ahead of the shuffle the counts of all
    parts would fill a task's memory and merge next to nothing. Adaptive execution doesn't split
    a key here, as the list is counted between its exchange and the join; nor may it put partitions
    together, as it goes by packed bytes, and equal keys pack to a tenth of what a sort takes.
    """
    amounts = spread(amounts, key, [*fact_keys, "sum_amount"])
    parts = F.explode(F.array(*[F.lit(i) for i in range(SPREAD)])).alias("sum_part")
    dealt = listed.select(key, parts).repartition(_partitions(listed), key, "sum_part")
    copies = dealt.groupBy(key, "sum_part").agg(F.count("*").alias("copies"))
    return _joined_totals(amounts, copies.hint("merge"), [key, "sum_part"], fact_keys, summed=False)


def _summed(amounts: DataFrame, key: str, fact_keys: Sequence[str]) -> DataFrame:
    # try_sum: the sum of a key that nobody listed must not decide whether the job succeeds.
    return amounts.groupBy(key, *fact_keys).agg(
        F.try_sum("sum_amount").alias("sum_amount"), F.count("*").alias("sum_rows")
    )


def _bucketed_totals(
    facts: BucketedRows,
    listed: DataFrame,
    amount: str,
    fact_keys: Sequence[str],
    list_keys: Sequence[str],
) -> DataFrame:
    """A large list against facts in buckets: only the list is shuffled, to the buckets.

    Rows of hot keys meet the list's rows of these keys. Without labels these are fewer than there
    are buckets, and are broadcast; with labels the hot rows are summed first.
    """
    key, keys = facts.key, [*fact_keys, *list_keys]
    copies = listed.groupBy(key, *list_keys).agg(F.count("*").alias("copies"))
    cold = _amounts(facts.buckets, key, amount, fact_keys)
    hot = _amounts(facts.hot, key, amount, fact_keys)
    hot_copies = copies.join(F.broadcast(facts.hot_keys), key, "left_semi")
    if list_keys:  # sums of a key are within its bucket
        cold, hot = _summed(cold, key, fact_keys), _summed(hot, key, fact_keys)
        hot_copies = hot_copies.hint("merge")
    else:
        hot_copies = F.broadcast(hot_copies)
    parts = [
        _joined_totals(cold, copies.hint("merge"), key, keys, summed=bool(list_keys)),
        _joined_totals(hot, hot_copies, key, keys, summed=bool(list_keys)),
    ]
    both = parts[0].unionByName(parts[1]).groupBy(*keys)
    return both.agg(F.sum("total").cast(INTEGER).alias("total"), F.sum("n").alias("n"))


def _joined_totals(
    amounts: DataFrame, copies: DataFrame, on: str | list[str], keys: Sequence[str], summed: bool
) -> DataFrame:
    # Most keys are listed once; the test spares their rows a decimal multiplication.
    once = F.col("copies") == 1
    amount = known_sum(F.col("sum_amount")) if summed else F.col("sum_amount")
    repeated = (amount * F.col("copies")).cast(INTEGER)
    rows = F.col("sum_rows") * F.col("copies") if summed else F.col("copies")
    return amounts.join(copies, on, "inner").groupBy(*keys).agg(
        F.sum(F.when(once, amount).otherwise(repeated)).alias("total"),
        F.sum(rows).alias("n"),
    )


def matched_sums(
    sums: DataFrame,
    listed: DataFrame,
    key: str,
    amount: str,
    rows: str,
    fact_keys: Sequence[str] = (),
    list_keys: Sequence[str] = (),
    broadcast_bytes: int | None = None,
) -> DataFrame:
    """``matched_totals`` of facts that are already summed per ``key`` and ``fact_keys``: ``amount``
    is their sum, NULL where it went beyond 38 digits, and ``rows`` their number."""
    limit = broadcast_limit(listed) if broadcast_bytes is None else broadcast_bytes
    size = small_list(listed, key, list_keys, limit)
    copies = listed.groupBy(key, *list_keys).agg(F.count("*").alias("copies"))
    copies = F.broadcast(copies) if size is not None else copies.hint("merge")
    amounts = sums.select(
        key, *fact_keys, F.col(amount).alias("sum_amount"), F.col(rows).alias("sum_rows")
    )
    return _joined_totals(amounts, copies, key, [*fact_keys, *list_keys], summed=True)


def ratio_join(totals: DataFrame, counts: DataFrame, key: str, name: str = "average") -> DataFrame:
    """Average from a frame of totals and a frame of counts of the same keys."""
    return totals.join(counts, key, "inner").select(
        key, ratio(F.col("total"), F.col("n")).alias(name)
    )
