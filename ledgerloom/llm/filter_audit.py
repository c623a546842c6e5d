"""Filter interaction audit: five filters, all 120 orders, by difference arrays over Lehmer ranks."""

from __future__ import annotations

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, checkpointed, text_of

FILTERS = "ABCDE"
#: Least words; distinct words and capitals in percent; characters of filter D.
MIN_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT, MARKS = 200, 50, 3, "[#$%&*|]"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("removed", "good_lost", "toxic_lost")


def lehmer_rank(prefix: str, letters: str = FILTERS) -> int:
    """Rank of the first permutation, in lexicographic order, that starts with ``prefix``."""
    left, rank = list(letters), 0
    for letter in prefix:
        rank += left.index(letter) * factorial(len(left) - 1)
        left.remove(letter)
    return rank


def removal_intervals(mask: int, letters: str = FILTERS) -> list[tuple[int, int, int]]:
    """(step, start, end) of the ranks whose order removes a document with these failures at that
    step.

    A document is removed at step s by every order that starts with s - 1 filters it passes and one
    it fails. Orders with a common start are neighbours in lexicographic order.
    """
    fails = [c for i, c in enumerate(letters) if mask >> i & 1]
    passes = [c for c in letters if c not in fails]
    found = []
    for before in range(len(passes) + 1 if fails else 0):
        width = factorial(len(letters) - before - 1)
        for start in permutations(passes, before):
            for last in fails:
                low = lehmer_rank("".join(start) + last, letters)
                found.append((before + 1, low, low + width))
    return found


def failure_mask(text: Column) -> Column:
    """Filters A to D that a text fails, as bits 1, 2, 4, 8."""
    words = F.regexp_extract_all(text, F.lit(f"({WORD})"), F.lit(1))
    counted = F.struct(
        F.size(words).alias("all"), F.size(F.array_distinct(words)).alias("distinct")
    )
    few = lambda c: c["all"] < MIN_WORDS
    repeated = lambda c: 100 * c["distinct"] < DISTINCT_PERCENT * c["all"]
    length = F.length(text)
    capitals = length - F.length(F.translate(text, CAPITALS, ""))
    bit = lambda test, value: F.when(test, value).otherwise(0)
    # Through a one-element transform the words are split once.
    ab = F.transform(F.array(counted), lambda c: bit(few(c), 1) + bit(repeated(c), 2))[0]
    long = lambda c: c.cast("long")
    return (
        ab
        + bit(100 * long(capitals) > CAPITAL_PERCENT * long(length), 4)
        + bit(text.rlike(MARKS), 8)
    )


def mask_counts(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """part, mask (bit i: fails filter i), n, good, toxic: documents per set of failures.

    Only an id, a hash and the bits of a document are shuffled. The least id of each text is an
    aggregate with partial sums, and rows find it by text and id together, so that no task gets a
    text of many rows.
    """
    text = text_of(text_col)
    rows = checkpointed(
        documents.select(
            F.col(id_col).alias("id"),
            F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
            failure_mask(text).alias("own"),
            F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"),
        )
    )
    first = rows.groupBy("same").agg(F.min("id").alias("least"))
    first = first.select(F.col("same").alias("again"), "least")
    marked = labels.groupBy(F.col(id_col).alias("labelled")).agg(
        F.max(F.when(F.col("quality") == 1, 1).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1).otherwise(0)).alias("toxic"),
    )
    found = (F.col("same") == F.col("again")) & (F.col("id") == F.col("least"))
    rows = rows.join(first, found, "left")
    later = F.when(F.col("id").isNotNull() & F.col("least").isNull(), 1 << FILTERS.index("E")).otherwise(0)
    rows = rows.select("id", "part", (F.col("own") + later).alias("mask"))
    rows = rows.join(marked, F.col("id") == F.col("labelled"), "left")
    return rows.groupBy("part", "mask").agg(
        F.count("*").alias("n"),
        F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
        F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
    )


def _fixed_tables(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    """The interval ends of all masks (mask, step, rank, sign), and the letters of all orders
    (filter_order, rank, step, letter): constants of the five filters."""
    ends = [
        (mask, step, rank, sign)
        for mask in range(1 << len(FILTERS))
        for step, low, high in removal_intervals(mask)
        for rank, sign in ((low, 1), (high, -1))
    ]
    orders = [
        ("".join(order), lehmer_rank("".join(order)), step + 1, letter)
        for order in permutations(FILTERS)
        for step, letter in enumerate(order)
    ]
    return (
        spark.createDataFrame(ends, "mask int, step int, rank int, sign int"),
        spark.createDataFrame(orders, "filter_order string, rank int, step int, letter string"),
    )


def filter_audit(
    documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    part_col: str = "lang",
) -> DataFrame:
    """One row per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost,
    toxic_lost, shapley.

    Each set of failures adds its counts at the ends of the rank intervals that remove it at a step;
    a prefix sum over the 120 ranks gives every order at once, so the documents are read once and
    only a few counts per part remain after the first aggregate.

    A null text is empty, a null part the empty one. E compares texts by SHA-256; a row with a null
    id neither fails E nor makes another fail it, and rows with equal ids don't make each other
    fail. Repeated rows count each. A document with several label rows is good or toxic if one says
    so; without one, or with a null id, it is neither. An empty table gives no rows. Other columns
    are ignored. Texts are read whole.
    """
    counts = checkpointed(mask_counts(documents, labels, id_col, text_col, part_col))
    ends, orders = (F.broadcast(t) for t in _fixed_tables(documents.sparkSession))

    # Differences, then running sums over the ranks of each part and step.
    amount = dict(zip(MEASURES, ("n", "good", "toxic")))
    deltas = counts.join(ends, "mask").groupBy("part", "step", "rank").agg(
        *(F.sum(F.col(c) * F.col("sign")).alias(m) for m, c in amount.items())
    )
    fails = lambda letter: F.col("mask").bitwiseAND(F.lit(1 << FILTERS.index(letter))) != 0
    totals = counts.groupBy("part").agg(
        F.sum("n").alias("total"),
        F.create_map(*(
            x for c in FILTERS for x in (F.lit(c), F.sum(F.when(fails(c), F.col("n")).otherwise(0)))
        )).alias("failing"),
        F.create_map(*(
            x for i, c in enumerate(FILTERS)
            for x in (F.lit(c), F.sum(F.when(F.col("mask") == 1 << i, F.col("n")).otherwise(0)))
        )).alias("only"),
    )
    numbers = lambda first, last: F.explode(F.sequence(F.lit(first), F.lit(last)))
    grid = totals.withColumn("rank", numbers(0, 119)).withColumn("step", numbers(1, 5))
    grid = grid.join(orders, ["rank", "step"])
    grid = grid.join(deltas, ["part", "step", "rank"], "left")
    ranks = Window.partitionBy("part", "step").orderBy("rank")
    for m in MEASURES:
        grid = grid.withColumn(m, F.sum(F.coalesce(m, F.lit(0))).over(ranks))
    steps = Window.partitionBy("part", "rank").orderBy("step")
    each = Window.partitionBy("part", "letter")
    long = lambda c, name: c.cast("long").alias(name)
    return grid.select(
        "part",
        "filter_order",
        "step",
        long(F.col("total") - F.sum("removed").over(steps), "kept"),
        long(F.col("removed"), "removed"),
        long(F.col("failing")[F.col("letter")] - F.col("removed"), "redundant"),
        long(F.col("only")[F.col("letter")], "unique_fails"),
        long(F.col("good_lost"), "good_lost"),
        long(F.col("toxic_lost"), "toxic_lost"),
        long(F.sum("removed").over(each), "shapley"),
    )
