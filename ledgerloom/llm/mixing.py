"""Mixing sources to target weights by Efraimidis-Spirakis keys and prefix-summed budgets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import WORD, checkpointed, text_of

WEIGHTS = (5, 2, 1)
REPEATS = 3


def quality(text: Column) -> Column:
    """Weight of a document: the share of its characters that are letters or spaces, 0.05 to 1."""
    length = F.length(text)
    plain = F.length(F.regexp_replace(text, r"[^\p{L}\x20\n]", ""))
    return F.greatest(F.lit(0.05), F.coalesce(F.try_divide(plain, length), F.lit(0.05)))


def uniform(*columns: Column) -> Column:
    """A number in (0, 1) that depends on the columns alone: reruns agree."""
    joined = F.concat_ws("|", *(F.coalesce(c.cast("string"), F.lit("")) for c in columns))
    head = F.conv(F.substring(F.md5(joined.cast("binary")), 1, 13), 16, 10).cast("long")
    return (head + 0.5) / F.lit(float(2**52))


def targets(sizes: DataFrame, weights=WEIGHTS, repeats: int = REPEATS) -> DataFrame:
    """Rows (source, source_size), one per source, with its target.

    Sources in code point order, null last, weigh ``weights`` in turn. A target stops at
    ``repeats`` times its source's size and the excess goes to the others by weight. In the order
    of cap per weight, a source is capped just if its share of what the capped ones before it left
    exceeds its cap, so prefix sums find the fixed point. One row per source is all that meets in
    one task.
    """
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*(F.lit(w).cast("long") for w in weights)), turn.cast("int") + 1)
    rows = sizes.withColumn("weight", weight).withColumn("cap", F.col("source_size") * repeats)
    everything = Window.partitionBy()
    ranked = Window.orderBy(
        F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source")
    ).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda name: F.coalesce(F.sum(name).over(ranked), F.lit(0))
    rows = rows.withColumns(
        {
            "left": F.sum("source_size").over(everything) - before("cap"),
            "heavy": F.sum("weight").over(everything) - before("weight"),
        }
    )
    rows = rows.withColumn("capped", F.col("weight") * F.col("left") > F.col("cap") * F.col("heavy"))
    share = lambda name: F.sum(F.when(F.col("capped"), F.col(name)).otherwise(0)).over(everything)
    rest = F.sum("source_size").over(everything) - share("cap")
    open_weight = F.sum("weight").over(everything) - share("weight")
    target = F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(
        F.try_divide((F.col("weight") * rest).cast("double"), open_weight.cast("double"))
    )
    return rows.select("source", "source_size", "weight", target.alias("target"))


def taken_words(keyed: DataFrame, goal: DataFrame) -> DataFrame:
    """Rows (key, source, doc_id, size, order) with the words that the mix takes from each.

    Complete epochs take every document; the rest of the budget takes documents in the order of
    their sampling keys until their prefix sum reaches it, the last one as far as the budget goes.
    The rows are dealt out by ranges of (source, order), so a large source spreads over many
    partitions; sums per range make the offsets of the prefix sums.
    """
    ranged = keyed.repartitionByRange("source", "order", "doc_id", "size")
    ranged = checkpointed(ranged.withColumn("part", F.spark_partition_id()))
    sums = ranged.groupBy("source", "part").agg(F.sum("size").alias("part_size"))
    earlier = Window.partitionBy("source").orderBy("part")
    earlier = earlier.rowsBetween(Window.unboundedPreceding, -1)
    offset = F.coalesce(F.sum("part_size").over(earlier), F.lit(0))
    offsets = sums.select(
        F.col("source").alias("s"), F.col("part").alias("p"), offset.alias("offset")
    )
    offsets = offsets.join(
        goal.select(F.col("source").alias("gs"), "source_size", "target"),
        F.col("s").eqNullSafe(F.col("gs")),
    ).drop("gs")
    within = Window.partitionBy("source", "part").orderBy("order", "doc_id", "size")
    within = within.rowsBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    rows = rows.join(
        offsets, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))
    )
    epochs = F.coalesce(F.floor(F.try_divide("target", "source_size")), F.lit(0))
    rest = F.floor(F.col("target") - epochs * F.col("source_size"))
    fraction = F.least(
        F.greatest(rest - F.col("offset") - F.col("inner"), F.lit(0)), F.col("size")
    )
    taken = (epochs * F.col("size") + fraction).cast("long")
    return rows.select("key", "doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """One row per row of ``df``: doc_id, size (words), source_size, target, taken.

    The sampling key of a document is -ln(u) / quality, u from a hash of its id and text; smaller
    keys come first. Null texts have size 0, a null source is a source of its own, the last; equal
    rows have equal keys, so it does not matter which of them the budget reaches first; a source
    without words has target 0; an empty table gives no rows. Only ids, sizes and keys are shuffled.
    """
    rows = df.select(
        F.col(id_col).alias("doc_id"),
        F.col(text_col).alias("text"),
        F.col(source_col).alias("source"),
        F.lit(0).alias("key"),
    )
    rows = checkpointed(keys(rows, "text", "source", "key"))
    return _mixed(rows, weights, repeats).select(
        F.col("doc_id").alias(id_col), "size", "source_size", "target", "taken"
    )


def keys(rows: DataFrame, text_col: str, source_col: str, key_col: str) -> DataFrame:
    """key, doc_id, source, size and order (the sampling key) of each row."""
    text = text_of(text_col)
    draw = uniform(F.col("doc_id"), text)
    return rows.select(
        F.col(key_col).alias("key"),
        "doc_id",
        F.col(source_col).alias("source"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"),
        (-F.log(draw) / quality(text)).alias("order"),
    )


def _mixed(rows: DataFrame, weights, repeats: int) -> DataFrame:
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = checkpointed(targets(sizes, weights, repeats))
    return taken_words(rows, goal)


def mixed_rows(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights=WEIGHTS,
    repeats: int = REPEATS,
) -> DataFrame:
    """The rows of ``df`` of which the mix takes words, whole in a column ``row``, with size,
    source_size, target and taken in a column ``mix``. Fully equal rows are collapsed for the
    join and written out again, each with its own share."""
    row = F.struct("*")
    rows = df.select(row.alias("row"), F.xxhash64(row).alias("key"), F.col(id_col).alias("doc_id"))
    own = keys(rows, f"row.{text_col}", f"row.{source_col}", "key")
    mixture = _mixed(checkpointed(own), weights, repeats).where("taken > 0")
    mixture = mixture.groupBy("key", "doc_id", "size", "source_size", "target", "taken").count()
    mixture = mixture.select(
        F.col("key").alias("k"), F.col("doc_id").alias("d"), "count",
        F.struct("size", "source_size", "target", "taken").alias("mix"),
    )
    distinct = rows.groupBy("key", "doc_id").agg(F.first("row").alias("row"))
    chosen = distinct.join(
        mixture, (F.col("key") == F.col("k")) & F.col("doc_id").eqNullSafe(F.col("d"))
    )
    each = F.explode(F.sequence(F.lit(1).cast("long"), F.col("count")))
    return chosen.select("row", "mix", each.alias("copy")).select("row", "mix")
