"""Comma text: one record per line, no quoting, no escapes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.integers import is_integer

LINE = "line"
ARITY = "arity"


def read_lines(spark: SparkSession, path: "str | list[str]") -> DataFrame:
    """One row per text line; uncompressed and bzip2 files are split across tasks."""
    return spark.read.text(path).withColumnRenamed("value", LINE)


def fields(
    lines: DataFrame, picked: dict[str, Column], keep_line: bool = False, arity: int | None = None
) -> DataFrame:
    """``arity`` and the picked expressions of every line; expressions refer to field(i). Given an
    ``arity``, nothing is worked out for lines of another one, and all of it is NULL there.

    The one-element inline is deliberate. With a plain select, later filters are pushed below it
    and every condition and every output column would split and convert the line again; through
    inline each line is split once and each field converted once.
    """
    split = lines.select(LINE, F.split(LINE, ",").alias("field"))
    struct = F.struct(F.size("field").alias(ARITY), *[c.alias(n) for n, c in picked.items()])
    if arity is not None:
        struct = F.when(F.size("field") == arity, struct)
    kept = [LINE] if keep_line else []
    return split.select(*kept, F.inline(F.array(struct)))


def field(position: int) -> Column:
    """Field of a split line; NULL, not an error, where the line is too short."""
    return F.get("field", F.lit(position))


def valid_lines(lines: DataFrame, arity: int, int_fields: Sequence[int] = ()) -> DataFrame:
    """Lines with exactly ``arity`` fields whose ``int_fields`` are all integers."""
    checks = {f"int_{i}": is_integer(field(i)) for i in int_fields}
    checked = fields(lines, checks, keep_line=True)
    valid = F.col(ARITY) == arity
    for name in checks:
        valid = valid & F.col(name)
    return checked.where(valid).select(LINE)
