"""Plot-ready series of a saved result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.labels import relabel
from ledgerloom.operators.ordering import by_key


def sorted_series(pairs: DataFrame, commas: bool = False) -> DataFrame:
    """``label``, ``value`` of saved pairs in label order; ``commas`` writes the label with a
    comma for its slash."""
    label = relabel(F.col("key")) if commas else F.col("key")
    return by_key(pairs.select(label.alias("label"), "value"), "label")
