"""Column expressions; everything here is built from pyspark.sql.functions."""

from ledgerloom.functions.integers import fitting, is_integer, to_epoch, to_integer
from ledgerloom.functions.labels import month_label, ratio, relabel

__all__ = ["fitting", "is_integer", "month_label", "ratio", "relabel", "to_epoch", "to_integer"]
