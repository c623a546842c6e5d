"""Month labels of epoch seconds, and the small expressions on grouped results."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The three label formats (month and full year, the same with a slash, month and
# two-digit year).
MONTH_YEAR = "MM y"
MONTH_SLASH_YEAR = "MM/y"
MONTH_SHORT_YEAR = "MM yy"

SECONDS_PER_DAY = 86400


def month_start(epoch: Column) -> Column:
    """First day of the UTC month an epoch second lies in: the key to group rows by.

    Goes through the UTC date, so it does not depend on the session time zone. Seconds that a date
    cannot hold raise.
    """
    day = F.floor(epoch / SECONDS_PER_DAY).cast("int")
    return F.trunc(F.date_from_unix_date(day), "MM")


def start_label(start: Column, pattern: str) -> Column:
    """Label of a month; formatting is dear, so only grouped rows get one."""
    return F.date_format(start, pattern)


def month_label(epoch: Column, pattern: str) -> Column:
    """Label of the UTC month an epoch second lies in."""
    return start_label(month_start(epoch), pattern)


def ratio(total: Column, count: Column) -> Column:
    return total.cast("double") / count.cast("double")


def relabel(label: Column) -> Column:
    return F.translate(label, "/", ",")
