"""The four ledger tables: positions and kinds of the fields that are read.

A typed table holds the lines of the right arity. A malformed integer is NULL there, so one typed
copy serves every query: each asks for its own columns, and rows with a NULL among them are
exactly the lines it would have dropped.

An integer that is well formed but too long for its type is a third state: it keeps its line where it
is only checked and raises where it is used, as in the text. It is NULL too, and the partition
column ``beyond`` of the typed table names such columns of a row. Nearly all rows are in the
partition without any, so a query reads that one as if there were no other.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.functions.integers import fitting, is_integer, to_epoch, to_integer
from ledgerloom.operators.buckets import BucketedRows, Rows, all_rows
from ledgerloom.sources.lines import ARITY, LINE, field, fields

TEXT, INTEGER, EPOCH = "text", "integer", "epoch"


@dataclass(frozen=True)
class Table:
    name: str
    arity: int
    fields: dict[str, tuple[int, str]]

    @property
    def columns(self) -> list[str]:
        return list(self.fields)

    def integers(self, columns: Sequence[str]) -> list[str]:
        return [c for c in columns if self.fields[c][1] != TEXT]


# Fields per line, and position and kind of each field that is read.
TRANSACTIONS = Table(
    "transactions",
    15,
    {
        "c3": (3, INTEGER),
        "address": (6, TEXT),
        "value": (7, INTEGER),
        "gas_used": (8, INTEGER),
        "gas_price": (9, INTEGER),
        "ts": (11, EPOCH),
    },
)
CONTRACTS = Table("contracts", 6, {"address": (0, TEXT), "byte": (1, TEXT)})
SCAMS = Table("scams", 8, {"id": (0, INTEGER), "category": (4, TEXT), "address": (6, TEXT)})
BLOCKS = Table("blocks", 19, {"miner": (9, TEXT), "size": (12, INTEGER)})

_READERS = {TEXT: lambda text: text, INTEGER: to_integer, EPOCH: to_epoch}
_TYPES = {TEXT: "string", INTEGER: "decimal(38,0)", EPOCH: "bigint"}

# Partition column of a typed table, its value where every integer fits, and what joins the names of
# the columns that don't.
BEYOND, WITHIN, AND = "beyond", "none", "-"

WRITERS_SETTING = "spark.sql.maxConcurrentOutputFileWriters"


def parse(
    lines: DataFrame,
    table: Table,
    columns: Sequence[str] | None = None,
    checked: Sequence[str] = (),
) -> DataFrame:
    """Typed rows of the lines with the right arity; NULL for a malformed integer.

    Only ``columns`` are converted, so ask for what the query uses. The ``checked`` columns come as
    true or NULL: their text is matched, not converted.
    """
    wanted = {name: table.fields[name] for name in columns or table.columns}
    picked = {name: _READERS[kind](field(i)) for name, (i, kind) in wanted.items()}
    for name in checked:
        picked[name] = F.when(is_integer(field(table.fields[name][0])), True)
    rows = fields(lines, picked, arity=table.arity)
    return rows.where(F.col(ARITY) == table.arity).select(*picked)


def parse_flagged(
    lines: DataFrame, table: Table, columns: Sequence[str] | None = None
) -> DataFrame:
    """As ``parse``, but an integer too long for its type is NULL as well; for each integer, the column
    ``<name>_form`` says whether the text is one, of any length."""
    wanted = {name: table.fields[name] for name in columns or table.columns}
    picked = {}
    for name, (i, kind) in wanted.items():
        picked[name] = field(i) if kind == TEXT else fitting(field(i), _TYPES[kind])
        if kind != TEXT:
            picked[f"{name}_form"] = is_integer(field(i))
    rows = fields(lines, picked, arity=table.arity)
    return rows.where(F.col(ARITY) == table.arity).drop(ARITY)


def parse_tolerant(
    lines: DataFrame, table: Table, columns: Sequence[str] | None = None
) -> DataFrame:
    """As ``parse``, but an integer too long for its type is NULL as well, and named in ``beyond``."""
    wanted = list(columns or table.columns)
    rows = parse_flagged(lines, table, wanted)
    long = [F.when(F.col(f"{c}_form") & F.col(c).isNull(), c) for c in table.integers(wanted)]
    named = F.concat_ws(AND, *long)
    beyond = F.when(named == "", WITHIN).otherwise(named)
    return rows.select(*wanted, beyond.alias(BEYOND))


def flagged(source: Rows, table: Table, columns: Sequence[str]) -> DataFrame:
    """The columns and their ``_form`` flags (see ``parse_flagged``) from lines or a typed table."""
    source = all_rows(source)
    if source.columns == [LINE]:
        return parse_flagged(source, table, columns)
    long = BEYOND in source.columns
    form = lambda c: F.col(c).isNotNull() | is_beyond(c) if long else F.col(c).isNotNull()
    return source.select(*columns, *(form(c).alias(f"{c}_form") for c in table.integers(columns)))


def is_beyond(name: str) -> Column:
    """Whether the row's integer of that name is well formed and too long for its type."""
    return F.array_contains(F.split(F.col(BEYOND), AND), name)


def pick(source: Rows, table: Table, *columns: str, checked: Sequence[str] = ()) -> Rows:
    """The named columns of the rows whose named and ``checked`` integers are all valid.

    ``source`` is either raw lines or a typed table; for the latter both the column choice and
    the NULL test reach the Parquet scan. Of a bucketed copy, both kinds of rows are picked.
    """
    if isinstance(source, BucketedRows):
        return source.each(lambda rows: pick(rows, table, *columns, checked=checked))
    if source.columns == [LINE]:
        rows = parse(source, table, columns, checked)
    elif BEYOND in source.columns:
        within = source.where(F.col(BEYOND) == WITHIN).drop(BEYOND)
        long = source.where(F.col(BEYOND) != WITHIN)
        return pick(within, table, *columns, checked=checked).unionByName(
            _pick_long(long, table, columns, checked)
        )
    else:
        rows = source.select(*columns, *checked)
    for name in [*table.integers(columns), *checked]:
        rows = rows.where(F.col(name).isNotNull())
    return rows.select(*columns)


def _pick_long(
    rows: DataFrame, table: Table, columns: Sequence[str], checked: Sequence[str]
) -> DataFrame:
    used = table.integers(columns)
    for name in [*used, *checked]:
        rows = rows.where(F.col(name).isNotNull() | is_beyond(name))
    too_long = F.raise_error(F.lit("NUMERIC_VALUE_OUT_OF_RANGE: a used integer is too long for its type"))
    # coalesce: the error stands where the value would, and is not evaluated elsewhere.
    value = lambda name: F.coalesce(F.col(name), too_long.cast(_TYPES[table.fields[name][1]]))
    return rows.select(*[value(c).alias(c) if c in used else F.col(c) for c in columns])


@contextmanager
def wide_writers(spark: SparkSession, table: Table) -> Iterator[None]:
    """Within it a task writes the partitions of ``beyond`` side by side, in as many open files as
    there can be, instead of sorting its rows by them."""
    before = spark.conf.get(WRITERS_SETTING)
    spark.conf.set(WRITERS_SETTING, str(1 + 2 ** len(table.integers(table.columns))))
    try:
        yield
    finally:
        spark.conf.set(WRITERS_SETTING, before)


def save_table(lines: DataFrame, table: Table, path: str, replace: bool = False) -> None:
    """Converts raw lines once to typed Parquet, for runs that ask several questions. An integer too
    long for its type takes nothing from the line's other columns; see ``beyond`` above. A copy
    that is there raises, or with ``replace`` makes way."""
    mode = "overwrite" if replace else "error"
    with wide_writers(lines.sparkSession, table):
        parse_tolerant(lines, table).write.mode(mode).partitionBy(BEYOND).parquet(path)


def schema_of(table: Table) -> str:
    return ", ".join(f"{c} {_TYPES[kind]}" for c, (_, kind) in table.fields.items())


def load_table(spark: SparkSession, table: Table, path: str) -> DataFrame:
    """The typed table at ``path``; with the column ``beyond`` only if some integer is too long."""
    rows = spark.read.schema(f"{schema_of(table)}, {BEYOND} string").parquet(path)
    return rows if _has_long(spark, path) else rows.select(*table.columns)


def _has_long(spark: SparkSession, path: str) -> bool:
    """Whether the table has a partition of rows with a long integer: a listing of one folder."""
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/{BEYOND}=*")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    return any(f.getPath().getName() != f"{BEYOND}={WITHIN}" for f in files.globStatus(pattern) or [])
