"""Reading exports and saved results, writing results."""

from ledgerloom.sources.bucketed import load_bucketed, save_bucketed
from ledgerloom.sources.lines import fields, read_lines, valid_lines
from ledgerloom.sources.object_store import s3a_options
from ledgerloom.sources.results import read_pairs, write_result
from ledgerloom.sources.tables import (
    BLOCKS,
    CONTRACTS,
    SCAMS,
    TRANSACTIONS,
    load_table,
    parse,
    pick,
    save_table,
)

__all__ = [
    "BLOCKS",
    "CONTRACTS",
    "SCAMS",
    "TRANSACTIONS",
    "fields",
    "load_bucketed",
    "load_table",
    "parse",
    "pick",
    "read_lines",
    "read_pairs",
    "s3a_options",
    "save_bucketed",
    "save_table",
    "valid_lines",
    "write_result",
]
