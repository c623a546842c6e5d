"""Personal data: patterns propose spans, checksums confirm them, context words move the score.

Native: everything below is one projection of built-in functions, without a shuffle or Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.llm.common import text_of

#: The patterns. Possessive repeats match the same spans as greedy ones here, since
#: what follows a repeat never begins with what it repeats, and they neither backtrack nor recurse
#: on very long runs. A lookbehind (or the end of the match before) keeps a failing run from being
#: tried again at each of its characters.
EMAIL = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
)
IP = r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IBAN = r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?\b"
SSN = r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b"
OCTETS = r"^0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}$"

#: Kind, pattern, score with its check passed, words that raise it by CONTEXT when
#: one stands within REACH characters before the span. Spans below LEAST are dropped; the scores of
#: the first four kinds start above it, so only their own checks drop them.
BASE = ("email", "ip", "card", "phone")
KINDS = {
    "email": (EMAIL, 0.8, r"e-?mail|contact|mailto|write to"),
    "ip": (IP, 0.6, r"\bip\b|address|host|server|login"),
    "card": (CARD, 0.7, r"card|visa|credit|debit|payment"),
    "phone": (PHONE, 0.6, r"phone|tel\b|mobile|call|fax"),
    "iban": (IBAN, 0.9, r"iban|account|bank"),
    "ssn": (SSN, 0.3, r"ssn|social security|tax id"),
}
CONTEXT, REACH, LEAST = 0.2, 40, 0.5


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    """12 to 19 digits whose Luhn sum is a multiple of ten."""
    own = F.reverse(_digits(match))
    twice = F.translate(own, "0123456789", "0246813579")
    places = F.sequence(F.lit(1), F.lit(19))
    total = F.aggregate(
        places,
        F.lit(0),
        lambda s, i: s
        + F.coalesce(
            F.when(i % 2 == 1, own.substr(i, F.lit(1)))
            .otherwise(twice.substr(i, F.lit(1)))
            .try_cast("int"),
            F.lit(0),
        ),
    )
    return F.length(own).between(12, 19) & (total % 10 == 0)


def _mod97(match: Column) -> Column:
    """15 to 34 characters that leave 1 modulo 97, letters as 10 to 35, first four moved last."""
    own = F.regexp_replace(match, r"\x20", "")
    turned = F.concat(F.substring(own, 5, 40), F.substring(own, 1, 4))
    code = lambda c: F.ascii(c) - F.when(c >= "A", 55).otherwise(48)
    left = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.length(turned)), lambda i: turned.substr(i, F.lit(1))),
        F.lit(0),
        lambda r, c: (r * F.when(c >= "A", 100).otherwise(10) + code(c)) % 97,
    )
    return F.length(own).between(15, 34) & (left == 1)


CHECKS = {
    "email": lambda m: F.lit(True),
    "ip": lambda m: m.rlike(OCTETS),
    "card": _luhn,
    "phone": lambda m: F.length(_digits(m)).between(9, 15),
    "iban": _mod97,
    "ssn": lambda m: ~m.rlike("^(?:000|666|9..)-|-00-|-0000$"),
}
#: What a text must have for a pattern to match at all; spares most texts the pattern.
NEEDS = {"email": "@", "ip": ".", "phone": "+", "ssn": "-"}
SPAN = "array<struct<start:int,rank:int,kind:string,end:int,score:double>>"
PAIRS = "array<struct<gap:string,match:string>>"
#: Matches that are walked together; not below REACH.
BLOCK = 128


def _pairs(text: Column, kind: str) -> Column:
    """The matches of a kind, in blocks, each with the piece of text between it and the one before."""
    pattern = KINDS[kind][0]
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.slice(F.split(text, pattern, -1), 1, F.size(matches))
    pairs = F.arrays_zip(gaps.alias("gap"), matches.alias("match"))
    # The pattern runs over each text once more for the gaps, so only where it matches at all.
    has = text.rlike(pattern)
    if kind in NEEDS:
        has = F.contains(text, F.lit(NEEDS[kind])) & has
    return F.when(has, pairs).otherwise(F.array().cast(PAIRS))


def _blocks(pairs: Column) -> Column:
    numbers = F.sequence(F.lit(0), F.floor((F.size(pairs) - 1) / BLOCK).cast("int"))
    cut = F.transform(numbers, lambda i: F.slice(pairs, i * BLOCK + 1, BLOCK))
    return F.when(F.size(pairs) > 0, cut).otherwise(F.array().cast(f"array<{PAIRS}>"))


def _lengths(blocks: Column) -> Column:
    """Characters of each block."""
    length = lambda p: F.length(p["gap"]) + F.length(p["match"])
    return F.transform(blocks, lambda b: F.aggregate(b, F.lit(0), lambda n, p: n + length(p)))


def _tail(*parts: Column) -> Column:
    return F.right(F.concat(*parts), F.lit(REACH))


def _spans(blocks: Column, lengths: Column, rank: int, kind: str) -> Column:
    """Spans of one kind, out of its matches in blocks.

    A walk over a block adds up lengths and keeps the last REACH characters before each match, so
    nothing is counted from the text's start. Blocks bound the walk, as an array is copied for each
    element it grows by; a block takes its start from the lengths of those before it.
    """
    _, base, near = KINDS[kind]

    def walk(state: Column, pair: Column) -> Column:
        start = state["end"] + F.length(pair["gap"])
        end = start + F.length(pair["match"])
        before = _tail(state["tail"], pair["gap"])
        score = F.lit(base) + F.when(before.rlike(f"(?i){near}"), CONTEXT).otherwise(0.0)
        found = F.array(
            F.struct(
                start.alias("start"), F.lit(rank).alias("rank"), F.lit(kind).alias("kind"),
                end.alias("end"), score.alias("score"),
            )
        ).cast(SPAN)
        good = CHECKS[kind](pair["match"]) & (score >= LEAST)
        kept = F.concat(state["spans"], F.when(good, found).otherwise(F.array().cast(SPAN)))
        tail = _tail(before, pair["match"])
        return F.struct(end.alias("end"), tail.alias("tail"), kept.alias("spans"))

    def of_block(block: Column, number: Column) -> Column:
        end = F.aggregate(F.slice(lengths, 1, number), F.lit(0), lambda n, x: n + x)
        # No match is empty, so the last REACH pairs of the block before hold all that is needed.
        last = F.slice(F.get(blocks, F.greatest(number - 1, F.lit(0))), BLOCK - REACH + 1, REACH)
        tail = F.aggregate(last, F.lit(""), lambda t, p: _tail(t, p["gap"], p["match"]))
        first = F.struct(
            end.alias("end"), F.when(number > 0, tail).otherwise("").alias("tail"),
            F.array().cast(SPAN).alias("spans"),
        )
        return F.aggregate(block, first, walk)["spans"]

    return F.flatten(F.transform(blocks, of_block))


def _joined(spans: Column, *more: str) -> Column:
    parts = lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"], *(s[m] for m in more))
    return F.array_join(F.transform(spans, parts), ",")


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its id and ``pii``, an array of spans (start, rank, kind, end,
    score) by start, then kind. Offsets are code points, the end is exclusive.

    Spans of one kind are leftmost and never overlap; a match that fails its check is dropped and
    not tried again. Null texts count as empty; repeated rows and null ids keep a row each; other
    columns are ignored. A text of any length is one row of one task; work grows in proportion to
    the text and its matches, and no row meets another.
    """
    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    # Step by step: each column is used more than once, and worked out once.
    rows = rows.select("id", *(_pairs(F.col("text"), k).alias(k) for k in KINDS))
    rows = rows.select("id", *(_blocks(F.col(k)).alias(k) for k in KINDS))
    rows = rows.select("id", *KINDS, *(_lengths(F.col(k)).alias(f"{k}_lengths") for k in KINDS))
    each = [_spans(F.col(k), F.col(f"{k}_lengths"), i, k) for i, k in enumerate(KINDS)]
    return rows.select(F.col("id").alias(id_col), F.array_sort(F.concat(*each)).alias("pii"))


def digest(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, hash and spans of ``find_pii`` in the form of the registered query."""
    pii = F.col("pii")
    count = lambda kind: F.size(F.filter(pii, lambda s: s["kind"] == kind)).cast("long")
    base = F.filter(pii, lambda s: s["rank"] < len(BASE))
    return df.select(
        id_col,
        *(count(kind).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_joined(base).cast("binary"), 256).alias("base_sha256"),
        _joined(pii).alias("spans"),
        *(count(kind).alias(f"n_{kind}") for kind in KINDS if kind not in BASE),
        F.array_join(
            F.transform(pii, lambda s: F.format_number(s["score"], 2)), ","
        ).alias("scores"),
    )
