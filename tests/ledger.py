"""Hand-written lines and plain-Python totals over them."""

from __future__ import annotations

from collections import Counter, defaultdict
from datetime import datetime, timezone


def tx(address="0xa", value="1", gas="1", price="1", ts="1438387199", c3="1", extra=0):
    record = ["f"] * (15 + extra)
    for position, text in ((3, c3), (6, address), (7, value), (8, gas), (9, price), (11, ts)):
        record[position] = text
    return ",".join(record)


def contract(address="0xa", byte="0x"):
    return f"{address},{byte},,f,f,0"


def scam(ident="1", category="Phishing", address="0xa"):
    return f"{ident},n,u,c,{category},s,{address},x"


def block(miner="m", size="1"):
    return ",".join([*"012345678", miner, "10", "11", size, *"345678"])


def month(ts: int, pattern: str) -> str:
    return datetime.fromtimestamp(ts, timezone.utc).strftime(pattern)


def joined(transactions, listed):
    """Pairs of an inner join on address, one by one; for small inputs only."""
    by_address = defaultdict(list)
    for entry in listed:
        by_address[entry["address"]].append(entry)
    return [(t, entry) for t in transactions for entry in by_address[t["address"]]]


def sums(pairs) -> dict:
    totals = Counter()
    for key, amount in pairs:
        totals[key] += amount
    return dict(totals)


def averages(pairs) -> dict:
    pairs = list(pairs)
    counts = Counter(key for key, _ in pairs)
    return {key: total / counts[key] for key, total in sums(pairs).items()}


def largest(totals: dict, k: int) -> list[tuple]:
    return sorted(totals.items(), key=lambda item: (-item[1], item[0]))[:k]
