"""Substring dedup: compact windows of min-hashed shingles find passages that texts share."""

from __future__ import annotations

import math
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import cached_property, lru_cache, reduce
from heapq import heapify, heappop, heappush

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    checkpointed, compressed_text, dropped_table, hashes, mixed, packed_counts, place, plain_text,
    shared_table, text_of, unpacked_counts, words,
)
from ledgerloom.llm.components import components

#: Words of a shingle, of the shortest passage; least Jaccard similarity of two passages' shingles.
WIDTH, LEAST, SIMILARITY = 5, 50, 0.8
#: A pair of passages that similar shares no signature with probability 0.2**HASHES at most.
HASHES = 4
#: Words beside a shingle that must agree on one side before texts are compared; of an exact passage
#: of 50 words, 22 stand on one side at least. Windows whose texts share no passage with their first
#: partner's meet again by the larger number of words.
CONTEXTS = (8, 16)
#: Numbers of words before a shingle that one key stands for, when windows meet by words on both
#: sides: by all but STEPS[0] - 1 words of the shortest passage first, then by all of them.
STEPS = (6, 1)
#: A passage takes in the words beyond an edit that inserts, drops or replaces more words than this
#: at a time only for more shared shingles than the edit costs.
GAP = 4
#: Text bytes whose windows one task groups, on average.
PART_BYTES = 16 << 20
#: Characters of the texts whose words one call splits, and of those whose windows one call lets
#: meet; one longer text is a piece of its own.
SPLIT_CHARS, PIECE_CHARS = 1 << 20, 6 << 20
#: Keys by which windows meet again that one call lets meet; those of one pair are not cut.
PIECE_KEYS = 500_000
#: Words of the texts that a task of the verification keeps for further pairs, or works out keys of.
KEPT_WORDS = 200_000
_SALT = 0xC2B2AE3D27D4EB4F
#: An odd number and its inverse modulo 2**64.
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
#: Of each byte, whether it belongs to a word; its lower case plus one, which is never 0 in UTF-8.
_IN_WORD = bytes(chr(x) not in " \t\n\r\x0b\x0c" for x in range(256))
_LOWER = bytes((x + 1) % 256 for x in bytes(range(256)).lower())


def shingles(h: np.ndarray, width: int = WIDTH) -> np.ndarray:
    """Hash of the ``width`` words at each position, of the words' hashes."""
    n = len(h) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(width):
        total = mixed(total + h[i : i + n])
    return total


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least value of each run of ``width`` values, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def _nearest(values: np.ndarray, step: int) -> np.ndarray:
    """Place of the nearest smaller value after each, or, with step -1, of the nearest one before it
    that is no larger; counted from 1, with 0 and one more than there are for none."""
    n = len(values)
    own = np.concatenate([values[:1], values, values[:1]])
    to = np.arange(n + 2) + step
    left = np.arange(1, n + 1)
    for _ in range(16):  # each place goes on to where the one that it has come to has come to
        at = to[left]
        low = own[at] >= own[left] if step > 0 else own[at] > own[left]
        left = left[low & (at > 0) & (at <= n)]
        to[left] = to[to[left]]
    if len(left):  # a few have a long way; those nearer to where they go have come there before
        own, to = own.tolist(), to.tolist()
        for i in left[::-step].tolist():
            at = to[i]
            while 0 < at <= n and (own[at] >= own[i] if step > 0 else own[at] > own[i]):
                at = to[at]
            to[i] = at
    return np.array(to[1:-1], np.int64)


def compact_windows(values: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(centre, left, right) of the compact windows of at least ``least`` values, by centre:
    values[centre] is the least of left..right, of equals the first, and neither end can move out.

    They are the Cartesian tree's nodes with subtrees of that size. A node's value is the least of
    some run of that length, and so is a smaller value beside it: those values alone have the ends of
    all windows.
    """
    n = len(values)
    if n < least:
        return (np.empty(0, np.int64),) * 3
    pad = np.zeros(least - 1, values.dtype)
    low = np.concatenate([pad, sliding_least(values, least), pad])
    greatest = ~sliding_least(~low, least)  # of the least values of the runs over each place
    centres = np.flatnonzero(values == greatest)
    at = np.concatenate([[-1], centres, [n]])
    left = at[_nearest(values[centres], -1)] + 1
    right = at[_nearest(values[centres], 1)] - 1
    keep = right - left + 1 >= least
    return centres[keep], left[keep], right[keep]


def windows_of(texts: list[str | None], count: int, width: int, least: int) -> list[np.ndarray]:
    """Arrays (text, key, centre, left, right, before, after) of the windows of some texts, for
    ``count`` hashes. before and after: 16 bits of a hash of the words beside the centre's shingle,
    or -1 where the text has too few.

    The texts stand end to end; shingles that would cross an end get a value below all others, and
    no window holds one of those. Ends are counted in shingles of the text.
    """
    split = [words(t) for t in texts]
    sizes = np.array([len(s) for s in split], np.int64)
    h = hashes([w for s in split for w in s])
    sh, beside = shingles(h, width), shingles(h, CONTEXTS[0])
    starts = np.cumsum(sizes) - sizes
    doc = np.repeat(np.arange(len(split)), sizes)[: len(sh)]
    position = np.arange(len(sh)) - starts[doc]
    outside = position > (sizes - width)[doc]
    out = []
    for k in range(count):
        value = mixed(sh + np.uint64((k + 1) * _SALT % 2**64)) | np.uint64(1)
        value[outside] = 0
        c, left, right = compact_windows(value, least - width + 1)
        real = value[c] > 0
        c, left, right = c[real], left[real], right[real]
        # All hashes share the shingle's places; their keys must not meet.
        key = mixed(value[c] + np.uint64(k))
        at, low = position[c], CONTEXTS[0]
        size, base = sizes[doc[c]], starts[doc[c]]
        before, after = np.full((2, len(c)), -1, np.int64)
        fit = at >= low
        before[fit] = beside[c[fit] - low] >> np.uint64(48)
        fit = at + width + low <= size
        after[fit] = beside[c[fit] + width] >> np.uint64(48)
        out.append((doc[c], key, at, left - base, right - base, before, after))
    return [np.concatenate(x) for x in zip(*out)]


WINDOW = ("key", "doc", "size", "c", "l", "r", "before", "after")
#: al, ar, bl, br: words beside the shingle that lie in the windows, as far as a shortest passage.
LINK = ("a", "b", "ac", "bc", "al", "ar", "bl", "br")


def meet(w: dict[str, np.ndarray], rows: np.ndarray, side: str, least: int, roomy: bool = True):
    """Of the windows ``rows``: pairs (first, other) with the same key and words on a side, first
    the one of the shortest text; the first windows, with those of their texts where no other text
    is; those without room for a passage with theirs, and the first of each of these.

    There is room if the intervals of both around the shared shingle overlap that far, or always
    unless ``roomy``. Further windows of the first one's text are paired with the next text's.
    """
    rows = rows[w[side][rows] >= 0]
    rows = rows[np.argsort(w["key"][rows])]
    again = np.zeros(len(rows) + 1, bool)
    again[1:-1] = w["key"][rows[1:]] == w["key"][rows[:-1]]
    several = again[1:] | again[:-1]
    # Most keys have one window; only the others need the order of all columns.
    alone, rows = rows[~several], rows[several]
    rows = rows[np.lexsort([w[x][rows] for x in ("c", "doc", "size", side, "key")])]
    same = np.zeros(len(rows), bool)
    key, words_ = w["key"][rows], w[side][rows]
    same[1:] = (key[1:] == key[:-1]) & (words_[1:] == words_[:-1])
    at = np.arange(len(rows))
    start = np.maximum.accumulate(np.where(same, 0, at))
    first = rows[start]
    other = w["doc"][rows] != w["doc"][first]
    to_left, to_right = w["c"] - w["l"], w["r"] - w["c"]
    room = np.minimum(to_left[rows], to_left[first]) + np.minimum(to_right[rows], to_right[first]) + 1
    fits = (room >= least - WIDTH + 1) | (not roomy)
    good = same & fits & other
    second = np.full(len(rows), len(rows))
    np.minimum.at(second, start[other], at[other])
    second = second[start]
    own = same & ~other
    lent = own & (second < len(rows))
    pairs = (
        np.concatenate([first[good], rows[lent]]),
        np.concatenate([rows[good], rows[second[lent]]]),
    )
    firsts = np.concatenate([alone, rows[~same | own & ~lent]])
    left = same & ~fits
    return pairs, firsts, rows[left], first[left]


def meetings(w: dict[str, np.ndarray], side: str, least: int, roomy: bool):
    """Pairs of windows that meet until none is left that had no room with its first partner, and
    the first windows of all rounds, each paired with the first of the round before it."""
    rows, before = np.arange(len(w["key"])), np.full(len(w["key"]), -1)
    pairs, firsts = [], []
    while len(rows):
        own, first, rows, past = meet(w, rows, side, least, roomy)
        late = first[before[first] >= 0]
        late = late[w["doc"][late] != w["doc"][before[late]]]
        pairs += [own, (before[late], late)]
        firsts.append(first)
        before[rows] = past
    return pairs, np.concatenate([np.empty(0, np.int64), *firsts])


def _as_links(w: dict[str, np.ndarray], pairs: list[tuple], least: int) -> dict[str, np.ndarray]:
    none = np.empty(0, np.int64)
    a, b = (np.concatenate([none, *x]) for x in zip(*pairs, (none, none)))
    out = {"a": w["doc"][a], "b": w["doc"][b], "ac": w["c"][a], "bc": w["c"][b]}
    reach = [np.minimum(x, least - WIDTH) for x in (w["c"] - w["l"], w["r"] - w["c"])]
    return out | {"al": reach[0][a], "ar": reach[1][a], "bl": reach[0][b], "br": reach[1][b]}


def _dealt(kind: int, rows: dict[str, np.ndarray], by: np.ndarray, parts: int) -> Iterator[tuple]:
    """Packed rows, one pack for each part that has any; ``by``: the hash that deals them."""
    order = np.argsort(by, kind="stable")
    rows = {name: x[order] for name, x in rows.items()}
    part = place(by[order], parts)
    cut = np.flatnonzero(np.diff(part)) + 1
    names = list(rows)
    for i, own in enumerate(np.split(part, cut)):
        if len(own):
            low = cut[i - 1] if i else 0
            packs = [packed_counts(rows[x][low : low + len(own)].view(np.int64)) for x in names]
            yield kind, int(own[0]), packs


PACK_SCHEMA = "kind int, part int, packs array<binary>"


def _unpacked(packs: list, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    own = {n: [unpacked_counts(p[i]) for p in packs] for i, n in enumerate(names)}
    out = {n: np.concatenate(x) if x else np.empty(0, np.int64) for n, x in own.items()}
    if "key" in out:
        out["key"] = out["key"].view(np.uint64)
    return out


def _packs(windows: dict[str, np.ndarray], least: int, parts: int, roomy: bool) -> pd.DataFrame:
    pairs, stays = [], np.zeros(len(windows["key"]), bool)
    for side in ("before", "after"):
        own, first = meetings(windows, side, least, roomy)
        pairs += own
        stays[first] = True
    links = _as_links(windows, pairs, least)
    windows = {name: x[stays] for name, x in windows.items()}
    a, b = links["a"].view(np.uint64), links["b"].view(np.uint64)
    rows = [*_dealt(0, windows, windows["key"], parts)]
    rows += _dealt(1, links, mixed(b ^ mixed(a)), parts)
    return pd.DataFrame(rows, columns=["kind", "part", "packs"])


def cuts(sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches (low, high) of all rows in order, whose sizes sum up to ``most`` or that are one row."""
    low, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if i > low and total + size > most:
            yield low, i
            low, total = i, 0
        total += size
    if len(sizes):
        yield low, len(sizes)


def pieces(batch: pd.DataFrame, chars: int) -> Iterator[pd.DataFrame]:
    """The rows in order, in pieces whose sizes sum up to ``chars`` at most, or of one row."""
    return (batch.iloc[low:high] for low, high in cuts(batch["size"].to_numpy(), chars))


def _signatures(rows: DataFrame, count: int, least: int, parts: int) -> DataFrame:
    """Packed windows (kind 0) and links (kind 1) of the texts.

    Within a batch, windows meet at once; only those that must stand for their key go beyond it: a
    passage that is in every text has one window for each batch, not for each text. Links are dealt
    out by their texts.
    """

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for part in pieces(batch, PIECE_CHARS):
                own = []
                for some in pieces(part, SPLIT_CHARS):
                    at, key, *rest = windows_of(some["text"].tolist(), count, WIDTH, least)
                    doc, size = (some[x].to_numpy()[at].astype(np.int64) for x in ("doc", "size"))
                    own.append((key, doc, size, *rest))
                whole = (np.concatenate(x) for x in zip(*own))
                yield _packs(dict(zip(WINDOW, whole)), least, parts, True)

    return rows.mapInPandas(found, PACK_SCHEMA)


def _by_pair(links: dict[str, np.ndarray]) -> pd.DataFrame:
    """One row (a, b, places) for each pair of texts; places are bytes of two integers each, of bc and
    ac by 32 bits and of the reaches by 16, in order."""
    reach = reduce(lambda x, n: x << 16 | links[n], ("ar", "bl", "br"), links["al"])
    columns = links["a"], links["b"], links["bc"] << 32 | links["ac"], reach
    order = np.lexsort(columns[::-1])
    a, b, place, reach = columns = tuple(x[order] for x in columns)
    other = np.ones((2, len(a)), bool)  # another pair; another place
    other[0, 1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    other[1, 1:] = other[0, 1:] | (place[1:] != place[:-1]) | (reach[1:] != reach[:-1])
    a, b, place, reach = (x[other[1]] for x in columns)
    start = np.flatnonzero(other[0, other[1]])
    data = np.column_stack([place, reach]).astype("<i8").tobytes()
    ends = [*start[1:].tolist(), len(a)]
    packs = [data[16 * low : 16 * high] for low, high in zip(start.tolist(), ends)]
    return pd.DataFrame({"a": a[start], "b": b[start], "places": pd.Series(packs, dtype=object)})


def _places(packs: list[bytes]) -> np.ndarray:
    """Rows (bc, ac, al, ar, bl, br) of a pair as columns, in order and each once."""
    place, reach = rows = np.frombuffer(b"".join(packs), "<i8").reshape(-1, 2).T
    if len(packs) > 1:
        place, reach = rows = rows[:, np.lexsort((reach, place))]
        new = np.ones(len(place), bool)
        new[1:] = (place[1:] != place[:-1]) | (reach[1:] != reach[:-1])
        place, reach = rows[:, new]
    shifts = np.array([[48], [32], [16], [0]])
    return np.concatenate([[place >> 32, place & 0xFFFFFFFF], reach >> shifts & 0xFFFF])


def _links(packs: DataFrame, least: int, roomy: bool) -> DataFrame:
    """Rows (a, b, places) of linked texts: b has at bc the shingle that a has at ac."""

    def found(group: pd.DataFrame) -> pd.DataFrame:
        kind = group["kind"].to_numpy()
        packs = group["packs"].to_numpy()
        windows = _unpacked([p for p, k in zip(packs, kind) if k == 0], WINDOW)
        out = [_unpacked([p for p, k in zip(packs, kind) if k == 1], LINK)]
        for side in ("before", "after"):
            out.append(_as_links(windows, meetings(windows, side, least, roomy)[0], least))
        return _by_pair({name: np.concatenate([x[name] for x in out]) for name in LINK})

    return packs.groupBy("part").applyInPandas(found, "a long, b long, places binary")


def _run(a: np.ndarray, b: np.ndarray, i: int, j: int, step: int) -> int:
    """Equal values from a[i] and b[j] on, or, with step -1, right before them and back."""
    limit = min(len(a) - i, len(b) - j) if step > 0 else min(i, j)
    n, size = 0, 64
    while n < limit:
        m = min(size, limit - n)
        if step > 0:
            different = a[i + n : i + n + m] != b[j + n : j + n + m]
        else:
            different = (a[i - n - m : i - n] != b[j - n - m : j - n])[::-1]
        k = int(different.argmax())
        if different[k]:
            return n + k
        n, size = n + m, size * 4
    return n


def prefix_sums(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums by which the hash of any stretch of words is one subtraction, and the powers in them:
    sums[high] - sums[low] * powers[high - low] is the same for equal words wherever they stand."""
    n = len(h)
    powers, inverse = _powers(1 << n.bit_length())
    # sums[n] = sum of h[i] * STEP**(n - 1 - i), by way of the powers' inverses.
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(np.multiply(h, inverse[:n], dtype=np.uint64), out=total[1:])
    total[1:] *= powers[:n]
    return total, powers


@lru_cache
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the step, and more than as many of its inverse."""
    return np.cumprod(np.full(n + 1, _STEP)) * _BACK, np.cumprod(np.full(n + 1, _BACK)) * _STEP


def word_values(text: bytes) -> np.ndarray:
    """A number for each word of a text, as ``words`` cuts it; the same for equal ones."""
    inside = np.frombuffer(b"\0" + text.translate(_IN_WORD) + b"\0", bool)
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    low, high = edges[::2], edges[1::2]
    sums, powers = prefix_sums(np.frombuffer(text.translate(_LOWER), np.uint8))
    return mixed(sums[high] - sums[low] * powers[high - low])


def _joined(h: np.ndarray) -> np.ndarray:
    """A number for each shingle, the same for equal ones within one process."""
    n = max(0, len(h) - WIDTH + 1)
    total = h[:n].copy()
    for i in range(1, WIDTH):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += h[i : i + n]
    return total


class Words:
    """Numbers of a text's words and of its shingles."""

    def __init__(self, text: bytes | list[bytes], size: int = 0) -> None:
        self.size = size
        self.values = word_values(text if isinstance(text, bytes) else b" ".join(text))
        self.numbers = _joined(self.values)

    @cached_property
    def places(self) -> tuple[list[int], list[int]]:
        """Places by the rank of their shingle and in order, and where those of each rank begin."""
        rank = self.ranks[1]
        begin = np.cumsum(np.bincount(rank, minlength=1))
        return np.argsort(rank, kind="stable").tolist(), [0, *begin.tolist()]

    def starts(self, least: int) -> tuple[np.ndarray, int]:
        """For each place, the first stretch of ``least`` shingles in which it is the first place of
        its shingle; the fewest distinct shingles of any such stretch."""
        if least not in self._starts:
            own = self.ranks[2] + 1
            own = np.maximum(own, np.arange(1 - least, len(own) + 1 - least))
            begun = np.cumsum(np.bincount(own, minlength=len(own)))[: max(0, len(own) - least + 1)]
            self._starts[least] = own, int((begun - np.arange(len(begun))).min(initial=len(own)))
        return self._starts[least]

    @cached_property
    def _starts(self) -> dict[int, tuple[np.ndarray, int]]:
        return {}

    @cached_property
    def ranks(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Distinct shingles in order; of each place the rank of its shingle among them, the place
        before it with the same one, or -1, and minus one if no other place has it, or zero."""
        order = np.argsort(self.numbers)
        ordered = self.numbers[order]
        new = np.ones(len(order) + 1, bool)
        np.not_equal(ordered[1:], ordered[:-1], out=new[1:-1])
        rank, before = np.empty(len(order), np.int64), np.full(len(order), -1)
        rank[order] = np.cumsum(new[:-1]) - 1
        lone = np.full(len(order), -1.0)
        several = np.flatnonzero(~(new[:-1] & new[1:]))
        if len(several):  # places of one shingle in order
            own = np.sort(rank[order[several]] << 32 | order[several]) & 0xFFFFFFFF
            lone[own] = 0
            later = np.flatnonzero(~new[several])
            before[own[later]] = own[later - 1]
        return ordered[new[:-1]], rank, before, lone

    def too_few(self, other: Words, least: int, limit: float = SIMILARITY) -> bool:
        """Whether the other text has so few of the shingles that no stretch of ``least`` of them, nor a
        longer one, can be that similar to any of its own."""
        own, theirs = self.ranks[0], np.sort(other.numbers)
        if len(self.numbers) < least:
            return True
        both = theirs[own[np.minimum(own.searchsorted(theirs), len(own) - 1)] == theirs]
        n_shared = np.count_nonzero(both[1:] != both[:-1]) + (len(both) > 0)
        return n_shared < limit * self.starts(least)[1] - 1e-6


class Side:
    """One text of a pair: which of its shingles the other one has, and how far a passage can go."""

    def __init__(self, text: Words, shared: np.ndarray, limit: float) -> None:
        _, _, self.before, lone = text.ranks
        self.text, self.shared = text, shared
        self.lone, self.gain = lone, (1 - limit) / limit / 2

    @cached_property
    def level(self) -> np.ndarray:
        """Of a passage's shingles, those of one side only are at most (1 - limit) / limit times those
        of both. Here each side gives half of that for a shingle that the other text has, and takes
        one for a shingle that stands once and not in the other text at all."""
        level = np.zeros(len(self.shared) + 1)
        np.cumsum(np.where(self.shared, self.gain, self.lone), out=level[1:])
        return level

    @cached_property
    def least(self) -> np.ndarray:
        return np.minimum.accumulate(self.level)

    @cached_property
    def most(self) -> np.ndarray:
        return np.maximum.accumulate(self.level[::-1])[::-1]

    def foreign(self, at: np.ndarray, least: int) -> np.ndarray:
        """For each place, the fewest distinct shingles that the other text does not have, of the
        stretches of ``least`` shingles that hold it."""
        begin = max(0, int(at.min()) - least + 1)
        near = slice(begin, int(at.max()) + least)
        other = ~self.shared[near]
        n = len(other)
        first = np.maximum(self.text.starts(least)[0][near][other] - begin, 0)
        change = np.bincount(first, minlength=n)
        change[1:] -= other[:-1]
        count = np.full(n + least - 1, n)  # by the start of the stretch
        count[least - 1 : n] = np.cumsum(change)[: n - least + 1]
        return sliding_least(count, least)[at - begin]

    def room(self, at: np.ndarray, least: int) -> np.ndarray:
        """For each place, the most that the level rises over a stretch of ``least`` shingles or more
        that holds it."""
        n = len(self.shared)
        rise = np.full(n + least - 1, np.inf)  # by the start of the stretch, negative
        rise[least - 1 : n] = self.level[: n - least + 1] - self.most[least:]
        near = -sliding_least(rise, least)[at]
        far = np.where(at >= least, self.most[at + 1] - self.least[np.maximum(at - least, 0)], -np.inf)
        return np.maximum(near, far)

    def counts(self, start: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Distinct shingles of the words from ``start`` to each of the ``ends``, and how many of
        them the other text has anywhere."""
        last = np.maximum(ends - WIDTH - start, 0)
        window = slice(start, start + int(last.max()) + 1)
        new = self.before[window] < start
        return np.cumsum(new)[last], np.cumsum(new & self.shared[window])[last]


def shared_shingles(a: Words, b: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each text's places, whether the other text has their shingle anywhere; of each of those of
    the second text, the rank of its shingle in the first one."""
    (of_a, rank_a, *_), (of_b, rank_b, *_) = a.ranks, b.ranks
    if not (len(of_a) and len(of_b)):
        return np.zeros(len(rank_a), bool), np.zeros(len(rank_b), bool), rank_b[:0]
    at = np.minimum(of_a.searchsorted(of_b), len(of_a) - 1)
    both = of_a[at] == of_b
    in_b = np.zeros(len(of_a), bool)
    in_b[at[both]] = True
    shared = both[rank_b]
    return in_b[rank_a], shared, at[rank_b[shared]]


class Pair:
    """Two texts and the search for passages that they share."""

    def __init__(self, a: Words, b: Words, limit: float = SIMILARITY) -> None:
        self.a, self.b, self.limit = a.values, b.values, limit
        self.first, self.second = a, b
        in_a, in_b, self.in_first = shared_shingles(a, b)
        self.sides = Side(a, in_a, limit), Side(b, in_b, limit)
        #: A passage with a larger edit has too few shared shingles for its similarity.
        self.budget = math.ceil(min(len(self.a), len(self.b)) * (1 - limit) / limit)
        self.steps: dict[tuple[int, int, int], tuple[int, int, int, int, int] | None] = {}

    @cached_property
    def common(self) -> list[int]:
        """Places of the second text whose shingles the first one has."""
        return np.flatnonzero(self.sides[1].shared).tolist()

    @cached_property
    def ranks(self) -> list[int]:
        """The ranks of their shingles in the first text."""
        return self.in_first.tolist()

    def beyond(self, i: int, j: int, step: int) -> tuple[int, int] | None:
        """Words between (i, j) and the nearest shared shingle in that direction, if the edit is
        within the budget."""
        best, least = None, self.budget + 1
        common, ranks, (places, begin) = self.common, self.ranks, self.first.places
        x = bisect_left(common, j) if step > 0 else bisect_right(common, j - WIDTH) - 1
        while 0 <= x < len(common):
            at = common[x]
            q = at - j if step > 0 else j - WIDTH - at
            if q >= least:
                break
            low, high = begin[ranks[x]], begin[ranks[x] + 1]
            if step > 0:
                k = bisect_left(places, i, low, high)
                p = places[k] - i if k < high else least
            else:
                k = bisect_right(places, i - WIDTH, low, high)
                p = i - WIDTH - places[k - 1] if k > low else least
            if p + q < least:
                best, least = (p, q), p + q
            x += step
        return best

    def next_run(self, i: int, j: int, step: int):
        """(i, j, shared, lost, paid) from the end of one run of equal words to that of the next; all
        passages that come by here share it."""
        key = i, j, step
        if key not in self.steps:
            edit = self.beyond(i, j, step)
            if edit is None:
                self.steps[key] = None
            else:
                k, m = i + step * edit[0], j + step * edit[1]
                n = _run(self.a, self.b, k, m, step)
                cost = sum(edit) + 2 * (WIDTH - 1)
                paid = cost if max(edit) > GAP else 0
                self.steps[key] = k + step * n, m + step * n, n - WIDTH + 1, cost, paid
        return self.steps[key]

    def hopeless(self, ac: int, bc: int, i: int, j: int, step: int) -> bool:
        """Whether no passage around the place can reach (i, j), or end beyond it, by the levels."""
        room = 0.0
        for side, at, end in zip(self.sides, (ac, bc), (i, j)):
            if step > 0:
                room += side.most[min(max(end - WIDTH + 1, at), len(side.most) - 1)] - side.least[at]
            else:
                room += side.most[at + 1] - side.least[end]
        return room < -1e-6

    def ends(self, i: int, j: int, step: int, place: tuple[int, int]) -> np.ndarray:
        """Rows (i, j, shared, lost, paid): where a passage from (i, j) can end, after the first run
        of equal words, and after each further run of a shingle or more that follows an edit; words
        of the first run and shingles of the others; shingles that the edits cost, and of those what
        the edits of more than GAP words do."""
        n = _run(self.a, self.b, i, j, step)
        out = [(i + step * n, j + step * n, n, 0, 0)]
        while True:
            i, j, *sums = out[-1]
            following = self.next_run(i, j, step)
            if following is None or self.hopeless(*place, *following[:2], step):
                return np.array(out, np.int64)
            out.append((*following[:2], *(x + y for x, y in zip(sums, following[2:]))))

    def similarity(self, i: int, k: int, j: int, m: int) -> float:
        """Jaccard similarity of the shingles of the words a[i:k] and b[j:m]."""
        a = set(self.first.numbers[i : k - WIDTH + 1].tolist())
        b = set(self.second.numbers[j : m - WIDTH + 1].tolist())
        both = len(a & b)
        return both / max(1, len(a) + len(b) - both)

    def possible(self, ac: np.ndarray, bc: np.ndarray, least: int) -> np.ndarray:
        """For each place, whether the levels of both texts, and the shingles near it that one text
        lacks, let any passage hold it."""
        least -= WIDTH - 1
        if min(len(x.shared) for x in self.sides) < least:
            return np.zeros(len(ac), bool)
        # A passage has no more shared shingles than the texts, which leave room for few others: it is
        # no smaller than the poorest stretch, and holds no stretch with more others.
        n_shared = np.count_nonzero(np.bincount(self.in_first))
        if n_shared < self.limit * self.second.starts(least)[1] - 1e-6 or not len(ac):
            return np.zeros(len(ac), bool)
        spare = n_shared * (1 - self.limit) / self.limit + 1e-6
        few = self.sides[1].foreign(bc, least)
        if few.min(initial=spare) <= spare:
            few = few + self.sides[0].foreign(ac, least)
        few = few <= spare
        if spare >= least and few.any():  # else the stretches near the places tell
            i, j = ac[few], bc[few]
            few[few] = self.sides[0].room(i, least) + self.sides[1].room(j, least) >= -1e-6
        return few

    def passage(self, ac: int, bc: int, least: int = LEAST):
        """The passage (a_start, a_end, b_start, b_end) around a shingle at ac and bc, or None.

        It takes the run of equal words there and, on either side, the runs beyond as many edits as
        give it the most shared shingles, less what the large edits cost, with the similarity of all
        of it within the limit. Ends are left out only where no similarity can be: the distinct
        shingles of both stretches, and those of each that the other text has, are counted exactly.
        """
        place = ac, bc
        after, before = self.ends(ac, bc, 1, place), self.ends(ac, bc, -1, place)
        if min(after[-1, :2] - before[-1, :2]) < least:
            return None
        if len(after) + len(before) == 2:  # equal words alone
            return int(before[0, 0]), int(after[0, 0]), int(before[0, 1]), int(after[0, 1])
        k, m = after[:, 0], after[:, 1]
        gain = after[:, 2] - after[:, 4]

        def best_of(x: int, below: tuple[int, int] | None = None):
            """(score, index of the end) of the best stretch from start ``x``, or the next best."""
            i, j = before[x, :2].tolist()
            da, ua = self.sides[0].counts(i, k)
            db, ub = self.sides[1].counts(j, m)
            both = np.minimum(ua, ub)
            score = gain + before[x, 2] - before[x, 4]
            good = (np.minimum(k - i, m - j) >= least) & (both >= self.limit * (da + db - both))
            if below is not None:
                good &= (score < below[0]) | (score == below[0]) & (np.arange(len(k)) > below[1])
            if not good.any():
                return None
            y = int(np.where(good, score, score.min() - 1).argmax())
            return -int(score[y]), x, y

        # An end before the place is looked into once no other one can have a higher score.
        heap = [(-x, i, -1) for i, x in enumerate((before[:, 2] - before[:, 4] + gain.max()).tolist())]
        heapify(heap)
        while heap:
            score, x, y = heappop(heap)
            if y >= 0:
                (i, j), end = before[x, :2].tolist(), (int(k[y]), int(m[y]))
                if x + y == 0 or self.similarity(i, end[0], j, end[1]) >= self.limit:
                    return i, end[0], j, end[1]
            if (top := best_of(x, (-score, y) if y >= 0 else None)) is not None:
                heappush(heap, top)
        return None


def verify(a: Words, own: list[bytes], places, least: int):
    """Passages shared by two texts (the first one's numbers, the words of the second) around the
    places, and the places in none."""
    ac, bc = np.array(sorted(places, key=lambda p: (p[1], p[0])), np.int64).reshape(-1, 2).T
    spans, failed = verified_places(a, Words(own), ac, bc, least)
    return spans, [*zip(ac[failed].tolist(), bc[failed].tolist())]


def verified_places(
    a: Words, b: Words, ac: np.ndarray, bc: np.ndarray, least: int
) -> tuple[list, np.ndarray]:
    """Passages around places, by bc, and which of the places are in none that an earlier one has."""
    spans, tried = [], {}
    failed = np.ones(len(ac), bool)
    if a.too_few(b, least - WIDTH + 1):
        return spans, failed
    pair = Pair(a, b)
    for n in np.flatnonzero(pair.possible(ac, bc, least)).tolist():
        if not failed[n]:
            continue
        i, j = int(ac[n]), int(bc[n])
        # All places in one run of equal words lead to the same passage.
        if j >= tried.get(i - j, 0):
            got = pair.passage(i, j, least)
            if got is not None:
                spans.append(got)
                inside = (got[0] <= ac[n:]) & (ac[n:] < got[1]) & (got[2] <= bc[n:]) & (bc[n:] < got[3])
                failed[n:][inside] = False
                continue
            tried[i - j] = j + _run(pair.a, pair.b, i, j, 1)
    return spans, failed


def equal_words(
    sums: tuple[np.ndarray, np.ndarray], i: np.ndarray, j: np.ndarray, most: np.ndarray, step: int
) -> np.ndarray:
    """How many words are equal from i and j on, or, with step -1, right before them; ``most`` at most."""
    total, powers = sums
    n, between = np.zeros(len(i), np.int64), total[i] - total[j]
    for bit in range(int(most.max(initial=0)).bit_length())[::-1]:
        more = n + (1 << bit)
        m = np.where(more <= most, more, 0)
        far = total[i + step * m] - total[j + step * m]
        same = far == between * powers[m] if step > 0 else between == far * powers[m]
        n = np.where(same & (more <= most), more, n)
    return n


def step_keys(
    sums: tuple[np.ndarray, np.ndarray], at: np.ndarray, reach: np.ndarray, run: np.ndarray, least: int,
    step: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(key, index of the place): keys of the shingles at the places with the words on both sides that
    all passages of ``least`` words have that begin lo to lo + step - 1 words before it, for each lo.

    Only those within ``reach`` words before and after a place, and only those that are not all
    within the ``run`` of words that a partner shares; both have a row for each place.
    """
    total = least - WIDTH
    lo = np.arange(0, total + 1, step)[None, :]
    hi = np.minimum(lo + step - 1, total)
    before, after = (x[:, None] for x in reach.T)
    run_before, run_after = (x[:, None] for x in run.T)
    good = (lo <= before) & (total - hi <= after) & ~((hi <= run_before) & (total - lo <= run_after))
    place, column = np.nonzero(good)
    low, high = at[place] - lo[0, column], at[place] + WIDTH + total - hi[0, column]
    value = sums[0][high] - sums[0][low] * sums[1][high - low]
    return mixed(value + (1000 * step + lo[0, column]).astype(np.uint64)), place


class Again:
    """The windows by which the places of verified pairs meet again, by kind.

    Kind 0 has ``context`` words on a side, for places in no passage; kind 1 has words on both sides,
    for all places where others can share a passage that the partner lacks. The first text of a
    pair has those for all places: whatever the others share with it and with no one else, they find
    it there. Without ``context`` or ``step`` there are none of that kind.
    """

    def __init__(self, least: int, context: int, step: int) -> None:
        self.least, self.context, self.step = least, context, step
        self.cells = len(range(0, least - WIDTH + 1, step)) if step else 2
        self.windows: tuple[list, list] = [], []
        self.held = 0
        self._new()

    def _new(self) -> None:
        self.rows: list[tuple] = []
        self.starts: dict[int, int] = {}
        self.texts: list[Words] = []
        self.words = self.places = 0

    def _start(self, text: Words) -> int:
        if id(text) not in self.starts:
            self.starts[id(text)] = self.words
            self.texts.append(text)
            self.words += len(text.values)
        return self.starts[id(text)]

    def add(
        self, a: int, b: int, first: Words, second: Words, places: np.ndarray, failed: np.ndarray
    ) -> None:
        """Takes in a pair, its places as columns; their keys are worked out with those of others."""
        if self.step or self.context and failed.any():
            ends = (x for t in (first, second) for x in (self._start(t), len(t.values), t.size))
            self.rows.append((places, failed, a, b, *ends))
            self.places += len(failed)
            if self.places * self.cells > PIECE_KEYS or self.words > KEPT_WORDS:
                self.work()

    def work(self) -> None:
        """Works out the keys of all pairs taken in."""
        if not self.rows:
            return
        places, failed, *pair = zip(*self.rows)
        counts = [len(x) for x in failed]
        places, failed = np.concatenate(places, axis=1), np.concatenate(failed)
        places[:2] = places[1::-1].copy()  # ac, bc
        a, b, *ends = (np.repeat(np.array(x, np.int64), counts) for x in pair)
        sums = prefix_sums(np.concatenate([t.values for t in self.texts]))
        i, j = places[0] + ends[0], places[1] + ends[3]
        sides = (
            (i, a, places[0], places[2:4], *ends[:3]),
            (j, b, places[1], places[4:6], *ends[3:]),
        )
        reach = self.least - WIDTH
        if self.step:
            back = equal_words(sums, i, j, np.minimum(np.minimum(places[0], places[1]), reach), -1)
            left = np.minimum(ends[1] - places[0], ends[4] - places[1])
            on = equal_words(sums, i, j, np.minimum(left, self.least), 1) - WIDTH
        for n, (at, doc, c, own, start, count, size) in enumerate(sides):
            code = np.stack([at, *own])
            if self.step:
                # What a first text's places have depends on no partner: once is enough.
                new = np.unique(code, axis=1, return_index=True)[1] if n == 0 else np.arange(len(at))
                run = np.full((len(at), 2), -1) if n == 0 else np.stack([back, on], axis=1)
                for low in range(0, len(new), max(1, PIECE_KEYS // self.cells)):
                    some = new[low : low + max(1, PIECE_KEYS // self.cells)]
                    key, which = step_keys(sums, at[some], own[:, some].T, run[some], self.least, self.step)
                    self._keep(1, key, some[which], doc, size, c, own)
            if self.context and failed.any():
                some = np.flatnonzero(failed)
                some = some[np.unique(at[some], return_index=True)[1]]
                for side, before, after in ((1, 0, self.context), (2, self.context, 0)):
                    fit = some[(c[some] >= before) & (c[some] + WIDTH + after <= count[some])]
                    low, high = at[fit] - before, at[fit] + WIDTH + after
                    value = sums[0][high] - sums[0][low] * sums[1][high - low]
                    self._keep(0, mixed(value + np.uint64(side)), fit, doc, size, c, own)
        self._new()

    def _keep(self, kind: int, key, which, doc, size, c, reach) -> None:
        if len(key):
            own = (x[which] for x in (doc, size, c, *reach))
            self.windows[kind].append((key, *own))
            self.held += len(key)

    def taken(self) -> Iterator[tuple[int, dict[str, np.ndarray]]]:
        """(kind, windows) of all pairs taken in, which are dropped here. A text's place that several
        pairs name is one window."""
        self.work()
        for kind, own in enumerate(self.windows):
            if own:
                key, doc, size, c, before, after = (np.concatenate(x) for x in zip(*own))
                own.clear()
                order = np.lexsort((c, doc, key))
                key, doc, size, c, before, after = (x[order] for x in (key, doc, size, c, before, after))
                new = np.ones(len(order), bool)
                new[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1]) | (c[1:] != c[:-1])
                start = np.flatnonzero(new)
                before, after = (np.maximum.reduceat(x, start) for x in (before, after))
                key, doc, size, c = (x[start] for x in (key, doc, size, c))
                zero = np.zeros(len(start), np.int64)
                yield kind, dict(zip(WINDOW, (key, doc, size, c, c - before, c + after, zero, zero - 1)))
        self.held = 0


SPAN = ("a", "b", "a_start", "a_end", "b_start", "b_end")
#: Rows of a span, or of a pack of the windows of kind ``again``.
CHECKED = pa.schema(
    [("again", pa.int32()), ("kind", pa.int32()), ("part", pa.int32()), ("packs", pa.list_(pa.binary()))]
    + [(n, pa.int64()) for n in SPAN]
)


def _verified(
    links: DataFrame, texts: DataFrame, least: int, context: int, step: int, parts: int
) -> DataFrame:
    """Rows of ``CHECKED``: the passages of all pairs of linked texts, and the packed windows by which
    their places meet again."""
    pairs = links.groupBy("a", "b").agg(F.collect_list("places").alias("places"))
    side = lambda n: texts.select(F.col("doc").alias(f"{n}_doc"), F.col("text").alias(f"text_{n}"))
    pairs = pairs.join(side("b"), F.col("b") == F.col("b_doc")).drop("b_doc")
    pairs = pairs.join(side("a"), F.col("a") == F.col("a_doc")).drop("a_doc")

    def out(spans: list[tuple], again: Again) -> Iterator[pa.RecordBatch]:
        if spans:
            rows = dict(zip(SPAN, zip(*spans)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows[n], t) if n in rows else pa.nulls(len(spans), t)
                 for n, t in zip(CHECKED.names, CHECKED.types)], schema=CHECKED,
            )
        for kind, windows in again.taken():
            # Only their keys restrict these windows.
            packs = _packs(windows, least, parts, False).assign(again=kind)
            yield pa.RecordBatch.from_arrays(
                [pa.array(packs[n], t) if n in packs else pa.nulls(len(packs), t)
                 for n, t in zip(CHECKED.names, CHECKED.types)], schema=CHECKED,
            )

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        again, spans = Again(least, context, step), []
        kept: dict[int, Words] = {}
        n_kept = 0

        def text(doc: int, data: pa.Scalar) -> Words:
            """Texts stay for further pairs while there is room, the last ones longest."""
            nonlocal n_kept
            own = kept.pop(doc, None)
            if own is None:
                plain = plain_text(data.as_py())
                own = Words(plain.encode(), len(plain))
                n_kept += len(own.values)
            kept[doc] = own
            while n_kept > KEPT_WORDS and len(kept) > 2:
                n_kept -= len(kept.pop(next(iter(kept))).values)
            return own

        for batch in batches:
            pairs = zip(batch["a"].to_pylist(), batch["b"].to_pylist(), *(batch[n] for n in given[2:]))
            for a, b, text_a, text_b, places in pairs:
                first, second = text(a, text_a), text(b, text_b)
                at = _places(places.as_py())
                bc, ac = at[:2]
                new = np.ones(len(bc), bool)
                new[1:] = (bc[1:] != bc[:-1]) | (ac[1:] != ac[:-1])
                found, failed = verified_places(first, second, ac[new], bc[new], least)
                spans += [(a, b, *s) for s in found]
                again.add(a, b, first, second, at, failed[np.cumsum(new) - 1])
                if again.held > PIECE_KEYS or len(spans) > 10_000:
                    yield from out(spans, again)
                    spans = []
        yield from out(spans, again)

    given = ("a", "b", "text_a", "text_b", "places")
    schema = ", ".join(f"{n} long" for n in SPAN)
    return pairs.select(*given).mapInArrow(verified, f"again int, {PACK_SCHEMA}, {schema}")


def shared_passages(rows: DataFrame, least: int = LEAST, count: int = HASHES) -> DataFrame:
    """Verified passages (a, b, a_start, a_end, b_start, b_end) between different texts of rows
    (doc, text, size); doc identifies the text. Every text with a passage is linked to others that
    have it, not to all of them.

    Windows with the same signature and words on a side are compared with the shortest text among
    them. Those that share no passage with it meet again by more words. What may be shared beyond
    the first text's run meets by words on both sides, until the words are a whole passage: no
    passage of equal words depends on which text came first.
    """
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(1, math.ceil(total / PART_BYTES))
    # Copies collapse before any text is shuffled: each task keeps one of each.
    small = rows.select("doc", compressed_text(F.col("text")).alias("text"))
    texts = small.groupBy("doc").agg(F.first("text").alias("text"))
    found = []

    def compared(packs: DataFrame, roomy: bool, context: int, step: int) -> DataFrame:
        links = _links(packs, least, roomy)
        checked, path = shared_table(_verified(links, texts, least, context, step, parts), True)
        found.append(checkpointed(checked.where(F.col("a").isNotNull()).select(*SPAN)))
        paths.append(path)
        return checked

    def again(checked: DataFrame, kind: int) -> DataFrame:
        return checked.where(F.col("again") == kind).select("kind", "part", "packs")

    paths: list[str] = []
    packs = _signatures(rows.select("doc", "text", "size"), count, least, parts)
    checked = compared(packs, True, CONTEXTS[1], STEPS[0])
    compared(again(checked, 0), False, 0, 0)
    checked = compared(again(checked, 1), False, 0, STEPS[1])
    compared(again(checked, 1), False, 0, 0)
    for path in paths:
        dropped_table(rows.sparkSession, path)
    return reduce(DataFrame.union, found)


def repeated_passages(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    least: int = LEAST,
    count: int = HASHES,
) -> DataFrame:
    """One row for each passage of a document that other documents repeat: its id, start_word,
    end_word (exclusive), class_id (the smallest id with a passage of that class) and n_passages
    (rows of the class). Documents that repeat nothing have no row.

    Passages have at least ``least`` words and a similarity of 0.8 over shingles of five words
    (words between ASCII white space, A-Z lowered). Overlapping passages of a document count as
    one. Whole copies of texts that long are passages too; shorter, empty and null texts have
    none. Rows with a null id have rows with a null id, which lend none to their class; repeated
    rows keep a row each and count as copies; other columns are ignored.
    """
    base = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    base = base.withColumn("doc", F.xxhash64("text"))
    sized = base.withColumn("size", F.length("text"))
    spans = checkpointed(shared_passages(sized.select("doc", "text", "size"), least, count))

    n_words = F.regexp_count(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"))
    ids = checkpointed(base.select("id", "doc", n_words.alias("n_words")))
    copies = ids.groupBy("doc").agg(F.count("*").alias("n"), F.first("n_words").alias("n_words"))
    copies = copies.where((F.col("n") > 1) & (F.col("n_words") >= least))

    ends = spans.select("a", "a_start", "a_end").union(spans.select("b", "b_start", "b_end"))
    ends = ends.toDF("doc", "start", "end")
    ends = ends.union(copies.select("doc", F.lit(0), "n_words"))
    ends = ends.groupBy("doc", "start").agg(F.max("end").alias("end"))  # no more than its words
    order = Window.partitionBy("doc").orderBy("start")
    before = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.withColumn("new", before.isNull() | (F.col("start") >= before))
    ends = ends.withColumn("island", F.max(F.when(F.col("new"), F.col("start"))).over(order))
    islands = checkpointed(
        ends.select("doc", "start", "end", "island", F.xxhash64("doc", "island").alias("node"))
    )
    node = lambda n: islands.select(
        F.col("doc").alias(f"{n}_doc"), F.col("start").alias(f"{n}_at"), F.col("node").alias(f"{n}_node")
    )
    edges = spans
    for n in "ab":
        edges = edges.join(
            node(n), (F.col(n) == F.col(f"{n}_doc")) & (F.col(f"{n}_start") == F.col(f"{n}_at"))
        )
    roots = components(edges.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")))
    merged = islands.groupBy("doc", "island", "node").agg(F.max("end").alias("end"))
    classes = merged.join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left")
    classes = classes.select(
        "doc", F.col("island").alias("start_word"), F.col("end").alias("end_word"),
        F.coalesce("root", "node").alias("class"),
    )
    rows = checkpointed(ids.select("id", "doc").join(classes, "doc").drop("doc"))
    totals = checkpointed(
        rows.groupBy("class").agg(F.min("id").alias("class_id"), F.count("*").alias("n_passages"))
    )
    return rows.join(totals, "class").select(
        F.col("id").alias(id_col), "start_word", "end_word", "class_id", "n_passages"
    )
