"""Secret scan: fixed patterns, and strings that stay incompressible beside what surrounds them."""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: The base patterns (ASCII letters of the keyword in either case).
ASSIGN = re.compile(
    r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
KINDS = ("assign", "access", "hex", "novel")

#: Words that make strings sensitive that start within REACH characters behind them, and the strings
#: looked at there, of LEAST characters or more; they are measured PIECE characters at a time.
SENSITIVE = re.compile(
    r"(?ai:passw(?:or)?d|passphrase|secret|token|api[_-]?key|access[_-]?key|private[_-]?key|"
    r"credential|authorization|bearer|client[_-]?id|auth)"
)
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]++(?:\.[A-Za-z0-9+/_=-]++)*+")
LEAST, PIECE = 16, 512
REACH, AROUND = 80, 256
#: Characters running that make two sensitive strings copies of each other in part.
SHARED = 8

#: Identifiers and phrases of ordinary code, the dictionary that candidates are measured against.
IDENTIFIERS = (
    "abstract accept access_key account address api_key application argument array assert async "
    "attribute auth authorization await base64 bearer begin boolean break buffer callback catch "
    "certificate char class client_id client_secret collection column command comment commit "
    "config configuration connection console const constructor container content context "
    "continue controller cookie count create credential current data database datetime debug "
    "decode default define delete description directory document domain element encode encoding "
    "endpoint environment error event example exception execute export extends false field file "
    "filter finally float folder format function generate global handler header hostname html "
    "http https identifier implements import include index information initialize input insert "
    "instance integer interface internal iterator javascript json lambda length library listener "
    "localhost location logger login manager message metadata method module namespace network "
    "null number object operation option output package parameter parent parse password path "
    "pattern permission placeholder pointer port prefix primary private process production "
    "property protected protocol provider public python query random read receive record "
    "refresh_token register request require resource response result return schema secret "
    "select server service session settings signature source stack static status storage string "
    "struct suffix switch system table target template thread timeout timestamp token true type "
    "undefined unicode update upload user username utf-8 value variable vector version void "
    "warning window write xxxxxxxxxxxxxxxxxxxxxxxx 0123456789 abcdefghijklmnopqrstuvwxyz "
    "ABCDEFGHIJKLMNOPQRSTUVWXYZ changeme your_api_key_here"
)
#: Marginal compressed bytes per character from which a string counts as random. Random hex takes
#: about 0.55, random base64 about 0.8, words and identifiers less than 0.45.
NOVELTY = 0.5
#: The same for letters alone, in parts or in both cases, as in names. Beside 200 characters of
#: prose, random ones took 0.69 at least (900 draws), ten names 0.52 to 0.73; beside a few words
#: nothing new is shortened, and names count as random too.
NAMES = 0.67
_ONE_CASE = re.compile(r"[^A-Za-z]*(?:[A-Z]+|[A-Z]?[a-z]+)[^A-Za-z]*")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, rank of the kind, end) of the fixed patterns, in code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 16]
    return found


class Novelty:
    """Marginal compressed size of a string beside a primed dictionary and its surroundings."""

    def __init__(self) -> None:
        primed = zstandard.ZstdCompressionDict(
            IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT
        )
        self.compressor = zstandard.ZstdCompressor(
            level=12, dict_data=primed, write_content_size=False
        )

    def size(self, data: str) -> int:
        return len(self.compressor.compress(data.encode()))

    def rate(self, around: str, candidate: str) -> float:
        """Bytes that ``candidate`` adds to the compressed surroundings, per character."""
        return (self.size(around + candidate) - self.size(around)) / len(candidate)


def candidates(text: str) -> list[tuple[int, int]]:
    """Strings that start in a sensitive context, in whole, with all parts that '.' joins."""
    found, end = [], 0
    for word in SENSITIVE.finditer(text):
        for m in CANDIDATE.finditer(text, max(end, word.end())):
            if m.start() > word.end() + REACH:
                break
            end = m.end()
            if m.end() - m.start() >= LEAST:
                found.append(m.span())
    return found


def pieces(start: int, end: int, text: str) -> list[tuple[int, int]]:
    """The stretches of a candidate that are measured: all of it and its long enough parts, or, of
    each that is over PIECE characters, equal pieces."""
    spans = {(start, end)}
    spans |= {
        (start + m.start(), start + m.end())
        for m in re.finditer(r"[^.]+", text[start:end])
        if m.end() - m.start() >= LEAST
    }
    out = []
    for low, high in sorted(spans):
        n = -(-(high - low) // PIECE)
        cuts = [low + (high - low) * i // n for i in range(n + 1)]
        out += zip(cuts, cuts[1:])
    return out


def islands(spans) -> list[tuple[int, int]]:
    """The runs of overlapping spans, by start."""
    out: list[tuple[int, int]] = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = out[-1][0], max(end, out[-1][1])
        else:
            out.append((start, end))
    return out


def shared_grams(text: str) -> set[str]:
    return {text[i : i + SHARED] for i in range(len(text) - SHARED + 1)}


def copies(text: str, string: str, low: int = 0, high: int | None = None) -> list[tuple[int, int]]:
    """Where ``text[low:high]`` has the string, from left to right without overlaps."""
    found, at = [], text.find(string, low, high)
    while at >= 0:
        found.append((at, at + len(string)))
        at = text.find(string, at + len(string), high)
    return found


def without_copies(text: str, low: int, high: int, piece: str, own: set[str], sensitive) -> str:
    """``text[low:high]`` without the copies of the piece, also those that reach over its ends, and
    without those of the ``sensitive`` islands that share ``own`` grams."""
    cut = copies(text, piece, max(0, low - len(piece) + 1), high + len(piece) - 1)
    for i in range(bisect_right(sensitive, low, key=lambda s: s[1]), len(sensitive)):
        start, end = max(sensitive[i][0], low), min(sensitive[i][1], high)
        if start >= high:
            break
        if not own.isdisjoint(shared_grams(text[start:end])):
            cut.append((start, end))
    out, at = [], low
    for start, end in sorted(cut):
        out.append(text[at : max(at, min(start, high))])
        at = max(at, end)
    return "".join([*out, text[at:high]])


def novel_spans(text: str, base: list[tuple[int, int, int]], novelty: Novelty):
    """Strings in a sensitive context that compression can't shorten and no pattern has found.

    Copies nearby are cut out of the surroundings, wherever they stand: a string that is stated
    twice is as much of a secret as one stated once.
    """
    taken = [(s, e) for s, _, e in base]
    found, looked_at = [], candidates(text)
    sensitive = islands(taken + looked_at)
    for start, end in looked_at:
        rest = list(text[start:end])
        for s, e in taken:
            if s < end and start < e:
                rest[max(s, start) - start : e - start] = "." * (min(e, end) - max(s, start))
        if not re.search("[A-Za-z0-9]", "".join(rest)):
            continue
        for low, high in pieces(start, end, text):
            piece = text[low:high]
            name = not re.search("[0-9]", piece) and not _ONE_CASE.fullmatch(piece)
            own = shared_grams(piece)
            around = without_copies(text, max(0, start - AROUND), start, piece, own, sensitive)
            around += without_copies(text, end, min(end + AROUND, len(text)), piece, own, sensitive)
            if novelty.rate(around, piece) >= (NAMES if name else NOVELTY):
                found.append((start, 3, end))
                break
    return found


def scan(text: str | None, novelty: Novelty) -> list[tuple[int, int, int]]:
    text = text or ""
    base = base_spans(text)
    return sorted(base + novel_spans(text, base, novelty))


def joined(spans) -> str:
    return ",".join(f"{KINDS[rank]}:{start}:{end}" for start, rank, end in spans)


def find_secrets(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``df``: its id, counts of the kinds, hash of the base spans, all spans.

    The base patterns' spans always stay; the dictionary-primed measure adds spans of kind
    ``novel``. Texts are read whole, a null one counts as empty; repeated rows and null ids keep a
    row each; other columns are ignored. Of equal starts the kinds come as listed. A text of any
    length is one row of one task. Rows never meet, so there is no shuffle.
    """

    @F.pandas_udf(
        "n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_novel long"
    )
    def scanned(texts: pd.Series) -> pd.DataFrame:
        novelty, rows = Novelty(), []
        for text in texts:
            spans = scan(text, novelty)
            ranks = [rank for _, rank, _ in spans]
            base = joined(s for s in spans if s[1] < 3)
            digest = hashlib.sha256(base.encode()).hexdigest()
            counts = [ranks.count(i) for i in range(4)]
            rows.append((*counts[:3], digest, joined(spans), counts[3]))
        names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_novel"]
        return pd.DataFrame(rows, columns=names)

    found = df.select(F.col(id_col), scanned(F.col(text_col)).alias("_found"))
    return found.select(id_col, "_found.*")


MARK = "[SECRET]"


def everywhere(text: str, spans) -> list[tuple[int, int, int]]:
    """The spans, and wherever else the secrets in them stand: what a keyword is assigned, and strings
    of the other kinds in whole. A copy in an ordinary place gives the secret away as well."""
    out = list(spans)
    for secret in {
        (rank, ASSIGN.fullmatch(text, start, end)[2] if rank == 0 else text[start:end])
        for start, rank, end in spans
    }:
        out += [(start, secret[0], end) for start, end in copies(text, secret[1])]
    return out


def redacted(text: str, spans) -> str:
    """``text`` with each run of overlapping spans, and of copies of them, replaced by one mark."""
    out, at = [], 0
    for start, _, end in sorted(everywhere(text, spans)):
        if start >= at:
            out += [text[at:start], MARK]
        at = max(at, end)
    return "".join([*out, text[at:]])


def redact_column(text):
    """The text without its secrets; null stays null."""

    @F.pandas_udf("string")
    def clean(texts: pd.Series) -> pd.Series:
        novelty = Novelty()
        return pd.Series(
            [t if t is None else redacted(t, scan(t, novelty)) for t in texts], dtype=object
        )

    return clean(text)
