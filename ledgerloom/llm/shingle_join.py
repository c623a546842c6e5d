"""N-gram Jaccard self-join: PartEnum signatures over shingle sets, exact links, components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations
from math import comb

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import (
    checkpointed, dropped_table, hashes, mixed, place, plain_text, shared_table, words,
)
from ledgerloom.llm.components import components

#: Words of a shingle; least Jaccard similarity in percent.
WIDTH, PERCENT = 5, 80
#: PartEnum: cells that a partition of the domain is cut into, and differences a partition may have.
#: Signatures of a partition are its sets of CELLS - SPARED cells.
CELLS, SPARED = 2, 1
#: Choices of cells that one cell is in.
KILLED = comb(CELLS - 1, CELLS - SPARED - 1)
#: Elements a partition holds, on average, of the largest sets of a size band.
LOAD = 6.5
#: Below this size a set's partitions are single shingles.
SMALL = 32
#: Nodes of a chunk from which a signature leaves the chunk once, for the first of them.
HOT = 64
#: Nodes of several components from which a signature's are not compared one by one.
CROWD = 16
#: How often nodes that share too few signatures are left out before the others are compared.
SIEVES = 1
#: Bits of a signature that are shuffled. Strangers that share one by chance are told apart by the
#: number of signatures they share.
SIGNATURE_BITS = 48
#: Shingles whose signatures one call works out together; texts that one step reads together.
CHUNK, PIECE = 500_000, 1000
_SALT = [np.uint64(x) for x in (0x243F6A8885A308D3, 0x13198A2E03707344, 0xA4093822299F31D0)]


def shingle_sets(texts: list[str | None], width: int = WIDTH) -> list[np.ndarray]:
    """Of each text, the sorted distinct 64-bit hashes of its shingles; of fewer words than a shingle
    has, one hash of all of them."""
    split = [words(t) for t in texts]
    sizes = [len(own) for own in split]
    h = hashes([w for own in split for w in own])
    total = np.zeros(max(0, len(h) - width + 1), np.uint64)
    for i in range(width):  # shingles that cross the end of a text are never picked
        total = mixed(total ^ h[i : i + len(total)]) + _SALT[0]
    total += np.uint64(width)
    sets, at = [], 0
    for n in sizes:
        if n >= width:
            sets.append(np.unique(total[at : at + n - width + 1]))
        else:
            short = np.zeros(min(n, 1), np.uint64)
            for i in range(n):
                short = mixed(short ^ h[at + i : at + i + 1]) + _SALT[0]
            sets.append(short + np.uint64(n))
        at += n
    return sets


def shingle_set(text: str | None, width: int = WIDTH) -> np.ndarray:
    return shingle_sets([text], width)[0]


def most_differences(sizes: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Elements that are in one set only, at most, of a set of that size and one linked with it:
    the similarity leaves (1 - t) / (1 + t) of both sizes together, and the other has size / t at
    most."""
    return sizes * (100 - percent) // percent


def bands(sizes: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The size band of each set, from a power of two to the next, and whether it may also be the
    larger partner of a set of the band below. Pairs meet in the band of their smaller set."""
    own = np.frexp(sizes.astype(float))[1] - 1
    least = -(-sizes * percent // 100)
    return own, least < (1 << own)


def partitions(band: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Partitions of the domain for pairs whose smaller set is of the band; 0: single shingles."""
    largest = ((2 << band) - 1) * 100 // percent
    return np.where(largest <= SMALL, 0, np.ceil(largest / LOAD)).astype(np.int64)


def part_enum(sets: list[np.ndarray], percent: int = PERCENT):
    """(signature, index of the set) of all signatures, and per set how many of them, at least, every
    linked set shares.

    The shingle domain is cut into partitions and these into cells, both by hash; a signature is the
    hash of what a set has in one choice of CELLS - SPARED cells of a partition. A shingle that
    only one of two sets has spoils the choices with its cell, KILLED of them, and no others; so
    they share all signatures but KILLED for each difference. Signatures of nothing are not
    emitted. A set with too few to share one for certain also emits every shingle as a signature
    (as many partitions as shingles), and two such sets meet there.
    """
    sizes = np.array([len(s) for s in sets], np.int64)
    values = np.concatenate(sets) if sets else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    own, below = bands(sizes, percent)
    allowed = most_differences(sizes, percent)
    need = np.full(len(sets), np.iinfo(np.int64).max)
    singles = np.zeros(len(sets), bool)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for band, taken in ((own, sizes > 0), (own - 1, below & (own > 0))):
        parts = partitions(band, percent)
        singles |= taken & (parts == 0)
        cut = taken & (parts > 0)
        if not cut.any():
            continue
        mine = cut[owner]
        who, band_salt = owner[mine], mixed(band.astype(np.uint64) + _SALT[1])
        m = mixed(values[mine] ^ band_salt[who])
        part = place(m, parts[who])
        cell = (m & np.uint64(0xFFFF)).astype(np.int64) % CELLS
        key = (who << 34) | (part << 2) | cell
        order = np.argsort(key)
        key, m = key[order], m[order]
        start = np.flatnonzero(np.diff(key, prepend=-1))
        sums = np.add.reduceat(mixed(m + _SALT[2]), start)
        key = key[start]
        row_start = np.flatnonzero(np.diff(key >> 2, prepend=-1))
        row = np.cumsum(np.diff(key >> 2, prepend=-1) != 0) - 1
        dense = np.zeros((len(row_start), CELLS), np.uint64)
        there = np.zeros((len(row_start), CELLS), bool)
        dense[row, key & 3], there[row, key & 3] = sums, True
        name = mixed((key[row_start] >> 2 & 0xFFFFFFFF).astype(np.uint64) ^ band_salt[key[row_start] >> 34])
        doc = key[row_start] >> 34
        sure = -allowed * KILLED
        for i, chosen in enumerate(combinations(range(CELLS), CELLS - SPARED)):
            some = there[:, chosen].any(1)
            total = dense[:, chosen].sum(1, dtype=np.uint64)
            found.append((mixed(mixed(total + np.uint64(i)) ^ name)[some], doc[some]))
            sure += np.bincount(doc[some], minlength=len(sets))
        singles |= cut & (sure < 1)
        need = np.where(cut, np.minimum(need, np.maximum(sure, 1)), need)
    if singles.any():
        mine = singles[owner]
        found.append((mixed(values[mine] ^ _SALT[0]), owner[mine]))
        need = np.where(singles, np.minimum(need, sizes - allowed), need)
    if not found:
        return np.empty(0, np.uint64), np.empty(0, np.int64), need
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found]), need


def _chunks(batches, width: int) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Nodes and their sets, together of bounded size; one long text makes a chunk of its own."""
    nodes, sets, size = [], [], 0
    for b in batches:
        for at in range(0, len(b), PIECE):
            piece = b[at : at + PIECE]
            read = shingle_sets([plain_text(data) for data in piece["data"]], width)
            for node, own in zip(piece["node"], read):
                if sets and size + len(own) > CHUNK:
                    yield np.array(nodes, np.int64), sets
                    nodes, sets, size = [], [], 0
                nodes.append(node)
                sets.append(own)
                size += len(own)
    if sets:
        yield np.array(nodes, np.int64), sets


def _members(nodes: DataFrame, width: int, percent: int) -> tuple[DataFrame, str]:
    """A table of rows (sig, node) of the signatures that several nodes have, and its path.

    A signature that many nodes of a chunk have leaves the chunk once, for the first of them; the
    others go to groups of their own with it, so that a signature of a third of all sets is a few
    rows per chunk in any task.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for ids, sets in _chunks(batches, width):
            sigs, who, _ = part_enum(sets, percent)
            sigs = sigs >> np.uint64(64 - SIGNATURE_BITS)
            order = np.lexsort((ids[who], sigs))
            sigs, own = sigs[order].view(np.int64), ids[who[order]]
            if not len(sigs):
                continue
            start = np.flatnonzero(np.concatenate([[True], sigs[1:] != sigs[:-1]]))
            size = np.diff(start, append=len(sigs))
            hot = np.repeat(size > HOT, size)
            lead = pd.array(np.repeat(own[start], size), dtype="Int64")
            alone = ~hot
            alone[start] = True
            lead[alone] = pd.NA
            yield pd.DataFrame({"sig": sigs, "lead": lead, "node": own, "hot": hot})

    rows = nodes.select("node", "data").mapInPandas(run, "sig long, lead long, node long, hot boolean")
    group = Window.partitionBy("sig", "lead")
    rows = rows.withColumn("least", F.min("node").over(group))
    rows = rows.withColumn("most", F.max("node").over(group))
    rows = rows.where(F.col("hot") | (F.col("least") < F.col("most")))
    return shared_table(rows.select("sig", "node"), True)


def _sieved(rows: DataFrame, needs: DataFrame) -> DataFrame:
    """The rows (sig, node) of nodes that share as many signatures with others as each linked set
    would share with them, and how many nodes have the signature."""
    enough = rows.groupBy("node").agg(F.count("*").alias("have")).join(needs, "node")
    enough = enough.where("have >= need").select("node")
    rows = rows.select("sig", "node").join(enough, "node")
    again = rows.groupBy("sig").agg(
        F.min("node").alias("low"), F.max("node").alias("high"), F.count("*").alias("times")
    )
    return rows.join(again.where("low < high").select("sig", "times"), "sig")


def _with_hubs(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """The rows (sig, node) with the hub of each signature, one of its nodes.

    Of near copies, the one with the least edits of its own has the signatures that most others have.
    It is the most similar to all of them, and few differences from it are shared. So the hub is
    the node whose signatures have the most nodes, by its size: the cosine of its set and all others.
    """
    weight = rows.groupBy("node").agg(F.sum("times").alias("total")).join(nodes.select("node", "n"), "node")
    weight = weight.select("node", (F.col("total") / F.sqrt("n")).alias("weight"))
    hubs = rows.join(weight, "node").groupBy("sig")
    hubs = hubs.agg(F.max_by("node", F.struct("weight", "node")).alias("hub"))
    return rows.select("sig", "node").join(hubs, "sig")


def _cross_pairs(
    rows: DataFrame, nodes: DataFrame, width: int = WIDTH, percent: int = PERCENT
) -> DataFrame:
    """Distinct pairs a < b of nodes of different components, out of rows (sig, node, comp, hub), that
    include all linked ones, or others that connect them.

    A linked pair of different components shares ``need`` signatures at least, so one that is among
    all but ``need`` - 1 of either node's signatures. Taken from the rarest on, as all nodes order
    them alike, these are the only ones that nodes are paired by. Of a signature with more than
    CROWD nodes even then, the nodes are told apart by what they lack of its hub, or have beyond it
    (``_crowd_pairs``).
    """
    open_ = rows.groupBy("sig").agg(
        F.count("*").alias("times"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    open_ = open_.where("low < high").select("sig", "times")
    own = Window.partitionBy("node")  # signatures of one text
    rows = rows.join(open_, "sig").join(nodes.select("node", "need"), "node")
    rows = rows.withColumn("rank", F.row_number().over(own.orderBy("times", "sig")))
    rows = rows.withColumn("have", F.count("*").over(own)).where("rank <= have - need + 1")
    rows = checkpointed(rows.select("sig", "node", "comp", "hub"))
    size = rows.groupBy("sig").agg(
        F.count("*").alias("times"), F.min("comp").alias("low"), F.max("comp").alias("high")
    )
    size = size.where("low < high")
    small = rows.join(size.where(F.col("times") <= CROWD).select("sig"), "sig")
    small = checkpointed(small)
    right = small.select("sig", F.col("node").alias("b"), F.col("comp").alias("other"))
    pairs = small.join(right, "sig").where("node < b and comp <> other")
    pairs = pairs.select(F.col("node").alias("a"), "b").distinct()
    crowds = rows.join(size.where(F.col("times") > CROWD).select("sig"), "sig")
    crowds = checkpointed(crowds.select(F.col("hub").alias("lead"), "node", "comp").distinct())
    if crowds.isEmpty():
        return pairs
    return pairs.union(_crowd_pairs(crowds, nodes, width, percent)).distinct()


def _crowd_pairs(crowds: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs of nodes of different components out of rows (lead, node, comp): nodes of one lead.

    Let a node's differences be the shingles that it or its lead has alone. Two nodes differ in those
    that only one of them has among its own. With d and e <= d differences, sizes n and m, and s
    differences shared, they are linked if d + e - 2 * s <= c * (n + m), where c is (1 - t) / (1 + t).
    Then n and m are not further apart than t, d - e is c * (n + m) at most, and

    * s is e - m * (1 - t) / (2 * t) at least, and d less the most that may be in one set only;
    * a node whose partner is not linked with the lead has more than half of its differences in s,
      less c / 2 for each shingle that it has more than the lead.

    Two that are linked with the lead are connected by it. Others meet by their rarest differences
    alone, as many of them as one more than they need not share. In a crowd of near copies these
    are the edits that a few of them have, not the text that all of them share.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        of = lru_cache(64)(lambda data: shingle_set(plain_text(data), width))
        out, size = [], 0
        for batch in batches:
            for lead, node, comp, p, q in zip(*(batch[c] for c in ("lead", "node", "comp", "p", "q"))):
                first, own = of(p), shingle_set(plain_text(q), width)
                keys = np.setxor1d(first, own, assume_unique=True)
                d, both = len(keys), (len(first) + len(own) - len(keys)) // 2
                near = 100 * both >= percent * (d + both)
                # Twice the differences shared, times 100 + percent, is more than this.
                twice = d * (100 + percent) - (100 - percent) * (len(own) - len(first))
                index = d - max(1, twice // (2 * (100 + percent)) + 1) + 1
                allowed = int(most_differences(np.array([len(own)]), percent)[0])
                more = d - max(1, d - allowed) + 1
                less = d - max(1, d - len(own) * (100 - percent) // (2 * percent)) + 1
                out.append((keys.view(np.int64), lead, node, comp, len(own), d, less, more, index, near))
                size += d
                if size > CHUNK:
                    yield rows_of(out)
                    out, size = [], 0
        if out:
            yield rows_of(out)

    def rows_of(out: list[tuple]) -> pd.DataFrame:
        keys, *rest = zip(*out)
        sizes = [len(k) for k in keys]
        names = ("lead", "node", "comp", "n", "d", "less", "more", "index", "near")
        frame = {"key": np.concatenate(keys)}
        return pd.DataFrame(frame | {n: np.repeat(x, sizes) for n, x in zip(names, rest)})

    left = nodes.select(F.col("node").alias("lead"), F.col("data").alias("p"))
    right = nodes.select("node", F.col("data").alias("q"))
    rows = crowds.where("lead <> node").join(right, "node").join(left, "lead")
    rows = rows.mapInPandas(
        run,
        "key long, lead long, node long, comp long, n long, d long, less long, more long, index long, near boolean",
    )
    rows, path = shared_table(rows, True)
    often = rows.groupBy("lead", "key").agg(F.count("*").alias("times")).where("times > 1")
    own = Window.partitionBy("lead", "node")  # differences of one text
    met = rows.join(often, ["lead", "key"])
    met = met.withColumn("rank", F.row_number().over(own.orderBy("times", "key")))
    met = met.withColumn("place", F.col("rank") + F.col("d") - F.count("*").over(own))
    columns = ["node", "comp", "n", "d", "index", "near", "place"]
    # One with a linked partner only has its differences by ``index`` if it is linked itself.
    known = "(not near or place <= index)"
    large = met.where(f"place <= more and {known}").select("lead", "key", *columns)
    small = met.where(f"place <= less and {known}")
    small = small.select("lead", "key", *(F.col(c).alias(f"{c}_2") for c in columns)).withColumnRenamed("node_2", "other")
    pairs = large.join(small, ["lead", "key"]).where(
        "node <> other and comp <> comp_2 and d >= d_2 and not (near and near_2)"
        " and (near_2 or place <= index) and (near or place_2 <= index_2)"
        f" and 100 * least(n, n_2) >= {percent} * greatest(n, n_2)"
        f" and {100 + percent} * (d - d_2) <= {100 - percent} * (n + n_2)"
    )
    pairs = pairs.select(F.least("node", "other").alias("a"), F.greatest("node", "other").alias("b"))
    near = rows.where("near").select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b"))
    found = checkpointed(pairs.union(near).distinct())
    dropped_table(nodes.sparkSession, path)
    return found


def linked(width: int = WIDTH, percent: int = PERCENT):
    """UDF of two compressed texts: whether 100 * intersection >= percent * union of their sets."""

    @F.pandas_udf("boolean")
    def test(left: pd.Series, right: pd.Series) -> pd.Series:
        of = lru_cache(256)(lambda data: shingle_set(plain_text(data), width))
        out = np.zeros(len(left), bool)
        for i, (x, y) in enumerate(zip(left, right)):
            p, q = of(x), of(y)
            if 100 * min(len(p), len(q)) >= percent * max(len(p), len(q)):
                both = len(np.intersect1d(p, q, assume_unique=True))
                out[i] = 100 * both >= percent * (len(p) + len(q) - both)
        return pd.Series(out)

    return test


def _verified(pairs: DataFrame, nodes: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, by size and then by comparing them. A hub of
    many pairs is split by adaptive execution, as the joins read straight from exchanges."""
    for end in ("a", "b"):
        size = nodes.select(F.col("node").alias(end), F.col("n").alias(f"n_{end}"))
        pairs = pairs.join(size, end)
    small, large = F.least("n_a", "n_b"), F.greatest("n_a", "n_b")
    pairs = checkpointed(pairs.where(100 * small >= percent * large).select("a", "b"))
    left = nodes.select(F.col("node").alias("a"), F.col("data").alias("p"))
    right = nodes.select(F.col("node").alias("b"), F.col("data").alias("q"))
    both = pairs.join(left, "a").join(right, "b")
    return checkpointed(both.where(linked(width, percent)("p", "q")).select("a", "b"))


def node_links(nodes: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between nodes (node, n, need, data: compressed text) that connect all that
    similar pairs connect.

    Nodes that share too few signatures with any others have no partner. Of the rest, each first
    meets the node that it shares the most signatures with, out of the hubs of its signatures; what
    that links are components. Then nodes of different components are compared, by the rarest signatures
    that they share. Each pair over the least similarity is compared or connected by other links.
    """
    spark = nodes.sparkSession
    needs = nodes.select("node", "need")
    members, path = _members(nodes, width, percent)
    rows = members.withColumn("times", F.lit(2))
    for _ in range(SIEVES):
        rows = _sieved(rows, needs)
    rows, sieved_path = shared_table(rows, True)
    dropped_table(spark, path)
    rows, rows_path = shared_table(_with_hubs(rows, nodes), True)
    dropped_table(spark, sieved_path)
    partner = rows.where("node <> hub").groupBy("node", "hub").agg(F.count("*").alias("shared"))
    partner = partner.groupBy("node").agg(F.max_by("hub", F.struct("shared", "hub")).alias("hub"))
    star = partner.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b"))
    star = checkpointed(star.distinct())
    first = components(_verified(star, nodes, width, percent))
    named = rows.join(first, "node", "left")
    named = named.select("sig", "node", F.coalesce("root", "node").alias("comp"), "hub")
    pairs = _cross_pairs(checkpointed(named), nodes, width, percent)
    dropped_table(spark, rows_path)
    more = _verified(pairs.join(star, ["a", "b"], "left_anti"), nodes, width, percent)
    return more.union(first.select(F.col("root").alias("a"), F.col("node").alias("b")))


def similar_documents(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = WIDTH,
    percent: int = PERCENT,
) -> DataFrame:
    """One row per row of ``df``: its id, n_shingles (size of its set) and component_id.

    Words are lower-cased (A-Z) and split at ASCII white space; a set holds the distinct shingles
    of ``width`` words, or all words of a shorter text as one. Documents link when 100 times the
    intersection is at least ``percent`` times the union; component_id is the smallest id that
    links reach. Every link between different sets is found. Shingles are compared by 64-bit hashes,
    equal sets by 128 bits.

    Equal sets are one node before any join, so copies are never paired. Null texts and texts without
    words have an empty set and link with nothing. Repeated rows keep a row each; a row with a null
    id takes part and lends it to none, so a component of such rows only has a null id; equal ids are
    rows of their own. An empty table gives no rows; other columns are ignored. Texts are read whole;
    a task holds the sets of some 500,000 shingles, or of one longer text.
    """

    base = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = base.schema["id"].dataType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compress = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            for at in range(0, len(batch), PIECE):
                piece = batch.slice(at, PIECE)
                texts = piece["text"].to_pylist()
                sets = shingle_sets(texts, width)
                key = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
                columns = {"id": piece["id"], "key": pa.array(key, pa.binary())}
                columns["n"] = pa.array([len(s) for s in sets], pa.int64())
                data = [compress(t.encode()) if k else None for k, t in zip(key, texts)]
                columns["data"] = pa.array(data, pa.binary())
                columns["need"] = pa.array(part_enum(sets, percent)[2], pa.int64())
                yield pa.RecordBatch.from_pydict(columns)

    rows = base.mapInArrow(read, f"id {kind}, key binary, n long, data binary, need long")
    rows, rows_path = shared_table(rows, with_path=True)
    keyed = shared_table(rows.select("id", "key", "n"))
    nodes = rows.where("key is not null").groupBy("key").agg(
        F.min("id").alias("least"), *(F.first(c).alias(c) for c in ("n", "need", "data"))
    )
    # Written before use: the numbers must not change when a task runs again.
    nodes, path = shared_table(
        nodes.withColumn("node", F.monotonically_increasing_id()), with_path=True
    )
    dropped_table(df.sparkSession, rows_path)
    roots = components(node_links(nodes, width, percent))
    rooted = nodes.select("key", "node", "least").join(roots, "node", "left")
    rooted = checkpointed(rooted.select("key", "least", F.coalesce("root", "node").alias("root")))
    dropped_table(df.sparkSession, path)
    best = rooted.groupBy("root").agg(F.min("least").alias("component"))
    found = rooted.join(best, "root").select("key", "component")
    return keyed.join(found, "key", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.coalesce("component", "id").alias("component_id"),
    )
