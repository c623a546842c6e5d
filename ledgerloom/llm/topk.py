"""Exact top-k inner products: ball trees per shard, searched by branch and bound."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import checkpointed

#: Sums of products below this are exact in doubles, whatever the order of the additions.
EXACT = float(2**53)
#: Rows of a leaf; tasks that a search of few shards is spread over.
LEAF, TASKS = 64, 16


class BallTree:
    """Balls over the rows of a matrix: each node has a centre, a radius, a slice of rows and, unless
    it is a leaf, two nodes that halve it."""

    def __init__(self, points: np.ndarray, leaf: int = LEAF) -> None:
        self.points, self.order = points, np.arange(len(points))
        self.slices: list[tuple[int, int]] = []
        self.children: list[tuple[int, int] | None] = []
        centres, radii = [], []
        todo = [(0, len(points), None)]
        while todo:
            low, high, parent = todo.pop()
            own = points[self.order[low:high]]
            centre = own.mean(0)
            away = np.linalg.norm(own - centre, axis=1)
            node = len(self.slices)
            self.slices.append((low, high))
            self.children.append(None)
            centres.append(centre)
            radii.append(away.max())
            if parent is not None:  # of two, the second is popped, and numbered, first
                given = self.children[parent]
                self.children[parent] = (node, given[0]) if given else (node, -1)
            if high - low <= leaf or away.max() == 0:
                continue
            first = own[away.argmax()]
            second = own[np.linalg.norm(own - first, axis=1).argmax()]
            side = own @ (second - first)
            middle = (high - low) // 2
            self.order[low:high] = self.order[low:high][np.argpartition(side, middle)]
            todo += [(low, low + middle, node), (low + middle, high, node)]
        self.centres, self.radii = np.array(centres), np.array(radii)

    def bounds(self, node: int, queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """No point of the node has a greater inner product with the query; the last term is more
        than what rounding can take from it."""
        centre, radius = self.centres[node], self.radii[node]
        slack = 1 + 1e-9 * norms * (np.linalg.norm(centre) + radius)
        return queries @ centre + norms * radius + slack


def products(queries: np.ndarray, points: np.ndarray) -> np.ndarray:
    """Exact integer inner products: in doubles where every sum fits them, else in Python integers."""
    if not queries.size or not points.size:
        return np.zeros((len(queries), len(points)))
    most = np.abs(queries).max() * np.abs(points).max() * queries.shape[1]
    if most < EXACT:
        return queries @ points.T
    whole = [[int(x) for x in row] for row in queries], [[int(x) for x in row] for row in points]
    return np.array([[sum(map(int.__mul__, q, p)) for p in whole[1]] for q in whole[0]], object)


class Search:
    """The k best points of each query in one tree, by branch and bound.

    Every query descends on its own: of a node's two halves first into the one with the larger bound,
    and into a half only while its bound reaches the query's k-th score, which all that it has seen
    so far raises. Queries that are at one node at the same time are worked out together.
    """

    def __init__(self, points: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int) -> None:
        self.tree = BallTree(points) if len(points) else None
        self.rows, self.ids, self.k = rows, ids, k
        #: Scores computed, of those that a full scan computes.
        self.computed = self.full = 0

    def best(self, queries: np.ndarray, query_rows: np.ndarray, floors: np.ndarray):
        """Triples (query, point, score) with the k best points of every query, ties to the smaller
        id. ``floors``: scores that k other points are known to reach."""
        none = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, object)
        if self.tree is None or not len(queries):
            return none
        k, points, tree = self.k, self.tree.points, self.tree
        current = floors.astype(float).copy()  # the k-th score so far
        best = np.full((len(queries), k), -np.inf)
        norms = np.linalg.norm(queries, axis=1)
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        everything = np.arange(len(queries))
        self.full += len(queries) * len(points)
        todo = [(0, everything, tree.bounds(0, queries, norms))]
        while todo:
            node, asked, bound = todo.pop()
            still = bound >= current[asked]
            asked = asked[still]
            if not len(asked):
                continue
            if tree.children[node] is not None:
                halves = [(n, tree.bounds(n, queries[asked], norms[asked])) for n in tree.children[node]]
                nearer = halves[0][1] >= halves[1][1]
                # Popped last in, first out: first the nearer half of either kind of query.
                for first in (False, True):
                    for i, (n, bound) in enumerate(halves):
                        mine = nearer == (i == 0) if first else nearer == (i == 1)
                        if mine.any():
                            todo.append((n, asked[mine], bound[mine]))
                continue
            low, high = tree.slices[node]
            members = tree.order[low:high]
            scores = products(queries[asked], points[members])
            self.computed += scores.size
            other = query_rows[asked][:, None] != self.rows[members][None, :]
            rounded = np.where(other, scores.astype(float), -np.inf)
            merged = np.concatenate([best[asked], rounded], axis=1)
            best[asked] = np.partition(merged, merged.shape[1] - k, axis=1)[:, -k:]
            # A k-th score rounded down never cuts off a point that ties with it.
            current[asked] = np.maximum(current[asked], np.nextafter(best[asked].min(1), -np.inf))
            q, p = np.nonzero(other & (rounded >= current[asked][:, None]))
            out.append((asked[q], members[p], scores[q, p]))
        if not out:
            return none
        q, p, s = (np.concatenate(x) for x in zip(*out))
        good = s.astype(float) >= current[q]
        q, p, s = q[good], p[good], s[good]
        falling = -s if s.dtype != object else [-int(x) for x in s]
        order = np.lexsort((self.rows[p], self.ids[p], falling, q))
        q, p, s = q[order], p[order], s[order]
        top = np.arange(len(q)) - np.searchsorted(q, q, side="left") < k
        return q[top], p[top], s[top]


def vectors(df: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """row, id, nameless (the id is null) and v (floor(scale * x) as doubles) of the rows whose
    components are all finite. A null id stands as the largest one, so that it sorts last."""
    most = F.lit(float(2**63))

    def whole(x):
        y = x.cast("double") * scale
        beyond = F.raise_error(F.lit("a component does not fit 64 bits"))
        return F.when(F.abs(y) < most, F.floor(y)).otherwise(beyond).cast("double")

    fine = F.forall(
        F.col(vector_col),
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < float("inf")),
    )
    kept = df.where(F.col(vector_col).isNotNull()).where(fine)
    return kept.select(
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(id_col).cast("long"), F.lit(2**63 - 1)).alias("id"),
        F.col(id_col).isNull().alias("nameless"),
        F.transform(F.col(vector_col), whole).alias("v"),
    )


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    """Rows of equal width; a shorter vector's missing components are 0."""
    out = np.zeros((len(lists), width))
    for i, v in enumerate(lists):
        out[i, : len(v)] = v
    return out


def top_k(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    divisor: int = 20,
    k: int = 20,
    scale: float = 64.0,
    shard_rows: int = 8192,
    block_rows: int = 2048,
) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best inner products of each query.

    Queries are the rows whose id is divisible by ``divisor``; every other row is a candidate, also
    one with the same id. Ties go to the smaller id, null ids last. Vectors that are null or hold a
    null or non-finite component take no part; a shorter vector is padded with zeros; with an empty
    vector all scores are 0. A component or score beyond 64 bits raises. Other columns are ignored.

    Candidates are dealt by hash to shards of bounded size. A shard's rows come to one task in order:
    first its candidates, of which it builds one tree, then, in batches, the queries, each of
    which is sent to every shard (of a table with few shards, to one of several copies of each, so
    that there are at least TASKS). A first search of one small sample, which blocks of
    ``block_rows`` queries share, gives each query a score that its k-th best can't fall below, and
    every shard starts from that score.
    """
    rows = checkpointed(vectors(df, id_col, vector_col, scale))
    size, width = rows.agg(F.count("*"), F.max(F.size("v"))).first()
    mine = ~F.col("nameless") & (F.col("id") % divisor == 0)
    shards, width = -(-(size or 1) // shard_rows), width or 0
    dealt = lambda n, seed: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n)).cast("int")
    queries = rows.where(mine)

    names = ["query", "query_id", "row", "id", "nameless", "score"]
    schema = ", ".join(f"{n} {'boolean' if n == 'nameless' else 'long'}" for n in names)

    def found(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows by shard, the candidates of each before its queries."""
        shard, parts, search = None, [], None
        for batch in batches:
            for (number, asks), part in batch.groupby(["shard", "asks"], sort=True):
                if number != shard:
                    shard, parts, search = number, [], None
                if not asks:
                    parts.append(part)
                    continue
                if search is None:
                    points = pd.concat(parts) if parts else part.iloc[:0]
                    ids, nameless = points["id"].to_numpy(), points["nameless"].to_numpy()
                    search = Search(_matrix(points["v"], width), points["row"].to_numpy(), ids, k)
                q, p, s = search.best(
                    _matrix(part["v"], width), part["row"].to_numpy(), part["floor"].to_numpy()
                )
                yield pd.DataFrame(
                    {
                        "query": part["row"].to_numpy()[q], "query_id": part["id"].to_numpy()[q],
                        "row": search.rows[p], "id": ids[p], "nameless": nameless[p],
                        "score": [int(x) for x in s],
                    }
                )

    best = Window.partitionBy("query").orderBy(F.col("score").desc(), "nameless", "id", "row")

    def searched(asked: DataFrame, points: DataFrame, groups: int) -> DataFrame:
        """The queries against the points that have the same ``shard``."""
        columns = ["shard", "asks", "row", "id", "nameless", "v", "floor"]
        asks = asked.withColumn("asks", F.lit(True)).select(columns)
        own = points.withColumn("floor", F.lit(0.0)).withColumn("asks", F.lit(False)).select(columns)
        both = own.unionByName(asks).repartition(groups, "shard")
        return both.sortWithinPartitions("shard", "asks", "row").mapInPandas(found, schema)

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    blocks = -(-(queries.count() or 1) // block_rows)
    low = queries.withColumn("floor", F.lit(float("-inf"))).withColumn("shard", dealt(blocks, 1))
    spread = max(1, shards * 4)  # the pilot is a quarter of a shard
    pilot = rows.where(dealt(spread, 2) == 0).withColumn("shard", every(blocks))
    floors = searched(low, pilot, blocks).groupBy("query").agg(
        F.count("*").alias("n"), F.min("score").cast("double").alias("floor")
    )
    floors = floors.where(F.col("n") == k).select(F.col("query").alias("q"), "floor")
    asked = queries.join(floors, F.col("row") == F.col("q"), "left").drop("q")
    asked = asked.withColumn("floor", F.coalesce("floor", F.lit(float("-inf"))))
    copies = max(1, TASKS // shards)
    asked = asked.withColumn("of", every(shards)).withColumn(
        "shard", F.col("of") * copies + dealt(copies, 4)
    )
    points = rows.withColumn("of", dealt(shards, 3)).withColumn("copy", every(copies))
    points = points.withColumn("shard", F.col("of") * copies + F.col("copy"))
    hits = searched(asked, points, shards * copies)
    ranked = hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    vec_id = F.when(~F.col("nameless"), F.col("id"))
    return ranked.select("query_id", "rank", vec_id.alias("vec_id"), "score")
