"""Exact k-means over whole numbers, with bounds loosened by norms of displacement sums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import dropped_table, shared_table

#: Up to this size, 64-bit integers hold squared distances over 512 components and sums of 2^36 rows.
NARROW = 1 << 26
#: Relative room for rounding in a bound: doubles err by far less over a few hundred components.
ROUNDING = 1e-9


def whole_vectors(
    df: DataFrame, id_col: str, vector_col: str, width: int, scale: float
) -> DataFrame:
    """id and v (floor(scale * x) as longs) of the vectors with ``width`` finite components."""
    most = F.lit(float(2**62))

    def whole(x):
        y = F.floor(x.cast("double") * scale)
        beyond = F.raise_error(F.lit("a component does not fit 62 bits"))
        return F.when(F.abs(y) < most, y).otherwise(beyond).cast("long")

    fine = F.forall(
        vector_col,
        lambda x: x.isNotNull()
        & ~F.isnan(x.cast("double"))
        & (F.abs(x.cast("double")) < float("inf")),
    )
    kept = df.where(F.size(vector_col) == width).where(F.coalesce(fine, F.lit(False)))
    return kept.select(F.col(id_col).alias("id"), F.transform(vector_col, whole).alias("v"))


def first_centroids(rows: DataFrame, k: int, seed: int) -> np.ndarray:
    """Vectors of the k smallest sha256 of ``seed:id``; of equal ids the least vector first."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit("")))
    first = rows.select("v", F.sha2(name.cast("binary"), 256).alias("hash"))
    return integers([r["v"] for r in first.orderBy("hash", "v").limit(k).collect()])


def integers(vectors: list) -> np.ndarray:
    """A matrix of 64-bit integers, or of Python's where products would not fit."""
    if not vectors:
        return np.empty((0, 0), np.int64)
    m = np.array(vectors, dtype=np.int64)
    return m if not m.size or np.abs(m).max() <= NARROW else m.astype(object)


def squared(points: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    """Exact squared distances of the points to one centroid, or row by row to as many."""
    away = points - centroid
    return (away * away).sum(1)


class History:
    """Centroids of all rounds. A bound of round t is loosened by the norm of what the centroid has
    moved in all since t, which is at most the sum of the norms of its single moves."""

    def __init__(self, rounds: list[np.ndarray]) -> None:
        self.rounds = rounds
        now = rounds[-1].astype(float)
        self.moved = np.array(
            [np.sqrt(((now - then.astype(float)) ** 2).sum(1)) for then in rounds]
        ) * (1 + ROUNDING)

    def assign(self, points, cluster, upper, upper_at, lower, lower_at):
        """New (cluster, upper, upper_at, lower, lower_at) and the number of exact distances.

        ``upper[i]`` was at least the distance of point i to its centroid in round ``upper_at[i]``,
        ``lower[i, j]`` at most that to centroid j in round ``lower_at[i, j]``. Where the loosened
        bounds leave no doubt, nothing is computed; ties are doubts.
        """
        now, each = len(self.rounds) - 1, np.arange(len(points))
        current = self.rounds[-1]
        high = (upper + self.moved[upper_at, cluster]) * (1 + ROUNDING)
        low = lower - self.moved[lower_at, np.arange(len(current))] - ROUNDING * lower
        low[each, cluster] = np.inf
        evaluated = 0
        doubt = np.flatnonzero(low.min(1) <= high) if len(current) > 1 else each[:0]
        if not len(doubt):
            return cluster, upper, upper_at, lower, lower_at, evaluated
        cluster, upper, upper_at = cluster.copy(), upper.copy(), upper_at.copy()
        lower, lower_at = lower.copy(), lower_at.copy()
        # First the own centroid: often its exact distance settles the matter.
        best = squared(points[doubt], current[cluster[doubt]])
        evaluated += len(doubt)
        upper[doubt] = np.sqrt(best.astype(float))
        upper_at[doubt] = now
        high[doubt] = upper[doubt] * (1 + ROUNDING)
        lower[doubt, cluster[doubt]] = upper[doubt]
        lower_at[doubt, cluster[doubt]] = now
        least, choice = best, cluster[doubt].copy()
        for j in range(len(current)):
            rows = np.flatnonzero((low[doubt, j] <= high[doubt]) & (cluster[doubt] != j))
            if not len(rows):
                continue
            own = squared(points[doubt[rows]], current[j])
            evaluated += len(rows)
            lower[doubt[rows], j] = np.sqrt(own.astype(float))
            lower_at[doubt[rows], j] = now
            better = (own < least[rows]) | ((own == least[rows]) & (j < choice[rows]))
            least[rows[better]] = own[better]
            choice[rows[better]] = j
        cluster[doubt] = choice
        upper[doubt] = np.sqrt(least.astype(float))
        return cluster, upper, upper_at, lower, lower_at, evaluated


STATE = (
    "id {id}, v array<long>, cluster int, upper double, upper_at int, lower array<double>, "
    "lower_at array<int>"
)


def _assigned(state: DataFrame, history: History, first: bool) -> DataFrame:
    """The state with this round's clusters; the first round measures every distance."""
    k = len(history.rounds[-1])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if not len(b):
                continue
            points = integers(list(b["v"]))
            if first:
                every = np.stack([squared(points, c) for c in history.rounds[-1]], axis=1)
                cluster = every.argmin(1).astype(np.int64)  # the first of equal ones
                lower = np.sqrt(every.astype(float))
                upper = lower[np.arange(len(b)), cluster]
                upper_at = np.zeros(len(b), np.int64)
                lower_at = np.zeros(lower.shape, np.int64)
            else:
                cluster, upper, upper_at, lower, lower_at, _ = history.assign(
                    points, b["cluster"].to_numpy(), b["upper"].to_numpy(),
                    b["upper_at"].to_numpy(), np.stack(b["lower"]), np.stack(b["lower_at"]),
                )
            yield pd.DataFrame(
                {
                    "id": b["id"], "v": b["v"], "cluster": cluster, "upper": upper,
                    "upper_at": upper_at, "lower": list(lower.reshape(-1, k)),
                    "lower_at": list(lower_at.reshape(-1, k)),
                }
            )

    kind = state.schema["id"].dataType.simpleString()
    return state.mapInPandas(run, STATE.format(id=kind))


def _moved(state: DataFrame, current: np.ndarray, narrow: bool) -> np.ndarray:
    """Centroids after the update: floor(sum / count) of each non-empty cluster, exactly; ``narrow``
    says that sums fit 64 bits. One row of sums per cluster reaches the driver."""
    width = current.shape[1]
    kind = "long" if narrow else "decimal(38,0)"
    part = lambda i: F.get("v", F.lit(i)).cast(kind)
    sums = state.groupBy("cluster").agg(
        F.count("*").alias("n"), *(F.sum(part(i)).alias(f"s{i}") for i in range(width))
    )
    new = current.astype(object)
    for r in sums.collect():
        new[r["cluster"]] = [int(r[f"s{i}"]) // r["n"] for i in range(width)]
    return integers(new.tolist())


def digest(centroid) -> str:
    return hashlib.sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def clusters(
    df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = 40,
    rounds: int = 5, width: int = 64, scale: float = 256.0, seed: int = 2,
) -> DataFrame:
    """Per vector: id, cluster, distance (squared), cluster_inertia, inertia, centroid_sha256.

    Lloyd's rounds on whole numbers floor(scale * x), exact in every step. Each vector keeps an
    upper bound to its centroid and a lower bound to every other one, each with the round it was
    measured in; the history of all centroids (rounds * k vectors) goes to the tasks, which loosen
    a bound by the norm of the centroid's total displacement since that round and rescan exactly
    where bounds fail. The state of a round is a table in the shared folder, so lost executors cost
    no earlier round, and the table before it is dropped. Nothing is shuffled but one row of sums
    per task and cluster.

    Vectors that are null, of another length or hold a null or non-finite component take no part.
    Rows with equal ids stay rows of their own; a null id hashes as the empty one. With fewer than
    ``k`` vectors there are as many centroids; an empty table gives no rows. Ties go to the smaller
    number. A component of 62 bits or more raises. Other columns are ignored.
    """
    spark = df.sparkSession
    rows, path = shared_table(whole_vectors(df, id_col, vector_col, width, scale), with_path=True)
    first = first_centroids(rows, k, seed)
    widest = rows.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
    history = [first]
    state = rows
    names = ["cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    if not len(first):
        kinds = ["int", "long", "long", "long", "string"]
        none = [F.lit(None).cast(t).alias(n) for n, t in zip(names, kinds)]
        return rows.where("false").select(F.col("id").alias(id_col), *none)
    for number in range(rounds + 1):
        state, new = shared_table(
            _assigned(state, History(history), number == 0), with_path=True
        )
        dropped_table(spark, path)
        path = new
        if number < rounds:
            history.append(_moved(state, history[-1], widest <= NARROW))

    last = history[-1]
    fixed = [(j, digest(c), [int(x) for x in c]) for j, c in enumerate(last)]
    centres = spark.createDataFrame(fixed, "cluster int, centroid_sha256 string, c array<long>")
    away = F.zip_with("v", "c", lambda x, y: (x - y) * (x - y))
    distance = F.aggregate(away, F.lit(0).cast("long"), lambda s, x: s + x)
    measured = state.join(F.broadcast(centres), "cluster").withColumn("distance", distance)
    whole = measured.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    everything = Window.partitionBy()  # one row per cluster
    whole = whole.withColumn("inertia", F.sum("cluster_inertia").over(everything).cast("long"))
    out = measured.join(F.broadcast(whole), "cluster")
    return out.select(F.col("id").alias(id_col), *names)
