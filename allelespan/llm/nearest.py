"""Approximate nearest neighbours by low-dimensional stable projections (SRS, Sun et al. 2014).

Largest inner product becomes nearest neighbour by one more coordinate, sqrt(max norm^2 - norm^2), which is 0 for queries.
Vectors are projected on DIMENSIONS Gaussian directions (2-stable), so a projected squared distance is the true one times a
chi-square variable. A kd-tree of the projections holds them: its upper levels cut the rows into cells, its lower ones the
rows of a task into leaves. A query takes cells and leaves by their distance in the projected space, verifies their vectors
on the true measure, and stops when all others are farther than sqrt(chi2inv(SURE) * d_k^2), d_k being the distance of its
k-th best: a vector that is nearer than that best is then missed with probability 1 - SURE at most.

The upper levels are fitted on at most FIT_ROWS rows; every row is indexed, and each cell's box and number of rows are exact.
A query takes cells by their distance in rounds: the rows of its nearest cell first, then of the next two, six, eighteen and so
on, and after each round d_k is smaller; it stops as soon as the next cell's box fails the test, so rows and queries are not
all sent to each other. A cell of over `block` rows, such as a hot group of equal
vectors, is dealt into parts of that size, and so are the queries of a cell; each task is of bounded size. The driver holds
one box a cell, at most FIT_ROWS / LEAST. Equal vectors of a task are held once. Scores of what is returned are computed
again in double precision in a fixed order, so equal vectors have equal scores; ties go to the smaller id.

Edge cases: rows with a null id, null or zero vectors, null or non-finite components, or another length than most rows
have, take no part. Rows that share the query's id are not its candidates. Equal queries count once. Fewer candidates than
k: all of them. Empty tables give no rows. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, exp, log2

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from allelespan.llm._common import staged, table

DIMENSIONS = 8
SURE = 0.97
BLOCK, QUERIES, LEAF = 8192, 8192, 256
SPARE = 12
SEED = 20141
#: Bound on the rows that the upper levels are fitted on, and how many of them a cell has.
FIT_ROWS, LEAST = 32768, 16


def chi_square_inverse(p: float, m: int) -> float:
    """For even m."""
    lo, hi = 0.0, 1000.0
    for _ in range(100):
        x = (lo + hi) / 2
        term = total = 1.0
        for i in range(1, m // 2):
            term *= x / 2 / i
            total += term
        lo, hi = (x, hi) if 1 - exp(-x / 2) * total < p else (lo, x)
    return lo


def _leaves(x: np.ndarray, leaf: int = LEAF) -> list[np.ndarray]:
    """Leaves of a kd-tree: median cuts of the widest side."""
    out, todo = [], [np.arange(len(x))]
    while todo:
        at = todo.pop()
        if len(at) <= leaf:
            out.append(at)
            continue
        side = int(np.argmax(np.ptp(x[at], axis=0)))
        order = at[np.argpartition(x[at, side], len(at) // 2)]
        todo += [order[: len(at) // 2], order[len(at) // 2 :]]
    return out


def _axes(d: int) -> np.ndarray:
    return np.random.default_rng(SEED).standard_normal((d + 1, DIMENSIONS))


def projected(x: np.ndarray, norm2: float) -> np.ndarray:
    """Low-dimensional places of candidates; those of queries lack the last coordinate."""
    axes = _axes(x.shape[1])
    more = np.sqrt(np.maximum(0, norm2 - np.einsum("ij,ij->i", x, x)))
    return x @ axes[:-1] + more[:, None] * axes[-1]


class Cells:
    """Upper levels of the kd-tree: a complete tree of median cuts of the widest side."""

    def __init__(self, sample: np.ndarray, levels: int):
        self.levels, n = levels, (1 << levels) - 1
        self.side, self.cut = np.zeros(n, dtype=np.int64), np.zeros(n)
        held = [sample]
        for node in range(n):
            x = held[node]
            if len(x):
                self.side[node] = np.argmax(np.ptp(x, axis=0))
                self.cut[node] = np.median(x[:, self.side[node]])
            right = x[:, self.side[node]] > self.cut[node]
            held += [x[~right], x[right]]
            held[node] = x[:0]

    def of(self, low: np.ndarray) -> np.ndarray:
        node, rows = np.zeros(len(low), dtype=np.int64), np.arange(len(low))
        for _ in range(self.levels):
            node = 2 * node + 1 + (low[rows, self.side[node]] > self.cut[node])
        return (node - len(self.cut)).astype(np.int32)


def _gaps(p: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distance of each place from each box."""
    out = np.zeros((len(p), len(a)))
    for i in range(p.shape[1]):
        out += np.maximum(0, np.maximum(a[None, :, i] - p[:, None, i], p[:, None, i] - b[None, :, i])) ** 2
    return out


def search(ids: np.ndarray, x: np.ndarray, query_ids: np.ndarray, q: np.ndarray, k: int, norm2: float, sure: float = SURE, rows_of: np.ndarray | None = None, known: np.ndarray | None = None) -> pd.DataFrame:
    """The k best of x for each query: query_id, q, vec_id, score. norm2: largest squared norm of all vectors. rows_of: a
    number for each query, returned as q. known: k-th best score that each query has already (-inf for none)."""
    rows_of = np.arange(len(q)) if rows_of is None else rows_of
    known = np.full(len(q), -np.inf) if known is None else known
    order = np.lexsort((ids,))
    ids, x = ids[order], np.ascontiguousarray(x[order])
    _, first, inverse = np.unique(x.view(np.dtype((np.void, x.dtype.itemsize * x.shape[1]))).ravel(), return_index=True, return_inverse=True)
    distinct = x[first]
    by = np.argsort(inverse, kind="stable")  # rows of each distinct vector, smaller ids first
    begin = np.concatenate(([0], np.cumsum(np.bincount(inverse))))
    axes, low = _axes(x.shape[1]), projected(distinct, norm2)
    leaves = _leaves(low)
    a, b = (np.array([f(low[at], axis=0) for at in leaves]) for f in (np.min, np.max))
    kk, stretch = min(len(distinct), k + SPARE), chi_square_inverse(sure, DIMENSIONS)
    rows = []
    for s in range(0, len(q), 512):
        part = q[s : s + 512]
        p = part @ axes[:-1]
        gap = _gaps(p, a, b)
        turn = np.argsort(gap, axis=1, kind="stable")
        own2 = np.einsum("ij,ij->i", part, part)
        top, at = np.full((len(part), kk), -np.inf), np.zeros((len(part), kk), dtype=np.int64)
        live = np.arange(len(part))
        for r in range(len(leaves)):
            leaf = turn[live, r]
            # one more than k, as the query's own vector may be among them
            kth = np.maximum(np.sort(top[live], axis=1)[:, -min(kk, k + 1)], known[s + live])
            # d_k^2 = norm2 + |q|^2 - 2 * k-th inner product; infinite while fewer than k are verified
            far = gap[live, leaf] > stretch * (norm2 + own2[live] - 2 * kth)
            live, leaf = live[~far], leaf[~far]
            if not len(live):
                break
            for n in np.unique(leaf):
                who, there = live[leaf == n], leaves[n]
                both = np.concatenate((top[who], part[who] @ distinct[there].T), axis=1)
                names = np.concatenate((at[who], np.broadcast_to(there, (len(who), len(there)))), axis=1)
                best = np.argpartition(-both, kk - 1, axis=1)[:, :kk] if both.shape[1] > kk else np.broadcast_to(np.arange(both.shape[1]), both.shape)
                top[who], at[who] = np.take_along_axis(both, best, axis=1), np.take_along_axis(names, best, axis=1)
        for i in range(len(part)):
            have = at[i][np.isfinite(top[i])]
            score = np.einsum("ij,ij->i", distinct[have], np.broadcast_to(part[i], (len(have), q.shape[1])))
            row = [by[begin[h] : begin[h] + min(begin[h + 1] - begin[h], k + 1)] for h in have]
            names = ids[np.concatenate(row)] if row else ids[:0]
            score = np.repeat(score, [len(x) for x in row])
            other = names != query_ids[s + i]
            names, score = names[other], score[other]
            best = np.lexsort((names, -score))[:k]
            rows.append((np.full(len(best), query_ids[s + i]), np.full(len(best), rows_of[s + i]), names[best], score[best]))
    cols = [np.concatenate(c) for c in zip(*rows)] if rows else [[], [], [], []]
    return pd.DataFrame(dict(zip(("query_id", "q", "vec_id", "score"), cols)))


def _stacked(e: pd.Series) -> np.ndarray:
    return np.stack(e).astype(np.float64)


def nearest(vectors: DataFrame, queries: DataFrame, k: int, vec_id: str = "vec_id", embedding: str = "embedding", sure: float = SURE, block: int = BLOCK, fit_rows: int = FIT_ROWS, rounds: list | None = None) -> DataFrame:
    """query_id, rank (from 1), vec_id, score. queries: rows of the same shape as vectors. rounds gets, for each round, how many
    queries met how many rows: (queries, pairs)."""
    spark = vectors.sparkSession

    def usable(df: DataFrame) -> DataFrame:
        e = F.col("e")
        finite = F.forall(e, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        kind = df.schema[embedding].dataType.simpleString()
        kept = F.col(embedding) if kind in ("array<float>", "array<double>") else F.col(embedding).cast("array<double>")
        df = df.select(F.col(vec_id).cast("long").alias("id"), kept.alias("e"))
        return df.where(F.col("id").isNotNull() & e.isNotNull() & finite & F.exists(e, lambda x: x != 0))

    rows, asked = usable(vectors), usable(queries)
    norm = F.aggregate("e", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    sizes = rows.groupBy(F.size("e").alias("d")).agg(F.count("*").alias("n"), F.max(norm).alias("norm2")).orderBy(F.desc("n"), "d").limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n, norm2 = sizes[0].d, sizes[0].n, sizes[0].norm2
    rows, asked = rows.where(F.size("e") == d), asked.where(F.size("e") == d).distinct()
    kind = rows.schema["e"].dataType.simpleString()

    def low_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                yield pd.DataFrame({"low": list(projected(_stacked(pdf["e"]), norm2))})

    levels = max(0, min(ceil(log2(n / block)), int(log2(fit_rows / LEAST))))
    sample = np.zeros((0, DIMENSIONS))
    if levels:
        share = rows.where(F.pmod(F.xxhash64("id", "e"), F.lit(ceil(n / fit_rows))) == 0).select("e").limit(fit_rows)
        sample = np.array([r.low for r in share.mapInPandas(low_of, "low array<double>").collect()]).reshape(-1, DIMENSIONS)
    cells = Cells(sample, levels)

    def placed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                low = projected(_stacked(pdf["e"]), norm2)
                yield pdf.assign(cell=cells.of(low), low=list(low))

    indexed = rows.mapInPandas(placed, f"id long, e {kind}, cell int, low array<double>")
    indexed = staged(indexed.withColumn("r", F.monotonically_increasing_id()), "srs-rows")
    ends = [f(F.get("low", F.lit(i))).alias(f"{name}{i}") for i in range(DIMENSIONS) for name, f in (("a", F.min), ("b", F.max))]
    boxes = sorted(indexed.groupBy("cell").agg(F.count("*").alias("n"), *ends).collect(), key=lambda r: r.cell)
    names = np.array([r.cell for r in boxes], dtype=np.int32)
    a, b = (np.array([[r[f"{name}{i}"] for i in range(DIMENSIONS)] for r in boxes]) for name in "ab")
    stretch = chi_square_inverse(sure, DIMENSIONS)

    def next_cells(start: int, stop: int):
        """Each query with those of its cells from start to stop, by distance, that may hold a nearer vector."""

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                for s in range(0, len(pdf), 256):
                    part = pdf.iloc[s : s + 256]
                    x = _stacked(part["e"])
                    gap = _gaps(x @ _axes(d)[:-1], a, b)
                    turn = np.argsort(gap, axis=1, kind="stable")[:, start:stop]
                    far = stretch * (norm2 + np.einsum("ij,ij->i", x, x) - 2 * part["known"].to_numpy())
                    i, j = np.nonzero(np.take_along_axis(gap, turn, axis=1) <= far[:, None])
                    yield part.iloc[i].assign(cell=names[turn[i, j]])

        return run

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({"query_id": [], "q": [], "vec_id": [], "score": []})
        return search(left["id"].to_numpy(), _stacked(left["e"]), right["id"].to_numpy(), _stacked(right["e"]), k, norm2, sure, right["q"].to_numpy(), right["known"].to_numpy())

    def met(asking: DataFrame) -> DataFrame:
        """The best of each query (staged: id, e, q, cell, known) in the cells it is sent to."""
        sent = {r.cell: r.n for r in asking.groupBy("cell").agg(F.count("*").alias("n")).collect()}
        if rounds is not None:
            rounds.append((asking.select("q").distinct().count(), sum(r.n * sent.get(r.cell, 0) for r in boxes)))
        deal = [(r.cell, ceil(r.n / block), ceil(sent[r.cell] / QUERIES)) for r in boxes if r.cell in sent]
        parts = F.broadcast(spark.createDataFrame(deal, "cell int, np int, nq int"))
        span = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
        left = indexed.select("id", "e", "cell", "r").join(parts, "cell").select("id", "e", "cell", F.pmod(F.xxhash64("r"), "np").cast("int").alias("i"), span("nq").alias("j"))
        right = asking.join(parts, "cell").select("id", "e", "q", "known", "cell", span("np").alias("i"), F.pmod(F.xxhash64("q"), "nq").cast("int").alias("j"))
        return left.groupBy("cell", "i", "j").cogroup(right.groupBy("cell", "i", "j")).applyInPandas(run, "query_id long, q long, vec_id long, score double")

    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
    ranked = lambda df: df.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    schema = f"id long, e {kind}, q long, known double, cell int"
    asked = staged(asked.withColumn("q", F.monotonically_increasing_id()), "srs-queries")
    live, near, start = asked.withColumn("known", F.lit(float("-inf"))), None, 0
    while start < len(boxes):
        first, stop = start, min(len(boxes), max(1, 3 * start))
        asking = staged(live.select("id", "e", "q", "known", F.lit(0).alias("cell")).mapInPandas(next_cells(first, stop), schema), "srs-asking")
        if asking.isEmpty():
            break
        found = met(asking)
        if near is not None:
            found = found.unionByName(near.drop("rank"))
        near, start = ranked(found), stop
        if start < len(boxes):
            near = staged(near, "srs-near")
            # only queries whose last cell passed the test go on, with what they know by now
            kth = near.where(F.col("rank") == k).select("q", F.col("score").alias("known"))
            reached = asking.groupBy("q").agg(F.count("*").alias("n")).where(F.col("n") == stop - first).select("q")
            live = asked.join(reached, "q", "left_semi").join(kth, "q", "left").withColumn("known", F.coalesce("known", F.lit(float("-inf"))))
    if near is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    return near.select("query_id", "rank", "vec_id", "score")


def op8_stable_projections(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    return nearest(rows, rows.where("vec_id % 20 = 0"), 20)
