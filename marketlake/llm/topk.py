"""Exact top-k search by inner product over an impact-ordered index.

Vectors are integers. Candidates are cut into blocks by a hash of their id and
queries into groups of their own; one task holds one block and one group, so
memory has a bound whatever the number of vectors. A block is indexed once for
a group of up to ``QUERIES`` queries (smaller groups only while blocks are too
few to keep all cores busy): per dimension the vectors stand in order of their
quantised component, so equal levels form posting segments.

A query takes segments score at a time: all segments whose quantised impact
reaches a falling threshold, over all dimensions. An accumulator has what a
vector has scored so far; what it may still gain is bounded by the sum of the
largest impacts that each dimension has left. Vectors whose upper bound is
below the k-th best lower bound are out by proof. When few possible members
remain, or segments run out, the members are rescored exactly.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import col

SCALE = 1024
CANDIDATES, QUERIES = 16384, 8192
LEAST_QUERIES = 512  # a smaller group isn't worth another index of its block
LEVELS, ROUNDS = 64, 3


class Index:
    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        n, dims = vectors.shape
        spread = int(vectors.max() - vectors.min()) if vectors.size else 0
        self.shift = max(0, spread.bit_length() - (LEVELS - 1).bit_length())
        self.levels = vectors >> self.shift
        self.order = np.argsort(self.levels, axis=0, kind="stable").T.copy()  # per dimension, by rising level
        self.sorted = np.take_along_axis(self.levels.T, self.order, axis=1)

    def search(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the best ``k`` vectors whose id isn't ``own``; ties to the smaller id."""
        n, dims = self.vectors.shape
        width = 1 << self.shift
        slack = int(np.abs(query).sum()) * (width - 1)  # most that quantising hides
        up = query > 0
        top = np.where(up, self.sorted[:, -1], self.sorted[:, 0]) * query * width
        low = np.where(up, self.sorted[:, 0], self.sorted[:, -1]) * query * width
        top -= low  # impacts count from the dimension's smallest
        acc = np.zeros(n, np.int64)
        done = np.zeros(dims, np.int64)  # postings taken, from the end that scores most
        step = int(top.max()) // ROUNDS + 1
        out = self.ids == own
        members = np.flatnonzero(~out)
        for r in range(1, ROUNDS + 1):
            if len(members) <= 4 * k:
                break
            floor = max(0, int(top.max()) - r * step)
            left = np.zeros(dims, np.int64)
            for d in np.flatnonzero(query):
                q = int(query[d]) * width
                levels = self.sorted[d]
                base = int(low[d])
                if q > 0:  # impact >= floor: level >= (floor + base) / q
                    at = int(np.searchsorted(levels, -((-(floor + base)) // q), side="left"))
                    ids, vals = self.order[d, at : n - done[d]], levels[at : n - done[d]]
                    done[d] = n - at
                    left[d] = int(levels[at - 1]) * q - base if at else 0
                else:  # level <= (floor + base) / q, rounded down
                    at = int(np.searchsorted(levels, (floor + base) // q, side="right"))
                    ids, vals = self.order[d, done[d] : at], levels[done[d] : at]
                    done[d] = at
                    left[d] = int(levels[at]) * q - base if at < n else 0
                if len(ids):
                    acc[ids] += vals * q - base
            best = acc[members]
            bound = np.partition(best, len(best) - k)[len(best) - k] if len(best) > k else best.min(initial=0)
            members = members[best + int(left.sum()) + slack >= bound]
        scores = self.vectors[members] @ query
        pick = np.lexsort((self.ids[members], -scores))[:k]
        return self.ids[members[pick]], scores[pick]


def _cell(k: int):
    kind = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return kind.empty_table()
        mat = lambda t: t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1)
        index = Index(left.column("id").to_numpy(), mat(left))
        parts = []
        for own, q in zip(right.column("id").to_pylist(), mat(right)):
            ids, scores = index.search(q, own, k)
            parts.append((np.full(len(ids), own), ids, scores))
        cols = [np.concatenate(c).astype(np.int64) for c in zip(*parts)]
        return pa.Table.from_arrays([pa.array(c) for c in cols], schema=kind)

    return run


def query_groups(queries: int, blocks: int, cores: int) -> int:
    """Groups that the queries are cut into: at most ``QUERIES`` in each (on average), more groups where blocks leave cores idle."""
    idle = min(-(-queries // LEAST_QUERIES), -(-cores // blocks))
    return max(1, -(-queries // QUERIES), idle)


def top_k(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", every: int = 100, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` best of each query, the vectors whose id divides by ``every``.

    Null vectors, vectors that hold a null or a non-finite component, empty ones
    and null ids take no part. Repeated rows count once. Vectors score against
    those of their own length. No vectors, or no query, give no rows.
    """
    raw = vectors.select(col(id_col).cast("long").alias("id"), col(vec_col).cast("array<double>").alias("x"))
    fine = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    ok = raw.where(F.col("id").isNotNull() & F.col("x").isNotNull() & (F.size("x") > 0) & F.coalesce(fine, F.lit(False)))
    ints = ok.select("id", F.transform("x", lambda x: F.floor(x * SCALE).cast("long")).alias("v"))
    ints = ints.dropDuplicates().withColumn("d", F.size("v"))
    n = ints.agg(F.count(F.lit(1)), F.count(F.when(F.col("id") % every == 0, 1))).first()
    blocks = max(1, -(-n[0] // CANDIDATES))
    groups = query_groups(n[1], blocks, vectors.sparkSession.sparkContext.defaultParallelism)
    at = F.xxhash64("id")
    queries = ints.where(F.col("id") % every == 0)
    left = ints.withColumn("b", F.pmod(at, F.lit(blocks))).withColumn("g", F.explode(F.expr(f"sequence(0L, {groups - 1}L)")))
    right = queries.withColumn("g", F.pmod(at, F.lit(groups))).withColumn("b", F.explode(F.expr(f"sequence(0L, {blocks - 1}L)")))
    found = left.groupBy("d", "b", "g").cogroup(right.groupBy("d", "b", "g")).applyInArrow(
        _cell(k), "query_id long, vec_id long, score long")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
