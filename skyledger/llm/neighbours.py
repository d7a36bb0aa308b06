"""Nearest neighbours by collision-counting hashing (operator 5).

Nearness is the largest inner product. With one more coordinate, sqrt(M^2 - |x|^2) for a vector and
0 for a query (M: the largest norm), the largest inner product is the smallest distance.

The vectors are dealt by hash to shards of bounded size. In a shard each of TABLES random
projections gives one sorted array. Around a query's own projection a window is opened in every
array; virtual rehashing widens all windows together, by a factor STEP a round, and only what came
into a window is counted anew. A vector found in at least THRESHOLD of the arrays is verified: its
inner product is computed in double precision on the original vectors. A query ends when it has k
verified vectors within the radius its windows stand for; a vector at that very distance is in one
window with probability 0.83, so it is missed where it is in fewer than 17 of 24 (7 %; nearer ones less). Nothing
else ends a query, and with windows that hold everything all vectors are verified.

Queries go against the shards in blocks. Each shard's k best for a query are merged.

Defined results: vectors that are null, zero, or hold null or non-finite components take no part,
nor do rows with a null vec_id; queries meet vectors of their own dimension only; repeated rows are
candidates each; equal scores go to the smaller vec_id; a query with fewer candidates than k gets all.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from skyledger.llm.common import register, staged, table

K = 20
TABLES = 24
WIDTH = 2.719                   # window width at radius 1
THRESHOLD = 17
STEP = 1.2
SHARD_ROWS = 32_768
QUERY_ROWS = 512


class SortedProjections:
    """The sorted arrays of one shard."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, norm: float, seed: int = 5):
        self.ids, self.vectors, self.norm = ids, vectors, norm
        lines = np.random.default_rng(seed).standard_normal((vectors.shape[1] + 1, TABLES))
        rest = np.sqrt(np.maximum(norm * norm - (vectors * vectors).sum(axis=1), 0.0))
        values = vectors @ lines[:-1] + rest[:, None] * lines[-1]
        self.lines = lines[:-1]
        order = np.argsort(values, axis=0, kind="stable")
        self.order = np.ascontiguousarray(order.T)
        self.values = np.ascontiguousarray(np.take_along_axis(values, order, axis=0).T)
        # all arrays as one, each moved beyond the one before, so that one search finds all window ends
        self.shift = np.arange(TABLES) * (4 * float(np.abs(values).max(initial=0.0)) + 1.0)
        self.reach = self.shift[1] / 2 - 0.25
        self.row = np.arange(TABLES) * len(ids)
        self.one = (self.values + self.shift[:, None]).reshape(-1)
        self.flat_order = self.order.reshape(-1)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int = K) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query number, candidate rows, scores) of the k best, nearest first."""
        at = queries @ self.lines
        for i, query in enumerate(queries):
            yield (i, *self._one(query_ids[i], query, at[i], k))

    def _one(self, own: int, query: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.ids)
        counts = np.zeros(n, np.int64)
        verified = np.zeros(n, bool)
        others = int((self.ids != own).sum())
        wanted = min(k, others)
        rows, last = np.zeros(0, np.int64), -np.inf
        if not wanted:
            return rows, np.zeros(0)
        products = self.vectors @ query                            # looked at for verified vectors only
        margin = 1e-9 * self.norm * float(np.sqrt(query @ query))
        at = np.clip(at, -self.reach, self.reach)                  # beyond the arrays' ends windows hold the same
        low = np.searchsorted(self.one, at + self.shift)
        low = np.clip(low, self.row, self.row + n)
        high = low.copy()
        base = float(query @ query) + self.norm * self.norm
        radius = self._first_radius(at, low - self.row, wanted)
        while True:
            half = min(WIDTH * radius / 2, self.reach)
            lo = np.minimum(np.maximum(np.searchsorted(self.one, at - half + self.shift), self.row), low)
            hi = np.maximum(np.minimum(np.searchsorted(self.one, at + half + self.shift, "right"), self.row + n), high)
            if WIDTH * radius / 2 >= 2 * self.reach:               # windows that hold everything
                lo, hi = self.row, self.row + n
            parts = [self.flat_order[a:b] for a, b in zip(lo.tolist(), low.tolist(), strict=True) if a < b]
            parts += [self.flat_order[a:b] for a, b in zip(high.tolist(), hi.tolist(), strict=True) if a < b]
            low, high = lo, hi
            if parts:
                counts += np.bincount(np.concatenate(parts), minlength=n)
            fresh = np.flatnonzero((counts >= THRESHOLD) & ~verified)
            if len(fresh):
                verified[fresh] = True
                rows = np.r_[rows, fresh[self.ids[fresh] != own]]
                if len(rows) >= wanted:                            # those that may still be among the k best
                    last = np.partition(products[rows], len(rows) - wanted)[len(rows) - wanted]
                    rows = rows[products[rows] >= last - margin]
            if len(rows) >= wanted and base - 2 * last <= radius * radius or int((high - low).sum()) == n * TABLES:
                # the exact scores, each summed in the same way, so that equal vectors have equal ones
                scores = np.einsum("ij,j->i", self.vectors[rows], query)
                keep = np.lexsort((self.ids[rows], -scores))[:k]
                return rows[keep], scores[keep]
            radius *= STEP

    def _first_radius(self, at: np.ndarray, low: np.ndarray, wanted: int) -> float:
        """A radius at which the middle one of the windows holds a fifth of the vectors."""
        table, some = np.arange(TABLES), max(wanted, len(self.ids) // 10)
        left = np.abs(self.values[table, np.maximum(low - some, 0)] - at)
        right = np.abs(self.values[table, np.minimum(low + some, len(self.ids) - 1)] - at)
        return max(2 * float(np.median(np.minimum(left, right))) / WIDTH, 1e-6 * self.norm)


def usable(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, vector, dim, square) of the rows that take part."""
    v = F.col("vector")
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).filter(
        F.col("vec_id").isNotNull() & v.isNotNull())
    rows = rows.filter(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))))
    rows = rows.withColumn("dim", F.size(v)).withColumn("square", F.aggregate(v, F.lit(0.0), lambda a, x: a + x * x))
    return rows.filter("square > 0")


def _packed(rows: DataFrame, block: Column, name: str) -> DataFrame:
    """One row per (dim, block): ids and vectors as bytes."""
    def pack(part: pd.DataFrame) -> pd.DataFrame:
        ids = part["vec_id"].to_numpy(np.int64)
        order = np.argsort(ids, kind="stable")
        matrix = np.array(part["vector"].to_list(), np.float64)[order]
        return pd.DataFrame({"dim": [int(part["dim"].iloc[0])], name: [int(part[name].iloc[0])], "ids": [ids[order].tobytes()], "matrix": [matrix.tobytes()]})

    return rows.withColumn(name, block.cast("long")).select("dim", name, "vec_id", "vector").groupBy("dim", name).applyInPandas(
        pack, f"dim int, {name} long, ids binary, matrix binary")


def nearest(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found for every row of `vectors` (vec_id, embedding) that `is_query` holds for."""
    rows = usable(vectors)
    # one row per dimension: how many blocks, and the largest norm
    sizes = rows.groupBy("dim").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(SHARD_ROWS)).cast("long").alias("shards"),
        F.greatest(F.lit(1), F.ceil(F.count(F.when(is_query, 1)) / F.lit(QUERY_ROWS))).cast("long").alias("blocks"),
        F.sqrt(F.max("square")).alias("norm"))
    sizes = staged(sizes, "vector-sizes")
    sized = rows.join(sizes, "dim")
    shards = staged(_packed(sized, F.pmod(F.xxhash64("vec_id", "vector"), F.col("shards")), "shard"), "vector-shards")
    queries = staged(_packed(sized.filter(is_query), F.pmod(F.xxhash64("vec_id", "vector"), F.col("blocks")), "block"), "vector-queries")
    asked = shards.join(sizes, "dim").select("dim", "shard", "norm", "ids", "matrix", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    asked = asked.repartition("dim", "shard", "block").join(
        queries.select("dim", "block", F.col("ids").alias("query_ids"), F.col("matrix").alias("query_matrix")), ["dim", "block"])
    asked = asked.select("dim", "shard", "norm", "ids", "matrix", "query_ids", "query_matrix")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, held = None, None
        for batch in batches:
            for r in range(batch.num_rows):
                dim, shard, norm, ids, matrix, query_ids, query_matrix = (batch.column(c)[r] for c in range(7))
                dim = dim.as_py()
                if held != (dim, shard.as_py()):
                    index = SortedProjections(np.frombuffer(ids.as_buffer(), np.int64), np.frombuffer(matrix.as_buffer()).reshape(-1, dim), norm.as_py())
                    held = (dim, shard.as_py())
                asked_ids = np.frombuffer(query_ids.as_buffer(), np.int64)
                found = [(np.full(len(rows), asked_ids[i]), index.ids[rows], scores)
                         for i, rows, scores in index.search(asked_ids, np.frombuffer(query_matrix.as_buffer()).reshape(-1, dim), k)]
                if found:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], ["query_id", "vec_id", "score"])

    found = asked.mapInArrow(run, "query_id long, vec_id long, score double")
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", place.cast("int")).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@register("op5_collision_counting_neighbours")
def op5_collision_counting_neighbours(spark, sf_dir):
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
