"""Exact top-k search by inner product: Fagin's threshold algorithm.

Vectors are scaled and floored to integers. They are dealt into blocks by a
hash of their id; a block keeps one sorted list per dimension. A query goes
down all lists at once, each from its favourable end (the largest values where
its component is positive, the smallest where it is negative). What it meets
is scored exactly (random access); after each step, the sum over dimensions of
query component times value at the present depth bounds every vector not met
so far. The query leaves the block as soon as that bound cannot beat its kth
result: a bound equal to the kth score goes on, since a tie may have a smaller
id.

All blocks of a query share one first bound: its kth score within a pilot of
``PILOT`` vectors (any subset gives a valid lower bound). So a cell (block of
vectors, block of queries) starts with a good kth score, ends its descents
early, and returns only what may be in the result. Cells are bounded tasks;
the k best of all cells are the result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8_192
QUERIES = 8_192
PILOT = 2_048
#: list entries that a descent reads per step, as a part of the list
STEPS = 32
#: largest component after scaling: inner products stay within 64 bits
LIMIT = 1 << 23
_NONE = np.iinfo(np.int64).min


class ThresholdIndex:
    """Sorted lists per dimension over the distinct vectors of a block."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vecs = ids[order], np.ascontiguousarray(vecs[order])
        raw = vecs.view(np.dtype((np.void, vecs.dtype.itemsize * vecs.shape[1]))).ravel()
        _, first, group = np.unique(raw, return_index=True, return_inverse=True)
        by = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group))
        # of equal vectors only the k + 1 smallest ids can be in a result
        self.ids = [np.unique(ids[by[a:b]])[:k + 1] for a, b in zip(np.append(0, ends[:-1]), ends)]
        self.vecs = vecs[first]
        n, dim = self.vecs.shape
        # double precision is exact below 2^53, and fast
        top = int(np.abs(self.vecs).max(initial=0))
        self.kind = np.float64 if dim * top * LIMIT < 1 << 53 else np.int64
        self.rows = self.vecs.astype(self.kind)
        self.down = np.argsort(-self.vecs, axis=0, kind="stable").T.copy()  # best first for positive components
        self.up = self.down[:, ::-1]
        # depths at which a descent looks at its bound, and the values there
        self.depths = np.unique(np.linspace(0, n, min(n, STEPS) + 1).astype(int))[1:]
        at = self.depths - 1
        rows = np.arange(dim)[:, None]
        self.high = self.rows[self.down[:, at], rows]
        self.low = self.rows[self.up[:, at], rows]

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """For each query and step the most that a vector not met can score."""
        q = queries.astype(self.kind)
        return np.maximum(q, 0) @ self.high + np.minimum(q, 0) @ self.low

    def search(self, query: np.ndarray, own: int, k: int, bounds: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Ids and scores of the k best of at least ``floor``, without the
        query's own id, and the depth at which the descent ended."""
        met = np.zeros(len(self.vecs), bool)
        dims = np.flatnonzero(query)  # a zero component adds nothing, whatever its list holds
        lists = np.where((query[dims] > 0)[:, None], self.down[dims], self.up[dims]) if len(dims) else self.down[:1]
        q = query.astype(self.kind)
        ids, scores, kth, depth = np.zeros(0, np.int64), np.zeros(0, np.int64), floor, 0
        for step, to in enumerate(self.depths.tolist()):
            here = np.zeros(len(met), bool)
            here[lists[:, depth:to].ravel()] = True
            fresh = np.flatnonzero(here & ~met)
            met[fresh] = True
            depth = to
            if len(fresh):
                score = (self.rows[fresh] @ q).astype(np.int64)
                fresh, score = fresh[score >= kth], score[score >= kth]
                more = [self.ids[i] for i in fresh]
                if more:
                    ids = np.concatenate([ids, *more])
                    scores = np.concatenate([scores, np.repeat(score, [len(x) for x in more])])
                    ids, scores = _best(ids, scores, own, k)
                    if len(ids) == k:
                        kth = max(kth, int(scores[-1]))
            if bounds[step] < kth:
                break
        return ids, scores, depth


def _best(ids: np.ndarray, scores: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k best, each id once with its best score, without ``own``."""
    order = np.lexsort((-scores, ids))
    order = order[np.append(True, ids[order][1:] != ids[order][:-1]) & (ids[order] != own)]
    order = order[np.argsort(-scores[order], kind="stable")][:k]
    return ids[order], scores[order]


def _cell(k: int):
    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        ids = table.column("vec_id").to_numpy()
        floors = table.column("floor").to_numpy()
        vecs = table.column("v").combine_chunks()
        vecs = (vecs.chunk(0) if isinstance(vecs, pa.ChunkedArray) else vecs).flatten().to_numpy().reshape(len(ids), -1)
        out = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if (role == 0).any() and (role == 1).any():
            index = ThresholdIndex(ids[role == 0], vecs[role == 0], k)
            asked = vecs[role == 1]
            for i in range(0, len(asked), 512):
                part = asked[i:i + 512]
                for q, b, own, floor in zip(part, index.bounds(part), ids[role == 1][i:i + 512].tolist(),
                                            floors[role == 1][i:i + 512].tolist()):
                    near, score, _ = index.search(q, own, k, b, floor)
                    out[0].append(np.full(len(near), own, np.int64))
                    out[1].append(near)
                    out[2].append(score)
        return pa.table(dict(zip(("query_id", "vec_id", "score"), map(np.concatenate, out))))

    return run


def _cells(rows: DataFrame, asked: DataFrame, k: int, block: int, n_blocks: int, n_asked: int) -> DataFrame:
    """query_id, vec_id, score: the k best of each cell."""
    def deal(name, n):
        return F.pmod(F.xxhash64(F.lit(name), "vec_id"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = rows.select(deal("row", n_blocks).alias("a"), every(n_asked).alias("b"), "dim", F.lit(0).alias("role"),
                       "vec_id", F.lit(_NONE).alias("floor"), "v")
    asked = asked.select(every(n_blocks).alias("a"), deal("query", n_asked).alias("b"), "dim", F.lit(1).alias("role"),
                         "vec_id", "floor", "v")
    return (rows.unionByName(asked).groupBy("a", "b", "dim")
            .applyInArrow(_cell(k), "query_id long, vec_id long, score long")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score")))


def _ranked(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 10, scale: float = 1024.0, id_col: str = "vec_id",
                 vec_col: str = "embedding", block: int = BLOCK, pilot: int = PILOT) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: for each query exactly the k
    vectors of largest inner product of ``floor(scale * x)``, ties to the
    smaller id.

    A query's own id is no candidate. Null vectors, rows with a null id, and
    vectors with null or non-finite components, or with one of ``LIMIT`` or
    more after scaling (their products could leave 64 bits), take no part,
    neither as queries nor as candidates; only vectors of a query's dimension
    are candidates. Fewer candidates than k: all of them. Rows that repeat an
    id count once, with their best score. Other columns are not read; an empty
    table gives an empty table."""
    def clean(df):
        whole = F.transform(df[vec_col].cast("array<double>"), lambda x: F.floor(F.lit(scale) * x))
        near = F.forall(df[vec_col].cast("array<double>"), lambda x: F.coalesce(
            ~F.isnan(x) & (F.abs(x) < F.lit(LIMIT / scale)), F.lit(False)))
        fine = df[vec_col].isNotNull() & (F.size(df[vec_col]) > 0) & near
        return (df.where(F.coalesce(fine, F.lit(False)) & df[id_col].isNotNull())
                .select(df[id_col].cast("long").alias("vec_id"), whole.alias("v")).withColumn("dim", F.size("v")))

    rows, asked = clean(vectors), clean(queries)
    n_blocks = max(1, -(-rows.count() // block))
    n_asked = max(1, -(-asked.count() // QUERIES))
    # any subset of the candidates gives a lower bound of the kth score
    first = rows.orderBy(F.xxhash64(F.lit("pilot"), "vec_id"), "vec_id").limit(pilot)
    floors = (_ranked(_cells(first, asked.withColumn("floor", F.lit(_NONE)), k, pilot, 1, n_asked), k)
              .where(F.col("rank") == k).select(F.col("query_id").alias("vec_id"), F.col("score").alias("floor")))
    asked = asked.join(floors, "vec_id", "left").withColumn("floor", F.coalesce("floor", F.lit(_NONE)))
    found = _cells(rows, asked, k, block, n_blocks, n_asked)
    return _ranked(found, k).select("query_id", "rank", "vec_id", "score")
