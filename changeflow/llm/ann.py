"""Approximate nearest neighbours by collision-counting hashing.

Vectors are dealt into blocks of about ``BLOCK`` rows by a hash of their id;
each block is an index of its own. Its hash tables are ``TABLES`` single
random projections, each a sorted array. A query is not hashed into fixed
buckets: in every array a window is opened around the query's own projection
and widened from round to round by the factor ``RATIO`` (virtual rehashing).
A vector that falls into the windows of ``LEAST`` or more arrays collides
often enough to be verified by its exact cosine. A query's rounds end when
``share`` of the block (and at least k vectors) are verified; with a share of
1 the windows open until every vector is, and the search is exact.

Every vector is indexed. The queries, a stated set, meet the blocks in blocks
of ``QUERIES`` (a cell of data block and query block is one bounded task);
each cell returns a query's k best, and the k best of all cells are the
result. Equal vectors of a block are searched as one and expand to their
smallest ids, so a very common vector costs one row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8_192
QUERIES = 512
TABLES = 64
LEAST = 44
RATIO = 1.3
START = 1.1
SHARE = 0.25
SEED = 3


def usable(vec) -> F.Column:
    """Not null, not zero, without null or non-finite components."""
    top = F.lit(float("inf"))
    fine = F.forall(vec, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < top), F.lit(False)))
    return F.coalesce(fine & F.exists(vec, lambda x: x != 0), F.lit(False))


class BlockIndex:
    """Sorted single-projection arrays over the distinct vectors of a block."""

    def __init__(self, ids: np.ndarray, vecs: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        ids, vecs = ids[order], np.ascontiguousarray(vecs[order])
        raw = vecs.view(np.dtype((np.void, vecs.dtype.itemsize * vecs.shape[1]))).ravel()
        _, first, group = np.unique(raw, return_index=True, return_inverse=True)
        by = np.argsort(group, kind="stable")
        ends = np.cumsum(np.bincount(group))
        # of equal vectors only the k + 1 smallest ids can be in a result
        self.ids = [np.unique(ids[by[a:b]])[:k + 1] for a, b in zip(np.append(0, ends[:-1]), ends)]
        # vectors beyond one of each id: so many of the best may be of ids that count already
        self.repeated = sum(map(len, self.ids)) - len(np.unique(np.concatenate(self.ids)))
        self.vecs = vecs[first]
        self.norms = _norm(self.vecs)
        self.planes = np.random.default_rng(SEED).normal(size=(vecs.shape[1], TABLES))
        values = (self.vecs / self.norms[:, None]) @ self.planes
        self.order = np.argsort(values, axis=0, kind="stable").T.copy()
        self.sorted = np.take_along_axis(values, self.order.T, 0).T.copy()

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, share: float = SHARE) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each query the ids and cosines of the k nearest found, without
        its own id."""
        n, norms = len(self.vecs), _norm(queries)
        centres = ((queries / norms[:, None]) @ self.planes).T.copy()
        enough = min(n, max(k + 1, int(np.ceil(share * n))))
        hits = np.zeros((len(queries), n), np.int16)
        middle = np.stack([np.searchsorted(s, c) for s, c in zip(self.sorted, centres)], axis=1)
        left, right = middle, middle.copy()
        out: list = [None] * len(queries)
        active, width = np.arange(len(queries)), START
        while len(active):
            # the windows of this round, in every array, for all open queries
            lo = np.stack([np.searchsorted(s, c[active] - width / 2) for s, c in zip(self.sorted, centres)], axis=1)
            hi = np.stack([np.searchsorted(s, c[active] + width / 2) for s, c in zip(self.sorted, centres)], axis=1)
            lo, hi = np.minimum(lo, left[active]), np.maximum(hi, right[active])
            still = []
            for q, a, b, c, d in zip(active.tolist(), lo.tolist(), left[active].tolist(), right[active].tolist(),
                                     hi.tolist()):
                fresh = [o[x:y] for o, x, y in zip(self.order, a, b)] + [o[x:y] for o, x, y in zip(self.order, c, d)]
                hits[q] += np.bincount(np.concatenate(fresh), minlength=n).astype(np.int16)
                found = np.flatnonzero(hits[q] >= LEAST)
                whole = not any(a) and min(d) == n
                if whole or len(found) >= enough:
                    out[q] = self._verified(np.arange(n) if whole else found, queries[q], norms[q], own[q], k)
                else:
                    still.append(q)
            left[active], right[active] = lo, hi
            active, width = np.array(still, np.int64), width * RATIO
        return out

    def _verified(self, found, query, norm, own, k) -> tuple[np.ndarray, np.ndarray]:
        cosine = _cosine(self.vecs[found], self.norms[found], query, norm)
        spare = k + 1 + self.repeated
        if len(found) > spare:  # ties of the last place stay
            last = np.partition(cosine, len(found) - spare)[len(found) - spare]
            found, cosine = found[cosine >= last], cosine[cosine >= last]
        ids = np.concatenate([self.ids[i] for i in found])
        score = np.repeat(cosine, [len(self.ids[i]) for i in found])
        best = np.lexsort((-score, ids))  # an id with several vectors counts once, with its best
        best = best[np.append(True, ids[best][1:] != ids[best][:-1])[:len(best)] & (ids[best] != own)]
        best = best[np.argsort(-score[best], kind="stable")][:k]
        return ids[best], score[best]


def _norm(v: np.ndarray) -> np.ndarray:
    """Lengths, without overflow or underflow of the squares."""
    top = np.abs(v).max(1)
    return top * np.sqrt(((v / top[:, None]) ** 2).sum(1))


def _cosine(vecs, norms, query, norm) -> np.ndarray:
    # a sum per row, so that equal vectors get equal scores
    return ((vecs / norms[:, None]) * (query / norm)).sum(1)


def _cell(k: int, share: float):
    def run(table: pa.Table) -> pa.Table:
        role = table.column("role").to_numpy()
        ids = table.column("vec_id").to_numpy()
        flat = table.column("v").combine_chunks()
        vecs = flat.flatten().to_numpy().reshape(len(ids), -1)
        out = [], [], []
        if (role == 0).any():
            index = BlockIndex(ids[role == 0], vecs[role == 0], k)
            own = ids[role == 1]
            for own, (near, score) in zip(own.tolist(), index.search(vecs[role == 1], own, k, share)):
                out[0].append(np.full(len(near), own, np.int64))
                out[1].append(near)
                out[2].append(score)
        whole = [np.concatenate(x) if x else np.zeros(0) for x in out]
        return pa.table({"query_id": pa.array(whole[0], pa.int64()), "vec_id": pa.array(whole[1], pa.int64()),
                         "score": pa.array(whole[2], pa.float64())})

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
            vec_col: str = "embedding", share: float = SHARE) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k nearest found of each
    query by cosine (double precision), ties to the smaller id. ``share``: the
    part of a block that a search verifies at least; 1 is exact.

    A query's own id is no candidate. Vectors that are null, zero or hold null
    or non-finite components, and rows with a null id, take no part, neither as
    queries nor as candidates; only vectors of a query's dimension are
    candidates. Fewer candidates than k: all of them. Rows that repeat an id
    count once, with their best score. Other columns are not read; an empty
    table gives an empty table."""
    def clean(df):
        return (df.where(usable(df[vec_col]) & df[id_col].isNotNull())
                .select(df[id_col].cast("long").alias("vec_id"), df[vec_col].cast("array<double>").alias("v"))
                .withColumn("dim", F.size("v")))

    rows, asked = clean(vectors), clean(queries)
    n_blocks = max(1, -(-rows.count() // BLOCK))
    n_asked = max(1, -(-asked.count() // QUERIES))

    def deal(name, n):
        return F.pmod(F.xxhash64(F.lit(name), "vec_id"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    rows = rows.select(deal("row", n_blocks).alias("a"), every(n_asked).alias("b"), "dim", F.lit(0).alias("role"), "vec_id", "v")
    asked = asked.select(every(n_blocks).alias("a"), deal("query", n_asked).alias("b"), "dim", F.lit(1).alias("role"), "vec_id", "v")
    found = (rows.unionByName(asked).groupBy("a", "b", "dim")
             .applyInArrow(_cell(k, share), "query_id long, vec_id long, score double"))
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    w = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
