"""Nearest neighbours by a block matrix join with int8 tiles.

Queries are broadcast in blocks of bounded size; each task multiplies a block with tiles of its vectors, both rounded to
int8. With x = s c + e and the norm of e known, | |q - x| - |q' - x'| | <= |e_q| + |e_x|, so the product bounds each
distance from both sides. What may still be among a query's k nearest is computed again in double precision and kept in
a heap of k; Spark merges the heaps of all tasks. Integer products are formed by a floating-point matrix product whose
sums stay exact.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgraph.llm.common import written

#: Vectors of a tile, and queries that are multiplied with it at once: bounds what a task holds, whatever the block.
TILE, QUERIES = 2048, 1024
#: Pairs whose distances are computed at once.
PAIRS = 1 << 15


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows of doubles -> int8 codes, scale and the norm of what rounding loses, each a little on the safe side."""
    scale = np.abs(x).max(axis=1) / 127
    with np.errstate(all="ignore"):
        code = np.where(scale[:, None] > 0, np.rint(x / scale[:, None]), 0).clip(-127, 127).astype(np.int8)
    rest = x - scale[:, None] * code
    biggest = np.abs(rest).max(axis=1)  # scaled before squaring: no overflow or underflow
    safe = np.where(biggest > 0, biggest, 1)
    return code, scale, biggest * np.sqrt(((rest / safe[:, None]) ** 2).sum(axis=1)) * (1 + 1e-9)


def distances(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Euclidean, in double precision, dimension by dimension; of rows of x to q, or to rows of q. Where squares leave the
    range of doubles, differences are scaled first."""
    total = np.zeros(len(x))
    with np.errstate(over="ignore"):
        for j in range(x.shape[1]):
            d = x[:, j] - q[..., j]
            total += d * d
        out = np.sqrt(total)
        odd = np.flatnonzero(~(total < 1e300) | (total < 1e-280))
        if len(odd):
            d = np.abs(x[odd] / 2 - (q[odd] if q.ndim > 1 else q) / 2)
            top = d.max(axis=1)
            safe = np.where(top > 0, top, 1)
            out[odd] = top * np.sqrt(((d / safe[:, None]) ** 2).sum(axis=1)) * 2
    return out


class Nearest:
    """The k nearest of each query so far, by (distance, id); an id counts once, at its nearest vector."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, queries, k
        self.code, self.scale, self.err = quantised(queries)
        self.kind = np.float32 if queries.shape[1] * 127 * 127 < 1 << 24 else np.float64
        self.norm2 = (self.code.astype(np.float64) ** 2).sum(axis=1)
        self.heaps: list[list[tuple[float, int]]] = [[] for _ in ids]  # (-distance, -id): the worst first
        self.worst = np.full(len(ids), np.inf)

    def add(self, ids: np.ndarray, x: np.ndarray) -> None:
        code, scale, err = quantised(x)
        norm2, tile = (code.astype(np.float64) ** 2).sum(axis=1), code.astype(self.kind).T
        # of a tile of distinct ids alone, the k + 1 least upper bounds: its own row may be among them
        alone = len(ids) > self.k + 1 and len(np.unique(ids)) == len(ids)
        for at in range(0, len(self.ids), QUERIES):
            some = slice(at, at + QUERIES)
            with np.errstate(all="ignore"):
                # in units of the larger scale of each pair: no overflow, and what underflows is far below the slack
                unit = np.maximum(self.scale[some, None], scale[None, :])
                unit[unit == 0] = 1
                a, b = self.scale[some, None] / unit, scale[None, :] / unit
                a2, b2 = a * a * self.norm2[some, None], b * b * norm2[None, :]
                near = a2 + b2 - 2 * a * b * (self.code[some].astype(self.kind) @ tile)
                slack = self.err[some, None] + err[None, :] + 1e-7 * unit * np.sqrt(a2 + b2)
                near = unit * np.sqrt(np.maximum(near, 0))
                bound = self.worst[some]
                if alone:
                    bound = np.fmin(bound, np.partition(near + slack, self.k, axis=1)[:, self.k])
                # what is no number stays
                query, at_x = np.nonzero(~(near - slack > bound[:, None] * (1 + 1e-9)))
            query += at
            other = ids[at_x] != self.ids[query]
            self._take(query[other], at_x[other], ids, x)

    def _take(self, query: np.ndarray, at: np.ndarray, ids: np.ndarray, x: np.ndarray) -> None:
        """Candidates, by query: their distances, and the nearest into the heaps."""
        for first in range(0, len(query), PAIRS):
            q, i = query[first : first + PAIRS], at[first : first + PAIRS]
            dist = distances(x[i], self.q[q])
            ok = dist <= self.worst[q]
            q, v, dist = q[ok], ids[i][ok], dist[ok]
            by = np.lexsort((v, dist, q))
            q, v, dist = q[by], v[by], dist[by]
            starts = np.flatnonzero(np.diff(q, prepend=-1))
            for s, e in zip(starts.tolist(), [*starts[1:].tolist(), len(q)], strict=True):
                self._push(int(q[s]), dist[s:e].tolist(), v[s:e].tolist())

    def _push(self, i: int, dist: list[float], ids: list[int]) -> None:
        heap = self.heaps[i]
        have = {-v: -d for d, v in heap}
        for d, v in zip(dist, ids, strict=True):
            if len(heap) == self.k and (-d, -v) <= heap[0]:
                break  # sorted: none of the rest is nearer
            if v in have:
                if d < have[v]:
                    heap.remove((-have[v], -v))
                    heapq.heapify(heap)
                    heapq.heappush(heap, (-d, -v))
                    have[v] = d
                continue
            if len(heap) < self.k:
                heapq.heappush(heap, (-d, -v))
            else:
                have.pop(-heapq.heapreplace(heap, (-d, -v))[1])
            have[v] = d
        if len(heap) == self.k:
            self.worst[i] = -heap[0][0]


def _search(block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = {size: Nearest(ids, q, k) for size, (ids, q) in block.value.items()}
        for batch in batches:
            vecs = batch.column(1)
            flat, ends = vecs.flatten().to_numpy(zero_copy_only=False), np.diff(vecs.offsets.to_numpy())
            starts, ids = np.concatenate([[0], np.cumsum(ends)[:-1]]), batch.column(0).to_numpy()
            for size, near in by_size.items():
                rows = np.flatnonzero(ends == size)
                for at in range(0, len(rows), TILE):
                    some = rows[at : at + TILE]
                    near.add(ids[some], flat[starts[some][:, None] + np.arange(size)].astype(np.float64))
        out = [(int(q), -v, -d) for near in by_size.values() for q, heap in zip(near.ids, near.heaps, strict=True) for d, v in heap]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], t) for j, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["query_id", "vec_id", "score"])

    return run


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """(vec_id, embedding) twice -> query_id, rank, vec_id, score: each query's k nearest of the other vectors by
    Euclidean distance, nearest first, ties to the smaller vec_id; all of them, if fewer.

    Vectors that are null, zero, empty or hold a null or non-finite component take no part, nor rows without vec_id;
    vectors of another number of components than the query's are no candidates. A repeated vec_id counts once, at its
    nearest vector; of a repeated query id the smallest vector asks. Any finite components will do: distances neither
    overflow before their own value does nor vanish. Queries are taken in blocks of about block_bytes,
    each of which reads the vectors once.
    """
    spark = vectors.sparkSession

    def valid(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        return df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & finite & F.exists("v", lambda x: x != 0))

    vectors, queries = valid(vectors), valid(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    size = queries.agg(F.sum(8 * F.size("v") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    parts = []
    for i in range(n):  # one block at a time is at the driver and in the tasks
        rows = (queries if n == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i)).collect()
        by: dict[int, list] = {}
        for r in sorted(rows, key=lambda r: r.vec_id):
            by.setdefault(len(r.v), []).append(r)
        block = spark.sparkContext.broadcast({s: (np.array([r.vec_id for r in some], np.int64), np.array([r.v for r in some], np.float64)) for s, some in by.items()})
        found = vectors.mapInArrow(_search(block, k), "query_id long, vec_id long, score double")
        if n > 1:
            found = written(found, "nearest")
            block.destroy()
        parts.append(found)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    # the tasks' heaps: k rows a query and task, of which Spark keeps k a query before and after the shuffle
    found = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("score", "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op8_nearest(spark, sf_dir: str) -> DataFrame:
    """The ten nearest of each vector whose id is divisible by 100, among all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return nearest(vectors, vectors.where("vec_id % 100 = 0"))


OP8_SQL = r"""
with e as (select vec_id, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0 and len(list_filter(embedding, lambda x: x <> 0)) > 0),
p as (select q.vec_id as query_id, c.vec_id, sqrt(list_reduce(list_transform(list_zip(q.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])), lambda a, b: a + b)) as score from e q join e c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score, vec_id) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""
