"""Exact top-k search of integer inner products by MaxScore.

The terms of a query are the components of its vector. Each task holds a shard of the vectors at a time as postings by
component, with the largest and the smallest value of each, so that a query knows the most that a term can add. Terms whose
bounds together stay below the query's k-th best score are non-essential: no vector gets in by them alone. The postings of
the others are traversed; then the non-essential ones are probed, the strongest first, for the vectors that what is left to
probe can still bring in. Shards raise the same query's threshold one after the other, and Spark merges the tasks' best.

Scores are exact integers: products are formed in doubles as long as their sums stay below 2^52, in 64-bit integers as long
as they fit, else in integers of any size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgraph.llm.common import written

#: Vectors of a shard, and non-essential terms that are probed before weak vectors go.
SHARD, PROBES = 2048, 4
LOW, HIGH = -(1 << 63), (1 << 63) - 1


def components(x: np.ndarray, by: int = 1024) -> np.ndarray:
    """floor(by * x) of finite numbers, as 64-bit integers where all fit, else as integers of any size."""
    x = x.astype(np.float64)
    if not x.size or np.abs(x).max() < float(1 << 52):
        return np.floor(by * x).astype(np.int64)
    return np.array([math.floor(by * v) if abs(v) < 1 << 52 else int(v) * by for v in x.ravel().tolist()], object).reshape(x.shape)


def _largest(x: np.ndarray) -> int:
    return max(abs(int(x.max())), abs(int(x.min()))) if x.size else 0


class Shard:
    """Vectors as postings by component: values in the order of ids, and the bounds of each."""

    def __init__(self, ids: np.ndarray, x: np.ndarray):
        by = np.argsort(ids, kind="stable")
        self.ids, self.most = ids[by], _largest(x)
        self.lists = {x.dtype: np.ascontiguousarray(x[by].T)}
        self.low, self.high = ([f(column) for column in self.lists[x.dtype]] for f in (min_of, max_of))

    def postings(self, kind) -> np.ndarray:
        kind = np.dtype(kind)
        if kind not in self.lists:
            self.lists[kind] = next(iter(self.lists.values())).astype(kind)
        return self.lists[kind]


def min_of(column: np.ndarray) -> int:
    return int(column.min())


def max_of(column: np.ndarray) -> int:
    return int(column.max())


class TopK:
    """The k best of each query so far, by score, ties to the smaller id; an id counts once, at its best."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int):
        self.ids, self.q, self.k = ids, queries, k
        self.most = [_largest(q) for q in queries]
        self.best: list[list[tuple[int, int]]] = [[] for _ in ids]  # (-score, id), sorted

    def add(self, shard: Shard) -> None:
        for i in range(len(self.ids)):
            top = self.most[i] * shard.most * max(1, len(self.q[i]))
            kind = np.float64 if top < 1 << 52 else np.int64 if top < 1 << 62 else object
            rows, scores = self._found(i, shard, kind)
            if len(rows):
                self._merge(i, shard.ids[rows], scores)

    def _found(self, i: int, shard: Shard, kind) -> tuple[np.ndarray, np.ndarray]:
        """Rows of the shard that may be among the k best of query i, and their scores."""
        lists, q = shard.postings(kind), self.q[i].astype(kind)
        full = len(self.best[i]) == self.k
        least = -self.best[i][-1][0] if full else None
        low, high = (np.array(x, kind) for x in (shard.low, shard.high))
        most = np.maximum(np.maximum(q * low, q * high), 0)
        order = np.argsort(most, kind="stable")
        upto = np.cumsum(most[order]) if len(order) else np.zeros(0, kind)
        # a vector in no list of a positive share has a score of 0 at most: with such a threshold all terms are essential
        first = int((upto < least).sum()) if full and least > 0 else 0
        if full and len(order) and first == len(order):
            return np.empty(0, np.int64), np.empty(0, kind)
        essential = order[first:]
        scores = q[essential] @ lists[essential] if len(essential) else np.zeros(len(shard.ids), kind)
        rows = np.arange(len(shard.ids))
        if full:
            rows = np.flatnonzero(scores + (upto[first - 1] if first else 0) >= least)
            scores = scores[rows]
        while first and len(rows):
            some = order[max(0, first - PROBES) : first]
            first = max(0, first - PROBES)
            scores = scores + q[some] @ lists[some][:, rows]
            keep = scores + (upto[first - 1] if first else 0) >= least
            rows, scores = rows[keep], scores[keep]
        return rows, scores

    def _merge(self, i: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ok = ids != self.ids[i]
        ids, scores = ids[ok], scores[ok]
        by = np.lexsort((ids, -scores)) if scores.dtype != object else np.array(sorted(range(len(ids)), key=lambda j: (-scores[j], ids[j])), np.int64)
        best, seen = self.best[i], set()
        n = 0
        for j in by:
            pair = (-int(scores[j]), int(ids[j]))
            if n >= self.k or len(best) == self.k and pair > best[-1]:
                break  # sorted: none of the rest is better
            if pair[1] in seen:
                continue
            seen.add(pair[1])
            n += 1
            best = best + [pair]
            if len(best) > 2 * self.k:
                best = self._once(best)
        self.best[i] = self._once(best)

    def _once(self, pairs: list[tuple[int, int]]) -> list[tuple[int, int]]:
        out, seen = [], set()
        for p in sorted(pairs):
            if p[1] not in seen:
                seen.add(p[1])
                out.append(p)
        return out[: self.k]


def _search(block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_size = {size: TopK(ids, q, k) for size, (ids, q) in block.value.items()}
        for batch in batches:
            vecs, ids = batch.column(1), batch.column(0).to_numpy()
            flat, ends = vecs.flatten().to_numpy(zero_copy_only=False), np.diff(vecs.offsets.to_numpy())
            starts = np.cumsum(ends) - ends
            for size, top in by_size.items():
                rows = np.flatnonzero(ends == size)
                for at in range(0, len(rows), SHARD):
                    some = rows[at : at + SHARD]
                    top.add(Shard(ids[some], components(flat[starts[some][:, None] + np.arange(size)])))
        out = [(int(q), v, min(max(-s, LOW), HIGH)) for top in by_size.values() for q, best in zip(top.ids, top.best, strict=True) for s, v in best]
        yield pa.RecordBatch.from_arrays([pa.array([r[j] for r in out], pa.int64()) for j in range(3)], names=["query_id", "vec_id", "score"])

    return run


def top_products(vectors: DataFrame, queries: DataFrame, k: int = 10, block_bytes: int = 8 << 20) -> DataFrame:
    """(vec_id, embedding) twice -> query_id, rank, vec_id, score: of each query the k other vectors of the largest inner product
    of floor(1024 * component), best first, ties to the smaller vec_id; all of them, if fewer.

    Vectors that are null or hold a null or non-finite component take no part, nor rows without vec_id; zero vectors and empty
    ones do, with scores of 0. Vectors of another number of components than the query's are no candidates. A repeated vec_id
    counts once, at its best vector; of a repeated query id the smallest vector asks. Any finite components will do: a score
    beyond 64 bits is exact in a task and shown, and merged, as the end of their range. Queries are taken in blocks of about
    block_bytes, each of which reads the vectors once; what it computes is some thousand times what reading costs.
    """
    spark = vectors.sparkSession

    def valid(df: DataFrame) -> DataFrame:
        df = df.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("v"))
        return df.where(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))))

    vectors, queries = valid(vectors), valid(queries).groupBy("vec_id").agg(F.min("v").alias("v"))
    size = queries.agg(F.sum(8 * F.size("v") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    parts = []
    for i in range(n):  # one block at a time is at the driver and in the tasks
        by: dict[int, list] = {}
        for r in sorted((queries if n == 1 else queries.where(F.pmod(F.xxhash64("vec_id"), F.lit(n)) == i)).collect(), key=lambda r: r.vec_id):
            by.setdefault(len(r.v), []).append(r)
        block = spark.sparkContext.broadcast({s: (np.array([r.vec_id for r in some], np.int64), components(np.array([r.v for r in some], np.float64).reshape(len(some), s))) for s, some in by.items()})
        found = vectors.mapInArrow(_search(block, k), "query_id long, vec_id long, score long")
        if n > 1:
            found = written(found, "products")
            block.destroy()
        parts.append(found)
    found = parts[0]
    for p in parts[1:]:
        found = found.union(p)
    # k rows a query and task, of which Spark keeps k a query before and after the shuffle
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op12_top_products(spark, sf_dir: str) -> DataFrame:
    """The ten largest inner products of each vector whose id is divisible by 100, among all others."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")
    return top_products(vectors, vectors.where("vec_id % 100 = 0"))


OP12_SQL = r"""
with e as (select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v from embeddings
  where vec_id is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
p as (select q.vec_id as query_id, c.vec_id, cast(coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])), 0) as bigint) as score from e q join e c on q.vec_id <> c.vec_id and len(q.v) = len(c.v) where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from p)
select query_id, cast(rank as integer) as rank, vec_id, score from r where rank <= 10
"""
