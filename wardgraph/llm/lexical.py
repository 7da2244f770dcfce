"""Ranked lexical search with blocks of similar documents in each term's posting list.

One pass over the texts keeps, for each document, how often the terms of the query items occur in it. The search then takes a
shard of documents at a time. The posting list of a term is clustered: some of its documents are representatives, each of the
others goes to the one most similar to it, and clusters are cut into blocks. A block stores the maximum of each coordinate, that
is of each term's share in a score, over its documents, so weights times summary bound the scores of all of them.

A query takes its lists from the strongest term on. A document without the terms of the lists before can score no more than
the other terms give, so those alone count in a block's bound, and the query ends once they cannot reach its k-th score. A
block is skipped only if its bound is below that score, or equal with larger ids alone. Documents of the other blocks are
scored exactly. Lists are clustered when a query first needs them.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgraph.llm.common import written

#: In UTF-8 every byte of a character beyond ASCII is 0x80 or more.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
#: Documents of a shard, documents of a block, coordinates of the sketch that similarity is measured on.
SHARD, BLOCK, SKETCH = 4096, 32, 64
#: Distinct terms of the queries that are searched together, and cells of a list's summaries; a list with more has no blocks
#: and is scored whole.
TERMS, CELLS = 16_384, 1 << 22


def terms_of(text: bytes) -> list[bytes]:
    """Runs of letters, digits and whatever is beyond ASCII, with A-Z in lower case (bytes know no other)."""
    return TERM.findall(text.lower())


def _texts(column: pa.Array) -> pa.Array:
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary())


def _counted(vocabulary, kind: pa.DataType):
    """Documents with a term -> doc_id, number of terms, ids and counts of those in the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for batch in batches:
            texts, keep, size, ids, counts, ends = _texts(batch.column(1)), [], [], [], [], [0]
            for i in range(batch.num_rows):
                found = terms_of(texts[i].as_py() or b"")
                if not found:
                    continue
                keep.append(i)
                size.append(len(found))
                for term, n in Counter(found).items():
                    at = known.get(term)
                    if at is not None:
                        ids.append(at)
                        counts.append(n)
                ends.append(len(ids))
            ends = pa.array(ends, pa.int32())
            columns = [batch.column(0).take(pa.array(keep, pa.int64())).cast(kind), pa.array(size, pa.int64()), pa.ListArray.from_arrays(ends, pa.array(ids, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(counts, pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    return run


def _ranges(start: np.ndarray, n: np.ndarray) -> np.ndarray:
    """start[0], ... start[0] + n[0] - 1, start[1], ..."""
    return np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))


class Shard:
    """Some documents by document and by term, with the blocks of the lists that queries ask for."""

    def __init__(self, ids: np.ndarray, ends: np.ndarray, terms: np.ndarray, shares: np.ndarray, weights: np.ndarray):
        self.ids, self.start, self.n = ids, ends[:-1], np.diff(ends)
        self.terms, self.shares = terms, shares
        self.rows = np.repeat(np.arange(len(ids)), self.n)
        by = np.argsort(terms, kind="stable")
        self.known, first = np.unique(terms[by], return_index=True)
        self.lists = np.split(self.rows[by], first[1:])
        self.most = np.maximum.reduceat(shares[by], first) if len(first) else np.empty(0, np.int64)
        # a sketch: each term goes to one coordinate, with a sign
        mixed = (terms.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        signed = np.where(mixed >> np.uint64(20) & np.uint64(1) == 0, 1.0, -1.0) * shares * weights[terms]
        sketch = np.bincount(self.rows * SKETCH + (mixed >> np.uint64(58)).astype(np.int64), signed, len(ids) * SKETCH).reshape(-1, SKETCH)
        self.sketch = (sketch / np.maximum(np.sqrt((sketch**2).sum(axis=1, keepdims=True)), 1e-9)).astype(np.float32)
        self.least = ids.min() if len(ids) else None

    def place(self, term: int) -> int:
        """Of a term's list, or -1."""
        at = int(np.searchsorted(self.known, term))
        return at if at < len(self.known) and self.known[at] == term else -1

    def scores(self, rows: np.ndarray, weight: np.ndarray) -> np.ndarray:
        n = self.n[rows]
        at = _ranges(self.start[rows], n)
        return np.add.reduceat(weight[self.terms[at]] * self.shares[at], np.cumsum(n) - n)

    def clustered(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The documents of a list, cluster by cluster, and where its blocks begin."""
        if len(rows) <= BLOCK:
            return rows, np.zeros(1, np.int64)
        chosen = rows[np.linspace(0, len(rows) - 1, -(-len(rows) // BLOCK)).astype(np.int64)]
        cluster = (self.sketch[rows] @ self.sketch[chosen].T).argmax(axis=1)
        by = np.argsort(cluster, kind="stable")
        heads = np.flatnonzero(np.diff(cluster[by], prepend=-1))
        n = np.diff(heads, append=len(rows))
        parts = -(-n // BLOCK)  # large clusters are cut
        return rows[by], np.repeat(heads, parts) + BLOCK * _ranges(np.zeros(len(n), np.int64), parts)


class Blocks:
    """The blocks of one list: documents, where each begins, its least id, and the maxima of the wanted terms' shares."""

    def __init__(self, shard: Shard, rows: np.ndarray, wanted: np.ndarray, column: np.ndarray):
        self.rows, self.heads = shard.clustered(rows)
        self.n = np.diff(self.heads, append=len(rows))
        self.least = np.minimum.reduceat(shard.ids[self.rows], self.heads)
        self.summary = None
        if len(self.heads) == 1:
            return  # scored whole
        n = shard.n[self.rows]
        at = _ranges(shard.start[self.rows], n)
        block = np.repeat(np.repeat(np.arange(len(self.heads)), self.n), n)
        column[wanted] = np.arange(len(wanted))
        found = column[shard.terms[at]]
        column[wanted] = -1
        ok = found >= 0
        used, found = np.unique(found[ok], return_inverse=True)
        if len(self.heads) * len(used) <= CELLS:
            self.summary = np.zeros((len(self.heads), len(used)), np.int64)
            np.maximum.at(self.summary, (block[ok], found), shard.shares[at[ok]])
            self.terms = wanted[used]

    def bounds(self, terms: np.ndarray, weight: np.ndarray) -> np.ndarray | None:
        """No document of a block gets more from these terms; None: not known."""
        if self.summary is None:
            return None
        at = np.searchsorted(self.terms, terms)
        at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, len(self.terms) - 1)] == terms)]
        return self.summary[:, at] @ weight[self.terms[at]]


class Ranked:
    """The k best documents of each query so far: by score, ties to the smaller id; an id counts once, at its best. counted: how
    many documents were scored, and how many stood in lists."""

    def __init__(self, queries: list[tuple[np.ndarray, np.ndarray]], size: int, weights: np.ndarray, k: int):
        self.queries, self.size, self.weights, self.k = queries, size, weights, k
        self.heaps: list[dict] = [{} for _ in queries]  # id -> score
        self.last: list[tuple | None] = [None] * len(queries)  # the k-th best: (score, id)
        self.weight, self.column = np.zeros(size, np.int64), np.full(size, -1, np.int64)
        self.counted = [0, 0]
        self.groups, group, seen = [], [], set()
        for i, (terms, _) in enumerate(queries):
            if group and len(seen) + len(terms) > TERMS:
                self.groups.append(group)
                group, seen = [], set()
            group.append(i)
            seen.update(terms.tolist())
        if group:
            self.groups.append(group)
        self.wanted = [self._wanted(g) for g in self.groups]

    def _wanted(self, group: list[int]) -> dict[int, np.ndarray]:
        """Of each term the terms that stand beside it in a query of the group: its lists' coordinates."""
        beside: dict[int, list] = {}
        for i in group:
            for t in self.queries[i][0].tolist():
                beside.setdefault(t, []).append(self.queries[i][0])
        return {t: some[0] if len(some) == 1 else np.unique(np.concatenate(some)) for t, some in beside.items()}

    def add(self, shard: Shard) -> None:
        for group, wanted in zip(self.groups, self.wanted, strict=True):
            blocks: dict[int, Blocks] = {}
            for i in group:
                self._search(i, shard, wanted, blocks)

    def _search(self, i: int, shard: Shard, wanted: dict, blocks: dict) -> None:
        terms, weight = self.queries[i]
        place = np.array([shard.place(t) for t in terms.tolist()], np.int64)
        here = (place >= 0) & (weight > 0)
        terms, weight, place = terms[here], weight[here], place[here]
        if not len(terms):
            return
        most = weight * shard.most[place]
        by = np.argsort(-most, kind="stable")
        terms, weight, place = terms[by], weight[by], place[by]
        rest = most[by][::-1].cumsum()[::-1]  # of the lists from here on
        self.weight[terms] = weight
        seen = np.zeros(len(shard.ids), bool)
        for j in range(len(terms)):
            last = self.last[i]
            if last and (rest[j] < last[0] or rest[j] == last[0] and shard.least > last[1]):
                break
            t = int(terms[j])
            if t not in blocks:
                blocks[t] = Blocks(shard, shard.lists[place[j]], wanted[t], self.column)
            b = blocks[t]
            self.counted[1] += len(b.rows)
            bounds = b.bounds(terms[j:], self.weight) if last else None
            if bounds is None:
                self._score(i, shard, b.rows, seen)
                continue
            order = np.argsort(-bounds, kind="stable")
            order = order[bounds[order] >= last[0]]
            for at in range(0, len(order), 8):  # the threshold rises on the way
                some, last = order[at : at + 8], self.last[i]
                some = some[(bounds[some] > last[0]) | (bounds[some] == last[0]) & (b.least[some] < last[1])]
                if len(some):
                    self._score(i, shard, b.rows[_ranges(b.heads[some], b.n[some])], seen)
        self.weight[terms] = 0

    def _score(self, i: int, shard: Shard, rows: np.ndarray, seen: np.ndarray) -> None:
        rows = rows[~seen[rows]]
        if not len(rows):
            return
        seen[rows] = True
        self.counted[0] += len(rows)
        scores, last = shard.scores(rows, self.weight), self.last[i]
        ok = scores > 0 if last is None else scores >= max(last[0], 1)
        best = self.heaps[i]
        for score, d in zip(scores[ok].tolist(), shard.ids[rows[ok]].tolist(), strict=True):
            if score > best.get(d, 0):
                best[d] = score
        if len(best) >= self.k:
            kept = heapq.nsmallest(self.k, best.items(), key=lambda x: (-x[1], x[0]))
            self.heaps[i], self.last[i] = dict(kept), (kept[-1][1], kept[-1][0])


def _searched(model, k: int, kind: pa.DataType):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, queries, weights, n_docs, length = model.value
        ranked = Ranked(queries, len(weights), weights, k)
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            size, ends = batch.column(1).to_numpy(), batch.column(2).offsets.to_numpy().astype(np.int64)
            terms, counts = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
            ends = ends - ends[0]
            m = 100 - 25 + (25 * size * n_docs) // length
            shares = (1_000_000_000 * counts) // (1000 * counts + 12 * np.repeat(m, np.diff(ends)))
            for at in range(0, len(ids), SHARD):
                e = ends[at : at + SHARD + 1]
                some = slice(e[0], e[-1])
                ranked.add(Shard(ids[at : at + SHARD], e - e[0], terms[some], shares[some], weights))
        out = [(items[i], d, s) for i, best in enumerate(ranked.heaps) for d, s in best.items()]
        columns = [pa.array([r[0] for r in out], pa.int64()), pa.array([r[1] for r in out], kind), pa.array([r[2] for r in out], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["item", "doc_id", "score"])

    return run


def _blocks(items: DataFrame, block_bytes: int) -> Iterator[list[tuple[int, str]]]:
    """Numbered items with text, in lists of bounded size at the driver."""
    size = items.agg(F.sum(F.length(F.col("text").cast("binary")) + 16)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    for i in range(n):
        mine = items if n == 1 else items.where(F.pmod(F.xxhash64("item"), F.lit(n)) == i)
        yield sorted((r.item, r.text) for r in mine.collect())


def ranked_search(docs: DataFrame, items: DataFrame, k: int = 20, block_bytes: int = 8 << 20) -> DataFrame:
    """(doc_id, text), (item_id, text) -> item_id, rank, doc_id, score: of each item the k documents that score highest, above 0,
    ties to the smaller doc_id; all, if fewer.

    A term's weight is floor(1000 ln((2 N + 2) / (2 df + 1))), its share in a document (10^9 tf) div (1000 tf + 12 m) with m = 75 +
    (25 n N) div L; a score sums weight times share over the item's terms, repeats included. N documents hold a term, L is
    their terms in all, n a document's own. Each row of docs is a document there; those without doc_id count but are not
    returned, and a repeated doc_id is returned once, at its best score. Null and empty texts hold no terms. Items without
    item_id or terms have no rows; of several texts under one item_id the first by code points asks.

    Items are taken in blocks of about block_bytes of text, whose terms are the vocabulary that tasks hold (some 100 MB at 8 MB).
    Each block reads the texts once, and the search reads what that keeps: a row a document, a number a term of the block in it.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text")).where("text is not null")
    items = written(items.where("item_id is not null and text is not null").groupBy("item_id").agg(F.min(F.col("text").cast("string")).alias("text")).withColumn("item", F.monotonically_increasing_id()), "items")
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = None
    for block in _blocks(items, block_bytes):
        asked = [(item, Counter(terms_of(text.encode()))) for item, text in block]
        names = sorted({t for _, terms in asked for t in terms})
        place = {t: i for i, t in enumerate(names)}
        vocabulary = spark.sparkContext.broadcast(place)
        arrow = _arrow(docs)
        kept = written(docs.mapInArrow(_counted(vocabulary, arrow), f"doc_id {kind}, n long, terms array<int>, counts array<long>"), "counts")
        n_docs, length = kept.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        df = np.zeros(len(names), np.int64)
        for r in kept.select(F.explode("terms").alias("t")).groupBy("t").count().collect():  # a row a term of the block
            df[r.t] = r["count"]
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        queries = []
        for _, terms in asked:
            ids = np.array(sorted(place[t] for t in terms), np.int64)
            queries.append((ids, weights[ids] * np.array([terms[names[i]] for i in ids.tolist()], np.int64)))
        model = spark.sparkContext.broadcast(([item for item, _ in asked], queries, weights, n_docs, length))
        best = written(kept.where("doc_id is not null and size(terms) > 0").mapInArrow(_searched(model, k, arrow), f"item long, doc_id {kind}, score long"), "found")
        vocabulary.destroy()
        model.destroy()
        found = best if found is None else found.union(best)
    # k rows an item and task, of which Spark keeps k an item before and after the shuffle
    found = found.groupBy("item", "doc_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), "doc_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _arrow(docs: DataFrame) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(docs.schema["doc_id"].dataType)


def op11_lexical(spark, sf_dir: str) -> DataFrame:
    """The twenty documents that score highest for each benchmark item."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    return ranked_search(docs, items)


OP11_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as t from documents where text is not null),
dn as (select row_number() over () as row, doc_id, len(t) as n, t from d where len(t) > 0),
s as (select count(*) as docs, sum(n)::bigint as terms from dn),
dm as (select row, doc_id, t, 100 - 25 + ((25 * n * docs) // terms) as m from dn, s),
f as (select row, term, count(*) as tf from (select row, unnest(t) as term from dn) group by row, term),
w as (select term, cast(floor(1000 * ln((2 * docs + 2)::double / (2 * df + 1)::double)) as bigint) as w from (select term, count(*) as df from f group by term), s),
i as (select item_id, term, count(*) as k from (select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from (select item_id, min(text) as text from benchmark where item_id is not null group by item_id)) group by item_id, term),
p as (select item_id, doc_id, row, cast(sum(k * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) as bigint) as score from i join w using (term) join f using (term) join dm using (row) where doc_id is not null group by item_id, doc_id, row),
b as (select item_id, doc_id, max(score) as score from p where score > 0 group by item_id, doc_id),
r as (select *, row_number() over (partition by item_id order by score desc, doc_id) as rank from b)
select item_id, cast(rank as integer) as rank, doc_id, score from r where rank <= 20
"""
