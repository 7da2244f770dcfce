"""Best-fit decreasing packing of token sequences.

A document's ids are cut into full windows and a rest. Only the number of pieces of each length decides the packing,
so the driver packs that histogram: open windows are kept as ranges of sequence ids by their remaining capacity, and a
segment tree over capacities finds the tightest that fits. All pieces of one length go in a few runs to ranges of
windows, so its work and its result depend on the window, not on the number of documents. Each piece then finds its
place from its rank among the pieces of its length, which Spark counts in salted groups.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wardgraph.llm.common import written
from wardgraph.llm.tokens import WORD_BPE, WordBpe, loaded

WINDOW, END = 2048, 1


class CapacityTree:
    """A segment tree over remaining capacities 0..size that finds the smallest one in use of at least some number."""

    def __init__(self, size: int):
        self.base = 1 << size.bit_length()
        self.used = np.zeros(2 * self.base, bool)

    def set(self, capacity: int, used: bool) -> None:
        at = self.base + capacity
        self.used[at] = used
        while at > 1:
            at //= 2
            self.used[at] = self.used[2 * at] or self.used[2 * at + 1]

    def tightest(self, least: int) -> int | None:
        at = self.base + least
        if self.used[at]:
            return least
        while at > 1:  # up, until a subtree to the right has one
            if not at & 1 and self.used[at + 1]:
                at += 1
                break
            at //= 2
        else:
            return None
        while at < self.base:
            at = 2 * at if self.used[2 * at] else 2 * at + 1
        return at - self.base


def best_fit_decreasing(counts: dict[int, int], window: int) -> list[tuple[int, int, int, int, int]]:
    """Pieces by length -> runs (length, first rank, pieces, first sequence id, offset): piece rank + i of a length goes
    to sequence id + i at that offset."""
    tree, free, runs, opened = CapacityTree(window), {}, [], 0

    def put(capacity: int, at: int, n: int) -> None:
        if capacity and n:
            if not free.get(capacity):
                tree.set(capacity, True)
            free.setdefault(capacity, []).append((at, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            capacity = tree.tightest(length)
            if capacity is None:
                n = -(-left // (window // length))
                put(window, opened, n)
                opened += n
                continue
            at, n = free[capacity].pop()
            if not free[capacity]:
                tree.set(capacity, False)
            # the window just used is the tightest for the next piece, as long as one fits: fill them one by one
            fit = capacity // length
            full, some = min(n, left // fit), fit
            if not full:
                full, some = 1, left
            for i in range(some):
                runs.append((length, rank, full, at, window - capacity + i * length))
                rank += full
            left -= full * some
            put(capacity, at + full, n - full)
            put(capacity - some * length, at, full)
    return runs


def _pieces(tokenizer: str, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = loaded(WordBpe, tokenizer).encode, np.array([END], "<u4").tobytes()
        for batch in (b.slice(at, 512) for b in batches for at in range(0, b.num_rows, 512)):
            out: list[list[int]] = [[], [], [], [], []]
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = encode(text) + end
                n = len(ids) // 4
                for start in range(0, n, window):
                    piece = ids[4 * start : 4 * (start + window)]
                    for col, v in zip(out, (i, start, len(piece) // 4, zlib.crc32(piece), n), strict=True):
                        col.append(v)
            at = pa.array(out[0], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(at), *(pa.array(c, pa.int64()) for c in out[1:])], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens"])

    return run


def packed_pieces(docs: DataFrame, window: int = WINDOW, tokenizer: str = WORD_BPE) -> DataFrame:
    """(doc_id, text) -> doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset: one row a piece.

    A null or empty text has the end id alone. Rows that share a doc_id are packed each for itself. An empty table gives
    no rows. The same pieces give the same layout for any partitioning; equal pieces may swap places.
    """
    spark = docs.sparkSession
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    id_type = docs.schema["doc_id"].dataType.simpleString()
    pieces = written(docs.mapInArrow(_pieces(tokenizer, window), f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long"), "pieces")
    # the rank of each piece among those of its length, counted in salted groups
    salts = max(8, int(spark.conf.get("spark.sql.shuffle.partitions")))
    order = ["doc_id", "start", "ids_crc32", "doc_tokens"]
    pieces = pieces.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    sizes = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = sizes.withColumn("before", F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)))
    counts = {r.length: r.n for r in sizes.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # `window` rows at most
    runs = np.array(best_fit_decreasing(counts, window), np.int64).reshape(-1, 5)
    placed = spark.sparkContext.broadcast((runs[:, 0] * (1 << 44) + runs[:, 1], runs[:, 1], runs[:, 3], runs[:, 4]))
    ranked = pieces.withColumn("r", F.row_number().over(Window.partitionBy("length", "salt").orderBy(*order)) - 1)
    ranked = ranked.join(before.select("length", "salt", "before"), ["length", "salt"]).withColumn("rank", F.col("r") + F.coalesce("before", F.lit(0)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, sequence, offset = placed.value
        by = np.argsort(key)
        key, first, sequence, offset = key[by], first[by], sequence[by], offset[by]
        for batch in batches:
            rank = batch.column(5).to_numpy()
            at = np.searchsorted(key, batch.column(2).to_numpy() * (1 << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.select(*order[:2], "length", *order[2:], "rank").mapInArrow(place, f"doc_id {id_type}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")


def op5_pack(spark, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packed_pieces(spark.read.parquet(f"{sf_dir}/documents.parquet"))
