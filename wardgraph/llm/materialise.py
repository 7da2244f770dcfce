"""Training-order materialisation.

Token ids are cut into sequences of one length. A keyed Feistel network over the next even power of two, walked along
its cycle until it falls below the size of its domain, sends each sequence's number to a global place. The number comes
from the input partition's share of the domain, an upper bound that the texts' bytes give without encoding them, so the
documents are encoded once; places that no sequence takes are closed up: a sequence's slot is its rank by place. A range
of places is one shard, a file of fixed-stride records, so reading in training order, from any slot on, is sequential:
the index of the shards tells each one's first slot.

Spark's own writer puts a shard's bytes into a file of their own and commits it whole, so any file system that Spark
knows will do, and a task that is repeated leaves nothing twice. What the table of sequences says is read back from the
files.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from wardgraph.llm.common import new_path, written
from wardgraph.llm.tokens import BYTE_BPE, ByteBpe, loaded

LENGTH, END = 2048, 50256
FILL = np.full(LENGTH, END, "<u2").tobytes()


@dataclass(frozen=True)
class Permutation:
    """A bijection of 0..n-1 for each key."""

    n: int
    key: int
    rounds: int = 4

    def __call__(self, at: np.ndarray) -> np.ndarray:
        half = np.uint64(max(1, (max(1, self.n - 1).bit_length() + 1) // 2))
        low = (np.uint64(1) << half) - np.uint64(1)
        out = at.astype(np.uint64)
        todo = np.arange(len(out))
        while len(todo):  # cycle-walking: under four steps on average, since the domain is below 4 n
            left, right = out[todo] >> half, out[todo] & low
            for r in range(self.rounds):
                mixed = right + np.uint64((self.key * 0x9E3779B97F4A7C15 + r * 0xD6E8FEB86659FD93) & 0xFFFFFFFFFFFFFFFF)
                mixed = (mixed ^ (mixed >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
                mixed = (mixed ^ (mixed >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
                left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(31))) & low)
            out[todo] = (left << half) | right
            todo = todo[out[todo] >= self.n]
        return out.astype(np.int64)


def _stream(batches: Iterator[pa.RecordBatch], tokenizer: str, length: int) -> Iterator[bytes]:
    """The partition's documents, each closed by END, in sequences of `length`; the last may be shorter."""
    encode, end, size = loaded(ByteBpe, tokenizer).encode, np.array([END], "<u2").tobytes(), 2 * length
    rest = bytearray()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            for text in batch.column(0).slice(at, 256).to_pylist():
                rest += encode(text) + end
                if len(rest) >= size:
                    whole = len(rest) // size * size
                    for s in range(0, whole, size):
                        yield bytes(rest[s : s + size])
                    del rest[:whole]
    if rest:
        yield bytes(rest)


def _place(tokenizer: str, length: int, share: object, order: Permutation):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        at, end = share.value.get(part, (0, 0))
        some: list[bytes] = []

        def batch():
            nonlocal some, at
            if at + len(some) > end:
                raise ValueError(f"partition {part} holds more than before: the input must be read alike twice; write it to a table first")
            places = order(np.arange(at, at + len(some)))
            at += len(some)
            data, some = some, []
            return pa.RecordBatch.from_arrays([pa.array(places), pa.array([len(d) // 2 for d in data], pa.int32()), pa.array([zlib.compress(d, 1) for d in data], pa.binary())], names=["place", "tokens", "data"])

        for s in _stream(batches, tokenizer, length):
            some.append(s)
            if len(some) == 512:
                yield batch()
        yield batch()

    return run


def stride(length: int) -> int:
    """Bytes of a record: the number of its tokens, big-endian, and `length` little-endian ids, all of 16 bits."""
    return 2 * length + 2


def _shards(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, place, tokens, data) in order, a shard's all in this task -> a row a shard, its records joined."""
        last, parts = None, []

        def shard():
            return pa.RecordBatch.from_arrays([pa.array([last], pa.int64()), pa.array([b"".join(parts)], pa.binary())], names=["shard", "records"])

        for batch in batches:
            for n, tokens, data in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3)), strict=True):
                if n != last and parts:
                    yield shard()
                    parts = []
                last = n
                parts += tokens.to_bytes(2, "big"), zlib.decompress(data), FILL[: 2 * (length - tokens)] if length - tokens <= LENGTH else np.full(length - tokens, END, "<u2").tobytes()
        if parts:
            yield shard()

    return run


def _records(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (shard, content), a file each -> a row a record. The closing mark of a file is shorter than a record."""
        for batch in batches:
            for shard, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                data = memoryview(content.as_buffer())
                at = range(0, len(data) - size + 1, size)
                tokens = [int.from_bytes(data[s : s + 2], "big") for s in at]
                crc = [zlib.crc32(data[s + 2 : s + 2 + 2 * n]) for s, n in zip(at, tokens, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array([shard] * len(at), pa.int64()), pa.array(at, pa.int64()), pa.array(tokens, pa.int32()), pa.array(crc, pa.int64())], names=["shard", "byte_offset", "tokens", "ids_crc32"])

    return run


def manifest(spark: SparkSession, path: str, length: int = LENGTH) -> DataFrame:
    """What the shard files below path hold: shard, byte_offset, tokens, ids_crc32, one row a record."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "part-*").load(path)
    files = files.select(F.regexp_extract("path", r"/shard=(\d+)/", 1).cast("long").alias("shard"), "content")
    return files.mapInArrow(_records(stride(length)), "shard long, byte_offset long, tokens int, ids_crc32 long")


def shard_index(manifest: DataFrame) -> DataFrame:
    """(shard, ...) one row a sequence -> shard, first slot, sequences. Sums run over blocks of shards, then in them."""
    size = manifest.groupBy("shard").agg(F.count("*").alias("n")).withColumn("block", F.floor(F.col("shard") / 1024))
    before = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    block = size.groupBy("block").agg(F.sum("n").alias("m")).withColumn("base", F.coalesce(F.sum("m").over(before), F.lit(0)))
    own = F.sum("n").over(Window.partitionBy("block").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    return size.join(block.select("block", "base"), "block").select("shard", (F.col("base") + F.coalesce(own, F.lit(0))).alias("first"), "n")


def write_training_order(docs: DataFrame, path: str, key: int = 1, length: int = LENGTH, per_shard: int = 2048, tokenizer: str = BYTE_BPE) -> DataFrame:
    """docs (text) -> shards of fixed-stride records below path, a folder of their own that is replaced, on any file system
    of Spark's; and a table: slot, shard, byte_offset, tokens (of the record; END fills it up), ids_crc32 (without the
    fill). One row a sequence.

    A null or empty text is END alone. Sequences run on across the documents of an input partition; only its last one is
    filled up. docs must be a table or a plain read, since its sizes are read first. A shard holds the sequences of
    per_shard places, most often about half as many, and is one row of that size in its task. An empty table writes none.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("text").cast("string").alias("text"))
    sizes = docs.groupBy(F.spark_partition_id().alias("part")).agg(F.sum(F.coalesce(F.octet_length("text"), F.lit(0)) + 1).alias("most")).collect()
    share, n = {}, 0
    for r in sorted(sizes, key=lambda r: r.part):  # a row for each input partition; a token has a byte at least
        share[r.part] = (n, n + r.most // length + 1)
        n = share[r.part][1]
    order, placed = Permutation(n, key), spark.sparkContext.broadcast(share)
    rows = docs.mapInArrow(_place(tokenizer, length, placed, order), "place long, tokens int, data binary")
    shards = max(1, -(-n // per_shard))
    tasks = max(1, min(shards, max(int(spark.conf.get("spark.sql.shuffle.partitions")), shards // 16)))
    rows = rows.select(F.floor(F.col("place") / per_shard).alias("shard"), "place", "tokens", "data")
    rows = rows.repartition(tasks, "shard").sortWithinPartitions("shard", "place")
    whole = rows.mapInArrow(_shards(length), "shard long, records binary")
    # a text writer takes the bytes as they are, and closes the file with END
    whole.select("shard", F.col("records").cast("string").alias("records")).write.mode("overwrite").option("encoding", "UTF-16LE").option("lineSep", chr(END)).partitionBy("shard").text(path)
    found = written(manifest(spark, path, length), "manifest")
    slot = (F.col("first") + F.col("byte_offset") / stride(length)).cast("long")
    return found.join(shard_index(found), "shard").select(slot.alias("slot"), "shard", "byte_offset", "tokens", "ids_crc32")


def read_training_order(index: list[tuple[int, int]], path: str, slot: int, n: int, length: int = LENGTH) -> np.ndarray:
    """The ids of records slot .. slot + n - 1, shard by shard, by Spark's file systems. index: (first slot, shard) of the
    shards, sorted."""
    spark = SparkSession.active()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    firsts, out, size = [f for f, _ in index], [], stride(length)
    while n > 0:
        i = bisect_right(firsts, slot) - 1
        first, shard = index[i]
        folder = jvm.org.apache.hadoop.fs.Path(f"{path}/shard={shard}")
        fs = folder.getFileSystem(conf)
        file = next(f for f in fs.listStatus(folder) if f.getPath().getName().startswith("part-"))
        some = min(n, file.getLen() // size - (slot - first))
        if some <= 0:
            raise IndexError(f"there is no slot {slot}")
        stream = fs.open(file.getPath())
        stream.seek((slot - first) * size)
        data = jvm.org.apache.commons.io.IOUtils.toByteArray(stream, some * size)
        stream.close()
        out.append(np.frombuffer(data, "<u2").reshape(some, length + 1)[:, 1:])
        slot, n = slot + some, n - some
    return np.concatenate(out) if out else np.empty((0, length), "<u2")


def op6_training_order(spark, sf_dir: str) -> DataFrame:
    """All documents as shards in training order, in the shared folder; returns the shards' table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    return write_training_order(docs, new_path(spark, "shards"))
