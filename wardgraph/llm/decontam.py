"""Benchmark decontamination by winnowing.

Texts and items become words. Of every w consecutive k-gram hashes the smallest (the rightmost of equals) is kept as a
fingerprint; the fingerprints of documents are joined with those of the items, and each hit is extended to the windows
of k + w - 1 words around it that occur in an item word for word. Two texts that share k + w - 1 words keep the same
fingerprint inside that span, so no such window is missed. Items shorter than a window give no such guarantee: they
are looked up whole, by the hashes of all document spans of their length.

Items of at most block_bytes of text in all are broadcast as an index: sorted hashes of windows in arrays, and what they
find is compared word for word. The documents are read once then and nothing is shuffled. Beyond that, fingerprints are
joined by shuffle, and the documents are read once as well: a filter of the items' fingerprints (bits, at most
FILTER_BYTES, which may say yes wrongly and never no) lets windows around likely ones pass, and these join the items'
windows by their words. A longer item is cut into parts that share k + w - 2 words.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgraph.llm.common import free_names, text_key, with_string_text, written

K, W = 5, 6
SPAN = K + W - 1
#: Item text whose index is broadcast.
BLOCK_BYTES = 8 << 20
#: The filter of fingerprints has two of at least 16 bits for each, up to this size; beyond it more passes, and nothing is lost.
FILTER_BYTES = 64 << 20
#: Windows of a document that leave a task in one row.
ROW_WINDOWS = 1 << 14
_KEPT = {*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)}
#: UTF-8 bytes: A-Z become a-z, and what is not of [^\x00-\x2F\x3A-\x60\x7B-\x7F] becomes a space.
_BYTES = bytes(b if b in _KEPT else b + 32 if 0x41 <= b <= 0x5A else 0x20 for b in range(256))
SPANS = "array<struct<start:int,end:int>>"


def words(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_BYTES).split() if text else []


def gram_hashes(ids: np.ndarray, k: int) -> np.ndarray:
    g = ids[: len(ids) - k + 1].astype(np.uint64)
    for j in range(1, k):
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + ids[j : len(ids) - k + 1 + j].astype(np.uint64)
    g = (g ^ (g >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return g ^ (g >> np.uint64(32))


def winnow(hashes: np.ndarray, w: int) -> np.ndarray:
    """Positions of the smallest hash, the rightmost of equals, of every w consecutive ones."""
    n = len(hashes) - w + 1
    if n <= 0:
        return np.empty(0, np.int64)
    low = np.lib.stride_tricks.sliding_window_view(hashes[::-1], w).argmin(axis=1)
    return np.unique(len(hashes) - 1 - (np.arange(n) + low))


def row_hashes(rows: np.ndarray) -> np.ndarray:
    return gram_hashes(rows.T, rows.shape[1])[0] if len(rows) else np.empty(0, np.uint64)


class Grams:
    """The distinct sequences of `size` word ids that items hold, with the items that hold each."""

    def __init__(self, size: int, flat: np.ndarray, starts: np.ndarray, owner: np.ndarray):
        """flat: ids of all items in a row; starts: where sequences begin in it; owner: the item of each."""
        self.size, self.flat = size, flat
        h = np.empty(len(starts), np.uint64)
        for at in range(0, len(starts), 1 << 16):
            h[at : at + (1 << 16)] = row_hashes(self._at(starts[at : at + (1 << 16)]))
        by = np.lexsort((owner, h))
        h, starts, owner = h[by], starts[by], owner[by]
        first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.empty(0, np.int64)
        group = np.cumsum(np.bincount(first, minlength=len(h))) - 1
        # sequences whose hash is that of another one, which is to be expected of none, are kept as they are
        self.odd: dict[bytes, set[int]] = {}
        same = np.ones(len(h), bool)
        for at in range(0, len(h), 1 << 16):
            part = slice(at, at + (1 << 16))
            same[part] = (self._at(starts[part]) == self._at(starts[first[group[part]]])).all(axis=1)
        for i in np.flatnonzero(~same).tolist():
            self.odd.setdefault(self._at(starts[i : i + 1]).tobytes(), set()).add(int(owner[i]))
        self.hashes, self.start = h[first], starts[first]
        # the items of each sequence, once each
        keep = same & np.concatenate([[True], (group[1:] != group[:-1]) | (owner[1:] != owner[:-1])]) if len(h) else same
        self.owner, self.ends = owner[keep].astype(np.int32), np.cumsum(np.bincount(group[keep], minlength=len(first)))

    def _at(self, starts: np.ndarray) -> np.ndarray:
        return self.flat[starts[:, None] + np.arange(self.size)]

    def find(self, ids: np.ndarray, starts: np.ndarray, hashes: np.ndarray | None = None) -> tuple[np.ndarray, set[int]]:
        """Those of the starts in ids where a sequence stands, and the items that hold these."""
        rows = None
        if hashes is None:
            rows = ids[starts[:, None] + np.arange(self.size)]
            hashes = row_hashes(rows)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        hit = np.flatnonzero(self.hashes[at] == hashes)
        if not len(hit):
            return starts[:0], set()
        at, starts = at[hit], starts[hit]
        rows = ids[starts[:, None] + np.arange(self.size)] if rows is None else rows[hit]
        ok = (rows == self._at(self.start[at])).all(axis=1)
        items: set[int] = set()
        for i in np.unique(at[ok]).tolist():
            items.update(self.owner[self.ends[i - 1] if i else 0 : self.ends[i]].tolist())
        if self.odd:
            for i in np.flatnonzero(~ok).tolist():
                own = self.odd.get(rows[i].tobytes())
                if own:
                    ok[i] = True
                    items |= own
        return starts[ok], items


class Index:
    """Fingerprints and windows of one block of items: some 30 bytes a word of item text, and its distinct words."""

    def __init__(self, items: list[tuple[str, str]], k: int = K, w: int = W):
        self.k, self.w, self.span = k, w, k + w - 1
        self.names = sorted({item for item, _ in items})
        number, self.vocab = {name: i for i, name in enumerate(self.names)}, {}
        texts = [(number[item], np.array([self.vocab.setdefault(x, len(self.vocab) + 1) for x in words(text)], np.int32)) for item, text in items]
        flat = np.concatenate([np.empty(0, np.int32), *(ids for _, ids in texts)])
        begin = np.cumsum([0, *(len(ids) for _, ids in texts)])
        starts: dict[int, list] = {}
        kept = [np.empty(0, np.uint64)]
        for (item, ids), at in zip(texts, begin.tolist(), strict=False):
            if len(ids):
                size = min(self.span, len(ids))
                some = np.arange(at, at + len(ids) - size + 1)
                starts.setdefault(size, []).append((some, np.full(len(some), item)))
            if len(ids) >= self.span:
                h = gram_hashes(ids, k)
                kept.append(h[winnow(h, w)])
        self.prints = np.unique(np.concatenate(kept))
        self.grams = {size: Grams(size, flat, *(np.concatenate(c) for c in zip(*some, strict=True))) for size, some in starts.items()}

    def find(self, text: str | None) -> tuple[int, list[dict], list[str]]:
        """Number of words, hit spans of words (merged, ends exclusive), items (sorted)."""
        ws = words(text)
        n, get = len(ws), self.vocab.get
        ids = np.fromiter(map(get, ws, repeat(0)), np.int32, n)
        items: set[int] = set()
        found: list[tuple[np.ndarray, int]] = []
        for size, grams in self.grams.items():
            if n < size:
                continue
            if size == self.span:
                h = gram_hashes(ids, self.k)
                at = winnow(h, self.w)
                prints = self.prints
                at = at[prints[np.minimum(np.searchsorted(prints, h[at]), len(prints) - 1)] == h[at]]
                if not len(at):
                    continue
                starts, own = grams.find(ids, np.unique(np.clip(at[:, None] - np.arange(self.w), 0, n - size)))
            else:
                starts, own = grams.find(ids, np.arange(n - size + 1), gram_hashes(ids, size))
            if len(starts):
                found.append((starts, size))
                items |= own
        if not found:
            return n, [], []
        edge = np.zeros(n + 1, np.int32)
        for starts, size in found:
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + size, -1)
        hit = np.diff(np.concatenate([[0], (np.cumsum(edge) > 0).astype(np.int8)]))
        return n, [{"start": int(a), "end": int(b)} for a, b in zip(np.flatnonzero(hit == 1), np.flatnonzero(hit == -1), strict=True)], [self.names[i] for i in sorted(items)]


_INDEX: dict = {}


def _index(block) -> Index:
    if block.value["id"] not in _INDEX:
        _INDEX.clear()
        _INDEX[block.value["id"]] = Index(block.value["items"])
    return _INDEX[block.value["id"]]


def _match(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = _index(block)
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for batch in batches:
            out = [index.find(t) for t in batch.column(1).to_pylist()]
            cols = [pa.array([x[i] for x in out], t) for i, t in ((0, pa.int64()), (1, kind), (2, pa.list_(pa.string())))]
            yield pa.RecordBatch.from_arrays([batch.column(0), *([batch.column(2)] if batch.num_columns > 2 else []), *cols], names=["doc_id", *(["row"] if batch.num_columns > 2 else []), "n_words", "spans", "items"])

    return run


def _clean(block):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            yield batch.filter(pa.array([not _index(block).find(t)[2] for t in text.to_pylist()], pa.bool_()))

    return run


def _parts(most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Items of over `most` bytes in parts of about that size, each of which begins with the last words of the one before
        that a window may need."""
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if len(text) * 4 <= most:
                    parts = [text]
                else:
                    ws = words(text)
                    step = max(K + W, most // max(1, sum(map(len, ws)) // max(1, len(ws)) + 1))
                    parts = [b" ".join(ws[max(0, at - K - W + 2) : at + step]).decode("utf-8", "surrogatepass") for at in range(0, len(ws), step)]
                for at in range(0, len(parts), 16):
                    some = parts[at : at + 16]
                    yield pa.RecordBatch.from_arrays([pa.array([item] * len(some), pa.string()), pa.array(some, pa.string())], names=["item", "text"])

    return run


def _items(items: DataFrame, block_bytes: int) -> tuple[DataFrame, bool]:
    """(item, text) of distinct items, in parts where they are long; and whether all fit into one index."""
    items = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")).where("text is not null").distinct()
    items = items.mapInArrow(_parts(block_bytes), "item string, text string")
    return items, (items.agg(F.sum(F.length(F.col("text").cast("binary")) + 16)).first()[0] or 0) <= block_bytes


def _block(items: DataFrame):
    rows = sorted((r.item, r.text) for r in items.collect())
    return items.sparkSession.sparkContext.broadcast({"id": hash(tuple(rows)), "items": rows})


def word_ids(ws: list[bytes]) -> np.ndarray:
    """Numbers of words that are the same in every task. Words that share one only let more candidates pass."""
    return np.fromiter(map(crc32, ws), np.uint64, len(ws))


def tagged(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of sequences of so many words, apart from those of other sizes; 0: fingerprints."""
    return (hashes + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)


def _item_prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, text -> size, h: the fingerprints (size 0) of items, and the hash of each item shorter than a window."""
    for batch in batches:
        found: dict[int, list] = {}
        for text in batch.column(1).to_pylist():
            ids = word_ids(words(text))
            if len(ids) >= SPAN:
                h = gram_hashes(ids, K)
                found.setdefault(0, []).append(h[winnow(h, W)])
            elif len(ids):
                found.setdefault(len(ids), []).append(gram_hashes(ids, len(ids)))
        for size, parts in found.items():
            h = np.unique(tagged(np.concatenate(parts), size)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(h), size, np.int32)), pa.array(h)], names=["size", "h"])


def _item_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """item, text -> gram, item: the words of each window, once an item's part."""
    for batch in batches:
        for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ws = words(text)
            size = min(SPAN, len(ws))
            for at in range(0, len(ws) - size + 1 if ws else 0, ROW_WINDOWS):
                grams = sorted({b" ".join(ws[i : i + size]) for i in range(at, min(at + ROW_WINDOWS, len(ws) - size + 1))})
                yield pa.RecordBatch.from_arrays([pa.array(grams, pa.binary()), pa.array([item] * len(grams), pa.string())], names=["gram", "item"])


def _filter(items: DataFrame, filter_bytes: int):
    """Broadcast bits of the items' fingerprints, and the sizes of items shorter than a window. The bits are put together in words
    of 64 by Spark, so the driver gets filter_bytes of them at most, each word with its number."""
    prints = written(items.mapInArrow(_item_prints, "size int, h long").distinct(), "prints")
    n = prints.count()
    bits = 1 << min(max(10, (16 * n - 1).bit_length()), (8 * filter_bytes).bit_length() - 1)
    at = prints.select(F.explode(F.array(F.col("h").bitwiseAND(bits - 1), F.shiftrightunsigned("h", 32).bitwiseAND(bits - 1))).alias("at"))
    some = at.groupBy(F.shiftright("at", 6).alias("word")).agg(F.expr("bit_or(shiftleft(1L, cast(at & 63 as int)))").alias("bits")).toArrow()
    table = np.zeros(bits >> 6, np.uint64)
    table[some.column("word").to_numpy()] = some.column("bits").to_numpy().view(np.uint64)
    sizes = sorted(r[0] for r in prints.where("size > 0").select("size").distinct().collect())
    return items.sparkSession.sparkContext.broadcast({"bits": table, "sizes": sizes})


def likely(h: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Which hashes the filter lets pass."""
    last = np.uint64(len(table) * 64 - 1)
    ok = np.ones(len(h), bool)
    for at in (h & last, (h >> np.uint64(32)) & last):
        ok &= (table[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return ok


def _candidates(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """doc_id, a, b, text -> one row a document with its number of words and the windows (gram, size, start) that may be an
        item's. What has more than ROW_WINDOWS of them goes on in rows without a number."""
        table, sizes = wanted.value["bits"], wanted.value["sizes"]
        kind = pa.list_(pa.struct([("gram", pa.binary()), ("size", pa.int32()), ("start", pa.int32())]))
        for batch in batches:
            keys, held, rows = batch.select([0, 1, 2]), 0, []

            def flush(keys=keys, rows=rows):
                took = keys.take(pa.array([r[0] for r in rows], pa.int64()))
                out = pa.RecordBatch.from_arrays([*took.columns, pa.array([r[1] for r in rows], pa.int64()), pa.array([r[2] for r in rows], kind)], names=["doc_id", "a", "b", "n_words", "windows"])
                rows.clear()
                return out

            for i, text in enumerate(batch.column(3)):
                ws = words(text.as_py())
                ids, starts = word_ids(ws), []
                if len(ws) >= SPAN:
                    h = gram_hashes(ids, K)
                    at = winnow(h, W)
                    at = at[likely(tagged(h[at], 0), table)]
                    starts += [(SPAN, s) for s in np.unique(np.clip(at[:, None] - np.arange(W), 0, len(ws) - SPAN)).tolist()]
                for size in sizes:
                    if len(ws) >= size:
                        starts += [(size, s) for s in np.flatnonzero(likely(tagged(gram_hashes(ids, size), size), table)).tolist()]
                for first in range(0, max(1, len(starts)), ROW_WINDOWS):
                    some = starts[first : first + ROW_WINDOWS]
                    rows.append((i, None if first else len(ws), [{"gram": b" ".join(ws[s : s + size]), "size": size, "start": s} for size, s in some]))
                    held += len(some)
                    if held >= ROW_WINDOWS:
                        held = 0
                        yield flush()
            if rows:
                yield flush()

    return run


def merged_spans(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans that meet or overlap become one."""
    by = np.argsort(starts, kind="stable")
    starts, ends = starts[by], np.maximum.accumulate(ends[by])
    first = np.concatenate([[True], starts[1:] > ends[:-1]])
    return starts[first], ends[np.concatenate([first[1:], [True]])]


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        spans = []
        for found in batch.column(2):
            starts, ends = (found.values.field(j).to_numpy(zero_copy_only=False) for j in (0, 1))
            spans.append([{"start": a, "end": b} for a, b in zip(*(x.tolist() for x in merged_spans(starts, ends)), strict=True)])
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(spans, kind)], names=["a", "b", "spans"])


def _joined(docs: DataFrame, items: DataFrame, filter_bytes: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """doc_id, text -> every row as (doc_id, a, b, n_words), a and b being the text's key; and by key: the windows that are an item's
    (a, b, gram, size, start), and the items' windows (gram, item). Each text's windows are made distinct before they join, so copies
    of one text join once."""
    wanted = _filter(items, filter_bytes)
    keyed = docs.select("doc_id", text_key().alias("k"), "text").select("doc_id", "k.a", "k.b", "text")
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, a long, b long, n_words long, windows array<struct<gram:binary,size:int,start:int>>"
    rows = written(keyed.mapInArrow(_candidates(wanted), schema), "windows")
    wanted.destroy()
    of_items = written(items.mapInArrow(_item_windows, "gram binary, item string").distinct(), "item-windows")
    windows = written(rows.select("a", "b", F.explode("windows").alias("w")).select("a", "b", "w.*").distinct(), "distinct")
    grams = written(of_items.select("gram").distinct(), "grams")
    hits = written(windows.join(grams, "gram", "left_semi").select("a", "b", "gram", "size", "start"), "hits")
    return rows.where("n_words is not null").select("doc_id", "a", "b", "n_words"), hits, of_items


def clean_documents(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """The rows of docs, with their columns, whose text holds no window of an item. Each row is judged by its own text. With items of
    at most block_bytes nothing is shuffled; with more, hits are joined by the text's key. Null and empty texts stay."""
    docs = with_string_text(docs)
    items, one = _items(items, block_bytes)
    if one:
        return docs.mapInArrow(_clean(_block(items)), docs.schema)
    _, hits, _ = _joined(docs.select(F.lit(0).alias("doc_id"), "text"), items, filter_bytes)
    key, own = free_names(docs, "key", "hit")
    hit = written(hits.select(F.struct("a", "b").alias(own)).distinct(), "hit-texts")
    return docs.withColumn(key, text_key()).join(hit, F.col(key) == F.col(own), "left_anti").drop(key)


def contamination(docs: DataFrame, items: DataFrame, block_bytes: int = BLOCK_BYTES, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """(doc_id, text), (item_id, text) -> doc_id, n_words, spans (of words, ends exclusive), items (sorted as strings).

    One row for each row of docs. Null and empty texts have no words; an item without words occurs nowhere; an item
    without id counts as ''; repeated items count once. Without items nothing is hit.
    """
    docs = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    items, one = _items(items, block_bytes)
    if one:
        return docs.mapInArrow(_match(_block(items)), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_words long, spans {SPANS}, items array<string>")
    rows, hits, of_items = _joined(docs, items, filter_bytes)
    span = F.struct("start", (F.col("start") + F.col("size")).alias("end"))
    spans = hits.groupBy("a", "b").agg(F.collect_list(span).alias("spans")).mapInArrow(_merge, f"a long, b long, spans {SPANS}")
    held = hits.join(of_items, "gram").select("a", "b", "item").distinct().groupBy("a", "b").agg(F.sort_array(F.collect_list("item")).alias("items"))
    found = written(spans.join(held, ["a", "b"]), "found")
    none = lambda c, t: F.coalesce(c, F.array().cast(t)).alias(c)
    return rows.join(found, ["a", "b"], "left").select("doc_id", "n_words", none("spans", SPANS), none("items", "array<string>"))


def op2_decontaminate(spark, sf_dir: str) -> DataFrame:
    """For every document: its words, those inside a benchmark window, and the items found."""
    docs, items = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "benchmark"))
    found = contamination(docs, items)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return found.select("doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"), F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("items") > 0).alias("contaminated"))


OP2_SQL = r"""
with d as (select doc_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents),
b as (select cast(item_id as varchar) as item, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark),
bw as (select distinct item, least(len(w), 10) as n, unnest(list_transform(range(1, len(w) - least(len(w), 10) + 2), lambda i: array_to_string(w[i:i+least(len(w), 10)-1], ' '))) as g from b where len(w) > 0),
dw as (select doc_id, n, unnest(range(1, len(w) - n + 2)) as i, unnest(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i+n-1], ' '))) as g
       from d, (select distinct n from bw) where len(w) >= n),
h as (select distinct dw.doc_id, dw.i, dw.n, bw.item from dw join bw on dw.g = bw.g and dw.n = bw.n),
c as (select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from h)) group by doc_id),
t as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items from (select distinct doc_id, item from h) group by doc_id)
select d.doc_id, cast(len(d.w) as bigint) as n_words, coalesce(c.n_hit, 0) as n_hit, coalesce(t.n_items, 0) as n_items, sha256(coalesce(t.items, '')) as items_sha256, coalesce(c.n_hit, 0) > 0 as contaminated
from d left join c using (doc_id) left join t using (doc_id)
"""
