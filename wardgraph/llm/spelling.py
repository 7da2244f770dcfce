"""Words and their rarer spellings: the near words of a vocabulary by dynamic programming over its sorted list.

The vocabulary is sorted by Spark and cut into blocks of neighbours. In a block a row of the banded edit matrix belongs to a
prefix that neighbours share, so it is computed once for all of them (the common prefixes of adjacent words say where to go
on), and a range of words whose shared prefix is already more than one edit away is skipped. All words of a block are looked
up together, one depth after the other.

An edit falls into the first part of a word or behind it. Words that share a first part are adjacent in the sorted list, and
words that share the rest are adjacent in the sorted list of reversed words, so a word meets its own neighbourhood of either
list alone: mostly its own block, else the blocks beside it, of which those are skipped whose shared prefix is too far.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, bisect_right
from collections import Counter
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgraph.llm.common import scratch, written

RUN = re.compile("[A-Za-zÀ-ÿ]+")
#: After any word that begins with the prefix before it: no letter of a run is as large.
END = "Ā"
#: Least code points of a word: an edit and both parts of its word must fit.
LEAST = 7
#: Distinct words that a counting task holds before it passes them on.
HELD = 200_000
#: Words of a block, and the most blocks of a list, whose bounds (DEPTH letters each) are broadcast.
BLOCK, BLOCKS = 1024, 50_000
#: Depth from which the few words that still share a prefix are compared one by one.
DEPTH = 64

_UPPER = {ord(c): ord(c.lower()) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}
FOUND = "word string, n long, near long, form_n long, form string"


def spellings(doc_id, text: str | None, every: int = 31) -> Counter:
    """Words of a text and how often they occur. Of a run whose crc32 with the document's id is divisible by `every` one code
    point is left out."""
    if not text:
        return Counter()
    text = text.lower() if text.isascii() else text.translate(_UPPER)
    runs = Counter(RUN.findall(text) if len(text) < 1 << 20 else (m[0] for m in RUN.finditer(text)))
    seed, out = None if doc_id is None else zlib.crc32(f"{doc_id}:".encode()), Counter()
    for run, k in runs.items():
        if len(run) < LEAST:
            continue
        if seed is not None and not (h := zlib.crc32(run.encode(), seed)) % every:
            at = h % len(run)
            run = run[:at] + run[at + 1 :]
            if len(run) < LEAST:
                continue
        out[run] += k
    return out


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def flushed() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], names=["word", "n"])
        held.clear()
        return out

    for batch in batches:
        for i in range(batch.num_rows):
            held.update(spellings(batch.column(0)[i].as_py(), batch.column(1)[i].as_py()))
            if len(held) >= HELD:
                yield flushed()
    if held:
        yield flushed()


def vocabulary(docs: DataFrame, least: int = 2) -> DataFrame:
    """word, n: the distinct words of all texts that occur `least` times at least. A null or empty text has no words; a repeated
    row counts again; in a document without doc_id no run loses a code point."""
    words = docs.select("doc_id", F.col("text").cast("string")).where("text is not null").mapInArrow(_count, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def one_edit(a: str, b: str) -> bool:
    """Whether exactly one inserted, deleted or replaced code point leads from a to b."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    low, high = 0, min(len(a), len(b))
    while low < high:  # length of the common prefix
        mid = (low + high + 1) // 2
        low, high = (mid, high) if a[low:mid] == b[low:mid] else (low, mid - 1)
    return a[low + (len(a) >= len(b)) :] == b[low + (len(b) >= len(a)) :]


class SortedWords:
    """A block of the sorted list: letters, lengths, and the common prefix of each word with the one before it."""

    def __init__(self, words: list[str]):
        self.words = words
        self.size = np.array([len(w) for w in words], np.int64)
        self.at = np.concatenate([[0], np.cumsum(self.size)])
        self.letters = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        width = int(min(self.size.max(initial=0), DEPTH))
        at = self.at[:-1, None] + np.arange(width)
        inside = np.arange(width) < self.size[:, None]
        self.grid = np.where(inside, self.letters[np.where(inside, at, 0)], 0) if width and len(self.letters) else np.zeros((len(words), 0), np.uint32)
        same = (self.grid[1:] == self.grid[:-1]) & inside[1:]
        self.lcp = np.concatenate([[0], np.where(same.all(axis=1), width, same.argmin(axis=1)) if width else np.zeros(len(words) - 1, np.int64)]).astype(np.int64)

    def pairs(self, queries: list[str], shared: list[int]) -> Iterator[tuple[int, int]]:
        """Numbers of queries and words one edit apart, where the word begins with the first shared[i] letters of query i."""
        for at in range(0, len(queries), BLOCK):
            q, w = self._near(queries[at : at + BLOCK], shared[at : at + BLOCK])
            yield from zip((q + at).tolist(), w.tolist(), strict=True)

    def _near(self, queries: list[str], shared: list[int]) -> tuple[np.ndarray, np.ndarray]:
        words, width = self.words, self.grid.shape[1]
        low, high, begin = [], [], []
        for q, h in zip(queries, shared, strict=True):
            low.append(a := bisect_left(words, q[:h]))
            high.append(bisect_right(words, q[:h] + END, a))
            begin.append(min(h, width))
        low, high, begin = (np.array(x, np.int64) for x in (low, high, begin))
        length = np.array([len(q) for q in queries], np.int64)
        flat = np.frombuffer("".join(queries).encode("utf-32-le"), np.uint32)
        start = np.cumsum(length) - length
        cols = np.arange(-1, width + 2)  # letter j of a query stands in column j + 1; outside of it there is none
        inside = (cols >= 0) & (cols < length[:, None])
        letter = np.where(inside, flat[np.where(inside, start[:, None] + cols, 0)], 1) if len(flat) else np.ones((len(queries), width + 3), np.uint32)
        pairs: list[tuple[np.ndarray, np.ndarray]] = []
        # ranges of words that share a prefix of the depth with their query's row: cells of the letters depth - 1 to depth + 1
        (q, lo, hi), row = (np.empty(0, np.int64) for _ in range(3)), np.empty((0, 3), np.int8)
        for depth in range(int(begin.min(initial=width)), width + 1):
            new = np.flatnonzero((begin == depth) & (low < high))
            q, lo, hi = np.concatenate([q, new]), np.concatenate([lo, low[new]]), np.concatenate([hi, high[new]])
            row = np.concatenate([row, np.tile(np.array([1, 0, 1], np.int8), (len(new), 1))])
            # words that end here are the first of their range
            ends = self.size[lo] == depth
            if ends.any():
                cell = length[q] - depth + 1
                hit = ends & (cell >= 0) & (cell <= 2)
                hit[hit] = row[np.flatnonzero(hit), cell[hit]] == 1
                pairs.append((q[hit], lo[hit]))
                lo = lo + ends
                alive = lo < hi
                q, lo, hi, row = q[alive], lo[alive], hi[alive], row[alive]
            if depth == width or not len(q):
                continue
            heads = np.append(np.flatnonzero(self.lcp <= depth), len(words))  # where the next letter changes
            first, last = np.searchsorted(heads, lo, "right"), np.searchsorted(heads, hi, "left")
            n = last - first + 1
            of = np.repeat(np.arange(len(q)), n)
            k = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
            child = np.where(k == 0, lo[of], heads[first[of] + k - 1])
            until = np.where(k == n[of] - 1, hi[of], heads[np.minimum(first[of] + k, len(heads) - 1)])
            c, of_q, r = self.grid[child, depth], q[of], row[of]
            a = np.minimum(r[:, 1] + 1, r[:, 0] + (c != letter[of_q, depth]))
            b = np.minimum(np.minimum(r[:, 1] + (c != letter[of_q, depth + 1]), r[:, 2] + 1), a + 1)
            d = np.minimum(r[:, 2] + (c != letter[of_q, depth + 2]), b + 1)
            keep = np.minimum(np.minimum(a, b), d) <= 1  # else the whole range is skipped
            q, lo, hi, row = of_q[keep], child[keep], until[keep], np.stack([a, b, d], axis=1)[keep].astype(np.int8)
        for i, a, b in zip(q.tolist(), lo.tolist(), hi.tolist(), strict=True):  # deeper than the grid
            some = np.array([j for j in range(a, b) if one_edit(queries[i], words[j])], np.int64)
            pairs.append((np.full(len(some), i, np.int64), some))
        return (np.concatenate([p[0] for p in pairs]), np.concatenate([p[1] for p in pairs])) if pairs else (np.empty(0, np.int64), np.empty(0, np.int64))


def first_part(size: int, back: bool) -> int:
    """Letters that a word of this size shares with those of its neighbourhood in a list, forwards or of reversed words."""
    h = (size - 1) // 2
    return size - h if back else h


def _found(block: SortedWords, counts: list[int], queries: list[str], ns: list[int], back: bool) -> dict[str, list]:
    """Of each query: how many near words the block adds, and the one of the largest count."""
    near, best = [0] * len(queries), [None] * len(queries)
    for q, w in block.pairs(queries, [first_part(len(q), back) for q in queries]):
        query, word = queries[q], block.words[w]
        if back:
            if word.endswith(query[-first_part(len(query), False) :]):
                continue  # they share the first part too: the other list has them
            word = word[::-1]
        near[q] += 1
        if best[q] is None or (-counts[w], word) < best[q]:
            best[q] = (-counts[w], word)
    return {"word": [q[::-1] for q in queries] if back else queries, "n": ns, "near": near, "form_n": [b and -b[0] for b in best], "form": [b and b[1] for b in best]}


_KINDS = pa.schema([("word", pa.string()), ("n", pa.int64()), ("near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])


def _within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each block looked up in it."""
    for batch in batches:
        for back, words, counts in zip(*(batch.column(c).to_pylist() for c in ("back", "words", "counts")), strict=True):
            yield pa.RecordBatch.from_pydict(_found(SortedWords(words), counts, words, counts, back), _KINDS)


def _beyond(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Words that other blocks sent, looked up in theirs."""
    for batch in batches:
        for back, words, counts, queries, ns in zip(*(batch.column(c).to_pylist() for c in ("back", "words", "counts", "queries", "ns")), strict=True):
            yield pa.RecordBatch.from_pydict(_found(SortedWords(words), counts, queries, ns, back), _KINDS)


def reached(query: str, shared: int, firsts: list[str], lasts: list[str]) -> list[int]:
    """Blocks, by their first and last words, that may hold a near word of the query with the same first letters. Of a block
    whose words share a prefix more than one edit away all blocks with that prefix are skipped."""
    part, out = query[:shared][:DEPTH], []
    i, stop = bisect_left(lasts, part), bisect_right(firsts, part + END)
    while i < stop:
        a, b = firsts[i], lasts[i]
        k = 0
        while k < min(len(a), len(b)) and a[k] == b[k]:
            k += 1
        row, depth = (1, 0, 1), min(shared, k)
        while depth < k and min(row) <= 1:
            x, y, z = (query[j] if 0 <= j < len(query) else "" for j in (depth - 1, depth, depth + 1))
            p = min(row[1] + 1, row[0] + (a[depth] != x))
            s = min(row[1] + (a[depth] != y), row[2] + 1, p + 1)
            row, depth = (p, s, min(row[2] + (a[depth] != z), s + 1)), depth + 1
        if min(row) <= 1:
            out.append(i)
            i += 1
        else:
            i = max(i + 1, bisect_left(lasts, a[:depth] + END, i))
    return out


def _cut(size: int):
    """Sorted rows of a partition -> blocks of `size` words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("part", "back", "s", "n")), strict=True)

        for (part, back), some in groupby(rows(), lambda r: r[:2]):
            block, i = [], 0
            for r in some:
                block.append(r)
                if len(block) == size:
                    yield made(part, back, i, block)
                    block, i = [], i + 1
            if block:
                yield made(part, back, i, block)

    def made(part: int, back: bool, i: int, block: list) -> pa.RecordBatch:
        words, counts = [r[2] for r in block], [r[3] for r in block]
        row = {"block": [(part << 33) + (i << 1) + back], "back": [back], "first": [words[0][:DEPTH]], "last": [words[-1][:DEPTH]], "words": [words], "counts": [counts]}
        return pa.RecordBatch.from_pydict(row, _BLOCK)

    return run


_BLOCK = pa.schema([("block", pa.int64()), ("back", pa.bool_()), ("first", pa.string()), ("last", pa.string()), ("words", pa.list_(pa.string())), ("counts", pa.list_(pa.int64()))])
_SENT = pa.schema([("block", pa.int64()), ("queries", pa.list_(pa.string())), ("ns", pa.list_(pa.int64()))])


def _sent(bounds):
    """The words of each block that other blocks may hold near words of, in one row a block and other block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, back, words, counts in zip(*(batch.column(c).to_pylist() for c in ("block", "back", "words", "counts")), strict=True):
                blocks, firsts, lasts = bounds.value[back]
                to: dict[int, tuple[list, list]] = {}
                for word, n in zip(words, counts, strict=True):
                    for i in reached(word, first_part(len(word), back), firsts, lasts):
                        if blocks[i] != own:
                            qs, ns = to.setdefault(blocks[i], ([], []))
                            qs.append(word)
                            ns.append(n)
                if to:
                    yield pa.RecordBatch.from_pydict({"block": list(to), "queries": [x[0] for x in to.values()], "ns": [x[1] for x in to.values()]}, _SENT)

    return run


def sorted_blocks(words: DataFrame, size: int = BLOCK, most: int = BLOCKS) -> DataFrame:
    """word, n -> blocks of neighbours in the sorted list of words and in that of reversed words; at most some `most` blocks a
    list: with more words, blocks grow."""
    size = max(size, -(-words.count() // most))
    both = words.select(F.lit(False).alias("back"), F.col("word").alias("s"), "n").union(words.select(F.lit(True), F.reverse("word"), "n"))
    ranged = both.repartitionByRange("back", "s").sortWithinPartitions("back", "s").select(F.spark_partition_id().alias("part"), "back", "s", "n")
    return written(ranged.mapInArrow(_cut(size), "block long, back boolean, first string, last string, words array<string>, counts array<long>"), "blocks")


def near_words(words: DataFrame, size: int = BLOCK, most: int = BLOCKS) -> DataFrame:
    """word, n (a table, words distinct, runs of letters of at least LEAST) -> word, n, n_near, and the near word of largest n, of equals the
    first by code points: near_n, near_word (null without one)."""
    blocks = sorted_blocks(words, size, most)
    bounds: dict[bool, tuple[list, list, list]] = {False: ([], [], []), True: ([], [], [])}
    # at most `most` blocks a list and one a partition, DEPTH letters a bound
    for r in blocks.select("back", "first", "last", "block").orderBy("back", F.shiftright("block", 33), "block").collect():
        for to, x in zip(bounds[r.back], (r.block, r.first, r["last"]), strict=True):
            to.append(x)
    own = blocks.select("back", "words", "counts").mapInArrow(_within, FOUND)
    sent = blocks.select("block", "back", "words", "counts").mapInArrow(_sent(words.sparkSession.sparkContext.broadcast(bounds)), "block long, queries array<string>, ns array<long>")
    away = sent.join(blocks.select("block", "back", "words", "counts"), "block").drop("block").mapInArrow(_beyond, FOUND)
    best = F.min(F.when(F.col("form").isNotNull(), F.struct((-F.col("form_n")).alias("n"), F.col("form").alias("word")))).alias("best")
    out = own.union(away).groupBy("word").agg(F.max("n").alias("n"), F.sum("near").alias("n_near"), best)
    return out.select("word", "n", "n_near", (-F.col("best.n")).alias("near_n"), F.col("best.word").alias("near_word"))


def roots(links: DataFrame) -> DataFrame:
    """word, form (a form's own form is more frequent, so chains end) -> word, root: the last form. Each round doubles the steps."""
    now = written(links.select("word", F.col("form").alias("root"), F.lit(True).alias("on")), "links")
    while not now.where("on").isEmpty():
        then = now.select(F.col("word").alias("root"), F.col("root").alias("far"))
        now = written(now.join(then, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("on")), "links")
    return now.select("word", "root")


def spelling_groups(words: DataFrame, times: int = 10, size: int = BLOCK, most: int = BLOCKS) -> DataFrame:
    """word, n -> word, form, root, n, n_near, form_n. A word's near words differ from it by exactly one inserted, deleted or replaced
    code point. Its form is its near word of largest n (of equals the first by code points) if that n is at least `times` its
    own; root follows the forms to the last, and is the word itself without one. An empty vocabulary has no rows. Words are
    distinct, of letters up to U+00FF, and of any length from LEAST on."""
    with scratch(words.sparkSession):
        found = near_words(written(words, "words"), size, most)
        has = F.col("near_n") >= times * F.col("n")
        found = written(found.select("word", F.when(has, F.col("near_word")).alias("form"), "n", "n_near", F.when(has, F.col("near_n")).alias("form_n")), "spellings")
        to = roots(found.where("form is not null"))
        out = found.join(to, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
        return written(out, "groups", keep=True)


def op13_spelling(spark, sf_dir: str) -> DataFrame:
    return spelling_groups(vocabulary(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")))


OP13_SQL = r"""
with recursive u as (select doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run from documents where text is not null),
r as (select row_number() over () as id, doc_id, run, k, hex(encode(cast(doc_id as varchar) || ':' || run)) as h from (select doc_id, run, count(*) as k from u where length(run) >= 7 group by doc_id, run)),
t(k, v) as (select k, list_reduce(list_concat([k], range(8)), lambda a, i: xor(a >> 1, 3988292384 * (a & 1))) from (select unnest(range(256)) as k)),
c(id, h, i, v) as (select id, h, 0, cast(4294967295 as bigint) from r where h is not null
  union all select c.id, c.h, c.i + 1, xor(c.v >> 8, t.v) from c join t on t.k = xor(c.v & 255, cast('0x' || substr(c.h, 2 * c.i + 1, 2) as bigint)) where 2 * c.i < length(c.h)),
d as (select id, xor(v, 4294967295) as crc from c where 2 * i = length(h)),
w as (select case when crc % 31 = 0 then substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) else run end as word, k from r left join d using (id)),
v as (select word, cast(sum(k) as bigint) as n from w where length(word) >= 7 group by word having sum(k) >= 2),
x as (select word, n, length(word) as size, i, substr(word, 1, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from v)),
p as (select a.word, b.word as near, b.n from x a join x b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union select x.word, v.word, v.n from x join v on v.word = x.rest
  union select v.word, x.word, x.n from x join v on v.word = x.rest),
b as (select word, count(*) as n_near, max(n) as best, arg_min(near, (-n, near)) as near from p group by word),
f as (select v.word, v.n, coalesce(b.n_near, 0) as n_near, case when b.best >= 10 * v.n then b.near end as form, case when b.best >= 10 * v.n then b.best end as form_n from v left join b using (word)),
s(word, root, i) as (select word, coalesce(form, word), 0 from f union all select s.word, f.form, s.i + 1 from s join f on s.root = f.word where f.form is not null),
e as (select word, arg_max(root, i) as root from s group by word)
select f.word, form, root, n, cast(n_near as bigint) as n_near, form_n from f join e using (word)
"""
