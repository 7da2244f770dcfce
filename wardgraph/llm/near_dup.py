"""MinHash near-duplicates with tensored banding.

Two collections of half-keys, A and B, are made of `rows` minhashes each. Table (i, j) is keyed by A_i and B_j, so
2 * halves * rows minhashes give halves ** 2 tables of 2 * rows minhashes; a pair of similarity s shares a table with
probability (1 - (1 - s ** rows) ** halves) ** 2, which is 0.9993 at 0.8 with the defaults and more above it. Half-keys
that no two classes share are dropped before tables are formed.

Texts with the same shingle set are one class from the start, whose node is a number of its own. Each class is tied to the smallest class of each of its
buckets; what hangs together so is a cluster of candidates, in which links are confirmed on the full shingle sets
(64-bit hashes of shingles). A task counts all intersections of a block of bounded size by matrix products and returns
a spanning tree of the links it finds, so no list of pairs is ever formed. A cluster larger than a block is cut by hash
into blocks that share a few classes, which ties together most of what is linked in time linear in its size. If it is
in several parts then, those outside the largest part meet each other and the largest part in pairs of blocks, by size
of the sets and by hash, where they can hold a link; pairs inside a part need no second look.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgraph.llm.common import free_names, own_columns, scratch, text_key, with_string_text, written
from wardgraph.llm.tokens import forget

FEATURES = "n_shingles long, k1 long, k2 long, a array<long>, b array<long>"
#: Bounds of a block: shingles and classes. A class of more shingles is a block of its own.
BLOCK_SHINGLES, BLOCK_CLASSES = 1_000_000, 1_000
#: So many classes of a large cluster, about, are in each of its blocks.
SHARED_CLASSES = 16


def shingle_hashes(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of a text; of the whole sequence, if it has fewer words."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
    k = min(k, len(h))
    g = h[: len(h) - k + 1]
    for j in range(1, k):
        g = (g ^ (g >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + h[j : len(h) - k + 1 + j]
    g = (g ^ (g >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return np.unique(g ^ (g >> np.uint64(32)))


def set_key(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits of a shingle set, as two signed numbers."""
    a, b = np.frombuffer(xxhash.xxh3_128_digest(shingles.tobytes()), np.int64)
    return int(a), int(b)


def minhashes(shingles: np.ndarray, mult: np.ndarray, add: np.ndarray) -> np.ndarray:
    """One minimum for each (odd multiplier, addend); long sets go through in blocks."""
    x, low = (shingles >> np.uint64(32)).astype(np.uint32), np.full(len(mult), 0xFFFFFFFF, np.uint32)
    for at in range(0, len(x), 2048):
        np.minimum(low, (x[at : at + 2048, None] * mult + add).min(axis=0), out=low)
    return low


def _features(k: int, halves: int, rows: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()  # what earlier stages left in this worker
        rng = np.random.default_rng(seed)
        n = 2 * halves * rows
        mult, add = (rng.integers(0, 2**32, n, dtype=np.uint64).astype(np.uint32) for _ in range(2))
        mult |= np.uint32(1)
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            for text in batch.column(1).to_pylist():
                s = shingle_hashes(text, k)
                if not len(s):
                    for col, v in zip(out, (0, None, None, None, None), strict=True):
                        col.append(v)
                    continue
                low = minhashes(s, mult, add)
                key = set_key(s)
                g = low.reshape(2 * halves, rows).astype(np.uint64)
                mix = g[:, 0].copy()
                for j in range(1, rows):
                    mix = (mix ^ (mix >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15) + g[:, j]
                mix = mix.view(np.int64).tolist()
                for col, v in zip(out, (len(s), *key, mix[:halves], mix[halves:]), strict=True):
                    col.append(v)
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(out, kinds, strict=True))], names=["row", "n_shingles", "k1", "k2", "a", "b"])

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                node, text, k1, k2, blocks = part.columns
                sets = [shingle_hashes(t, k) for t in text.to_pylist()]
                if any(set_key(s) != key for s, key in zip(sets, zip(k1.to_pylist(), k2.to_pylist(), strict=True), strict=True)):
                    raise ValueError("a text differs from the one first read: the input must be read alike twice; write it to a table first")
                yield pa.RecordBatch.from_arrays([node, pa.array([s.tobytes() for s in sets], pa.binary()), blocks], names=["node", "s", "blocks"])

    return run


def intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs: shingles of few sets are counted by pair, others by matrix products."""
    n = len(sets)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    flat = np.concatenate(sets)
    by = np.argsort(flat, kind="stable")
    flat, owner = flat[by], owner[by]
    first = np.flatnonzero(np.concatenate([[True], flat[1:] != flat[:-1]]))
    df = np.diff(np.append(first, len(flat)))
    both = np.zeros(n * n, np.int64)
    for d in range(2, 9):
        at = first[df == d]
        if len(at):
            some = owner[at[:, None] + np.arange(d)]
            i, j = np.triu_indices(d, 1)
            both += np.bincount((some[:, i] * n + some[:, j]).ravel(), minlength=n * n)
    both = both.reshape(n, n)
    both += both.T
    many = np.flatnonzero(df > 8)
    for at in range(0, len(many), 2048):
        some = many[at : at + 2048]
        x = np.zeros((n, len(some)), np.float32)
        size = df[some]
        x[owner[np.repeat(first[some], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)], np.repeat(np.arange(len(some)), size)] = 1
        both += (x @ x.T).astype(np.int64)
    return both


def spanning_links(nodes: np.ndarray, sets: list[np.ndarray], num: int, den: int) -> list[tuple[int, int]]:
    """(smallest node of a component, node) for the components over links within a block."""
    if len(nodes) < 2:
        return []
    both, size = intersections(sets), np.array([len(s) for s in sets])
    link = den * both >= num * (size[:, None] + size[None, :] - both)
    out, left = [], np.ones(len(nodes), bool)
    for i in np.argsort(nodes, kind="stable"):
        if left[i]:
            seen = front = np.arange(len(nodes)) == i
            while front.any():
                front = link[front].any(axis=0) & ~seen
                seen = seen | front
            left &= ~seen
            out += [(int(nodes[i]), int(v)) for v in nodes[seen] if v != nodes[i]]
    return out


def _block_links(num: int, den: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (block, node, s) by block, each block whole in this task."""
        key, nodes, sets, out = None, [], [], []

        def batch():
            return pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([y for _, y in out], pa.int64())], names=["src", "dst"])

        for b in batches:
            for k, node, s in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), strict=True):
                if k != key:
                    out += spanning_links(np.array(nodes), sets, num, den)
                    key, nodes, sets = k, [], []
                nodes.append(node)
                sets.append(np.frombuffer(s.as_py(), np.uint64))
        out += spanning_links(np.array(nodes), sets, num, den)
        yield batch()

    return run


def connected_components(edges: DataFrame) -> DataFrame:
    """(src, dst) -> (node, comp), comp the smallest node that can be reached: least labels spread to neighbours and
    along labels until none changes, which takes a number of rounds logarithmic in a chain's length."""
    both = edges.select("src", "dst").union(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    both = written(both.where("src <> dst").distinct(), "edges")
    label = written(both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("m")).select("node", F.least("node", "m").alias("comp")), "label")
    while True:
        near = both.join(label.withColumnRenamed("node", "dst"), "dst").groupBy(F.col("src").alias("node")).agg(F.min("comp").alias("m"))
        step = written(label.join(near, "node").select("node", F.least("comp", "m").alias("comp"), F.col("comp").alias("was")), "step")
        up = step.select(F.col("node").alias("comp"), F.col("comp").alias("up"))
        now = written(step.join(up, "comp", "left").select("node", F.least("comp", F.coalesce("up", "comp")).alias("comp"), "was"), "label")
        if now.where("comp <> was").isEmpty():
            return now.select("node", "comp")
        label = now.select("node", "comp")


def near_duplicates(docs: DataFrame, **how) -> DataFrame:
    """(doc_id, text) -> doc_id, n_shingles, component_id: the smallest doc_id reachable over links of at least
    num / den Jaccard similarity. One row for each row of docs; doc_id keeps its type. how: see `classified`.

    A text that is null, empty or white space has no shingles and is its own component. Rows that share a doc_id are
    judged by their own texts, so different texts stay apart. Rows without doc_id take part in all links; a component
    whose rows all have none has none.
    """
    feats, of = classified(docs, **how)
    # both sides are tables: AQE splits the rows of a class with very many copies
    full = feats.where("n_shingles > 0").select("row", "n_shingles", "k1", "k2").join(of.select("k1", "k2", "top"), ["k1", "k2"])
    full = full.select("row.doc_id", "n_shingles", F.col("top.doc_id").alias("component_id"))
    return full.union(feats.where("n_shingles = 0").select("row.doc_id", "n_shingles", F.col("row.doc_id").alias("component_id")))


def deduplicated(docs: DataFrame, **how) -> DataFrame:
    """The rows of docs, with their columns, of which one of each component stays: that of the smallest doc_id (rows
    without one come last; of equal ids, the text of the smallest hash). Texts without words are in no component and
    stay. Rows of the same doc_id and text are one document, of which one row stays."""
    docs = with_string_text(docs)
    feats, of = classified(docs, **how)
    k, a, b = free_names(docs, "__text", "__a", "__b")
    # 128 bits of a document: its id and text
    key = lambda i, t: [F.xxhash64(F.lit(x), i, F.isnull(i), f"{t}.a", f"{t}.b").alias(name) for x, name in (("a", a), ("b", b))]
    kept = of.select(*key("top.doc_id", "top.text")).distinct()
    kept = kept.union(feats.where("n_shingles = 0").select(*key("row.doc_id", "row.text")).distinct())
    # rows of one document are put together before they are shuffled; the join takes the same key, so texts move once
    rows = docs.withColumn(k, text_key()).select(*own_columns(docs), *key("doc_id", k)).dropDuplicates([a, b])
    return rows.join(kept, [a, b], "left_semi").select(*own_columns(docs))


def classified(docs: DataFrame, shingle: int = 4, num: int = 80, den: int = 100, halves: int = 20, rows: int = 5, seed: int = 11, small_keys: int = 500_000) -> tuple[DataFrame, DataFrame]:
    """(doc_id, text) -> the features of all rows, and the classes: k1, k2 (of the shingle set) and top, the first
    document of the class's component, as doc_id and text key.

    small_keys: up to so many block keys of candidates are broadcast to pick their texts; beyond, texts and keys meet in
    a shuffle.
    """
    with scratch(docs.sparkSession):
        return _classified(docs, shingle, num, den, halves, rows, seed, small_keys)


def _classified(docs: DataFrame, shingle: int, num: int, den: int, halves: int, rows: int, seed: int, small_keys: int) -> tuple[DataFrame, DataFrame]:
    docs = with_string_text(docs).select("doc_id", "text", text_key().alias("key"))
    row = F.struct(F.isnull("doc_id").alias("none"), "doc_id", F.col("key").alias("text"))
    keyed = docs.select(row.alias("row"), "text")
    feats = written(keyed.mapInArrow(_features(shingle, halves, rows, seed), f"row {keyed.schema['row'].dataType.simpleString()}, {FEATURES}"), "features", keep=True)
    # one row a shingle set; its number is any that no other has, fixed by being written
    classes = feats.where("n_shingles > 0").groupBy("k1", "k2").agg(F.min("row").alias("top"), F.first("n_shingles").alias("n_shingles"), F.first("a").alias("a"), F.first("b").alias("b"))
    classes = written(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    comps = _components(docs, classes, shingle, num, den, small_keys)
    linked = comps.join(classes.select("node", "k1", "k2", "top"), "node")
    tops = written(linked.groupBy("comp").agg(F.min("top").alias("of")), "tops")
    linked = written(linked.select("k1", "k2", "comp"), "linked").join(tops, "comp").select("k1", "k2", "of")
    of = classes.select("k1", "k2", "top").join(linked, ["k1", "k2"], "left").select("k1", "k2", F.coalesce("of", "top").alias("top"))
    return feats, written(of, "of", keep=True)


def _components(docs: DataFrame, classes: DataFrame, shingle: int, num: int, den: int, small_keys: int) -> DataFrame:
    """(node, comp) of the classes that are linked."""
    reps = classes.select("node", "n_shingles", "a", "b")

    # half-keys that at least two classes share; then the tables of those
    def half(side: str) -> DataFrame:
        return reps.select("node", F.lit(side).alias("side"), F.posexplode(side).alias("i", "v")).select("node", "side", F.xxhash64("side", "i", "v").alias("h"))

    halved = written(half("a").union(half("b")), "halves")
    shared = halved.groupBy("h").agg(F.count("*").alias("n")).where("n > 1").select("h")
    live = halved.join(shared, "h").groupBy("node").agg(*(F.collect_list(F.when(F.col("side") == s, F.col("h"))).alias(s) for s in "ab"))
    keys = F.flatten(F.transform("a", lambda a: F.transform("b", lambda b: F.xxhash64(a, b))))
    member = written(live.where("size(a) > 0 and size(b) > 0").select("node", F.explode(keys).alias("key")), "tables")
    # a table, so that AQE can split the classes of a key that very many share
    centres = written(member.groupBy("key").agg(F.count("*").alias("n"), F.min("node").alias("centre")).where("n > 1").select("key", "centre"), "centres")
    # a class hangs on its smallest centre, and so do its other centres (at most halves ** 2): that many classes name the
    # same centres makes no more ties
    met = member.join(centres, "key").where("node <> centre").groupBy("node").agg(F.array_sort(F.collect_set("centre")).alias("c"))
    ties = met.select(F.col("c")[0].alias("src"), F.explode(F.concat(F.array("node"), F.slice("c", 2, F.size("c")))).alias("dst")).distinct()
    cluster = connected_components(ties).withColumnRenamed("comp", "cluster")
    tops = classes.select("node", "n_shingles", "k1", "k2", "top")
    cluster = written(cluster.join(tops, "node"), "clusters")

    # first round: a small cluster is one block; a larger one is cut by hash, with some of its classes in every block
    own = F.greatest(F.ceil(F.sum("n_shingles") / BLOCK_SHINGLES), F.ceil(F.count("*") / BLOCK_CLASSES)).cast("int")
    cuts = written(cluster.groupBy("cluster").agg(own.alias("own"), F.count("*").alias("n")), "cuts")
    key = lambda *of: F.concat_ws(":", F.col("cluster"), *of)
    everywhere = (F.pmod(F.xxhash64(F.lit("everywhere"), "node"), F.col("n")) < SHARED_CLASSES) & (F.col("own") > 1)
    blocks = F.when(everywhere, F.transform(_up_to("own"), lambda j: key(j))).otherwise(F.array(key(_slot("own"))))
    placed = written(cluster.join(cuts, "cluster").select("node", "cluster", "n_shingles", "k1", "k2", "top", "own", blocks.alias("blocks")), "placed")
    links = _decided(docs, placed, shingle, num, den, small_keys)
    comps = connected_components(links)
    of = ["node", "cluster", "n_shingles", "k1", "k2", "top"]
    large = placed.where("own > 1").select(*of)
    if large.isEmpty():
        return comps

    # second round: of clusters in several parts, the classes outside the largest part meet each other and that part
    parts = written(large.join(comps, "node", "left").select(*of, F.coalesce("comp", "node").alias("comp")), "parts")
    sizes = parts.groupBy("cluster", "comp").agg(F.count("*").alias("n"))
    split = written(sizes.groupBy("cluster").agg(F.max(F.struct("n", "comp"))["comp"].alias("largest"), F.count("*").alias("parts")).where("parts > 1"), "split")
    # sets of a link are of one size class or of neighbouring ones
    size_class = F.floor(F.log(F.col("n_shingles").cast("double")) / math.log(den / num)).cast("int")
    rest = parts.join(split, "cluster").select(*of, size_class.alias("class"), (F.col("comp") == F.col("largest")).alias("main"))
    rest = written(rest, "parts")
    if rest.isEmpty():
        return comps
    cells = rest.groupBy("cluster", "class", "main").agg(own.alias("own"))
    other = cells.select("cluster", F.col("class").alias("c"), F.col("main").alias("m"), F.col("own").alias("k"))
    near = cells.withColumn("c", F.explode(F.array(F.col("class") - 1, F.col("class"), F.col("class") + 1))).join(other, ["cluster", "c"]).where("not (main and m)")
    near = near.groupBy("cluster", "class", "main", "own").agg(F.collect_list(F.struct("c", "m", "k")).alias("near"))  # six at most
    side = lambda c, m, slot: F.concat_ws("/", c, m.cast("string"), slot)
    mine = side(F.col("class"), F.col("main"), _slot("own"))
    meet = lambda theirs: key(F.least(mine, theirs), F.greatest(mine, theirs))
    blocks = F.flatten(F.transform("near", lambda x: F.transform(_up_to(x["k"]), lambda j: meet(side(x["c"], x["m"], j)))))
    again = written(rest.join(written(near, "near"), ["cluster", "class", "main"]).select("node", "k1", "k2", "top", blocks.alias("blocks")), "placed")
    return connected_components(links.union(_decided(docs, again, shingle, num, den, small_keys)))


def _slot(n: str):
    return F.pmod(F.xxhash64("node"), F.col(n)).cast("int")


def _up_to(n):
    return F.sequence(F.lit(0), (F.col(n) if isinstance(n, str) else n) - 1)


def _decided(docs: DataFrame, placed: DataFrame, shingle: int, num: int, den: int, small_keys: int) -> DataFrame:
    """placed: node, its set's key, its document, blocks -> (src, dst), links that span what hangs together in each
    block. Texts of placed nodes alone are read again; with up to small_keys block keys in all, placed is broadcast."""
    few = (placed.agg(F.sum(F.size("blocks"))).first()[0] or 0) <= small_keys
    placed = placed.select("node", "k1", "k2", F.col("top.doc_id").alias("i"), F.col("top.text").alias("t"), "blocks")
    found = docs.join(F.broadcast(placed) if few else placed, F.col("doc_id").eqNullSafe(F.col("i")) & (F.col("key") == F.col("t")))
    texts = found.select("node", "text", "k1", "k2", "blocks").dropDuplicates(["node"])
    sets = texts.mapInArrow(_sets(shingle), "node long, s binary, blocks array<string>")
    blocks = sets.select(F.explode("blocks").alias("block"), "node", "s").repartition("block").sortWithinPartitions("block")
    return written(blocks.mapInArrow(_block_links(num, den), "src long, dst long").distinct(), "links")


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    """Components of near copies of all documents, on four-word shingles at 0.8."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


OP9_SQL = r"""
with recursive d as (select doc_id, regexp_extract_all(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) end as s from d),
x as (select doc_id, len(s) as n, unnest(s) as g from s),
p as (select a.doc_id as x, b.doc_id as y, a.n as na, b.n as nb, count(*) as both_n from x a join x b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select x, y from p where 100 * both_n >= 80 * (na + nb - both_n)),
e as (select x as a, y as b from l union select y, x from l),
r as (select doc_id as a, doc_id as b from s union select r.a, e.b from r join e on r.b = e.a)
select s.doc_id, cast(len(s.s) as bigint) as n_shingles, m.c as component_id, s.doc_id = m.c as kept
from s join (select a, min(b) as c from r group by a) m on s.doc_id = m.a
"""
