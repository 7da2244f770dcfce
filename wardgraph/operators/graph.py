"""The edge multiset of the chain with weights, and what is computed on it."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgraph.functions.ids import node_type
from wardgraph.operators.telemetry import numbered
from wardgraph.sources.edge_store import EdgeStore
from wardgraph.sources.tables import partitions, written


def edges(stored: DataFrame, cwe_capec: DataFrame, techniques: DataFrame, defend: DataFrame, categories: DataFrame) -> DataFrame:
    """(source, target, value): how many path steps of all vulnerabilities run over each edge.

    stored: (cve_id, cwe_id), parents included; categories: (cve_id, category_id). From weaknesses on, weights are
    carried from hop to hop instead of repeated rows. The facts are grouped once, into a table, and so is each hop, which
    is as large as the knowledge tables: no kind of edge computes the one above it again.
    """
    one = written(stored.groupBy("cve_id", "cwe_id").agg(F.count("*").alias("value")), "facts")
    five = categories.groupBy("cve_id", "category_id").agg(F.count("*").alias("value"))
    return reduce(DataFrame.unionByName, [*_first(one, five), *_below(one, cwe_capec, techniques, defend)])


def list_edges(lists: DataFrame, cwe_capec: DataFrame, techniques: DataFrame, defend: DataFrame) -> DataFrame:
    """edges() of cve_id, cwe and owasp, a table with a row a vulnerability as chain.weakness_lists makes it: no fact is dealt again."""
    one, five = _listed(lists, "cwe", "cwe_id"), _listed(lists, "owasp", "category_id")
    return reduce(DataFrame.unionByName, [*_first(one, five), *_below(one, cwe_capec, techniques, defend)])


def list_neighbours(lists: DataFrame, cwe_capec: DataFrame, techniques: DataFrame, defend: DataFrame) -> DataFrame:
    """neighbour_texts() of list_edges(): a vulnerability's targets are together in its row, and no edge leads to it. lists are read once."""
    named = lambda p, c: F.transform(c, lambda x: F.concat(F.lit(p), x))
    whole = written(lists.select(F.col("cve_id").alias("source"), F.concat(named("CWE-", "cwe"), named("OWASP-", "owasp")).alias("targets")), "whole")
    one = whole.select(F.explode("targets").alias("target")).where(F.col("target").startswith("CWE-"))
    one = one.select(F.substring("target", 5, 1 << 30).alias("cwe_id"), F.lit(1).cast("long").alias("value"))
    return neighbour_texts(reduce(DataFrame.unionByName, _below(one, cwe_capec, techniques, defend)), whole)


def _listed(lists: DataFrame, column: str, name: str) -> DataFrame:
    return lists.select("cve_id", F.explode(column).alias(name), F.lit(1).cast("long").alias("value"))


def _node(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column))


def _first(one: DataFrame, five: DataFrame) -> list[DataFrame]:
    """The edges of vulnerabilities, to weaknesses and to categories."""
    return [
        one.select(F.col("cve_id").alias("source"), _node("CWE-", "cwe_id").alias("target"), "value"),
        five.select(F.col("cve_id").alias("source"), _node("OWASP-", "category_id").alias("target"), "value"),
    ]


def _below(one: DataFrame, cwe_capec: DataFrame, techniques: DataFrame, defend: DataFrame) -> list[DataFrame]:
    """The edges from weaknesses on, hop by hop."""
    cwe = one.groupBy("cwe_id").agg(F.sum("value").alias("w"))
    two = written(cwe.join(cwe_capec, "cwe_id").groupBy("cwe_id", "capec_id").agg(F.sum("w").alias("value")), "hop")
    capec = two.groupBy("capec_id").agg(F.sum("value").alias("w"))
    three = written(capec.join(techniques, "capec_id").groupBy("capec_id", "technique_id").agg(F.sum("w").alias("value")), "hop")
    tech = three.groupBy(_node("T", "technique_id").alias("technique_id")).agg(F.sum("value").alias("w"))
    four = tech.join(defend, "technique_id").groupBy("technique_id", "d3f_id").agg(F.sum("w").alias("value"))
    return [
        two.select(_node("CWE-", "cwe_id").alias("source"), _node("CAPEC-", "capec_id").alias("target"), "value"),
        three.select(_node("CAPEC-", "capec_id").alias("source"), _node("T", "technique_id").alias("target"), "value"),
        four.select(F.col("technique_id").alias("source"), _node("D3F-", "d3f_id").alias("target"), "value"),
    ]


def target_scores(e: DataFrame) -> DataFrame:
    return e.groupBy(F.col("target").alias("node")).agg(F.sum("value").alias("score"))


def rollup_subtechniques(scores: DataFrame) -> DataFrame:
    """Each sub-technique's score is added to its parent too, which is made if it has none of its own."""
    up = scores.where(F.col("node").rlike("T[0-9]+[.][0-9]+")).select(F.substring_index("node", ".", 1).alias("node"), "score")
    return scores.union(up).groupBy("node").agg(F.sum("score").alias("score"))


def max_score(scores: DataFrame) -> DataFrame:
    """The most over all nodes, and over techniques alone; 0 if there are none."""
    tech = F.max(F.when(node_type(F.col("node")) == "technique", F.col("score")))
    return scores.agg(F.greatest(F.coalesce(F.max("score"), F.lit(0)), F.lit(0)).alias("max_score"), F.greatest(F.coalesce(tech, F.lit(0)), F.lit(0)).alias("max_technique_score"))


def node_set(e: DataFrame) -> DataFrame:
    return e.select(F.explode(F.array("source", "target")).alias("node")).distinct()


def trace_back(e: DataFrame | EdgeStore, selected: DataFrame, prefixes: tuple[str | None, ...]) -> DataFrame:
    """Edges into the selected nodes, then into their sources that start with each prefix in turn (None: any). Each hop joins e
    again, so e should be a table, or a store, of which no hop moves an edge."""
    into = e.edges_of if isinstance(e, EdgeStore) else lambda nodes: e.join(nodes.select(F.col("node").alias("target")).distinct(), "target", "left_semi")
    front, found = written(selected.select("node").distinct(), "selected"), []
    for prefix in prefixes:
        step = written(into(front).select("source", "target", "value"), "hop")
        found.append(step)
        front = step.select(F.col("source").alias("node")).distinct()
        front = front if prefix is None else front.where(F.col("node").startswith(prefix))
    found.append(into(front).select("source", "target", "value"))
    return reduce(DataFrame.union, found).distinct()


def neighbours(e: DataFrame) -> DataFrame:
    """Per node its sources and targets, sorted; a hub's list is as long as its degree, as asked, and is gathered in one task. Where
    hubs may be too large for that there are neighbour_texts() and neighbour_stretches()."""
    return _gathered(_sides(e))


def _gathered(sides: DataFrame) -> DataFrame:
    lists = (F.sort_array(F.collect_list(F.when(F.col("side") == side, F.col("other")))).alias(side) for side in ("sources", "targets"))
    unnamed = F.when(F.col("node").isNull(), F.col("side")).alias("unnamed")  # what has no name is no one node
    return sides.groupBy("node", unnamed).agg(*lists).drop("unnamed")


def _sides(e: DataFrame) -> DataFrame:
    """Each edge as seen from its target and from its source: node, side, and the other one. One pass over e."""
    seen = lambda node, side, other: F.struct(F.col(node).alias("node"), F.lit(side).alias("side"), F.col(other).alias("other"))
    return e.select(F.inline(F.array(seen("target", "sources", "source"), seen("source", "targets", "target"))))


#: Neighbours of a node that one task puts in order.
HUB_ROWS = 100_000


#: Edges of a bucket of nodes, about, and buckets of a group; names of a piece of a hub's text, as a power of two; names that one task puts together.
BUCKET_EDGES, GROUP_BUCKETS, PIECE_BITS, TEXT_NAMES = 50_000, 32, 13, 250_000_000


def neighbour_texts(e: DataFrame, whole: DataFrame | None = None, separator: str = ",", most: int = HUB_ROWS, task_names: int = TEXT_NAMES) -> DataFrame:
    """node, sources, targets: as neighbours(), the names of a list joined to a text. whole: more edges, as source and targets, a row a
    source; such a source is no target and has no edge in e, so its row is put in order where it is. Both are read up to four
    times, so they should be tables.

    Nodes are counted in buckets by hash, which lie in groups. Nodes of groups whose buckets have up to `most` edges are gathered where
    they are. The others, and so all hubs, are put in order in ranges by many tasks and joined in pieces. A hub's text alone is as long
    as its degree: pieces are sorted by group, and a task for each `task_names` names puts one node after the other together. So many
    other nodes of its group come between a hub and the next that a writer which looks at its size now and then (Parquet's does after
    10,000 rows at most) does not hold both, where a group has as many."""
    e, n = e.select("source", "target"), e.count()
    sides, own = _sides(e), None
    if whole is not None:
        n += whole.agg(F.coalesce(F.sum(F.size("targets")), F.lit(0))).first()[0]
        named = whole.where("source is not null and size(targets) > 0")
        sides = _sides(e.union(whole.where("source is null").select("source", F.explode("targets"))))
        sides = sides.union(named.select(F.explode("targets").alias("node"), F.lit("sources").alias("side"), F.col("source").alias("other")))
        own = named.select(F.col("source").alias("node"), F.lit("").alias("sources"), F.array_join(F.sort_array("targets"), separator).alias("targets"))
    groups = max(1, n // (BUCKET_EDGES * GROUP_BUCKETS))
    hashed = lambda m: F.pmod(F.xxhash64("node"), F.lit(m))
    buckets = sides.groupBy(hashed(groups * GROUP_BUCKETS).alias("bucket")).agg(F.count("*").alias("n"))
    buckets = buckets.groupBy(F.pmod("bucket", F.lit(groups)).alias("group")).agg(F.max("n").alias("most"), F.sum("n").alias("n"))
    heavy = written(buckets.where(F.col("most") > most), "heavy")  # at most one for `most` edges
    hubs, parts = heavy.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    dealt = lambda how: sides.join(F.broadcast(heavy.select("group")), hashed(groups) == F.col("group"), how)
    few = dealt("left_anti") if hubs else sides
    few = _gathered(few.repartition(partitions(e.sparkSession, n), "node"))
    found = few.select("node", *(F.array_join(side, separator).alias(side) for side in ("sources", "targets")))
    if hubs:
        order = ["node", "side", "other"]
        rows = written(dealt("left_semi"), "hubs").repartitionByRange(partitions(e.sparkSession, hubs), *order)  # which reads up to three times
        rows = rows.sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
        text = F.when(F.count("other") > 0, F.array_join(F.sort_array(F.collect_list("other")), separator))
        pieces = rows.groupBy("node", "side", F.shiftright("at", PIECE_BITS)).agg(F.min("at").alias("at"), text.alias("text"))
        pieces = pieces.withColumn("group", hashed(groups)).repartition(parts, "group").sortWithinPartitions("group", "node", "side", "at")
        pieces = pieces.select("node", "side", "text").coalesce(-(-hubs // task_names))  # a task sorts one part after the other
        found = found.union(pieces.mapInArrow(_put_together(separator), "node string, sources string, targets string"))
    return found if own is None else found.union(own)


def _put_together(separator: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of node, side and text in order -> a row a node. Of texts, one node's are held, once, or some 1 MB of short ones."""
    joint, names = separator.encode(), ["node", "sources", "targets"]

    def nodes(batches):
        last, parts = None, {}
        for batch in batches:
            for node, side, text in zip(batch["node"].to_pylist(), batch["side"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
                key = (node, side if node is None else None)
                if key != last:
                    if last:
                        yield last[0], parts.pop("sources", b""), parts.pop("targets", b"")
                    last = key
                if text is not None:
                    if side in parts:
                        parts[side] += joint
                    parts.setdefault(side, bytearray()).extend(text)
        if last:
            yield last[0], parts.pop("sources", b""), parts.pop("targets", b"")

    def column(texts) -> pa.Array:
        ends = pa.array(np.cumsum([0, *map(len, texts)])).cast(pa.int32())
        return pa.StringArray.from_buffers(len(texts), ends.buffers()[1], pa.py_buffer(texts[0] if len(texts) == 1 else b"".join(texts)))

    def run(batches):
        rows, size = [], 0
        for row in nodes(batches):
            rows.append(row)
            size += len(row[1]) + len(row[2])
            del row
            if size > 1 << 20:
                node, sources, targets = zip(*rows, strict=True)
                rows, size = [], 0
                yield pa.RecordBatch.from_arrays([pa.array(node, pa.string()), column(sources), column(targets)], names)
                del sources, targets
                yield pa.RecordBatch.from_arrays([pa.array([], pa.string())] * 3, names)  # so that nobody keeps a long row while the next one is made
        if rows:
            node, sources, targets = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.string()), column(sources), column(targets)], names)

    return run


def neighbour_stretches(e: DataFrame, size: int = 10_000, most: int = HUB_ROWS) -> DataFrame:
    """node, side (sources or targets), stretch (from 0), nodes: as neighbours(), with at most `size` of them a row. Up to `most` neighbours
    are put in order where the node is; a hub has more and is numbered in ranges by many tasks."""
    sides = _sides(written(e.select("source", "target"), "edges"))
    hubs = sides.groupBy("node", "side").agg(F.count("*").alias("n"), F.count_if(F.col("other").isNull()).alias("unnamed")).where((F.col("n") > most) | (F.col("unnamed") > 0))
    hubs = written(hubs.select("node", "side"), "hubs")
    few = sides.join(hubs, ["node", "side"], "left_anti").groupBy("node", "side").agg(F.sort_array(F.collect_list("other")).alias("all"))
    last = F.greatest(F.ceil(F.size("all") / size) - 1, F.lit(0))
    cut = F.transform(F.sequence(F.lit(0).cast("long"), last), lambda i: F.slice("all", (i * size + 1).cast("int"), size))
    few = few.select("node", "side", F.posexplode(cut).alias("stretch", "nodes")).withColumn("stretch", F.col("stretch").cast("long"))
    at = numbered(sides.join(hubs, ["node", "side"], "left_semi"), ["node", "side"], ["other"], "__n").withColumn("stretch", F.floor((F.col("__n") - 1) / size))
    return few.union(at.groupBy("node", "side", "stretch").agg(F.sort_array(F.collect_list("other")).alias("nodes")))


def marked_above(tree: DataFrame, marked: DataFrame) -> DataFrame:
    """(parent, node) and nodes -> those nodes and all above them. Jumps double in each round, and nodes meet their jump's end
    alone, so a hierarchy of depth d takes log2(d) rounds of as many rows as it has nodes, and no pair of ancestors is made.
    A cycle ends when jumps are longer than it can be."""
    jumps = written(tree.where("parent is not null and node is not null").select("node", F.col("parent").alias("up")).distinct(), "jumps")
    marked, steps, n = written(marked.select("node").distinct(), "marked"), 1, jumps.select("node").distinct().count()
    while steps <= 2 * n and not jumps.isEmpty():
        marked = written(marked.union(jumps.join(marked, "node", "left_semi").select(F.col("up").alias("node"))).distinct(), "marked")
        far = jumps.select(F.col("node").alias("up"), F.col("up").alias("far"))
        jumps, steps = written(jumps.join(far, "up").select("node", F.col("far").alias("up")).distinct(), "jumps"), 2 * steps
    return marked


def hit_groups(tree: DataFrame, scores: DataFrame) -> DataFrame:
    """(parent, node) -> per group: direct children, and those hit: a scored leaf, or a subgroup with a scored leaf anywhere below."""
    tree = written(tree.select("parent", "node"), "tree")
    leaf = tree.select("node").join(tree.select(F.col("parent").alias("node")), "node", "left_anti")
    hit = leaf.join(scores.where("score > 0"), "node", "left_semi")
    above = marked_above(tree, hit).withColumn("is_hit", F.lit(1))
    return tree.join(above, "node", "left").groupBy(F.col("parent").alias("group")).agg(F.count("*").alias("total"), F.count("is_hit").alias("hits"))
