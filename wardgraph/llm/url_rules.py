"""URL filters by association rules.

FP-growth mines combinations of URL tokens, the label being one more item of a labelled URL's basket; one pass over all
baskets then counts each combination. Labels exist only where someone gave them, mostly by site, so there are two kinds of
rules token set -> label. Those of the first kind hold among all URLs, an unlabelled one counting against them: they are
sure, and say little of other pages. Those of the second kind hold among the labelled URLs, above the label's share there,
and on several sites: they hold still when the part of the sites that has most of their evidence is held out. A rule of the
second kind decides where none of the first fits. Rules that pass the least support and confidence, and that no shorter rule
says as surely, are kept in an inverted index under one of their tokens, the rarest among the rules; a URL looks up its own
tokens only.

Tokens that are in the same baskets are one item for mining, and no item of a basket is left out. Baskets that have so many
items that FP-growth could make more than 2 ** most_items / support sets are split, by the first item of a set in an order
from the rarest on, into the baskets that hold it, with their later items, and again until a part is small enough. A part is
left out only where it has no rule that counts: none can reach the confidence, or that of a shorter rule. Each split is a
Spark pass over all parts, and one FP-growth mines all small ones.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import reduce

import pyarrow as pa
from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgraph.llm.common import free_names, written

ALLOW, BLOCK = "allow", "block"
#: (host, path, verdict): the longest rule whose host is the URL's or above it, and whose path starts the URL's, wins.
HOST_RULES = (("com", "/", ALLOW), ("example.com", "/en/", BLOCK), ("www.example.com", "/en/", ALLOW), ("net", "/es/", BLOCK), ("net", "/fr/", BLOCK))
_LABEL = "\x00label="
#: More than rounding may change of a product, so that no bound drops a rule.
_ROUND = 1e-9
#: Parts of the sites, of which a rule's evidence must come from two at least.
PARTS = 64
_SPLIT = re.compile(r"[^0-9A-Za-z\u0080-\U0010ffff]+")


def lower_ascii(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fixed_rule(host: Column, path: Column, rules=HOST_RULES) -> Column:
    """The rule that decides, as host and path, or null: an expression."""
    fits = F.lit(None).cast("string")
    for h, p, _ in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.lit(h + p)).otherwise(fits)
    return fits


def tokens(host: str | None, path: str | None) -> list[str]:
    """What a rule may combine: the host's endings, the words of its other labels, the path's words. Numbers are no words:
    they name single pages. A null host or path has none."""
    host, path = host or "", path or ""
    labels = [x for x in host.split(".") if x]
    out = {f"host:{'.'.join(labels[i:])}" for i in range(1 if len(labels) > 2 else 0, len(labels))}
    out |= {f"name:{w}" for x in labels[:-2] for w in _SPLIT.split(x) if w}
    return sorted(out | {f"path:{w}" for w in _SPLIT.split(path) if w and not w.isdigit()})


def site_of(host: str | None) -> str:
    """The last two labels of a host."""
    return ".".join([x for x in (host or "").split(".") if x][-2:])


def _baskets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """host, path, label -> tokens, label, and the part of the sites."""
    for batch in batches:
        hosts, paths = (batch.column(i).to_pylist() for i in range(2))
        part = [zlib.crc32(site_of(h).encode()) % PARTS for h in hosts]
        yield pa.RecordBatch.from_arrays([pa.array([tokens(h, p) for h, p in zip(hosts, paths, strict=True)], pa.list_(pa.string())), batch.column(2), pa.array(part, pa.int32())], names=["items", "label", "part"])


def _merged(frequent):
    """tokens, label, part -> items to mine: the frequent tokens, one of those of the same baskets; label, part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = [sorted({frequent.value[t] for t in own if t in frequent.value}) for own in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(items, pa.list_(pa.string())), batch.column(1), batch.column(2)], names=["items", "label", "part"])

    return run


@dataclass
class _Part:
    """The sets that hold `key` and later items of its baskets, for one label, which is a rule's if it is in `label` of them.
    sure, wide: whether such a set can be a rule of either kind that no shorter one says as surely as known so far."""

    label: str
    key: tuple[str, ...] = ()
    sure: bool = True
    wide: bool = True
    best_sure: float = 0.0
    best_wide: float = 0.0


def _met(labels, inside):
    """node, items, label, part -> how many baskets of each node, part and label there are, by the one item of the node that they
    lack (none: empty; more: null), and how many sets they hold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, sets = Counter(), Counter()
        for batch in batches:
            for node, items, label, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = inside.value.get(node, frozenset())
                here = own.intersection(items)
                lacks = min(own - here, default="") if len(own) - len(here) < 2 else None
                key = node, part, None if label is None else label == labels.value[node], lacks
                rows[key] += 1
                sets[key] += 2.0 ** min(len(here), 900)
        keys = list(rows)
        columns = [pa.array([k[i] for k in keys], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.bool_(), pa.string()))]
        columns += [pa.array([c[k] for k in keys], t) for c, t in ((rows, pa.int64()), (sets, pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["node", "part", "hit", "lacks", "n", "sets"])

    return run


def _split(orders):
    """node, items, label, part -> the same of each item that the node is split by, with the later ones alone. orders: of a
    node the items that it is split by, in order, each with the node it leads to."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = {node: {t: (i, child) for i, (t, child) in enumerate(order)} for node, order in orders.value.items()}
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for node, items, label, part in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                rank = ranks.get(node, {})
                own = sorted((t for t in items if t in rank), key=rank.get)
                for i, t in enumerate(own):
                    for column, value in zip(out, (rank[t][1], own[i + 1 :], label, part), strict=True):
                        column.append(value)
                    if len(out[0]) >= 10_000:
                        yield _rows(out)
                        out = [[], [], [], []]
            yield _rows(out)

    return run


_ROWS = "node int, items array<string>, label string, part int"


def _rows(columns: list[list]) -> pa.RecordBatch:
    types = pa.int32(), pa.list_(pa.string()), pa.string(), pa.int32()
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=["node", "items", "label", "part"])


def _tagged(small):
    """node, items, label -> of the nodes that are small enough the items to mine, each with its node's number, and the label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for node, items, label in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = [f"{node}\x00{t}" for t in items if t in small.value.get(node, ())]
                if own:
                    out.append(own + ([] if label is None else [_LABEL + label]))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.list_(pa.string()))], names=["items"])

    return run


def _likely(items: DataFrame, rows: int, least: int, confidence: float, bars: DataFrame | None = None) -> list[tuple[str, ...]]:
    """The sets of at least so many baskets of a label in which FP-growth counts enough of it for a rule. rows: those of
    items. bars: of the nodes that items are tagged with, what a set's share of all and of labelled baskets must exceed.
    Only these sets come to the driver, some of which may still be no rules."""
    is_label = lambda t: t.startswith(_LABEL)
    found = FPGrowth(itemsCol="items", minSupport=(least - 0.5) / rows).fit(items).freqItemsets
    found = found.select(F.array_sort(F.filter("items", lambda t: ~is_label(t))).alias("key"), F.exists("items", is_label).alias("hit"), "freq").where(F.size("key") > 0)
    # a set with a label is in no more baskets than the set, which is thus frequent too
    found = found.groupBy("key").agg(*(F.sum(F.when(c, F.col("freq"))).alias(n) for c, n in ((~F.col("hit"), "all"), (F.col("hit"), "given"))), F.max(F.when(F.col("hit"), F.col("freq"))).alias("hits"))
    found = found.where(F.col("hits") >= (1 - _ROUND) * confidence * F.least("all", "given"))
    if bars is not None:
        found = found.join(F.broadcast(bars), F.substring_index(F.col("key")[0], "\x00", 1).cast("int") == F.col("node"))
        found = found.where((F.col("hits") > F.col("of_all") * F.col("all")) | (F.col("hits") > F.col("of_given") * F.col("given")))
    return [tuple(r.key) for r in found.select("key").collect()]


def _mined(rows: DataFrame, names: list[str], share: dict[str, float], total: int, least: int, confidence: float, lift: float, most: int) -> set[tuple[str, ...]]:
    """items, label, part -> the sets of items that may be rules: all that are, and that no shorter one says as surely. share:
    of each label among labelled baskets."""
    spark = rows.sparkSession
    rows = written(rows, "items")
    if rows.agg(F.sum(F.pow(F.lit(2.0), F.size("items")))).first()[0] <= 2.0**most * total:
        items = rows.select(F.when(F.isnull("label"), F.col("items")).otherwise(F.array_append("items", F.concat(F.lit(_LABEL), "label"))).alias("items"))
        return set(_likely(items, total, least, confidence))
    keys: set[tuple[str, ...]] = set()
    nodes = {i: _Part(x) for i, x in enumerate(names)}
    at: dict[int, _Part] = {}
    small: list[DataFrame] = []
    bars: list[tuple[int, float, float]] = []
    rows = rows.select(F.explode(F.array(*(F.lit(i) for i in nodes))).alias("node"), "items", "label", "part")
    made = len(nodes)
    while nodes:
        at |= nodes
        labels = spark.sparkContext.broadcast({i: p.label for i, p in nodes.items()})
        own = F.create_map(*(F.lit(x) for i, p in enumerate(names) for x in (p, i)))
        of_node = spark.createDataFrame([(i, names.index(p.label)) for i, p in nodes.items()], "node int, of int")
        each = rows.select("node", F.explode("items").alias("t"), own[F.col("label")].alias("given")).groupBy("node", "t", "given").agg(F.count("*").alias("n")).join(of_node, "node")
        hit = F.col("given") == F.col("of")
        each = each.groupBy("node", "t").agg(F.coalesce(F.sum(F.when(hit, F.col("n"))), F.lit(0)).alias("hits"), F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("given").isNotNull(), F.col("n"))), F.lit(0)).alias("given"))
        inside: dict[int, dict[str, tuple[int, int, int]]] = {}
        for r in each.where(F.col("hits") >= least).collect():
            inside.setdefault(r.node, {})[r.t] = r.hits, r.n - r.hits, r.given - r.hits
        of_all = spark.sparkContext.broadcast({i: frozenset(x) for i, x in inside.items()})
        met = written(rows.mapInArrow(_met(labels, of_all), "node int, part int, hit boolean, lacks string, n long, sets double"), "met")
        when = lambda c: F.coalesce(F.sum(F.when(c, F.col("n"))), F.lit(0))
        hit, other, full = F.col("hit"), ~F.col("hit"), F.col("lacks") == ""
        counts = F.sum("n").alias("n"), when(hit).alias("hits"), when(other).alias("others")
        lacking: dict[int, dict[str, tuple[int, int, int]]] = {}
        for r in met.where("lacks != ''").groupBy("node", "lacks").agg(*counts).collect():
            lacking.setdefault(r.node, {})[r.lacks] = r.hits, r.n - r.hits, r.others
        met = met.groupBy("node", "part").agg(*counts, F.sum("sets").alias("sets"), when(full).alias("full"), when(full & hit).alias("full_hits"), when(full & other).alias("full_others"))
        tops = [F.max(F.struct("hits", (F.col("hits") + F.col("others")).alias("given"))).alias("top"), F.max("full_hits").alias("full_top")]
        met = met.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n", "sets", "full", "hits", "others", "full_hits", "full_others")), *tops)
        mine: dict[int, list[str]] = {}
        orders: dict[int, list[tuple[str, int]]] = {}
        nodes = {}
        for r in met.collect():
            p, items = at[r.node], inside.get(r.node, {})
            given, wanted = r.hits + r.others, max(confidence, lift * share[p.label])
            if p.key:
                sure = r.hits >= confidence * r.n
                wide = r.hits > r.top.hits and r.hits >= wanted * given and r.hits - r.top.hits >= wanted * (given - r.top.given)
                if sure or wide:
                    keys.add(p.key)
                # of a set most of whose baskets have a label, that is the rule's
                p.best_sure = max(p.best_sure, r.hits / r.n if sure and 2 * r.hits > r.n else 0)
                p.best_wide = max(p.best_wide, r.hits / given if wide and 2 * r.hits > given else 0)
            else:  # of which no set is left without an item, so that what follows can't tell
                keys |= {(t,) for t in items}
            # every longer set has at most these hits, and the baskets that hold all items
            least_all, least_given = r.hits + r.full - r.full_hits, r.hits + r.full_others
            p.sure = p.sure and r.hits >= (1 - _ROUND) * confidence * least_all and r.hits > p.best_sure * least_all
            p.wide = p.wide and r.hits > r.top.hits and r.hits >= (1 - _ROUND) * wanted * least_given and r.hits > p.best_wide * least_given
            # an item makes no longer set surer if those that it takes from the other baskets are too few for the hits that it
            # takes at least: those that lack it alone. For the second kind the set without it must also hold on several
            # sites, as it does if the baskets of all items show so
            on_sites = (r.full_hits - r.full_top) * (1 - wanted) > (1 + _ROUND) * wanted * r.others
            used = []
            for t, (hits, rest, others) in items.items():
                lost = lacking.get(r.node, {}).get(t, (0, 0, 0)) if confidence > 0.5 else (0, 0, 0)
                sure = (r.n - r.hits - rest) * r.hits > lost[0] * (r.full - r.full_hits + lost[1])
                wide = (r.others - others) * r.hits > lost[0] * (r.full_others + lost[2]) if on_sites else others < r.others or hits < r.hits
                if (p.sure and sure) or (p.wide and wide):
                    used.append(t)
            if not used:
                continue
            if min(r.sets, 2.0 ** min(len(used), 900) * r.n) <= 2.0**most * total:
                mine[r.node] = used
                bars.append((r.node, p.best_sure if p.sure else 1.0, p.best_wide if p.wide else 1.0))
                continue
            used.sort(key=lambda t: (items[t][0] + items[t][1], t))
            orders[r.node] = [(t, made + i) for i, t in enumerate(used)]
            nodes |= {made + i: _Part(p.label, (*p.key, t), p.sure, p.wide, p.best_sure, p.best_wide) for i, t in enumerate(used)}
            made += len(used)
        if mine:
            of_mine = spark.sparkContext.broadcast({i: frozenset(x) for i, x in mine.items()})
            small.append(written(rows.mapInArrow(_tagged(of_mine), "items array<string>"), "small"))
        if nodes:
            rows = written(rows.mapInArrow(_split(spark.sparkContext.broadcast(orders)), _ROWS), "split")
    if small:
        items = reduce(DataFrame.unionAll, small)
        for key in _likely(items, items.count(), least, confidence, spark.createDataFrame(bars, "node int, of_all double, of_given double")):
            node = int(key[0].partition("\x00")[0])
            keys.add((*at[node].key, *(t.partition("\x00")[2] for t in key)))
    return {tuple(sorted(k)) for k in keys}


def _held(sets):
    """tokens, label, part -> of each set of tokens that a task has met: how many URLs of each part and label hold it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: dict[str, list[tuple[int, frozenset]]] = {}
        for i, (rarest, own) in enumerate(sets.value):
            index.setdefault(rarest, []).append((i, own))
        seen: Counter = Counter()
        for batch in batches:
            for items, label, part in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                own = set(items)
                for t in items:
                    for i, some in index.get(t, ()):
                        if some <= own:
                            seen[i, part, label] += 1
        keys = list(seen)
        columns = [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.int32()), pa.array([k[2] for k in keys], pa.string()), pa.array([seen[k] for k in keys], pa.int64())]
        yield pa.RecordBatch.from_arrays(columns, names=["rule", "part", "label", "n"])

    return run


Rule = tuple[tuple[str, ...], str, float, float]


def _shortest(rules: dict[tuple[str, ...], tuple[float, float, str]]) -> list[Rule]:
    """Without those that a shorter one says as surely."""
    kept: list[Rule] = []
    index: dict[str, list[Rule]] = {}
    for key in sorted(rules, key=lambda k: (len(k), k)):
        conf, sup, label = rules[key]
        if not any(r[1] == label and r[2] >= conf and set(r[0]) <= set(key) for t in key for r in index.get(t, ())):
            kept.append((key, label, conf, sup))
            index.setdefault(key[0], []).append(kept[-1])
    return kept


@dataclass
class UrlRules:
    """rules and wider: (tokens, verdict, confidence, support), of the first and the second kind. A URL that none fits gets
    `otherwise`."""

    rules: list[Rule]
    otherwise: str = ALLOW
    wider: list[Rule] = field(default_factory=list)

    def __post_init__(self):
        self.indexes = [self._index(self.rules), self._index(self.wider)]

    @staticmethod
    def _index(rules: list[Rule]) -> dict[str, list[Rule]]:
        used, index = Counter(t for r in rules for t in r[0]), {}
        for r in rules:
            index.setdefault(min(r[0], key=lambda t: (used[t], t)), []).append(r)
        return index

    @classmethod
    def fit(cls, urls: DataFrame, support: float = 0.005, confidence: float = 0.8, most_items: int = 10, lift: float = 1.2) -> UrlRules:
        """urls: host, path, label (null if there is none). Support is a share of all urls. A rule of the second kind needs the
        confidence and `lift` times its label's share among the labelled urls, in all and without the part of the sites that
        has most of its hits. most_items bounds what FP-growth mines at once (see above), and drops nothing. Frequent tokens, whose
        number the support bounds (a url's tokens over it), the sets that may be rules, and the parts that baskets are split
        into come to the driver. Of tokens that go together in ever different ways the parts and rules may be exponential."""
        spark = urls.sparkSession
        baskets = written(urls.select("host", "path", F.col("label").cast("string").alias("label")).mapInArrow(_baskets, "items array<string>, label string, part int"), "baskets")
        labels = {r.label: r.n for r in baskets.groupBy("label").agg(F.count("*").alias("n")).collect()}
        total, labelled = sum(labels.values()), sum(n for label, n in labels.items() if label is not None)
        if not labelled:
            return cls([])
        # tokens of the same baskets have the same sum of hashes
        marks = baskets.select(F.explode("items").alias("t"), F.xxhash64("items").cast("decimal(20,0)").alias("h"))
        often = marks.groupBy("t").agg(F.count("*").alias("n"), F.sum("h").alias("h")).where(F.col("n") >= support * total).collect()
        first: dict[tuple, str] = {}
        for r in sorted(often, key=lambda r: r.t):
            first.setdefault((r.n, r.h), r.t)
        frequent = spark.sparkContext.broadcast({r.t: first[r.n, r.h] for r in often})
        names = sorted(x for x in labels if x is not None)
        least = math.ceil(support * total)
        least += (least < support * total) - (least - 1 >= support * total)
        merged = baskets.mapInArrow(_merged(frequent), "items array<string>, label string, part int")
        keys = sorted(_mined(merged, names, {x: labels[x] / labelled for x in names}, total, max(least, 1), confidence, lift, most_items))
        n = {r.t: r.n for r in often}
        sets = spark.sparkContext.broadcast([(min(key, key=lambda t: (n[t], t)), frozenset(key)) for key in keys])
        held = baskets.mapInArrow(_held(sets), "rule int, part int, label string, n long").groupBy("rule", "part", "label").agg(F.sum("n").alias("n"))
        held = held.groupBy("rule", "part").agg(F.sum("n").alias("all"), *(F.coalesce(F.sum(F.when(F.col("label") == x, F.col("n"))), F.lit(0)).alias(f"n{i}") for i, x in enumerate(names)))
        each = [F.sum(f"n{i}").alias(f"n{i}") for i in range(len(names))]
        given = sum((F.col(f"n{i}") for i in range(1, len(names))), F.col("n0"))
        tops = [F.max(F.struct(F.col(f"n{i}").alias("hits"), given.alias("given"))).alias(f"top{i}") for i in range(len(names))]
        sure: dict[tuple[str, ...], tuple] = {}
        wide: dict[tuple[str, ...], tuple] = {}
        for r in held.groupBy("rule").agg(F.sum("all").alias("all"), *each, *tops).collect():
            of_label = sum(r[f"n{i}"] for i in range(len(names)))
            for i, label in enumerate(names):
                hits, top = r[f"n{i}"], r[f"top{i}"]
                if hits < support * total:
                    continue
                key, sup = keys[r.rule], hits / total
                if hits >= confidence * r["all"]:
                    sure[key] = max(sure.get(key, (0,)), (hits / r["all"], sup, label))
                least = max(confidence, lift * labels[label] / labelled)
                if hits > top.hits and hits >= least * of_label and hits - top.hits >= least * (of_label - top.given):
                    wide[key] = max(wide.get(key, (0,)), (hits / of_label, sup, label))
        return cls(_shortest(sure), wider=_shortest(wide))

    def judge(self, host: str, path: str) -> tuple[str, str | None, float | None]:
        """Verdict, and the tokens and confidence of the surest rule that fits, of the first kind if there is one; of equals
        the one of most support, then of most tokens, then the first by name."""
        own = set(tokens(host, path))
        for index in self.indexes:
            fit = [r for t in own for r in index.get(t, ()) if own.issuperset(r[0])]
            if fit:
                r = min(fit, key=lambda r: (-r[2], -r[3], -len(r[0]), r[0], r[1]))
                return r[1], " ".join(r[0]), r[2]
        return self.otherwise, None, None


def _judge(model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen: dict = {}
            out = []
            for key in zip(batch.column("__host").to_pylist(), batch.column("__path").to_pylist(), strict=True):
                if key not in seen:
                    seen[key] = model.value.judge(*key)
                out.append(seen[key])
            yield pa.RecordBatch.from_arrays([*batch.columns, *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.string(), pa.string(), pa.float64())))], names=[*batch.schema.names, *names])

    return run


def judged(pages: DataFrame, model: UrlRules) -> DataFrame:
    """pages, which have __host and __path as host_of and path_of give them, with __verdict, __mined (its tokens) and
    __confidence, each with more underscores in front if pages has such a column. A null or empty host and path fit no
    rule. One row for each row of pages, repeated ones too."""
    bc, names = pages.sparkSession.sparkContext.broadcast(model), free_names(pages, "__verdict", "__mined", "__confidence")
    schema = StructType([*pages.schema.fields]).add(names[0], "string").add(names[1], "string").add(names[2], "double")
    return pages.mapInArrow(_judge(bc, names), schema)


def op3_url_filter(spark, sf_dir: str) -> DataFrame:
    """Every page's verdict: a fixed rule's where one fits. Those that fixed rules decide are labelled so for mining; null or
    empty URLs have neither host nor path and get the method's verdict, which without a rule is allow."""
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", F.col("url").cast("string").alias("url"))
    pages = pages.select("page_id", host_of(F.col("url")).alias("__host"), path_of(F.col("url")).alias("__path"))
    pages = pages.withColumn("rule", fixed_rule(F.col("__host"), F.col("__path")))
    verdict = F.create_map(*(F.lit(x) for h, p, v in HOST_RULES for x in (h + p, v)))
    ruled = pages.withColumn("label", F.when(F.col("rule").isNotNull(), verdict[F.col("rule")]))
    model = UrlRules.fit(ruled.select(F.col("__host").alias("host"), F.col("__path").alias("path"), "label"))
    found = judged(ruled, model)
    return found.select("page_id", F.col("__host").alias("host"), F.col("__path").alias("path"), "rule", F.coalesce("label", "__verdict").alias("verdict"), F.col("__mined").alias("mined"))
