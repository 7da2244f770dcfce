"""The knowledge chain: vulnerability -> weakness -> pattern -> technique -> countermeasure, and weakness -> category.

Facts are (cve_id, cwe_id) rows; the other tables are dimensions. Ids of weaknesses are bare.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgraph.functions.ids import is_technique_id, taxonomy_ids
from wardgraph.sources.tables import partitions, written


def capec_techniques(capec: DataFrame, valid: bool = True) -> DataFrame:
    """(capec_id, taxonomy) -> (capec_id, technique_id), distinct within a pattern."""
    return capec.select("capec_id", F.explode(F.array_distinct(taxonomy_ids(F.col("taxonomy"), valid))).alias("technique_id"))


def expand_parents(facts: DataFrame, parents: DataFrame, parts: int | None = None) -> DataFrame:
    """Direct weaknesses and their parents, one level up; if asked for, in so many partitions by vulnerability."""
    up = facts.join(parents, "cwe_id").select("cve_id", F.col("parent_id").alias("cwe_id"))
    both = facts.select("cve_id", "cwe_id").union(up)
    return (both.repartition(parts, "cve_id") if parts else both).distinct()


def weakness_lists(facts: DataFrame, parents: DataFrame, category_map: DataFrame, parts: int) -> DataFrame:
    """(cve_id, cwe_id) -> cve_id, cwe (its weaknesses and their parents, one level up) and owasp (the categories of its weaknesses), distinct and
    in no order. Facts meet parents and categories at once and are dealt by vulnerability once, in so many partitions, a row a fact."""
    each = lambda df, c, name: df.groupBy("cwe_id").agg(F.transform(F.collect_set(F.struct(c)), lambda s: s[c]).alias(name))  # noqa: E731 (nulls stay)
    known = each(parents, "parent_id", "up").join(each(category_map, "category_id", "owasp"), "cwe_id", "full_outer")
    none = F.array().cast("array<string>")
    rows = facts.join(known, "cwe_id", "left").select("cve_id", F.concat(F.array("cwe_id"), F.coalesce("up", none)).alias("cwe"), F.coalesce("owasp", none).alias("owasp"))
    return rows.repartition(parts, "cve_id").groupBy("cve_id").agg(*(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("cwe", "owasp")))


def ancestors(parents: DataFrame) -> DataFrame:
    """(cwe_id, parent_id) -> (cwe_id, ancestor_id, depth), each ancestor at its least depth. Cycles end by themselves. A round joins
    the pairs found so far with each other, so paths double: a hierarchy of depth d takes some log2(d) rounds over pairs, of which
    there are as many as the result has. What asks for less than the pairs themselves does without them: see graph.hit_groups."""
    found = written(parents.where("cwe_id is not null and parent_id is not null").select("cwe_id", F.col("parent_id").alias("ancestor_id"), F.lit(1).alias("depth")).distinct(), "pairs")
    n = found.count()
    while True:
        up = found.select(F.col("cwe_id").alias("ancestor_id"), F.col("ancestor_id").alias("far"), F.col("depth").alias("more"))
        twice = found.join(up, "ancestor_id").select("cwe_id", F.col("far").alias("ancestor_id"), (F.col("depth") + F.col("more")).alias("depth"))
        found = written(found.union(twice).groupBy("cwe_id", "ancestor_id").agg(F.min("depth").alias("depth")), "pairs")
        before, n = n, found.count()
        if n == before:
            return found


def weakness_patterns(facts: DataFrame, cwe_capec: DataFrame) -> DataFrame:
    return facts.join(cwe_capec, "cwe_id").select("cve_id", "capec_id").distinct()


def pattern_techniques(patterns: DataFrame, techniques: DataFrame) -> DataFrame:
    return patterns.join(techniques, "capec_id").select("cve_id", "technique_id").distinct()


def technique_countermeasures(techniques: DataFrame, defend: DataFrame) -> DataFrame:
    """defend is keyed by T and the technique's id; a sub-technique has a key of its own."""
    keyed = techniques.select("cve_id", F.concat(F.lit("T"), F.col("technique_id")).alias("technique_id"))
    return keyed.join(defend, "technique_id").select("cve_id", "d3f_id").distinct()


def weakness_categories(ids: DataFrame, facts: DataFrame, category_map: DataFrame) -> DataFrame:
    """cve_id, categories (sorted, distinct) of the direct weaknesses; an empty list where there are none."""
    found = facts.join(category_map.distinct(), "cwe_id").groupBy("cve_id").agg(F.sort_array(F.collect_set("category_id")).alias("categories"))
    return ids.select("cve_id").join(found, "cve_id", "left").select("cve_id", F.coalesce("categories", F.array().cast("array<string>")).alias("categories"))


LISTS = ("cwe", "capec", "techniques", "defend", "owasp")


#: Bytes of the lists of all weaknesses up to which these are broadcast: 16 an id besides its text.
BROADCAST_BYTES = 64 << 20
#: Names of a kind up to which a set of them is words of bits.
WORD_NAMES = 1024
#: Patterns up to which they are numbered: their names and words, some 100 bytes each, are given to the tasks.
NUMBERED = 1 << 20


def _listed(row: np.ndarray, rows: int, names: pa.Array, which: np.ndarray) -> pa.Array:
    """Of each row the names that it has; row ascends."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), names.take(pa.array(which)))


def _read_numbers(book):
    """Numbers of patterns, three bytes each and in any order -> the patterns' names, and for each further kind of the book the names
    that their words hold; all sorted and distinct."""

    def run(packed: pa.Array) -> pa.Array:
        patterns, words = book.value
        rows = len(packed)
        at = np.frombuffer(packed.buffers()[1], np.int32)[packed.offset : packed.offset + rows + 1] if rows else np.zeros(1, np.int32)
        data = np.frombuffer(packed.buffers()[2] or b"", np.uint8)[at[0] : at[-1]].reshape(-1, 3)
        key = np.unique(np.repeat(np.arange(rows), np.diff(at) // 3) << 24 | data.astype(np.int64) @ np.array([1 << 16, 1 << 8, 1]))
        row, number = key >> 24, key & (1 << 24) - 1
        out = {"capec": _listed(row, rows, patterns, number)}
        some, first = np.unique(row, return_index=True)
        for kind, (names, bits) in words.items():
            own = np.zeros((rows, bits.shape[1]), np.uint64)
            if len(some):
                own[some] = np.bitwise_or.reduceat(bits[number], first, axis=0)
            which = np.unpackbits(own.view(np.uint8), axis=1, bitorder="little").nonzero()
            out[kind] = _listed(which[0], rows, names, which[1])
        return pa.StructArray.from_arrays(list(out.values()), names=list(out))

    return run


class Knowledge:
    """What each weakness leads to by itself and by its parents, as a table with a row a weakness: the distinct ids of the chosen `kinds`.

    Techniques and countermeasures are few names that very many weaknesses share: up to `most_names` of them a set is words of bits,
    a bit a name in order, which are put together by bit_or and read at the end; categories too. More names are lists of ids. What
    patterns lead to is gathered a pattern before it meets the weaknesses, so no path is a row.

    Patterns, up to `most_numbers` of them, are numbered in order, and a weakness has the numbers of its own as three bytes each. What
    these patterns lead to follows from them at the end, so nothing else of it is moved. More patterns are lists of ids.
    """

    def __init__(self, parents: DataFrame, cwe_capec: DataFrame, techniques: DataFrame, defend: DataFrame, category_map: DataFrame, kinds: tuple[str, ...] = LISTS, most_names: int = WORD_NAMES, most_numbers: int = NUMBERED):
        self.kinds, self.names, self.book = kinds, {}, None
        columns = {"techniques": "technique_id", "defend": "d3f_id"}
        below = [kind for kind in ("capec", *columns) if kind in kinds]
        paths, own = techniques, []
        if "defend" in kinds:
            key = F.concat(F.lit("T"), F.col("technique_id"))
            paths = techniques.join(defend.withColumnRenamed("technique_id", "key"), key == F.col("key"), "left").drop("key")
        for kind, column in columns.items():
            if kind in kinds:
                if self._few(kind, paths.select(column), most_names):
                    paths = self._numbered(paths, kind, column)
                    own += [F.bit_or(x).alias(w) for w, x in self._bits(kind)]
                else:
                    own.append(F.collect_set(column).alias(kind))
        led = paths.groupBy("capec_id").agg(*own) if own else None
        rows = parents.select("cwe_id", "parent_id")
        if "capec" in kinds and all(kind in self.names for kind in below[1:]):
            self.book = self._book(cwe_capec, led, below[1:], most_numbers)
        if self.book:
            packed = F.unhex(F.array_join(F.transform(F.collect_set("number"), lambda n: F.lpad(F.hex(n), 6, "0")), "")).alias("capec")
            rows = self._with_parents(written(cwe_capec.join(self.order, "capec_id").groupBy("cwe_id").agg(packed), "below"), parents)
            below = ["capec"]
        elif below:
            each = cwe_capec if led is None else cwe_capec.join(led, "capec_id", "left")
            more = [x for kind in below if kind != "capec" for x in self.gathered(kind)]
            each = written(each.groupBy("cwe_id").agg(F.collect_set("capec_id").alias("capec"), *more), "below")
            rows = self._with_parents(each if "capec" in kinds else each.drop("capec"), parents)
        self.kept = [kind for kind in kinds if kind in below or kind not in ("capec", *columns)]
        sets = [F.collect_set("parent_id").alias("up")]
        if "owasp" in kinds:  # those of direct weaknesses alone
            cats = category_map.select("cwe_id", "category_id")
            if self._few("owasp", cats.select("category_id"), most_names):
                cats = self._numbered(cats, "owasp", "category_id").select("cwe_id", *(x.alias(w) for w, x in self._bits("owasp")))
                sets += self.gathered("owasp")
            else:
                sets.append(F.collect_set("category_id").alias("owasp"))
            rows = rows.unionByName(cats, allowMissingColumns=True)
        self.lists = written(rows.where("cwe_id is not null").groupBy("cwe_id").agg(*sets, *(x for kind in below for x in self.gathered(kind))), "lists")

    @staticmethod
    def _with_parents(below: DataFrame, parents: DataFrame) -> DataFrame:
        """What weaknesses lead to, and a row for each of a weakness's parents with what that one leads to."""
        return below.unionByName(parents.join(below.withColumnRenamed("cwe_id", "parent_id"), "parent_id", "left"), allowMissingColumns=True)

    def _few(self, kind: str, column: DataFrame, most: int) -> bool:
        found = [r[0] for r in column.where(F.col(column.columns[0]).isNotNull()).distinct().limit(most + 1).collect()]
        if len(found) <= most:
            self.names[kind] = sorted(found)
        return len(found) <= most

    def _bits(self, kind: str) -> list[tuple[str, Column]]:
        """Each word of a name's number."""
        return [(w, F.when(F.floor(F.col(f"__{kind}") / 64) == i, F.expr(f"shiftleft(1L, cast(__{kind} % 64 as int))"))) for i, w in enumerate(self.words(kind))]

    def _book(self, cwe_capec: DataFrame, led: DataFrame | None, kinds: list[str], most: int):
        """The patterns in order of their ids, as numbers in a table and, with their words, for tasks; None if there are more than `most`."""
        ids, spark = cwe_capec.select("capec_id").where("capec_id is not null").distinct(), cwe_capec.sparkSession
        found = written(ids if led is None else ids.join(led, "capec_id", "left"), "patterns")
        if found.count() > most:
            return None
        rows = found.toArrow()
        rows = rows.take(pc.sort_indices(rows, [("capec_id", "ascending")])).combine_chunks()
        names = pa.array(rows["capec_id"].to_pylist(), pa.string())
        bits = lambda w: rows[w].fill_null(0).to_numpy().astype(np.int64).view(np.uint64)
        words = {kind: (pa.array(self.names[kind], pa.string()), np.stack([bits(w) for w in self.words(kind)] or [np.zeros(len(names), np.uint64)], axis=1)) for kind in kinds}
        numbers = pa.table({"capec_id": names, "number": pa.array(np.arange(len(names)))})
        self.order = written(spark.createDataFrame(numbers), "numbers")
        return spark.sparkContext.broadcast((names, words))

    def _numbered(self, paths: DataFrame, kind: str, column: str) -> DataFrame:
        order = paths.sparkSession.createDataFrame(list(enumerate(self.names[kind])), f"__{kind} int, __name string")
        return paths.join(F.broadcast(order), F.col(column) == F.col("__name"), "left").drop("__name")  # at most WORD_NAMES rows

    def words(self, kind: str) -> list[str]:
        return [f"{kind}_{i}" for i in range(-(-len(self.names[kind]) // 64))]

    def gathered(self, kind: str) -> list[Column]:
        """Sets of rows put together."""
        if kind == "capec" and self.book:
            return [F.listagg(kind).alias(kind)]
        if kind in self.names:
            return [F.bit_or(w).alias(w) for w in self.words(kind)]
        return [F.array_distinct(F.flatten(F.collect_list(kind))).alias(kind)]

    def read(self, kind: str) -> Column:
        """A set as a sorted list."""
        if kind not in self.names:
            return F.sort_array(kind).alias(kind)
        names, parts = self.names[kind], [F.array().cast("array<string>")]
        for i, w in enumerate(self.words(kind)):
            some = F.array(*map(F.lit, names[64 * i : 64 * i + 64]))
            word = F.coalesce(w, F.lit(0).cast("long"))
            parts.append(F.filter(some, lambda _, n: F.getbit(word, n) == 1))  # noqa: B023 (called at once)
        return F.concat(*parts).alias(kind)

    def bytes(self) -> int:
        """Of all lists: 16 an id besides its text, 8 a word."""
        size = lambda c, t: F.coalesce(16 * F.size(c) + F.octet_length(F.array_join(c, "")), F.lit(0)) if t.startswith("array") else F.lit(8)
        return self.lists.agg(F.sum(reduce(lambda a, b: a + b, (size(c, t) for c, t in self.lists.dtypes)))).first()[0] or 0

    def of(self, facts: DataFrame, ids: DataFrame | None = None, most: int = BROADCAST_BYTES) -> DataFrame:
        """(cve_id, cwe_id) -> one row a vulnerability of facts, and of ids if given, with a sorted distinct list of each kind.

        Where the lists of all weaknesses have at most `most` bytes they are broadcast to facts that are dealt by vulnerability, so no
        list is shuffled. Beyond that, or where patterns are numbers, facts meet them by weakness, and what is dealt by vulnerability is a row
        a fact, in partitions whose number grows with the facts."""
        facts, lists = written(facts.select("cve_id", "cwe_id"), "facts"), self.lists
        ids = facts.select("cve_id").limit(0) if ids is None else ids.select("cve_id")
        n = partitions(facts.sparkSession, facts.count())
        if not self.book and self.bytes() <= most:
            rows = facts.unionByName(ids, allowMissingColumns=True).repartition(n, "cve_id").join(F.broadcast(lists), "cwe_id", "left")
            rows = self._own(rows)
        else:
            rows = self._own(facts.join(lists, "cwe_id", "left")).unionByName(ids, allowMissingColumns=True).repartition(n, "cve_id")
        found = rows.groupBy("cve_id").agg(*(x for kind in self.kept for x in self.gathered(kind)))
        if self.book:
            order = ["capec", *self.book.value[1]]
            shape = f"struct<{', '.join(f'{kind}: array<string>' for kind in order)}>"
            read = F.arrow_udf(_read_numbers(self.book), shape)
            found = found.withColumn("__read", read(F.coalesce("capec", F.lit(b""))))
            return found.select("cve_id", *(F.col(f"__read.{kind}").alias(kind) if kind in order else self.read(kind) for kind in self.kinds))
        return found.select("cve_id", *(self.read(kind) for kind in self.kinds))

    def _own(self, rows: DataFrame) -> DataFrame:
        """Facts with their lists, the weakness itself and its parents as one."""
        none = F.array().cast("array<string>")
        own = F.concat(F.when(F.col("cwe_id").isNotNull(), F.array("cwe_id")).otherwise(none), F.coalesce("up", none))
        rows = rows.withColumn("cwe", own).drop("cwe_id", "up")
        return rows if "cwe" in self.kinds else rows.drop("cwe")


def correlate(ids: DataFrame, facts: DataFrame, parents: DataFrame, cwe_capec: DataFrame, techniques: DataFrame, defend: DataFrame, category_map: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """One row per vulnerability with five sorted distinct lists; vulnerabilities without weaknesses keep empty ones."""
    return Knowledge(parents, cwe_capec, techniques, defend, category_map).of(facts, ids, most)


def lookup_request(store: DataFrame, wanted: DataFrame) -> DataFrame:
    return store.join(wanted.select("cve_id").distinct(), "cve_id", "left_semi")


def not_found(store: DataFrame, wanted: DataFrame) -> DataFrame:
    return wanted.select("cve_id").distinct().join(store, "cve_id", "left_anti")


def attach_tactics(scores: DataFrame, tactics: DataFrame) -> DataFrame:
    """One row per tactic of a technique; techniques without one drop."""
    return scores.join(tactics, "technique_id")


def translate_domain(techniques: DataFrame, assoc: DataFrame, domain: str) -> DataFrame:
    """For ics and mobile each technique becomes its associated id, or drops; enterprise passes."""
    if domain not in ("ics", "mobile"):
        return techniques
    found = techniques.join(assoc.select("technique_id", F.col(domain).alias("to")), "technique_id")
    return found.where("to is not null").withColumn("technique_id", F.col("to")).drop("to")


def replace_keys(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """old without the keys that new has, and new: an upsert, or the override of a mapping."""
    return old.join(new.select(key).distinct(), key, "left_anti").unionByName(new)


def valid_techniques(df: DataFrame) -> DataFrame:
    return df.where(is_technique_id(F.col("technique_id")))
