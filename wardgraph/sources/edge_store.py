"""Edges stored by target and by source, so that hops and neighbours move no edge."""

from __future__ import annotations

import hashlib
import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgraph.sources.tables import written

#: Each side of an edge that is read by, and what is found on the other.
OTHER = {"target": "source", "source": "target"}
#: Edges of a bucket, about, and of one node's part of a side.
BUCKET_ROWS, PART_ROWS = 2_000_000, 100_000


class EdgeStore:
    """A folder with two Parquet tables that hold every edge, one bucketed and sorted by target, one by source, or with one of these alone. Reading the edges
    of some nodes deals the nodes as the buckets are; the edges stay where they are.

    A hub, which is a node with more than part_rows edges on a side, has them in several parts by the hash of the edge. Part and
    node are the bucket's key together, so no bucket and no task holds a hub whole. Edges without a source or a target are
    found by the other alone. Repeated edges stay, but share a part.
    """

    def __init__(self, spark: SparkSession, path: str):
        """Opens what write() made, in the same session or another."""
        self.spark, self.path = spark, path
        self.buckets, self.columns, sides = spark.read.parquet(f"{path}/shape").select("buckets", "columns", "sides").first()
        self.hubs = {side: spark.read.parquet(f"{path}/hubs_of_{side}") for side in sides}
        self.tables = {side: self._table(side) for side in sides}

    @staticmethod
    def _name(path: str, side: str) -> str:
        return f"edges_by_{side}_{hashlib.sha256(path.encode()).hexdigest()[:16]}"

    def _table(self, side: str) -> DataFrame:
        """The bucketed table under a name of the session's catalog, where alone Spark looks for buckets."""
        name, at = self._name(self.path, side), f"{self.path}/by_{side}"
        keys = f"(`{side}`, `part`)"
        self.spark.sql(f"create table if not exists {name} ({self.columns}) using parquet clustered by {keys} sorted by {keys} into {self.buckets} buckets location '{at}'")
        return self.spark.table(name)

    @classmethod
    def write(cls, edges: DataFrame, path: str, buckets: int | None = None, part_rows: int = PART_ROWS, sides: tuple[str, ...] = tuple(OTHER)) -> EdgeStore:
        """edges (source, target and any more columns but `part`) -> the store at path, where none may be. Each side is one shuffle, of rows that
        are dealt by node and part; its size gives the number of buckets where none is asked for. sides: those that will be read by."""
        spark, edges = edges.sparkSession, written(edges, "edges")
        n = buckets or max(int(spark.conf.get("spark.sql.shuffle.partitions")), math.ceil(edges.count() / BUCKET_ROWS))
        for side in sides:
            degree = edges.groupBy(F.col(side).alias("hub")).agg(F.count("*").alias("n")).where(F.col("n") > part_rows)
            degree.select("hub", F.ceil(F.col("n") / part_rows).cast("int").alias("parts")).write.parquet(f"{path}/hubs_of_{side}")
            hubs = spark.read.parquet(f"{path}/hubs_of_{side}")
            part = F.coalesce(F.pmod(F.xxhash64(*edges.columns), F.col("parts")).cast("int"), F.lit(0))
            dealt = edges.join(hubs, F.col(side).eqNullSafe(F.col("hub")), "left").select(*edges.columns, part.alias("part"))
            name = cls._name(path, side)
            spark.sql(f"drop table if exists {name}")  # of a store that was there before
            dealt.repartition(n, side, "part").write.bucketBy(n, side, "part").sortBy(side, "part").option("path", f"{path}/by_{side}").saveAsTable(name)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in dealt.schema)
        spark.range(1).select(F.lit(n).alias("buckets"), F.lit(columns).alias("columns"), F.array(*map(F.lit, sides)).alias("sides")).write.parquet(f"{path}/shape")
        return cls(spark, path)

    def edges_of(self, nodes: DataFrame, side: str = "target") -> DataFrame:
        """The edges whose target (or source) is one of nodes, a column `node`. Nodes that repeat count once."""
        named = nodes.select("node").distinct().join(self.hubs[side], F.col("node") == F.col("hub"), "left")
        parts = named.select(F.col("node").alias(side), F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)).alias("part"))
        edges = self.tables[side]
        return edges.join(parts.repartition(self.buckets, side, "part"), [side, "part"], "left_semi").select(*(c for c in edges.columns if c != "part"))

    def neighbour_parts(self) -> DataFrame:
        """node, side (sources or targets), part, nodes (sorted): each node's neighbours, a hub's in parts, on the sides that are stored. Nothing is shuffled."""
        rows = [self.tables[side].groupBy(F.col(side).alias("node"), F.lit(f"{other}s").alias("side"), "part").agg(F.sort_array(F.collect_list(other)).alias("nodes")) for side, other in OTHER.items() if side in self.tables]
        return reduce(DataFrame.union, rows)
