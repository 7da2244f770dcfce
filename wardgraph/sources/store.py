"""A table of records by key, in versions: an upsert rewrites the buckets of its keys alone and is seen at once or not at all.

Rows lie in folders of a year and a bucket of keys. A manifest names the folders of a version; manifests are numbered, and the
highest one is the table. A write adds folders and then its manifest, by one rename: a reader has the old version or the new
one, and a write that dies leaves folders that no manifest names. Two writers at once: the later rename fails.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wardgraph.sources.tables import scratch, written


class Conflict(RuntimeError):
    """Another writer was first."""


@dataclass
class VersionedStore:
    """A manifest has a line for each year and bucket that holds rows, so `buckets` bounds it. A key's year must follow from the key.
    The rename must fail where its target exists, as on HDFS and local file systems."""

    spark: SparkSession
    path: str
    key: str = "cve_id"
    year: str = "year"
    buckets: int = 64

    def _fs(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def version(self) -> int:
        """The number of the last version; 0 if there is none."""
        at, fs = self._fs(f"{self.path}/manifests")
        if not fs.exists(at):
            return 0
        names = [s.getPath().getName() for s in fs.listStatus(at)]
        return max((int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit()), default=0)

    def manifest(self, version: int | None = None) -> dict:
        """schema, and folders by "year/bucket"."""
        version = self.version() if version is None else version
        if not version:
            return {"schema": None, "folders": {}}
        at, fs = self._fs(f"{self.path}/manifests/v{version}")
        stream = fs.open(at)
        try:
            return json.loads(bytes(self.spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)))
        finally:
            stream.close()

    def _commit(self, version: int, manifest: dict) -> None:
        temp, fs = self._fs(f"{self.path}/manifests/_{uuid.uuid4().hex}")
        final, _ = self._fs(f"{self.path}/manifests/v{version}")
        stream = fs.create(temp)
        stream.write(bytearray(json.dumps(manifest).encode()))
        stream.close()
        if fs.exists(final) or not fs.rename(temp, final):
            fs.delete(temp, False)
            raise Conflict(f"version {version} of {self.path} was made by another writer")

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version, the last one if none is named."""
        found = self.manifest(version)
        if found["schema"] is None:
            raise FileNotFoundError(f"no version of {self.path}")
        return self._rows(found, found["folders"].values())

    def _rows(self, manifest: dict, folders) -> DataFrame:
        schema, paths = StructType.fromJson(manifest["schema"]), [f"{self.path}/data/{f}" for f in folders]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(*paths)

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key).cast("string")), F.lit(self.buckets)).cast("int")

    def upsert(self, new: DataFrame) -> int:
        """Rows of new's keys are replaced, other rows stay; of a key new should have one row. The number of the new version."""
        version, old = self.version(), None
        old = self.manifest(version)
        with scratch(self.spark):
            new = written(new.withColumns({"__y": F.coalesce(F.col(self.year).cast("string"), F.lit("none")), "__b": self._bucket()}), "upsert")
            touched = [(r["__y"], r["__b"]) for r in new.select("__y", "__b").distinct().collect()]  # a row a folder
            rows = new
            if kept := [f for f in (old["folders"].get(f"{y}/{b}") for y, b in touched) if f]:
                before = self._rows(old, kept).select(*(c for c in new.columns if not c.startswith("__")))
                before = before.withColumns({"__y": F.coalesce(F.col(self.year).cast("string"), F.lit("none")), "__b": self._bucket()})
                rows = before.join(new.select(self.key), self.key, "left_anti").select(*new.columns).unionByName(new)
            name, own = uuid.uuid4().hex, [c for c in new.columns if c not in ("__y", "__b")]
            rows.repartition("__y", "__b").select(*own, F.col("__y").alias("y"), F.col("__b").alias("b")).write.partitionBy("y", "b").parquet(f"{self.path}/data/{name}")
            folders = old["folders"] | {f"{y}/{b}": f"{name}/y={y}/b={b}" for y, b in touched}
            self._commit(version + 1, {"schema": new.select(*own).schema.jsonValue(), "folders": folders})
        return version + 1

    def vacuum(self, keep: int = 1) -> int:
        """Drops all but the last `keep` versions and what no manifest of theirs names; how many folders went. No writer or reader of
        older versions may be at work."""
        last = self.version()
        used = {f for v in range(max(last - keep + 1, 1), last + 1) for f in self.manifest(v)["folders"].values()}
        gone = 0
        root, fs = self._fs(f"{self.path}/data")
        for s in fs.globStatus(self._fs(f"{self.path}/data/*/y=*/b=*")[0]) or []:
            name = "/".join(str(s.getPath()).rsplit("/", 3)[1:])
            if name not in used:
                gone += bool(fs.delete(s.getPath(), True))
        for v in range(1, last - keep + 1):
            fs.delete(self._fs(f"{self.path}/manifests/v{v}")[0], False)
        return gone
