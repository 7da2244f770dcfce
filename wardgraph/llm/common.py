"""What the operators of this subpackage share: bounded samples and held-out rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardgraph.sources.tables import new_path, scratch, shared_dir, written

__all__ = ["free_names", "held_out", "new_path", "own_columns", "sample_by_hash", "scratch", "shared_dir", "text_key", "with_string_text", "written"]


def sample_by_hash(df: DataFrame, keys: list[str], k: int) -> DataFrame:
    """The k rows whose keys hash lowest: the same for any partitioning; each task passes on k rows at most."""
    return df.orderBy(F.xxhash64(F.lit("sample"), *keys), *keys).limit(k)


def free_names(df: DataFrame, *wanted: str) -> list[str]:
    """The wanted names of added columns, each with more underscores in front as long as df has a column of that name."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in wanted:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        out.append(name)
    return out


def own_columns(df: DataFrame) -> list[Column]:
    """df's columns, whatever their names hold."""
    return [F.col(f"`{c.replace('`', '``')}`") for c in df.columns]


def with_string_text(df: DataFrame) -> DataFrame:
    return df if dict(df.dtypes).get("text") == "string" else df.withColumn("text", F.col("text").cast("string"))


def text_key(c: str = "text") -> Column:
    """128 bits that tell texts apart; null and empty ones differ."""
    return F.struct(F.xxhash64(F.lit("a"), c, F.isnull(c)).alias("a"), F.xxhash64(F.lit("b"), c, F.isnull(c)).alias("b"))


def held_out(key: str, n: int, rest: int):
    """crc32 of the key as text, modulo n, equals rest. A null key is never held out."""
    return F.coalesce(F.pmod(F.crc32(F.col(key).cast("string").cast("binary")), F.lit(n)) == rest, F.lit(False))
