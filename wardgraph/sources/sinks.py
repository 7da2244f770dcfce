"""Sinks. None overwrites what its own plan reads: new data are staged first."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgraph.sources.tables import written

WIRE = (("CWE", "cwe"), ("CAPEC", "capec"), ("TECHNIQUES", "techniques"), ("DEFEND", "defend"), ("OWASP", "owasp"))


def jsonl_lines(vulns: DataFrame) -> DataFrame:
    """One line {cve_id: {...}} per record."""
    return vulns.select(F.to_json(F.create_map("cve_id", F.struct(*(F.col(c).alias(n) for n, c in WIRE)))).alias("value"))


def write_jsonl(vulns: DataFrame, path: str, compression: str = "none") -> None:
    """compression: of the text files, as Spark names it; its readers tell by a file's ending."""
    jsonl_lines(vulns).write.mode("overwrite").text(path, compression=compression)


def upsert_by_year(new: DataFrame, path: str, key: str = "cve_id", year: str = "year", rows_per_file: int = 1_000_000) -> None:
    """Into a Parquet table partitioned by year: keys of `new` are replaced, other rows stay. Only the years that `new`
    has are read and rewritten, so a key's year must follow from the key. Tasks and files a year follow from its rows."""
    spark = new.sparkSession
    new = written(new, "upsert")
    years = [r[0] for r in new.select(year).distinct().collect()]  # as many as there are years
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at):
        old = spark.read.parquet(path).where(F.col(year).isin(years)).select(*new.columns)
        new = written(old.join(new.select(key), key, "left_anti").select(*new.columns).unionByName(new), "merged")
    parts = new.groupBy(F.col(year).alias("__year")).agg(F.ceil(F.count("*") / rows_per_file).alias("__parts"))
    dealt = new.join(F.broadcast(parts), F.col(year).eqNullSafe(F.col("__year")))  # a row a year
    dealt = dealt.withColumn("__part", F.pmod(F.xxhash64(key), F.col("__parts"))).repartition(year, "__part")
    dealt.select(*new.columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(year).parquet(path)


def write_knowledge(table: DataFrame, path: str) -> None:
    """A knowledge table, as the engine reads it."""
    table.write.mode("overwrite").parquet(path)


def keyed_lines(table: DataFrame, key: str) -> DataFrame:
    """One line {id: {...}} per row: the keyed JSON export, without a task or a row that holds all of it."""
    return table.select(F.to_json(F.create_map(F.col(key).cast("string"), F.struct(*(c for c in table.columns if c != key)))).alias("value"))


def write_keyed_json(table: DataFrame, path: str, key: str) -> None:
    keyed_lines(table, key).write.mode("overwrite").text(path)


def prometheus_lines(counters: DataFrame, histograms: DataFrame, summaries: DataFrame) -> DataFrame:
    """Exposition text as (name, line_no, line). counters: name, help, kind, labels, value; histograms: name, help,
    labels, le, cumulative, n, total; summaries: name, help, labels, quantile, value, n, total. labels: k="v" text."""

    def heads(df: DataFrame, kind) -> DataFrame:
        kind = F.col("kind") if kind is None else F.lit(kind)
        one = df.select("name", "help", kind.alias("k")).distinct()
        return one.select("name", F.lit("").alias("labels"), F.explode(F.array(F.struct(F.lit(0).alias("o"), F.concat_ws(" ", F.lit("# HELP"), "name", "help").alias("line")), F.struct(F.lit(1).alias("o"), F.concat_ws(" ", F.lit("# TYPE"), "name", "k").alias("line")))).alias("r")).select("name", "labels", "r.o", F.lit("").alias("x"), "r.line")

    braces = lambda *parts: F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))
    plain = lambda c: F.when(F.col("labels") == "", F.lit("")).otherwise(braces(c))
    named = F.when(F.col("labels") != "", F.col("labels"))
    values = counters.select("name", "labels", F.lit(2).alias("o"), F.lit("").alias("x"), F.concat(F.col("name"), plain("labels"), F.lit(" "), F.col("value").cast("string")).alias("line"))
    le = F.concat(F.lit('le="'), F.col("le"), F.lit('"'))
    bucket = histograms.select("name", "labels", F.lit(2).alias("o"), F.lpad("le", 12, "0").alias("x"), F.concat(F.col("name"), F.lit("_bucket"), braces(named, le), F.lit(" "), F.col("cumulative").cast("string")).alias("line"))
    q = F.concat(F.lit('quantile="'), F.col("quantile"), F.lit('"'))
    quant = summaries.select("name", "labels", F.lit(2).alias("o"), F.col("quantile").alias("x"), F.concat(F.col("name"), braces(named, q), F.lit(" "), F.col("value").cast("string")).alias("line"))

    def tails(df: DataFrame) -> DataFrame:
        one = df.select("name", "labels", "n", "total").distinct()
        row = lambda o, suffix, c: F.struct(F.lit(o).alias("o"), F.concat(F.col("name"), F.lit(suffix), plain("labels"), F.lit(" "), F.col(c).cast("string")).alias("line"))
        return one.select("name", "labels", F.explode(F.array(row(3, "_sum", "total"), row(4, "_count", "n"))).alias("r")).select("name", "labels", "r.o", F.lit("").alias("x"), "r.line")

    out = heads(counters, None).union(heads(histograms, "histogram")).union(heads(summaries, "summary")).union(values).union(bucket).union(quant).union(tails(histograms)).union(tails(summaries))
    return out.select("name", F.concat_ws("|", F.when(F.col("o") < 2, "0").otherwise("1"), "labels", F.col("o").cast("string"), "x").alias("line_no"), "line")
