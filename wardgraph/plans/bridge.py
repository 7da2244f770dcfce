"""Views that give the sample tables the shape of the knowledge chain, as DataFrames and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardgraph.sources.tables import partitions

VIEWS_SQL = """
b_vuln as (select 'CVE-' || cast(year(o_orderdate) as string) || '-' || lpad(cast(o_orderkey as string), 7, '0') as cve_id,
  cast(year(o_orderdate) as int) as yr, o_orderdate as published, o_orderkey from orders),
b_vuln_cwe as (select distinct v.cve_id, cast(l.l_partkey as string) as cwe_id from b_vuln v join lineitem l on v.o_orderkey = l.l_orderkey),
b_cwe as (select cast(p_partkey as string) as cwe_id, p_name as name, p_type as owasp_id from part),
b_cwe_parent as (select cast(p_partkey as string) as cwe_id, cast(cast(floor(p_partkey / 10) as bigint) as string) as parent_id from part where p_partkey >= 10),
b_cwe_capec as (select distinct cast(l_partkey as string) as cwe_id, cast(l_suppkey as string) as capec_id from lineitem where l_linenumber = 1),
b_capec as (select cast(s_suppkey as string) as capec_id, s_name as name,
  '::TAXONOMY NAME:ATTACK:ENTRY ID:' || cast(1000 + s_nationkey as string) || ':ENTRY NAME:n::TAXONOMY NAME:ATTACK:ENTRY ID:' || cast(1000 + s_nationkey as string)
  || '.' || lpad(cast(s_suppkey % 7 as string), 3, '0') || ':ENTRY NAME:s::' || case when s_suppkey % 5 = 0 then 'TAXONOMY NAME:ATTACK:ENTRY ID:10x:ENTRY NAME:bad::' else '' end as techniques from supplier),
b_technique_tactic as (select 'T' || cast(1000 + n_nationkey as string) as technique_id, r_name as tactic from nation join region on n_regionkey = r_regionkey
  union all select 'T' || cast(1000 + n_nationkey as string), 'COMMAND AND CONTROL' from nation where n_nationkey % 2 = 0),
b_defend as (select distinct 'T' || cast(1000 + c_nationkey as string) as technique_id, c_mktsegment as d3f_id from customer),
b_error as (select event_id, ts, cast(user_id as string) as component,
  case when value >= 200 then 'critical' when value >= 100 then 'high' when value >= 30 then 'medium' else 'low' end as severity,
  event_type as category, value as duration, event_type <> 'error' as success from events),
x_capec_tech as (select capec_id, t as technique_id from (select capec_id, unnest(regexp_extract_all(techniques, 'ATTACK:ENTRY ID:([^:]*)', 1)) as t from b_capec) where regexp_matches(t, '^T?[0-9]+([.][0-9]+)?$')),
x_cwe as (select cve_id, cwe_id from b_vuln_cwe union select c.cve_id, p.parent_id from b_vuln_cwe c join b_cwe_parent p on c.cwe_id = p.cwe_id),
x_layer as (select 'T' || cast(p_partkey as string) as technique_id, p_type as tactic, case when p_size % 6 = 0 then null else p_size end as score, p_size % 7 <> 0 as enabled, p_name as name, p_partkey from part)
"""


def with_views(sql: str) -> str:
    """SQL that may use the views; it may begin with `with` to add its own (recursive ones too)."""
    sql = sql.strip()
    if sql.lower().startswith("with recursive "):
        return f"with recursive {VIEWS_SQL.strip()},\n{sql[15:]}"
    return f"with {VIEWS_SQL.strip()}" + (f",\n{sql[5:]}" if sql.lower().startswith("with ") else f"\n{sql}")


class Bridge:
    """The views over one folder of tables. Timestamps are read as UTC."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._read: dict[str, DataFrame] = {}  # a read looks into the files: once a table

    def table(self, name: str) -> DataFrame:
        if name not in self._read:
            self._read[name] = self._table(name)
        return self._read[name]

    def _table(self, name: str) -> DataFrame:
        df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return df.withColumns({c: F.col(c).cast("timestamp") for c, t in df.dtypes if t == "timestamp_ntz"}) if "timestamp_ntz" in dict(df.dtypes).values() else df

    @property
    def vuln(self) -> DataFrame:
        year = F.year("o_orderdate")
        cve = F.concat(F.lit("CVE-"), year.cast("string"), F.lit("-"), F.lpad(F.col("o_orderkey").cast("string"), 7, "0"))
        return self.table("orders").select(cve.alias("cve_id"), year.alias("yr"), F.col("o_orderdate").alias("published"), "o_orderkey")

    @property
    def vuln_cwe(self) -> DataFrame:
        """Dealt twice, by order and by vulnerability, in partitions whose number grows with the lines."""
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.col("l_partkey").cast("string").alias("cwe_id"))
        n = partitions(self.spark, lines.count())
        own = self.vuln.select("cve_id", "o_orderkey").repartition(n, "o_orderkey").join(lines.repartition(n, "o_orderkey"), "o_orderkey")
        return own.select("cve_id", "cwe_id").repartition(n, "cve_id").distinct()

    @property
    def cwe(self) -> DataFrame:
        return self.table("part").select(F.col("p_partkey").cast("string").alias("cwe_id"), F.col("p_name").alias("name"), F.col("p_type").alias("owasp_id"))

    @property
    def cwe_parent(self) -> DataFrame:
        return self.table("part").where("p_partkey >= 10").select(F.col("p_partkey").cast("string").alias("cwe_id"), F.floor(F.col("p_partkey") / 10).cast("string").alias("parent_id"))

    @property
    def cwe_capec(self) -> DataFrame:
        return self.table("lineitem").where("l_linenumber = 1").select(F.col("l_partkey").cast("string").alias("cwe_id"), F.col("l_suppkey").cast("string").alias("capec_id")).distinct()

    @property
    def capec(self) -> DataFrame:
        tech = (1000 + F.col("s_nationkey")).cast("string")
        head, bad = "TAXONOMY NAME:ATTACK:ENTRY ID:", "TAXONOMY NAME:ATTACK:ENTRY ID:10x:ENTRY NAME:bad::"
        text = F.concat(
            F.lit("::" + head), tech, F.lit(":ENTRY NAME:n::" + head), tech, F.lit("."), F.lpad((F.col("s_suppkey") % 7).cast("string"), 3, "0"), F.lit(":ENTRY NAME:s::"), F.when(F.col("s_suppkey") % 5 == 0, bad).otherwise("")
        )
        return self.table("supplier").select(F.col("s_suppkey").cast("string").alias("capec_id"), F.col("s_name").alias("name"), text.alias("taxonomy"))

    @property
    def technique_tactic(self) -> DataFrame:
        nation = self.table("nation").withColumn("technique_id", F.concat(F.lit("T"), (1000 + F.col("n_nationkey")).cast("string")))
        named = nation.join(self.table("region"), F.col("n_regionkey") == F.col("r_regionkey")).select("technique_id", F.col("r_name").alias("tactic"))
        return named.union(nation.where("n_nationkey % 2 = 0").select("technique_id", F.lit("COMMAND AND CONTROL")))

    @property
    def defend(self) -> DataFrame:
        return self.table("customer").select(F.concat(F.lit("T"), (1000 + F.col("c_nationkey")).cast("string")).alias("technique_id"), F.col("c_mktsegment").alias("d3f_id")).distinct()

    @property
    def error(self) -> DataFrame:
        v = F.col("value")
        severity = F.when(v >= 200, "critical").when(v >= 100, "high").when(v >= 30, "medium").otherwise("low")
        return self.table("events").select("event_id", "ts", F.col("user_id").cast("string").alias("component"), severity.alias("severity"), F.col("event_type").alias("category"), v.alias("duration"), (F.col("event_type") != "error").alias("success"))

    @property
    def layer(self) -> DataFrame:
        score = F.when(F.col("p_size") % 6 != 0, F.col("p_size"))
        return self.table("part").select(F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("technique_id"), F.col("p_type").alias("tactic"), score.alias("score"), (F.col("p_size") % 7 != 0).alias("enabled"), F.col("p_name").alias("name"), "p_partkey")
