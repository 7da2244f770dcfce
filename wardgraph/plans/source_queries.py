"""Queries that land tables as files and read them back through the scans and sinks."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wardgraph.functions import ids
from wardgraph.operators import chain
from wardgraph.plans.bridge import Bridge
from wardgraph.plans.chain_queries import CORRELATE, correlated, joined_lists, techniques
from wardgraph.plans.registry import query
from wardgraph.operators import telemetry
from wardgraph.sources import paged, scans, sinks
from wardgraph.sources.store import VersionedStore
from wardgraph.sources.tables import new_path, written


def land_pages(b: Bridge, path: str, order: str | None = None) -> None:
    """The vulnerabilities as API pages: a file's line is one page of a year's orders."""
    text = F.array(F.struct(F.lit("en").alias("lang"), F.concat(F.lit("see CWE-"), (F.col("o_orderkey") % 90 + 10).cast("string"), F.lit(" and CWE-79")).alias("value")), F.struct(F.lit("es").alias("lang"), F.lit("CWE-1").alias("value")))
    rec = F.struct(F.struct(F.col("cve_id").alias("id"), text.alias("descriptions"), F.col("published")).alias("cve"))
    pages = b.vuln.groupBy(F.floor(F.col("o_orderkey") / 500)).agg(F.collect_list(rec).alias("vulnerabilities")).select("vulnerabilities")
    pages.write.json(path)


@query("select cve_id, array_to_string(list_sort(list_distinct([cast(o_orderkey % 90 + 10 as varchar), '79'])), ',') as cwe from b_vuln")
def scan_vuln_pages(b: Bridge):
    path = new_path(b.spark, "pages")
    land_pages(b, path)
    back = scans.vuln_pages(b.spark, path, lines=True)
    return back.select(F.col("id").alias("cve_id"), ids.joined(ids.weakness_ids(F.col("descriptions"))).alias("cwe"))


@query("select o_orderkey, o_totalprice from orders order by o_orderdate, o_orderkey limit 2000 offset 300")
def scan_page_range(b: Bridge):
    return scans.page_range(b.table("orders"), ["o_orderdate", "o_orderkey"], 300, 2000).select("o_orderkey", "o_totalprice")


def numbered_orders(b: Bridge):
    return telemetry.numbered(b.table("orders"), [], ["o_orderdate", "o_orderkey"], "n").select((F.col("n") - 1).alias("index"), "o_orderkey", "o_totalprice")


def land_records(rows, path: str, size: int) -> None:
    """Rows with an index, as pages of up to `size` records, each in a folder start=<index of its first> as JSON lines in order."""
    page = F.floor(F.col("index") / size)
    first = rows.groupBy(page.alias("page")).agg(F.min("index").alias("start"))
    lines = rows.select("index", page.alias("page"), F.to_json(F.struct(*(c for c in rows.columns if c != "index"))).alias("value")).join(first, "page")
    lines.repartition("start").sortWithinPartitions("start", "index").select("start", "value").write.mode("append").partitionBy("start").text(path)


@query("select cast(row_number() over (order by o_orderdate, o_orderkey) - 1 as bigint) as index, o_orderkey, o_totalprice from orders")
def scan_paged_source(b: Bridge):
    """Landed pages read by offset, a partition a page of another size than the landed ones."""
    path, name = new_path(b.spark, "api"), f"pages_{uuid.uuid4().hex}"
    land_records(numbered_orders(b), path, 1000)
    b.spark.dataSource.register(paged.paged_source(name, paged.LandedPages(path)))
    found = b.spark.read.format(name).option("page_size", 750).load()
    return found.select("index", F.from_json("record", "o_orderkey long, o_totalprice double").alias("r")).select("index", "r.*")


@query("select capec_id, name, techniques as taxonomy from b_capec where capec_id <> ''")
def scan_attack_pattern_csv(b: Bridge):
    path = new_path(b.spark, "patterns")
    b.capec.select(F.col("capec_id").alias("'ID"), F.col("name").alias("Name"), F.col("taxonomy").alias("Taxonomy Mappings")).write.csv(path, header=True, escape='"')
    return scans.attack_pattern_csv(b.spark, path)


@query("select cwe_id, name, coalesce(parent_id, '') as parents from b_cwe left join b_cwe_parent using (cwe_id)")
def scan_weakness_xml(b: Bridge):
    path = new_path(b.spark, "weaknesses")
    rows = b.cwe.join(b.cwe_parent, "cwe_id", "left")
    child = F.when(F.col("parent_id").isNotNull(), F.array(F.struct(F.array(F.struct(F.col("parent_id").alias("_CWE_ID"))).alias("Weakness"))))
    rows.select(F.col("cwe_id").alias("_ID"), F.col("name").alias("_Name"), F.col("name").alias("Description"), child.alias("ChildOf")).write.format("xml").option("rowTag", "Weakness").option("rootTag", "Weaknesses").save(path)
    return scans.weakness_xml(b.spark, path).select("cwe_id", "name", ids.joined(F.col("child_of")).alias("parents"))


@query("select cast(p_partkey as varchar) as technique_id, case when p_partkey % 3 = 0 then 'ics' when p_partkey % 2 = 0 then 'mobile' else 'enterprise' end as framework, p_name as name from part where p_partkey % 7 <> 0")
def scan_technique_sheets(b: Bridge):
    """Each framework's sheet holds parts; those in several sheets keep the later framework."""
    part, key, paths = b.table("part"), F.col("p_partkey"), {}
    tid = F.when(key % 7 == 0, "nan").otherwise(key.cast("string"))
    for name, rows in (("enterprise", part), ("mobile", part.where("p_partkey % 2 = 0")), ("ics", part.where("p_partkey % 3 = 0"))):
        at = scans.SHEETS[name][0]
        cols = [tid if i == at else F.col("p_name") if i == 1 else F.lit("x") for i in range(11)]
        paths[name] = new_path(b.spark, name)
        rows.select(*(c.alias(f"c{i}") for i, c in enumerate(cols))).write.csv(paths[name], header=True, escape='"')
    return scans.technique_sheets(b.spark, paths).select("technique_id", "framework", "name")


LISTS_SQL = CORRELATE + "select v.cve_id, coalesce(l1.s, '') as cwe, coalesce(l2.s, '') as capec, coalesce(l3.s, '') as techniques, coalesce(l4.s, '') as defend, coalesce(l5.s, '') as owasp from b_vuln v left join l1 using (cve_id) left join l2 using (cve_id) left join l3 using (cve_id) left join l4 using (cve_id) left join l5 using (cve_id)"


@query(LISTS_SQL)
def scan_jsonl_map(b: Bridge):
    lines = written(sinks.jsonl_lines(correlated(b)), "lines", compression="zstd")
    return joined_lists(scans.jsonl_map(lines.withColumn("seq", F.lit(0))))


@query(LISTS_SQL)
def sink_jsonl(b: Bridge):
    path = new_path(b.spark, "jsonl")
    sinks.write_jsonl(correlated(b), path, compression="gzip")
    return joined_lists(scans.jsonl_map(b.spark.read.text(path).withColumn("seq", F.lit(0))))


@query("select case when o_orderkey % 10 = 0 then 'bad' else 'good' end as status, count(*) as n from orders where o_orderkey % 10 <> 1 group by 1")
def scan_jsonl_permissive(b: Bridge):
    key = F.col("o_orderkey")
    line = F.when(key % 10 == 0, F.concat(F.lit('{"CVE-'), "o_orderstatus")).when(key % 10 == 1, "  ").otherwise(F.concat(F.lit('{"CVE-'), key.cast("string"), F.lit('":{"CWE":["79"]}}')))
    return scans.jsonl_split(b.table("orders").select(line.alias("value"))).groupBy("status").agg(F.count("*").alias("n"))


@query("select technique_id, d3f_id from b_defend where d3f_id <> 'BUILDING' or technique_id not like '%5'")
def scan_countermeasures(b: Bridge):
    """Two lines a technique: the whole list, and for some a later one without BUILDING that replaces it."""
    own = b.defend
    line = lambda df, n: df.groupBy("technique_id").agg(F.collect_list(F.struct(F.col("d3f_id").alias("id"))).alias("ids")).select(F.to_json(F.create_map("technique_id", "ids")).alias("value"), F.lit(n).alias("seq"))
    later = own.where("technique_id like '%5' and d3f_id <> 'BUILDING'")
    return scans.countermeasures(line(own, 1).union(line(later, 2)))


@query("select cast(p_partkey as varchar) as id, p_name as name, p_size as size from part")
def scan_json_object_table(b: Bridge):
    """Objects by id, one line a block of parts."""
    path = new_path(b.spark, "objects")
    entry = F.struct(F.col("p_partkey").cast("string"), F.struct(F.col("p_name").alias("name"), F.col("p_size").alias("size")))
    b.table("part").groupBy(F.floor(F.col("p_partkey") / 1000).alias("block")).agg(F.to_json(F.map_from_entries(F.collect_list(entry))).alias("value")).repartition("block").select("value").write.option("lineSep", "\n").text(path)
    return scans.object_table(b.spark, path, "struct<name:string,size:int>", lines=True)


@query("select cwe_id, owasp_id as category_id from b_cwe")
def scan_category_map(b: Bridge):
    """Documents of the categories of a block of weaknesses each."""
    path = new_path(b.spark, "categories")
    block = F.floor(F.col("cwe_id").cast("long") / 1000).alias("block")
    rows = b.cwe.groupBy(block, "owasp_id").agg(F.collect_list("cwe_id").alias("cwe_ids"))
    each = rows.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("owasp_id", F.struct(F.col("owasp_id").alias("name"), F.lit("").alias("description"), "cwe_ids")))).alias("categories"))
    each.select("categories").write.json(path)
    return scans.category_map(b.spark, path, lines=True)[1]


@query("select cve_id, yr from b_vuln where yr in (1996, 1998)")
def scan_year_partition(b: Bridge):
    """Only the years that the requested ids name are read; of one of them there are no records."""
    path = new_path(b.spark, "years")
    b.vuln.select("cve_id", "yr").repartition("yr", F.pmod(F.xxhash64("cve_id"), F.lit(8))).write.partitionBy("yr").parquet(path)
    some = b.vuln.where("yr in (1996, 1998)").select("cve_id")
    wanted = some.union(some.limit(1).select(F.lit("CVE-2050-0000001")))
    return scans.year_partition(b.spark, path, wanted, "yr")[0].select("cve_id", "yr")


@query("select p_partkey, case when p_partkey % 3 = 0 then p_brand else p_name end as name from part where p_partkey % 3 = 0 or p_partkey % 2 = 0")
def scan_first_available(b: Bridge):
    part = b.table("part")
    first = part.where("p_partkey % 3 = 0").select("p_partkey", F.col("p_brand").alias("name"))
    return scans.first_available([first, part.where("p_partkey % 2 = 0").select("p_partkey", F.col("p_name").alias("name"))], "p_partkey")


@query("select technique_id, tactic, cast(score as double) as score, enabled from x_layer")
def scan_layer_json(b: Bridge):
    """Layers of an old version, a line holding the list of those of a block of parts, one a tactic."""
    path = new_path(b.spark, "layers")
    cell = F.struct(F.col("technique_id").alias("techniqueID"), "tactic", "score", "enabled", F.lit(5).alias("comment"))
    block = F.floor(F.col("p_partkey") / 1000).alias("block")
    layer = b.layer.groupBy(block, "tactic").agg(F.collect_list(cell).alias("techniques")).select("block", F.struct(F.lit("old").alias("name"), F.lit("3.0").alias("version"), F.lit("mitre-enterprise").alias("domain"), F.lit(2).alias("viewMode"), "techniques").alias("l"))
    layer.groupBy("block").agg(F.to_json(F.collect_list("l")).alias("value")).select("value").write.text(path)
    back = scans.layer_json(b.spark, path, lines=True).where("domain = 'enterprise-attack' and layout = 'mini' and layer_version = '3.0'")
    return back.select(F.explode("techniques").alias("t")).select("t.technique_id", "t.tactic", "t.score", "t.enabled")


@query("""select 'c' || c_custkey as name, case c_custkey % 4 when 0 then '3.0' when 1 then '2.1' when 2 then '4.5' else '1.0' end as layer_version,
case c_custkey % 4 when 1 then 'mobile-attack' when 3 then null else 'enterprise-attack' end as domain, case c_custkey % 4 when 0 then 'mini' when 2 then 'flat' else 'side' end as layout, c_custkey % 4 = 2 as hide_disabled, c_custkey % 9 as sorting from customer""")
def select_layer_fields(b: Bridge):
    """Layers of four versions, brought to the fields of the newest."""
    k, name = F.col("c_custkey"), F.concat(F.lit('{"name":"c'), F.col("c_custkey"), F.lit('","sorting":'), F.col("c_custkey") % 9)
    rest = (
        F.when(k % 4 == 0, ',"version":"3.0","domain":"mitre-enterprise","viewMode":2,"stages":["act"]}')
        .when(k % 4 == 1, ',"version":"2.1","domain":"mitre-mobile","viewFullTable":false}')
        .when(k % 4 == 2, ',"versions":{"layer":"4.5"},"domain":"enterprise-attack","layout":{"layout":"flat"},"hideDisabled":true}')
        .otherwise(',"version":"1.0","viewFullTable":true,"hideDisabled":"true"}')
    )
    fields = scans.layers_of(b.table("customer").select(F.concat(name, rest).alias("value")))
    return fields.select("name", "layer_version", "domain", "layout", "hide_disabled", F.col("sorting").cast("long").alias("sorting"))


@query("select 'e' || event_id as error_id, category, severity from b_error where event_id % 3 <> 0")
def scan_error_log(b: Bridge):
    rec = F.when(F.col("event_id") % 3 != 0, F.struct(F.concat(F.lit("e"), "event_id").alias("error_id"), "category", "severity"))
    lines = b.error.select(F.to_json(F.struct(F.lit("ERROR").alias("level"), rec.alias("error_record"))).alias("value"))
    return scans.error_log(lines).select("error_id", "category", "severity")


@query("select r_name as \"column\", n_name as parent, s_name as node, true as is_leaf, 'D3-' || s_suppkey as d3f_id from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey where s_suppkey % 9 <> 0 union all select distinct r_name, r_name, n_name, false, null from supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def land_d3fend_matrix(b: Bridge):
    """Regions are columns, nations groups, suppliers leaves; some leaves have no id and drop. A line is the matrix of a
    block of suppliers, so a group may come in several."""
    path = new_path(b.spark, "matrix")
    leaf = F.struct(F.col("s_name").alias("rdfs:label"), F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("D3-"), "s_suppkey")).alias("d3f:d3fend-id"))
    rows = b.table("supplier").join(b.table("nation"), F.col("s_nationkey") == F.col("n_nationkey")).join(b.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    groups = rows.groupBy(F.floor(F.col("s_suppkey") / 1000).alias("block"), "r_name", "n_name").agg(F.collect_list(leaf).alias("children"))
    group = F.struct(F.col("n_name").alias("name"), F.lit("D3-X").alias("d3f:d3fend-id"), "children")
    cols = groups.groupBy("block", "r_name").agg(F.collect_list(group).alias("children"))
    lines = cols.groupBy("block").agg(F.to_json(F.collect_list(F.struct(F.concat(F.lit("d3f:"), "r_name").alias("@id"), "children"))).alias("value"))
    lines.select("value").write.text(path)
    return scans.countermeasure_tree(b.spark, path, lines=True).distinct()


# sinks

UPSERT = "select cve_id, yr as year, case when o_orderkey % 3 = 0 then 'new' else 'old' end as state from b_vuln where o_orderkey % 2 = 0 or o_orderkey % 3 = 0"


@query(UPSERT)
def upsert_by_year(b: Bridge):
    path = new_path(b.spark, "vulns")
    half = lambda n, s: b.vuln.where(f"o_orderkey % {n} = 0").select("cve_id", F.col("yr").alias("year"), F.lit(s).alias("state"))
    sinks.upsert_by_year(half(2, "old"), path)
    sinks.upsert_by_year(half(3, "new"), path)
    return b.spark.read.parquet(path).select("cve_id", "year", "state")


@query(UPSERT)
def upsert_versions(b: Bridge):
    """The same upsert into a store of versions, of which a reader sees the last."""
    store = VersionedStore(b.spark, new_path(b.spark, "store"), buckets=4)
    half = lambda n, s: b.vuln.where(f"o_orderkey % {n} = 0").select("cve_id", F.col("yr").alias("year"), F.lit(s).alias("state"))
    store.upsert(half(2, "old"))
    store.upsert(half(3, "new"))
    return store.read()


@query("select cwe_id, name from b_cwe")
def sink_knowledge_table(b: Bridge):
    """The table as Parquet, and from it the keyed JSON export, which is read back."""
    path, lines = new_path(b.spark, "knowledge"), new_path(b.spark, "knowledge-json")
    sinks.write_knowledge(b.cwe.select("cwe_id", "name"), path)
    sinks.write_keyed_json(b.spark.read.parquet(path), lines, "cwe_id")
    return scans.object_table(b.spark, lines, "struct<name:string>", "cwe_id", lines=True)


PROM = """with c as (select event_type as k, cast(cast(sum(cast(value as decimal(24,4))) as decimal(38,4)) as varchar) as total, count(*) as n from events group by event_type),
q as (select event_type as k, value, row_number() over (partition by event_type order by value) as rn, count(*) over (partition by event_type) as n from events),
m as (select k, cast(cast(max(case when rn = greatest(cast(trunc(0.5::double * n - 1) as bigint), 0) + 1 then value end) as decimal(24,4)) as varchar) as v from q group by k),
lines as (select '# HELP events_total Events' as line union all select '# TYPE events_total counter' union all select 'events_total' || chr(123) || 'type="' || k || '"' || chr(125) || ' ' || n from c
union all select '# HELP latency Latency' union all select '# TYPE latency histogram' union all select 'latency_count' || chr(123) || 'type="' || k || '"' || chr(125) || ' ' || n from c
union all select 'latency_sum' || chr(123) || 'type="' || k || '"' || chr(125) || ' ' || total from c
union all select 'latency_bucket' || chr(123) || 'type="' || event_type || '",le="' || l || '"' || chr(125) || ' ' || count(*) filter (value <= b) from events cross join (values ('10.0', 10.0), ('100.0', 100.0), ('+Inf', 1e308)) v(l, b) group by event_type, l, b
union all select '# HELP size Size' union all select '# TYPE size summary' union all select 'size_count' || chr(123) || 'type="' || k || '"' || chr(125) || ' ' || n from c
union all select 'size_sum' || chr(123) || 'type="' || k || '"' || chr(125) || ' ' || total from c
union all select 'size' || chr(123) || 'type="' || k || '",quantile="0.5"' || chr(125) || ' ' || v from m)
select line from lines"""


@query(PROM)
def sink_metrics_text(b: Bridge):
    """Exposition text of a counter, a histogram and a summary; sums and quantiles are printed with four decimals."""
    rows = b.table("events").select(F.col("event_type").alias("label_key"), "value")
    label = F.concat(F.lit('type="'), F.col("label_key"), F.lit('"'))
    fixed = lambda c, kind: F.col(c).cast(kind).alias(c if c == "total" else "value")
    counters = rows.groupBy("label_key").agg(F.count("*").alias("value")).select(F.lit("events_total").alias("name"), F.lit("Events").alias("help"), F.lit("counter").alias("kind"), label.alias("labels"), "value")
    hist = telemetry.histogram(rows, (10.0, 100.0, float("inf"))).select(F.lit("latency").alias("name"), F.lit("Latency").alias("help"), label.alias("labels"), "le", "cumulative", "n", fixed("total", "decimal(38,4)"))
    quant = telemetry.quantiles(rows, (0.5,)).select(F.lit("size").alias("name"), F.lit("Size").alias("help"), label.alias("labels"), F.lit("0.5").alias("quantile"), fixed("q5", "decimal(24,4)"), "n", fixed("total", "decimal(38,4)"))
    path = new_path(b.spark, "metrics")
    sinks.prometheus_lines(counters, hist, quant).orderBy("name", "line_no").select("line").write.text(path)
    return b.spark.read.text(path).select(F.col("value").alias("line"))


@query("select t.capec_id, t.technique_id from x_capec_tech t")
def capec_technique_pairs(b: Bridge):
    """The pattern table exploded, as the chain joins it: distinct within a pattern."""
    return chain.valid_techniques(techniques(b))
