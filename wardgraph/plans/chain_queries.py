"""Queries of the knowledge chain, projections and validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardgraph.functions import ids, status
from wardgraph.operators import chain, rules
from wardgraph.plans.bridge import Bridge
from wardgraph.plans.registry import query


def techniques(b: Bridge):
    return chain.capec_techniques(b.capec)


def category_map(b: Bridge):
    return b.cwe.select("cwe_id", F.col("owasp_id").alias("category_id"))


def joined_lists(df):
    return df.select("cve_id", *(ids.joined(F.col(c)).alias(c) for c in chain.LISTS))


def knowledge(b: Bridge, *kinds: str):
    return chain.Knowledge(b.cwe_parent, b.cwe_capec, techniques(b), b.defend, category_map(b), kinds or chain.LISTS)


def correlated(b: Bridge):
    return knowledge(b).of(b.vuln_cwe, b.vuln)


def reached(b: Bridge, kind: str, name: str):
    """(cve_id, name), distinct: what a vulnerability reaches, by its weaknesses and their parents. A row is made of each at the end alone."""
    return knowledge(b, kind).of(b.vuln_cwe).select("cve_id", F.explode(kind).alias(name))


CORRELATE = """
with y_capec as (select distinct x.cve_id, c.capec_id from x_cwe x join b_cwe_capec c on x.cwe_id = c.cwe_id),
y_tech as (select distinct y.cve_id, t.technique_id from y_capec y join x_capec_tech t on y.capec_id = t.capec_id),
y_def as (select distinct y.cve_id, d.d3f_id from y_tech y join b_defend d on 'T' || y.technique_id = d.technique_id),
y_cat as (select distinct v.cve_id, c.owasp_id from b_vuln_cwe v join b_cwe c on v.cwe_id = c.cwe_id),
l1 as (select cve_id, string_agg(cwe_id, ',' order by cwe_id) as s from x_cwe group by cve_id), l2 as (select cve_id, string_agg(capec_id, ',' order by capec_id) as s from y_capec group by cve_id),
l3 as (select cve_id, string_agg(technique_id, ',' order by technique_id) as s from y_tech group by cve_id), l4 as (select cve_id, string_agg(d3f_id, ',' order by d3f_id) as s from y_def group by cve_id),
l5 as (select cve_id, string_agg(owasp_id, ',' order by owasp_id) as s from y_cat group by cve_id)
"""


@query(CORRELATE + "select v.cve_id, coalesce(l1.s, '') as cwe, coalesce(l2.s, '') as capec, coalesce(l3.s, '') as techniques, coalesce(l4.s, '') as defend, coalesce(l5.s, '') as owasp from b_vuln v left join l1 using (cve_id) left join l2 using (cve_id) left join l3 using (cve_id) left join l4 using (cve_id) left join l5 using (cve_id)")
def correlate(b: Bridge):
    return joined_lists(correlated(b))


@query("select cve_id, string_agg(cwe_id, ',' order by cwe_id) as cwe from b_vuln_cwe group by cve_id")
def sorted_id_lists(b: Bridge):
    return b.vuln_cwe.groupBy("cve_id").agg(ids.joined(F.sort_array(F.collect_set("cwe_id"))).alias("cwe"))


@query("select cve_id, cwe_id from x_cwe")
def expand_parents(b: Bridge):
    return chain.expand_parents(b.vuln_cwe, b.cwe_parent)


@query("select cve_id, cwe_id from x_cwe")
def union_parents(b: Bridge):
    """The same set by array_union of the direct list and the parents' list."""
    own = b.vuln_cwe.join(b.cwe_parent.groupBy("cwe_id").agg(F.collect_set("parent_id").alias("up")), "cwe_id", "left")
    both = own.groupBy("cve_id").agg(F.collect_set("cwe_id").alias("own"), F.flatten(F.collect_list("up")).alias("up"))
    return both.select("cve_id", F.explode(F.array_union("own", "up")).alias("cwe_id"))


@query("""with recursive r as (select cwe_id, parent_id as ancestor_id, 1 as depth from b_cwe_parent union all select r.cwe_id, p.parent_id, r.depth + 1 from r join b_cwe_parent p on r.ancestor_id = p.cwe_id where r.depth < 20)
select cwe_id, ancestor_id, cast(min(depth) as int) as depth from r group by cwe_id, ancestor_id""")
def expand_ancestors(b: Bridge):
    return chain.ancestors(b.cwe_parent)


@query("select distinct x.cve_id, c.capec_id from x_cwe x join b_cwe_capec c on x.cwe_id = c.cwe_id")
def weakness_to_patterns(b: Bridge):
    return reached(b, "capec", "capec_id")


@query("select distinct x.cve_id, t.technique_id from x_cwe x join b_cwe_capec c on x.cwe_id = c.cwe_id join x_capec_tech t on c.capec_id = t.capec_id")
def patterns_to_techniques(b: Bridge):
    return reached(b, "techniques", "technique_id")


@query("select distinct x.cve_id, d.d3f_id from x_cwe x join b_cwe_capec c on x.cwe_id = c.cwe_id join x_capec_tech t on c.capec_id = t.capec_id join b_defend d on d.technique_id = 'T' || t.technique_id")
def techniques_to_countermeasures(b: Bridge):
    return reached(b, "defend", "d3f_id")


@query("select v.cve_id, coalesce(x.s, '') as categories from b_vuln v left join (select cve_id, string_agg(owasp_id, ',' order by owasp_id) as s from (select distinct v.cve_id, c.owasp_id from b_vuln_cwe v join b_cwe c on v.cwe_id = c.cwe_id) group by cve_id) x using (cve_id)")
def weakness_to_categories(b: Bridge):
    return chain.weakness_categories(b.vuln, b.vuln_cwe, category_map(b)).select("cve_id", ids.joined(F.col("categories")).alias("categories"))


@query("select t.technique_id, t.tactic, s.n from b_technique_tactic t join (select 'T' || technique_id as technique_id, count(*) as n from x_capec_tech group by technique_id) s using (technique_id)")
def attach_tactics(b: Bridge):
    n = techniques(b).groupBy(F.concat(F.lit("T"), F.col("technique_id")).alias("technique_id")).agg(F.count("*").alias("n"))
    return chain.attach_tactics(n, b.technique_tactic).select("technique_id", "tactic", "n")


@query("select t.capec_id, a.ics as technique_id from x_capec_tech t join (select cast(1000 + n_nationkey as varchar) as technique_id, case when n_nationkey % 3 = 0 then 'T0' || cast(n_nationkey as varchar) end as ics from nation) a on t.technique_id = a.technique_id where a.ics is not null")
def translate_domain(b: Bridge):
    key = F.col("n_nationkey")
    assoc = b.table("nation").select((1000 + key).cast("string").alias("technique_id"), F.when(key % 3 == 0, F.concat(F.lit("T0"), key.cast("string"))).alias("ics"), F.lit(None).cast("string").alias("mobile"))
    return chain.translate_domain(techniques(b), assoc, "ics").select("capec_id", "technique_id")


def wanted(b: Bridge):
    """Requested ids: those of orders in some months, and as many that no store has."""
    some = b.vuln.where("o_orderkey % 7 = 0").select("cve_id")
    return some.union(b.table("customer").select(F.concat(F.lit("CVE-1990-"), F.lpad(F.col("c_custkey").cast("string"), 7, "0")).alias("cve_id")))


WANTED = "with w as (select cve_id from b_vuln where o_orderkey % 7 = 0 union all select 'CVE-1990-' || lpad(cast(c_custkey as varchar), 7, '0') from customer)\n"


@query(WANTED + "select v.cve_id, v.yr from b_vuln v semi join w on v.cve_id = w.cve_id")
def lookup_request(b: Bridge):
    return chain.lookup_request(b.vuln.select("cve_id", "yr"), wanted(b))


@query(WANTED + "select distinct w.cve_id from w anti join b_vuln v on v.cve_id = w.cve_id")
def not_found(b: Bridge):
    return chain.not_found(b.vuln, wanted(b))


@query("select cast(c_custkey as varchar) as id, n_name as name from customer join nation on c_nationkey = n_nationkey")
def lookup_category(b: Bridge):
    return b.table("customer").join(b.table("nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").cast("string").alias("id"), F.col("n_name").alias("name"))


OVERRIDE = "select cwe_id, owasp_id as category_id from b_cwe where cast(cwe_id as bigint) % 10 <> 0 union all select cast(p_partkey as varchar), p_brand from part where p_partkey % 10 = 0"


@query(OVERRIDE)
def override_mapping(b: Bridge):
    new = b.table("part").where("p_partkey % 10 = 0").select(F.col("p_partkey").cast("string").alias("cwe_id"), F.col("p_brand").alias("category_id"))
    return chain.replace_keys(category_map(b), new, "cwe_id")


@query(OVERRIDE)
def custom_mapping(b: Bridge):
    """A user's mapping first, the default for the rest: the same rows by priority instead of an anti-join."""
    new = b.table("part").where("p_partkey % 10 = 0").select(F.col("p_partkey").cast("string").alias("cwe_id"), F.col("p_brand").alias("category_id"), F.lit(0).alias("p"))
    both = new.unionByName(category_map(b).withColumn("p", F.lit(1)))
    return both.groupBy("cwe_id").agg(F.min_by("category_id", "p").alias("category_id"))


# projections and filters


@query("select cve_id, cast(published as timestamp) as published from b_vuln where published between timestamp '1996-01-01' and timestamp '1997-12-31'")
def filter_pub_window(b: Bridge):
    return b.vuln.where(F.col("published").between(F.lit("1996-01-01").cast("timestamp"), F.lit("1997-12-31").cast("timestamp"))).select("cve_id", "published")


@query("select doc_id, coalesce(array_to_string(list_sort(list_distinct(regexp_extract_all(text, '([0-9]{3,})', 1))), ','), '') as found from documents where lang = 'en'")
def extract_weakness_ids(b: Bridge):
    """The extraction on documents: numbers of three and more digits, since they hold no weakness ids."""
    docs = b.table("documents").where("lang = 'en'")
    found = ids.weakness_ids(F.array(F.struct("lang", F.col("text").alias("value"))), "en", "([0-9]{3,})")
    return docs.select("doc_id", F.coalesce(ids.joined(found), F.lit("")).alias("found"))


@query("select cve_id, o_orderkey from (select case when o_orderkey % 11 = 0 then '' when o_orderkey % 13 = 0 then null else cve_id end as cve_id, o_orderkey from b_vuln) where coalesce(cve_id, '') <> ''")
def drop_missing_id(b: Bridge):
    broken = b.vuln.select(F.when(F.col("o_orderkey") % 11 == 0, "").when(F.col("o_orderkey") % 13 == 0, None).otherwise(F.col("cve_id")).alias("cve_id"), "o_orderkey")
    return broken.where(F.coalesce("cve_id", F.lit("")) != "")


BROKEN = """with s as (select o_orderkey, case when o_orderkey % 17 = 0 then 'X-' || cve_id else cve_id end as cve_id, case when o_orderkey % 5 = 0 then 'number' when o_orderkey % 7 = 0 then 'missing' else 'list' end as shape from b_vuln),
c as (select *, (case when o_orderkey % 17 = 0 then 1 else 0 end) + (case when shape = 'number' then 1 else 0 end) as errors, case when shape = 'missing' then 1 else 0 end as warnings from s)
"""


def broken_records(b: Bridge):
    key = F.col("o_orderkey")
    body = F.when(key % 5 == 0, '{"CWE":5,"CAPEC":[],"TECHNIQUES":[]}').when(key % 7 == 0, '{"CAPEC":["1"],"TECHNIQUES":[]}').otherwise('{"CWE":["79"],"CAPEC":[],"TECHNIQUES":["1"]}')
    return b.vuln.select("o_orderkey", F.when(key % 17 == 0, F.concat(F.lit("X-"), "cve_id")).otherwise(F.col("cve_id")).alias("cve_id"), body.alias("body"))


@query(BROKEN + "select o_orderkey, cve_id, cast(errors as int) as errors, cast(warnings as int) as warnings from c")
def validate_records(b: Bridge):
    return rules.validate_records(broken_records(b)).select("o_orderkey", "cve_id", F.size("errors").alias("errors"), F.size("warnings").alias("warnings"))


ID_TEXT = "(select o_orderkey, case o_orderkey % 6 when 0 then 'CWE-' || cast(o_orderkey as varchar) when 1 then cast(o_orderkey as varchar) when 2 then 'T' || cast(o_orderkey as varchar) || '.001' when 3 then 'T' || cast(o_orderkey as varchar) when 4 then 'CWE-' || cast(o_orderkey as varchar) || 'x' else cast(o_orderkey as varchar) || '.1.2' end as s from orders)"


def id_texts(b: Bridge):
    k = F.col("o_orderkey")
    t = k.cast("string")
    s = F.when(k % 6 == 0, F.concat(F.lit("CWE-"), t)).when(k % 6 == 1, t).when(k % 6 == 2, F.concat(F.lit("T"), t, F.lit(".001"))).when(k % 6 == 3, F.concat(F.lit("T"), t)).when(k % 6 == 4, F.concat(F.lit("CWE-"), t, F.lit("x"))).otherwise(F.concat(t, F.lit(".1.2")))
    return b.table("orders").select("o_orderkey", s.alias("s"))


@query(f"select o_orderkey, s, regexp_matches(s, '^CWE-[0-9]+$') as ok from {ID_TEXT}")
def is_weakness_id(b: Bridge):
    return id_texts(b).withColumn("ok", ids.is_weakness_id(F.col("s")))


@query(f"select o_orderkey, s, regexp_matches(s, '^[0-9]+$') as ok from {ID_TEXT}")
def is_pattern_id(b: Bridge):
    return id_texts(b).withColumn("ok", ids.is_pattern_id(F.col("s")))


@query(f"select o_orderkey, s, regexp_matches(s, '^T?[0-9]+([.][0-9]+)?$') as ok from {ID_TEXT}")
def is_technique_id(b: Bridge):
    return id_texts(b).withColumn("ok", ids.is_technique_id(F.col("s")))


@query("select o_orderkey, trim(unnest(string_split(t, chr(10)))) as id from (select o_orderkey, ' ' || cve_id || chr(10) || 'junk' || chr(10) || 'CVE-12-3' || chr(10) || cve_id as t from b_vuln) qualify true".replace(" qualify true", "").join(("select o_orderkey, id from (", ") where regexp_matches(id, '^CVE-[0-9]{4}-[0-9]{4,}$')")))
def filter_request_ids(b: Bridge):
    text = F.concat(F.lit(" "), F.col("cve_id"), F.lit("\njunk\nCVE-12-3\n"), F.col("cve_id"))
    rows = b.vuln.select("o_orderkey", F.explode(F.split(text, "\n")).alias("id")).withColumn("id", F.trim("id"))
    return rows.where(ids.is_request_id(F.col("id")))


@query("select cve_id, cast(string_split(cve_id, '-')[2] as int) as year from b_vuln")
def year_of_id(b: Bridge):
    return b.vuln.select("cve_id", ids.year_of_id(F.col("cve_id")).alias("year"))


@query(f"select o_orderkey, regexp_replace(s, '^CWE-', '') as id from {ID_TEXT}")
def normalise_weakness_id(b: Bridge):
    return id_texts(b).select("o_orderkey", ids.normalise_weakness_id(F.col("s")).alias("id"))


@query("select capec_id, array_to_string(list_filter(regexp_extract_all(techniques, 'ATTACK:ENTRY ID:([^:]*)', 1), lambda t: regexp_matches(t, '^T?[0-9]+([.][0-9]+)?$')), ',') as techniques from b_capec")
def parse_taxonomy(b: Bridge):
    return b.capec.select("capec_id", ids.joined(ids.taxonomy_ids(F.col("taxonomy"))).alias("techniques"))


@query("select capec_id, array_to_string(list_sort(list_distinct(regexp_extract_all(techniques, 'ATTACK:ENTRY ID:([^:]*)', 1))), ',') as techniques from b_capec")
def parse_taxonomy_distinct(b: Bridge):
    return b.capec.select("capec_id", ids.joined(F.sort_array(F.array_distinct(ids.taxonomy_ids(F.col("taxonomy"), valid=False)))).alias("techniques"))


NODES = "(select 'CVE-' || c_custkey as node from customer union all select 'CWE-' || p_partkey from part union all select 'CAPEC-' || s_suppkey from supplier union all select 'T' || o_orderkey from orders union all select 'D3F-' || c_mktsegment from customer union all select 'OWASP-' || p_type from part union all select p_name from part)"


def nodes(b: Bridge):
    make = lambda t, p, c: b.table(t).select(F.concat(F.lit(p), F.col(c).cast("string")).alias("node"))
    out = make("customer", "CVE-", "c_custkey")
    for t, p, c in (("part", "CWE-", "p_partkey"), ("supplier", "CAPEC-", "s_suppkey"), ("orders", "T", "o_orderkey"), ("customer", "D3F-", "c_mktsegment"), ("part", "OWASP-", "p_type"), ("part", "", "p_name")):
        out = out.union(make(t, p, c))
    return out


@query(f"select node from {NODES}")
def node_label(b: Bridge):
    return nodes(b)


@query(f"""select node, case when starts_with(node, 'CVE-') then 'cve' when starts_with(node, 'CWE-') then 'cwe' when starts_with(node, 'CAPEC-') then 'capec' when starts_with(node, 'T') then 'technique' when starts_with(node, 'D3F-') then 'countermeasure' when starts_with(node, 'OWASP-') then 'category' end as type,
case when starts_with(node, 'CVE-') then '#ff6b6b' when starts_with(node, 'CWE-') then '#4ecdc4' when starts_with(node, 'CAPEC-') then '#45b7d1' when starts_with(node, 'T') then '#96ceb4' when starts_with(node, 'D3F-') then '#feca57' when starts_with(node, 'OWASP-') then '#ff9ff3' end as colour from {NODES}""")
def classify_node(b: Bridge):
    return nodes(b).select("node", ids.node_type(F.col("node")).alias("type"), ids.node_colour(F.col("node")).alias("colour"))


@query("select c_custkey, regexp_replace(lower(n_name || ' AND ' || c_mktsegment), '^([^ ]*) ', '\\1-') as slug from customer join nation on c_nationkey = n_nationkey")
def tactic_slug(b: Bridge):
    rows = b.table("customer").join(b.table("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", ids.tactic_slug(F.concat("n_name", F.lit(" AND "), "c_mktsegment")).alias("slug"))


@query("select event_id, case when event_type <> 'error' then 'k' else '' end as keys from events")
def drop_empty_values(b: Bridge):
    m = F.create_map(F.lit("k"), F.when(F.col("event_type") != "error", F.array("event_type")).otherwise(F.array().cast("array<string>")), F.lit("n"), F.lit(None).cast("array<string>"))
    return b.table("events").select("event_id", F.array_join(F.map_keys(ids.drop_empty_values(m)), ",").alias("keys"))


# exception names are made of the event types
NAMES = "(select event_id, case event_type when 'error' then 'SystemConnectionError' when 'click' then 'JSONDecodeError' when 'view' then 'FilePermissionError' when 'signup' then 'ConfigTimeout' else 'SqlDataError' end as t, event_type from events)"


def exception_names(b: Bridge):
    e = F.col("event_type")
    t = F.when(e == "error", "SystemConnectionError").when(e == "click", "JSONDecodeError").when(e == "view", "FilePermissionError").when(e == "signup", "ConfigTimeout").otherwise("SqlDataError")
    return b.table("events").select("event_id", t.alias("t"))


@query(f"""select event_id, t, case when regexp_matches(lower(t), 'request|http|connection') then 'network_error' when regexp_matches(lower(t), 'file|io|permission') then 'file_operation' when regexp_matches(lower(t), 'json|decode|validation') then 'data_validation' when regexp_matches(lower(t), 'config|setting') then 'configuration' when regexp_matches(lower(t), 'database|sql') then 'database_error' else 'unknown' end as category,
case when regexp_matches(lower(t), 'critical|fatal|system') then 'critical' when regexp_matches(lower(t), 'connection|timeout|api') then 'high' when regexp_matches(lower(t), 'validation|file|data') then 'medium' else 'low' end as severity from {NAMES}""")
def classify_error(b: Bridge):
    return exception_names(b).select("event_id", "t", status.error_category(F.col("t")).alias("category"), status.error_severity(F.col("t")).alias("severity"))


@query("""select event_id, t, case t when 'APIError' then 'api_error' when 'DatabaseError' then 'database_error' else 'unknown' end as category, case t when 'APIError' then 'high' when 'DatabaseError' then 'high' else 'low' end as severity
from (select event_id, case event_type when 'error' then 'APIError' when 'click' then 'DatabaseError' else 'KeyError' end as t from events)""")
def error_exception_defaults(b: Bridge):
    e = F.col("event_type")
    rows = b.table("events").select("event_id", F.when(e == "error", "APIError").when(e == "click", "DatabaseError").otherwise("KeyError").alias("t"))
    return rows.select("event_id", "t", status.typed_category(F.col("t")).alias("category"), status.typed_severity(F.col("t")).alias("severity"))


@query("select event_id, case when event_id % 3 = 0 then '' else 'r' || event_id || '_' end || category || '_' || cast(cast(floor(epoch(ts)) as bigint) as varchar) as error_id from b_error")
def error_id(b: Bridge):
    request = F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("r"), F.col("event_id").cast("string")))
    return b.error.select("event_id", status.error_id(request, F.col("category"), F.col("ts")).alias("error_id"))


@query("select event_id, 'component=' || component || '|severity=' || severity as label_key from b_error")
def label_key(b: Bridge):
    return b.error.select("event_id", ids.label_key(F.create_map(F.lit("severity"), F.col("severity"), F.lit("component"), F.col("component"))).alias("label_key"))


@query("select event_id, case when value > 90 then 'unhealthy' when value > 80 then 'degraded' else 'healthy' end as memory, case when value < 5 then 'unhealthy' when value < 15 then 'degraded' else 'healthy' end as disk from events")
def threshold_status(b: Bridge):
    v = F.col("value")
    return b.table("events").select("event_id", status.threshold_status(v, 80, 90).alias("memory"), status.threshold_status(v, 15, 5, above=False).alias("disk"))


RULES = (
    rules.Rule("o_orderkey", "required"),
    rules.Rule("o_totalprice", "range", (1000.0, 400000.0)),
    rules.Rule("o_orderpriority", "pattern", ("^[1-5]-",)),
    rules.Rule("o_orderstatus", "enum", ("F", "O"), warning=True),
    rules.Rule("o_custkey", "range", (1, None), stage=1),
)
RULE_SQL = """with c as (select o_orderkey, (case when o_orderkey is null then 1 else 0 end) + (case when o_totalprice < 1000 or o_totalprice > 400000 then 1 else 0 end) + (case when not regexp_matches(o_orderpriority, '^[1-5]-') then 1 else 0 end) as e0,
case when o_orderstatus not in ('F', 'O') then 1 else 0 end as w, case when o_custkey < 1 then 1 else 0 end as e1 from orders)
"""


@query(RULE_SQL + "select o_orderkey, cast(e0 + case when e0 = 0 then e1 else 0 end as int) as errors, cast(w as int) as warnings from c")
def dq_rules(b: Bridge):
    return rules.check_rows(b.table("orders"), RULES).select("o_orderkey", F.size("errors").alias("errors"), F.size("warnings").alias("warnings"))


@query(RULE_SQL + "select sum(e0 + case when e0 = 0 then e1 else 0 end) = 0 as valid, cast(sum(e0 + case when e0 = 0 then e1 else 0 end) as bigint) as error_count, cast(sum(w) as bigint) as warning_count from c")
def dq_report(b: Bridge):
    return rules.report(rules.check_rows(b.table("orders"), RULES))
