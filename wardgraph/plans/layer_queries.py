"""Queries of matrix layers. Cells are the parts of the sample tables: a part is a technique, its type a tactic."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardgraph.operators import layers
from wardgraph.plans.bridge import Bridge
from wardgraph.plans.graph_queries import EDGES, all_edges, rolled
from wardgraph.plans.registry import query
from wardgraph.sources.tables import new_path

SLICES = "with a as (select technique_id, tactic, cast(score as double) as score from x_layer where p_partkey % 3 <> 0), b as (select technique_id, tactic, cast(score * 2 as double) as score from x_layer where p_partkey % 3 <> 1)\n"
BOTH = SLICES.rstrip() + ", f as (select coalesce(a.technique_id, b.technique_id) as technique_id, coalesce(a.tactic, b.tactic) as tactic, a.score as a, b.score as b from a full join b on a.technique_id = b.technique_id and a.tactic = b.tactic)\n"


def slices(b: Bridge):
    cells = b.layer
    return {"a": cells.where("p_partkey % 3 <> 0"), "b": cells.where("p_partkey % 3 <> 1").withColumn("score", F.col("score") * 2)}


@query(BOTH + "select technique_id, tactic, coalesce(a, 0) + coalesce(b, 0) * 0.5 as score from f")
def combine_layers(b: Bridge):
    return layers.combine(slices(b), "a + b * 0.5", missing=0.0)


EIGHT = "select technique_id, tactic, cast(sum(case when score is not null and p_partkey % (k + 2) <> 0 then score * k else 0 end) as double) as score from x_layer cross join (select unnest(range(1, 9)) as k) group by technique_id, tactic, p_partkey having bool_or(p_partkey % (k + 2) <> 0)"


@query(EIGHT)
def combine_many_layers(b: Bridge):
    """Eight layers, each of the cells whose number its own does not divide."""
    each = {f"{chr(96 + k)}": b.layer.where(F.col("p_partkey") % (k + 2) != 0).withColumn("score", F.col("score") * k) for k in range(1, 9)}
    return layers.combine(each, " + ".join(each), missing=0.0)


@query(BOTH + "select technique_id, tactic, cast(case when (a > 20 and b >= 50) is null then null when a > 20 and b >= 50 then 25 when a is null then null when a >= 10 then (a + b) / 2 else -a end as double) as score from f")
def score_expression(b: Bridge):
    return layers.combine(slices(b), "(a > 20 and b >= 50) ? 25 : (not (a < 10) ? (a + b) / 2 : -a)")


@query("""with o as (select 'T' || p_partkey as technique_id, p_name as n from part where p_partkey % 5 <> 0), n as (select 'T' || p_partkey as technique_id, case when p_partkey % 4 = 0 then p_brand else p_name end as n from part where p_partkey % 7 <> 0)
select coalesce(o.technique_id, n.technique_id) as technique_id, case when o.technique_id is null then 'added' when n.technique_id is null and cast(substr(o.technique_id, 2) as bigint) % 2 = 0 then 'replaced' when n.technique_id is null then 'removed' when o.n = n.n then 'unchanged' else 'changed' end as state from o full join n on o.technique_id = n.technique_id""")
def layer_upgrade_diff(b: Bridge):
    key = F.concat(F.lit("T"), F.col("p_partkey").cast("string")).alias("technique_id")
    part = b.table("part")
    old = part.where("p_partkey % 5 <> 0").select(key, F.col("p_name").alias("name"))
    new = part.where("p_partkey % 7 <> 0").select(key, F.when(F.col("p_partkey") % 4 == 0, F.col("p_brand")).otherwise(F.col("p_name")).alias("name"))
    return layers.upgrade_diff(old, new, part.where("p_partkey % 2 = 0").select(key.alias("from_id")))


@query(SLICES.rstrip() + """, f as (select coalesce(a.technique_id, b.technique_id) as technique_id, coalesce(a.tactic, b.tactic) as tactic, a.score as a, b.score as b, a.technique_id is not null as in_a, b.technique_id is not null as in_b from a full join b on a.technique_id = b.technique_id and a.tactic = b.tactic)
select f.technique_id, f.tactic, f.a - f.b as score, case when in_b then x.name end as comment, case when in_a then x.enabled end as enabled from f join x_layer x on f.technique_id = x.technique_id""")
def combine_layers_inherited(b: Bridge):
    """Two layers of one domain and version: comments are those of one, states those of the other."""
    both = {n: df.withColumnRenamed("name", "comment") for n, df in slices(b).items()}
    return layers.combine(both, "a - b", inherit={"comment": "b", "enabled": "a"}, of={"a": ("enterprise", "17"), "b": ("enterprise", "17")})


@query("""with o as (select technique_id, tactic, score, name from x_layer where p_partkey % 5 <> 0), n as (select technique_id, case when p_partkey % 4 = 0 then 'moved' else tactic end as tactic from x_layer where p_partkey % 7 <> 0)
select n.technique_id, n.tactic, o.score, o.name from n join o on n.technique_id = o.technique_id and n.tactic = o.tactic""")
def layer_upgrade_copies(b: Bridge):
    """Annotations of techniques whose tactics are those of the old version."""
    cells = b.layer
    new = cells.where("p_partkey % 7 <> 0").select("technique_id", F.when(F.col("p_partkey") % 4 == 0, "moved").otherwise(F.col("tactic")).alias("tactic"))
    return layers.upgrade_copies(cells.where("p_partkey % 5 <> 0"), new, ["score", "name"])


@query("""with c as (select technique_id, case when p_partkey % 2 = 0 then tactic end as tactic, score, p_partkey from x_layer), t as (select 'T' || p_partkey as technique_id, 'one' as tactic from part union all select 'T' || p_partkey, 'two' from part where p_partkey % 3 = 0)
select technique_id, tactic, score from c where tactic is not null union all select c.technique_id, t.tactic, c.score from c join t on c.technique_id = t.technique_id where c.tactic is null""")
def expand_tacticless(b: Bridge):
    cells = b.layer.select("technique_id", F.when(F.col("p_partkey") % 2 == 0, F.col("tactic")).alias("tactic"), "score")
    key = b.layer.select("technique_id", "p_partkey")
    tactics = key.select("technique_id", F.lit("one").alias("tactic")).union(key.where("p_partkey % 3 = 0").select("technique_id", F.lit("two")))
    return layers.expand_tacticless(cells, tactics)


@query("select distinct cast(c_custkey as varchar) as technique_id from customer join nation on c_nationkey = n_nationkey where n_name in ('FRANCE', 'GERMANY', 'NATION_3', 'NATION_7') or c_custkey % 10 = 0")
def select_by_mapping(b: Bridge):
    cust = b.table("customer").withColumn("technique_id", F.col("c_custkey").cast("string"))
    mapped = cust.join(b.table("nation").where(F.col("n_name").isin("FRANCE", "GERMANY", "NATION_3", "NATION_7")), F.col("c_nationkey") == F.col("n_nationkey"), "left_semi")
    return layers.select_by_mapping(cust.where("c_custkey % 10 = 0"), mapped)


def parts(b: Bridge):
    text = F.concat(F.lit("T"), F.floor(F.col("p_partkey") / 10).cast("string"), F.when(F.col("p_partkey") % 10 != 0, F.concat(F.lit("."), F.lpad((F.col("p_partkey") % 10).cast("string"), 3, "0"))).otherwise(""))
    return b.table("part").select(text.alias("technique_id"), F.when(F.col("p_size") % 6 != 0, F.col("p_size") % 20).cast("long").alias("score"))


SUB = "with c as (select 'T' || cast(cast(floor(p_partkey / 10) as bigint) as varchar) as technique_id, p_partkey % 10 <> 0 as sub, case when p_size % 6 <> 0 then cast(p_size % 20 as bigint) end as score from part)\n"


@query(SUB + "select technique_id, avg(nullif(score, 0)) as average, min(score) as min, max(score) as max, cast(sum(score) as bigint) as sum from c group by technique_id having bool_or(sub)")
def aggregate_scores(b: Bridge):
    return layers.aggregate_scores(parts(b))


@query(SUB + "select technique_id, avg(coalesce(score, 0)) as average, min(coalesce(score, 0)) as min, max(coalesce(score, 0)) as max, cast(sum(coalesce(score, 0)) as bigint) as sum from c group by technique_id having bool_or(sub)")
def aggregate_scores_unscored(b: Bridge):
    return layers.aggregate_scores(parts(b), count_unscored=True)


@query("select p_partkey, p_name from part where list_contains(string_split(p_name, ' '), 'red') or list_contains(string_split(p_name, ' '), 'ring')")
def filter_platforms(b: Bridge):
    cells = b.table("part").select("p_partkey", "p_name", F.split("p_name", " ").alias("platforms"))
    return layers.filter_platforms(cells, ["red", "ring"]).select("p_partkey", "p_name")


@query("select technique_id, tactic from x_layer where enabled")
def hide_disabled(b: Bridge):
    return layers.hide_disabled(b.layer).select("technique_id", "tactic")


@query("select p_partkey from part where contains(lower(p_name), 'bolt') or contains(lower(p_brand), 'bolt')")
def search_objects(b: Bridge):
    return layers.search(b.table("part"), "Bolt", ["p_name", "p_brand"]).select("p_partkey")


for _mode, _order in enumerate(("name asc", "name desc", "coalesce(score, 0) asc", "coalesce(score, 0) desc")):

    @query(f"select technique_id, tactic, cast(row_number() over (partition by tactic order by {_order}, technique_id) as int) as rank from x_layer", name="layer_sort" if _mode == 3 else f"layer_sort_{_mode}")
    def layer_sort(b: Bridge, mode: int = _mode):
        return layers.sort_rank(b.layer, mode).select("technique_id", "tactic", "rank")


@query("select c_custkey, cast(coalesce(list_position(['Model', 'Harden', 'Detect', 'Isolate', 'Deceive', 'Evict', 'Restore'], case c_custkey % 4 when 0 then 'Detect' when 1 then 'Model' when 2 then 'Restore' else c_mktsegment end), 0) as bigint) as place from customer")
def ordered_columns(b: Bridge):
    k = F.col("c_custkey") % 4
    label = F.when(k == 0, "Detect").when(k == 1, "Model").when(k == 2, "Restore").otherwise(F.col("c_mktsegment"))
    return b.table("customer").select("c_custkey", layers.column_order(label).alias("place"))


@query(EDGES + "select r.node as \"techniqueID\", t.tactic, r.score, (select max(score) from rolled) as max_value from rolled r join b_technique_tactic t on r.node = t.technique_id")
def sink_layer(b: Bridge):
    """The layer document, written as JSON and read back as cells."""
    scores = rolled(b)
    cells = scores.join(b.technique_tactic, scores.node == F.col("technique_id")).select("technique_id", "tactic", "score")
    most = scores.agg(F.max("score")).first()[0] or 0
    text = layers.layer_json(cells, "enterprise-defend", most)
    back = text.select(F.from_json("layer", "gradient struct<maxValue:long>, techniques array<struct<techniqueID:string,tactic:string,score:long>>").alias("j"))
    return back.select("j.gradient.maxValue", F.explode("j.techniques").alias("t")).select("t.*", F.col("maxValue").alias("max_value"))


@query(EDGES + "select d.p as platform, count(*) as cells from (select unnest(['Windows', 'Linux', 'macOS', 'Network', 'PRE', 'Containers', 'Office 365', 'SaaS', 'Google Workspace', 'IaaS', 'Azure AD']) as p) d, rolled where starts_with(node, 'T') group by d.p")
def domain_config(b: Bridge):
    """The platforms that a layer of the graph's techniques lists, each with the layer's number of cells."""
    n = rolled(b).where(F.col("node").startswith("T")).agg(F.count("*").alias("cells"))
    return n.select(F.explode(F.array(*map(F.lit, layers.PLATFORMS[layers.domain_of("enterprise-defend")]))).alias("platform"), "cells")


@query("select technique_id, tactic, score from x_layer where enabled order by tactic, coalesce(score, 0) desc, technique_id")
def sink_layer_table(b: Bridge):
    """The table export: hidden cells dropped, sorted as the layer, written as CSV and read back."""
    path = new_path(b.spark, "layer-csv")
    layers.sort_rank(layers.hide_disabled(b.layer), 3).orderBy("tactic", "rank").select("technique_id", "tactic", "score").write.csv(path, header=True)
    return b.spark.read.schema("technique_id string, tactic string, score int").csv(path, header=True)


@query("select technique_id, tactic, score from x_layer where enabled and (list_contains(string_split(name, ' '), 'red') or list_contains(string_split(name, ' '), 'ring')) order by tactic, coalesce(score, 0) desc, technique_id")
def sink_layer_table_filtered(b: Bridge):
    """The table export of the chosen platforms alone, here words of a cell's name."""
    path = new_path(b.spark, "layer-csv")
    chosen = layers.filter_platforms(layers.hide_disabled(b.layer.withColumn("platforms", F.split("name", " "))), ["red", "ring"])
    layers.sort_rank(chosen, 3).orderBy("tactic", "rank").select("technique_id", "tactic", "score").write.csv(path, header=True)
    return b.spark.read.schema("technique_id string, tactic string, score int").csv(path, header=True)
