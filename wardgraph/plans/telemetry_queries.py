"""Queries of pipeline telemetry on the events."""

from __future__ import annotations

from pyspark.sql import functions as F

from wardgraph.functions import status
from wardgraph.operators import telemetry as t
from wardgraph.plans.bridge import Bridge
from wardgraph.plans.registry import query
from wardgraph.sources.tables import new_path, written
from wardgraph.streaming.streams import open_requests

DEC = "cast(sum(cast({} as decimal(24,4))) as double)"


@query("select category, severity, count(*) as n, cast(grouping(category) * 2 + grouping(severity) as int) as level from b_error group by grouping sets ((category), (severity), (category, severity), ())")
def error_summary(b: Bridge):
    return t.error_summary(b.error)


ALERTS = "with r as (select event_id, category, severity, row_number() over (partition by category, severity order by ts, event_id) as nth from b_error) select event_id, category, severity, nth from r where nth % case severity when 'critical' then 1 when 'high' then 5 when 'medium' then 20 else 50 end = 0"


@query(ALERTS)
def alerts(b: Bridge):
    return t.alerts(b.error).select("event_id", "category", "severity", F.col("nth").cast("long").alias("nth"))


@query(f"select cast(0 as bigint) as active, count(*) as completed, count(*) as total, round(count(*) filter (success) * 100.0 / count(*), 2) as success_rate, round({DEC.format('duration')} / count(*), 3) as avg_duration from b_error")
def request_stats(b: Bridge):
    return t.request_stats(b.error)


@query(f"select count(*) filter (event_id % 4 = 0) as active, count(*) filter (event_id % 4 <> 0) as completed, count(*) as total, round(count(*) filter (success and event_id % 4 <> 0) * 100.0 / count(*) filter (event_id % 4 <> 0), 2) as success_rate, round(cast(sum(cast(duration as decimal(24,4))) filter (event_id % 4 <> 0) as double) / count(*) filter (event_id % 4 <> 0), 3) as avg_duration from b_error")
def request_stats_active(b: Bridge):
    """A fourth of the requests have no end yet."""
    requests = b.error.withColumn("request_id", F.col("event_id").cast("string"))
    done = requests.where("event_id % 4 <> 0")
    active = open_requests(requests.select("request_id", "ts"), done.select("request_id", "ts"))
    return t.request_stats(done, active)


@query(f"select count(*) as operations, {DEC.format('value')} as total_duration, cast(sum(user_id) as bigint) as total_items, round(avg(case when value > 0 then user_id / value else 0 end), 6) as mean_rate from events")
def perf_summary(b: Bridge):
    rows = b.table("events").select(F.col("value").alias("duration"), F.col("user_id").alias("items"))
    return t.perf_summary(rows).withColumn("mean_rate", F.round("mean_rate", 6))


@query(f"select 'events_total' as name, event_type as label_key, {DEC.format('value')} as total from events group by event_type")
def counter_totals(b: Bridge):
    return t.counter_totals(b.table("events").select(F.lit("events_total").alias("name"), F.col("event_type").alias("label_key"), "value"))


@query("""with s as (select cast(user_id as varchar) as label_key, event_id as seq, case when event_id % 10 = 0 then 'set' when event_id % 3 = 0 then 'dec' else 'inc' end as op, cast(value as decimal(24,4)) as value from events),
l as (select label_key, max(seq) as seq, arg_max(value, seq) as value from s where op = 'set' group by label_key)
select s.label_key, cast(coalesce(any_value(l.value), 0) + coalesce(sum(case when l.seq is null or s.seq > l.seq then case s.op when 'inc' then s.value when 'dec' then -s.value end end), 0) as double) as value from s left join l on s.label_key = l.label_key group by s.label_key""")
def gauge_value(b: Bridge):
    k = F.col("event_id")
    op = F.when(k % 10 == 0, "set").when(k % 3 == 0, "dec").otherwise("inc")
    return t.gauge_values(b.table("events").select(F.col("user_id").cast("string").alias("label_key"), k.alias("seq"), op.alias("op"), "value"))


def _buckets(bs):
    return ", ".join(f"('{'+Inf' if b == float('inf') else b}', {'1e308' if b == float('inf') else b})" for b in bs)


HIST = "select event_type as label_key, s.n, s.total, k.le, count(*) filter (e.value <= k.b) as cumulative from events e join (select event_type as et, count(*) as n, cast(sum(cast(value as decimal(24,4))) as double) as total from events group by event_type) s on e.event_type = s.et cross join (values {}) k(le, b) group by event_type, s.n, s.total, k.le, k.b"


def samples(b: Bridge):
    return b.table("events").select(F.col("event_type").alias("label_key"), "value")


@query(HIST.format(_buckets(t.BUCKETS)))
def histogram(b: Bridge):
    return t.histogram(samples(b))


# fixed values: bounds of a histogram for durations in seconds
OWN = (0.1, 0.5, 1.0, 2.0, 5.0, 10.0, 30.0, 60.0)


def _quantiles(qs):
    picks = ", ".join(f"max(case when rn = greatest(cast(trunc({q}::double * n - 1) as bigint), 0) + 1 then value end) as q{str(q)[2:]}" for q in qs)
    return f"with r as (select event_type as label_key, value, row_number() over (partition by event_type order by value) as rn, count(*) over (partition by event_type) as n from events) select label_key, max(n) as n, {DEC.format('value')} as total, {DEC.format('value')} / max(n) as mean, {picks} from r group by label_key"


@query(_quantiles(t.QUANTILES))
def summary_quantiles(b: Bridge):
    return t.quantiles(samples(b))


@query("select event_type as label_key, count(*) as n, q, true as within from events cross join (select unnest([0.5, 0.9, 0.95, 0.99])::double as q) group by event_type, q")
def summary_sketch(b: Bridge):
    """Sketches stored by day, merged by type; each answer's exact rank against the stated error (twice it: one table is one case)."""
    rows = b.table("events").select(F.col("event_type").alias("label_key"), F.to_date("ts").alias("day"), "value")
    path = new_path(b.spark, "sketches")
    t.sketches(rows, "label_key", "day").write.parquet(path)
    found = written(t.sketched_quantiles(t.merged(b.spark.read.parquet(path), "label_key")), "sketched")
    errors = t.rank_errors(rows, found, "label_key")
    return errors.join(found.select("label_key", "n"), "label_key").select("label_key", "n", "q", (F.col("error") <= 2 * t.SKETCH_ERROR).alias("within"))


@query(HIST.format(_buckets(OWN)))
def custom_buckets(b: Bridge):
    return t.histogram(samples(b), OWN)


@query(_quantiles((0.25, 0.75)))
def custom_buckets_quantiles(b: Bridge):
    return t.quantiles(samples(b), (0.25, 0.75))


@query(f"select event_type as func, count(*) as n, {DEC.format('value')} as total, {DEC.format('value')} / count(*) as mean, min(value) as min, max(value) as max from events group by event_type")
def profile_summary(b: Bridge):
    return t.profile(b.table("events").select(F.col("event_type").alias("func"), "value"))


NEED = "(select unnest(['signup', 'error', 'click', 'view', 'purchase', 'refund', 'audit']) as name)"


def required(b: Bridge):
    return b.spark.createDataFrame([(x,) for x in ("signup", "error", "click", "view", "purchase", "refund", "audit")], "name string")


@query(f"select name from {NEED} r anti join events e on r.name = e.event_type")
def missing_members(b: Bridge):
    return required(b).join(b.table("events").select(F.col("event_type").alias("name")), "name", "left_anti")


@query(f"select case when (select count(*) from {NEED} r anti join events e on r.name = e.event_type) > 0 then 'unhealthy' when (select count(*) from events) = 0 then 'degraded' else 'healthy' end as status, (select count(*) from events) as entries")
def database_health(b: Bridge):
    missing = missing_members(b).agg(F.count("*").alias("missing"))
    total = b.table("events").agg(F.count("*").alias("entries"))
    both = total.join(F.broadcast(missing))  # one row by one row
    return both.select(F.when(F.col("missing") > 0, "unhealthy").when(F.col("entries") == 0, "degraded").otherwise("healthy").alias("status"), "entries")


@query("select component, case when count(*) filter (severity = 'critical') > 0 then 'unhealthy' when count(*) filter (severity = 'high') > 10 or count(*) > 100 then 'degraded' else 'healthy' end as status from b_error group by component")
def error_rate_health(b: Bridge):
    n = lambda s: F.count_if(F.col("severity") == s)
    return b.error.groupBy("component").agg(F.when(n("critical") > 0, "unhealthy").when((n("high") > 10) | (F.count("*") > 100), "degraded").otherwise("healthy").alias("status"))


@query("select component, case max(case severity when 'critical' then 2 when 'high' then 1 else 0 end) when 2 then 'unhealthy' when 1 then 'degraded' else 'healthy' end as status from b_error group by component")
def worst_status(b: Bridge):
    s = F.when(F.col("severity") == "critical", "unhealthy").when(F.col("severity") == "high", "degraded").when(F.col("severity") == "low", "healthy").otherwise("unknown")
    return b.error.groupBy("component").agg(status.worst(s).alias("status"))


RUNS = f"select component as run_id, count(*) as steps, count(*) filter (category in ('view', 'click')) as success, count(*) filter (category = 'error') as failed, {DEC.format('duration')} as total_duration from b_error group by component"


def run_summaries(b: Bridge):
    step = F.when(F.col("category").isin("view", "click"), "success").when(F.col("category") == "error", "failed").otherwise("partial")
    n = lambda s: F.count_if(step == s)
    return b.error.groupBy(F.col("component").alias("run_id")).agg(F.count("*").alias("steps"), n("success").alias("success"), n("failed").alias("failed"), t.exact_sum("duration").alias("total_duration"))


@query(RUNS)
def run_summary(b: Bridge):
    return run_summaries(b)


@query(RUNS)
def sink_run_summary(b: Bridge):
    """Summaries appended as JSON lines and read back."""
    path, out = new_path(b.spark, "runs"), run_summaries(b)
    out.write.mode("append").json(path)
    return b.spark.read.schema(out.schema).json(path)


@query("select component, count(*) filter (success) as hits, count(*) filter (not success) as misses, round(count(*) filter (success) / count(*), 6) as ratio from b_error group by component")
def cache_ratio(b: Bridge):
    return b.error.groupBy("component").agg(F.count_if("success").alias("hits"), F.count_if(~F.col("success")).alias("misses"), F.round(F.count_if("success") / F.count("*"), 6).alias("ratio"))


@query("select count(distinct user_id) as metrics, count(distinct event_type) as kinds, string_agg(distinct event_type, ',' order by event_type) as kind_list from events")
def metrics_overview(b: Bridge):
    return b.table("events").agg(F.count_distinct("user_id").alias("metrics"), F.count_distinct("event_type").alias("kinds"), F.array_join(F.sort_array(F.collect_set("event_type")), ",").alias("kind_list"))


@query("select component, count(*) filter (success) as ok, count(*) filter (not success) as failed, case when count(*) filter (not success) = 0 then 'success' else 'partial' end as status from b_error group by component")
def update_outcomes(b: Bridge):
    failed = F.count_if(~F.col("success"))
    return b.error.groupBy("component").agg(F.count_if("success").alias("ok"), failed.alias("failed"), F.when(failed == 0, "success").otherwise("partial").alias("status"))


# windows, sorts, limits


@query("select user_id, max(event_id) as event_id, arg_max(event_type, event_id) as event_type, arg_max(value, event_id) as value from events group by user_id")
def last_wins(b: Bridge):
    return t.last_wins(b.table("events").select("user_id", "event_id", "event_type", "value"), "user_id", "event_id").select("user_id", "event_id", "event_type", "value")


@query("select event_id, component from b_error order by ts desc, event_id desc limit 100")
def recent_completed(b: Bridge):
    return b.error.orderBy(F.desc("ts"), F.desc("event_id")).limit(100).select("event_id", "component")


@query("select event_id, category from b_error where not success order by ts desc, event_id desc limit 10")
def recent_errors(b: Bridge):
    return b.error.where("not success").orderBy(F.desc("ts"), F.desc("event_id")).limit(10).select("event_id", "category")


@query("select event_id, user_id from (select event_id, user_id, row_number() over (partition by user_id order by ts desc, event_id desc) as rn from events) where rn <= 100")
def retain_newest(b: Bridge):
    return t.retain_newest(b.table("events").select("event_id", "user_id", "ts"), "user_id", [F.desc("ts"), F.desc("event_id")], 100).select("event_id", "user_id")


@query("select event_id, user_id from (select event_id, user_id, count(*) over (partition by user_id) as n, row_number() over (partition by user_id order by event_id desc) as rn from events) where rn <= case when n <= 40 then n else 20 + (n - 41) % 21 end")
def retain_samples(b: Bridge):
    return t.retain_samples(b.table("events").select("event_id", "user_id"), "user_id", "event_id", 40, 20)


@query("with r as (select component, event_id, success, sum(cast(success as int)) over (partition by component order by ts, event_id) as run from b_error) select component, min(event_id) as first_event, count(*) as length, count(*) >= 3 as opens from r where not success group by component, run")
def failure_runs(b: Bridge):
    return t.failure_runs(b.error, "component", 3)


RATE = "with e as (select event_id, event_type, epoch_us(ts) as us from events), w as (select event_id, us, count(*) over r as calls, min(us) over r as oldest from e window r as (partition by event_type order by us range between 3599999999 preceding and current row))\n"


def rates(b: Bridge):
    rows = b.table("events").select("event_id", "event_type", F.unix_micros("ts").alias("us"))
    return t.trailing_rate(rows, "event_type", "us", 3600, 3)


@query(RATE + "select event_id, calls, calls - 1 >= 3 as limited from w")
def trailing_rate(b: Bridge):
    return rates(b).select("event_id", "calls", "limited")


@query(RATE + "select event_id, case when calls - 1 >= 3 then oldest + 3600000000 - us else 0 end as wait_us from w")
def time_to_free(b: Bridge):
    return rates(b).select("event_id", "wait_us")


@query("""with recursive e as (select event_id, event_type, epoch_us(ts) as us, row_number() over (partition by event_type order by ts, event_id) as i from events),
r(event_type, i, event_id, admitted, held) as (select event_type, i, event_id, true, [us] from e where i = 1
union all select event_type, i, event_id, len(h) < 3, case when len(h) < 3 then list_append(h, us) else h end from (select e.event_type, e.i, e.event_id, e.us, list_filter(r.held, lambda x: x > e.us - 3600000000) as h from r join e on e.event_type = r.event_type and e.i = r.i + 1))
select event_id, admitted from r""")
def admitted_calls(b: Bridge):
    """What a limiter of three calls an hour lets through of each event type."""
    rows = b.table("events").select("event_id", "event_type", F.unix_micros("ts").alias("us"))
    return t.admitted(rows, "event_type", "us", "event_id", 3600, 3).select("event_id", "admitted")


@query("select event_id, cast(floor((row_number() over (order by ts, event_id) - 1) / 1000) as bigint) as batch from events")
def batch_assign(b: Bridge):
    return t.batches(b.table("events").select("event_id", "ts"), ["ts", "event_id"], 1000).select("event_id", "batch")


@query("select r_name as framework, cast(c_custkey as varchar) as technique_id from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey")
def union_frameworks(b: Bridge):
    nation = b.table("nation").join(b.table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    cust = b.table("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    return cust.select(F.col("r_name").alias("framework"), F.col("c_custkey").cast("string").alias("technique_id"))
