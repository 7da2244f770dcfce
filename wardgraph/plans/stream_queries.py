"""Stream operators over the events, run to their end, and their batch twins in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from wardgraph.functions import ids
from wardgraph.operators import extension, telemetry
from wardgraph.plans.bridge import Bridge
from wardgraph.plans.chain_queries import joined_lists, knowledge
from wardgraph.plans.registry import query
from wardgraph.plans.source_queries import LISTS_SQL, land_pages, land_records, numbered_orders
from wardgraph.plans.telemetry_queries import ALERTS
from wardgraph.sources import paged, scans
from wardgraph.sources.tables import new_path, written
from wardgraph.streaming import streams


def replayed(b: Bridge, rows, build, name: str, parts: int = 4):
    """Rows land as ranges of time, one after another, each as files that many tasks write, rows without a time first. After
    each the stream that `build` makes of the folder goes on from its checkpoint, in one micro-batch. At last a row lands
    that is two days later and null but for its time, so that the watermark passes all others. Returns what the sink has."""
    spark = b.spark
    path, checkpoint, out = (new_path(spark, f"{name}-{x}") for x in ("landed", "checkpoint", "sink"))
    us = F.unix_micros("ts")
    cuts = rows.select(us.alias("us")).approxQuantile("us", [i / parts for i in range(1, parts)], 0.001)
    last = rows.agg((F.max("ts") + F.expr("interval 2 days")).alias("ts"))
    beat = last.select(*(F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema.fields)).where("ts is not null")
    for low, high in [*zip([None, *cuts], [*cuts, None], strict=True), (None, None)]:
        after = (us >= low) if low is not None else F.lit(True)
        before = ((us < high) if high is not None else F.lit(True)) | (us.isNull() if low is None else F.lit(False))
        some = beat if low is high is None and cuts else rows.where(F.coalesce(after, F.lit(False)) & F.coalesce(before, F.lit(True)))
        some.repartitionByRange("ts").write.mode("append").parquet(path)
        stream = build(streams.events_stream(spark, path, rows.schema))
        streams.run_to_end(stream, checkpoint, path=out)
    return spark.read.schema(stream.schema).parquet(out)


@query("select cve_id, yr as year from b_vuln")
def ingest_incremental(b: Bridge):
    """Landed pages into the year-partitioned table, several micro-batches."""
    pages, table = new_path(b.spark, "pages"), new_path(b.spark, "vulns")
    land_pages(b, pages)
    stream = scans.vuln_pages_stream(b.spark, pages, files=8, lines=True).select(F.col("id").alias("cve_id"), ids.year_of_id(F.col("id")).alias("year"), "published")
    streams.ingest(stream, new_path(b.spark, "ingest-checkpoint"), table)
    return b.spark.read.parquet(table).select("cve_id", "year")


@query("select o_orderkey, o_orderkey % 5 = 0 or o_orderdate < timestamp '1999-12-31 12:00:00' as due from orders")
def freshness_gate(b: Bridge):
    stamps = b.table("orders").select("o_orderkey", F.when(F.col("o_orderkey") % 5 == 0, "never").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")).alias("stamp"))
    return streams.freshness_gate(stamps, "2000-01-01 12:00:00").select("o_orderkey", "due")


@query("select start, event_type, n, total from (select time_bucket(interval '5 minutes', cast(ts as timestamp)) as start, event_type, count(*) as n, cast(sum(cast(value as decimal(24,4))) as double) as total from events group by 1, 2)")
def windowed_counters(b: Bridge):
    """Windows of a stream, which come out once the watermark passes them."""
    return replayed(b, b.table("events"), lambda e: streams.windowed(e, ["event_type"]), "windows")


@query("""with e as (select event_type, value, time_bucket(interval '30 minutes', cast(ts as timestamp)) as s from events), w as (select event_type, value, s as start from e union all select event_type, value, s - interval '30 minutes' from e)
select start, event_type, count(*) as n, cast(sum(cast(value as decimal(24,4))) as double) as total from w group by 1, 2""")
def sliding_counters(b: Bridge):
    """Windows of an hour that begin each half hour."""
    return replayed(b, b.table("events"), lambda e: streams.windowed(e, ["event_type"], "1 hour", "30 minutes"), "sliding")


@query("""with g as (select user_id, ts, case when ts - lag(ts) over w < interval '30 minutes' then 0 else 1 end as new from (select user_id, cast(ts as timestamp) as ts from events) window w as (partition by user_id order by ts)),
s as (select user_id, ts, sum(new) over (partition by user_id order by ts) as s from g) select user_id, min(ts) as start, max(ts) + interval '30 minutes' as "end", count(*) as n from s group by user_id, s""")
def session_counters(b: Bridge):
    """Sessions of a stream, which come out once the watermark passes their end."""
    return replayed(b, b.table("events"), lambda e: streams.sessions(e, "user_id"), "sessions")


def delayed(b: Bridge, minutes: int, land):
    """The events, in four landings by the time of their arrival: up to so many minutes after their own, in any order among
    each other. After each, `land` goes on with the folder's stream; then a row two days later, null but for its time, lands."""
    spark, path, rows = b.spark, new_path(b.spark, "delayed"), b.table("events")
    delay = F.pmod(F.xxhash64("event_id"), F.lit(60 * minutes)) if minutes else F.lit(0)
    rows = written(rows.withColumn("arrival", F.unix_seconds("ts") + delay), "arrivals")
    cuts = rows.approxQuantile("arrival", [0.25, 0.5, 0.75], 0.001)
    for low, high in zip([None, *cuts], [*cuts, None], strict=True):
        at = F.col("arrival")
        some = rows.where((at.isNull() if low is None else F.lit(False)) | F.coalesce((at >= low if low is not None else F.lit(True)) & (at < high if high is not None else F.lit(True)), F.lit(False)))
        some.drop("arrival").repartition(5).write.mode("append").parquet(path)
        land(streams.events_stream(spark, path, b.table("events").schema))
    last = rows.agg((F.max("ts") + F.expr("interval 2 days")).alias("ts")).where("ts is not null")
    last.select(*(F.col("ts") if f.name == "ts" else F.lit(None).cast(f.dataType).alias(f.name) for f in b.table("events").schema.fields)).write.mode("append").parquet(path)
    land(streams.events_stream(spark, path, b.table("events").schema))


@query(ALERTS)
def stateful_alerts(b: Bridge):
    """Rows that arrive up to nine minutes late and in no order, in several micro-batches: numbered in order of time all the same."""
    spark, v = b.spark, F.col("value")
    severity = F.when(v >= 200, "critical").when(v >= 100, "high").when(v >= 30, "medium").otherwise("low")
    checkpoint, out = new_path(spark, "alerts-checkpoint"), new_path(spark, "alerts-sink")

    def land(e):
        # the last row is of a key of its own, and dropped below
        errors = e.select(F.coalesce("event_id", F.lit(-1)).alias("event_id"), "ts", F.col("event_type").alias("category"), severity.alias("severity"))
        streams.run_to_end(streams.ordered_alerts(errors, 4 * 3600), checkpoint, path=out, rocksdb=True)

    delayed(b, 9, land)
    return spark.read.schema("event_id long, category string, severity string, nth long").parquet(out).where("event_id >= 0")


@query(f"""with s as (select time_bucket(interval '1 hour', cast(ts as timestamp)) as start, event_type, value from events),
k(le, b) as (values {', '.join(f"('{x}', {x})" for x in (10.0, 50.0, 100.0, 200.0))}, ('+Inf', 1e308))
select start, event_type, n, total, le, count(*) filter (value <= b) as cumulative from s join (select start, event_type, count(*) as n, cast(sum(cast(value as decimal(24,4))) as double) as total from s group by 1, 2) g using (start, event_type) cross join k group by all""")
def windowed_histogram(b: Bridge):
    """Histograms by hour of a stream."""
    buckets = (10.0, 50.0, 100.0, 200.0, float("inf"))
    return replayed(b, b.table("events"), lambda e: streams.windowed_histogram(e, ["event_type"], buckets, "1 hour"), "histograms")


@query("select event_id from events")
def late_rows_kept(b: Bridge):
    """Rows that arrive up to a day late: windows of those on time and a table of those that are not hold every event once."""
    spark = b.spark
    checkpoint, on_time, late, windows, sink = (new_path(spark, f"late-{x}") for x in ("checkpoint", "rows", "kept", "windows", "sink"))
    delayed(b, 24 * 60, lambda e: streams.split_late(e, checkpoint, on_time, late))
    rows = spark.readStream.schema(b.table("events").schema).parquet(f"{on_time}/*").withColumn("ts", F.col("ts").cast("timestamp"))
    counted = rows.withWatermark("ts", streams.LATE).groupBy(F.window("ts", "1 hour").alias("w")).agg(F.collect_list("event_id").alias("ids")).select(F.explode("ids").alias("event_id"))
    streams.run_to_end(counted, windows, path=sink)
    own, kept = spark.read.schema("event_id long").parquet(sink), spark.read.schema(b.table("events").schema).parquet(f"{late}/*").select("event_id")
    return own.union(kept).where("event_id is not null")


@query("select cast(row_number() over (order by o_orderdate, o_orderkey) - 1 as bigint) as index, o_orderkey, o_totalprice from orders")
def ingest_paged(b: Bridge):
    """Landed pages of the paged source as a stream that is stopped after a part of them, which ends within a page."""
    spark, path, out, checkpoint = b.spark, new_path(b.spark, "api"), new_path(b.spark, "paged-sink"), new_path(b.spark, "paged-checkpoint")
    rows, name = numbered_orders(b), f"pages_{uuid.uuid4().hex}"
    spark.dataSource.register(paged.paged_source(name, paged.LandedPages(path)))
    n = rows.count() * 3 // 5
    for some in (rows.where(F.col("index") < n), rows.where(F.col("index") >= n)):
        land_records(some, path, 700)
        streams.run_to_end(spark.readStream.format(name).option("page_size", 450).load(), checkpoint, path=out)
    found = spark.read.schema(paged.SCHEMA).parquet(out)
    return found.select("index", F.from_json("record", "o_orderkey long, o_totalprice double").alias("r")).select("index", "r.*")


@query("select event_id, user_id, event_type from events")
def dedupe_stream(b: Bridge):
    """Every third event is delivered twice."""
    rows = b.table("events")
    twice = rows.union(rows.where("event_id % 3 = 0"))
    return replayed(b, twice, lambda e: streams.dedupe(e.where("event_id is not null"), ["event_id"]).select("event_id", "user_id", "event_type"), "deduped")


@query(LISTS_SQL)
def stream_enrich(b: Bridge):
    """Arriving (vulnerability, weaknesses) records against the knowledge tables, in each micro-batch."""
    path, out = new_path(b.spark, "records"), new_path(b.spark, "enriched")
    facts = b.vuln.select("cve_id").join(b.vuln_cwe.groupBy("cve_id").agg(F.collect_list("cwe_id").alias("cwes")), "cve_id", "left")
    facts.repartition(3, "cve_id").write.parquet(path)
    known = knowledge(b)

    def each(batch, n: int) -> None:
        own = batch.select("cve_id", F.explode("cwes").alias("cwe_id"))
        # a repeated batch replaces its own folder
        joined_lists(known.of(own, batch)).write.mode("overwrite").parquet(f"{out}/batch={n}")

    stream = b.spark.readStream.schema(facts.schema).option("maxFilesPerTrigger", 2).parquet(path)
    streams.run_to_end(stream, new_path(b.spark, "enrich-checkpoint"), each=each)
    return b.spark.read.parquet(out).drop("batch")


@query("select cast(event_id as varchar) as request_id from events where event_type = 'error'")
def active_requests(b: Bridge):
    """Each event starts a request, and all but errors end it: starts without an end, of two streams."""

    def build(e):
        # the last row is a request of its own: Spark drops null keys before it looks at their times
        rows = e.select(F.coalesce("event_id", F.lit(-1)).cast("string").alias("request_id"), "ts", "event_type")
        ends = rows.where("event_type is null or event_type <> 'error'")
        return streams.open_requests(rows.select("request_id", "ts"), ends.select("request_id", "ts")).select("request_id")

    return replayed(b, b.table("events"), build, "requests")


@query("select cast(event_id as varchar) as request_id from events where event_id % 5 >= 3")
def requests_ended_late(b: Bridge):
    """Each event starts a request. A fifth each ends at once, ten minutes later, just before the bound of an hour, just after it, and
    never; ends land in order of time, so most come with a later batch than their start. The last two fifths are open."""
    delay = F.element_at(F.array(*(F.expr(f"interval {m} minutes") for m in (0, 10, 59, 61))), (F.col("event_id") % 5 + 1).cast("int"))
    started = b.table("events").select("event_id", "ts", F.lit(False).alias("is_end"))
    both = started.union(started.where("event_id % 5 < 4").select("event_id", F.col("ts") + delay, F.lit(True)))

    def build(e):
        # the row that closes the streams is in both, a request of its own
        rows = e.select(F.coalesce("event_id", F.lit(-1)).cast("string").alias("request_id"), "ts", "is_end")
        starts, ends = (rows.where(F.col("is_end").isNull() | (F.col("is_end") == end)).select("request_id", "ts") for end in (False, True))
        return streams.open_requests(starts, ends).select("request_id")

    return replayed(b, both, build, "late-ends")


@query("select event_id, value * 2 as doubled from events")
def map_batches(b: Bridge):
    return extension.map_batches(b.table("events").select("event_id", "value"), lambda pdf: pdf.assign(doubled=pdf.value * 2)[["event_id", "doubled"]], "event_id long, doubled double")


@query("select count(*) as rows, count(*) as accounted, true as some_raised, true as some_unfit from events")
def failed_batches(b: Bridge):
    """Batches of which some raise and some return what does not fit the schema: rows that came out and rows that the table of
    failures counts are all rows."""

    def double(pdf):
        if (pdf.event_id % 97 == 0).any():
            raise ValueError("a row that is not wanted")
        return pdf.assign(doubled=["no number"] * len(pdf) if (pdf.event_id % 89 == 0).any() else pdf.value * 2)

    events = b.table("events").select("event_id", "event_type", "value")
    good, failed = extension.try_batches(events, double, "event_id long, doubled double", 50)
    told = failed.agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("lost"), F.bool_or(F.col("error").startswith("ValueError")).alias("some_raised"), F.bool_or(F.col("error").contains("Arrow")).alias("some_unfit"))
    both = good.agg(F.count("*").alias("out")).join(F.broadcast(told)).join(F.broadcast(events.agg(F.count("*").alias("rows"))))  # one row each
    return both.select("rows", (F.col("out") + F.col("lost")).alias("accounted"), "some_raised", "some_unfit")


@query("select user_id, max(event_id) as event_id from events group by user_id")
def dedupe_last(b: Bridge):
    """Repeats of a key with changes: the last wins, as the upsert of a micro-batch sees them."""
    return telemetry.last_wins(b.table("events").select("user_id", "event_id"), "user_id", "event_id")


