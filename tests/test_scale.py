"""Hot keys in ranges, sources by page, stores of versions, streams in order of time, batches that fail."""

import json
import random
import threading
from collections import defaultdict, deque
from http.server import BaseHTTPRequestHandler, HTTPServer
from urllib.parse import parse_qs, urlparse

import pytest
from pyspark.sql import functions as F

from wardgraph.functions import status
from wardgraph.operators import chain, extension, graph, layers, telemetry
from wardgraph.sources import paged
from wardgraph.sources.edge_store import EdgeStore
from wardgraph.sources.store import Conflict, VersionedStore
from wardgraph.sources.tables import written
from wardgraph.streaming import streams


@pytest.fixture(autouse=True)
def many_ranges(spark):
    """Small tables stay in as many partitions as large ones have."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def hot_events(n, seed=1):
    """Half of all rows are of one component; some have no component or no time."""
    r = random.Random(seed)
    rows = [(i, r.choice(["hot", "hot", "hot", "a", "b", None]), None if i % 50 == 0 else f"2024-01-01 {r.randrange(10):02d}:{r.randrange(60):02d}:{r.randrange(60):02d}", r.random() < 0.4) for i in range(n)]
    return rows, "event_id long, component string, ts string, success boolean"


def test_failure_runs_of_a_hot_key_are_those_of_a_plain_walk(spark):
    rows, schema = hot_events(3000)
    df = spark.createDataFrame(rows, schema).withColumn("ts", F.col("ts").cast("timestamp")).repartition(7)
    want = set()
    by = defaultdict(list)
    for i, c, ts, ok in sorted(rows, key=lambda x: (x[2] is not None, x[2] or "", x[0])):
        by[c].append((i, ok))
    for c, events in by.items():
        run = []
        for i, ok in [*events, (None, True)]:
            if ok and run:
                want.add((c, min(run), len(run), len(run) >= 3))
            run = [] if ok else [*run, i]
    got = telemetry.failure_runs(df, "component", 3)
    assert {tuple(r) for r in got.collect()} == want
    dealt = telemetry.ranged(df, ["component"], ["ts", "event_id"], "g", "at").where("component = 'hot'")
    assert dealt.select("g").distinct().count() >= 2  # the hot key is in several ranges
    assert telemetry.failure_runs(df.limit(0), "component", 3).count() == 0


def test_running_sums(spark):
    rows, schema = hot_events(800, 2)
    df = spark.createDataFrame(rows, schema).withColumn("x", F.when(F.col("event_id") % 3 > 0, F.col("event_id") - 400))
    total, want = defaultdict(int), {}
    for i, c, *_ in rows:
        total[c] += (i - 400) if i % 3 > 0 else 0
        want[i] = total[c]
    assert {r.event_id: r.s for r in telemetry.running_sum(df, ["component"], ["event_id"], F.col("x"), "s").collect()} == want


def test_retained_samples_of_a_hot_key(spark):
    rows, schema = hot_events(2500, 3)
    held = defaultdict(list)
    for i, c, *_ in rows:
        held[c].append(i)
        if len(held[c]) > 100:
            held[c] = held[c][-30:]
    got = telemetry.retain_samples(spark.createDataFrame(rows, schema), "component", "event_id", 100, 30).collect()
    assert {r.event_id for r in got} == {i for ids in held.values() for i in ids} and len(got) == sum(map(len, held.values()))


@pytest.mark.parametrize(("n", "span"), [(1500, 40_000), (1500, 3000), (40, 100_000)])
def test_admitted_calls_are_those_of_a_limiter(spark, n, span):
    r = random.Random(n + span)
    rows = [(i, r.choice(["hot", "hot", "a", None]), None if i % 90 == 7 else r.randrange(span) * 1_000_000) for i in range(n)]
    held, want = defaultdict(deque), {}
    for i, c, us in sorted((x for x in rows if x[2] is not None), key=lambda x: (x[2], x[0])):
        calls = held[c]
        while calls and calls[0] <= us - 60_000_000:
            calls.popleft()
        want[i] = len(calls) < 2
        if want[i]:
            calls.append(us)
    want |= {i: None for i, _, us in rows if us is None}
    df = spark.createDataFrame(rows, "id long, key string, us long").repartition(5)
    assert {x.id: x.admitted for x in telemetry.admitted(df, "key", "us", "id", 60, 2).collect()} == want


def test_sketches_merge_and_keep_their_error(spark):
    r = random.Random(4)
    rows = [(k, i % 9, r.lognormvariate(0, 2)) for k in ("a", "b") for i in range(20_000)] + [("c", 0, 5.0), ("c", 1, None), (None, 0, 1.0), ("d", 0, None)]
    df = spark.createDataFrame(rows, "label_key string, part int, value double")
    found = telemetry.sketched_quantiles(telemetry.merged(telemetry.sketches(df, "label_key", "part"), "label_key"))
    found = spark.createDataFrame(found.collect(), found.schema)  # a sketch draws at random
    got = {x.label_key: x for x in found.collect()}
    assert set(got) == {"a", "b", "c", None} and got["a"].n == 20_000 and (got["c"].n, got["c"].q5, got["c"].q99) == (1, 5.0, 5.0)
    for x in telemetry.rank_errors(df, found, "label_key").collect():
        values = sorted(v for k, _, v in rows if k == x.label_key and v is not None)
        v = got[x.label_key][f"q{str(x.q)[2:]}"]
        below, upto = sum(y < v for y in values) / len(values), sum(y <= v for y in values) / len(values)
        assert x.error == pytest.approx(max(below - x.q, x.q - upto, 0)) and x.error <= 2 * telemetry.SKETCH_ERROR


class Api(BaseHTTPRequestHandler):
    records: list = []
    failures: list = []

    def do_GET(self):
        q = {k: int(v[0]) for k, v in parse_qs(urlparse(self.path).query).items()}
        if self.failures and self.failures.pop():
            self.send_error(503)
            return
        some = self.records[q["startIndex"] : q["startIndex"] + q["resultsPerPage"]]
        body = json.dumps({"totalResults": len(self.records), "vulnerabilities": some}).encode()
        self.send_response(200)
        self.end_headers()
        self.wfile.write(body)

    def log_message(self, *args):
        pass


def test_pages_of_an_api_that_fails_at_times(spark, tmp_path):
    server = HTTPServer(("127.0.0.1", 0), Api)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    try:
        Api.records, Api.failures = [{"id": f"é{i}"} for i in range(23)], [True, False, True]
        spark.dataSource.register(paged.paged_source("api_test", paged.HttpPages(f"http://127.0.0.1:{server.server_port}/", delay=0.01)))
        got = spark.read.format("api_test").option("page_size", 5).load()
        assert got.rdd.getNumPartitions() == 5
        assert sorted((r["index"], json.loads(r.record)["id"]) for r in got.collect()) == [(i, f"é{i}") for i in range(23)]
        assert spark.read.format("api_test").option("start_index", 20).load().count() == 3

        def run():
            stream = spark.readStream.format("api_test").option("page_size", 5).load()
            streams.run_to_end(stream, f"{tmp_path}/cp", path=f"{tmp_path}/out")
            return sorted(r["index"] for r in spark.read.parquet(f"{tmp_path}/out").collect())

        assert run() == list(range(23))
        Api.records += [{"id": str(i)} for i in range(30)]
        assert run() == list(range(53)) == run()  # from record 23 on, in the middle of a page
        Api.failures = [True] * 50
        with pytest.raises(Exception, match="503"):
            paged.HttpPages(f"http://127.0.0.1:{server.server_port}/", delay=0.001, retries=2).total()
    finally:
        server.shutdown()


class Unknown:
    def total(self):
        return None

    def page(self, start, size):
        return [str(i) for i in range(start, min(start + size, 12))]


def test_a_short_page_ends_the_scan(spark, tmp_path):
    spark.dataSource.register(paged.paged_source("unknown_total", Unknown()))
    assert spark.read.format("unknown_total").option("page_size", 5).load().count() == 12
    for start, n in ((0, 4), (4, 3), (9, 2)):  # the page at 4 is two short
        (tmp_path / f"start={start}").mkdir()
        (tmp_path / f"start={start}" / "part-0").write_text("".join(f"{start + i}\n" for i in range(n)))
    pages = paged.LandedPages(f"file://{tmp_path}")
    assert pages.page(2, 3) == ["2", "3", "4"] and pages.page(5, 9) == ["5", "6"]
    assert paged.LandedPages(f"file://{tmp_path}/none").total() == 0


def test_an_upsert_rewrites_the_buckets_of_its_keys_alone(spark, tmp_path, monkeypatch):
    store = VersionedStore(spark, f"file://{tmp_path}/s", buckets=8)
    with pytest.raises(FileNotFoundError):
        store.read()
    rows = lambda ids, s: spark.createDataFrame([(f"CVE-{2000 + i % 3}-{i}", 2000 + i % 3, s) for i in ids], "cve_id string, year int, state string")
    all_ = lambda df: {(r.cve_id, r.state) for r in df.collect()}
    assert store.upsert(rows(range(300), "old")) == 1
    before = store.manifest()["folders"]
    assert store.upsert(rows(range(10), "new")) == 2
    after = store.manifest()["folders"]
    assert len(before) == len(after) == 24 and sum(before[k] != after[k] for k in after) <= 10
    want = {(f"CVE-{2000 + i % 3}-{i}", "new" if i < 10 else "old") for i in range(300)}
    assert all_(store.read()) == want and {s for _, s in all_(store.read(1))} == {"old"}
    # a write that dies before its manifest changes nothing
    monkeypatch.setattr(store, "_commit", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    with pytest.raises(RuntimeError, match="killed"):
        store.upsert(rows(range(300), "lost"))
    monkeypatch.undo()
    assert store.version() == 2 and all_(store.read()) == want
    # of two writers of one version the second fails
    reader = store.read()
    with monkeypatch.context() as m:
        m.setattr(VersionedStore, "version", lambda self: 1)
        with pytest.raises(Conflict):
            store.upsert(rows([5], "second"))
    assert all_(store.read()) == all_(reader) == want
    assert store.vacuum() > 0 and all_(store.read()) == want and store.vacuum() == 0


def test_rows_without_year_and_empty_upserts(spark, tmp_path):
    store = VersionedStore(spark, f"file://{tmp_path}/s", buckets=2)
    schema = "cve_id string, year int, n int"
    assert store.upsert(spark.createDataFrame([], schema)) == 1 and store.read().count() == 0
    store.upsert(spark.createDataFrame([("a", None, 1), ("b", 2001, 1)], schema))
    store.upsert(spark.createDataFrame([("a", None, 2)], schema))
    assert sorted(map(tuple, store.read().collect())) == [("a", None, 2), ("b", 2001, 1)]


def test_alerts_come_in_order_of_time_across_micro_batches(spark, tmp_path):
    r = random.Random(5)
    schema = "event_id long, ts string, category string, severity string"
    rows = [(i, f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", r.choice("cd"), r.choice(["high", "critical", "odd"])) for i in range(600)]
    late = sorted(rows, key=lambda x: x[0] + r.randrange(9))  # up to eight minutes late
    closing = [(-1, "2024-01-03 00:00:00", None, None)]
    make = lambda some: spark.createDataFrame(some, schema).withColumn("ts", F.col("ts").cast("timestamp"))

    def step(some):
        make(some).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        stream = streams.ordered_alerts(streams.events_stream(spark, f"{tmp_path}/in", make([]).schema), slice_=900)
        streams.run_to_end(stream, f"{tmp_path}/cp", path=f"{tmp_path}/out", rocksdb=True)  # each run goes on from its checkpoint

    for some in (late[:250], late[250:400], late[400:], closing):
        step(some)
    before = spark.conf.get(streams.STATE_STORE, None)
    assert before is None or "RocksDB" not in before
    got = sorted((x.category, x.severity, x.nth, x.event_id) for x in spark.read.parquet(f"{tmp_path}/out").collect() if x.event_id >= 0)
    want = sorted((x.category, x.severity, x.nth, x.event_id) for x in telemetry.alerts(make(rows)).collect())
    assert got == want and len(want) > 200


def test_late_rows_are_kept_and_a_repeated_micro_batch_changes_nothing(spark, tmp_path):
    schema = "event_id long, ts timestamp"
    make = lambda some: spark.createDataFrame(some, "event_id long, ts string").withColumn("ts", F.col("ts").cast("timestamp"))

    def step(*some):
        make(list(some)).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        streams.split_late(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"{tmp_path}/cp", f"{tmp_path}/on", f"{tmp_path}/late")

    step((1, "2024-01-01 10:00:00"), (2, None))
    step((3, "2024-01-01 09:49:59"), (4, "2024-01-01 09:50:00"), (5, "2024-01-01 08:00:00"))
    step((6, "2024-01-01 09:49:00"), (7, "2024-01-02 00:00:00"))
    ids = lambda name: sorted(r.event_id for r in spark.read.schema(schema).parquet(f"{tmp_path}/{name}/*").collect())
    assert ids("on") == [1, 4, 7] and ids("late") == [2, 3, 5, 6]


def test_a_batch_that_fails_is_told_and_the_function_runs_once(spark, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def f(pdf):
        calls.add(1)
        if (pdf.id == 7).any():
            raise ValueError("seven")
        if (pdf.id == 23).any():
            return pdf.assign(x=["text"] * len(pdf))
        if (pdf.id == 31).any():
            return pdf[["id"]]  # a column is missing
        return pdf.assign(x=pdf.id / 2, more=1)

    good, failed = extension.try_batches(spark.range(50, numPartitions=1), f, "id long, x double", size=10)
    told = {r.batch: (r.rows, r.error) for r in failed.collect()}
    assert {b: (n, e.split(":")[0]) for b, (n, e) in told.items()} == {"0-0": (10, "ValueError"), "0-2": (10, "ArrowInvalid"), "0-3": (10, "KeyError")}
    assert sorted(r.id for r in good.collect()) == [*range(10, 20), *range(40, 50)] and good.columns == ["id", "x"]
    assert calls.value == 5
    none, failed = extension.try_batches(spark.range(0), f, "id long, x double")
    assert none.count() == failed.count() == 0


def test_many_layers_are_one_shuffle(spark):
    cells = spark.createDataFrame([("T1", "a", 1, "x"), ("T2", None, 2, None), ("T2", None, 5, "y")], "technique_id string, tactic string, score int, comment string")
    many = {n: cells.withColumn("score", F.col("score") * (i + 1)) for i, n in enumerate("abcdefgh")}
    out = layers.combine(many, "a + h", inherit={"comment": "b"})
    assert out._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert sorted(map(tuple, out.collect())) == [("T1", "a", 9.0, "x"), ("T2", None, 45.0, "y")]


def test_a_manual_colour_wins(spark):
    rows = spark.createDataFrame([(50.0, None), (50.0, ""), (50.0, "#123456"), (None, "#abcdef"), (None, None)], "score double, colour string")
    got = [r[0] for r in rows.select(status.gradient_colour(F.col("score"), ["#000000", "#ffffff"], 0, 100, F.col("colour"))).collect()]
    assert got == ["#808080", "#808080", "#123456", "#abcdef", None]


def test_deep_hierarchies_take_few_rounds(spark, monkeypatch):
    n, rounds, real = 5000, [], graph.written
    monkeypatch.setattr(graph, "written", lambda df, name, **k: rounds.append(name) or real(df, name, **k))
    tree = spark.range(1, n).select((F.col("id") - 1).alias("parent"), F.col("id").alias("node")).union(spark.createDataFrame([(7, 100_000), (100_000, 100_001), (100_000, 100_002)], "parent long, node long"))
    got = {r.group: (r.total, r.hits) for r in graph.hit_groups(tree, spark.createDataFrame([(100_001, 3), (n - 1, 0), (5, 9)], "node long, score long")).collect()}
    assert got == {i: (1, int(i < 7)) for i in range(n - 1)} | {7: (2, 1), 100_000: (2, 1)}
    assert len([r for r in rounds if r == "marked"]) <= 15


def test_hits_below_cycles_and_second_parents(spark):
    tree = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("c", "leaf"), ("x", "leaf"), ("x", "other"), ("y", "x"), (None, "y")], "parent string, node string")
    got = {r.group: (r.total, r.hits) for r in graph.hit_groups(tree, spark.createDataFrame([("leaf", 1)], "node string, score int")).collect()}
    assert got == {"a": (1, 1), "b": (1, 1), "c": (2, 2), "x": (2, 1), "y": (1, 1), None: (1, 1)}
    assert graph.hit_groups(tree.limit(0), spark.createDataFrame([], "node string, score int")).count() == 0


def test_closure_by_doubling_is_breadth_first(spark):
    r = random.Random(3)
    edges = {(str(r.randrange(40)), str(r.randrange(40))) for _ in range(55)} | {(str(100 + i), str(101 + i)) for i in range(30)}
    want = {}
    for start in {a for a, _ in edges}:
        front, depth = {start}, 0
        while front := {b for a, b in edges if a in front} - {y for x, y in want if x == start}:
            depth += 1
            want |= {(start, b): depth for b in front}
    got = chain.ancestors(spark.createDataFrame(list(edges), "cwe_id string, parent_id string")).collect()
    assert {(x.cwe_id, x.ancestor_id): x.depth for x in got} == want and len(got) == len(want)


def test_a_hub_is_many_rows(spark):
    e = spark.createDataFrame([("hub", f"t{i:04d}") for i in range(1003)] + [("a", "hub"), ("b", "hub")], "source string, target string")
    rows = graph.neighbour_stretches(e, 100).where("node = 'hub'").collect()
    assert {(r.side, r.stretch): len(r.nodes) for r in rows} == {("targets", i): 100 if i < 10 else 3 for i in range(11)} | {("sources", 0): 2}
    assert [x for r in sorted((r for r in rows if r.side == "targets"), key=lambda r: r.stretch) for x in r.nodes] == [f"t{i:04d}" for i in range(1003)]


def test_edge_store_moves_no_edge(spark, tmp_path):
    """A hub of half of all edges is many bounded parts and many buckets; hops deal nodes alone; another session opens the store."""
    rows = spark.range(40_000).select(F.concat(F.lit("CVE-"), F.col("id")).alias("source"), F.when(F.col("id") % 2 == 0, "CWE-hub").otherwise(F.concat(F.lit("CWE-"), F.col("id") % 997)).alias("target"), F.lit(1).alias("value"))
    rows = rows.union(spark.createDataFrame([("CWE-hub", "T1", 5), ("CWE-3", "T1", 2), ("CWE-5", "T2", 1), (None, "T1", 1), ("CWE-9", None, 1)], "source string, target string, value int"))
    store = EdgeStore.write(rows, f"file://{tmp_path}/edges", buckets=6, part_rows=1000)
    parts = store.neighbour_parts().where("node = 'CWE-hub' and side = 'sources'").select(F.size("nodes").alias("n")).collect()
    assert len(parts) == 20 and sum(r.n for r in parts) == 20_000 and max(r.n for r in parts) < 1200
    assert "Exchange" not in plan_of(store.neighbour_parts())
    nodes = written(spark.createDataFrame([("CWE-hub",), ("CWE-hub",), ("T1",), ("absent",), (None,)], "node string"), "nodes")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(store.edges_of(nodes))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    edges_side = plan.split("SortMergeJoin [target", 1)[1].split("FileScan")
    assert "Exchange" not in edges_side[0] and "Bucketed: true" in edges_side[1]
    for side in ("target", "source"):
        got = store.edges_of(nodes, side).collect()
        assert sorted(map(str, got)) == sorted(map(str, rows.where(F.col(side).isin("CWE-hub", "T1")).collect()))
    chosen = spark.createDataFrame([("T1",)], "node string")
    want = sorted(graph.trace_back(rows, chosen, ("CWE-",)).collect(), key=str)
    assert sorted(graph.trace_back(store, chosen, ("CWE-",)).collect(), key=str) == want and len(want) == 3 + 20_000 + rows.where("target = 'CWE-3'").count()
    for side in ("target", "source"):
        spark.sql(f"drop table {store._name(store.path, side)}")
    again = EdgeStore(spark, store.path)
    assert again.edges_of(nodes).count() == 20_003 and again.buckets == 6


def test_edge_store_of_no_edges(spark, tmp_path):
    store = EdgeStore.write(spark.createDataFrame([], "source string, target string, value int"), f"file://{tmp_path}/none", buckets=2)
    assert store.edges_of(spark.createDataFrame([("T1",)], "node string")).count() == 0 and store.neighbour_parts().count() == 0


def test_quantiles_of_a_hot_key_come_from_its_ranges(spark):
    """Three in four rows are of one key, half of these have one value; a key of one row, one of nulls, and none."""
    r = random.Random(4)
    rows = [("hot", r.choice([7.0, r.randrange(1000) / 4])) for _ in range(3000)] + [(None, float(r.randrange(50))) for _ in range(900)] + [("one", 2.5), ("void", None), ("void", None)]
    df = spark.createDataFrame(rows, "label_key string, value double").repartition(5)
    want = set()
    for k in {k for k, _ in rows}:
        own = sorted((v for x, v in rows if x == k), key=lambda v: (v is not None, v))
        n, known = len(own), [v for v in own if v is not None]
        total = sum(known) if known else None
        want.add((k, n, total, None if total is None else total / n, *(own[max(int(q * n - 1), 0)] for q in telemetry.QUANTILES)))
    got = telemetry.quantiles(df)
    assert set(map(tuple, got.collect())) == want and got.columns == ["label_key", "n", "total", "mean", "q5", "q9", "q95", "q99"]
    assert telemetry.quantiles(df.limit(0)).count() == 0
