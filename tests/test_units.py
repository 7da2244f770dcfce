"""Small hand-written inputs with known results."""

import json
import random

import pytest
from pyspark.sql import functions as F

from wardgraph.functions import ids, status
from wardgraph.operators import chain, graph, layers, rules, telemetry
from wardgraph.plans import registry
from wardgraph.sources import scans, sinks
from wardgraph.streaming import streams


def lines(spark, *values):
    return spark.createDataFrame([(v, i) for i, v in enumerate(values)], "value string, seq int")


def test_vuln_pages(spark, tmp_path):
    rec = lambda i, *texts: {"cve": {"id": i, "published": "2020-01-02T03:04:05", "descriptions": [{"lang": x, "value": v} for x, v in texts]}}
    (tmp_path / "a.json").write_text(json.dumps({"vulnerabilities": [rec("CVE-2020-0001", ("en", "CWE-79 and CWE-22, CWE-79"), ("es", "CWE-1")), rec("", ("en", "CWE-5"))]}, indent=1))
    (tmp_path / "b.json").write_text(json.dumps({"vulnerabilities": []}))
    rows = scans.vuln_pages(spark, str(tmp_path)).where("coalesce(id, '') <> ''").select("id", ids.weakness_ids(F.col("descriptions")).alias("w")).collect()
    assert [(r.id, r.w) for r in rows] == [("CVE-2020-0001", ["22", "79"])]


def test_jsonl_last_wins_and_rejects(spark):
    rows = lines(spark, '{"CVE-1-1":{"CWE":["1"]},"CVE-1-2":{"CWE":[]}}', "", '{"CVE-1-1":{"CWE":["2"],"OWASP":["A"]}}', "{bad")
    split = {r.status: r.n for r in scans.jsonl_split(rows).groupBy("status").agg(F.count("*").alias("n")).collect()}
    assert split == {"good": 2, "bad": 1}
    found = {r.cve_id: (r.cwe, r.owasp) for r in scans.jsonl_map(rows, mode="PERMISSIVE").collect()}
    assert found == {"CVE-1-1": (["2"], ["A"]), "CVE-1-2": ([], [])}
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        scans.jsonl_map(rows).collect()


def test_attack_pattern_csv(spark, tmp_path):
    (tmp_path / "p.csv").write_text("'ID,Name,Taxonomy Mappings\n1,\"a \"\"q\"\" b\",::TAXONOMY NAME:ATTACK:ENTRY ID:1574.010:ENTRY NAME:x::TAXONOMY NAME:ATTACK:ENTRY ID:10x:ENTRY NAME:y::\n,none,x\n2,old,\n2,new,\n".replace('""', '""'))
    rows = {r.capec_id: r for r in scans.attack_pattern_csv(spark, str(tmp_path / "p.csv")).withColumn("t", ids.taxonomy_ids(F.col("taxonomy"))).collect()}
    assert sorted(rows) == ["1", "2"] and rows["1"].t == ["1574.010"] and rows["2"].name == "new" and rows["2"].t == []


def test_weakness_xml(spark, tmp_path):
    (tmp_path / "w.xml").write_text(
        '<Weakness_Catalog xmlns="http://cwe.mitre.org/cwe-7"><Weaknesses><Weakness ID="79" Name="n"><Description>d</Description><ChildOf><Weakness CWE_ID="74"/></ChildOf>'
        '<Related_Attack_Patterns><Related_Attack_Pattern CAPEC_ID="63"/></Related_Attack_Patterns></Weakness><Weakness ID="1" Name="m"/></Weaknesses></Weakness_Catalog>'
    )
    rows = {r.cwe_id: r for r in scans.weakness_xml(spark, str(tmp_path / "w.xml")).where("name is not null").collect()}
    assert rows["79"].child_of == ["74"] and rows["79"].related_attack_patterns == ["63"] and rows["1"].child_of == []


def test_object_table_and_categories(spark, tmp_path):
    (tmp_path / "o.json").write_text('{"1":{"name":"a"},"2":{"name":"b"}}')
    assert {(r.id, r.name) for r in scans.object_table(spark, str(tmp_path / "o.json"), "struct<name:string>").collect()} == {("1", "a"), ("2", "b")}
    (tmp_path / "c.json").write_text('{"categories":{"A01":{"name":"n","description":"d","cwe_ids":["285","639","639"]}}}')
    _, mapping = scans.category_map(spark, str(tmp_path / "c.json"))
    assert sorted(r.cwe_id for r in mapping.collect()) == ["285", "639", "639"]


def test_countermeasure_tree(spark, tmp_path):
    tree = [{"rdfs:label": "Harden", "children": [{"name": "g", "d3f:d3fend-id": "D3-G", "children": [{"rdfs:label": "leaf", "d3f:d3fend-id": "D3-L"}, {"rdfs:label": "noid"}]}]}]
    (tmp_path / "t.json").write_text(json.dumps(tree))
    rows = {(r.parent, r.node, r.is_leaf, r.d3f_id) for r in scans.countermeasure_tree(spark, str(tmp_path / "t.json"), depth=4).collect()}
    assert rows == {("Harden", "g", False, None), ("g", "leaf", True, "D3-L")}


def test_layer_json_versions(spark, tmp_path):
    old = {"name": "o", "version": "3.0", "domain": "mitre-mobile", "viewMode": 1, "sorting": "x", "techniques": [{"techniqueID": "T1", "score": "bad", "enabled": "no"}]}
    (tmp_path / "l.json").write_text(json.dumps([old, {"name": "n", "versions": {"layer": "4.5"}, "domain": "ics-attack", "techniques": [{"techniqueID": "T2", "score": 0}]}]))
    rows = {r.name: r for r in scans.layer_json(spark, str(tmp_path / "l.json")).collect()}
    assert rows["o"].domain == "mobile-attack" and rows["o"].sorting == 0 and rows["o"].layout == "side" and rows["n"].layer_version == "4.5"
    assert rows["n"].techniques[0].score == 0.0 and rows["o"].techniques[0].enabled


def test_ancestors_end_on_cycles(spark):
    pairs = spark.createDataFrame([("1", "2"), ("2", "3"), ("3", "1"), ("9", "1")], "cwe_id string, parent_id string")
    got = {(r.cwe_id, r.ancestor_id): r.depth for r in chain.ancestors(pairs).collect()}
    assert got["9", "3"] == 3 and got["1", "1"] == 3 and len(got) == 12


def test_edge_weights_are_path_counts(spark):
    rnd = random.Random(5)
    pick = lambda n, a, b: sorted({(f"{a}{rnd.randrange(4)}", f"{b}{rnd.randrange(4)}") for _ in range(n)})
    facts, cc, ct, td = pick(9, "v", "w"), pick(9, "w", "c"), pick(9, "c", "1"), pick(9, "T1", "d")
    make = lambda rows, a, b: spark.createDataFrame(rows, f"{a} string, {b} string")
    got = {(r.source, r.target): r.value for r in graph.edges(make(facts, "cve_id", "cwe_id"), make(cc, "cwe_id", "capec_id"), make(ct, "capec_id", "technique_id"), make(td, "technique_id", "d3f_id"), make([("v0", "A")], "cve_id", "category_id")).collect()}
    want = {}
    add = lambda s, t: want.__setitem__((s, t), want.get((s, t), 0) + 1)
    for v, w in facts:
        add(v, f"CWE-{w}")
        for w2, c in cc:
            if w2 == w:
                add(f"CWE-{w}", f"CAPEC-{c}")
                for c2, t in ct:
                    if c2 == c:
                        add(f"CAPEC-{c}", f"T{t}")
                        for t2, d in td:
                            if t2 == f"T{t}":
                                add(t2, f"D3F-{d}")
    add("v0", "OWASP-A")
    assert got == want


def test_retain_samples_is_the_simulated_list(spark):
    for n in (5, 10, 11, 16, 17, 40):
        kept = []
        for i in range(n):
            kept.append(i)
            if len(kept) > 10:
                kept = kept[-5:]
        rows = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("seq"))
        assert sorted(r.seq for r in telemetry.retain_samples(rows, "k", "seq", 10, 5).collect()) == kept


def test_quantile_index(spark):
    rows = spark.createDataFrame([("a", float(i)) for i in range(1, 11)] + [("b", 3.0)], "label_key string, value double")
    got = {r.label_key: (r.q5, r.q99) for r in telemetry.quantiles(rows).collect()}
    assert got == {"a": (5.0, 9.0), "b": (3.0, 3.0)}


def test_empty_inputs(spark):
    none = spark.createDataFrame([], "ts timestamp, event_id long, category string, severity string, duration double, success boolean")
    assert telemetry.request_stats(none).first().asDict() == {"active": 0, "completed": 0, "total": 0, "success_rate": 0.0, "avg_duration": 0.0}
    assert telemetry.alerts(none).count() == 0


def test_score_expression(spark):
    row = spark.createDataFrame([(1.0, 2.0, None)], "a double, b double, c double")
    value = lambda t: row.select(layers.score_expression(t, {"a", "b", "c"}).alias("x")).first().x
    assert [value(t) for t in ("a + b * 2", "(a + b) / 2", "a > b", "not (a > b) and b == 2", "a > b ? 25 : 10", "100 - a", "a + c", "a / 0")] == [5.0, 1.5, 0.0, 1.0, 10.0, 99.0, None, None]
    for bad in ("a; drop table x", "sum(a)", "a +", "(a", "a b", "d"):
        with pytest.raises(ValueError):
            layers.score_expression(bad, {"a", "b", "c"})


def test_rules_stop_at_the_first_bad_stage(spark):
    rows = spark.createDataFrame([(None, 5), ("x", -1)], "name string, n int")
    checked = rules.check_rows(rows, [rules.Rule("name", "required"), rules.Rule("n", "range", (0, None), stage=1), rules.Rule("n", "enum", (1, 2), warning=True)])
    assert [(r.errors, r.warnings) for r in checked.collect()] == [(["name: required"], ["n: enum"]), (["n: range"], ["n: enum"])]


def test_validate_records(spark):
    rows = spark.createDataFrame([("CVE-1", '{"CWE":[],"CAPEC":[],"TECHNIQUES":[]}'), ("X", '{"CWE":"a","CAPEC":[]}'), ("CVE-2", "[]"), (None, "{")], "cve_id string, body string")
    got = [(r.errors, r.warnings) for r in rules.validate_records(rows).collect()]
    assert got[0] == ([], []) and got[1] == (["id", "CWE"], ["TECHNIQUES"]) and got[2][0] == ["body"] and got[3][0] == ["id", "body"]


def test_typed_exceptions(spark):
    rows = spark.createDataFrame([("APIError",), ("ConfigurationError",), ("KeyError",)], "t string")
    got = [(r.c, r.s) for r in rows.select(status.typed_category(F.col("t")).alias("c"), status.typed_severity(F.col("t")).alias("s")).collect()]
    assert got == [("api_error", "high"), ("configuration", "critical"), ("unknown", "low")]


def test_metrics_text(spark):
    c = spark.createDataFrame([("n", "h", "counter", 'a="b"', 2)], "name string, help string, kind string, labels string, value long")
    h = spark.createDataFrame([("l", "h", "", "+Inf", 3, 3, 4.5)], "name string, help string, labels string, le string, cumulative long, n long, total double")
    s = spark.createDataFrame([("s", "h", 'a="b"', "0.5", 1.5, 2, 3.0)], "name string, help string, labels string, quantile string, value double, n long, total double")
    got = [r.line for r in sinks.prometheus_lines(c, h, s).orderBy("name", "line_no").collect()]
    assert got == ["# HELP l h", "# TYPE l histogram", 'l_bucket{le="+Inf"} 3', "l_sum 4.5", "l_count 3", "# HELP n h", "# TYPE n counter", 'n{a="b"} 2', "# HELP s h", "# TYPE s summary", 's{a="b",quantile="0.5"} 1.5', 's_sum{a="b"} 3.0', 's_count{a="b"} 2']


def test_ingest_goes_on_after_a_stop(spark, tmp_path):
    page = lambda n, i: (tmp_path / "in" / f"{n}.json").write_text(json.dumps({"vulnerabilities": [{"cve": {"id": i, "descriptions": [], "published": "2020-01-01T00:00:00"}}]}))
    (tmp_path / "in").mkdir()
    table, check = str(tmp_path / "table"), str(tmp_path / "check")

    def run():
        s = scans.vuln_pages_stream(spark, str(tmp_path / "in")).select(F.col("id").alias("cve_id"), F.year("published").alias("year"), "published")
        streams.ingest(s, check, table)
        return sorted(r.cve_id for r in spark.read.parquet(table).collect())

    page(1, "CVE-2020-0001"), page(2, "CVE-2020-0002")
    assert run() == ["CVE-2020-0001", "CVE-2020-0002"]
    page(3, "CVE-2020-0003")
    assert run() == ["CVE-2020-0001", "CVE-2020-0002", "CVE-2020-0003"]


def test_failed_batches_are_skipped(spark):
    from wardgraph.operators.extension import map_batches

    def f(pdf):
        if (pdf.id == 7).any():
            raise ValueError("no")
        return pdf

    assert map_batches(spark.range(10, numPartitions=1), f, "id long", size=5).count() == 5


def test_heat_scale_ends_at_the_tables_maximum(spark, tmp_path):
    for n, values in enumerate(([5.0, 400.0, 800.0, None], [0.25, 0.5])):
        spark.createDataFrame(list(enumerate(values)), "event_id long, value double").write.parquet(f"{tmp_path}/{n}/events.parquet")
        most = max([v for v in values if v is not None] + [1.0])
        for r in registry.QUERIES["heat_bucket"](spark, f"{tmp_path}/{n}").collect():
            v = values[r.event_id]
            assert r.percent == (None if v is None else int(100 * v / most + 0.5))
            assert v != 800.0 or r.hue == 20.0
            assert v != 400.0 or r.hue == 40.0


def test_numbered_is_row_number(spark):
    rows = spark.createDataFrame([("a" if i % 3 else None, i % 7, i) for i in range(500)], "k string, v int, i long")
    got = telemetry.numbered(rows.repartition(6), ["k"], ["v", "i"], "n").collect()
    want = {}
    for k in ("a", None):
        for n, r in enumerate(sorted((r for r in got if r.k == k), key=lambda r: (r.v, r.i)), 1):
            want[r.i] = n
    assert len(got) == 500 and all(r.n == want[r.i] for r in got)
    assert telemetry.numbered(rows.limit(0), ["k"], ["v", "i"], "n").count() == 0


def test_trailing_rate_over_stretches(spark):
    rnd = random.Random(4)
    times = [rnd.randrange(-20_000_000, 60_000_000) for _ in range(300)] + [0, 10_000_000, 10_000_000, None]
    rows = spark.createDataFrame([("k", t, i) for i, t in enumerate(times)], "k string, us long, i long")
    for r in telemetry.trailing_rate(rows, "k", "us", 10, 5).collect():
        inside = [t for t in times if t is not None and r.us is not None and r.us - 10_000_000 < t <= r.us] or [None]
        assert r.calls == len(inside) and r.limited == (r.calls > 5), r
        assert r.wait_us == (min(inside) + 10_000_000 - r.us if r.limited else 0)


def test_missing_years_are_told(spark, tmp_path, caplog):
    spark.createDataFrame([("CVE-2001-0001", 2001), ("CVE-2002-0001", 2002)], "cve_id string, year int").write.partitionBy("year").parquet(f"{tmp_path}/t")
    wanted = spark.createDataFrame([("CVE-2002-0009",), ("CVE-2007-0001",), ("junk",)], "cve_id string")
    with caplog.at_level("WARNING"):
        rows, missing = scans.year_partition(spark, f"{tmp_path}/t", wanted)
    assert [r.cve_id for r in rows.collect()] == ["CVE-2002-0001"] and [r.year for r in missing.collect()] == [2007] and "2007" in caplog.text


def test_trees_of_any_depth(spark, tmp_path):
    node = {"name": "leaf", "d3f:d3fend-id": "D3-X"}
    for i in range(15):
        node = {"name": f"n{i}", "children": [node]}
    (tmp_path / "t.json").write_text(json.dumps([node]))
    rows = scans.countermeasure_tree(spark, str(tmp_path)).collect()
    assert len(rows) == 15 and [r.d3f_id for r in rows if r.is_leaf] == ["D3-X"]


def test_layer_document(spark):
    cells = spark.createDataFrame([("T2", "b", 1), ("T1", "a", 5)], "technique_id string, tactic string, score int")
    doc = json.loads(layers.layer_json(cells, "enterprise-defend", 5).first().layer)
    assert [t["techniqueID"] for t in doc["techniques"]] == ["T1", "T2"] and doc["layout"]["aggregateFunction"] == "average" and doc["layout"]["showName"] is True
    assert doc["legendItems"] == doc["metadata"] == doc["links"] == [] and doc["selectTechniquesAcrossTactics"] is True and doc["domain"] == "enterprise-attack"


def test_layers_of_one_domain_alone_are_combined(spark):
    cells = spark.createDataFrame([("T1", "a", 5, "x")], "technique_id string, tactic string, score int, comment string")
    with pytest.raises(ValueError, match="domains"):
        layers.combine({"a": cells, "b": cells}, "a + b", of={"a": ("ics", "17"), "b": ("enterprise", "17")})
    replaced = spark.createDataFrame([("T1", "T9"), ("T1", "T8")], "from_id string, to_id string")
    new = spark.createDataFrame([("T9", "a"), ("T8", "b"), ("T1", "a")], "technique_id string, tactic string")
    assert sorted(map(tuple, layers.upgrade_copies(cells, new, ["score", "comment"], replaced).collect())) == [("T1", "a", 5, "x"), ("T9", "a", 5, "x")]


def test_stream_alerts_are_in_order_of_time(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"2024-01-01 00:{59 - i:02d}:00", "c", "high") for i in range(40)], "event_id long, ts string, category string, severity string").withColumn("ts", F.col("ts").cast("timestamp"))
    rows.repartition(5).write.parquet(f"{tmp_path}/in")
    stream = streams.alert_stream(streams.events_stream(spark, f"{tmp_path}/in", rows.schema))
    streams.run_to_end(stream, f"{tmp_path}/cp", path=f"{tmp_path}/out")
    got = sorted((r.nth, r.event_id) for r in spark.read.parquet(f"{tmp_path}/out").collect())
    assert got == [(n, 40 - n) for n in range(5, 41, 5)]


def test_a_shared_folder_is_asked_for_on_a_cluster(monkeypatch):
    from types import SimpleNamespace

    from wardgraph.sources import tables

    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://somewhere:7077")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        tables.shared_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda *_: None), sparkContext=context))


def test_scratch_tables_go_at_its_end(spark):
    from wardgraph.sources.tables import scratch, written

    with scratch(spark):
        with scratch(spark):
            gone, inner = written(spark.range(3), "gone"), written(spark.range(4), "inner", keep=True)
            assert gone.count() == 3
        assert inner.count() == 4
        kept = written(spark.range(5), "kept", keep=True)
    assert kept.count() == 5
    for df in (gone, inner):
        with pytest.raises(Exception, match="(?i)not.?exist|FILE_NOT"):
            df.collect()
