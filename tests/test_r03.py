"""What the findings of round 3 were about: each of these failed before."""

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from wardgraph.operators import chain, graph, telemetry
from wardgraph.plans import registry
from wardgraph.plans.bridge import Bridge
from wardgraph.sources import edge_store, paged, scans, sinks, tables


def test_heat_of_nothing_is_transparent_in_sql_too(spark, tmp_path):
    spark.createDataFrame([(1, 0.0), (2, 5.0), (3, None), (4, 20.0)], "event_id long, value double").write.parquet(str(tmp_path / "events.parquet"))
    con = duckdb.connect()
    con.execute(f"create view events as select * from '{tmp_path}/events.parquet/*.parquet'")
    for t in ("orders", "lineitem", "part", "supplier", "nation", "region", "customer"):
        con.execute(f"create view {t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    want = sorted(con.execute(registry.ORACLES["heat_bucket"]).fetchall())
    got = sorted((r.event_id, r.hue, r.percent) for r in registry.QUERIES["heat_bucket"](spark, str(tmp_path)).collect())
    assert got == want and want[0][1] is None


def small_chain(spark):
    """The tables of a small chain with odd rows, and what a plain walk finds."""
    r = random.Random(5)
    facts = {(f"v{r.randrange(40)}", str(r.randrange(30))) for _ in range(120)} | {("v1", "none"), ("w", None)}
    parents = {(str(i), str(i // 10)) for i in range(10, 30)} | {("7", "8"), ("none", "3"), ("29", "5")}
    capec = {(str(r.randrange(25)), f"c{r.randrange(20)}") for _ in range(60)}
    tech = {(f"c{r.randrange(18)}", str(1000 + r.randrange(70))) for _ in range(80)}
    defend = {(f"T{1000 + r.randrange(70)}", f"d{r.randrange(80)}") for _ in range(120)}
    cats = {(str(r.randrange(30)), f"A{r.randrange(4)}") for _ in range(40)}
    sets = (facts, parents, capec, tech, defend, cats)
    names = ("cve_id string, cwe_id string", "cwe_id string, parent_id string", "cwe_id string, capec_id string", "capec_id string, technique_id string", "technique_id string, d3f_id string", "cwe_id string, category_id string")
    want = {}
    for v in {v for v, _ in facts} | {"empty"}:
        direct = {w for x, w in facts if x == v and w}
        cwe = direct | {p for w, p in parents if w in direct}
        c = {y for w, y in capec if w in cwe}
        t = {y for x, y in tech if x in c}
        want[v] = tuple(map(sorted, (cwe, c, t, {y for x, y in defend if x[1:] in t}, {y for w, y in cats if w in direct})))
    return [spark.createDataFrame(sorted(s, key=str), n) for s, n in zip(sets, names, strict=True)], want


@pytest.mark.parametrize(("most", "most_names"), [(1 << 30, 1024), (0, 1024), (0, 3), (1 << 30, 0)])
def test_chain_by_words_or_lists_broadcast_or_not_is_a_plain_walk(spark, most, most_names):
    (facts, parents, capec, tech, defend, cats), want = small_chain(spark)
    known = chain.Knowledge(parents, capec, tech, defend, cats, most_names=most_names)
    ids = facts.select("cve_id").union(spark.createDataFrame([("empty",)], "cve_id string"))
    assert {r.cve_id: tuple(r[k] for k in chain.LISTS) for r in known.of(facts, ids, most).collect()} == want


def test_chain_deals_bits_and_no_list_of_names(spark):
    (facts, parents, capec, tech, defend, cats), want = small_chain(spark)
    found = chain.Knowledge(parents, capec, tech, defend, cats, ("techniques",)).of(facts, None, 0)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "collect_" not in plan and "bit_or" in plan
    assert {r.cve_id: r.techniques for r in found.collect()} == {v: w[2] for v, w in want.items() if v != "empty"}


def test_jsonl_shuffles_no_record_of_an_id_that_comes_once(spark, tmp_path):
    lines = [('{"a":{"CWE":["1"]},"b":{"CWE":["2"]}}', 0), ('{"c":{"OWASP":["x"]}}', 1)]
    df = spark.createDataFrame(lines, "value string, seq int")
    plan = scans.jsonl_map(df)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan
    twice = spark.createDataFrame([*lines, ('{"b":{"CWE":["3"]},"d":{}}', 2)], "value string, seq int")
    for few in (0, 1, 100):
        assert {r.cve_id: (r.cwe, r.owasp) for r in scans.jsonl_map(twice, few=few).collect()} == {"a": (["1"], []), "b": (["3"], []), "c": ([], ["x"]), "d": ([], [])}


def test_jsonl_sink_can_be_compressed(spark, tmp_path):
    rows = spark.createDataFrame([("a", ["1"], [], [], [], ["x"])], "cve_id string, cwe array<string>, capec array<string>, techniques array<string>, defend array<string>, owasp array<string>")
    sinks.write_jsonl(rows, str(tmp_path / "out"), compression="gzip")
    assert list((tmp_path / "out").glob("part-*.gz"))
    assert [(r.cve_id, r.cwe, r.owasp) for r in scans.jsonl_map(spark.read.text(str(tmp_path / "out")).withColumn("seq", F.lit(0))).collect()] == [("a", ["1"], ["x"])]


def test_partitions_of_facts_grow_with_their_rows(spark, monkeypatch):
    b = Bridge(spark, "/root/testdata/sf0.001")
    monkeypatch.setattr(tables, "PART_ROWS", 500)
    n = -(-b.table("lineitem").count() // 500)
    assert n > int(spark.conf.get("spark.sql.shuffle.partitions"))
    for df in (b.vuln_cwe, chain.expand_parents(b.vuln_cwe, b.cwe_parent, n)):
        assert df.rdd.getNumPartitions() == n and df.count() == df.distinct().count()


def test_trailing_rate_of_a_dense_key_is_a_plain_count(spark):
    r = random.Random(3)
    rows = [("a", r.randrange(40_000_000), i) for i in range(1500)] + [("a", 5_000_000, 2000), ("a", 5_000_000, 2001), ("a", 15_000_000, 2002), ("b", -3_000_000, 2003), ("b", 6_999_999, 2005), ("b", 7_000_000, 2004), ("a", None, 3000), ("a", None, 3001)]
    found = telemetry.trailing_rate(spark.createDataFrame(rows, "k string, us long, id long"), "k", "us", 10, 3)
    assert "RangeFrame, -" not in found._jdf.queryExecution().analyzed().toString()
    got = {x.id: (x.calls, x.limited, x.wait_us) for x in found.collect()}
    want = {}
    for k, t, i in rows:
        same = [u for j, u, _ in rows if j == k and (u is None if t is None else u is not None and t - 10_000_000 < u <= t)]
        full = len(same) - 1 >= 3
        want[i] = (len(same), full, None if t is None and full else min(same) + 10_000_000 - t if full else 0)
    assert got == want


def test_many_landed_pages_are_listed_once_and_read_several_a_task(spark, tmp_path, monkeypatch):
    at, folders = 0, {}
    for n in (7, 1, 12, 5, 30, 2):
        folders[at] = n
        (tmp_path / f"start={at}").mkdir()
        (tmp_path / f"start={at}" / "part-0").write_text("".join(f'{{"n":{at + i}}}\n' for i in range(n)))
        at += n
    monkeypatch.setattr(paged, "MOST_PARTITIONS", 5)
    source = paged.LandedPages(f"file://{tmp_path}")
    parts = paged._Batch(source, 4, 0).partitions()
    assert len(parts) == 5 and source.total() == at
    monkeypatch.setattr(paged.LandedPages, "listed", None)
    for size in (1, 3, 4, 11, 100):
        for start in (0, 6, 7, 21):
            found = []
            for p in paged._Batch(source, size, start).partitions():
                assert len(p.pages.listed) <= len(folders)
                found += [(i, r) for batch in paged._read(p.pages, p, size) for i, r in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            assert found == [(i, f'{{"n":{i}}}') for i in range(start, at)]
    assert [x for x, _ in parts[0].pages.listed] == [0, 7, 8, 20][: len(parts[0].pages.listed)]
    assert len(parts[0].pages.listed) < len(folders)


@pytest.mark.parametrize("most_numbers", [1 << 20, 3])
def test_what_meets_a_fact_is_numbers_of_patterns_and_no_name(spark, most_numbers):
    (facts, parents, capec, tech, defend, cats), want = small_chain(spark)
    known = chain.Knowledge(parents, capec.union(spark.createDataFrame([("3", None)], capec.schema)), tech, defend, cats, most_numbers=most_numbers)
    if most_numbers > 3:
        assert dict(known.lists.dtypes) == {"cwe_id": "string", "up": "array<string>", "owasp_0": "bigint", "capec": "binary"}
    assert {r.cve_id: tuple(r[k] for k in chain.LISTS) for r in known.of(facts, None, 0).collect()} == {v: w for v, w in want.items() if v != "empty"}
    assert chain.Knowledge(parents, capec.limit(0), tech, defend, cats).of(facts.limit(0)).count() == 0


def odd_edges(spark):
    r = random.Random(9)
    rows = [(f"CVE-{r.randrange(60)}", f"CWE-{r.randrange(9)}") for _ in range(300)] + [("CVE-1", "OWASP-A")] * 2 + [(f"CVE-{i}", "OWASP-B") for i in range(50)] + [("CVE-1", None), (None, "CWE-1"), (None, None), ("CWE-1", "CAPEC-1")]
    return rows, spark.createDataFrame(rows, "source string, target string")


def test_neighbours_take_one_shuffle_and_no_join(spark):
    rows, e = odd_edges(spark)
    found = graph.neighbours(e)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    want = {}
    for s, t in rows:
        want.setdefault((t, t is None and "sources"), ([], []))[0].append(s)
        want.setdefault((s, s is None and "targets"), ([], []))[1].append(t)
    clean = lambda xs: tuple(sorted(x for x in xs if x is not None))
    assert sorted(((r.node, tuple(r.sources), tuple(r.targets)) for r in found.collect()), key=str) == sorted(((n, clean(a), clean(b)) for (n, _), (a, b) in want.items()), key=str)


def test_stretches_of_hubs_and_of_other_nodes_are_alike(spark, monkeypatch):
    _, e = odd_edges(spark)
    as_set = lambda df: {(r.node, r.side, r.stretch, tuple(r.nodes)) for r in df.collect()}
    named, numbered, real = e.where("source is not null and target is not null"), [], graph.numbered
    monkeypatch.setattr(graph, "numbered", lambda rows, *a: numbered.append(rows.select("node").distinct().count()) or real(rows, *a))
    for some in (named, e):
        assert as_set(graph.neighbour_stretches(some, 7, 10**6)) == as_set(graph.neighbour_stretches(some, 7, 30)) == as_set(graph.neighbour_stretches(some, 7, 0))
    assert numbered[0] == 0 < numbered[1] < numbered[2]


def test_stored_queries_store_what_they_read(spark, monkeypatch):
    """trace_back_stored reads no edge by source, neighbour_parts no value."""
    seen, real = [], edge_store.EdgeStore.write.__func__
    monkeypatch.setattr(edge_store.EdgeStore, "write", classmethod(lambda cls, e, *a, **k: seen.append((e.columns, real(cls, e, *a, **k))) or seen[-1][1]))
    for q in ("trace_back_stored", "neighbour_parts"):
        assert registry.QUERIES[q](spark, "/root/testdata/sf0.001").count() > 0
    assert [(columns, set(store.tables)) for columns, store in seen] == [(["source", "target", "value"], {"target"}), (["source", "target"], {"target", "source"})]


def test_edges_of_lists_are_those_of_pairs(spark):
    (facts, parents, capec, tech, defend, cats), _ = small_chain(spark)
    cats = cats.union(spark.createDataFrame([("3", None), ("3", "A1"), ("3", "A1")], cats.schema))
    stored = chain.expand_parents(facts, parents)
    direct = facts.distinct().join(cats.distinct(), "cwe_id").select("cve_id", "category_id").distinct()
    lists = tables.written(chain.weakness_lists(facts, parents, cats, 3), "lists")
    as_list = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert as_list(graph.list_edges(lists, capec, tech, defend)) == as_list(graph.edges(stored, capec, tech, defend, direct))


def test_a_store_may_have_one_side(spark, tmp_path):
    _, e = odd_edges(spark)
    store = edge_store.EdgeStore.write(e, f"file://{tmp_path}/one", buckets=2, sides=("target",))
    assert set(store.tables) == set(edge_store.EdgeStore(spark, store.path).tables) == {"target"}
    assert {r.side for r in store.neighbour_parts().collect()} == {"sources"}
