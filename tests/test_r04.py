import functools
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wardgraph.functions import ids
from wardgraph.operators import graph
from wardgraph.plans import registry
from wardgraph.plans.bridge import Bridge


def odd_edges(spark):
    """Edges of CVE-1 to CVE-59, each with a name or none at either end, and of others; OWASP-B is a hub."""
    r = random.Random(9)
    rows = [(f"CVE-{r.randrange(60)}", f"CWE-{r.randrange(9)}") for _ in range(300)] + [("CVE-1", "OWASP-A")] * 2 + [(f"CVE-{i}", "OWASP-B") for i in range(50)]
    rows += [("CVE-1", None), ("CVE-none", None), (None, "CWE-1"), (None, None), ("CVE-,", ""), ("CVE-", "")]
    more = [("CWE-1", "CAPEC-1"), ("CWE-1", "CAPEC-2"), (None, "CAPEC-1"), ("CAPEC-1", None)]
    return spark.createDataFrame(rows, "source string, target string"), spark.createDataFrame(more, "source string, target string")


def as_texts(lists):
    return lists.select("node", *(ids.joined(F.col(side)).alias(side) for side in ("sources", "targets")))


def in_order(df):
    return sorted(map(tuple, df.collect()), key=str)


@pytest.mark.parametrize(("most", "bucket", "piece"), [(10**6, 10_000, 13), (40, 1, 2), (40, 50, 0), (0, 20, 3)])
def test_texts_of_hubs_and_of_other_nodes_are_their_lists(spark, monkeypatch, most, bucket, piece):
    monkeypatch.setattr(graph, "BUCKET_EDGES", bucket)
    monkeypatch.setattr(graph, "GROUP_BUCKETS", 3)
    monkeypatch.setattr(graph, "PIECE_BITS", piece)
    e, more = odd_edges(spark)
    want = in_order(as_texts(graph.neighbours(e.union(more))))
    whole = e.where("source is not null").groupBy("source").agg(F.collect_list(F.struct("target")).alias("t")).select("source", F.col("t.target").alias("targets"))
    nameless = e.where("source is null").select("source", F.array("target").alias("targets"))
    none = spark.createDataFrame([("CVE-of-no-edge", [])], whole.schema)
    for task_names in (10**6, 60):
        assert in_order(graph.neighbour_texts(e.union(more), most=most, task_names=task_names)) == want
        assert in_order(graph.neighbour_texts(more, whole.union(nameless).union(none), most=most, task_names=task_names)) == want
    assert graph.neighbour_texts(e.limit(0), most=most).count() == 0


def test_neighbours_gather_no_hub_in_a_list(spark, monkeypatch):
    """No list of names is longer than a bucket may be, and the query's rows are those of lists."""
    most, longest, real = 40, [], graph._gathered

    def gathered(sides):
        longest.append(sides.groupBy("node").agg(F.count("*").alias("n")).agg(F.max("n")).first()[0])
        return real(sides)

    b = Bridge(spark, "/root/testdata/sf0.001")
    want = in_order(as_texts(graph.neighbours(registry.graph_queries.all_edges(b))))
    monkeypatch.setattr(graph, "BUCKET_EDGES", 10)
    monkeypatch.setattr(graph, "GROUP_BUCKETS", 2)
    monkeypatch.setattr(graph, "_gathered", gathered)
    monkeypatch.setattr(graph, "neighbour_texts", functools.partial(graph.neighbour_texts, most=most))
    assert in_order(registry.QUERIES["neighbours"](spark, "/root/testdata/sf0.001")) == want
    assert longest and max(longest) <= most < max(r[1].count(",") + 1 for r in want)


def test_hubs_are_put_together_one_at_a_time():
    """Pieces are read as they come: a hub goes on before the next one's pieces are read."""
    read, pieces, name = [], 40, "x" * 99_999

    def batches():
        for node in ("a", "b", None):
            for side in ("sources", "targets"):
                for i in range(pieces):
                    read.append(node)
                    yield pa.RecordBatch.from_pydict({"node": pa.array([node], pa.string()), "side": [side], "text": pa.array([name], pa.string())})

    out = []
    for batch in graph._put_together(",")(batches()):
        assert batch.num_rows <= 1 and len(read) <= (len(out) + 1) * 2 * pieces + 1
        out += [(r["node"], len(r["sources"]), len(r["targets"])) for r in batch.to_pylist()]
    size = pieces * 100_000 - 1
    assert out == [("a", size, size), ("b", size, size), (None, size, 0), (None, 0, size)]
