"""The pipeline against the same steps done plainly on the driver."""

import zlib

import numpy as np

import corpus_pipeline
from tests.llm.test_operators import brute_components, brute_hits
from wardgraph.llm import lang_id, secrets, tokens

SF = "/root/testdata/sf0.001"


def test_run_is_the_plain_version(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    docs = [(r.doc_id, r.text) for r in table.collect()]
    langs, scores = lang_id.LanguageModel.fit(table).predict([t for _, t in docs])
    docs = [d for d, lang, s in zip(docs, langs, scores, strict=True) if lang != "und" and s >= 0.4]
    comp = brute_components(docs, k=5)
    docs = [(i, t) for i, t in docs if comp[i][1] == i]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(i, t) for i, t in docs if not brute_hits(t, items)[2]]
    model = secrets.SecretModel.fit(spark.createDataFrame(docs, "doc_id long, text string"))
    enc, want = tokens.loaded(tokens.WordBpe, tokens.WORD_BPE).tokenizer, {}
    for i, t in docs:
        out, at = "", 0
        for s, _, e in model.spans(t):
            if s >= at:
                out += t[at:s] + "<SECRET>"
            at = max(at, e)
        want[i] = enc.encode(out + t[at:], add_special_tokens=False).ids + [1]
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == set(want)
    for r in got:
        piece = want[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(want[r.doc_id]) and zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32
    assert sum(r.length for r in got) == sum(map(len, want.values()))


def test_stages_keep_columns_and_empty_tables(spark):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for rows in (0, 30):
            docs = spark.read.parquet(f"{SF}/documents.parquet").limit(rows)
            assert stage(spark, docs, SF).columns == docs.columns, name


def test_stage_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontaminate", "secret_scan", "packing"]


def test_near_dedup_of_documents_without_id(spark):
    long = "one two three four five six seven eight nine ten"
    rows = [(2, long), (None, long), (None, "other words here"), (None, "other words here"), (None, "more of other words"), (None, None), (3, ""), (3, "")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, __x string")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(2, long), (None, "other words here"), (None, "more of other words"), (None, None), (3, "")], key=str)
