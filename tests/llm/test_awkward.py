"""Shared ids, names that clash, extreme numbers, and what samples decide."""

import random
import string
import time
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.llm.test_operators import SF, brute_components, docs_of
from wardgraph.llm import ann, chat, common, decontam, lang_id, materialise, near_dup, quality, secrets, tokens, url_rules

ADDED = ["__id", "__lang", "__score", "__spans", "__secrets", "__quality", "__text", "__i", "__t", "row", "key", "node"]


def clashing(spark, n=40):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(n)
    return docs.withColumns({c: F.lit(f"own {c}") for c in ADDED})


def test_clashing_columns_pass_through_every_stage(spark):
    docs = clashing(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns, name
        rows = out.collect()
        assert rows and all(r[c] == f"own {c}" for r in rows for c in ADDED), name
    assert corpus_pipeline.packing(spark, docs, SF).count() >= docs.count()


def test_clashing_columns_in_the_operators(spark):
    docs = clashing(spark)
    assert common.free_names(docs, "__lang", "__Score", "new") == ["___lang", "___Score", "new"]
    model = lang_id.LanguageModel.fit(docs)
    found = lang_id.identify(docs, model)
    assert found.columns == [*docs.columns, "___lang", "___score"] and {r["__lang"] for r in found.collect()} == {"own __lang"}
    spans = secrets.secret_spans(docs, secrets.SecretModel.fit(docs))
    assert spans.columns[-1] == "___spans" and {r["__spans"] for r in spans.collect()} == {"own __spans"}
    labels = docs.select("doc_id", F.lit(1).alias("y"))
    scored = quality.quality_scores(docs, quality.QualityModel.fit(docs, labels))
    assert scored.columns[-1] == quality.added_name(docs) == "___quality" and {r["__quality"] for r in scored.collect()} == {"own __quality"}


def test_different_texts_that_share_an_id_stay(spark):
    long = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, long), (1, "quite other words that nothing else says here"), (1, long), (5, long + " thirteen"), (5, None), (5, ""), (None, long), (7, "quite other words that nothing else says here")]
    docs = spark.createDataFrame([(i, t, "k") for i, t in rows], "doc_id long, text string, __id string")
    got = corpus_pipeline.near_dedup(spark, docs, SF)
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(1, long), (1, rows[1][1]), (5, None), (5, "")], key=str)
    comps = sorted(((r.doc_id, r.n_shingles, r.component_id) for r in near_dup.near_duplicates(docs).collect()), key=str)
    assert comps == sorted([(1, 9, 1), (1, 5, 1), (1, 9, 1), (5, 10, 1), (5, 0, 5), (5, 0, 5), (None, 9, 1), (7, 5, 1)], key=str)


def test_ids_that_share_a_smallest_one_are_not_united(spark):
    a, b = "a b c d e f g h i j k l", "m n o p q r s t u v w x"
    rows = [(1, a), (1, b), (8, a), (9, b + " y")]
    feats, of = near_dup.classified(spark.createDataFrame(rows, "doc_id long, text string"))
    tops = {(r.k1, r.k2): (r.top.doc_id, r.top.text.a) for r in of.collect()}
    assert len(tops) == 3 and len(set(tops.values())) == 2


def test_ids_of_any_type(spark):
    rows = [("x9", "a b c d e f"), ("x10", "a b c d e f"), (None, "a b c d e f"), ("y", None)]
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id string, text string")).collect()}
    assert got == {"x9": "x10", "x10": "x10", None: "x10", "y": "y"}


def test_clusters_of_many_copies_and_parts(spark, monkeypatch):
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(6))
    base = [word() for _ in range(200)]
    rows = [(i, " ".join(w if rnd.random() > 0.004 * (i % 9) else word() for w in base)) for i in range(60)] + [(100 + i, " ".join(base)) for i in range(300)]
    monkeypatch.setattr(near_dup, "BLOCK_CLASSES", 5)
    monkeypatch.setattr(near_dup, "SHARED_CLASSES", 1)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows[:60] + rows[60:61])
    assert all(got[i] == want.get(i, want[100]) for i, _ in rows)


def far(x, y):
    """Euclidean distance without overflow, in the widest floats."""
    return float(np.sqrt(((np.array(x, np.longdouble) - np.array(y, np.longdouble)) ** 2).sum()))


@pytest.mark.parametrize("block", [8 << 20, 200])
def test_nearest_of_extreme_vectors(spark, block):
    rnd = np.random.default_rng(1)
    rows = []
    for size in (1e160, 1e300, 1e-300, 1.0, 1e-160, 5e-324):
        rows += [(len(rows) + i, (rnd.normal(size=4) * size).tolist() if size != 5e-324 else [5e-324 * (1 + i % 3), 0.0, 0.0, 0.0]) for i in range(12)]
    rows.append((len(rows), [1.7e308, -1.7e308, 1.7e308, 1.7e308]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 2 = 0"), k=5, block_bytes=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    for q, v in rows[::2]:
        best = sorted((far(v, x), i) for i, x in rows if i != q)[:5]
        mine = sorted(got[q])
        assert [r for r, _, _ in mine] == [1, 2, 3, 4, 5]
        assert [s for _, _, s in mine] == pytest.approx([d for d, _ in best], rel=1e-12), q
    assert ann.distances(np.array([[0.0, 0.0]]), np.array([0.0, 0.0])).tolist() == [0.0]


# what samples decide


def planted(rnd, n):
    """Texts of ordinary words and identifiers, where some hold a random key after `key` and some a pattern's hit."""
    words = ["the", "value", "of", "some_name", "otherName", "config", "parse", "request", "index", "window", "number", "table", "is", "and", "we", "then", "print", "total", "counter", "batch_size"]
    rows, keys = [], {}
    for i in range(n):
        text = [rnd.choice(words) + (rnd.choice(["", "", str(rnd.randrange(100))])) for _ in range(60)]
        secret = "".join(rnd.choice(string.ascii_letters + string.digits) for _ in range(24))
        if i % 10 == 0:
            keys[i] = secret
            text.insert(30, f"key {secret}")
        elif i % 10 == 5:
            text.insert(30, f"password={secret}")
        rows.append((i, " ".join(text), "en", ""))
    return rows, keys


def test_limits_are_chosen_on_held_out_samples(spark):
    rows, keys = planted(random.Random(6), 600)
    docs = docs_of(spark, rows)
    least, least_mean, recall = secrets.SecretModel.limits(docs, false_rate=1e-3)
    assert recall >= 0.95 and least >= 20.0 and least_mean >= 1.0
    model = secrets.SecretModel.fit(docs, least, least_mean)
    texts = {i: t for i, t, *_ in rows}
    found = {r.doc_id: [(texts[r.doc_id][s.start : s.end], s.ratio) for s in r["__spans"] if s.kind == "markov"] for r in secrets.secret_spans(docs, model).collect()}
    hits = [(i, s) for i, v in found.items() for s, _ in v]
    right = sum(keys.get(i) == s for i, s in hits)
    assert right / len(keys) >= 0.95 and right / len(hits) >= 0.95  # recall and precision of keys that no pattern finds
    assert all(ratio >= model.least for v in found.values() for _, ratio in v)


def test_limits_are_the_same_at_every_size(spark):
    rows, keys = planted(random.Random(6), 600)
    for n in (10, 600):
        model = secrets.SecretModel.fit(docs_of(spark, rows[:n]))
        assert (model.least, model.least_mean) == (secrets.LEAST, secrets.LEAST_MEAN)
        found = [r for r in secrets.secret_spans(docs_of(spark, rows[:n]), model).collect() if any(s.kind == "markov" for s in r["__spans"])]
        assert {r.doc_id for r in found} == {i for i in keys if i < n}


def test_chosen_limits_are_the_best_of_all():
    rnd = np.random.default_rng(2)
    n = np.zeros((2, secrets._TOTALS + 1, secrets._MEANS + 1), np.int64)
    np.add.at(n[0], (rnd.integers(5, 60, 300), rnd.integers(1, 12, 300)), 1)
    np.add.at(n[1], (rnd.integers(0, 20, 5000), rnd.integers(0, 6, 5000)), 1)
    total, mean, recall = secrets.chosen_limits(n, 1e-3, 3, 0.25)
    hits = lambda label, t, m: n[label, int(t) :, int(4 * m) :].sum()
    assert hits(1, total, mean) <= 5 and recall == hits(0, total, mean) / 300
    for m in range(1, 13):
        for t in range(3, 400):
            if hits(1, t, m / 4) <= 5:
                assert hits(0, t, m / 4) < hits(0, total, mean) or (hits(0, t, m / 4) == hits(0, total, mean) and (t, m / 4) >= (total, mean))
    assert secrets.chosen_limits(n, 1e-3, 30, 1.0)[:2] == (30.0, 1.0)
    # the strictest where none is strict enough, the lowest where there is nothing to find
    n[1, 399, 39] += 5000
    assert secrets.chosen_limits(n, 1e-3, 3, 0.25) == (secrets._TOTALS - 1.0, 3.0, 0.0)
    assert secrets.chosen_limits(n * 0, 1e-3, 3, 0.25) == (3.0, 0.25, 0.0)


def test_redaction_is_linear_and_covers_every_span():
    model = secrets.SecretModel(np.zeros((94, 94)))
    text = "token=abcdef1 and words " * 20_000
    out, n = model.redact(text, "<SECRET>")
    assert n == 20_000 and out == "<SECRET> and words " * 20_000
    assert model.redact(None, "x") == (None, 0) and model.redact("", "x") == ("", 0)


def test_repeated_rows_do_not_reach_the_driver(spark):
    row = spark.range(3000).select(F.lit(7).cast("long").alias("doc_id"), F.lit("the very same text here").alias("text"), F.lit("en").alias("lang"))
    other = spark.createDataFrame([(1, "le chat noir est ici", "fr"), (2, "bad", "fr")], row.schema)
    docs = row.union(other)
    model = lang_id.LanguageModel.fit(docs)
    assert model.predict(["the text here", "le chat"])[0] == ["en", "fr"]
    alone = lang_id.LanguageModel.fit(row.limit(1).union(other))
    assert np.array_equal(model.weights, alone.weights)
    labels = spark.createDataFrame([(7, 1), (2, 0)], "doc_id long, y int")
    a, b = quality.QualityModel.fit(docs, labels), quality.QualityModel.fit(row.limit(1).union(other), labels)
    assert np.array_equal(a.weights, b.weights)


def test_many_languages_share_the_bound(spark):
    rows = [(i, f"w{i % 40} v{i % 40} x{i}", f"l{i % 40}", "") for i in range(400)]
    model = lang_id.LanguageModel.fit(docs_of(spark, rows), most=120, most_landmarks=80)
    langs, _ = model.predict([t for _, t, *_ in rows])
    assert len(model.langs) == 40 and sum(a == r[2] for a, r in zip(langs, rows, strict=True)) >= 0.9 * len(rows)


def test_language_scores_are_the_two_products():
    """Presence by landmarks, then kernels by weights, from sets and plain sums."""
    rnd = np.random.default_rng(4)
    sets = [np.unique(rnd.integers(0, 3 * lang_id.BUCKETS, 50)) for _ in range(6)]
    vocab = np.unique(np.concatenate(sets[:3]))
    k = lang_id.LanguageModel._kernels(sets, sets[:3], vocab)
    for i in range(6):
        for j in range(3):
            want = 0
            for n in range(3):
                a, b = ({x for x in s.tolist() if x // lang_id.BUCKETS == n} for s in (sets[i], sets[j]))
                want += len(a & b) / (max(1, len(a)) * max(1, len(b))) ** 0.5 / 3
            assert k[i, j] == pytest.approx(want, rel=1e-5)
    alpha = rnd.normal(size=(3, 2))
    weights = np.stack([lang_id.LanguageModel._row(m, vocab) for m in sets[:3]]).T @ alpha / 3
    rows = np.stack([lang_id.LanguageModel._row(s, vocab) for s in sets])
    assert rows @ weights == pytest.approx(k @ alpha, rel=1e-4, abs=1e-6)


def test_risk_and_its_gradient():
    rnd = np.random.default_rng(9)
    pos, unl = rnd.normal(0.5, 1, (40, 5)), rnd.normal(size=(70, 5))
    for prior in (0.05, 0.4, 0.95):
        for scale in (0.1, 3.0):
            w = rnd.normal(size=5) * scale
            loss = lambda z, y: sum(np.log1p(np.exp(-y * v)) for v in z) / len(z)
            want = prior * loss(pos @ w, 1), loss(unl @ w, -1) - prior * loss(pos @ w, -1)
            assert quality.risk(pos, unl, w, prior) == pytest.approx(want)
            sign = (lambda r: r[0] + r[1]) if want[1] >= 0 else (lambda r: -r[1])
            steps = [(sign(quality.risk(pos, unl, w + e, prior)) - sign(quality.risk(pos, unl, w - e, prior))) / 2e-6 for e in np.eye(5) * 1e-6]
            assert quality.slope(pos, unl, w, prior) == pytest.approx(steps, rel=1e-4, abs=1e-7)


# rules of URLs


def test_rules_supports_and_confidences_are_brute_force(spark):
    rnd = random.Random(3)
    urls = []
    for _ in range(300):
        host, path = rnd.choice(["a.b.net", "c.net", "b.org"]), "/" + "/".join(rnd.sample(["en", "es", "shop", "win", "77"], 2))
        urls.append((host, path, None if rnd.random() < 0.3 else "block" if "win" in path or (host == "c.net" and rnd.random() < 0.9) else "allow"))
    urls += [(None, None, None), ("", "", None), ("c.net", None, "block")]
    support, confidence = 0.05, 0.6
    got = {(r[0], r[1]): r[2:] for r in url_rules.UrlRules.fit(spark.createDataFrame(urls, "host string, path string, label string"), support, confidence).rules}
    baskets = [(frozenset(url_rules.tokens(h, p)), label) for h, p, label in urls]
    where = {t: tuple(t in b for b, _ in baskets) for t in sorted({t for b, _ in baskets for t in b}, reverse=True)}
    every = sorted({at: t for t, at in where.items()}.values())  # of tokens in the same baskets the first
    assert len(every) < len(where)
    rules = {}
    for n in range(1, len(every) + 1):
        for key in combinations(every, n):
            has = [label for b, label in baskets if b.issuperset(key)]
            for label in ("allow", "block"):
                hit = has.count(label)
                if has and hit / len(urls) >= support and hit / len(has) >= confidence:
                    rules[key, label] = hit / len(has), hit / len(urls)
    want = {}
    for (key, label), (conf, sup) in rules.items():
        if (key, "allow" if label == "block" else "block") in rules and rules[key, "allow" if label == "block" else "block"] > (conf, sup):
            continue
        if not any(v == label and set(k) < set(key) and c[0] >= conf for (k, v), c in want.items()):
            want[key, label] = conf, sup
    assert got.keys() == want.keys() and len(got) > 5
    assert all(got[k] == pytest.approx(want[k]) for k in want)


def test_labelled_pages_that_were_held_out(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    rows = pages.select("page_id", url_rules.host_of(F.col("url")).alias("host"), url_rules.path_of(F.col("url")).alias("path"))
    verdict = F.create_map(*(F.lit(x) for h, p, v in url_rules.HOST_RULES for x in (h + p, v)))
    rows = rows.withColumn("label", verdict[url_rules.fixed_rule(F.col("host"), F.col("path"))])
    held = common.held_out("page_id", 5, 0)
    model = url_rules.UrlRules.fit(rows.where(~held))
    judged = [(r.label, model.judge(r.host, r.path)[0]) for r in rows.where(held).collect()]
    blocked, block = [a for a, b in judged if b == "block" and a], [b for a, b in judged if a == "block"]
    assert blocked.count("block") / len(blocked) >= 0.8 and block.count("block") / len(block) >= 0.8
    # where no label says so, few are blocked
    other = [b for a, b in judged if a is None]
    assert other.count("block") / len(other) <= 0.2


def planted_urls(rnd, sites=40):
    """Pages of many sites, a tenth of them labelled, of which some offer bets: host, path, label, whether they do."""
    rows = []
    for i in range(4000):
        bad = rnd.random() < 0.3
        words = rnd.sample(["news", "blog", "en", "fr", "shop", "about", "tag"], 3) + ([rnd.choice(["casino", "bets"])] if bad else [])
        rnd.shuffle(words)
        label = ("block" if bad else "allow") if rnd.random() < 0.1 else None
        rows.append((f"w{i % 3}.site{rnd.randrange(sites)}.org", "/" + "/".join(words) + f"/{i}", label, bad))
    return rows


def test_rules_of_the_second_kind_judge_unlabelled_pages(spark):
    rows = planted_urls(random.Random(8))
    fit = lambda rows: url_rules.UrlRules.fit(spark.createDataFrame([r[:3] for r in rows], "host string, path string, label string"))
    model = fit(rows)
    judged = [(bad, *model.judge(host, path)) for host, path, label, bad in rows if label is None]
    blocked, passed = [b for b, v, *_ in judged if v == "block"], [b for b, v, *_ in judged if v == "allow"]
    assert sum(blocked) / len(blocked) >= 0.99 and sum(passed) / len(passed) <= 0.01  # all that is bad, and nothing else
    assert {r[0] for r in model.wider if r[1] == "block"} == {("path:casino",), ("path:bets",)} and not model.rules
    assert all(t in ("path:casino", "path:bets") for _, v, t, _ in judged if v == "block")
    # labels of one site alone say nothing of others, but of itself if it is labelled throughout
    one = [(h, p, ("block" if "casino" in p else "allow") if h.endswith("site1.org") else None, bad) for h, p, _, bad in planted_urls(random.Random(9), 3)]
    model = fit(one)
    assert not model.wider and all("site1" in " ".join(r[0]) for r in model.rules) and model.rules
    assert model.judge("w0.site2.org", "/casino/x")[0] == "allow" and model.judge("w0.site1.org", "/casino/x")[0] == "block"


@pytest.mark.parametrize("shared", [1, 10, 20])
def test_words_that_go_together_are_one_item(spark, shared):
    path = "/".join(f"w{i}" for i in range(shared))
    rows = [(f"a.s{i % 9}.org", f"/{path}/{'bets' if i % 3 else 'news'}/{i}", ("block" if i % 3 else "allow") if i % 2 else None) for i in range(900)]
    began = time.time()
    model = url_rules.UrlRules.fit(spark.createDataFrame(rows, "host string, path string, label string"))
    assert time.time() - began < 60 and {(r[0], r[1]) for r in model.wider} >= {(("path:bets",), "block"), (("path:news",), "allow")}
    # words that nearly always go together
    rows = [(h, "/".join(w for w in p.split("/") if w in ("bets", "news") or zlib.crc32(f"{i} {w}".encode()) % 50), y) for i, (h, p, y) in enumerate(rows)]
    model = url_rules.UrlRules.fit(spark.createDataFrame(rows, "host string, path string, label string"))
    assert {(r[0], r[1]) for r in model.wider} >= {(("path:bets",), "block"), (("path:news",), "allow")}


def test_judged_pages_keep_their_columns(spark):
    pages = spark.createDataFrame([("a.org", "/x/", "own"), (None, None, None), ("a.org", "/x/", "own")], "__host string, __path string, __verdict string")
    out = url_rules.judged(pages, url_rules.UrlRules([(("path:x",), "block", 1.0, 0.5)]))
    assert out.columns == ["__host", "__path", "__verdict", "___verdict", "__mined", "__confidence"]
    want = [(None, None, None, "allow", None, None), *[("a.org", "/x/", "own", "block", "path:x", 1.0)] * 2]
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)


# shards


def test_slots_are_in_order_of_the_permutation(spark, tmp_path):
    rows = [(i, f"text number {i} " * (i % 40), "en", "") for i in range(200)]
    docs_of(spark, rows).repartition(3).write.parquet(f"{tmp_path}/docs")
    docs, path, length = spark.read.parquet(f"{tmp_path}/docs").select("text"), f"file://{tmp_path}/shards", 64
    enc = tokens.loaded(tokens.ByteBpe, tokens.BYTE_BPE)
    parts = {}
    for r in docs.select("text", F.spark_partition_id().alias("p")).collect():
        parts.setdefault(r.p, []).append(r.text)
    n, placed = 0, []
    sizes = {p: sum(len(t.encode()) + 1 for t in ts) // length + 1 for p, ts in sorted(parts.items())}
    order = materialise.Permutation(sum(sizes.values()), 9)
    for p, ts in sorted(parts.items()):
        ids = np.concatenate([np.append(np.frombuffer(enc.encode(t), "<u2"), 50256) for t in ts])
        for i in range(0, len(ids), length):
            placed.append((int(order(np.array([n + i // length]))[0]), ids[i : i + length]))
        n += sizes[p]
    want = [ids for _, ids in sorted(placed, key=lambda x: x[0])]
    for _ in range(2):  # the second time over the files of the first
        got = sorted(materialise.write_training_order(docs, path, key=9, length=length, per_shard=32).collect(), key=lambda r: r.slot)
        assert [r.slot for r in got] == list(range(len(want))) and [r.tokens for r in got] == [len(x) for x in want]
        assert [r.ids_crc32 for r in got] == [zlib.crc32(x.astype("<u2").tobytes()) for x in want]
        index = sorted({(min(x.slot for x in got if x.shard == r.shard), r.shard) for r in got})
        data = materialise.read_training_order(index, path, 0, len(want), length)
        assert all((d[: len(x)] == x).all() and (d[len(x) :] == 50256).all() for d, x in zip(data, want, strict=True))
        assert (materialise.read_training_order(index, path, 5, 40, length) == data[5:45]).all()
    assert len(index) == len([f for f in (tmp_path / "shards").rglob("part-*") if not f.name.startswith(".")])
    with pytest.raises(IndexError):
        materialise.read_training_order(index, path, len(want), 1, length)


# windows of items


def test_windows_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(decontam, "row_hashes", lambda rows: np.zeros(len(rows), np.uint64))
    index = decontam.Index([("a", "one two three four five six seven eight nine ten"), ("b", "q w e r t y u i o p a s")])
    assert index.find("x Q w e r t y u i o p a s one two")[1:] == ([{"start": 1, "end": 13}], ["b"])
    assert index.find("one two three four five six seven eight nine ten q")[1:] == ([{"start": 0, "end": 10}], ["a"])


def test_long_items_are_cut_without_losing_a_window(spark):
    rnd = random.Random(1)
    words = [f"w{rnd.randrange(500)}" for _ in range(3000)]
    items = spark.createDataFrame([(1, " ".join(words)), (2, "short one")], "item_id long, text string")
    docs = docs_of(spark, [(i, " ".join(words[i : i + 10]), "en", "") for i in range(0, 2991, 7)] + [(9999, "w1 w2", "en", "")])
    got = decontam.contamination(docs, items, block_bytes=2000).collect()
    assert all((r["items"] == ["1"]) == (r.doc_id != 9999) and r.n_words == (2 if r.doc_id == 9999 else 10) for r in got)
    assert all(sum(s.end - s.start for s in r.spans) == 10 for r in got if r.doc_id != 9999)


# chat


def test_chat_ids_and_offsets_are_the_tokenizers_own():
    own, whole = chat.Encoder(chat.TOKENIZER), chat.tokenizer(chat.TOKENIZER)
    for text in ["", "é ́ ﬁ ½²Ⅷ🙂👍🏽 日本語　x\x00\x07 \n\n  a", chat.render([("user", "a<|im_end|>é"), ("assistant", " 🙂 ")])[0], "it's  \t x" * 50]:
        ids, offsets = own.encode(text)
        want = whole.encode(text, add_special_tokens=False)
        assert ids.tolist() == want.ids and list(map(tuple, offsets.tolist())) == want.offsets
        assert own.decode(ids.tolist()) == text
