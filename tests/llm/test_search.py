"""Lexical search, inner products and spellings against brute force, and on awkward tables."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardgraph.llm import lexical, maxscore, spelling

# lexical search

WORDS = [f"w{i}" for i in range(60)] + ["É", "naïve", "x1", "日本"]


def plain_terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_search(docs, items, k):
    bags = [(d, Counter(plain_terms(t))) for d, t in docs]
    bags = [(d, b, sum(b.values())) for d, b in bags if b]
    n_docs, length = len(bags), sum(n for _, _, n in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    asked = {}
    for item, text in items:
        if item is not None and text is not None:
            asked[item] = min(asked.get(item, text), text)
    out = {}
    for item, text in asked.items():
        best = {}
        for d, b, n in bags:
            m = 100 - 25 + (25 * n * n_docs) // length
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * b[t]) // (1000 * b[t] + 12 * m)) for t in plain_terms(text) if b[t])
            if score > 0 and d is not None:
                best[d] = max(best.get(d, 0), score)
        for i, (d, s) in enumerate(sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]):
            out[item, i + 1] = (d, s)
    return out


def some_docs(seed, n=600):
    r = random.Random(seed)
    common = [min(int(r.expovariate(0.08)), len(WORDS) - 1) for _ in range(4000)]
    docs = [(i, " ".join(WORDS[r.choice(common)] for _ in range(r.randint(1, 60)))) for i in range(n)]
    docs += [(n + i, docs[7][1]) for i in range(90)]  # ties
    return docs + [(None, "w1 w2 w3"), (n + 95, None), (n + 96, ""), (n + 97, " .;\n"), (5, "w9 w9 W9 w1"), (5, docs[5][1]), (n + 98, "w3 " * 40_000)]


@pytest.mark.parametrize("block", [8 << 20, 60])
def test_search_is_brute_force(spark, monkeypatch, block):
    docs, r = some_docs(3), random.Random(5)
    items = [(i, " ".join(r.choice(WORDS) for _ in range(r.randint(1, 12)))) for i in range(25 if block > 100 else 5)]
    items += [(90, docs[7][1]), (91, None), (None, "w1"), (92, ""), (93, "nowhere at-all"), (94, "w5 w6"), (94, "W4 w6"), (94, "W4 w6"), (95, "w3 w3 w3 w1")]
    t = spark.createDataFrame(docs, "doc_id long, text string").withColumn("item", F.lit("own")).repartition(3)
    got = {(x.item_id, x.rank): (x.doc_id, x.score) for x in lexical.ranked_search(t, spark.createDataFrame(items, "item_id long, text string"), 20, block).collect()}
    assert got == plain_search(docs, items, 20)
    assert (93, 1) not in got and (92, 1) not in got


def test_search_of_nothing(spark):
    docs, items = "doc_id string, text string", "item_id string, text string"
    none, some = spark.createDataFrame([], docs), spark.createDataFrame([("b", "an old oak"), ("a", "an old oak"), ("c", "a new oak")], docs)
    asked = spark.createDataFrame([("q", "old oak")], items)
    assert lexical.ranked_search(none, asked).collect() == [] and lexical.ranked_search(some, spark.createDataFrame([], items)).collect() == []
    assert [(x.item_id, x.rank, x.doc_id) for x in lexical.ranked_search(some, asked).orderBy("rank").collect()] == [("q", 1, "a"), ("q", 2, "b"), ("q", 3, "c")]


def shard_of(docs, seed):
    """Random documents as a shard, and queries, with lists long enough for many blocks."""
    r = np.random.default_rng(seed)
    terms = [np.unique(r.zipf(1.3, 12) % 50) for _ in range(docs)]
    ends = np.concatenate([[0], np.cumsum([len(t) for t in terms])])
    weights = r.integers(1, 2000, 50)
    return r, lexical.Shard(np.arange(docs), ends, np.concatenate(terms).astype(np.int64), r.integers(1, 1000, ends[-1]), weights), weights


def searched():
    """The k best of random queries are those of all documents; how many were scored of those in lists."""
    r, shard, weights = shard_of(3000, 1)
    queries = [(t := np.sort(r.choice(50, 8, replace=False)).astype(np.int64), weights[t]) for _ in range(30)]
    ranked = lexical.Ranked(queries, 50, weights, 20)
    ranked.add(shard)
    for i, (terms, weight) in enumerate(queries):
        dense = np.zeros(50, np.int64)
        dense[terms] = weight
        want = sorted(zip((-shard.scores(np.arange(3000), dense)).tolist(), range(3000), strict=True))[:20]
        assert sorted((-s, d) for d, s in ranked.heaps[i].items()) == want
    return ranked.counted[0] / ranked.counted[1]


def test_blocks_are_skipped(monkeypatch):
    some = searched()
    assert some < 0.75  # terms are drawn alone here, so clusters say little
    monkeypatch.setattr(lexical, "CELLS", 10)
    monkeypatch.setattr(lexical, "TERMS", 20)
    assert searched() > some  # lists without summaries are scored whole, queries in groups


def test_summaries_bound_every_document():
    r, shard, weights = shard_of(3000, 1)
    column, seen = np.full(50, -1, np.int64), 0
    for _ in range(8):
        terms = np.sort(r.choice(50, 8, replace=False)).astype(np.int64)
        dense = np.zeros(50, np.int64)
        dense[terms] = weights[terms]
        for t in terms.tolist():
            if (at := shard.place(t)) < 0:
                continue
            b = lexical.Blocks(shard, shard.lists[at], terms, column)
            assert sorted(b.rows.tolist()) == shard.lists[at].tolist() and b.n.max() <= lexical.BLOCK and b.n.sum() == len(b.rows)
            if (bounds := b.bounds(terms, dense)) is not None:
                assert (np.maximum.reduceat(shard.scores(b.rows, dense), b.heads) <= bounds).all()
                assert (b.least == np.minimum.reduceat(b.rows, b.heads)).all()
                seen += len(bounds)
    assert seen > 100


# inner products


def plain_products(rows, k):
    def floored(v):
        return [math.floor(1024 * x) if abs(x) < 2**52 else int(x) * 1024 for x in v]

    ok = [(i, floored(v)) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    asking = {}
    for i, v in rows:
        if i is not None and i % 100 == 0 and v is not None and all(x is not None and math.isfinite(x) for x in v):
            asking[i] = min(asking.get(i, v), v)
    out = {}
    for q, v in asking.items():
        best = {}
        for i, x in ok:
            if i != q and len(x) == len(v):
                s = sum(a * b for a, b in zip(floored(v), x, strict=True))
                best[i] = max(best.get(i, s), s)
        for n, (i, s) in enumerate(sorted(best.items(), key=lambda b: (-b[1], b[0]))[:k]):
            out[q, n + 1] = (i, min(max(s, maxscore.LOW), maxscore.HIGH))
    return out


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_products_are_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(maxscore, "SHARD", 64)
    r = np.random.default_rng(2)
    rows = [(i, r.normal(0, 0.2, 16).astype(np.float32).astype(float).tolist()) for i in range(500)]
    rows += [(i, rows[3][1]) for i in range(500, 520)]  # ties
    rows += [(600, None), (601, [None] * 16), (602, [float("nan")] * 16), (603, [float("inf")] + [0.0] * 15), (604, [0.0] * 16), (700, [0.5, 0.25]), (701, [1.0, -1.0]), (800, []), (801, []), (None, rows[0][1]), (7, rows[9][1]), (7, rows[7][1]), (100, rows[7][1])]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = {(x.query_id, x.rank): (x.vec_id, x.score) for x in maxscore.top_products(t, t.where("vec_id % 100 = 0"), 10, block).collect()}
    assert got == plain_products(rows, 10)
    none = t.limit(0)
    assert maxscore.top_products(none, none).collect() == [] and maxscore.top_products(t, none).collect() == []


@pytest.mark.parametrize("scale", [1.0, 3e4, 1e9, 1e18, 1e300])
def test_products_of_any_size_are_exact(spark, scale):
    r = np.random.default_rng(4)
    rows = [(i, (r.normal(0, 1, 5) * scale).tolist()) for i in range(90, 140)]
    t = spark.createDataFrame(rows, "vec_id long, embedding array<double>").coalesce(1)
    got = {(x.query_id, x.rank): (x.vec_id, x.score) for x in maxscore.top_products(t, t.where("vec_id % 100 = 0")).collect()}
    if scale < 1e9:
        assert got == plain_products(rows, 10)
    else:  # beyond 64 bits scores are told as the end of their range, and tie there
        assert {q: s for q, (_, s) in got.items()} == {q: s for q, (_, s) in plain_products(rows, 10).items()}


def test_weak_terms_are_probed_and_shards_skipped():
    r = np.random.default_rng(6)
    x = r.normal(0, 100, (4000, 32)).astype(np.int64)
    x[:, 16:] //= 50  # weak terms
    top = maxscore.TopK(np.array([10_000]), np.array([x[5]]), 10)
    found = []
    for at in range(0, 4000, 500):
        shard = maxscore.Shard(np.arange(at, at + 500), x[at : at + 500])
        found.append(len(top._found(0, shard, np.float64)[0]))
        top.add(shard)
    scores = (x @ x[5]).tolist()
    assert top.best[0] == sorted(zip((-s for s in scores), range(4000), strict=True))[:10]
    assert found[0] == 500 and max(found[1:]) < 50
    assert len(top._found(0, maxscore.Shard(np.arange(500), x[:500] // 50), np.float64)[0]) == 0  # its bounds add up to less


# spellings


def plain_near(words):
    def near(a, b):
        rows = [list(range(len(b) + 1))]
        for i, x in enumerate(a, 1):
            rows.append([i])
            for j, y in enumerate(b, 1):
                rows[i].append(min(rows[i - 1][j] + 1, rows[i][j - 1] + 1, rows[i - 1][j - 1] + (x != y)))
        return rows[-1][-1] == 1

    out = {a: [] for a in words}
    for i, a in enumerate(words):
        for b in words[i + 1 :]:
            if abs(len(a) - len(b)) < 2 and near(a, b):
                out[a].append(b)
                out[b].append(a)
    return out


def plain_groups(counts):
    near, out = plain_near(sorted(counts)), {}
    forms = {}
    for w, n in counts.items():
        best = min(((-counts[x], x) for x in near[w]), default=None)
        forms[w] = best[1] if best and -best[0] >= 10 * n else None
    for w, n in counts.items():
        root = w
        while forms[root]:
            root = forms[root]
        out[w] = (forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None)
    return out


def vocabulary_of(seed, letters, low, high, n=25):
    r = random.Random(seed)
    words = set()
    for _ in range(n):
        w = "".join(r.choice(letters) for _ in range(r.randint(low, high)))
        for _ in range(8):
            words.add(w)
            at, kind = r.randrange(len(w)), r.random()
            w = w[:at] + ("" if kind < 0.3 and len(w) > 7 else r.choice(letters)) + w[at + (kind < 0.6) :] if kind < 0.9 else w
            if len(w) < 7:
                w += "a" * 7
    return {w: r.choice([2, 3, 25, 30, 400, 5000]) for w in words}


@pytest.mark.parametrize(("letters", "low", "high", "size", "most"), [("ab", 7, 9, 1024, 50_000), ("abcé", 7, 12, 7, 50_000), ("aÿz", 60, 70, 16, 50_000), ("abc", 7, 10, 2, 5)])
def test_spellings_are_brute_force(spark, letters, low, high, size, most):
    counts = vocabulary_of(len(letters) + size, letters, low, high)
    rows = spelling.spelling_groups(spark.createDataFrame(list(counts.items()), "word string, n long"), 10, size, most).collect()
    assert {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in rows} == plain_groups(counts) and len(rows) == len(counts)


def test_ranges_are_skipped_by_their_shared_prefix():
    words = sorted({f"{a}{b}aaaaa{c}{d}" for a in "abcdefgh" for b in "abcdefgh" for c in "abcdefgh" for d in "abcdefgh"})
    cut = [words[i : i + 16] for i in range(0, len(words), 16)]
    firsts, lasts = [b[0] for b in cut], [b[-1] for b in cut]
    assert len(spelling.reached("aaaaaaabb", 4, firsts, lasts)) == 4 and len(cut) == 256  # of those with the same first letters
    assert len(spelling.reached("aaaaaaabb", 0, firsts, lasts)) < 70
    block = spelling.SortedWords(words)
    assert sorted(words[w] for _, w in block.pairs(["aaaaaaabb"], [0])) == [w for w in words if spelling.one_edit(w, "aaaaaaabb")]


def test_edits_of_long_words():
    a = "x" * 300_000
    assert spelling.one_edit(a, a + "y") and spelling.one_edit(a, a[:-1]) and spelling.one_edit(a[:9] + "b" + a[10:], a)
    assert not spelling.one_edit(a, a) and not spelling.one_edit(a[:9] + "b" + a[11:] + "c", a) and not spelling.one_edit(a, a + "yy")
    block = spelling.SortedWords(sorted([a, a + "b", "b" + a, "short" * 3]))
    assert sorted((q, block.words[w] == a) for q, w in block.pairs([a], [4])) == [(0, False)]


def test_words_of_texts(spark):
    text = "Ärgernis ärgernis ARGERNIS argernis, argernis2argernis naïveté-naïveté short"
    rows = [(1, text), (1, text), (None, "argernis"), (4, None), (5, ""), (6, "12 %"), (7, "Q" * 50_000 + " " + "z" * 2_000_000), (8, "q" * 50_000)]
    got = {r.word: r.n for r in spelling.vocabulary(spark.createDataFrame(rows, "doc_id long, text string").withColumn("word", F.lit("own"))).collect()}
    want = Counter()
    for d, t in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if d is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            want[run] += 1
    assert got == {w: n for w, n in want.items() if len(w) >= 7 and n >= 2}
    assert any(spelling.spellings(d, "argernis") == Counter({"argernis"[: h % 8] + "argernis"[h % 8 + 1 :]: 1}) for d in range(200) if (h := zlib.crc32(f"{d}:argernis".encode())) % 31 == 0)


def test_no_words_no_groups(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.spelling_groups(spelling.vocabulary(none)).collect() == []


def test_forms_are_followed_to_the_last(spark):
    links = [(f"w{i}", f"w{i + 1}") for i in range(19)] + [("x", "w7"), ("y", "w19")]
    assert {r.word: r.root for r in spelling.roots(spark.createDataFrame(links, "word string, form string")).collect()} == {w: "w19" for w, _ in links}
