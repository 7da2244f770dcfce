"""Each operator against brute force, round trips or held-out accuracy, and on awkward tables."""

import hashlib
import random
import re
import zlib
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from wardgraph.llm import ann, chat, decontam, lang_id, materialise, near_dup, packing, quality, secrets, tokens, url_rules
from wardgraph.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, __x string"
ODD = [(1, None, None, "a"), (2, "", "en", "b"), (3, " \n\t", "en", "c"), (4, "x" * 5000, None, "d"), (None, "the same words again and again", "en", "e"), (6, "the same words again and again", "en", None), (6, "the same words again and again", "en", None), (7, "12 !? --", "fr", "")]


def docs_of(spark, rows=ODD):
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return docs_of(spark, [])


# language


def test_language_accuracy(spark):
    df = QUERIES["op1_language_id"](spark, SF)
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()}
    rows = [r for r in df.collect() if r.held_out]
    assert rows and all(zlib.crc32(str(r.doc_id).encode()) % 5 == 0 for r in rows)
    assert sum(r.lang_pred == lang[r.doc_id] for r in rows) / len(rows) >= 0.95


def test_language_odd(spark):
    model = lang_id.LanguageModel.fit(docs_of(spark))
    rows = lang_id.identify(docs_of(spark), model).collect()
    assert len(rows) == len(ODD) and [r["__lang"] for r in rows[:3]] == ["und"] * 3
    assert all(0 <= r["__score"] <= 1 for r in rows) and rows[7]["__lang"] == "und"
    none = lang_id.LanguageModel.fit(empty(spark))
    assert none.predict(["a", None]) == (["und", "und"], [0.0, 0.0])
    assert lang_id.identify(empty(spark), model).count() == 0


def test_kernel_is_the_blended_presence_kernel():
    texts = ["the cat sat", "le chat noir", "the dog"]
    marks = np.zeros(3 * lang_id.BUCKETS, bool)
    sets = [set(lang_id._marks(t, marks).tolist()) for t in texts]
    model = lang_id.LanguageModel(["a"], np.unique([b for s in sets for b in s]).astype(np.int64), np.empty((0, 0)), np.empty((0, 0)))
    rows = [model._row(np.array(sorted(s)), model.vocab) for s in sets]
    for i, j in combinations(range(3), 2):
        want = 0
        for n in range(3):
            a, b = ({x for x in sets[k] if x // lang_id.BUCKETS == n} for k in (i, j))
            want += len(a & b) / (len(a) * len(b)) ** 0.5 / 3
        assert rows[i] @ rows[j] / 3 == pytest.approx(want, rel=1e-5)


# decontamination


def brute_hits(text, items):
    w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, t in items:
        iw = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        n = min(10, len(iw))
        wins = {tuple(iw[i : i + n]) for i in range(len(iw) - n + 1)} if n else set()
        for i in range(len(w) - n + 1):
            if n and tuple(w[i : i + n]) in wins:
                hit.update(range(i, i + n))
                found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("block", [64 << 20, 400])
def test_contamination_is_brute_force(spark, block):
    rnd = random.Random(2)
    vocab = ["a", "B", "c1", "dé", "the", "É"]
    text = lambda n: rnd.choice([" ", ", ", "\n"]).join(rnd.choice(vocab) for _ in range(n))
    items = [(i, text(rnd.choice([0, 1, 3, 6, 9, 10, 12, 30]))) for i in range(12)] + [(50, "a " * 40), (51, None), (51, "dup dup dup dup dup dup dup dup dup dup")]
    rows = [(i, text(rnd.choice([0, 3, 40])) + " " + (items[rnd.randrange(12)][1] or "") + " " + text(5), "en", "") for i in range(40)] + [(90, "a " * 300, "en", ""), (91, "dup " * 30, None, ""), (91, "dup " * 30, None, "")]
    got = decontam.contamination(docs_of(spark, rows + ODD), spark.createDataFrame(items, "item_id long, text string"), block)
    have = sorted((r.doc_id is None, r.doc_id or 0, r.n_words, sum(s.end - s.start for s in r.spans), r["items"]) for r in got.collect())
    want = sorted((i is None, i or 0, *brute_hits(t, items)) for i, t, *_ in rows + ODD)
    assert have == want


@pytest.mark.parametrize("block", [64 << 20, 2000])
def test_clean_documents_are_those_without_hits(spark, block):
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    docs = docs.union(docs.limit(3)).union(docs.limit(1).withColumn("text", F.lit(None).cast("string")).withColumn("doc_id", F.lit(None).cast("long")))
    items = items.where("item_id % 2 = 0") if block == 2000 else items
    want = [r.doc_id for r in decontam.contamination(docs, items).collect() if not r["items"]]
    got = decontam.clean_documents(docs, items, block)
    assert got.columns == docs.columns and sorted((r.doc_id for r in got.collect()), key=str) == sorted(want, key=str) and 0 < len(want) < docs.count()


def test_more_items_than_an_index_holds_join_by_shuffle(spark, monkeypatch):
    """Fingerprints joined by shuffle equal the broadcast index, with a filter that lets nearly all pass, rows that go on, and copies."""
    docs, items = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text"), spark.read.parquet(f"{SF}/benchmark.parquet")
    one = items.orderBy("item_id").first()
    docs = docs.union(docs.limit(3)).union(spark.createDataFrame([(i, one.text) for i in (7, 7, None, 70_001)] + [(70_002, (one.text + " ") * 2000)], "doc_id long, text string"))
    order = lambda df: sorted(map(repr, df.collect()))
    want = order(decontam.contamination(docs, items))
    for most in (decontam.FILTER_BYTES, 128):
        got = decontam.contamination(docs, items, 4000, most)
        assert order(got) == want, most
        assert "BroadcastNestedLoopJoin" not in got._sc._jvm.PythonSQLUtils.explainString(got._jdf.queryExecution(), "simple")


def test_filter_never_says_no_wrongly():
    rnd = np.random.default_rng(3)
    h = rnd.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    table = np.zeros(1 << 8, np.uint64)
    for at in np.concatenate([h, h >> np.uint64(32)]) & np.uint64((1 << 14) - 1):
        table[int(at) >> 6] |= np.uint64(1) << (at & np.uint64(63))
    assert decontam.likely(h, table).all()
    assert decontam.likely(rnd.integers(0, 1 << 63, 5000, dtype=np.uint64), table).mean() < 0.05
    assert [x.tolist() for x in decontam.merged_spans(np.array([30, 0, 5, 15, 0]), np.array([40, 10, 15, 20, 3]))] == [[0, 30], [20, 40]]


def test_winnowing_guarantee():
    rnd = np.random.default_rng(1)
    shared = rnd.integers(0, 5, 10)
    for _ in range(200):
        a, b = (np.concatenate([rnd.integers(0, 5, rnd.integers(0, 20)), shared, rnd.integers(0, 5, rnd.integers(0, 20))]) for _ in range(2))
        prints = []
        for x in (a, b):
            h = decontam.gram_hashes(x.astype(np.int32), 5)
            prints.append(set(h[decontam.winnow(h, 6)].tolist()))
        assert prints[0] & prints[1]


def test_contamination_without_items(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r["items"] == [] for r in decontam.contamination(docs_of(spark), none).collect())
    assert decontam.contamination(empty(spark), none).count() == 0


# URL rules


def brute_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    path = re.split(r"[?#]", rest[len(host) :], maxsplit=1)[0]
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    fit = [h + p for h, p, _ in url_rules.HOST_RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return host, path, max(fit, key=len, default=None)


def test_url_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.COM/en/1?x", "https://www.example.com/en/", "http://example.com", "http://net/es/", "http://x.net/fr/a#b", "http://notcom/", "a://b://c.com/x", "http://x.org/es/1\n2", "http://x.com?/en/"]
    rows = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    host, path = url_rules.host_of(F.col("url")), url_rules.path_of(F.col("url"))
    for r in rows.select("url", host.alias("h"), path.alias("p"), url_rules.fixed_rule(host, path).alias("r")).collect():
        assert (r.h, r.p, r.r) == brute_rule(r.url), r.url


def test_mined_rules_match_by_subset(spark):
    pages = [("a.net", "/es/1", "block")] * 40 + [("b.org", "/en/2", "allow")] * 60 + [("c.net", "/en/3", "allow")] * 10
    model = url_rules.UrlRules.fit(spark.createDataFrame(pages, "host string, path string, label string"))
    for host, path in {(h, p) for h, p, _ in pages} | {("z.net", "/es/9"), ("q.biz", "/")}:
        own = set(url_rules.tokens(host, path))
        fit = [r for r in model.rules if own.issuperset(r[0])]
        assert model.judge(host, path)[0] == (min(fit, key=lambda r: (-r[2], -r[3], -len(r[0]), r[0], r[1]))[1] if fit else "allow")
    assert model.judge("z.net", "/es/9")[0] == "block"
    assert url_rules.UrlRules.fit(spark.createDataFrame([], "host string, path string, label string")).judge("a", "b") == ("allow", None, None)


def test_words_of_every_folder_are_mined(spark):
    pages = [("a.org", f"/x/y/{i}/casino/offer", "block") for i in range(40)] + [("a.org", f"/x/y/{i}/garden/offer", "allow") for i in range(60)]
    model = url_rules.UrlRules.fit(spark.createDataFrame(pages, "host string, path string, label string"))
    assert model.judge("b.org", "/p/q/r/casino/s")[:2] == ("block", "path:casino")
    assert model.judge("b.org", "/p/q/r/garden/s")[:2] == ("allow", "path:garden")


def test_url_query(spark):
    pages = {r.page_id: r.url for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = QUERIES["op3_url_filter"](spark, SF).collect()
    assert len(rows) == len(pages)
    verdict = {h + p: v for h, p, v in url_rules.HOST_RULES}
    for r in rows:
        assert (r.host, r.path, r.rule) == brute_rule(pages[r.page_id]) and (r.rule is None or r.verdict == verdict[r.rule])


# secrets


def test_secret_spans(spark):
    key = "AKIA" + "A1B2" * 5
    text = f'é password: "abc123XYZ" tOken=abc Api-key api_key="zzzzzz" {key} {"0a" * 15} xQ7pL0vB9zR2tY5wE8kM plainwordplainwordplainword'
    base = [(m.start(), "assign", m.end()) for m in secrets._ASSIGN.finditer(text) if len(m[2]) >= 6]
    assert [text[s:e] for s, _, e in base] == ['password: "abc123XYZ', 'api_key="zzzzzz']
    rows = [(i, f"ordinary identifiers like some_name{i % 7} and otherNames in plain sentences", "en", "") for i in range(50)] + [(99, text, "en", "")]
    docs = docs_of(spark, rows + ODD)
    found = {r.doc_id: r["__spans"] for r in secrets.secret_spans(docs, secrets.SecretModel.fit(docs)).collect()}
    got = [(s.kind, text[s.start : s.end]) for s in found[99]]
    assert ("access", key) in got and ("hex", "0a" * 15) in got and ("markov", "xQ7pL0vB9zR2tY5wE8kM") in got and len(got) == 5
    assert not any(v for k, v in found.items() if k != 99)
    out = secrets.secret_spans(docs, secrets.SecretModel.fit(docs)).select("doc_id", "text", secrets.redacted(F.col("text"), F.col("__spans")).alias("r")).where("doc_id = 99").first()
    assert out.r.count("<SECRET>") == 5 and "abc123" not in out.r and out.r.startswith("é <SECRET>")
    assert secrets.secret_spans(empty(spark), secrets.SecretModel.fit(empty(spark))).count() == 0


def test_runs_of_any_length_and_parts_of_runs_are_judged(spark):
    short, letters, left, right = "k3J9s0Lq1mZ", "qZxWvKjPqRtYbNmLhG", "xQ7pL0vB9zR2tY5wE8kM", "Qw8Rt5Yk2Pz7Lx3Vb6N"
    text = f"see {short} and {letters} then {left}{'0a' * 15}{right} plainwordplainwordplainword"
    rows = [(i, f"ordinary identifiers like some_name{i % 7} and otherNames in plain sentences, then see plain words", "en", "") for i in range(50)]
    model = secrets.SecretModel.fit(docs_of(spark, rows + [(98, "f3" * 20, "en", "")]))
    found = {r.doc_id: [(s.kind, r.text[s.start : s.end]) for s in r["__spans"]] for r in secrets.secret_spans(docs_of(spark, [*rows, (99, text, "en", "")]), model).collect()}
    assert found[99] == [("markov", short), ("markov", letters), ("markov", left), ("hex", "0a" * 15), ("markov", right)]
    assert not any(v for k, v in found.items() if k != 99)
    # sums of long texts are made in stretches
    rnd = np.random.default_rng(3)
    code = np.concatenate([secrets._codes("".join(map(chr, rnd.integers(0x20, 0x7F, 1 << 20)))), np.full(1 << 20, ord("q") - 0x21, np.uint8), secrets._codes(" aZ9 x")])
    model = secrets.SecretModel(rnd.normal(0.5, 1, (94, 94)), least=3.0, least_mean=0.7)
    key = secrets._KEY[code].astype(np.int8)
    edges = np.flatnonzero(np.diff(key, prepend=0, append=0))
    sums = [(s, e, model.ratio[code[s : e - 1], code[s + 1 : e]].sum()) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True)]
    assert list(model._runs(code)) == [(s, e) for s, e, x in sums if x >= 3.0 and x >= 0.7 * (e - s)]


# tokens and packing


def test_cached_ids_are_the_tokenizers_own():
    texts = ["Σίσυφος ΣΑΣ İstanbul", "it's don't 'sound \"'s x's", "<|endoftext|>a", "é ́ ﬁ ½²Ⅷ", "a\x1cb", "日本語　x", "", "🙂👍🏽 ok", " \n\t", "AbC123 4x4"]
    word, byte = tokens.loaded(tokens.WordBpe, tokens.WORD_BPE), tokens.loaded(tokens.ByteBpe, tokens.BYTE_BPE)
    for _ in range(2):
        for t in texts:
            assert np.frombuffer(word.encode(t), "<u4").tolist() == word.tokenizer.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(byte.encode(t), "<u2").tolist() == byte.encoding.encode_ordinary(t)


def test_control_bytes_keep_their_ids():
    word = tokens.WordBpe(tokens.public_tokenizers.path(tokens.WORD_BPE))
    for c in map(chr, range(0x80)):
        for t in (c, f"a{c}b", f"x{c}[0m", f"{c}{c} word{c}", f"é{c}ß"):
            want = word.tokenizer.encode(t, add_special_tokens=False).ids
            assert np.frombuffer(word.encode(t), "<u4").tolist() == want, (t, want)


def test_histogram_packing_is_best_fit_decreasing():
    rnd = random.Random(4)
    for _ in range(20):
        sizes = [rnd.randint(1, 16) for _ in range(rnd.randint(1, 60))]
        counts = {s: sizes.count(s) for s in sizes}
        used = {}
        for length, rank, n, seq, offset in packing.best_fit_decreasing(counts, 16):
            for i in range(n):
                assert used.setdefault(seq + i, 0) == offset
                used[seq + i] += length
        bins = []
        for s in sorted(sizes, reverse=True):
            fit = [b for b in bins if b + s <= 16]
            if fit:
                best = max(fit)
                bins[bins.index(best)] += s
            else:
                bins.append(s)
        assert sorted(used.values()) == sorted(bins)


def test_packing_rebuilds_every_document(spark):
    rows = ODD + [(i, "word " * (i * 37), "en", "") for i in range(10, 30)]
    enc = tokens.loaded(tokens.WordBpe, tokens.WORD_BPE)
    got = packing.packed_pieces(docs_of(spark, rows), window=256).collect()
    ids = [np.frombuffer(enc.encode(t), "<u4").tolist() + [1] for _, t, *_ in rows]
    assert sum(r.length for r in got) == sum(map(len, ids))
    by_doc = {i: x for (i, *_), x in zip(rows, ids, strict=True)}
    places = {}
    for r in got:
        piece = by_doc[r.doc_id][r.start : r.start + r.length]
        assert len(piece) == r.length and zlib.crc32(np.array(piece, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(by_doc[r.doc_id])
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for p in places.values():
        p.sort()
        assert [o for o, _ in p] == [sum(n for _, n in p[:i]) for i in range(len(p))] and sum(n for _, n in p) <= 256
    assert packing.packed_pieces(empty(spark)).count() == 0


# materialisation


def test_permutation_is_a_bijection():
    for n in (1, 2, 3, 17, 1000, 4097):
        for key in (0, 5):
            assert sorted(materialise.Permutation(n, key)(np.arange(n)).tolist()) == list(range(n))
    assert materialise.Permutation(1000, 1)(np.arange(9)).tolist() != materialise.Permutation(1000, 2)(np.arange(9)).tolist()


def test_shards_hold_all_ids_in_order_of_slots(spark, tmp_path):
    rows = [(i, f"text number {i} " * (i % 40), "en", "") for i in range(200)] + ODD
    path = f"file://{tmp_path}/shards"
    docs = docs_of(spark, rows).repartition(3)
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = materialise.write_training_order(docs, path, length=64, per_shard=32).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    index = sorted({(min(x.slot for x in got if x.shard == r.shard), r.shard) for r in got})
    data = materialise.read_training_order(index, path, 0, len(got), length=64)
    enc = tokens.loaded(tokens.ByteBpe, tokens.BYTE_BPE)
    want = np.concatenate([np.append(np.frombuffer(enc.encode(t), "<u2"), 50256) for _, t, *_ in rows])
    have = np.concatenate([data[r.slot][: r.tokens] for r in got])
    assert sorted(have.tolist()) == sorted(want.tolist())
    assert all(zlib.crc32(data[r.slot][: r.tokens].tobytes()) == r.ids_crc32 for r in got)
    again = materialise.write_training_order(docs, path, length=64, per_shard=32).collect()
    assert sorted(again) == sorted(got)
    assert materialise.write_training_order(empty(spark), f"file://{tmp_path}/none").count() == 0


# chat


def test_escape_goes_back():
    for t in ["<|im_end|>", "<\\|", "<\\\\|x", "a<b|c", "<<||", "", "\\", "<|<\\|"]:
        assert chat.unescape(chat.escape(t)) == t and "<|" not in chat.escape(t)


def test_chat_round_trip(spark):
    turns = [(1, 0, "system", ""), (1, 1, "user", "hi\n"), (1, 2, "assistant", " 🙂 \n\n<|im_end|>é"), (1, 2, "assistant", None), (1, 3, None, "x"), (None, 0, "assistant", "lost"), (2, None, "assistant", "\n"), (2, None, "assistant", "\n")]
    rows = chat.formatted_chats(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    tok = chat.tokenizer(chat.TOKENIZER)
    for r in rows:
        mine = sorted((t for t in turns if t[0] == r.conv_id), key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] is not None, t[3] or ""))
        got, loss = chat.read_back(r.formatted, *chat.token_columns(r), tok)
        enc = tok.encode(r.formatted, add_special_tokens=False)
        assert enc.ids == r.ids and enc.offsets == list(zip(r.starts, r.ends, strict=True))
        assert got == [(t[2] or "", t[3] or "") for t in mine]
        assert loss == [t[3] for t in mine if t[2] == "assistant" and t[3]]
    assert len(rows) == 3


def test_long_chat_in_stretches(spark, monkeypatch):
    turns = [(5, i, "assistant" if i % 2 else "user", f"turn {i}") for i in range(1200)] + [(5, None, "user", f"{i:04d}") for i in range(600)]
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    rows = sorted(chat.formatted_chats(df).collect(), key=lambda r: (r.stretch is not None, r.stretch, r.part))
    assert [(r.stretch, r.part) for r in rows] == [(None, 0), (None, 1), (0, 0), (1, 0), (2, 0)]
    assert "".join(r.formatted for r in rows) == chat.render([(t[2], t[3]) for t in turns[1200:] + turns[:1200]])[0]


def test_long_chat_query_is_its_sql(spark, tmp_path):
    import duckdb

    turns = [(5, i, "assistant" if i % 2 else "user", f"turn <|{i}") for i in range(1200)] + [(6, 0, "assistant", None), (6, 1, None, "x"), (None, 0, "assistant", "lost")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = QUERIES["op7_chat_format"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    want = con.sql(f"select {', '.join(got.columns)} from ({ORACLES['op7_chat_format']})").fetchall()
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str) and len(want) == 4


# neighbours


def brute_nearest(rows, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = {}
    for q, qv in {i: min((v.tolist() for j, v in good if j == i)) for i, _ in good if i % 3 == 0}.items():
        best = {}
        for i, v in good:
            if i != q and len(v) == len(qv):
                d = float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, qv, strict=True))))
                best[i] = min(d, best.get(i, d))
        out[q] = sorted((d, i) for i, d in best.items())[:k]
    return out


@pytest.mark.parametrize("block", [8 << 20, 300])
def test_nearest_is_brute_force(spark, block):
    rnd = np.random.default_rng(3)
    rows = [(i, rnd.normal(size=8).tolist()) for i in range(150)] + [(200 + i, [1.0] * 8) for i in range(30)] + [(300, None), (303, [0.0] * 8), (306, [1.0, None]), (309, [float("nan")] * 8), (312, [1.0, 2.0]), (315, [1e-30] * 8), (318, [1e15] * 8), (3, [0.5] * 8), (None, [1.0] * 8)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in ann.nearest(df, df.where("vec_id % 3 = 0"), k=5, block_bytes=block).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.score, r.vec_id))
    want = {q: v for q, v in brute_nearest(rows, 5).items() if v}
    assert {q: [(s, i) for _, s, i in sorted(v)] for q, v in got.items()} == want
    assert ann.nearest(df.limit(0), df.limit(0)).count() == 0


# near-duplicates


def brute_components(rows, k=4, num=80, den=100):
    sets = []
    for i, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append((i, {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())))
    comp = {i: i for i, _ in sets}
    changed = True
    while changed:
        changed = False
        for (a, x), (b, y) in combinations(sets, 2):
            if x and y and den * len(x & y) >= num * len(x | y) and comp[a] != comp[b]:
                comp[a] = comp[b] = min(comp[a], comp[b])
                changed = True
    return {i: (len(s), comp[i]) for i, s in sets}


def near_rows():
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcde") for _ in range(6))
    base = [word() for _ in range(120)]
    rows = [(i, " ".join(w if rnd.random() > p else word() for w in base)) for i, p in enumerate([0, 0.01, 0.02, 0.03, 0.05, 0.08] * 12)]
    rows += [(100 + i, " ".join(word() for _ in range(30))) for i in range(20)] + [(130, "one two"), (131, "One  two\n"), (132, None), (133, ""), (134, " \t"), (135, "x " * 3000)]
    return rows


def test_near_duplicates_are_brute_force(spark, monkeypatch):
    rows = near_rows()
    want = brute_components(rows)
    df = spark.createDataFrame([(i, t, "", "") for i, t in rows], DOCS)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df).collect()} == want
    for size, shared in ((7, 2), (3, 0)):  # many blocks and size classes, both rounds, and keys that are not broadcast
        monkeypatch.setattr(near_dup, "BLOCK_CLASSES", size)
        monkeypatch.setattr(near_dup, "SHARED_CLASSES", shared)
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in near_dup.near_duplicates(df, small_keys=0).collect()} == want


def test_near_duplicates_odd(spark):
    rows = sorted(((r.doc_id is None, r.doc_id or 0, r.component_id) for r in near_dup.near_duplicates(docs_of(spark)).collect()), key=str)
    assert len(rows) == len(ODD) and (True, 0, 6) in rows and (False, 6, 6) in rows and (False, 1, 1) in rows
    assert near_dup.near_duplicates(empty(spark)).count() == 0


def test_intersections_are_exact():
    rnd = np.random.default_rng(5)
    sets = [np.unique(rnd.integers(0, 60, rnd.integers(1, 50)).astype(np.uint64)) for _ in range(25)]
    got = near_dup.intersections(sets)
    for i, j in combinations(range(25), 2):
        assert got[i, j] == len(set(sets[i].tolist()) & set(sets[j].tolist()))


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 30)] + [(100, 101), (102, 101), (7, 7)]
    got = {r.node: r.comp for r in near_dup.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == {**{i: 1 for i in range(1, 31)}, 100: 100, 101: 100, 102: 100}


# quality


def test_quality_ranks_held_out_labels(spark):
    sf = "/root/testdata/sf0.01"
    y = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = [r for r in QUERIES["op10_quality"](spark, sf).collect() if r.held_out and r.doc_id in y]
    good, bad = ([r.score for r in rows if y[r.doc_id] == v] for v in (1, 0))
    assert sum((p > n) + 0.5 * (p == n) for p in good for n in bad) / len(good) / len(bad) >= 0.95


def test_quality_odd(spark):
    labels = spark.createDataFrame([(6, 1), (6, 1), (4, 0), (None, 1), (99, 1), (2, None)], "doc_id long, y int")
    for model in (quality.QualityModel.fit(docs_of(spark), labels), quality.QualityModel.fit(empty(spark), labels.limit(0))):
        rows = quality.quality_scores(docs_of(spark), model).collect()
        assert len(rows) == len(ODD) and all(0 <= r["__quality"] <= 1 for r in rows)


def test_oracles_exist_for_what_sql_can_say():
    assert {"op2_decontaminate", "op7_chat_format", "op8_nearest", "op9_near_dedup"} <= set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", ["op7_chat_format", "op8_nearest", "op2_decontaminate"])
def test_oracle(spark, name):
    duckdb = pytest.importorskip("duckdb")
    c = duckdb.connect()
    for t in ("documents", "benchmark", "conversations", "embeddings"):
        c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    df = QUERIES[name](spark, SF)
    out = c.execute(ORACLES[name])
    at = [[x[0] for x in out.description].index(n) for n in df.columns]
    assert sorted(map(str, (tuple(r) for r in df.collect()))) == sorted(str(tuple(r[i] for i in at)) for r in out.fetchall())


def test_base_digest(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    pats = (("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 6, 2), ("access", re.compile(r"AKIA[A-Z0-9]+"), 20, 0), ("hex", re.compile(r"[0-9a-f]+"), 24, 0))
    for r in QUERIES["op4_secrets"](spark, SF).collect():
        spans = sorted((m.start(), k, m.end(), n) for k, (n, p, least, g) in enumerate(pats) for m in p.finditer(docs[r.doc_id] or "") if len(m[g]) >= least)
        assert r.base_sha256 == hashlib.sha256(",".join(f"{n}:{s}:{e}" for s, _, e, n in spans).encode()).hexdigest()
