"""Rules of URLs whose baskets hold more items than FP-growth takes at once: none is dropped."""

import random
import zlib

import pytest

from wardgraph.llm import url_rules

SCHEMA = "host string, path string, label string"


def shortest(rules):
    out = {}
    for key in sorted(rules, key=lambda k: (len(k), sorted(k))):
        conf, sup, label = rules[key]
        if not any(r[0] == label and r[1] >= conf and k < key for k, r in out.items()):
            out[key] = (label, conf, sup)
    return out


def brute(urls, support, confidence, lift=1.2):
    """The rules of both kinds among all sets of tokens."""
    baskets = [(set(url_rules.tokens(h, p)), y, zlib.crc32(url_rules.site_of(h).encode()) % url_rules.PARTS) for h, p, y in urls]
    rows = lambda test: sum(1 << i for i, b in enumerate(baskets) if test(*b))
    every = {rows(lambda b, *_, t=t: t in b): t for t in sorted({t for b, *_ in baskets for t in b}, reverse=True)}
    items, labels = [(t, at) for at, t in every.items()], {y for _, y, _ in baskets if y is not None}
    of = {y: rows(lambda _, x, __, y=y: x == y) for y in labels}
    given, parts = sum(of.values()), [rows(lambda *b, p=p: b[2] == p) for p in {b[2] for b in baskets}]
    sure, wide, todo = {}, {}, [(frozenset(), (1 << len(urls)) - 1, 0)]
    while todo:
        key, at, start = todo.pop()
        for y in labels if key else ():
            hits, all_given = (at & of[y]).bit_count(), (at & given).bit_count()
            if hits < support * len(urls):
                continue
            if hits >= confidence * at.bit_count():
                sure[key] = max(sure.get(key, (0,)), (hits / at.bit_count(), hits / len(urls), y))
            top = max(((at & of[y] & p).bit_count(), (at & given & p).bit_count()) for p in parts)
            least = max(confidence, lift * of[y].bit_count() / given.bit_count())
            if hits > top[0] and hits >= least * all_given and hits - top[0] >= least * (all_given - top[1]):
                wide[key] = max(wide.get(key, (0,)), (hits / all_given, hits / len(urls), y))
        for j in range(start, len(items)):
            if any((at & items[j][1] & x).bit_count() >= support * len(urls) for x in of.values()):
                todo.append((key | {items[j][0]}, at & items[j][1], j + 1))
    return shortest(sure), shortest(wide)


def fitted(model):
    return [{frozenset(r[0]): r[1:] for r in rules} for rules in (model.rules, model.wider)]


def wide_urls(seed, n, words, keep, unlabelled):
    """URLs of many words that go together, of which x, or y with w1, mostly make a URL bad."""
    rnd, rows = random.Random(seed), []
    for _ in range(n):
        own = [f"w{i}" for i in range(words) if rnd.random() < keep] + rnd.sample(["x", "y", "z", "q"], 2)
        bad = "x" in own or ("w1" in own and "y" in own) or rnd.random() < 0.2
        label = None if rnd.random() < unlabelled else "block" if bad else rnd.choice(["allow", "maybe"])
        rows.append((f"{rnd.choice(['a.', 'b.', ''])}s{rnd.randrange(5)}.org", "/" + "/".join(own), label))
    return rows


@pytest.mark.parametrize("seed, support, confidence, keep, unlabelled", [(1, 0.05, 0.6, 0.8, 0.1), (2, 0.05, 0.4, 0.95, 0.1), (3, 0.03, 0.8, 0.6, 0.4)])
def test_split_baskets_give_the_rules_of_all_sets(spark, seed, support, confidence, keep, unlabelled):
    urls = wide_urls(seed, 150, 6, keep, unlabelled)
    want = list(brute(urls, support, confidence))
    assert want[0] or want[1]
    for most in (0, 3, 10):
        assert fitted(url_rules.UrlRules.fit(spark.createDataFrame(urls, SCHEMA), support, confidence, most)) == want, most


def test_rules_of_the_commonest_of_many_items(spark):
    """x and y are the commonest items of baskets of some thirteen, and only together say that a URL is bad."""
    rnd, urls = random.Random(4), []
    for i in range(600):
        x, y = rnd.random() < 0.75, rnd.random() < 0.75
        own = [f"w{j}" for j in range(16) if rnd.random() < 0.65] + ["x"] * x + ["y"] * y
        urls.append((f"s{i % 7}.org", "/" + "/".join(own), None if rnd.random() < 0.02 else "block" if x and y else "allow"))
    assert sum(len(url_rules.tokens(h, p)) > 11 for h, p, _ in urls) > 400
    model = url_rules.UrlRules.fit(spark.createDataFrame(urls, SCHEMA), support=0.2)
    assert fitted(model) == list(brute(urls, 0.2, 0.8))
    assert ("path:x", "path:y") in {r[0] for r in model.wider if r[1] == "block"}
    assert model.judge("new.biz", "/x/y")[0] == "block" and model.judge("new.biz", "/x/w1")[0] == "allow"


def test_long_rules_are_compared_in_no_more_than_their_number():
    tokens = tuple(f"path:{i:02}" for i in range(40))
    rules = {tokens[: n + 1]: (0.8 + n / 1000, 0.1, "block") for n in range(40)} | {tokens[1:]: (0.7, 0.1, "allow"), tokens[5:]: (0.7, 0.1, "allow")}
    assert {r[0] for r in url_rules._shortest(rules)} == rules.keys() - {tokens[1:]}
