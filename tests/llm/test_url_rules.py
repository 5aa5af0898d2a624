import itertools
import re
import time

import pytest
from pyspark.sql import functions as F

from salestide.llm import url_rules

DATA = "/root/testdata/sf0.001/pages.parquet"
ODD = [
    None, "", "no scheme", "://", "http://", "HTTP://A.NET", "http://A.NET/", "http://a.net?x=/", "http://x.example.NET/en/1",
    "http://example.net/en", "http://notexample.com/de/1", "http://example.com/de/", "http://EXAMPLE.com/DE/", "http://a.org/fr/x",
    "http://org/fr/", "http://aorg/fr/", "x://y://z/en/", "http://a.b.net:80/p#q?r", "http://a.net/\n/de", "http://É.net/",
    "http://example.net/en/?a=1&b=2&a=3#f",
]


def split_by_hand(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    return "".join(c.lower() if c.isascii() else c for c in host), path


def stated_by_hand(host, path):
    fitting = [
        r for r in url_rules.STATED if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)
    ]
    return max(fitting, key=lambda r: len(r.name), default=None)


def spelled(token):
    """Whether a stated rule spells the token."""
    sites = [".".join(r.host.split(".")[-2:]) for r in url_rules.STATED]
    segments = [x for r in url_rules.STATED for x in r.path.split("/") if x]
    kind, word = token.split(":", 1)
    return kind == "site" and any(word == s or word.endswith("." + s) for s in sites) or kind == "path" and word in segments


def rules_by_hand(baskets, min_support, min_confidence):
    """All rules by trying all combinations; of combinations that the same URLs have, the largest stands for all."""
    least = -(-min_support * len(baskets) // 1)
    both, alone = {}, {}
    for tokens, verdict in baskets:
        for size in range(1, len(tokens) + 1):
            for some in itertools.combinations(tokens, size):
                alone[some] = alone.get(some, 0) + 1
                both[some, verdict] = both.get((some, verdict), 0) + 1
    holders = {}
    for token in {t for tokens, _ in baskets for t in tokens}:
        holders.setdefault(frozenset(i for i, (tokens, _) in enumerate(baskets) if token in tokens), set()).add(token)
    whole = lambda some: all(len(group & set(some)) in (0, len(group)) for group in holders.values())
    return {
        (some, verdict): n / alone[some] for (some, verdict), n in both.items()
        if n >= least and n / alone[some] >= min_confidence and whole(some)
    }


def judged_by_hand(tokens, rules, support):
    fitting = [
        (confidence, len(some), support[some, verdict], verdict == "allow", list(some), verdict)
        for (some, verdict), confidence in rules.items() if set(some) <= set(tokens)
    ]
    return max(fitting)[-1] if fitting else "allow"


@pytest.mark.parametrize("support", [0.05, 0.2])
def test_verdicts_equal_brute_force(spark, support):
    rows = [(r.page_id, r.url) for r in spark.read.parquet(DATA).collect()] + [(1000 + i, u) for i, u in enumerate(ODD)]
    pages = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, host string, verdict string")
    token_sets = {
        r.page_id: tuple(r.t) for r in pages.select("page_id", url_rules.tokens(F.col("url")).alias("t")).collect() if r.t is not None
    }
    baskets = []
    for page, url in rows:
        rule = stated_by_hand(*split_by_hand(url))
        if rule:
            baskets.append((tuple(t for t in token_sets[page] if not spelled(t)), rule.verdict))
    rules = rules_by_hand(baskets, support, 0.9)
    share = {(some, v): sum(set(some) <= set(t) and w == v for t, w in baskets) / len(baskets) for some, v in rules}
    got = {r.page_id: r for r in url_rules.judge(pages.repartition(3), min_support=support).collect()}
    assert len(got) == len(rows)
    for page, url in rows:
        host, path = split_by_hand(url)
        rule = stated_by_hand(host, path)
        r = got[page]
        assert (r.host, r.path, r.rule) == (host, path, rule.name if rule else None)
        tokens = token_sets.get(page, ()) if url and "://" in url else ()
        assert r.verdict == (rule.verdict if rule else judged_by_hand(tokens, rules, share)), url


def test_a_hot_template_of_many_segments(spark):
    """Half of the labelled URLs are of one template of 25 segments that says nothing; what decides stands beside it."""
    path = "/".join(f"seg{chr(97 + i)}" for i in range(25))
    rows = [(f"http://t.example.com/{path}/{'bad' if i % 2 else 'good'}/{i}", "block" if i % 2 else "allow") for i in range(60)]
    rows += [(f"http://s{i}.example.com/other/{i}", "allow") for i in range(60)]
    labelled = spark.createDataFrame(rows, "url string, verdict string")
    pages = spark.createDataFrame([(1, f"http://new.example.com/{path}/bad/"), (2, f"http://new.example.com/{path}/"), (3, "http://x.example.com/bad/")], "page_id long, url string")
    began = time.perf_counter()
    got = {r.page_id: r for r in url_rules.judge(pages, rules=(), labelled=labelled).collect()}
    assert time.perf_counter() - began < 20
    assert {k: r.verdict for k, r in got.items()} == {1: "block", 2: "allow", 3: "block"}
    rules = url_rules.mine(labelled.select(url_rules.tokens(F.col("url")).alias("tokens"), "verdict"))
    assert rules.count() < 40


def test_a_stated_rule_is_no_evidence_for_its_own_words(spark):
    """All labelled pages of a site are those that a rule about one of its folders blocks: that says nothing of its other folders."""
    rows = [(i, f"http://w{i}.example.com/de/x") for i in range(40)] + [(100 + i, f"http://a.org/fr/{i}") for i in range(40)]
    rows += [(500, "http://w500.example.com/en/y"), (501, "http://b.org/en/y")]
    got = {r.page_id: r for r in url_rules.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert got[500].verdict == got[501].verdict == "allow" and got[500].mined is None
    assert got[1].verdict == "block" and got[101].verdict == "allow"


def test_given_labels_teach_combinations(spark):
    labelled = spark.createDataFrame(
        [(f"http://s{i}.example.com/{a}/{b}/", "block" if (a, b) == ("x", "y") else "allow") for i in range(5) for a in "xz" for b in "yw"],
        "url string, verdict string",
    )
    pages = spark.createDataFrame([(1, "http://new.example.com/x/y/"), (2, "http://new.example.com/x/w/"), (3, None), (3, None)], "page_id long, url string")
    got = url_rules.judge(pages, rules=(), labelled=labelled, min_support=0.1)
    assert sorted((r.page_id, r.verdict) for r in got.collect()) == [(1, "block"), (2, "allow"), (3, "allow"), (3, "allow")]


def test_a_verdict_that_needs_five_tokens(spark):
    def url(parts):
        return "http://s.example.com/" + "/".join(parts) + "/"

    words = ["aa", "bb", "cc", "dd", "ee"]
    part = [url(words[:i] + [f"no{n}"] + words[i + 1 :]) for i in range(5) for n in range(4)]
    labelled = spark.createDataFrame([(url(words), "block")] * 20 + [(u, "allow") for u in part], "url string, verdict string")
    pages = spark.createDataFrame([(1, url([*words, "new"])), (2, url([*words[:4], "new"]))], "page_id long, url string")
    got = {r.page_id: r for r in url_rules.judge(pages, rules=(), labelled=labelled, min_support=0.1).collect()}
    assert got[1].verdict == "block" and {f"path:{w}" for w in words} <= set(got[1].mined.split()) and got[2].verdict == "allow"


def test_empty_tables_and_no_labels(spark, monkeypatch):
    none = spark.createDataFrame([], "page_id long, url string")
    assert url_rules.judge(none).count() == 0
    only = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    assert [r.verdict for r in url_rules.judge(only).collect()] == ["allow"]
    monkeypatch.setattr(url_rules, "MAX_BROADCAST_RULES", 0)
    two = spark.createDataFrame([(1, "http://a.net/x/"), (2, "http://a.net/x/"), (3, "http://a.com/x/"), (4, "http://net/")], "page_id long, url string")
    assert {r.page_id: r.verdict for r in url_rules.judge(two).collect()} == {1: "block", 2: "block", 3: "block", 4: "block"}
