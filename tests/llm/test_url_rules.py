"""Mined URL rules against all combinations of tokens, and tables that made mining explode."""

import itertools
import random
import time

import pytest

from tidemark.llm import url_filter


def _verdicts(spark, labelled, urls, **pruning):
    rows = spark.createDataFrame(labelled, "tokens array<string>, label int")
    rules = url_filter.mine_rules(rows, **pruning)
    index = rules.collect()
    return [any(all(set(c) & set(t) for c in r.antecedent) for r in index) for t in urls], index


def _plain(labelled, urls, support, confidence, lift):
    """Every set of tokens that enough labelled rows hold, one by one."""
    rows = [(set(t), y) for t, y in labelled if y in (0, 1) and t]
    total, bad = len(rows), sum(y for _, y in rows)
    least = max(support * total, url_filter.LEAST_ROWS)
    tokens = sorted({x for t, _ in rows for x in t})
    passing = []
    for size in range(1, 5):
        for some in itertools.combinations(tokens, size):
            held = [y for t, y in rows if set(some) <= t]
            share = sum(held) / len(held) if held else 0
            if sum(held) >= least and share >= confidence and share / (bad / total) >= lift:
                passing.append(set(some))
    return [any(p <= set(t) for p in passing) for t in urls]


@pytest.mark.parametrize("seed", range(4))
def test_verdicts_equal_those_of_all_combinations(spark, seed):
    rng = random.Random(seed)
    labelled = []
    for _ in range(160):
        t = [x for x in "abcdef" if rng.random() < 0.45]
        t += ["a1", "a2"] * ("a" in t)                        # always with a: one class
        t += ["all"]                                          # in every row
        y = int(("b" in t and "c" in t) or ("d" in t and rng.random() < 0.75)) if rng.random() < 0.95 else 1
        labelled.append((t, y))
    labelled += [([], 1), (["a"], None)]
    urls = [list(u) for n in range(4) for u in itertools.combinations(["a", "a2", "b", "c", "d", "e", "f", "new"], n)]
    pruning = {"support": 0.05, "confidence": 0.7, "lift": 1.2}
    got, index = _verdicts(spark, labelled, urls, **pruning)
    assert got == _plain(labelled, urls, **pruning) and any(got) and not all(got) and index


def test_shared_query_keys_do_not_explode(spark):
    keys = [f"query=k{k}" for k in range(30)]
    labelled = [(["scheme=https", "host=shop", f"path=p{k}", *keys], 1) for k in range(12)]
    labelled += [(["scheme=https", "host=shop", f"path=q{k}", *keys[:29 - k % 3]], k % 2) for k in range(12)]
    labelled += [(["scheme=https", "host=news", f"path=n{k}"], 0) for k in range(60)]
    begin = time.perf_counter()
    got, index = _verdicts(spark, labelled, [["host=shop", "query=k29"], ["host=news"], ["query=k0"]])
    assert time.perf_counter() - begin < 60 and len(index) < 20
    assert got[0] and not got[1]


def test_pages_are_judged_by_classes(spark):
    labelled = [(["host=a", "host=b", "path=x"], 1)] * 20 + [(["host=a", "host=b", "path=y"], 0)] * 20 \
        + [(["host=c", "path=x"], 0)] * 20
    rules = url_filter.mine_rules(spark.createDataFrame(labelled, "tokens array<string>, label int"))
    pages = spark.createDataFrame([(1, "http://a/x"), (1, "http://a/x"), (2, "http://b/x"), (3, "http://a.b/y"),
                                   (4, "http://c/x"), (5, None), (6, "http://a/" + "z" * 100000)],
                                  "page_id long, url string")
    got = sorted((r.page_id, r.verdict) for r in url_filter.judge_urls(spark, pages, rules).collect())
    assert got == [(1, "block"), (1, "block"), (2, "block"), (3, "allow"), (4, "allow"), (5, "allow"), (6, "allow")]
    assert url_filter.judge_urls(spark, pages.limit(0), rules).count() == 0
