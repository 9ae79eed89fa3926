"""The toxicity fit on executors: near copies, features, small label sets, held-out labels."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity
from tidemark.llm.common import table

SF = "/root/testdata/"


def _text(rng, n=60, words=400):
    return " ".join("v" + "".join("abcdefghij"[int(d)] for d in str(rng.randrange(words))) for _ in range(n))


def _frames(spark, texts, labels):
    return (spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"),
            spark.createDataFrame(list(enumerate(labels)), "doc_id long, toxic int"))


def test_bands_agree_for_near_copies_not_for_shared_passages():
    rng = random.Random(3)
    near = shared = 0
    for _ in range(60):
        a = _text(rng, 300).split()
        b = list(a)
        b[rng.randrange(300)] = "other"
        c = a[:60] + _text(rng, 240).split()          # a fifth in common
        near += bool(set(toxicity.bands(a)) & set(toxicity.bands(b)))
        shared += bool(set(toxicity.bands(a)) & set(toxicity.bands(c)))
        assert toxicity.bands(a) == toxicity.bands(list(a))
    assert near >= 58 and shared <= 3
    assert toxicity.bands([]) == toxicity.bands([]) and len(toxicity.bands(["one"])) == toxicity.BANDS


def test_feature_ranks_equal_plain_counts(spark):
    rng = random.Random(8)
    texts = [_text(rng, 30, 60) + (" scumbag" if k % 7 == 0 else "") for k in range(210)]
    labels = [int(k % 7 == 0) for k in range(210)]
    model = toxicity.fit_toxicity(*_frames(spark, texts, labels))
    n1, n0 = sum(labels), len(labels) - sum(labels)
    held = {}
    for t, y in zip(texts, labels, strict=True):
        for f in {f for w in t.split() for f in toxicity.features("".join(toxicity._WORD.findall(w)))}:
            held.setdefault(f, [0, 0])[y] += 1
    part = lambda k, n, r: (k * math.log(r) if k else 0) + ((n - k) * math.log(1 - r) if n - k else 0)
    known = set()
    for f, (a, b) in held.items():
        if b >= toxicity.LEAST and (b + .5) / (n1 + 1) * (n0 + 1) / (a + .5) >= 1:
            pooled = (a + b) / (n0 + n1)
            ratio = 2 * (part(b, n1, b / n1) + part(a, n0, a / n0) - part(b, n1, pooled) - part(a, n0, pooled))
            if ratio >= min(toxicity.KNOWN, toxicity.CLEAR * math.log(sum(c[1] >= toxicity.LEAST for c in held.values()))):
                known.add(f)
    assert set(model.known) == known and "=scumbag" in known


def test_copies_of_a_toxic_text_count_once_and_a_clean_copy_does_not_remove_it(spark):
    rng = random.Random(1)
    clean = [_text(rng) for _ in range(80)]
    toxic = [_text(rng) + " villain " + _text(rng, 5) for _ in range(12)]
    copied = [_text(rng) + " justonce " + _text(rng, 5)] * 40
    texts, labels = clean + toxic + copied + [toxic[0]], [0] * 80 + [1] * 12 + [1] * 40 + [0]
    model = toxicity.fit_toxicity(*_frames(spark, texts, labels))
    assert "=villain" in model.known and "=justonce" not in model.known


def test_few_toxic_documents_make_a_real_model(spark):
    rng = random.Random(6)
    texts = [_text(rng) for _ in range(45)] + [_text(rng) + " villain" for _ in range(6)]
    labels = [0] * 45 + [1] * 6
    docs, marks = _frames(spark, texts, labels)
    model = toxicity.fit_toxicity(docs, marks)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, model).collect()}
    bad, good = ([r.toxicity for k, r in got.items() if labels[k] == y] for y in (1, 0))
    assert model.known and sum(x >= toxicity.REJECT for x in bad) >= 5 and min(bad) > sorted(good)[-3], (bad, good)
    assert sum(x >= toxicity.REJECT for x in good) <= 2
    assert all("villain" in {texts[k][s.start:s.end] for s in got[k].toxic_spans} for k in got if labels[k])


def test_odd_labels_and_texts(spark):
    docs = spark.createDataFrame([(1, None), (1, None), (2, ""), (None, "x"), (3, "word " * 50000), (4, "12 !?")],
                                 "doc_id long, text string")
    marks = spark.createDataFrame([(1, 1), (2, 0), (3, None), (9, 1), (None, 1), (4, 0), (4, 1)], "doc_id long, toxic int")
    for labels in (marks, marks.limit(0)):
        model = toxicity.fit_toxicity(docs, labels)
        scores = [r.toxicity for r in toxicity.score_toxicity(docs, model).collect()]
        assert len(scores) == 6 and all(0 <= s <= 1 for s in scores)


@pytest.mark.parametrize("sf,recall,false", [("sf0.1", 0.9, 4), ("sf0.01", 0.75, 1)])
def test_held_out_labels(spark, sf, recall, false):
    """The labels of the test are never read by the fit (some carry no sign at all)."""
    sf = SF + sf
    truth = table(spark, sf, "labels").where("toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    rows = toxicity.op5_toxicity(spark, sf).where("held_out").join(truth, "doc_id").select("predicted", "toxic").collect()
    caught = [r.predicted for r in rows if r.toxic]
    assert len(caught) > 10 and sum(caught) >= recall * len(caught)
    assert sum(r.predicted for r in rows if not r.toxic) <= false
