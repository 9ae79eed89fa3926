"""The forest decides: held-out findings of forms the label rule does not know; stored tables hold no clear values."""

import glob
import random
import string

from tidemark.llm import secret_scan
from tidemark.session import shared_dir

DOCS = "doc_id long, text string, is_secret string, row int"


def _token(rng, n, digits=True):
    return "".join(rng.choices(string.ascii_letters + (string.digits * 3 if digits else ""), k=n)) + ("7" if digits else "")


def _corpus(seed=5):
    """Texts with a secret the rule labels, benign findings it labels, and both kinds it leaves open."""
    rng = random.Random(seed)
    words = ["".join(rng.choices("etaoinshrdlu", k=rng.randint(2, 8))) for _ in range(60)]
    prose = lambda n: " ".join(rng.choices(words, k=n))
    texts, truth = [], []
    for k in range(400):
        kind = k % 8
        mark = f"{rng.choice(['api_key', 'token', 'secret', 'password'])}"
        if kind in (0, 1):
            value, text = (v := _token(rng, 24)), f"{mark} = '{v}'"
        elif kind == 2:
            value, text = None, f"see https://www.{rng.choice(words)}-site.example.com/{rng.choice(words)}/{rng.randrange(10 ** 6)} now"
        elif kind == 3:
            value, text = None, f"order {rng.randrange(10 ** 18, 10 ** 19)} shipped"
        elif kind == 4:
            value, text = None, f"the {mark}: {rng.choice(words)} {rng.choice(words)}"
        elif kind == 5:  # open: letters only, which the rule does not call random
            value, text = (v := _token(rng, 28, False)), f'{mark}: "{v}"'
        elif kind == 6:  # open: a path of usual words with a number
            value, text = None, f"in /{rng.choice(words)}/{rng.choice(words)}/{rng.choice(words)}{rng.randrange(100)}/{rng.choice(words)}.txt"
        else:
            value, text = None, prose(3)
        texts.append(f"{prose(8)} {text} {prose(6)}")
        truth.append(value)
    return texts, truth


def test_open_forms_are_judged_by_the_forest(spark):
    texts, truth = _corpus()
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in enumerate(texts)], DOCS)
    found = secret_scan.scan_secrets(spark, docs).collect()
    features = secret_scan.label_findings(secret_scan.described(secret_scan.candidates(docs), secret_scan.word_counts(docs)))
    label = {(r.value, r.before): r.label for r in features.select("value", "before", "label").collect()}
    befores = {(r.id, r.idx): r.before for r in secret_scan.candidates(docs).collect()}
    hits = {}
    for r in found:
        hits.setdefault(label[r.value, befores[r.id, r.idx]] is None, []).append((r.is_secret, r.value == truth[r.id]))
    for unlabelled in (False, True):
        rows = hits[unlabelled]
        true = sum(s and w for s, w in rows)
        recall, precision = true / max(sum(w for _, w in rows), 1), true / max(sum(s for s, _ in rows), 1)
        assert len(rows) >= 40 and recall >= 0.9 and precision >= 0.9, (unlabelled, recall, precision, len(rows))
    assert {r.id for r in found if r.value == truth[r.id]} >= {k for k, v in enumerate(truth) if v}


def test_labelled_findings_of_the_caller_decide(spark):
    """With the labels turned round, the verdicts turn round: the rule has no say."""
    texts, truth = _corpus(6)
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in enumerate(texts)], DOCS)
    features = secret_scan.label_findings(secret_scan.described(secret_scan.candidates(docs), secret_scan.word_counts(docs)))
    turned = features.withColumn("label", 1 - features["label"])
    found = secret_scan.scan_secrets(spark, docs, labelled=turned).collect()
    rule = [r.is_secret for r in found if truth[r.id] and len(truth[r.id]) == 25]
    assert rule and not any(rule)


def test_stored_tables_hold_no_clear_value(spark):
    import pyarrow.parquet as pq
    texts, truth = _corpus(7)
    docs = spark.createDataFrame([(k, t, "x", 0) for k, t in enumerate(texts)], DOCS)
    base = shared_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{base}/secret-*"))
    clean = {r.doc_id: r.text for r in secret_scan.redact(spark, docs).collect()}
    assert sum("[REDACTED]" in t for t in clean.values()) >= 100
    values = [v for v in truth if v]
    seen = 0
    for folder in set(glob.glob(f"{base}/secret-*")) - before:
        if "secret-words" in folder:
            continue
        for file in glob.glob(f"{folder}/part-*.parquet"):
            text = str(pq.read_table(file).to_pylist())
            seen += len(text)
            assert not any(v in text for v in values), folder
    assert seen > 10_000
