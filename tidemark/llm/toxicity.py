"""Toxicity: a linear-chain CRF tags toxic words, its marginals score documents.

Fitting, on a bounded sample of labelled rows (about ``FIT_CHARS`` characters of text;
of near copies with one label, the first counts):

1. Tasks count word and word-beginning features of toxic and clean documents; Spark ranks
   them by the log-likelihood ratio. What is clearly toxic is relative to how many
   features were compared (``CLEAR``), so small label sets are fitted like large ones.
   Words of toxic documents that carry a clearly toxic feature are the labelled tokens
   "toxic", all other tokens "clean".
2. A two-state linear-chain CRF with features of a word and of its two neighbours is
   fitted to these tokens (exact gradient by forward-backward, Adam). The driver does
   this on numbers: one per word for its set of known features, never on texts.
3. A logistic regression on what the marginals add up to in a document (expected
   toxic words, the largest marginal, the density) gives the score.

Scoring runs over every whole text: the words of an Arrow batch form one chain in
which each document starts with a reset, so that blocked forward-backward passes
handle all documents at once, long ones too. A document gets a score and the offsets
of its offending spans (code points, end exclusive).

Null and empty texts score as documents without words. Label rows with a null label
or no document are left out; without both labels the score is the (smoothed) rate of
toxic labels and nothing is tagged. Repeated rows score alike. Every input column is
passed through; empty tables give no rows.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import forget, fresh, stored, table

#: characters of labelled text the classifier is fitted on, about
FIT_CHARS = 12_000_000
#: documents longer than this share of the sample are not sampled
LONGEST = 1 / 16
#: tokens of the sample that the CRF itself is fitted on, about
FIT_TOKENS = 300_000
PREFIXES = (3, 4, 5, 6)
#: least log-likelihood ratio of a feature that marks toxic tokens, per logarithm of the
#: number of features compared (2 lets about one pass by chance), and its least lift
CLEAR, LIFT = 1.5, 4.0
#: toxic documents that hold a feature, at least
LEAST = 3
#: least ratio of a feature that the CRF knows, and the most features
KNOWN, MOST_FEATURES = 10.0, 20_000
#: min-hashes of five words: bands, and hashes that all agree in a band of a near copy
BANDS, ROWS = 4, 4
STEPS = 60
#: documents of the sample that are scored together for the document regression
FIT_GROUP = 500
#: words a worker remembers
REMEMBER = 300_000
#: characters scored at a time
AT_ONCE = 1_500_000
#: score from which a document counts as toxic
REJECT = 0.7

_WORD = re.compile(r"[^\W\d_]+")


def features(word: str) -> list[str]:
    word = word.lower()
    return ["=" + word] + [word[:k] for k in PREFIXES if len(word) >= k]


def marginals(emit: np.ndarray, first: np.ndarray, start: np.ndarray,
              trans: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """P(toxic) of each token of one long chain with resets where ``first``.

    ``emit`` is the log potential of toxic over clean. The chain is cut into equal
    blocks; 2 x 2 products of the blocks give each block its entering messages, so
    the passes run over all blocks side by side. Also returns the forward share of
    the toxic state and both backward messages (for the gradient).
    """
    n = len(emit)
    if not n:
        return (np.empty(0),) * 4
    length = max(16, int(math.sqrt(n)))
    count = -(-n // length)
    gain = np.ones(count * length)
    gain[:n] = np.exp(np.clip(emit, -30, 30))
    reset = np.ones(count * length, bool)
    reset[:n] = first
    gain, reset = (np.ascontiguousarray(x.reshape(count, length).T) for x in (gain, reset))
    m00 = np.where(reset, start[0], trans[0, 0])
    m10 = np.where(reset, start[0], trans[1, 0])
    m01 = np.where(reset, start[1], trans[0, 1]) * gain
    m11 = np.where(reset, start[1], trans[1, 1]) * gain
    p00, p11 = np.ones(count), np.ones(count)
    p01, p10 = np.zeros(count), np.zeros(count)
    for a, b, c, d in zip(m00, m01, m10, m11, strict=True):
        p00, p01, p10, p11 = p00 * a + p01 * c, p00 * b + p01 * d, p10 * a + p11 * c, p10 * b + p11 * d
        scale = 1 / (p00 + p01 + p10 + p11)
        p00, p01, p10, p11 = p00 * scale, p01 * scale, p10 * scale, p11 * scale
    blocks = list(zip(p00.tolist(), p01.tolist(), p10.tolist(), p11.tolist(), strict=True))
    enter, x, y = [], 0.5, 0.5
    for a, b, c, d in blocks:
        enter.append(y)
        x, y = x * a + y * c, x * b + y * d
        x, y = x / (x + y), y / (x + y)
    leave, x, y = [], 0.5, 0.5
    for a, b, c, d in reversed(blocks):
        leave.append((x, y))
        x, y = a * x + b * y, c * x + d * y
        x, y = x / (x + y), y / (x + y)
    ahead = np.empty_like(gain)
    share = np.array(enter)
    for t in range(length):
        clean = 1 - share
        toxic = clean * m01[t] + share * m11[t]
        share = toxic / (toxic + clean * m00[t] + share * m10[t])
        ahead[t] = share
    b0, b1 = (np.array(x) for x in zip(*reversed(leave), strict=True))
    back0, back1 = np.empty_like(gain), np.empty_like(gain)
    for t in range(length - 1, -1, -1):
        back0[t], back1[t] = b0, b1
        n0, n1 = m00[t] * b0 + m01[t] * b1, m10[t] * b0 + m11[t] * b1
        scale = 1 / (n0 + n1)
        b0, b1 = n0 * scale, n1 * scale
    flat = [x.T.reshape(-1)[:n] for x in (ahead, back0, back1)]
    toxic = flat[0] * flat[1 + 1]
    return toxic / (toxic + (1 - flat[0]) * flat[1]), *flat


@dataclass
class Model:
    """What scoring needs: feature weights, chain potentials and the document regression."""

    known: dict[str, int] = field(default_factory=dict)
    own: np.ndarray = field(default_factory=lambda: np.zeros(0))
    before: np.ndarray = field(default_factory=lambda: np.zeros(0))
    after: np.ndarray = field(default_factory=lambda: np.zeros(0))
    start: np.ndarray = field(default_factory=lambda: np.array([1.0, 0.0]))
    trans: np.ndarray = field(default_factory=lambda: np.array([[1.0, 0.0], [1.0, 0.0]]))
    regression: np.ndarray = field(default_factory=lambda: np.zeros(4))


class Lexicon(dict):
    """Word -> type; words with the same known features share a type, type 0 has none."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known
        self.types: dict[tuple[int, ...], int] = {(): 0}

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBER:
            self.clear()
        key = tuple(self.known[f] for f in features(word) if f in self.known)
        found = self[word] = self.types.setdefault(key, len(self.types))
        return found

    def sums(self, weights: np.ndarray) -> np.ndarray:
        return np.array([weights[list(key)].sum() if key else 0.0 for key in self.types])


def emissions(types: np.ndarray, first: np.ndarray, own: np.ndarray, before: np.ndarray,
              after: np.ndarray) -> np.ndarray:
    out = own[types].astype(float)
    if len(out) > 1:
        inner = ~first[1:]
        out[1:] += np.where(inner, before[types[:-1]], 0)
        out[:-1] += np.where(inner, after[types[1:]], 0)
    return out


def _joined(chains: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Types of all documents in a row, where documents start, and whose each token is."""
    sizes = np.array([len(c) for c in chains], np.int64)
    if chains and isinstance(chains[0], np.ndarray):
        types = np.concatenate(chains).astype(np.int64)
    else:
        types = np.fromiter(chain.from_iterable(chains), np.int64, int(sizes.sum()))
    owner = np.repeat(np.arange(len(chains)), sizes)
    first = np.ones(len(types), bool)
    first[1:] = owner[1:] != owner[:-1]
    return types, first, owner


def _document_features(p: np.ndarray, owner: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    total = np.bincount(owner, p, len(sizes))
    most = np.zeros(len(sizes))
    np.maximum.at(most, owner, p)
    return np.column_stack([np.ones(len(sizes)), np.log1p(total), most,
                            np.log1p(100 * total / np.maximum(sizes, 1))])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def score_chains(model: Model, lexicon: Lexicon, chains: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    """(score of each document, marginal of each token)."""
    types, first, owner = _joined(chains)
    emit = emissions(types, first, *(lexicon.sums(w) for w in (model.own, model.before, model.after)))
    p = marginals(emit, first, model.start, model.trans)[0]
    sizes = np.array([len(c) for c in chains])
    return _sigmoid(_document_features(p, owner, sizes) @ model.regression), p


def _ratio(a: F.Column, b: F.Column, n_a: int, n_b: int) -> F.Column:
    """Log-likelihood ratio of document counts a of n_a and b of n_b."""
    def part(k: F.Column, n: int, rate: F.Column) -> F.Column:
        rate = F.greatest(F.lit(1e-12), F.least(F.lit(1 - 1e-12), rate))
        return k * F.log(rate) + (n - k) * F.log(1 - rate)
    pooled = (a + b) / (n_a + n_b)
    return 2 * (part(a, n_a, a / n_a) + part(b, n_b, b / n_b)
                - part(a, n_a, pooled) - part(b, n_b, pooled))


_MIX = np.random.default_rng(5).integers(0, 2 ** 63, (2, BANDS * ROWS, 1), dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def bands(words: list[str]) -> list[int]:
    """Hashes that documents share if most of their runs of five words agree."""
    grams = {" ".join(words[k:k + 5]) for k in range(max(1, len(words) - 4))}
    hashes = np.array([xxhash.xxh64_intdigest(g) for g in grams], np.uint64)[None, :]
    low = np.concatenate([((hashes[:, k:k + 4096] ^ _MIX[1]) * _MIX[0]).min(axis=1, keepdims=True)
                          for k in range(0, hashes.shape[1], 4096)], axis=1).min(axis=1)
    return [xxhash.xxh64_intdigest(row.tobytes(), k) - 2 ** 63 for k, row in enumerate(low.reshape(BANDS, ROWS))]


def _banded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, label, band) for each band of a text."""
    for batch in batches:
        rows, labels = batch.column("row").to_pylist(), batch.column("label").to_pylist()
        found = [(r, y, b) for r, y, t in zip(rows, labels, batch.column("text"), strict=True)
                 for b in bands(_WORD.findall(t.as_py()))]
        columns = list(zip(*found, strict=True)) or [[], [], []]
        yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64()), strict=True)],
                              names=["row", "label", "band"])


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(feature, clean, toxic): documents of the task that hold it."""
    counts: dict[str, list[int]] = {}
    for batch in batches:
        for text, label in zip(batch.column("text"), batch.column("label").to_pylist(), strict=True):
            for f in set(chain.from_iterable(map(features, set(_WORD.findall(text.as_py()))))):
                counts.setdefault(f, [0, 0])[label] += 1
    clean, toxic = zip(*counts.values(), strict=True) if counts else ([], [])
    yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(clean, pa.int64()), pa.array(toxic, pa.int64())],
                          names=["feature", "clean", "toxic"])


def _key(known: tuple[int, ...]) -> int:
    """A number for a set of known features; 0 for none."""
    return xxhash.xxh64_intdigest(np.array(known, "<i4").tobytes()) - 2 ** 63 if known else 0


def _typed(known: dict[str, int]):
    """Rows as (row, label, keys of the words), and once a task what its keys stand for."""
    schema = pa.schema([("row", pa.int64()), ("label", pa.int32()), ("words", pa.binary()), ("key", pa.int64()),
                        ("features", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys: dict[str, int] = {}
        meaning: dict[int, list[int]] = {}
        for batch in batches:
            out = []
            for row, label, text in zip(batch.column("row").to_pylist(), batch.column("label").to_pylist(),
                                        batch.column("text"), strict=True):
                words = _WORD.findall(text.as_py())
                for w in set(words) - keys.keys():
                    own = tuple(known[f] for f in features(w) if f in known)
                    keys[w] = _key(own)
                    meaning[keys[w]] = list(own)
                out.append({"row": row, "label": label, "key": None, "features": None,
                            "words": np.array([keys[w] for w in words], "<i8").tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=schema)
        yield pa.RecordBatch.from_pylist([{"key": k, "features": v} for k, v in meaning.items()], schema=schema)
    return run


def _fit(rows: pa.Table, known: dict[str, int], strong: np.ndarray) -> Model:
    """The model from the sample's word keys."""
    meant = rows.filter(rows["key"].is_valid())
    meaning = dict(zip(meant["key"].to_pylist(), map(tuple, meant["features"].to_pylist()), strict=True))
    lexicon = Lexicon(known)
    order = [0, *sorted(meaning.keys() - {0})]
    for key in order[1:]:
        lexicon.types[meaning[key]] = len(lexicon.types)
    place = np.argsort(order)
    of = np.sort(order)
    docs = rows.filter(rows["words"].is_valid()).sort_by("row")
    toxic = docs["label"].to_numpy()
    chains = [place[np.searchsorted(of, np.frombuffer(w.as_buffer(), "<i8"))].astype(np.int32)
              for w in docs["words"]]
    del rows, meant, docs
    marks = np.array([any(strong[f] for f in key) for key in lexicon.types])
    model = Model(known, *_fit_chain(chains, toxic, lexicon, marks))
    weights = [lexicon.sums(w) for w in (model.own, model.before, model.after)]
    parts = []
    for at in range(0, len(chains), FIT_GROUP):
        some = chains[at:at + FIT_GROUP]
        types, first, owner = _joined(some)
        p = marginals(emissions(types, first, *weights), first, model.start, model.trans)[0]
        parts.append(_document_features(p, owner, np.array([len(c) for c in some])))
    model.regression = _logistic(np.concatenate(parts), toxic)
    return model


def _fit_chain(chains: list[list[int]], toxic: np.ndarray, lexicon: Lexicon, marks: np.ndarray):
    """CRF weights and potentials from the labelled tokens (Adam on the penalised likelihood)."""
    rng = np.random.default_rng(0)
    picked, tokens = [], 0
    order = rng.permutation(len(chains))
    for k in order[np.argsort(-toxic[order], kind="stable")]:  # toxic documents first
        if tokens < FIT_TOKENS or toxic[k] and tokens < 2 * FIT_TOKENS:
            picked.append(int(k))
            tokens += len(chains[k])
    types, first, owner = _joined([chains[k] for k in picked])
    truth = (marks[types] & (toxic[picked][owner] == 1)).astype(float)
    keys = list(lexicon.types)
    type_of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    feature_of = np.array([f for k in keys for f in k], np.int64)
    n = len(lexicon.known)
    theta = np.zeros(3 * n + 6)  # own, before, after; start (2), trans (4)
    theta[3 * n:] = [0, -4, 0, -4, 0, -2]
    mean, square = np.zeros_like(theta), np.zeros_like(theta)
    inner = np.nonzero(~first)[0]

    def by_feature(by_type: np.ndarray) -> np.ndarray:
        return np.bincount(feature_of, by_type[type_of], n)

    observed_pair = np.bincount((2 * truth[inner - 1] + truth[inner]).astype(int), minlength=4)
    observed_start = np.array([(truth[first] == 0).sum(), (truth[first] == 1).sum()])
    for step in range(1, STEPS + 1):
        weights = [np.bincount(type_of, w[feature_of], len(keys)) for w in np.split(theta[:3 * n], 3)]
        start, trans = np.exp(theta[3 * n:3 * n + 2]), np.exp(theta[3 * n + 2:]).reshape(2, 2)
        emit = emissions(types, first, *weights)
        p, ahead, back0, back1 = marginals(emit, first, start, trans)
        miss = truth - p
        gradient = np.zeros_like(theta)
        gradient[:n] = by_feature(np.bincount(types, miss, len(keys)))
        gradient[n:2 * n] = by_feature(np.bincount(types[inner - 1], miss[inner], len(keys)))
        gradient[2 * n:3 * n] = by_feature(np.bincount(types[inner], miss[inner - 1], len(keys)))
        gain = np.exp(np.clip(emit[inner], -30, 30))
        prior = 1 - ahead[inner - 1], ahead[inner - 1]
        post = back0[inner], gain * back1[inner]
        pair = [prior[a] * trans[a, b] * post[b] for a in (0, 1) for b in (0, 1)]
        total = pair[0] + pair[1] + pair[2] + pair[3]
        expected = np.array([(k / total).sum() for k in pair])
        gradient[3 * n:3 * n + 2] = observed_start - [(1 - p[first]).sum(), p[first].sum()]
        gradient[3 * n + 2:] = observed_pair - expected
        gradient -= 0.05 * theta
        mean = 0.9 * mean + 0.1 * gradient
        square = 0.99 * square + 0.01 * gradient ** 2
        theta += 0.3 * (mean / (1 - 0.9 ** step)) / (np.sqrt(square / (1 - 0.99 ** step)) + 1e-8)
    own, before, after = np.split(theta[:3 * n], 3)
    return own, before, after, np.exp(theta[3 * n:3 * n + 2]), np.exp(theta[3 * n + 2:]).reshape(2, 2)


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [0.05] * (x.shape[1] - 1))
    for _ in range(30):
        p = _sigmoid(x @ w)
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty
        w = w + np.linalg.solve(hessian, x.T @ (y - p) - penalty @ w)
    return w


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", fit_chars: int = FIT_CHARS) -> Model:
    """Fit on about ``fit_chars`` characters of labelled documents (by a hash of the id).

    The driver sees the ranked features (``MOST_FEATURES`` at most) and, for each word of the
    sample, one number.
    """
    spark = docs.sparkSession
    marked = (labels.where(F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("id"))
              .agg(F.max(label_col).cast("int").alias("label")))
    text = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
                       .alias("text")).where(F.length("text") <= int(fit_chars * LONGEST))
    sizes = text.select("id", F.length("text").alias("size")).join(marked, "id")
    chars = sizes.agg(F.sum("size")).first()[0] or 0
    share = min(1.0, fit_chars / max(chars, 1))
    lucky = marked.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(share * 1_000_000))
    tasks = 2 * spark.sparkContext.defaultParallelism
    # a row is known by a hash of its id and text: equal rows are one
    sample = stored(spark, text.join(lucky, "id").select(F.xxhash64("id", "text").alias("row"), "text", "label")
                    .dropDuplicates(["row"]).repartition(tasks, "row"), "toxicity-sample")
    banded = stored(spark, sample.mapInArrow(_banded, "row long, label int, band long"), "toxicity-bands")
    first = banded.groupBy("band", "label").agg(F.min("row").alias("first"))
    copies = banded.join(first, ["band", "label"]).where("row > first").select("row").distinct()
    kept = stored(spark, sample.join(copies, "row", "left_anti").repartition(tasks, "row"), "toxicity-kept")
    found = {r.label: r.n for r in kept.groupBy("label").agg(F.count("*").alias("n")).collect()}
    n_clean, n_toxic = found.get(0, 0), found.get(1, 0)
    rate = (n_toxic + 0.5) / (n_toxic + n_clean + 1) if found else 0.0
    constant = Model(regression=np.array([math.log(rate / (1 - rate)) if rate else -35.0, 0, 0, 0]))
    try:
        if not n_toxic or not n_clean:
            return constant
        counts = stored(spark, kept.mapInArrow(_counted, "feature string, clean long, toxic long").groupBy("feature")
                        .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
                        .where(F.col("toxic") >= LEAST), "toxicity-features")
        clean, toxic = F.col("clean"), F.col("toxic")
        lift = (toxic + 0.5) / (n_toxic + 1) * (n_clean + 1) / (clean + 0.5)
        least = CLEAR * math.log(max(counts.count(), 2))
        ranked = (counts.select("feature", _ratio(toxic, clean, n_toxic, n_clean).alias("ratio"), lift.alias("lift"))
                  .where((F.col("lift") >= 1) & (F.col("ratio") >= min(KNOWN, least)))
                  .orderBy(F.desc("ratio"), "feature").limit(MOST_FEATURES).toArrow())
        forget(spark, counts)
        known = {f: k for k, f in enumerate(ranked["feature"].to_pylist())}
        strong = (ranked["ratio"].to_numpy() >= least) & (ranked["lift"].to_numpy() >= LIFT)
        if not strong.any():
            return constant
        rows = kept.mapInArrow(_typed(known), "row long, label int, words binary, key long, features array<int>").toArrow()
        return _fit(rows, known, strong)
    finally:
        forget(spark, sample, banded, kept)


def _groups(column: pa.Array) -> Iterator[list[str]]:
    """The texts of a batch, about ``AT_ONCE`` characters at a time, so that memory stays bounded."""
    texts, size = [], 0
    for value in column:
        texts.append(value.as_py() or "")
        size += len(texts[-1])
        if size >= AT_ONCE:
            yield texts
            texts, size = [], 0
    if texts:
        yield texts


def _scorer(model: Model, text_at: int, spans: bool, schema: pa.Schema | None = None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = Lexicon(model.known)
        for batch in batches:
            scores, tagged = [np.empty(0)], []
            for texts in _groups(batch.column(text_at)):
                chains = [list(map(lexicon.__getitem__, _WORD.findall(t))) for t in texts]
                score, p = score_chains(model, lexicon, chains)
                scores.append(score)
                if spans:
                    ends = np.cumsum([len(c) for c in chains]).tolist()
                    tagged += [_spans(t, p[e - len(c):e]) for t, c, e in zip(texts, chains, ends, strict=True)]
            columns = [*batch.columns, pa.array(np.concatenate(scores))]
            if spans:
                columns.append(pa.array(tagged, pa.list_(pa.struct([
                    ("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))))
            names = [*batch.schema.names, *(f"added{k}" for k in range(len(columns) - batch.num_columns))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def _spans(text: str, p: np.ndarray) -> list[dict]:
    """Runs of words that are more likely toxic than not."""
    hit = p >= 0.5
    if not hit.any():
        return []
    out: list[dict] = []
    joined = False
    for match, bad, prob in zip(_WORD.finditer(text), hit.tolist(), p.tolist(), strict=True):
        if bad and joined:
            out[-1] = {"start": out[-1]["start"], "end": match.end(), "p": max(out[-1]["p"], prob)}
        elif bad:
            out.append({"start": match.start(), "end": match.end(), "p": prob})
        joined = bad
    return out


def score_toxicity(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "toxicity",
                   spans_col: str | None = "toxic_spans") -> DataFrame:
    """``docs`` with a score and (unless ``spans_col`` is None) the offending spans.

    Columns of ``docs`` that already have these names are replaced.
    """
    added = {c for c in (score_col, spans_col) if c}
    kept = docs.select(*(c for c in docs.columns if c not in added or c == text_col))
    (text,) = fresh(kept, "text")
    ready = kept.select("*", F.col(text_col).cast("string").alias(text))
    fields = [*ready.schema.fields, T.StructField(score_col, T.DoubleType())]
    if spans_col:
        fields.append(T.StructField(spans_col, T.ArrayType(T.StructType([
            T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()),
            T.StructField("p", T.DoubleType())]))))
    names = [f.name for f in fields]
    run = _scorer(model, len(ready.columns) - 1, bool(spans_col))

    def named(batches):
        for batch in run(batches):
            yield pa.RecordBatch.from_arrays(batch.columns, names=names)

    return ready.mapInArrow(named, T.StructType(fields)).drop(text)


def drop_toxic(docs: DataFrame, model: Model, text_col: str = "text", reject: float = REJECT) -> DataFrame:
    """The rows of ``docs`` that score below ``reject``, with their own columns."""
    (score,) = fresh(docs, "toxicity")
    scored = score_toxicity(docs, model, text_col, score, None)
    return scored.where(F.col(score) < reject).select(*docs.columns)


def held_out(id_col: str = "doc_id") -> F.Column:
    return F.crc32(F.col(id_col).cast("string")) % 3 == 1


def training_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    """The model of the contract: labels of held-out ids are never read."""
    labels = table(spark, sf_dir, "labels").where(~held_out())
    return fit_toxicity(docs, labels)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = score_toxicity(docs, training_model(spark, docs, sf_dir), spans_col=None,
                            score_col="score")
    return scored.select("doc_id", held_out().alias("held_out"), "score",
                         (F.col("score") >= REJECT).cast("int").alias("predicted"))
