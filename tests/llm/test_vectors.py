"""Vector codes and centroid clusters against plain comparison of everything."""

import hashlib
import math
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import centroids, integer_vectors, vector_codes

ODD = [(9000, None, 1), (9001, [None] + [0.1] * 63, 1), (9002, [float("nan")] + [0.1] * 63, None),
       (9003, [float("inf")] + [0.1] * 63, 2)]
SCHEMA = "vec_id long, embedding array<float>, label int, code string, id int"


def _vectors(n=400, dims=64, seed=0):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=(9, dims)) * 0.2
    v = (middle[rng.integers(0, 9, n)] + rng.normal(size=(n, dims)) * 0.06).astype(np.float32)
    v[50:120] = v[50]  # repeated vectors: ties
    ids = [*range(n - 6), 3, 3, None, None, 8, 8]
    return [(i, x.tolist(), [None, 0, 1, 1, 1, 2][k % 6]) for k, (i, x) in enumerate(zip(ids, v, strict=True))]


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 5) for r in rows], SCHEMA)


def _whole(rows):
    out = []
    for i, v, label in rows:
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            top = integer_vectors.largest(len(v))
            out.append((i, [max(-top, min(top, math.floor(256 * float(np.float32(x))))) for x in v], label))
    return out


def _squared(a, b):
    return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))


def _codes(rows, parts, entries, rounds):
    rows = _whole(rows)
    width = max(1, -(-max(len(v) for _, v, _ in rows) // parts))
    rows = [(i, v + [0] * (width * parts - len(v)), label) for i, v, label in rows]
    cut = [[tuple(v[p * width:(p + 1) * width]) for p in range(parts)] for _, v, _ in rows]
    # of equal ids the lesser vector first, as given (before zeros at the end)
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))
    books = [[cut[k][p] for k in order[:entries]] for p in range(parts)]

    def assign():
        return [[min(range(len(books[p])), key=lambda e: (_squared(row[p], books[p][e]), e)) for p in range(parts)]
                for row in cut]
    for _ in range(rounds):
        code = assign()
        for p in range(parts):
            for e in range(len(books[p])):
                own = [row[p] for row, c in zip(cut, code, strict=True) if c[p] == e]
                if own:
                    books[p][e] = tuple(sum(x) // len(own) for x in zip(*own, strict=True))
    code = assign()
    error = [sum(_squared(row[p], books[p][c[p]]) for p in range(parts)) for row, c in zip(cut, code, strict=True)]
    per_label = Counter()
    for (_, _, label), e in zip(rows, error, strict=True):
        per_label[label] += e
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    return Counter((i, label, "".join(f"{x:02x}" for x in c), e, per_label[label], sha)
                   for (i, _, label), c, e in zip(rows, code, error, strict=True))


def _coded(df):
    return Counter((r.vec_id, r.label, r.code, r.error, r.label_error, r.codebooks_sha256) for r in df.collect())


@pytest.mark.parametrize("parts,entries", [(16, 64), (4, 5)])
def test_codes_equal_plain_comparison(spark, parts, entries):
    rows = _vectors(160) + ODD
    got = vector_codes.vector_codes(spark, _frame(spark, rows).repartition(5), parts=parts, entries=entries)
    assert _coded(got) == _codes(rows, parts, entries, 2)


def test_codes_of_uneven_short_and_huge_vectors(spark):
    rows = [(1, [0.5, 1.0, -3.3], 0), (2, [], 0), (3, [1e38] * 7, None), (4, [-1e38, 2.0], None), (5, [0.1] * 5, 1)]
    got = vector_codes.vector_codes(spark, _frame(spark, rows), parts=2, entries=3)
    assert _coded(got) == _codes(rows, 2, 3, 2)


def test_codes_of_empty_tables(spark):
    assert vector_codes.vector_codes(spark, _frame(spark, [])).count() == 0
    assert vector_codes.vector_codes(spark, _frame(spark, ODD)).count() == 0


def test_a_hot_label_is_summed_like_the_others(spark):
    rows = spark.range(5000).selectExpr("id", "CASE WHEN id % 3 = 0 THEN 7 WHEN id < 40 THEN NULL ELSE id END AS k",
                                        "id AS v")
    got = vector_codes.with_group_total(rows, "k", "v", "total").collect()
    want = Counter()
    for r in got:
        want[r.k] += r.v
    assert len(got) == 5000 and all(r.total == want[r.k] for r in got)


@pytest.mark.parametrize("width", [1, 3, 14])
def test_dominated_entries_are_never_nearest(width, monkeypatch):
    monkeypatch.setattr(vector_codes, "MEMORY", 64)  # forgets while it runs
    rng = np.random.default_rng(width)
    book = rng.integers(-40, 40, (64, width))
    book[10] = book[3]
    points = np.concatenate([rng.integers(-90, 90, (2000, width)), book])
    cells = vector_codes.Cells(book)
    entry, squared = cells.nearest(points)
    all_ = ((points[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == all_.argmin(axis=1)).all() and (squared == all_.min(axis=1)).all()
    if width == 3:  # inside the grid few entries stay
        assert np.mean([len(x) for x in cells.known.values()]) < 40


def test_codes_decode_to_their_entries():
    books = np.arange(2 * 3 * 2).reshape(2, 3, 2)
    assert vector_codes.decode("0102", books).tolist() == [2, 3, 10, 11]


def _clusters(rows, k, rounds, dims):
    rows = [r for r in _whole(rows) if len(r[1]) == dims]
    key = lambda r: (r[0] is None, hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "",
                     r[1])
    cent = [tuple(r[1]) for r in sorted(rows, key=key)[:k]]

    def assign():
        return [min(range(len(cent)), key=lambda c: (_squared(v, cent[c]), c)) for _, v, _ in rows]
    for _ in range(rounds):
        own = defaultdict(list)
        for c, (_, v, _) in zip(assign(), rows, strict=True):
            own[c].append(v)
        for c, vs in own.items():
            cent[c] = tuple(sum(x) // len(vs) for x in zip(*vs, strict=True))
    code = assign()
    d = [_squared(v, cent[c]) for c, (_, v, _) in zip(code, rows, strict=True)]
    inertia = Counter()
    for c, x in zip(code, d, strict=True):
        inertia[c] += x
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in cent]
    return Counter((r[0], c, x, inertia[c], sum(d), sha[c]) for r, c, x in zip(rows, code, d, strict=True))


def _clustered(df):
    return Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, r.centroid_sha256)
                   for r in df.collect())


@pytest.mark.parametrize("k,rounds", [(40, 5), (9, 8), (1, 2)])
def test_clusters_equal_plain_comparison(spark, k, rounds):
    rows = _vectors(300) + ODD + [(9004, [0.1] * 63, 1), (9005, [], 1)]
    got = centroids.centroid_clusters(spark, _frame(spark, rows).repartition(5), k=k, rounds=rounds)
    assert _clustered(got) == _clusters(rows, k, rounds, 64)


def test_clusters_of_few_and_huge_vectors(spark):
    rows = [(1, [1e38, 0.0], 0), (2, [-1e38, 0.0], 0), (3, [0.0, 1e38], 0)]
    got = centroids.centroid_clusters(spark, _frame(spark, rows), k=2, rounds=3, dims=2)
    assert _clustered(got) == _clusters(rows, 2, 3, 2)
    assert centroids.centroid_clusters(spark, _frame(spark, [])).count() == 0
    assert centroids.centroid_clusters(spark, _frame(spark, ODD)).count() == 0


def test_tightened_bounds_save_scans(spark):
    rows = _vectors(400)
    got = centroids.centroid_clusters(spark, _frame(spark, rows), k=9, rounds=8).collect()
    assert sum(r.scans for r in got) < 0.8 * 9 * len(got)


def test_loosening_holds_and_is_below_the_drift():
    rng = np.random.default_rng(5)
    less = 0
    for _ in range(40):
        old = rng.integers(-300, 300, (6, 3))
        new = old + rng.integers(-60, 60, (6, 3)) * rng.integers(0, 2, (6, 1))
        radius = rng.uniform(0, 150, 6)
        fall = centroids.loosening(old, new, radius)
        full = np.array([max(np.linalg.norm(new[j] - old[j]) for j in range(6) if j != i) for i in range(6)])
        for i in range(6):
            way = rng.normal(size=(400, 3))
            x = old[i] + way / np.linalg.norm(way, axis=1, keepdims=True) * radius[i] * rng.uniform(0, 1, (400, 1))
            for j in range(6):
                if j != i:
                    nearer = np.linalg.norm(x - old[j], axis=1) - np.linalg.norm(x - new[j], axis=1)
                    assert nearer.max() <= fall[i] + 1e-9
        less += (fall < full - 1e-6).sum()
        assert (fall <= full * (1 + 1e-8) + 1e-8).all()
    assert less > 60
