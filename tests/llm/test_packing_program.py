"""The configuration program of packing: every length covered, a dual bound, its share, small optima."""

import itertools
import math
import random

import numpy as np
import pytest

from tidemark.llm import packing


def _optimum(pieces, room):
    """Fewest sequences, by trying all ways."""
    best = len(pieces)

    def place(k, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if k == len(pieces):
            best = len(bins)
            return
        for b in sorted({x for x in bins}):
            if b >= pieces[k]:
                at = bins.index(b)
                place(k + 1, [*bins[:at], b - pieces[k], *bins[at + 1:]])
        place(k + 1, [*bins, room - pieces[k]])
    place(0, [])
    return best


def _counts(pieces, room):
    return np.bincount(pieces, minlength=room + 1)


def _whole(result, counts):
    used = np.zeros(len(counts), int)
    for combination, times in result.plan:
        assert times > 0 and sum(k * a for k, a in combination.items()) <= len(counts) - 1
        for k, a in combination.items():
            used[k] += a * times
    assert (used == counts).all()
    return sum(times for _, times in result.plan)


@pytest.mark.parametrize("seed", range(60))
def test_small_histograms_meet_the_optimum(seed):
    rng = random.Random(seed)
    room = rng.choice([7, 10, 12])
    pieces = sorted((rng.randint(1, room) for _ in range(rng.randint(1, 9))), reverse=True)
    counts = _counts(pieces, room)
    best = _optimum(pieces, room)
    result = packing.pack_histogram(counts)
    assert _whole(result, counts) == best
    if result.program is not None:
        cut = int(counts[room])
        assert result.program.bound <= best - cut + 1e-6


@pytest.mark.parametrize("seed", range(20))
def test_price_is_the_best_combination(seed):
    rng = np.random.default_rng(seed)
    sizes, values, most = rng.integers(1, 9, 4), rng.random(4), rng.integers(0, 4, 4)
    chosen, worth = packing.price(values, sizes, most, 17)
    best = max(sum(v * a for v, a in zip(values, some)) for some in itertools.product(*(range(m + 1) for m in most))
               if sum(s * a for s, a in zip(sizes, some)) <= 17)
    assert worth == pytest.approx(best) and worth == pytest.approx(sum(values[k] * a for k, a in chosen.items()))
    assert sum(sizes[k] * a for k, a in chosen.items()) <= 17 and all(a <= most[k] for k, a in chosen.items())


def test_the_program_covers_everything_near_its_dual_bound():
    rng = np.random.default_rng(2)
    sizes = rng.permutation(np.arange(20, 1000))[:40]
    n = rng.integers(50, 4000, 40).astype(float)
    program = packing.solve_configurations(n, sizes, 2048)
    covered = np.zeros(40)
    for combination, amount in program.amounts.items():
        assert sum(sizes[k] * a for k, a in combination) <= 2048
        for k, a in combination:
            covered[k] += a * amount
    assert (program.covered >= 1).all() and (covered >= n * (1 - 1e-6)).all()
    total = sum(program.amounts.values())
    assert program.bound <= total <= 1.1 * program.bound


def test_the_program_places_most_tokens_and_comes_near_the_bound():
    rng = np.random.default_rng(4)
    lengths = np.minimum(2048, 1 + rng.lognormal(5.3, 1.1, 12000).astype(int))
    counts = _counts(lengths, 2048)
    result = packing.pack_histogram(counts)
    bound = math.ceil((counts * np.arange(2049)).sum() / 2048)
    assert bound <= _whole(result, counts) <= 1.01 * bound
    assert result.share > 0.9 and (result.program.covered >= 1).all()


@pytest.mark.parametrize("counts", [[0] * 13, [0] * 12 + [5], [0, 7] + [0] * 11, [0] * 7 + [3] + [0] * 5])
def test_plain_histograms(counts):
    counts = np.array(counts)
    n = _whole(packing.pack_histogram(counts), counts)
    assert n == {0: 0, 5: 5, 7: 1, 3: 3}[int(counts.max())]


def test_other_tokenizer_files_are_used_whole(spark):
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer
    path = public.path("byte_bpe_50k.json")
    texts = ["Hello  World\n it's", "", "é的 \U0001f600 Ab  c"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.ids for r in packing.pack(spark, docs, path=path, keep_ids=True).collect()}
    whole = Tokenizer.from_file(path)
    for k, text in enumerate(texts):
        assert np.frombuffer(got[k], "<u4").tolist() == [*whole.encode(text, add_special_tokens=False).ids, 0]
    assert packing.WordIds(public.path(packing.TOKENIZER)).by_word and not packing.WordIds(path).by_word
