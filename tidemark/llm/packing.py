"""Best-fit packing of documents into sequences of a fixed number of tokens.

1. Every document becomes its token ids and one end id; only documents longer than a
   sequence are cut, into whole sequences and one shorter rest. Words repeat, so a
   task keeps the ids of the words it has met; each word's ids come from the
   tokenizer itself. Each piece gets its rank among the pieces of its length in its task.
2. The length histogram (as many numbers as a sequence has tokens) goes to the driver.
   There the configuration linear program - how often to use each combination of
   lengths that fits a sequence, so that all lengths are covered - is solved by
   multiplicative weights over at most ``CLASSES`` runs of neighbouring lengths with like
   numbers of tokens (few lengths are a class each): classes not covered yet weigh more, a
   knapsack dynamic program prices the best combination, and a step of it is taken, until
   every class is covered. The weights are dual prices and give a lower bound as well.
   The solution is rounded down and its classes are filled with lengths of their own, the
   last two so that they fill the sequence; what is left of a sequence, and the pieces left
   over, are packed best-fit, each combination as often as the remaining lengths allow.
3. A combination used m times owns the next m sequences. The pieces of each length are
   dealt to its places by rank: rank in the task plus the counts of earlier tasks.

The driver's work depends on the number of distinct lengths, not on the rows; no
task holds more than a batch of texts. The number of sequences is at least
ceil(ids / sequence length), and usually that.

Null texts count as empty (they are the end id alone). Repeated rows are packed as
often as they appear. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

import json
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import stored, table

SEQUENCE, END_ID = 2048, 0
TOKENIZER = "word_bpe_49k.json"
#: classes of lengths in the program; learning rate and step size of its solver
CLASSES, RATE, STEP = 48, 6.0, 0.25
#: words (and word parts) whose ids a task remembers, and the longest word it remembers
REMEMBER, LONGEST = 400_000, 40


@lru_cache(maxsize=1)
def _tokenizer(path: str):
    """The tokenizer, loaded once a worker, and whether its file has the steps that ``WordIds`` takes itself."""
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(path)
    steps = json.loads(whole.to_str())
    return whole, steps["normalizer"] == _NORMALIZER and steps["pre_tokenizer"] == _SPLITTER


class WordIds(dict):
    """White-space separated word -> its ids as little-endian 32-bit numbers.

    The given tokenizer drops white space and never joins ids across it, so the ids of a
    text are those of its words in order; files of other kinds get whole texts. Parts of
    Latin words (letter runs and so on) are remembered as well, since words differ mostly in
    punctuation; merging a part alone costs a fraction of a call to the whole tokenizer.
    Words of other scripts go to that.
    """

    def __init__(self, path: str):
        super().__init__()
        self.whole, self.by_word = _tokenizer(path)
        # the tokenizer's own steps for Latin words: lower case, split into parts, merge a part
        self.merge = self.whole.model.tokenize
        self.parts: dict[str, bytes] = {"": b""}

    def text(self, text: str) -> bytes:
        """The ids of a text; a file with other steps gets it whole."""
        return b"".join(map(self.__getitem__, _words(text))) if self.by_word else self._encode(text)

    def __missing__(self, word: str) -> bytes:
        ids = self._ids(word) if word else b""
        if len(word) <= LONGEST:
            if len(self) >= REMEMBER:
                self.clear()
            self[word] = ids
        return ids

    def _ids(self, word: str) -> bytes:
        if ("<|" in word or len(word) > LONGEST  # special tokens, odd words, other scripts: as they are
                or not word.isascii() and max(word) >= _NOT_LATIN):
            return self._encode(word)
        core = word.rstrip(_MARKS)
        low = core.lower()
        if low.isalpha():  # letters, then marks: two parts at most
            ids = self._part(low)
            return ids if len(core) == len(word) else ids + self._part(word[len(core):])
        return b"".join(self._part(part) for part in _PARTS.findall(word.lower()))

    def _part(self, part: str) -> bytes:
        ids = self.parts.get(part)
        if ids is None:
            if len(self.parts) >= REMEMBER:
                self.parts = {"": b""}
            as_bytes = part if part.isascii() and part.isprintable() else _byte_letters(part)
            ids = self.parts[part] = array("I", [t.id for t in self.merge(as_bytes)]).tobytes()
        return ids

    def _encode(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


#: fixed values: the splitting pattern of the tokenizer file, on normalised text, and its steps
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITTER = {"type": "Sequence", "pretokenizers": [
    {"type": "Split", "pattern": {"Regex": _PARTS.pattern}, "behavior": "Removed", "invert": True},
    {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}
#: marks that often end a word; they make one part of their own
_MARKS = ".,;:!?"
#: words of characters before this one are composed already: lower-casing is all that the
#: tokenizer's normaliser does to them
_NOT_LATIN = "\u0250"
#: byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100 on
_PLAIN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_LETTERS = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - set(_PLAIN)))}


def _byte_letters(part: str) -> str:
    """The UTF-8 bytes of ``part`` as letters of the byte-level alphabet."""
    return part.encode().decode("latin-1").translate(_LETTERS)


def _words(text: str) -> list[str]:
    """Words between plain white space (other kinds of space are the tokenizer's matter)."""
    return text.replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ")


def _pieces(path: str, sequence: int, end_id: int, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordIds(path)
        end = np.array([end_id], "<u4").tobytes()
        task = TaskContext.get().partitionId()
        ranks = np.zeros(sequence + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for at, text in enumerate(batch.column(1).to_pylist()):
                ids = words.text(text or "") + end
                for piece, start in enumerate(range(0, len(ids), 4 * sequence)):
                    part = ids[start:start + 4 * sequence]
                    length = len(part) // 4
                    rows.append((at, piece, start // 4, length, zlib.crc32(part), task,
                                 ranks[length], part if keep_ids else None))
                    ranks[length] += 1
            if not rows:
                continue
            at, *cols = zip(*rows, strict=True)
            kinds = [pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int64()]
            arrays = [batch.column(0).take(pa.array(at)),
                      *(pa.array(c, k) for c, k in zip(cols, kinds, strict=False))]
            names = ["id", "piece", "start", "length", "ids_crc32", "task", "rank"]
            if keep_ids:
                arrays.append(pa.array(cols[6], pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def tokenized_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
                     keep_ids: bool = False) -> DataFrame:
    """Pieces of all documents with their rank among equal lengths of the same task."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(TOKENIZER)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, piece int, start long, length int, ids_crc32 long, task int, rank long"
              + ", ids binary" * keep_ids)
    return picked.mapInArrow(_pieces(path, sequence, end_id, keep_ids), schema)


class Program(NamedTuple):
    """A covering of the classes: each combination (class, copies) and how often, and a dual bound."""

    amounts: dict[tuple[tuple[int, int], ...], float]
    covered: np.ndarray
    bound: float


def length_classes(counts: np.ndarray, most: int = CLASSES) -> list[tuple[int, int]]:
    """Runs of lengths [low, high) with like numbers of tokens, ``most`` of them at most."""
    lengths = np.flatnonzero(counts)
    if len(lengths) <= most:
        return [(int(k), int(k) + 1) for k in lengths]
    tokens = np.cumsum(counts[lengths] * lengths)
    cuts = np.searchsorted(tokens, np.arange(1, most) * (tokens[-1] / most)) + 1
    edges = sorted({0, *cuts.tolist(), len(lengths)})
    return [(int(lengths[a]), int(lengths[b - 1]) + 1) for a, b in zip(edges, edges[1:])]


def price(values: np.ndarray, sizes: np.ndarray, most: np.ndarray, room: int) -> tuple[dict[int, int], float]:
    """The most valuable combination that fits, and its value: bounded knapsack by dynamic programming.

    A piece of class k has size ``sizes[k]``, is worth ``values[k]``, and there are ``most[k]``.
    """
    best = np.zeros(room + 1)
    took: list[tuple[int, int, int, np.ndarray]] = []
    for k in np.flatnonzero((values > 0) & (most > 0) & (sizes <= room)).tolist():
        left, copies = int(min(most[k], room // sizes[k])), 1
        while left:
            copies = min(copies, left)
            left -= copies
            size = copies * int(sizes[k])
            with_it = best[:-size] + copies * values[k]
            better = with_it > best[size:]
            np.copyto(best[size:], with_it, where=better)
            took.append((k, copies, size, better))
            copies *= 2
    worth, chosen = float(best[room]), {}
    for k, copies, size, better in reversed(took):
        if size <= room and better[room - size]:
            chosen[k] = chosen.get(k, 0) + copies
            room -= size
    return chosen, worth


def solve_configurations(n: np.ndarray, sizes: np.ndarray, room: int, rate: float = RATE, step: float = STEP) -> Program:
    """A fractional solution of the covering program for ``n[k]`` pieces of size ``sizes[k]``.

    Coverage z of a class starts at 0; its weight is exp(-rate * z) until it is covered. Every
    step adds the best-priced combination: ``step`` times as often as the scarcest of its
    classes allows, or as it takes to cover one of them. Weights over the best price are
    feasible dual prices, so their sum bounds the number of sequences from below.
    """
    covered, bound = np.zeros(len(n)), float(n @ sizes) / room  # sizes by themselves are feasible prices
    amounts: dict[tuple, float] = {}
    while (covered < 1).any():
        weight = np.where(covered < 1, np.exp(-rate * covered), 0)
        combination, worth = price(weight / n, sizes, n, room)
        bound = max(bound, weight.sum() / worth)
        uses = np.array(list(combination.items()))
        share = uses[:, 1] / n[uses[:, 0]]  # of a class, per use
        lack = 1 - covered[uses[:, 0]]
        times = min(step / share.max(), (lack / share).min())
        covered[uses[:, 0]] += times * share
        covered[uses[:, 0][lack - times * share < 1e-9]] = 1
        key = tuple(sorted(combination.items(), reverse=True))
        amounts[key] = amounts.get(key, 0.0) + times
    return Program(amounts, covered, bound)


def _best_fit(left: np.ndarray, room: int, chosen: dict[int, int]) -> None:
    """Fill ``room`` with the longest piece left that fits, and so on; ``chosen`` has some already."""
    free = left[:room + 1].copy()
    for length, copies in chosen.items():
        if length <= room:
            free[length] -= copies
    while room:
        fits = np.flatnonzero(free[:room + 1] > 0)
        if not len(fits):
            break
        length = int(fits[-1])
        copies = min(int(free[length]), room // length)
        chosen[length] = chosen.get(length, 0) + copies
        free[length] -= copies
        room -= copies * length


def _filled(combination: tuple[tuple[int, int], ...], spans: list[tuple[int, int]], left: np.ndarray,
            room: int) -> dict[int, int]:
    """Lengths for the classes of a combination, the last two chosen to fill the sequence."""
    free, chosen = left.copy(), {}
    slots = [spans[k] for k, copies in combination for _ in range(copies)]  # longest first

    def take(length: int) -> None:
        nonlocal room
        chosen[length] = chosen.get(length, 0) + 1
        free[length] -= 1
        room -= length

    while len(slots) > 2:
        low, high = slots.pop(0)
        found = np.flatnonzero(free[low:min(high, room + 1)])
        if len(found):
            take(low + int(found[-1]))
    longest = np.maximum.accumulate(np.where(free[:room + 1] > 0, np.arange(room + 1), 0))
    if len(slots) == 2:
        low, high = slots.pop(0)
        first = low + np.flatnonzero(free[low:min(high, room + 1)])
        if len(first):
            mate = longest[room - first]
            mate[(mate < slots[0][0]) | (mate == first) & (free[first] < 2)] = 0
            at = int(np.argmax(first + mate))
            take(int(first[at]))
            if mate[at]:
                take(int(mate[at]))
            slots.pop()
    if slots and longest[room] >= slots[0][0]:
        take(int(longest[room]))
    return chosen


class Packing(NamedTuple):
    """Whole combinations (lengths and copies, how often), and how they came about."""

    plan: list[tuple[dict[int, int], int]]
    program: Program | None
    #: share of the tokens of uncut sequences that the program's combinations place
    share: float


def pack_histogram(counts: np.ndarray, classes: int = CLASSES) -> Packing:
    """Combinations that use every piece exactly once.

    ``counts[l]`` pieces have length l; the last index is the length of a sequence.
    """
    counts = counts.astype(np.int64)
    sequence, left = len(counts) - 1, counts.copy()
    plan: list[tuple[dict[int, int], int]] = []
    if left[sequence]:
        plan.append(({sequence: 1}, int(left[sequence])))
        left[sequence] = 0
    if not left.any():
        return Packing(plan, None, 0.0)
    tokens = int((left * np.arange(sequence + 1)).sum())

    def use(combination: dict[int, int], most: int) -> int:
        times = min(most, *(int(left[k]) // a for k, a in combination.items()))
        plan.append((combination, times))
        for k, a in combination.items():
            left[k] -= times * a
        return times

    spans = length_classes(left, classes)
    n = np.array([left[a:b].sum() for a, b in spans], float)
    sizes = np.array([int((left[a:b] * np.arange(a, b)).sum() // left[a:b].sum()) for a, b in spans])
    program, placed = solve_configurations(n, sizes, sequence), 0
    for combination, amount in sorted(program.amounts.items(), key=lambda x: (-x[1], x[0])):
        todo = int(amount + 1e-9)
        while todo and (own := _filled(combination, spans, left, sequence)):
            size = sum(k * a for k, a in own.items())
            _best_fit(left, sequence - size, own)
            times = use(own, todo)
            todo, placed = todo - times, placed + times * size
    while left.any():
        rest: dict[int, int] = {}
        _best_fit(left, sequence, rest)
        use(rest, int(left.max()))
    return Packing(plan, program, placed / tokens)


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, ...]]:
    """For each length: first rank, first sequence, places in a sequence, offset of each use."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used: dict[int, int] = {}
    sequence_id = 0
    for combination, times in plan:
        offset = 0
        for length, copies in sorted(combination.items(), reverse=True):
            out.setdefault(length, []).append((used.get(length, 0), sequence_id, copies, offset))
            used[length] = used.get(length, 0) + times * copies
            offset += copies * length
        sequence_id += times
    return {k: tuple(np.array(c) for c in zip(*v, strict=True)) for k, v in out.items()}


def _deal(places: dict[int, tuple[np.ndarray, ...]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(k).to_numpy(zero_copy_only=False) for k in
                            (batch.schema.get_field_index("length"), batch.schema.get_field_index("rank")))
            sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
            for value in np.unique(length).tolist():
                rows = np.nonzero(length == value)[0]
                first, base, copies, start = places[value]
                use = np.searchsorted(first, rank[rows], side="right") - 1
                place = rank[rows] - first[use]
                sequence[rows] = base[use] + place // copies[use]
                offset[rows] = start[use] + place % copies[use] * value
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(sequence), pa.array(offset)],
                                             names=[*batch.schema.names, "sequence_id", "offset"])

    return run


def pack(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
         path: str | None = None, sequence: int = SEQUENCE, end_id: int = END_ID,
         keep_ids: bool = False) -> DataFrame:
    """One row per piece: id, piece, start, length, ids_crc32, sequence_id, offset (, ids)."""
    pieces = stored(spark, tokenized_pieces(docs, id_col, text_col, path, sequence, end_id, keep_ids),
                    "packing-pieces")
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    by_task = stored(spark, by_task, "packing-counts")
    counts = np.zeros(sequence + 1, np.int64)
    for row in by_task.groupBy("length").agg(F.sum("n").alias("n")).toArrow().to_pylist():
        counts[row["length"]] = row["n"]
    places = _places(pack_histogram(counts).plan)
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    before = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = (pieces.join(before, ["task", "length"])
              .select("id", "piece", "start", "length", "ids_crc32",
                      (F.col("rank") + F.col("before")).alias("rank"), *["ids"] * keep_ids))
    kind = ranked.schema["id"].dataType.simpleString()
    schema = (f"id {kind}, piece int, start long, length int, ids_crc32 long, rank long"
              + ", ids binary" * keep_ids + ", sequence_id long, offset long")
    return ranked.mapInArrow(_deal(places), schema).select(
        F.col("id").alias(id_col), "piece", "start", F.col("length").cast("long").alias("length"),
        "ids_crc32", "sequence_id", "offset", *["ids"] * keep_ids)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark, table(spark, sf_dir, "documents"))
