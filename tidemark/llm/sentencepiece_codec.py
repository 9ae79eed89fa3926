"""SentencePiece encoding and decoding by a streaming Viterbi pass.

The pass walks over the normalised text and keeps, for each of the last boundaries a
piece can still start at (a window of the longest piece), the path that ends there.
Whenever all paths of the window share a boundary, the ids before it are committed and
forgotten, so the pass needs the memory of the window, however long a word or (without
word starts) a text is. A text's normalised form and its ids are held whole, one text at a
time.

What a path needs depends on the model:

* unigram: the sum of piece scores, the best path to a boundary survives;
* BPE (the given vocabulary): a segmentation is the one that merging gives exactly if
  it is so for each two neighbouring pieces, so of the pieces that end at a boundary the
  one that may follow the path before it survives. The ids equal those of the merge
  procedure (the tests compare them with the library).

Characters outside the vocabulary become byte pieces, or the unknown id without them.
No piece holds a word start after another character, so paths always meet at word
starts; words are therefore encoded one by one and remembered by a worker.

Null texts count as empty and have no ids. Decoding gives the normalised text back; it
differs from the text only where the model's normalisation does, and where the text
holds the model's own space mark. Repeated rows are encoded alike; empty tables give
no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
#: words and neighbouring pieces a worker remembers; longer words are not remembered
WORDS, REMEMBER, LONGEST = 800_000, 300_000, 48
#: lengths of a piece that are always tried
TWO = (2,)
_WORDS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")


def _field(message: bytes, wanted: int) -> int | bytes | None:
    """The last value of a protocol-buffer field (numbers and byte strings)."""
    at, found = 0, None

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        kind = key & 7
        if kind == 0:
            value = number()
        elif kind == 2:
            size = number()
            value, at = message[at:at + size], at + size
        else:
            size = 8 if kind == 1 else 4
            value, at = message[at:at + size], at + size
        if key >> 3 == wanted:
            found = value
    return found


class Codec:
    """A model file's vocabulary and normalisation, encoded and decoded by own passes."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor
        self.model = SentencePieceProcessor(model_file=path)
        size = self.model.vocab_size()
        usual = [k for k in range(size) if not (self.model.is_control(k) or self.model.is_unknown(k)
                                                or self.model.is_byte(k) or self.model.is_unused(k))]
        self.pieces = [self.model.id_to_piece(k) for k in range(size)]
        trainer = _field(self.model.serialized_model_proto(), 2) or b""
        kind = _field(trainer, 3) or 1
        self._prepare({self.pieces[k]: k for k in usual}, {k: self.model.get_score(k) for k in usual}, kind == 2)
        self.unknown = self.model.unk_id()
        self.bytes = {int(self.pieces[k][1:-1], 16): k for k in range(size) if self.model.is_byte(k)}
        self.values = {k: bytes([b]) for b, k in self.bytes.items()}
        self.shown = [p.replace(SPACE, " ") for p in self.pieces]
        self.raw = [self.values.get(k) or p.encode() for k, p in enumerate(self.shown)]

    def _prepare(self, ids: dict[str, int], scores: dict[int, float], bpe: bool) -> None:
        self.ids, self.bpe = ids, bpe
        self.by_piece = {p: scores[k] for p, k in ids.items()}
        self.window = max(map(len, ids), default=1)
        self.by_word = not any(SPACE in p.lstrip(SPACE) for p in ids)
        self.floor = min(scores.values(), default=0.0) - 10
        self.words: dict[str, bytes] = {"": b""}
        #: pieces that merging their own text gives back
        #: and for each, which pieces it may follow (as far as met)
        self.whole: dict[str, dict[str, bool]] = {p: {} for p in ids if self.merged(p) == [p]} if bpe else {}
        self.met = 0
        #: lengths of such pieces, longest first, by their last three characters
        lengths: dict[str, set[int]] = {}
        for piece in self.whole:
            if len(piece) > 2:
                lengths.setdefault(piece[-3:], set(TWO)).add(len(piece))
        self.lengths = {end: tuple(sorted(sizes, reverse=True)) for end, sizes in lengths.items()}

    def merged(self, text: str) -> list[str]:
        """Plain merging: the best-scored neighbours first, the leftmost of equals."""
        get, none = self.by_piece.get, -float("inf")
        parts = list(text)
        scores = [get(a + b, none) for a, b in zip(parts, parts[1:])]
        while scores and (best := max(scores)) > none:
            k = scores.index(best)
            parts[k:k + 2] = [parts[k] + parts[k + 1]]
            del scores[k]
            if k:
                scores[k - 1] = get(parts[k - 1] + parts[k], none)
            if k < len(scores):
                scores[k] = get(parts[k] + parts[k + 1], none)
        return parts

    def _may_follow(self, left: str, right: str) -> bool:
        """Whether merging ``left + right`` gives just these two pieces."""
        self.met += 1
        if self.met >= REMEMBER:
            self.met = 0
            for lefts in self.whole.values():
                lefts.clear()
        found = self.whole[right][left] = self.merged(left + right) == [left, right]
        return found

    def segments(self, text: str) -> Iterator[str]:
        """Pieces of normalised text, committed as soon as all live paths share a boundary."""
        # the last piece of the path to a boundary, and the path's score (unigram)
        paths, sums = {0: ""}, {0: 0.0}
        committed = done = 0
        while done < len(text):
            first, done = done + 1, min(len(text), done + 4 * self.window)
            if self.bpe:
                self._merge_survivors(text, paths, committed, first, done)
            else:
                self._best_survivors(text, paths, sums, committed, first, done)
            shared = self._shared(paths, committed, done) if done < len(text) else committed
            if shared > committed:
                yield from self._walk(paths, committed, shared)
                for k in range(committed, shared):
                    del paths[k]
                    sums.pop(k, None)
                committed = shared
        yield from self._walk(paths, committed, len(text))

    def _merge_survivors(self, text: str, paths: dict, committed: int, first: int, last: int) -> None:
        """BPE: the piece that merging leaves in front of a boundary, if the text ended there."""
        whole, lengths = self.whole, self.lengths
        for end in range(first, last + 1):
            near = end - committed
            survivor = text[end - 1]
            for size in lengths.get(text[end - 3:end], TWO) if near > 2 else TWO:
                if size > near:
                    continue
                piece = text[end - size:end]
                lefts = whole.get(piece)
                if lefts is not None:
                    left = paths[end - size]
                    found = lefts.get(left) if left else True
                    if found is None:
                        found = self._may_follow(left, piece)
                    if found:
                        survivor = piece
                        break
            paths[end] = survivor

    def _best_survivors(self, text: str, paths: dict, sums: dict, committed: int, first: int, last: int) -> None:
        """Unigram: the last piece of the best-scored path to a boundary."""
        for end in range(first, last + 1):
            paths[end], sums[end] = text[end - 1], sums[end - 1] + self.floor
            for start in range(max(committed, end - self.window), end):
                score = self.by_piece.get(text[start:end])
                if score is not None and sums[start] + score > sums[end]:
                    paths[end], sums[end] = text[start:end], sums[start] + score

    def _shared(self, paths: dict, committed: int, end: int) -> int:
        """The last boundary on every path that a later piece can still continue."""
        common: set[int] | None = None
        for live in range(max(committed, end - self.window + 1), end + 1):
            at, path = live, set()
            while at > committed:
                path.add(at)
                at -= len(paths[at])
            path.add(committed)
            common = path if common is None else common & path
        return max(common or {committed})

    @staticmethod
    def _walk(paths: dict, low: int, high: int) -> list[str]:
        out = []
        while high > low:
            out.append(paths[high])
            high -= len(paths[high])
        return out[::-1]

    def _word(self, word: str) -> bytes:
        if self.bpe and len(word) <= 4 * self.window:  # one pass, nothing to commit before its end
            paths: dict[int, str] | list[str] = [""] * (len(word) + 1)
            self._merge_survivors(word, paths, 0, 1, len(word))
            pieces = self._walk(paths, 0, len(word))
        else:
            pieces = self.segments(word)
        get, out = self.ids.get, []
        for piece in pieces:
            known = get(piece)
            if known is not None:
                out.append(known)
            elif self.bytes:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(self.unknown)
        return array("I", out).tobytes()

    def encode(self, text: str) -> bytes:
        """The ids of ``text`` as little-endian 32-bit numbers."""
        normal = self.model.normalize(text)
        if not self.by_word:
            return self._word(normal)
        words = _WORDS.findall(normal)
        out = list(map(self.words.get, words))
        if None in out:
            for at, word in enumerate(words):
                if out[at] is None:
                    out[at] = self.words.get(word) or self._new_word(word)
        return b"".join(out)

    def _new_word(self, word: str) -> bytes:
        ids = self._word(word)
        if len(word) <= LONGEST:
            if len(self.words) >= WORDS:
                self.words = {"": b""}
            self.words[word] = ids
        return ids

    def decode(self, ids: bytes) -> str:
        """The text of ids: pieces in a row, byte pieces read as UTF-8, one leading space less."""
        numbers = array("I", ids)
        shown = self.shown
        if not self.values.keys().isdisjoint(numbers):
            text = b"".join(map(self.raw.__getitem__, numbers)).decode("utf-8", "replace")
        else:
            text = "".join(map(shown.__getitem__, numbers))
        return text[1:] if text.startswith(" ") else text


@lru_cache(maxsize=1)
def _codec(path: str) -> Codec:
    """A worker keeps its codec, and with it the words it has met, from task to task."""
    return Codec(path)


def _run(path: str, keep_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                text = text or ""
                ids = codec.encode(text)
                back = codec.decode(ids)
                rows.append((len(ids) // 4, zlib.crc32(ids), len(back),
                             hashlib.sha256(back.encode()).hexdigest(), back == text, ids))
            if not rows:
                continue
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.bool_(), pa.binary())
            cols = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            names = ["id", "n_ids", "ids_crc32", "n_chars", "decoded_sha256", "round_trip", "ids"]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols[:5 + keep_ids]], names=names[:6 + keep_ids])

    return run


def encode_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None,
                 keep_ids: bool = True) -> DataFrame:
    """id, n_ids, ids_crc32, n_chars and decoded_sha256 of the decoded text, round_trip (, ids)."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    kind = picked.schema["id"].dataType.simpleString()
    out = picked.mapInArrow(_run(path, keep_ids), f"id {kind}, n_ids long, ids_crc32 long, n_chars long, "
                            "decoded_sha256 string, round_trip boolean" + ", ids binary" * keep_ids)
    return out.withColumnRenamed("id", id_col)


def decode_ids(rows: DataFrame, ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``rows`` (little-endian 32-bit ids in ``ids_col``) with the decoded text in place of the ids."""
    if path is None:
        import public_tokenizers
        path = public_tokenizers.path(MODEL)
    at = rows.columns.index(ids_col)
    schema = rows.schema
    fields = [(f.name, "string" if k == at else f.dataType.simpleString()) for k, f in enumerate(schema)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(path)
        for batch in batches:
            texts = pa.array([codec.decode(x or b"") for x in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns[:at], texts, *batch.columns[at + 1:]],
                                             names=batch.schema.names)

    return rows.mapInArrow(run, ", ".join(f"`{n}` {t}" for n, t in fields))


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_texts(table(spark, sf_dir, "documents"), keep_ids=False)
