"""Vector code compression by product codes, assigned through memoised grid cells.

Vectors are cut into ``parts`` equal consecutive parts; each part position has a codebook
of ``entries`` integer entries, and a vector's code is the number of the nearest entry of
each part. Codebooks start as the parts of the first vectors in id order and are refined
in ``rounds`` rounds (assign all parts, replace each entry by the floored mean of its
parts; an unused entry stays).

Nearest entries come from coarse cells: a part falls into a cell of a grid over its
codebook's range. For a cell seen first, every entry gets its least and largest distance
to the cell's box; an entry whose least distance is above some other's largest one is
dominated, nearest to no point of the box. The others are remembered under the cell, and
only they are evaluated, exactly in whole numbers. The memory holds at most ``MEMORY``
cells a part and starts anew beyond that; it changes no result.

Tasks send counts and sums per entry, never vectors: parts x entries x width numbers come to
the driver a round, however long the table is.

Null vectors and those with null or non-finite components are dropped; ids may be null or
repeat. Vectors of different lengths, or of a length that is no multiple of ``parts``, are
ended with zeros to the next multiple above the longest. Fewer vectors than entries give
shorter codebooks. Ties go to the lower entry. Of equal ids the lesser vector comes first
in the start codebook, null ids come last. Empty tables give no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import forget, stored, table
from .integer_vectors import SCALE, matrix, whole_vectors

PARTS, ENTRIES, ROUNDS = 16, 64, 2
#: grid cells over a codebook's range, and cells remembered per part in a task (most)
GRID, MEMORY = 1296, 1 << 15
#: numbers held at once while candidates are evaluated
BLOCK = 1 << 21
#: a label with more than one row in so many is joined by broadcast
HEAVY = 1024


def _distinct(cells: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of a first row of each kind, and the kind of every row."""
    low = cells.min(axis=0)
    spans = [int(x) for x in cells.max(axis=0) - low + 1]
    if math.prod(spans) < 2 ** 62:  # one number a row
        key = np.zeros(len(cells), np.int64)
        for axis, span in enumerate(spans):
            key = key * span + (cells[:, axis] - low[axis])
    else:
        key = cells.view(np.dtype((np.void, cells.itemsize * cells.shape[1]))).ravel()
    return np.unique(key, return_index=True, return_inverse=True)[1:]


class Cells:
    """The entries of one codebook that can be nearest, by grid cell."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries.astype(np.int64)
        self.low = self.entries.min(axis=0)
        splits = max(1, int(GRID ** (1 / entries.shape[1]) + 1e-9))
        self.side = np.maximum(1, -(-(self.entries.max(axis=0) - self.low + 1) // splits))
        self.known: dict[bytes, np.ndarray] = {}

    def undominated(self, cells: np.ndarray) -> list[np.ndarray]:
        """Per cell, the entries that are nearest to some point of its box, or may be."""
        out: list[np.ndarray] = []
        for at in range(0, len(cells), max(1, BLOCK // self.entries.size)):
            low = self.low + cells[at:at + max(1, BLOCK // self.entries.size)] * self.side
            high = low + self.side - 1
            least = np.zeros((len(low), len(self.entries)), np.int64)
            most = np.zeros_like(least)
            for axis in range(low.shape[1]):
                below = low[:, axis, None] - self.entries[None, :, axis]
                above = self.entries[None, :, axis] - high[:, axis, None]
                least += np.maximum(0, np.maximum(below, above)) ** 2
                most += np.maximum(np.abs(below), np.abs(above)) ** 2
            row, entry = np.nonzero(least <= most.min(axis=1, keepdims=True))
            ends = np.searchsorted(row, np.arange(len(low) + 1)).tolist()
            out += [entry[a:b] for a, b in zip(ends, ends[1:])]
        return out

    def nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the nearest entry and squared distance, per point."""
        step = max(1, BLOCK // self.entries.size)
        found = [self._nearest(points[at:at + step]) for at in range(0, len(points), step)]
        entry, squared = zip(*found, strict=True)
        return np.concatenate(entry), np.concatenate(squared)

    def _nearest(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        cells = np.ascontiguousarray((points - self.low) // self.side)
        first, own = _distinct(cells)
        if len(self.known) + len(first) > MEMORY:
            self.known.clear()
        names = [row.tobytes() for row in cells[first]]
        new = [k for k, name in enumerate(names) if name not in self.known]
        if new:
            self.known.update(zip([names[k] for k in new], self.undominated(cells[first[new]]), strict=True))
        lists = [self.known[name] for name in names]
        sizes = np.array([len(x) for x in lists])
        starts = np.cumsum(sizes) - sizes
        counts = sizes[own]
        begin = np.cumsum(counts) - counts
        row = np.repeat(np.arange(len(points)), counts)
        entry = np.concatenate(lists)[np.arange(len(row)) - begin[row] + starts[own][row]]
        gap = points[row] - self.entries[entry]
        squared = (gap * gap).sum(axis=1)
        best = np.minimum.reduceat(squared, begin)
        hit = np.flatnonzero(squared == best[row])
        hit = hit[np.unique(row[hit], return_index=True)[1]]  # entries ascend within a row
        return entry[hit], best


class _Assign:
    """Codes of batches; the cell memory lives as long as its task."""

    def __init__(self, books: np.ndarray):
        self.books = books  # part, entry, component

    def codes(self, cells: list[Cells], points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts, _, width = self.books.shape
        code = np.empty((len(points), parts), np.int64)
        error = np.zeros(len(points), np.int64)
        for p in range(parts):
            code[:, p], squared = cells[p].nearest(points[:, p * width:(p + 1) * width])
            error += squared
        return code, error

    def sums(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(slot, n): counts and component sums of each entry; slots number them."""
        parts, entries, width = self.books.shape
        cells = [Cells(b) for b in self.books]
        total = np.zeros((parts, entries, width + 1), np.int64)
        for batch in batches:
            if batch.num_rows:
                points = matrix(batch.column(0), parts * width)
                code, _ = self.codes(cells, points)
                for p in range(parts):
                    own = np.column_stack([np.ones(len(points), np.int64),
                                           points[:, p * width:(p + 1) * width]])
                    np.add.at(total[p], code[:, p], own)
        some = np.flatnonzero(total)
        yield pa.record_batch([pa.array(some), pa.array(total.ravel()[some])], names=["slot", "n"])

    def rows(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The kept columns with code and error."""
        parts, _, width = self.books.shape
        cells = [Cells(b) for b in self.books]
        for batch in batches:
            if batch.num_rows:
                code, error = self.codes(cells, matrix(batch.column(0), parts * width))
                digits = code.astype(np.uint8).tobytes().hex()
                text = [digits[at:at + 2 * parts] for at in range(0, len(digits), 2 * parts)]
                yield pa.record_batch([*batch.columns[1:], pa.array(text), pa.array(error)],
                                      names=[*batch.schema.names[1:], "code", "error"])


def fit(spark: SparkSession, whole: DataFrame, parts: int = PARTS, entries: int = ENTRIES,
        rounds: int = ROUNDS) -> np.ndarray | None:
    """Codebooks (part, entry, component) of a table of integer vectors ``vec`` with ``id``."""
    if not 1 <= entries <= 256:
        raise ValueError("a code holds two hex digits a part: 1 to 256 entries")
    longest = whole.agg(F.max(F.size("vec"))).first()[0]
    if longest is None:
        return None
    width = max(1, -(-longest // parts))
    first = whole.orderBy(F.col("id").asc_nulls_last(), "vec").limit(entries).select("vec").toArrow()
    books = matrix(first["vec"], parts * width).reshape(-1, parts, width).transpose(1, 0, 2)
    for _ in range(rounds):
        books = np.ascontiguousarray(books)
        found = (whole.select("vec").mapInArrow(_Assign(books).sums, "slot long, n long")
                 .groupBy("slot").agg(F.sum("n").alias("n")).toArrow())
        total = np.zeros(books.shape[:2] + (width + 1,), np.int64)
        total.reshape(-1)[found["slot"].to_numpy()] = found["n"].to_numpy()
        count = total[..., :1]
        books = np.where(count > 0, total[..., 1:] // np.maximum(count, 1), books)
    return np.ascontiguousarray(books)


def encode(whole: DataFrame, books: np.ndarray) -> DataFrame:
    """The columns of ``whole`` without the vector, with ``code`` and ``error``."""
    kept = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in whole.schema.fields if f.name != "vec")
    rest = [c for c in whole.columns if c != "vec"]
    return whole.select("vec", *rest).mapInArrow(_Assign(books).rows, f"{kept}, code string, error long")


def decode(code: str, books: np.ndarray) -> np.ndarray:
    """The integer vector that a code stands for."""
    return np.concatenate([books[p][e] for p, e in enumerate(bytes.fromhex(code))])


def digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_group_total(rows: DataFrame, key: str, value: str, name: str) -> DataFrame:
    """``rows`` with the sum of ``value`` over equal keys (nulls together).

    Keys with over one row in ``HEAVY`` are fewer than ``HEAVY`` and reach the rows by
    broadcast; the rows of the other keys meet their totals in an ordinary join.
    """
    totals = rows.groupBy(F.col(key).alias("_key")).agg(F.sum(value).alias(name), F.count("*").alias("_n"))
    limit = rows.count() / HEAVY
    heavy = F.broadcast(totals.where(F.col("_n") > limit))
    same = F.col(key).eqNullSafe(F.col("_key"))
    rest = rows.join(heavy, same, "left_anti").join(totals.where(F.col("_n") <= limit), same)
    return rows.join(heavy, same).unionByName(rest).drop("_key", "_n")


def vector_codes(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding",
                 label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES,
                 rounds: int = ROUNDS, scale: int = SCALE) -> DataFrame:
    """One row per kept vector: id, label, code, error, label_error, codebooks_sha256."""
    whole = stored(spark, whole_vectors(vectors, vec_col, {"id": id_col, "label": label_col}, scale),
                   "codes-vectors")
    books = fit(spark, whole, parts, entries, rounds)
    if books is None:
        coded = whole.select("id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        sha = digest(np.zeros(0, np.int64))
    else:
        coded, sha = stored(spark, encode(whole, books), "codes-rows"), digest(books)
        forget(spark, whole)
    return with_group_total(coded, "label", "error", "label_error").select(
        F.col("id").alias(id_col), F.col("label").alias(label_col), "code", "error", "label_error",
        F.lit(sha).alias("codebooks_sha256"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes(spark, table(spark, sf_dir, "embeddings"))


def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    """The same codes by comparing every part with every entry (vectors of one length)."""
    steps = [f"""WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label,
         list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
piece AS MATERIALIZED (
  SELECT r, p, list_slice(v, 1 + p * (len(v) // {parts}), (p + 1) * (len(v) // {parts})) AS x
  FROM kept, range({parts}) AS t(p)),
first AS (SELECT r, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM kept
          QUALIFY e < {entries}),
book0 AS MATERIALIZED (SELECT p, e, x AS c FROM piece JOIN first USING (r))"""]
    near = """near{n} AS MATERIALIZED (
  SELECT r, p, min(d * 256 + e) % 256 AS e, min(d * 256 + e) // 256 AS d FROM (
    SELECT r, p, e, CAST(list_sum(list_transform(list_zip(x, c), lambda t: (t[1] - t[2]) * (t[1] - t[2]))) AS BIGINT) AS d
    FROM piece JOIN book{n} USING (p)) GROUP BY r, p)"""
    for n in range(rounds):
        steps.append(near.format(n=n))
        steps.append(f"""mean{n} AS (
  SELECT p, e, list(m ORDER BY i) AS c FROM (
    SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS m
    FROM (SELECT p, e, x, unnest(range(1, len(x) + 1)) AS i FROM near{n} JOIN piece USING (r, p)) GROUP BY p, e, i)
  GROUP BY p, e),
book{n + 1} AS MATERIALIZED (SELECT p, e, coalesce(m.c, b.c) AS c FROM book{n} b LEFT JOIN mean{n} m USING (p, e))""")
    steps.append(near.format(n=rounds))
    steps.append(f"""coded AS MATERIALIZED (
  SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
  FROM near{rounds} GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS s FROM book{rounds})""")
    return ",\n".join(steps) + """
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT s FROM books) AS codebooks_sha256
FROM kept JOIN coded USING (r)"""


ORACLE = _oracle()
