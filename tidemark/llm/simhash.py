"""SimHash near-dedup with bit-sliced Hamming comparison.

Fingerprints. A-Z lower-cased, words are runs of anything but ASCII white space,
shingles are ``words`` consecutive words (repeats count, fewer words: the whole
sequence), each hashed with XXH64 (seed 42). A fingerprint bit is 1 where over
half the shingle hashes have it; no words give fingerprint 0.

Links. Two fingerprints link at ``radius`` or fewer differing bits.

* Equal fingerprints meet in one partial aggregation, so a group of copies of any
  size goes on as a single row.
* 64 bits in ``BLOCKS`` blocks: fingerprints within the radius agree on at least
  ``BLOCKS - radius`` blocks, so a key for each choice of that many blocks brings
  every linked pair together in some bucket (pigeonhole, exact).
* Buckets over ``TILE`` rows are cut into tiles that are compared pairwise in
  separate groups; no task ever needs a whole bucket.
* Inside a group the fingerprints stand as 64 vertical bit planes. XOR with a query's
  bit gives the lanes that differ; carry-save counters over the planes add up all
  distances at once, and a block of queries is abandoned once every lane is over the
  radius. A group gives a spanning forest of its links, not all its pairs.
* The links' components are found by star contraction (``common.components``).

Null texts count as empty. Null ids take part in links and never name a component
unless no other id is in it (then the component id is null). Repeated rows are
copies like any other. Empty tables give no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import components, fresh, stored, table

WORDS, RADIUS, SEED = 3, 3, 42
#: blocks the 64 bits are cut into
BLOCKS = 5
#: most rows of one side of a comparison
TILE = 1024
#: rows compared together when small buckets are gathered
GATHER = 512
#: shingle hashes held at a time, so that long texts need bounded memory
CHUNK = 1 << 15

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """The unsigned 64-bit SimHash of one text."""
    tokens = (text or "").encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not tokens:
        return 0
    total = max(len(tokens) - words + 1, 1)
    counts = np.zeros(64, np.int64)
    for at in range(0, total, CHUNK):
        part = tokens[at:at + CHUNK + words - 1]
        grams = ([b" ".join(part)] if total == 1 else
                 map(b" ".join, zip(*(part[k:] for k in range(words)), strict=False)))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), "<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = np.packbits(counts * 2 > total, bitorder="little")
    return int(set_bits.view("<u8")[0])


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _digest(text_col: str) -> Column:
    return F.unhex(F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 words: int = WORDS, digests: bool = False) -> DataFrame:
    """(id, fp): the fingerprint as a signed long, for every row; ``digests``: and the text's digest."""
    picked = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                         *([_digest(text_col).alias("digest")] if digests else []))
    kind = picked.schema["id"].dataType.simpleString()
    names = ["id", "fp", *picked.columns[2:]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [_signed(fingerprint(t.as_py(), words)) for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(out, pa.int64()), *batch.columns[2:]], names=names)

    return picked.mapInArrow(run, f"id {kind}, fp long" + ", digest binary" * digests)


def bit_planes(prints: np.ndarray) -> np.ndarray:
    """64 rows of packed bits, one lane per fingerprint, padded to whole 64-bit words."""
    lanes = -(-len(prints) // 64) * 64
    padded = np.zeros(lanes, np.uint64)
    padded[:len(prints)] = prints
    shifts = np.arange(64, dtype=np.uint64)[:, None]
    bits = ((padded[None, :] >> shifts) & np.uint64(1)).astype(np.uint8)
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def near_lanes(queries: np.ndarray, planes: np.ndarray, lanes: int,
               radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(query index, lane) of every pair at ``radius`` or fewer differing bits.

    The counters start at 2^k - 1 - radius, so a carry out of the top bit means
    that a lane is over the radius.
    """
    depth = max(int(radius).bit_length(), 1)
    offset = (1 << depth) - 1 - radius
    full = np.uint64(0xFFFFFFFFFFFFFFFF)
    width = planes.shape[1]
    valid = np.zeros(width * 64, np.uint8)
    valid[:lanes] = 1
    dead = ~np.packbits(valid, bitorder="little").view("<u8")
    rows = np.arange(len(queries))
    counters = [np.full((len(queries), width), full if offset >> k & 1 else np.uint64(0))
                for k in range(depth)]
    over = np.repeat(dead[None, :], len(queries), axis=0)
    for bit in range(64):
        query = np.where((queries[rows] >> np.uint64(bit)) & np.uint64(1), full, np.uint64(0))
        carry = planes[bit][None, :] ^ query[:, None]
        for counter in counters:
            ripple = counter & carry
            np.bitwise_xor(counter, carry, out=counter)
            carry = ripple
        over |= carry
        if bit >= 15 and bit % 4 == 3:
            alive = (over != full).any(axis=1)
            if not alive.any():
                return np.empty(0, np.int64), np.empty(0, np.int64)
            if alive.sum() < 0.75 * len(rows):
                rows, over = rows[alive], over[alive]
                counters = [c[alive] for c in counters]
    found, lane = np.nonzero(np.unpackbits((~over).view(np.uint8), axis=1, bitorder="little"))
    return rows[found], lane


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links a-b, the smallest node each one hangs together with."""
    label = np.arange(n)
    while len(a):
        la, lb = label[a], label[b]
        open_ = la != lb
        if not open_.any():
            break
        a, b, la, lb = a[open_], b[open_], la[open_], lb[open_]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label = label[label]
    return label


def _links(left: np.ndarray, right: np.ndarray | None, radius: int) -> Iterator[tuple]:
    """Spanning links between ``left`` and ``right`` (or inside ``left``), as (low, high)."""
    other = left if right is None else right
    planes, base = bit_planes(other), 0 if right is None else len(left)
    found = [(np.empty(0, np.int64),) * 2]
    for at in range(0, len(left), 256):
        rows, lane = near_lanes(left[at:at + 256], planes, len(other), radius)
        found.append((rows + at, lane + base))
    a, b = (np.concatenate(x) for x in zip(*found, strict=True))
    every = left if right is None else np.concatenate([left, right])
    label = forest(len(every), a, b)
    moved = np.nonzero(label != np.arange(len(every)))[0]
    return every[moved], every[label[moved]]


def _compare(radius: int):
    """Compare rows sorted by group: (grp, i, j, slot, fp)."""

    def emit(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
        return pa.record_batch([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))],
                               names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []  # columns of rows not compared yet, whole groups first

        def settle(cols: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            grp, i, j, slot, fp = cols
            cut = np.nonzero((grp[1:] != grp[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))[0] + 1
            starts, ends = np.r_[0, cut], np.r_[cut, len(grp)]
            small: list[slice] = []
            size = 0
            for s, e in zip(starts.tolist(), ends.tolist(), strict=True):
                if i[s] != j[s]:
                    mine = slot[s:e] == i[s]
                    yield emit(*_links(fp[s:e][mine], fp[s:e][~mine], radius))
                elif e - s > GATHER:
                    yield emit(*_links(fp[s:e], None, radius))
                else:  # small buckets share a comparison; a link across them is a true link too
                    if size + e - s > GATHER:
                        yield emit(*_links(np.concatenate([fp[x] for x in small]), None, radius))
                        small, size = [], 0
                    small.append(slice(s, e))
                    size += e - s
            if small:
                yield emit(*_links(np.concatenate([fp[x] for x in small]), None, radius))

        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            cols[4] = cols[4].view(np.uint64)
            held = cols if not held else [np.concatenate(x) for x in zip(held, cols, strict=True)]
            grp, i, j = held[:3]
            last = np.nonzero((grp != grp[-1]) | (i != i[-1]) | (j != j[-1]))[0]
            if len(grp) >= 4 * TILE and len(last):  # all but the last group is whole
                end = last[-1] + 1
                yield from settle([c[:end] for c in held])
                held = [c[end:] for c in held]
        if held and len(held[0]):
            yield from settle(held)

    return run


def link_forest(spark: SparkSession, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS,
                tile: int = TILE) -> DataFrame:
    """Links (a, b) that span every component of distinct fingerprints ``fp``."""
    edges = np.linspace(0, 64, blocks + 1).astype(int).tolist()
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    keys = []
    for k, pick in enumerate(combinations(spans, blocks - radius)):
        key = F.lit(k).cast("long")
        for low, high in pick:
            part = F.shiftrightunsigned("fp", low).bitwiseAND(F.lit((1 << (high - low)) - 1).cast("long"))
            key = F.shiftleft(key, high - low).bitwiseOR(part)
        keys.append(key)
    keyed = prints.select("fp", F.explode(F.array(*keys)).alias("grp"))
    crowd = keyed.groupBy("grp").agg(F.count("*").alias("n")).where("n > 1")
    tiles = F.ceil(F.col("n") / tile).cast("int")
    slot = F.pmod(F.xxhash64("fp"), F.col("tiles")).cast("int")
    met = (keyed.join(crowd, "grp").withColumn("tiles", tiles).withColumn("slot", slot)
           .withColumn("mate", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
           .select("grp", F.least("slot", "mate").alias("i"), F.greatest("slot", "mate").alias("j"),
                   "slot", "fp"))
    dealt = met.repartition("grp", "i", "j").sortWithinPartitions("grp", "i", "j", "slot")
    return dealt.mapInArrow(_compare(radius), "a long, b long")


def _classes(spark: SparkSession, rows: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(fp, root, component_id) for each fingerprint of ``rows``; ``root`` is one of the component's fingerprints."""
    prints = stored(spark, rows.groupBy("fp").agg(F.min("id").alias("low")), "simhash-distinct")
    links = link_forest(spark, prints.select("fp"), radius)
    comps = components(spark, links, "simhash-links")
    rooted = (prints.join(comps, F.col("fp") == F.col("node"), "left")
              .select("fp", "low", F.coalesce("root", "fp").alias("root")))
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(named, "root").select("fp", "root", "component_id")


def simhash_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                       text_col: str = "text", words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """One row per row of ``docs``: id, fp (signed long), component_id (smallest id reachable)."""
    rows = stored(spark, fingerprints(docs, id_col, text_col, words), "simhash-prints")
    return rows.join(_classes(spark, rows, radius), "fp").select("id", "fp", "component_id")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(spark, table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"),
                        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def drop_near_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay: of each component one row with its smallest id.

    Of several such rows the one with the smallest text stays (of equal texts the first).
    A null id stays only where its component has no other id. Rows of different
    components never stand for each other, whatever their ids.
    """
    digest, row, root, rank, low, same = fresh(docs, "digest", "row", "root", "rank", "id", "same")
    rows = stored(spark, fingerprints(docs, id_col, text_col, digests=True), "simhash-prints")
    # id and text decide the component, so they find the rows again
    stay = (rows.join(_classes(spark, rows), "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
            .select(F.col("id").alias(low), F.col("digest").alias(same),
                    F.col("root").alias(root)).distinct())
    marked = docs.withColumn(digest, _digest(text_col)).withColumn(row, F.monotonically_increasing_id())
    kept = marked.join(stay, (marked[digest] == stay[same]) & marked[id_col].eqNullSafe(stay[low]))
    first = Window.partitionBy(root).orderBy(F.col(text_col), F.col(row))
    return (kept.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
            .select(*docs.columns))
