"""Embedding near-dedup by an epsilon grid order join.

Vectors link at cosine >= ``cosine``, which for unit vectors is a distance of at most
eps = sqrt(2 - 2 cosine). Equal vectors first become one class with a weight, so a
group of copies of any size is one point.

1. Principal axes come from the exact second moments of all classes (partial sums per
   task, added up by Spark; dimensions squared numbers reach the driver).
2. Points are sorted by their grid cells (side eps) on the ``LEADING`` first axes, then
   by their position, and cut into sequence intervals with a bounding box on ``BOXED``
   axes. Orthogonal projection never lengthens a distance, so intervals whose boxes
   are more than eps apart hold no links.
3. Interval pairs are refined level by level from one interval of everything:
   each level is an equi-join on interval numbers, distant pairs are dropped.
4. Surviving pairs of intervals meet in one task each and go on recursively there, in
   halves, until ``LEAF`` points a side. A leaf is a product in single precision with a
   safety margin; what comes near the threshold is decided in double precision.
   A task gives link weights per point and a spanning forest, never all pairs.

Null vectors, zero vectors and those with null or non-finite components link with
nothing. Vectors of different length are compared as if the shorter one ended in
zeros. Repeated rows count as further vectors. Rows with a null id count in the links
of others but name no component. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import components, session_conf, stored, table
from .simhash import forest

COSINE = 0.9
LEADING, BOXED = 4, 16
#: points of an interval (most), of a shipped chunk and of a leaf of the recursion
INTERVAL, CHUNK, LEAF = 16384, 512, 256
#: children of an interval on the way from one interval to all
FANOUT = 16


def _usable(vec: str) -> F.Column:
    v = F.col(vec)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    return F.coalesce(v.isNotNull() & finite & F.exists(v, lambda x: x != 0), F.lit(False))


def _unit(column: pa.Array, width: int) -> np.ndarray:
    """Rows as unit vectors in double precision, padded with zeros to ``width``."""
    sizes = pc.list_value_length(column).to_numpy(zero_copy_only=False)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), width))
    out[np.arange(width)[None, :] < sizes[:, None]] = flat
    out /= np.abs(out).max(axis=1, keepdims=True)  # no overflow in the squares
    return out / np.linalg.norm(out, axis=1, keepdims=True)


def _axes(classes: DataFrame, width: int) -> np.ndarray:
    """Principal axes (columns, leading first) of all unit vectors."""
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width + 1, width + 1))
        for batch in batches:
            if batch.num_rows:
                unit = _unit(batch.column(0), width)
                unit = np.column_stack([unit, np.ones(len(unit))])
                total += unit.T @ unit
        yield pa.record_batch([pa.array(np.arange(total.size)), pa.array(total.ravel())], names=["at", "x"])

    rows = (classes.select("vec").mapInArrow(sums, "at long, x double").groupBy("at")
            .agg(F.sum("x").alias("x")).toArrow())
    total = np.zeros((width + 1) ** 2)
    total[rows["at"].to_numpy()] = rows["x"].to_numpy()
    total = total.reshape(width + 1, width + 1)
    mean = total[-1, :-1] / max(total[-1, -1], 1)
    moments = total[:-1, :-1] / max(total[-1, -1], 1) - np.outer(mean, mean)
    return np.linalg.eigh(moments)[1][:, ::-1]


def _placed(axes: np.ndarray, eps: float, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                spot = _unit(batch.column(1), width) @ axes[:, :LEADING]
                cells = np.floor(spot / eps).astype(np.int32)
                yield pa.record_batch([*batch.columns, pa.array(list(cells), pa.list_(pa.int32())),
                                       pa.array(list(spot), pa.list_(pa.float64()))],
                                      names=["cls", "vec", "n", "cell", "spot"])
    return run


def _chunked(axes: np.ndarray, width: int, interval: int):
    """Consecutive rows of a sorted task as chunks: part, seq, interval, box, points."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, rows = 0, 0
        left: pa.Table | None = None

        def chunk(part: pa.Table) -> pa.RecordBatch:
            nonlocal seq, rows
            unit = _unit(part["vec"].combine_chunks(), width) @ axes
            box = unit[:, :BOXED]
            row = {"piece": rows // interval, "seq": seq, "low": box.min(axis=0).tolist(),
                   "high": box.max(axis=0).tolist(), "points": unit.tobytes(),
                   "cls": part["cls"].to_numpy().astype("<i8").tobytes(),
                   "n": part["n"].to_numpy().astype("<i8").tobytes()}
            seq, rows = seq + 1, rows + len(unit)
            return pa.RecordBatch.from_pylist([row], schema=schema)

        schema = pa.schema([("piece", pa.int64()), ("seq", pa.int64()), ("low", pa.list_(pa.float64())),
                            ("high", pa.list_(pa.float64())), ("points", pa.binary()),
                            ("cls", pa.binary()), ("n", pa.binary())])
        for batch in batches:
            own = pa.Table.from_batches([batch])
            left = own if left is None else pa.concat_tables([left, own])
            while left.num_rows >= CHUNK:
                yield chunk(left.slice(0, CHUNK))
                left = left.slice(CHUNK)
        if left is not None and left.num_rows:
            yield chunk(left)
    return run


def _gap(low_a, high_a, low_b, high_b):
    return np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))


class _Side:
    """One interval of a pair: its points, class numbers and weights."""

    def __init__(self, points: np.ndarray, cls: np.ndarray, n: np.ndarray):
        self.points, self.cls, self.n = points, cls, n
        self.single = points.astype(np.float32)
        self.links = np.zeros(len(cls), np.int64)


def _leaf_pairs(a: _Side, b: _Side, cosine: float, eps: float, same: bool) -> Iterator[tuple]:
    """(i, j) of all links between the sides: halves are skipped once provably distant."""
    margin = 1e-6 * a.points.shape[1] + 1e-6
    stack = [(0, len(a.cls), 0, len(b.cls))]
    boxes: dict[tuple, tuple] = {}

    def box(side: _Side, low: int, high: int, name: str) -> tuple:
        key = (name, low, high)
        if key not in boxes:
            part = side.points[low:high, :BOXED]
            boxes[key] = part.min(axis=0), part.max(axis=0)
        return boxes[key]

    while stack:
        a0, a1, b0, b1 = stack.pop()
        if same and b1 <= a0:  # the mirror image of a part that is done
            continue
        gap = _gap(*box(a, a0, a1, "a"), *box(b, b0, b1, "b"))
        if gap @ gap > eps * eps * (1 + 1e-9):
            continue
        if a1 - a0 > LEAF or b1 - b0 > LEAF:
            if a1 - a0 >= b1 - b0:
                mid = (a0 + a1) // 2
                stack += [(a0, mid, b0, b1), (mid, a1, b0, b1)]
            else:
                mid = (b0 + b1) // 2
                stack += [(a0, a1, b0, mid), (a0, a1, mid, b1)]
            continue
        i, j = np.nonzero(a.single[a0:a1] @ b.single[b0:b1].T >= cosine - margin)
        i, j = i + a0, j + b0
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            sure = np.einsum("ij,ij->i", a.points[i], b.points[j]) >= cosine
            if sure.any():
                yield i[sure], j[sure]


def _join(cosine: float, eps: float, width: int):
    """Rows sorted by (a, b, side, seq): the chunks of both intervals of each pair."""
    schema = pa.schema([("cls", pa.int64()), ("links", pa.int64()), ("root", pa.int64())])

    def points(rows: list[dict]) -> _Side:
        return _Side(np.concatenate([np.frombuffer(r["points"]).reshape(-1, width) for r in rows]),
                     *(np.concatenate([np.frombuffer(r[k], "<i8") for r in rows]) for k in ("cls", "n")))

    def settle(left: _Side, right: _Side | None) -> pa.RecordBatch:
        other = left if right is None else right
        base = 0 if right is None else len(left.cls)
        cls = left.cls if right is None else np.concatenate([left.cls, right.cls])
        label = np.arange(len(cls))
        left.links[:] = 0
        other.links[:] = 0
        held: list[tuple] = []
        size = 0

        def merge() -> None:
            nonlocal label, held, size
            a, b = (np.concatenate(x) for x in zip(*held, strict=True))
            label = forest(len(cls), np.concatenate([a, np.arange(len(cls))]),
                           np.concatenate([b, label]))
            held, size = [], 0

        for i, j in _leaf_pairs(left, other, cosine, eps, right is None):
            left.links += np.bincount(i, other.n[j], len(left.cls)).astype(np.int64)
            other.links += np.bincount(j, left.n[i], len(other.cls)).astype(np.int64)
            held.append((i, j + base))
            size += len(i)
            if size > 1 << 20:
                merge()
        if held:
            merge()
        links = left.links if right is None else np.concatenate([left.links, right.links])
        some = np.nonzero(links)[0]
        return pa.record_batch([pa.array(cls[some]), pa.array(links[some]),
                                pa.array(cls[label[some]])], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, first, second = None, [], []
        for batch in batches:
            for row in batch.to_pylist():
                if (row["a"], row["b"]) != key:
                    if key is not None:
                        yield settle(points(first), points(second) if second else None)
                    key, first, second = (row["a"], row["b"]), [], []
                (second if row["side"] else first).append(row)
        if key is not None:
            yield settle(points(first), points(second) if second else None)

    return run


def _interval_pairs(spark: SparkSession, boxes: DataFrame, count: int, eps: float) -> DataFrame:
    """Pairs (a, b), a <= b, of interval numbers whose boxes are at most eps apart."""
    levels, top = 0, count
    while top > 1:
        levels, top = levels + 1, -(-top // FANOUT)
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))

    def children(node: str) -> F.Column:
        return F.explode(F.sequence(F.col(node) * FANOUT, F.col(node) * FANOUT + FANOUT - 1)).alias(node)

    for level in range(levels - 1, -1, -1):
        each = boxes.select(F.floor(F.col("interval") / FANOUT ** level).alias("node"),
                            F.posexplode(F.arrays_zip("low", "high")).alias("axis", "side"))
        box = (each.groupBy("node", "axis").agg(F.min("side.low").alias("low"), F.max("side.high").alias("high"))
               .groupBy("node").agg(F.sort_array(F.collect_list(F.struct("axis", "low", "high"))).alias("box")))
        grown = pairs.select(children("a"), "b").select("a", children("b")).where("a <= b")
        met = (grown.join(box.select(F.col("node").alias("a"), F.col("box").alias("box_a")), "a")
               .join(box.select(F.col("node").alias("b"), F.col("box").alias("box_b")), "b"))
        apart = F.aggregate(F.zip_with("box_a", "box_b", lambda x, y: F.greatest(
            F.lit(0.0), x["low"] - y["high"], y["low"] - x["high"])), F.lit(0.0), lambda s, g: s + g * g)
        pairs = met.where(apart <= eps * eps * (1 + 1e-9)).select("a", "b")
    return pairs


def embedding_links(spark: SparkSession, vectors: DataFrame, id_col: str = "vec_id",
                    vec_col: str = "embedding", cosine: float = COSINE) -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component_id, kept."""
    eps = float(np.sqrt(2 - 2 * cosine))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    good = rows.where(_usable("vec"))
    classes = stored(spark, good.groupBy("vec").agg(F.min("id").alias("low"), F.count("*").alias("n"))
                     .select(F.monotonically_increasing_id().alias("cls"), "vec", "n", "low"), "vectors-classes")
    found = classes.agg(F.count("*"), F.max(F.size("vec"))).first()
    count, width = found[0], found[1] or 1
    if count:
        axes = _axes(classes, width)
        # intervals large enough to limit what is sent twice, small enough to use the cluster
        interval = int(min(INTERVAL, max(CHUNK, -(-count // (12 * CHUNK)) * CHUNK)))
        parts = max(1, -(-count // interval))
        spots = (classes.select("cls", "vec", "n").mapInArrow(
            _placed(axes, eps, width),
            f"cls long, vec {classes.schema['vec'].dataType.simpleString()}, n long, "
            "cell array<int>, spot array<double>"))
        spots = stored(spark, spots, "vectors-spots")
        order = ["cell", "spot", "cls"]
        ordered = spots.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        with session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="4096"):
            chunks = ordered.select("cls", "vec", "n").mapInArrow(
                _chunked(axes, width, interval), "piece long, seq long, low array<double>, "
                "high array<double>, points binary, cls binary, n binary")
            chunks = stored(spark, chunks.select(F.spark_partition_id().cast("long").alias("part"), "*"),
                            "vectors-chunks")
        # number the intervals in order: parts have few of them, counted per part
        per_part = chunks.agg(F.max("piece"), F.max("part")).first()
        stride = per_part[0] + 1
        chunks = chunks.withColumn("interval", F.col("part") * stride + F.col("piece"))
        pairs = stored(spark, _interval_pairs(spark, chunks.select("interval", "low", "high"),
                                              (per_part[1] + 1) * stride, eps), "vectors-pairs")
        sides = (pairs.select("a", "b", F.lit(0).alias("side"), F.col("a").alias("interval"))
                 .unionByName(pairs.where("a != b").select("a", "b", F.lit(1).alias("side"),
                                                           F.col("b").alias("interval"))))
        # a few tasks per core: pairs are many and small where the range partitions are
        tasks = max(1, min(pairs.count(), 4 * spark.sparkContext.defaultParallelism))
        met = (sides.join(chunks.select("interval", "seq", "points", "cls", "n"), "interval")
               .repartition(tasks, "a", "b").sortWithinPartitions("a", "b", "side", "seq"))
        with session_conf(spark, spark__sql__execution__arrow__maxRecordsPerBatch="32"):
            joined = stored(spark, met.select("a", "b", "side", "points", "cls", "n").mapInArrow(
                _join(cosine, eps, width), "cls long, links long, root long"), "vectors-joined")
        links = joined.groupBy("cls").agg(F.sum("links").alias("links"))
        comps = components(spark, joined.where("cls != root").select("cls", "root"), "vectors-links")
        rooted = (classes.select("cls", "vec", "n", "low").join(links, "cls", "left")
                  .join(comps, F.col("cls") == F.col("node"), "left")
                  .select("vec", "low", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                          F.coalesce("root", "cls").alias("root")))
        named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
        known = rooted.join(named, "root").select("vec", "n_links", "component_id")
        linked = good.join(known, "vec").select("id", "n_links", "component_id")
    else:
        linked = good.select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    alone = rows.where(~_usable("vec")).select("id", F.lit(0).cast("long").alias("n_links"),
                                               F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)).alias("kept"))


def op4_embedding_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_links(spark, table(spark, sf_dir, "embeddings"))
