"""Mixing sources to target weights by systematic sampling.

The size of a document is its number of words. Sources, in code point order with null last,
get the weights in turn and share ``share`` times all words by weight; a target stops at
``most`` times its source's words, and what is over is shared again by weight among the
others until no target is above.

Every document of a source is expected ``target / source words`` times. Within a source
these expectations are summed up in the order of size (then a hash of the id, the id and
the text's hash), one offset drawn from the source's name and the seed is added, and a
document is emitted once for each whole number that its stretch of the sum crosses. A
document thus comes ``floor`` or ``ceil`` of its expectation times, never more than
``most``; as neighbours in that order have like sizes, a source's words differ from its
target by less than its longest document. Sums are whole numbers over a common
denominator, so no rounding adds a copy.

A source may hold any share of the rows: the order is a range partitioning over source and
size, positions are counted within a range and get the counts of the earlier ranges, and
every join is on (range, source). Sources are rows of a table too, numbered the same way;
only totals come to the driver. Nothing depends on the partitioning, so reruns agree.

Null texts have size 0, like texts of white space alone. Null ids come first within their
size. Documents of size 0 weigh nothing; a source without words has target 0 and takes
none. Equal rows are separate documents. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import forget, stored, table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (3, 1, 2)
SHARE, MOST = Fraction(3, 2), 2
SEED = 0
#: the offset is a whole number of STEPS-ths of a document
STEPS = 1 << 20
RESULT = ("size", "source_size", "target", "copies", "taken")


def _whole(value: Column | int) -> Column:
    """A whole number beyond a long's range."""
    value = F.lit(str(value)) if isinstance(value, int) else value
    return value.cast("decimal(38,0)")


def _ordered(spark: SparkSession, rows: DataFrame, order: Sequence[Column], group: str) -> tuple:
    """``rows`` sorted and written, and where each group starts in each range.

    Returns the rows with ``range`` and ``row`` (ascending within a range) and one row per
    (range, group): ``first`` (its first ``row``) and ``before`` (rows of the group in
    earlier ranges). A row's place in its group is ``row - first + before``.
    """
    ranged = (rows.repartitionByRange(*order).sortWithinPartitions(*order)
              .withColumn("row", F.monotonically_increasing_id()))
    ranged = stored(spark, ranged.withColumn("range", F.shiftright("row", 33)), "mix-ordered")
    starts = ranged.groupBy("range", group).agg(F.min("row").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy(group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = starts.select("range", group, "first",
                           F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    return ranged, starts


def _joined(left: DataFrame, right: DataFrame, *keys: str) -> DataFrame:
    """Inner join with equal nulls; the keys once."""
    same = [left[k].eqNullSafe(right[k]) for k in keys]
    found = left.join(right, [*same])
    for k in keys:
        found = found.drop(right[k])
    return found


def source_targets(spark: SparkSession, sized: DataFrame, weights: Sequence[int] = WEIGHTS,
                   share: Fraction = SHARE, most: int = MOST) -> DataFrame:
    """One row per source of (source, size): source, source_size, target, and the expected
    copies of its documents as ``num / den``."""
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    sources, starts = _ordered(spark, sources.withColumn("all", F.lit(0)),
                               [F.col("source").asc_nulls_last()], "all")
    place = F.col("row") - F.col("first") + F.col("before")
    turn = F.element_at(F.array(*map(F.lit, weights)), (place % len(weights) + 1).cast("int"))
    sources = stored(spark, _joined(sources, starts, "range", "all")
                     .select("source", "source_size", turn.cast("long").alias("weight")), "mix-sources")
    total = sources.agg(F.sum("source_size")).first()[0] or 0
    level, full = Fraction(0), F.lit(False)
    while True:  # each turn holds more sources at their most
        held = sources.agg(F.sum(F.when(full, F.col("source_size")).otherwise(0)).alias("size"),
                           F.sum(F.when(full, 0).otherwise(F.col("weight"))).alias("weight")).first()
        new = (share * total - most * (held.size or 0)) / held.weight if held.weight else level
        if new == level:
            break
        level = new
        full = (_whole(F.col("weight")) * _whole(level.numerator)
                > _whole(F.col("source_size")) * _whole(most * level.denominator))
    part = _whole(F.col("weight")) * _whole(level.numerator)
    return sources.select(
        "source", "source_size",
        F.when(full, (F.col("source_size") * most).cast("double"))
        .otherwise(part.cast("double") / F.lit(float(level.denominator))).alias("target"),
        F.when(full, _whole(most)).otherwise(part).alias("num"),
        F.when(full, _whole(1)).otherwise(_whole(F.col("source_size")) * _whole(level.denominator)).alias("den"))


def mix(spark: SparkSession, docs: DataFrame, keep: Sequence[str] = ("doc_id",), id_col: str = "doc_id",
        text_col: str = "text", source_col: str = "source", weights: Sequence[int] = WEIGHTS,
        share: Fraction = SHARE, most: int = MOST, seed: int = SEED) -> DataFrame:
    """One row per document: the ``keep`` columns, size, source_size, target, copies, taken.

    A kept column named like one of the result's own is left out. ``emit`` repeats the rows.
    """
    kept = [c for c in keep if c not in RESULT]
    text = F.coalesce(F.col(text_col), F.lit(""))
    sized = stored(spark, docs.select(
        F.struct(*kept).alias("kept"), F.col(source_col).alias("source"), F.col(id_col).alias("id"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), F.xxhash64(text).alias("hash"),
        F.monotonically_increasing_id().alias("seat")), "mix-sized")  # seat: equal rows fill many ranges
    targets = source_targets(spark, sized, weights, share, most)
    order = [F.col("source").asc_nulls_last(), F.col("size"), F.md5(F.col("id").cast("string")), F.col("id"),
             F.col("hash"), F.col("seat")]
    rows, starts = _ordered(spark, sized, order, "source")
    forget(spark, sized)
    step = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit(""))), 256), 1, 5), 16, 10)
    starts = _joined(starts, targets.withColumn("step", step.cast("long")), "source")
    found = _joined(rows, starts, "range", "source")
    place = F.col("row") - F.col("first") + F.col("before")

    def crossed(documents: Column) -> Column:
        """Whole numbers passed after so many documents of the source."""
        return F.call_function("div", _whole(documents) * F.col("num") * _whole(STEPS)
                               + _whole(F.col("step")) * F.col("den"), F.col("den") * _whole(STEPS))

    copies = F.when(F.col("source_size") > 0, crossed(place + 1) - crossed(place)).otherwise(0)
    return (found.select("kept.*", "size", "source_size", "target", copies.cast("long").alias("copies"))
            .withColumn("taken", F.col("copies") * F.col("size")))


def emit(mixed: DataFrame) -> DataFrame:
    """The mix itself: each document as often as it is taken, without the result's figures."""
    once = F.explode(F.array_repeat(F.lit(True), F.col("copies").cast("int")))
    return mixed.select("*", once.alias("_once")).drop("_once", *RESULT)


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(spark, table(spark, sf_dir, "documents"))


ORACLE = f"""WITH sized AS MATERIALIZED (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size
  FROM documents),
src AS MATERIALIZED (
  SELECT source, CAST(sum(size) AS HUGEINT) AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w,
         ('0x' || substr(sha256('{SEED}:' || coalesce(source, '')), 1, 5))::BIGINT AS step
  FROM sized GROUP BY source),
full_ AS MATERIALIZED (
  SELECT s.*, (SELECT sum(least(2 * t.source_size * s.w, 2 * s.source_size * t.w)) FROM src t) * 2
              < 3 * (SELECT sum(source_size) FROM src) * s.w AS at_most
  FROM src s),
rest AS (
  SELECT 3 * sum(source_size) - 4 * coalesce(sum(source_size) FILTER (at_most), 0) AS p,
         2 * sum(w) FILTER (NOT at_most) AS q FROM full_),
target AS MATERIALIZED (
  SELECT source, source_size, step,
         CASE WHEN at_most THEN CAST(2 * source_size AS DOUBLE) ELSE CAST(p * w AS DOUBLE) / CAST(q AS DOUBLE) END AS target,
         CAST(CASE WHEN at_most THEN 2 ELSE p * w END AS HUGEINT) AS num,
         CAST(CASE WHEN at_most THEN 1 ELSE q * source_size END AS HUGEINT) AS den
  FROM full_, rest),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY size, md5(CAST(doc_id AS VARCHAR)) NULLS FIRST,
                               doc_id NULLS FIRST) AS n FROM sized)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(copies AS BIGINT) AS copies,
       CAST(copies * size AS BIGINT) AS taken
FROM (
  SELECT d.doc_id, d.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN
           (n * num * {STEPS} + step * den) // (den * {STEPS}) - ((n - 1) * num * {STEPS} + step * den) // (den * {STEPS})
         ELSE 0 END AS copies
  FROM placed d JOIN target t ON d.source IS NOT DISTINCT FROM t.source)"""
