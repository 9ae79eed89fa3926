"""Exact dedup by a heavy-hitter split, in DataFrame operations only.

Texts are equal when their SHA-256 digests (UTF-8, null read as empty) are equal.

1. A mergeable Misra-Gries style frequent-items sketch over the digests
   (``approx_top_k``, ``SLOTS`` counters) names every digest that may hold more than
   rows / ``SLOTS`` rows. The sketch is a partial aggregate of fixed size.
2. The named digests are counted exactly; those that are that frequent are the
   winners, each with the row that stays. There are at most ``SLOTS`` of them, so
   the broadcast has a fixed bound (about 150 bytes a row, under 200 kB).
3. Rows of winner digests are decided on the map side and never shuffled. The
   other digests, each at most rows / ``SLOTS`` rows, go through one shuffle.

Of equal texts the row with the largest id stays (null ids are smallest); of
repeated rows that share this id, one. Empty tables give no rows; extra columns of
any name are left alone.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import fresh, stored, table

#: counters of the frequent-items sketch, and the most winners that are broadcast
SLOTS = 1024


def text_digest(text_col: str) -> F.Column:
    return F.sha2(F.coalesce(F.col(text_col).cast("string"), F.lit("")), 256)


def frequent_digests(spark: SparkSession, rows: DataFrame, slots: int = SLOTS) -> DataFrame:
    """Verified heavy hitters of ``rows`` (id, rid, digest), written once.

    Returns (digest, keep_id, keep_rid, n), at most ``slots`` rows, each with more
    than count / ``slots`` rows.
    """
    named = (rows.agg(F.expr(f"approx_top_k(digest, {slots}, {slots * 4})").alias("top"),
                      F.count("*").alias("total"))
             .select("total", F.explode("top.item").alias("digest")))
    exact = (rows.join(F.broadcast(named), "digest").groupBy("digest", "total")
             .agg(F.max(F.struct("id", "rid")).alias("keep"), F.count("*").alias("n"))
             .where(F.col("n") * slots > F.col("total"))
             .select("digest", F.col("keep.id").alias("keep_id"), F.col("keep.rid").alias("keep_rid"),
                     "n"))
    return stored(spark, exact, "dedup-frequent")


def exact_dedup(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    rows = stored(spark, docs.select(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("rid"),
                                     text_digest(text_col).alias("digest")), "dedup-digests")
    heavy = F.broadcast(frequent_digests(spark, rows, slots))
    done = (rows.join(heavy, "digest")
            .select("id", "keep_id", F.col("n").alias("group_size"),
                    (F.col("rid") == F.col("keep_rid")).alias("kept"), "digest"))
    same = Window.partitionBy("digest")
    rest = (rows.join(heavy.select("digest"), "digest", "left_anti")
            .withColumn("keep", F.max(F.struct("id", "rid")).over(same))
            .withColumn("group_size", F.count("*").over(same))
            .select("id", F.col("keep.id").alias("keep_id"), "group_size",
                    (F.col("rid") == F.col("keep.rid")).alias("kept"), "digest"))
    return done.unionByName(rest).select(F.col("id").alias(id_col), "keep_id", "group_size", "kept",
                                         F.col("digest").alias("text_sha256"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id",
                      text_col: str = "text", slots: int = SLOTS) -> DataFrame:
    """The rows of ``docs`` that stay, with their own columns.

    Rows of a winner digest other than the one that stays are removed before the
    shuffle; the rest meet once by digest (partial top-1 first), so each remaining
    text travels at most once.
    """
    digest, rank = fresh(docs, "digest", "rank")
    ids = stored(spark, docs.select(F.col(id_col).alias("id"), F.lit(0).alias("rid"),
                                    text_digest(text_col).alias("digest")), "dedup-digests")
    heavy = frequent_digests(spark, ids, slots).select(
        F.col("digest").alias("_w_digest"), F.col("keep_id").alias("_w_keep"))
    marked = docs.select("*", text_digest(text_col).alias(digest))
    left = (marked.join(F.broadcast(heavy), (marked[digest] == heavy["_w_digest"])
                        & ~marked[id_col].eqNullSafe(heavy["_w_keep"]), "left_anti"))
    first = Window.partitionBy(digest).orderBy(F.col(id_col).desc_nulls_last())
    return (left.withColumn(rank, F.row_number().over(first)).where(F.col(rank) == 1)
            .select(*docs.columns))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
