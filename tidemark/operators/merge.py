"""Keyed upsert and export conformance (M1, M1a-c, P10, P11, V6).

``merge_upsert`` reproduces ``INSERT ... ON CONFLICT (keys) DO UPDATE SET
<update_cols>`` applied row by row in ``order_by`` order:
  * unmatched key  -> the row is inserted (for a key repeated in the updates,
    insert-only columns come from its first row, update columns from its last);
  * matched key    -> only ``update_cols`` are overwritten, by the last row;
  * target rows without updates are kept unchanged.
Plan: one aggregation collapses the updates per key (map-side combinable,
no window over an unbounded group), then one full outer equi-join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import lenient_timestamp


def collapse_updates(updates: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
                     insert_only: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """One row per key, as row-by-row ``ON CONFLICT`` application would leave it
    (M1c): update columns from the key's last row, insert-only columns from its
    first, in ``order_by`` order (then every other column as tie-break). Rows
    with a null key are dropped. Returns keys + struct columns ``_last`` and
    ``_first``; one aggregation, map-side combinable."""
    keys = list(keys)
    order = list(order_by) + [c for c in updates.columns if c not in order_by and c not in keys]
    order_key = F.struct(*order)
    not_null_keys = F.lit(True)
    for k in keys:
        not_null_keys = not_null_keys & F.col(k).isNotNull()
    return (updates.where(not_null_keys).groupBy(*keys)
            .agg(F.max_by(F.struct(*update_cols), order_key).alias("_last"),
                 F.min_by(F.struct(*insert_only), order_key).alias("_first")))


def merge_upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
                 update_cols: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    keys, update_cols = list(keys), list(update_cols)
    cols = target.columns
    insert_only = [c for c in cols if c not in keys and c not in update_cols]
    collapsed = collapse_updates(updates, keys, update_cols, insert_only, order_by) \
        .withColumn("_u", F.lit(True))
    t = target.withColumn("_t", F.lit(True))
    j = t.join(collapsed, keys, "full_outer")
    out = []
    for c in cols:
        if c in keys:
            out.append(F.col(c))
        elif c in update_cols:
            out.append(F.when(F.col("_u"), F.col(f"_last.{c}")).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(F.col("_t"), F.col(c)).otherwise(F.col(f"_first.{c}")).alias(c))
    return j.select(*out)


def conform(df: DataFrame, schema: T.StructType, key_cols: Sequence[str] = ("window_start",),
            observation: Observation | None = None) -> DataFrame:
    """Shape a frame to an export whitelist.

    P10: keep whitelisted columns in declared order; a missing one arrives as a
    typed null (the reference only warned, then failed at bind time).
    P11: timestamp columns given as text are coerced leniently (bad -> null).
    V6: rows with a null key are dropped; the count is available through
    ``observation`` (metric ``dropped_null_key``) after the first action.
    """
    present = set(df.columns)
    sel = []
    for f in schema.fields:
        if f.name not in present:
            sel.append(F.lit(None).cast(f.dataType).alias(f.name))
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)) and \
                isinstance(df.schema[f.name].dataType, T.StringType):
            c = lenient_timestamp(c)
        sel.append(c.cast(f.dataType).alias(f.name))
    shaped = df.select(*sel)
    null_key = F.lit(False)
    for k in key_cols:
        null_key = null_key | F.col(k).isNull()
    if observation is not None:
        shaped = shaped.observe(observation,
                                F.sum(F.when(null_key, 1).otherwise(0)).alias("dropped_null_key"))
    return shaped.where(~null_key)
