"""Silver validation rules (V1-V5).

A row is valid when every rule evaluates to TRUE (a null verdict rejects).
``rejected`` tags each failing row with the name of the first rule it breaks.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schemas import VALID_EVENT_TYPES


def default_rules() -> list[tuple[str, Column]]:
    # FIXED VALUES: the reference's rule set, in its order.
    return [
        ("event_id_not_null", F.col("event_id").isNotNull()),
        ("event_time_not_null", F.col("event_time").isNotNull()),
        ("product_id_not_null", F.col("product_id").isNotNull()),
        ("price_positive", F.col("price").isNotNull() & (F.col("price") > 0)),
        ("event_type_known", F.col("event_type").isin(*VALID_EVENT_TYPES)),
    ]


def _passes(pred: Column) -> Column:
    return F.coalesce(pred, F.lit(False))


def validate(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    rules = rules or default_rules()
    return df.where(reduce(lambda a, b: a & b, (_passes(p) for _, p in rules)))


def first_failed_rule(rules: list[tuple[str, Column]] | None = None) -> Column:
    rules = rules or default_rules()
    return F.coalesce(*[F.when(~_passes(p), F.lit(name)) for name, p in rules])


def rejected(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Complement of ``validate``, with a ``rejected_rule`` column."""
    return (df.withColumn("rejected_rule", first_failed_rule(rules))
              .where(F.col("rejected_rule").isNotNull()))


def reject_counts(df: DataFrame, rules: list[tuple[str, Column]] | None = None) -> DataFrame:
    """Rejected rows per topic and first failing rule."""
    return (rejected(df, rules).groupBy("topic", "rejected_rule")
            .agg(F.count(F.lit(1)).alias("rejected_rows")))
