"""Keyed upsert with ON CONFLICT semantics and export conformance (FIXTURES §4)."""

from pyspark.sql import Observation
from pyspark.sql import types as T

from tidemark.operators.merge import conform, merge_upsert

SCHEMA = "pid int, ws string, name string, cat string, we string, n int"
UPD = "pid int, ws string, name string, cat string, we string, n int, ord int"
KEYS, UPDATE = ["pid", "ws"], ["name", "n"]


def _merge(spark, target, updates):
    t = spark.createDataFrame(target, SCHEMA)
    u = spark.createDataFrame(updates, UPD)
    return merge_upsert(t, u, KEYS, UPDATE, ["ord"]).drop("ord")


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


TARGET = [(1, "t0", "old", "catA", "we_old", 5), (2, "t0", "keep", "catB", "we", 7)]
UPDATES = [(1, "t0", "new", "catZ", "we_new", 9, 1), (1, "t0", "newer", "catY", "we_new2", 10, 2),
           (3, "t0", "ins", "catC", "we", 1, 1)]
EXPECTED = [(1, "t0", "newer", "catA", "we_old", 10), (2, "t0", "keep", "catB", "we", 7),
            (3, "t0", "ins", "catC", "we", 1)]


def test_insert_update_untouched(spark):
    out = _merge(spark, TARGET, UPDATES)
    assert out.columns == ["pid", "ws", "name", "cat", "we", "n"]
    assert _rows(out) == EXPECTED


def test_rerun_is_idempotent(spark):
    first = [tuple(r) for r in _merge(spark, TARGET, UPDATES).collect()]
    again = _merge(spark, first, UPDATES)
    assert _rows(again) == EXPECTED


def test_duplicate_new_key_first_insert_last_update(spark):
    out = _merge(spark, TARGET, [(4, "t0", "x", "c1", "w1", 1, 1), (4, "t0", "y", "c2", "w2", 2, 2)])
    assert (4, "t0", "y", "c1", "w1", 2) in _rows(out)


def test_input_order_does_not_matter(spark):
    out = _merge(spark, TARGET, list(reversed(UPDATES)))
    assert _rows(out) == EXPECTED


def test_null_key_update_is_ignored(spark):
    out = _merge(spark, TARGET, UPDATES + [(None, "t0", "bad", "c", "w", 1, 3)])
    assert _rows(out) == EXPECTED


def test_conform_whitelist_typed_nulls_and_null_key_drop(spark):
    schema = T.StructType([
        T.StructField("product_id", T.StringType()), T.StructField("window_start", T.TimestampType()),
        T.StructField("view_count", T.LongType()), T.StructField("add_to_cart_rate", T.DoubleType())])
    df = spark.createDataFrame(
        [("P1", "2024-01-01T10:00:00+00:00", 3, "extra"), ("P2", "garbage", 1, "extra"),
         ("P3", None, 2, "extra")],
        "product_id string, window_start string, view_count int, junk string")
    obs = Observation("conform")
    out = conform(df, schema, observation=obs)
    rows = out.collect()
    assert out.columns == ["product_id", "window_start", "view_count", "add_to_cart_rate"]
    assert out.schema["add_to_cart_rate"].dataType == T.DoubleType()
    assert out.schema["view_count"].dataType == T.LongType()
    assert [(r.product_id, r.add_to_cart_rate) for r in rows] == [("P1", None)]
    assert obs.get["dropped_null_key"] == 2


def test_merge_plan_collapses_updates_before_join(spark):
    """Updates are collapsed by an aggregate (partial + final), not a window."""
    import contextlib
    import io
    out = _merge(spark, TARGET, UPDATES)
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        out.explain()
    plan = buf.getvalue()
    assert "partial_max_by" in plan and "partial_min_by" in plan
    assert "Window" not in plan
