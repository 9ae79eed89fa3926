"""Every registered query against its DuckDB oracle (sf0.001), approximate
distinct counts within their error bound (sf0.01)."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from conftest import SF_ORACLE, SF_SMALL
from tidemark.plans.batch import Layers
from tidemark.plans.catalog import registry
from tidemark.plans.check import compare, duckdb_connection
from tidemark.plans.oracle import build

ORACLE = build()


@pytest.fixture(scope="module")
def con():
    return duckdb_connection(SF_SMALL)


def test_every_query_has_an_oracle():
    assert set(registry()) == set(ORACLE)


@pytest.mark.parametrize("kind", ["user", "order"])
def test_the_merge_queries_hold_every_class_of_rows(kind):
    """Untouched, updated, inserted and repeated new keys, and insert-only values that differ."""
    big = duckdb_connection(SF_ORACLE)
    sql = ORACLE[f"merge_{kind}_metrics"]
    ctes = sql[:sql.rindex("SELECT COALESCE")]
    ask = lambda what: big.execute(ctes + what).fetchone()[0]
    key = "(product_id, window_start)"
    in_target, in_upd = f"{key} IN (SELECT {key} FROM target)", f"{key} IN (SELECT {key} FROM upd)"
    assert ask(f"SELECT count(*) FROM target WHERE NOT {in_upd}") > 0
    assert ask(f"SELECT count(*) FROM target WHERE {in_upd}") > 0
    assert ask(f"SELECT count(*) FROM upd WHERE NOT {in_target}") > 0
    assert ask("SELECT count(*) FROM (SELECT 1 FROM upd WHERE batch_id = 2 "
               f"GROUP BY {key[1:-1]} HAVING count(*) > 1)") > 0
    assert ask(f"SELECT count(*) FROM (SELECT 1 FROM upd WHERE NOT {in_target} GROUP BY {key[1:-1]} "
               "HAVING count(DISTINCT category) > 1 AND count(DISTINCT window_end) > 1)") > 0
    assert ask("SELECT count(*) FROM target t JOIN upd u USING (product_id, window_start) "
               "WHERE t.category <> u.category AND t.window_end <> u.window_end") > 0
    cols = ", ".join(d[0] for d in big.execute(sql).description)
    result = f"SELECT {cols} FROM ({sql})"
    for other in (f"SELECT {cols} FROM target", f"SELECT {cols} FROM upd WHERE batch_id = 2"):
        assert ask(f"SELECT count(*) FROM ({result} EXCEPT {other})") > 0
    assert big.execute(f"SELECT count(*) FROM ({result} EXCEPT SELECT {cols} FROM "
                       f"({ORACLE[f'{kind}_metrics_1h']}))").fetchone()[0] > 0


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, con, name):
    r = compare(registry()[name](spark, SF_SMALL), con, ORACLE[name])
    assert r["columns_match"], r
    assert r["spark_rows"] == r["oracle_rows"] > 0, r
    assert r["values_match"], r


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "unique_users" in df.columns


def test_approx_distinct_error_bound(spark):
    lay = Layers(spark, SF_ORACLE)
    users = lay.silver_user()
    exact = lay.user_gold("1 day", "exact").select("product_id", "window_start", F.col("unique_users").alias("e"))
    approx = lay.user_gold("1 day", "approx").select("product_id", "window_start", F.col("unique_users").alias("a"))
    j = exact.join(approx, ["product_id", "window_start"])
    # rsd 0.05: per group within 4 standard deviations (or one, for tiny groups
    # where a single register collision is already a miss by one), mean within rsd
    err = F.abs(F.col("a") - F.col("e"))
    stats = j.select(
        F.sum(F.when(err > F.greatest(F.lit(1.0), 4 * 0.05 * F.col("e")), 1).otherwise(0)).alias("outside"),
        F.avg(err / F.col("e")).alias("mean"),
        F.count(F.lit(1)).alias("n")).first()
    assert stats.n == exact.count() and users.count() > 0
    assert stats.outside == 0 and stats.mean <= 0.05
