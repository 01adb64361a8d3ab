"""Named queries against the same statements in DuckDB, smallest scale."""

import os

import duckdb
import pytest

import __spark_entry__ as entry_module
from acctpulse import schema

SF_DIR = "/root/testdata/sf0.001"
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()
# One feature each, all checked together by ``feature_table``.
SINGLE = set(schema.FEATURE_COLUMNS)
SLOW_ELSEWHERE = {"stream_features", "warm_start", "late_data", "state_inspect", "lof_fit"}

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for name in os.listdir(SF_DIR):
        con.execute(f"create view {name.split('.')[0]} as select * from '{SF_DIR}/{name}'")
    return con


def key(value):
    """Value with its type; a negative zero is not a zero."""
    return (type(value).__name__, repr(value))


def ordered(columns, rows):
    at = [columns.index(c) for c in sorted(columns)]
    return sorted(tuple(key(row[i]) for i in at) for row in rows)


@pytest.mark.parametrize("name", sorted(set(SQL) - SINGLE - SLOW_ELSEWHERE))
def test_matches_sql(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    got = ordered(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(SQL[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    want = ordered(columns, result.fetchall())
    assert len(got) == len(want)
    assert got == want


def test_every_statement_has_a_query():
    assert set(SQL) <= set(QUERIES)


def test_entry(spark):
    assert entry_module.entry(spark).count() > 0


@pytest.mark.parametrize("name, fits, flags", [
    ("iforest_score", "fit_forest", "score_forest"), ("shap_topk", "fit_forest", "with_contributions"),
    ("ocsvm_score", "fit_ocsvm", "score_ocsvm"),
])
def test_a_model_is_fitted_and_applied_beside_the_fixed_one(spark, monkeypatch, name, fits, flags):
    from acctpulse.models import explain, forest, ocsvm

    fitted, applied = [], []
    for module in (forest, explain, ocsvm):
        for told, found in ((fitted, fits), (applied, flags)):
            if hasattr(module, found):
                was = getattr(module, found)
                monkeypatch.setattr(module, found, lambda df, m, *a, _f=was, _t=told, **k: _t.append(m) or _f(df, m, *a, **k))
    rows = QUERIES[name](spark, SF_DIR)
    rows.collect()
    assert len(fitted) == 1 and len({id(m) for m in applied}) >= 2
    assert {"flag_is_sign"} <= set(rows.columns) or {"n_rows", "flagged_are_explained", "largest_gap"} <= set(rows.columns)


def test_a_forest_is_fitted_though_numbers_repeat_or_are_missing(spark, tmp_path):
    from test_features import make_events, to_df

    from acctpulse.operators.features import feature_table
    from acctpulse.plans import queries
    from pyspark.sql import functions as F

    table = feature_table(to_df(spark, make_events(61, n=80)))
    table.unionByName(table).unionByName(table.withColumn("seq", F.lit(None).cast("long"))).write.parquet(str(tmp_path / "t"))
    model = queries._forest_of(spark.read.parquet(str(tmp_path / "t")))
    assert model.n_trees == 100 and model.nodes.query("node == 0")["rows"].eq(240).all()
