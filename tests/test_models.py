import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from acctpulse.models import explain, forest
from acctpulse.operators import quantile
from acctpulse.operators.quantile import exact_quantile

FEATURES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def points(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4)) * [1, 2, 3, 1]
    x[:30] += 12
    rows = [(i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "seq long, a double, b double, c double, d double")


@pytest.fixture(scope="module")
def model(points):
    return forest.fit_forest(points, FEATURES, n_estimators=40)


def test_forest_flags_outliers(points, model):
    scored = forest.score_forest(points, model).toPandas()
    assert scored["is_anomaly"].mean() == pytest.approx(0.01, abs=0.0005)
    assert (scored.loc[scored["seq"] < 30, "is_anomaly"]).mean() > 0.8
    assert ((scored["anomaly_score"] < 0) == (scored["anomaly_label"] == -1)).all()


def test_forest_independent_of_partitioning(points, model):
    again = forest.fit_forest(points.repartition(7, "c"), FEATURES, n_estimators=40)
    assert again.nodes.equals(model.nodes)
    assert again.offset == model.offset


def test_forest_samples_have_full_size(points):
    counts = forest.sample_per_tree(points, 3000, 5, 64, 1).groupBy("tree").agg(
        F.count("*").alias("n"), F.count_distinct("seq").alias("d")
    )
    assert {tuple(r) for r in counts.collect()} == {(t, 64, 64) for t in range(5)}


def walk(model, x):
    """Path length by following the node table."""
    total = 0.0
    for _, nodes in model.nodes.groupby("tree"):
        table = {r.node: r for r in nodes.itertuples()}
        r = table[0]
        while r.feature >= 0:
            r = table[2 * r.node + (1 if x[r.feature] <= r.threshold else 2)]
        total += r.depth + float(forest.average_path(r.rows))
    return total / model.n_trees


def test_packed_scoring_matches_walk(points, model):
    x = points.limit(50).toPandas()[FEATURES].to_numpy()
    got = forest.mean_path(x, model.packed())
    assert got == pytest.approx([walk(model, r) for r in x])


def expectation(model, x, known):
    """Value of a coalition: unknown features split by training rows."""
    total = 0.0
    for _, nodes in model.nodes.groupby("tree"):
        table = {r.node: r for r in nodes.itertuples()}

        def visit(node):
            r = table[node]
            if r.feature < 0:
                return r.depth + float(forest.average_path(r.rows))
            left, right = 2 * node + 1, 2 * node + 2
            if r.feature in known:
                return visit(left if x[r.feature] <= r.threshold else right)
            return (
                table[left].rows * visit(left) + table[right].rows * visit(right)
            ) / r.rows

        total += visit(0)
    return total / model.n_trees


def test_contributions_are_shapley_values(points, model):
    small = forest.ForestModel(
        FEATURES, model.nodes[model.nodes["tree"] < 6], 6, model.max_samples
    )
    groups = explain.leaf_boxes(small)
    x = points.limit(3).toPandas()[FEATURES].to_numpy()
    got = explain.contributions(x, groups, 4)
    for row, phi in zip(x, got):
        for j in range(4):
            want = 0.0
            others = [k for k in range(4) if k != j]
            for size in range(4):
                weight = math.factorial(size) * math.factorial(3 - size) / math.factorial(4)
                for s in itertools.combinations(others, size):
                    want += weight * (
                        expectation(small, row, {*s, j}) - expectation(small, row, set(s))
                    )
            assert phi[j] == pytest.approx(want, abs=1e-9)
        assert phi.sum() + explain.base_value(groups) == pytest.approx(walk(small, row))


def test_contributions_do_not_depend_on_other_rows(points, model):
    groups = explain.leaf_boxes(model)
    x = points.limit(2 * explain.ROWS_AT_ONCE + 3).toPandas()[FEATURES].to_numpy()
    together = explain.contributions(x, groups, 4)
    assert len(x) > 2 * explain.ROWS_AT_ONCE
    assert (together == [explain.contributions(r[None, :], groups, 4)[0] for r in x]).all()
    gap = together.sum(axis=1) + explain.base_value(groups) - forest.mean_path(x, model.packed())
    assert abs(gap).max() < 1e-9


def test_explain_flagged(points, model):
    rows = explain.score_and_explain(points, model, 3).collect()
    scores = {r["seq"]: r["anomaly_score"] for r in forest.score_forest(points, model).collect()}
    assert {r["seq"]: r["anomaly_score"] for r in rows} == scores
    for r in rows:
        assert (r["top_features"] is not None) == r["is_anomaly"]
        if r["is_anomaly"]:
            sizes = [abs(c["value"]) for c in r["top_features"]]
            assert len(sizes) == 3 and sizes == sorted(sizes, reverse=True)


def test_save_and_load(spark, points, model, tmp_path):
    forest.save_forest(spark, model, str(tmp_path / "m"))
    loaded = forest.load_forest(spark, str(tmp_path / "m"))
    assert loaded.nodes.equals(model.nodes) and loaded.offset == model.offset
    a = forest.score_forest(points, model).agg(F.sum("anomaly_score")).first()[0]
    assert forest.score_forest(points, loaded).agg(F.sum("anomaly_score")).first()[0] == a


@pytest.mark.parametrize("q", [0.0, 0.01, 0.37, 0.5, 1.0])
def test_exact_quantile(spark, monkeypatch, q):
    monkeypatch.setattr(quantile, "GATHER_ROWS", 10)
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=500), np.full(400, 0.25), [1e9, -1e9]])
    w = rng.integers(0, 4, size=len(x))
    w[7] = 5_000
    df = spark.createDataFrame([(float(v), int(n)) for v, n in zip(x, w)], "v double, n long")
    df = df.unionByName(spark.createDataFrame([(None, 3), (float("nan"), 3), (1.0, None)], "v double, n long"))
    assert exact_quantile(df.where("n is not null"), "v", q) == pytest.approx(np.quantile(x, q), rel=1e-12)
    assert exact_quantile(df, "v", q, "n") == pytest.approx(np.quantile(np.repeat(x, w), q), rel=1e-12)


def test_exact_quantile_in_two_reads(spark, monkeypatch):
    """One pass for the sketch, one that counts; a sketch that errs costs another and no exactness."""
    x = np.random.default_rng(4).permutation(60_000).astype(float)
    monkeypatch.setattr(quantile, "GATHER_ROWS", 1_000)
    df = spark.createDataFrame([(float(v),) for v in x], "v double")
    seen = []
    read = quantile.cut_lineage
    monkeypatch.setattr(quantile, "cut_lineage", lambda d: seen.append(1) or read(d))
    assert exact_quantile(df, "v", 0.25) == 0.25 * 59_999
    assert len(seen) == 1
    borders = quantile._borders
    wrong = iter([(70_000.0, 80_000.0), (-3.0, -2.0)])
    monkeypatch.setattr(quantile, "_borders", lambda *a: next(wrong, None) or borders(*a))
    assert exact_quantile(df, "v", 0.25) == 0.25 * 59_999
    assert exact_quantile(df.where("v < 0"), "v", 0.5) is None


def invariants(nodes, size, depth):
    """Rows at the root, in leaves and below each split; why leaves are leaves."""
    for _, tree in nodes.groupby("tree"):
        at = {r.node: r for r in tree.itertuples()}
        assert at[0].rows == size and at[0].depth == 0
        assert sum(r.rows for r in at.values() if r.feature < 0) == size
        for node, r in at.items():
            assert r.depth <= depth
            if r.feature >= 0:
                low, high = at[2 * node + 1], at[2 * node + 2]
                assert low.rows + high.rows == r.rows and min(low.rows, high.rows) > 0
                assert low.depth == high.depth == r.depth + 1
            else:
                assert 2 * node + 1 not in at and (r.rows == 1 or r.depth == depth)


@pytest.mark.parametrize("finish", [50, 2000])
def test_large_samples_grow_level_by_level(spark, points, monkeypatch, finish):
    monkeypatch.setattr(forest, "GROUPED_SAMPLES", 100)
    monkeypatch.setattr(forest.levels, "FINISH_ROWS", finish)
    model = forest.fit_forest(points, FEATURES, n_estimators=6, max_samples=0.5)
    rows = points.count()
    assert model.max_samples == rows // 2
    invariants(model.nodes, rows // 2, int(np.ceil(np.log2(rows // 2))))
    again = forest.fit_forest(points.repartition(5, "c"), FEATURES, n_estimators=6, max_samples=rows // 2)
    assert again.nodes.equals(model.nodes)
    grouped = forest.fit_forest(points, FEATURES, n_estimators=40, max_samples=100)
    invariants(grouped.nodes, 100, 7)
    # The rows far off stand out in both.
    worst = [
        {r.seq for r in forest.score_forest(points, m).orderBy("anomaly_score").limit(10).collect()}
        for m in (model, grouped)
    ]
    assert all(len(w & set(range(30))) >= 9 for w in worst)


def test_each_tree_has_exactly_its_number_of_rows(spark, points):
    rows = points.select(F.xxhash64("seq").alias(forest.levels.HASH))
    h = np.array([r[0] for r in rows.collect()])
    for size in (1, 777, len(h)):
        limits = forest.levels.hash_limits(rows, 4, size)
        assert [(forest.levels.picks(h, t) <= limits[t]).sum() for t in range(4)] == [size] * 4


@pytest.mark.parametrize("wrong", [0.0, 1.5, 0, -3])
def test_sample_sizes(wrong):
    with pytest.raises(ValueError):
        forest.sample_size(wrong, 100)
    assert [forest.sample_size(m, 1000) for m in ("auto", 0.5, 1.0, 5000, 7)] == [256, 500, 1000, 1000, 7]
