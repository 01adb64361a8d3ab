import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acctpulse.models import knn, lof, ocsvm, select

FEATURES = ["a", "b", "c"]


def points(seed, n=500, copies=60):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3)) * [5, 1, 1]
    x[:copies] = x[0]  # a group of equal rows
    x[copies : copies + 5] += 40
    return x


def to_df(spark, x, start=0):
    rows = [(start + i, *map(float, r)) for i, r in enumerate(x)]
    return spark.createDataFrame(rows, "seq long, a double, b double, c double")


def brute_lof(train, queries, k):
    """Scores from the definition, every copy a row of its own."""

    def knn_rows(q, skip=None):
        d = np.sqrt(((train - q) ** 2).sum(axis=1))
        if skip is not None:
            d[skip] = np.inf
        order = np.argsort(d, kind="stable")[:k]
        return order, d[order]

    near = [knn_rows(t, i) for i, t in enumerate(train)]
    kdist = np.array([d[-1] for _, d in near])
    lrd = np.array([1 / (np.maximum(d, kdist[o]).mean() + 1e-10) for o, d in near])
    nof = np.array([-lrd[o].mean() / lrd[i] for i, (o, _) in enumerate(near)])
    raw = []
    for q in queries:
        o, d = knn_rows(q)
        raw.append(-lrd[o].mean() * (np.maximum(d, kdist[o]).mean() + 1e-10))
    return nof, np.array(raw)


@pytest.mark.parametrize("cell_rows,slice_rows", [(1024, 4096), (60, 4096), (10, 7)])
def test_lof_matches_brute_force(spark, monkeypatch, cell_rows, slice_rows):
    monkeypatch.setattr(knn, "CELL_ROWS", cell_rows)
    monkeypatch.setattr(knn, "SLICE_ROWS", slice_rows)
    rng = np.random.default_rng(5)
    train = points(1)
    share = 0.5  # beside a group of copies the factor is huge; take a usual one
    queries = rng.normal(size=(80, 3)) * [6, 2, 1]
    model = lof.fit_lof(to_df(spark, train), FEATURES, n_neighbors=10, contamination=share)
    nof, raw = brute_lof(train, queries, 10)
    assert model.offset == pytest.approx(np.percentile(nof, 100 * share), rel=1e-9)
    rows = lof.score_lof(to_df(spark, queries), model).orderBy("seq").collect()
    got = [r["anomaly_score"] for r in rows]
    assert got == pytest.approx((raw - model.offset).tolist(), rel=1e-9)
    assert all((r["anomaly_score"] < 0) == r["is_anomaly"] for r in rows)


def vectors_df(spark, x, name):
    return spark.createDataFrame([(i, 1, r.tolist()) for i, r in enumerate(x)], f"{name} long, copies long, v array<double>")


def clustered(rng, n, groups=40, width=64):
    return rng.normal(size=(groups, width))[rng.integers(0, groups, n)] * 4 + rng.normal(size=(n, width)) * 0.3


@pytest.mark.parametrize("make", [clustered, lambda rng, n: rng.normal(size=(n, 64)), lambda rng, n: rng.normal(size=(n, 2))])
def test_neighbours_are_exact_and_few_cells_are_visited(spark, monkeypatch, make):
    monkeypatch.setattr(knn, "CELL_ROWS", 50)
    rng = np.random.default_rng(8)
    both = make(rng, 2200)
    x, asked = both[:2000], both[2000:]
    refs, index = knn.build_index(vectors_df(spark, x, "rid").repartition(3), len(x))
    assert index.rows.sum() == len(x) and len(index.centers) > 30
    visits = []
    queries = vectors_df(spark, asked, "qid").select("qid", "v")
    got = knn.neighbours(queries, refs, index, 7, visits=visits).collect()
    dist = np.sqrt(((asked[:, None] - x[None]) ** 2).sum(axis=2))
    order = np.argsort(dist, axis=1, kind="stable")[:, :7]
    want = {(q, int(r)) for q in range(len(asked)) for r in order[q]}
    assert {(r.qid, r.rid) for r in got} == want
    assert all(r.dist == pytest.approx(dist[r.qid, r.rid], rel=1e-12) for r in got)
    share = sum(visits) / (len(asked) * len(index.centers))
    if make is clustered or x.shape[1] == 2:
        assert share < 0.25
    # Each bound is no more than the least distance to a row of the cell.
    cells = {r.rid: r.cell for r in refs.select("rid", "cell").collect()}
    own = np.array([cells[i] for i in range(len(x))])
    bound = index.bounds(asked)
    for c in np.unique(own):
        assert (bound[:, c] <= dist[:, own == c].min(axis=1) + 1e-12).all()


def test_equal_rows_and_tables_smaller_than_k(spark):
    x = np.zeros((40, 3))
    model = lof.fit_lof(to_df(spark, x), FEATURES, n_neighbors=10, contamination=0.1)
    assert model.rows == 1 and lof.score_lof(to_df(spark, x + 1), model).count() == 40
    few = lof.fit_lof(to_df(spark, points(2, n=4, copies=0)[:4]), FEATURES, n_neighbors=10)
    assert few.k == 3


def test_ocsvm_share_and_outliers(spark):
    x = np.random.default_rng(2).normal(size=(2000, 3))
    x[:10] *= 9 / np.linalg.norm(x[:10], axis=1)[:, None]  # far off, each on its own side
    df = to_df(spark, x)
    model = ocsvm.fit_ocsvm(df, FEATURES, nu=0.02, steps=8)
    scored = ocsvm.score_ocsvm(df, model).toPandas()
    assert scored["is_anomaly"].mean() == pytest.approx(0.02, abs=0.002)
    assert scored.loc[scored["seq"] < 10, "is_anomaly"].all()


@pytest.mark.parametrize(
    "kind,params",
    [
        ("LocalOutlierFactor", {"n_neighbors": 5, "scale": True}),
        ("OneClassSVM", {"steps": 2, "n_components": 32, "scale": True}),
    ],
)
def test_select_save_load(spark, tmp_path, kind, params):
    df = to_df(spark, points(3, n=120, copies=3))
    model = select.fit(df, FEATURES, kind, params)
    select.save(spark, model, str(tmp_path / kind))
    loaded = select.load(spark, str(tmp_path / kind))
    a = select.score(df, model).agg(F.sum("anomaly_score")).first()[0]
    b = select.score(df, loaded).agg(F.sum("anomaly_score")).first()[0]
    assert a == pytest.approx(b) and not select.explains(loaded)


def test_unknown_model_is_refused(spark):
    with pytest.raises(ValueError, match="no model named"):
        select.check("Nope")


def exact_dual(z, nu, rounds=200_000):
    """Least squared length of a mean in which no row weighs more than 1 / (nu n): weight moves pair by pair."""
    n = len(z)
    cap = 1 / (nu * n)
    share = np.zeros(n)
    whole = int(nu * n)
    share[:whole] = cap
    if whole < n:
        share[whole] = 1 - whole * cap
    gram = z @ z.T
    slope = gram @ share
    for _ in range(rounds):
        to = int(np.where(share < cap - 1e-15, slope, np.inf).argmin())
        away = int(np.where(share > 1e-15, slope, -np.inf).argmax())
        if slope[away] - slope[to] < 1e-10:
            break
        curve = max(gram[to, to] - 2 * gram[to, away] + gram[away, away], 1e-300)
        step = min(share[away], cap - share[to], (slope[away] - slope[to]) / curve)
        share[to] += step
        share[away] -= step
        slope += step * (gram[to] - gram[away])
    return float(share @ gram @ share)


@pytest.mark.parametrize("nu", [0.02, 0.15])
def test_ocsvm_is_within_its_gap_of_the_exact_dual(spark, nu):
    x = np.random.default_rng(6).normal(size=(500, 3)) * [2, 1, 1]
    model = ocsvm.fit_ocsvm(to_df(spark, x).repartition(3), FEATURES, nu=nu, n_components=64, steps=25, tolerance=1e-3)
    w, b = ocsvm.fourier_map(3, 64, model.gamma, model.seed)
    best = exact_dual(ocsvm.mapped(x, w, b), nu)
    length = sum(v * v for v in model.weights)
    assert best - 1e-9 <= length <= best + model.gap + 1e-9
    assert model.gap <= 0.1 * length


def test_visits_are_planned_in_bounded_tables():
    """Each of many queries reaches all cells; no table of (query, cell) pairs grows with the cells."""
    import types

    rng = np.random.default_rng(5)
    centers = rng.normal(size=(600, 4))
    zero = np.zeros((600, 1))
    index = knn.PivotIndex(centers, np.array([0]), zero, zero + 1e9, np.full(600, 1e9), np.ones(600, np.int64))
    queries = pd.DataFrame({"qid": range(50), "v": list(rng.normal(size=(50, 4))), "radius": np.inf})
    caught = {}
    table = types.SimpleNamespace(
        sparkSession=types.SimpleNamespace(
            sparkContext=types.SimpleNamespace(broadcast=lambda v: types.SimpleNamespace(value=v))
        ),
    )
    table.select = lambda *names: table
    table.mapInPandas = lambda f, schema: caught.setdefault("plan", f)
    knn._asks(table, index, 0, 600)
    told = list(caught["plan"](iter([queries])))
    assert max(map(len, told)) <= knn.ASKS_AT_ONCE
    pairs = pd.concat(told)
    assert len(pairs) == 50 * 600 and not pairs.duplicated(["qid", "cell"]).any()


def test_a_fit_maps_rows_quickly_and_nearly_as_scores_do(monkeypatch):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(700, 5)) * 1e5
    w, b = ocsvm.fourier_map(5, 64, 0.3, 1)
    assert np.abs(ocsvm.nearly_mapped(x, w, b) - ocsvm.mapped(x, w, b)).max() < 4e-7 * np.sqrt(2 / 64)
    kinds = []
    cos = np.cos
    monkeypatch.setattr(np, "cos", lambda a: kinds.append((a.dtype, len(a))) or cos(a))
    ocsvm.nearly_mapped(x, w, b)
    assert {k for k, _ in kinds} == {np.dtype(np.float32)} and max(n for _, n in kinds) <= 256


def a_block(x, centers, k, self_free=True, own_only=False):
    """An index of rows ``x`` with the given centres, and a block of all of them as queries."""
    own = knn.squared(x, centers)[0].argmin(axis=1)
    apart = np.sqrt(((x[:, None] - centers[None]) ** 2).sum(axis=2))
    inside = own[:, None] == np.arange(len(centers))
    low, high = np.where(inside, apart, np.inf).min(axis=0), np.where(inside, apart, -np.inf).max(axis=0)
    index = knn.PivotIndex(centers, np.zeros(0, np.int64), np.zeros((len(centers), 0)), np.zeros((len(centers), 0)), high, inside.sum(axis=0))
    block = knn.Block(index, k, self_free, own_only)
    return index, block, own


@pytest.mark.parametrize(
    "make",
    [
        lambda rng: rng.normal(size=(900, 8)),
        lambda rng: rng.normal(size=(900, 8)).astype(np.float32).astype(float),
        lambda rng: rng.integers(0, 3, (900, 4)).astype(float),  # many equal distances
        lambda rng: 1e6 + rng.normal(size=(900, 8)) * np.where(rng.random((900, 1)) < 0.5, 1e-4, 1.0),
        lambda rng: rng.normal(size=(900, 8)) * 1e25,
        lambda rng: rng.normal(size=(900, 8)) * 1e-25,
    ],
)
def test_a_block_finds_the_nearest_of_what_passes_by(make):
    rng = np.random.default_rng(11)
    x = make(rng)
    copies = rng.integers(1, 4, len(x))
    centers = x[:7].copy()
    index, block, own = a_block(x, centers, 9)
    block.ask(np.arange(len(x)), own, x, np.full(len(x), np.inf))
    block.own = np.full(len(x), -1)
    for c in range(7):
        at = np.flatnonzero(own == c)
        for part in np.array_split(at, 3):
            if block.qid is None:
                block.begin()
                block.own = np.full(len(x), -1)  # no cell was visited before
            block.meet(c, part, copies[part], x[part])
    (run, lists), = list(block.end())
    dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    for q in range(len(x)):
        times = copies - (np.arange(len(x)) == q)
        order = np.lexsort((np.arange(len(x)), dist[q]))
        order = order[times[order] > 0]
        before = np.cumsum(times[order]) - times[order]
        want = order[before < 9][:9]
        assert lists["rids"][q].as_py() == want.tolist()
        assert lists["dists"][q].as_py() == dist[q, want].tolist()
        assert lists["times"][q].as_py() == times[want].tolist()


def test_packed_vectors_are_the_same():
    import pyarrow as pa

    rng = np.random.default_rng(2)
    small = rng.normal(size=(5, 3)).astype(np.float32).astype(float)
    for v in (small, rng.normal(size=(5, 3)), np.concatenate([small, rng.normal(size=(4, 3)), small * 1e300])):
        p = knn.packed(v)
        assert (knn.unpacked(p, 3) == v).all() and (knn.unpacked(p.slice(2, 3), 3) == v[2:5]).all()
    sizes = [len(b) for b in pa.array(knn.packed(small)).to_pylist()]
    assert sizes == [12] * 5


def test_cells_are_dealt_in_parts_of_bounded_size():
    rows = np.array([5, 30, 4, 0, 6, 12])
    first, parts = knn.dealt(rows, np.array([0, 2, 3, 1, 4, 5]), 10)
    assert parts.tolist() == [1, 3, 1, 1, 1, 2]
    held = {}
    for c in range(len(rows)):
        for p in range(first[c], first[c] + parts[c]):
            held[p] = held.get(p, 0) + rows[c] / parts[c]
    assert max(held.values()) <= 10
    assert first[0] == first[2] == first[3] and first[1] != first[0] and first[5] != first[4]


def test_a_cell_is_sent_once_to_a_block_of_queries(spark, monkeypatch):
    """Without structure each query reaches each cell; what is sent does not grow with queries times cells."""
    monkeypatch.setattr(knn, "CELL_ROWS", 20)
    monkeypatch.setattr(knn, "BLOCK_LEAST", 500)
    sent = []
    compared = knn._compared
    monkeypatch.setattr(knn, "_compared", lambda s, *rest: sent.append(s.count()) or compared(s, *rest))
    x = np.random.default_rng(8).normal(size=(2000, 64))
    refs, index = knn.build_index(vectors_df(spark, x, "rid").repartition(3), len(x))
    visits = []
    queries = refs.select(F.col("rid").alias("qid"), "v")
    got = knn.neighbours(queries, refs, index, 5, self_free=True, visits=visits).groupBy("qid").count().collect()
    assert len(got) == 2000 and {r["count"] for r in got} == {5}
    assert sum(visits) > 100_000  # pairs of a query and a cell
    assert sum(sent) < 30_000


def test_scores_of_training_rows_need_no_second_search(spark, monkeypatch):
    train = points(4, n=400, copies=30)
    rng = np.random.default_rng(9)
    asked = np.concatenate([train[rng.permutation(400)], rng.normal(size=(50, 3)) * [6, 2, 1], train[:3]])
    model = lof.fit_lof(to_df(spark, train), FEATURES, n_neighbors=10, contamination=0.5)
    searched = []
    placed = knn._own_cells
    monkeypatch.setattr(knn, "_own_cells", lambda q, index: searched.append(q.count()) or placed(q, index))
    got = [r["anomaly_score"] for r in lof.score_lof(to_df(spark, asked), model).orderBy("seq").collect()]
    assert searched == [50]
    raw = brute_lof(train, asked, 10)[1]
    assert got == pytest.approx((raw - model.offset).tolist(), rel=1e-9)
    model.near = None  # as in a loaded model
    again = [r["anomaly_score"] for r in lof.score_lof(to_df(spark, asked), model).orderBy("seq").collect()]
    assert again == pytest.approx(got, rel=1e-12) and searched == [50, 453]


def test_training_rows_that_share_an_id_are_searched_for(spark):
    train = points(4, n=60, copies=0)
    df = to_df(spark, train).withColumn("seq", F.col("seq") % 59)
    assert lof.fit_lof(df, FEATURES, n_neighbors=5).near is None
