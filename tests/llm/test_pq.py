import numpy as np
import pytest

from acctpulse.llm import pq
from acctpulse.llm.tables import with_row_key


def linked(spark, data, **how):
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>, h long, v string")
    rows = pq.linked_vectors(with_row_key(df.repartition(3)), **how).collect()
    return sorted((-1 if r["vec_id"] is None else r["vec_id"], r["n_links"], r["component_id"], r["kept"])
                  for r in rows)


def brute(data, similarity=0.9):
    rows = []
    for i, v, *_ in data:
        x = np.array([np.nan if c is None else c for c in (v or [])], float).astype(np.float32).astype(float)
        good = np.isfinite(x).all() and (x != 0).any()
        rows.append((i, x / np.linalg.norm(x) if good else None))
    links = [{j for j, (_, y) in enumerate(rows) if j != k and x is not None and y is not None
              and len(x) == len(y) and x @ y >= similarity - 1e-12} for k, (_, x) in enumerate(rows)]
    out = []
    for k in range(len(rows)):
        seen, todo = {k}, [k]
        while todo:
            for j in links[todo.pop()] - seen:
                seen.add(j)
                todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        root = min(ids) if ids else None
        out.append((-1 if rows[k][0] is None else rows[k][0], len(links[k]), root, root == rows[k][0]))
    return sorted(out)


def vectors(n, seed, dims=16):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(n // 4, dims))
    out = []
    for i in range(n):
        v = base[rng.integers(len(base))] + rng.normal(size=dims) * rng.choice([0.05, 0.3, 1.5])
        out.append((i, [float(x) for x in v.astype(np.float32)], 1, "x"))
    return out


@pytest.mark.parametrize("block", [7, 1024])
def test_links_are_those_of_all_pairs(spark, block):
    data = vectors(240, 1)
    assert linked(spark, data, block=block, probes=0) == brute(data)


def test_copies_and_awkward_rows(spark):
    data = vectors(40, 2)
    data += [(100 + i, data[0][1], 1, None) for i in range(30)] + [(200, [2 * x for x in data[0][1]], 1, None)]
    data += [(300, None, 1, None), (301, [0.0] * 16, 1, None), (302, [float("nan")] + [1.0] * 15, 1, None),
             (303, [float("inf")] + [1.0] * 15, 1, None), (304, [None] + [1.0] * 15, 1, None),
             (305, [1.0] * 15, 1, None), (305, [], 1, None), (5, data[0][1], 1, None), (5, data[0][1], 1, None),
             (400, [-0.0] + [1.0] * 15, 1, None), (401, [0.0] + [1.0] * 15, 1, None)]
    assert linked(spark, data, probes=0) == brute(data)


def test_only_unusable_or_no_rows(spark):
    assert linked(spark, []) == []
    assert linked(spark, [(1, None, 1, None), (2, [0.0, 0.0], 1, None)]) == [(1, 0, 1, True), (2, 0, 2, True)]
    assert linked(spark, [(1, [1.0, 0.0], 1, None)]) == [(1, 0, 1, True)]


def test_codes_never_hide_a_near_vector():
    rng = np.random.default_rng(3)
    x = pq._unit(rng.normal(size=(400, 20)))
    book = pq.fit_codebook(x, 400, subspaces=5, codes=16)
    at = book.nearest(x)
    residual = x - book.centres(at)
    code, error = book.encode(residual)
    for c in np.unique(at):
        own = np.flatnonzero(at == c)
        tables = book.tables(x - book.centre(c))
        coded = sum(tables[:, j][:, code[own, j]] for j in range(code.shape[1]))
        true = np.linalg.norm(x[:, None] - x[own][None], axis=2)
        assert (np.sqrt(np.maximum(coded, 0)) - error[own] <= true + 1e-6).all()


def test_vectors_of_several_lengths(spark):
    """Each is compared with those of its own length, the rare lengths too."""
    data = vectors(120, 7) + [(1000 + i, v, 1, "x") for i, v, *_ in vectors(60, 8, dims=9)]
    data += [(2000, [1.0, 2.0, 3.0], 1, "x"), (2001, [1.0, 2.0, 3.0], 1, "x"), (2002, [1.0, 2.0, 3.1], 1, "x"),
             (2003, [5.0], 1, "x"), (2004, [7.0], 1, "x"), (2005, [-7.0], 1, "x")]
    got = linked(spark, data, probes=0)
    assert got == brute(data)
    assert [r[1] for r in got if r[0] >= 2000] == [2, 2, 2, 1, 1, 0]


def test_lists_of_two_levels(spark, monkeypatch):
    monkeypatch.setattr(pq, "LIST_ROWS", 2)
    monkeypatch.setattr(pq, "MAX_LISTS", 20)
    data = vectors(400, 9)
    book = pq.fit_codebook(pq._unit(np.array([v for _, v, *_ in data])), 400)
    assert len(book.centroids) == 20 and len(book.second) == 10 and book.probes == 12
    assert linked(spark, data, probes=0) == brute(data)
    got, want = linked(spark, data), brute(data)
    assert sum(r[1] for r in got) >= 0.95 * sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))


def planted(rng, x, cosine):
    """A vector at this cosine from each of ``x``."""
    x = x / np.linalg.norm(x, axis=1, keepdims=True)
    side = rng.normal(size=x.shape)
    side -= (side * x).sum(1, keepdims=True) * x
    side /= np.linalg.norm(side, axis=1, keepdims=True)
    return cosine * x + np.sqrt(1 - cosine**2) * side


@pytest.mark.parametrize("clusters", [0, 30])
def test_recall_of_the_usual_probes(spark, clusters):
    """Pairs just above the limit, among vectors without any structure and in clusters."""
    rng = np.random.default_rng(10)
    x = rng.normal(size=(3000, 64))
    if clusters:
        x = 0.7 * x + rng.normal(size=(clusters, 64))[rng.integers(0, clusters, 3000)]
    near = planted(rng, x[:500], 0.905)
    data = [(i, v.tolist(), 1, "x") for i, v in enumerate(np.concatenate([x, near]))]
    found, all_links = (sum(r[1] for r in rows) for rows in (linked(spark, data), brute(data)))
    assert all_links >= 1000 and 0.95 * all_links <= found <= all_links


def test_either_side_finds_a_pair(spark):
    """Few probes: what one side misses the other finds, and both count it once."""
    data = vectors(400, 5)
    got = {r[0]: r[1] for r in linked(spark, data, probes=2)}
    want = {r[0]: r[1] for r in brute(data)}
    assert all(got[i] <= want[i] for i in want)
    assert sum(got.values()) % 2 == 0 and sum(got.values()) >= 0.9 * sum(want.values())
