import itertools
import random

import corpus
import numpy as np
import pyarrow as pa
import pytest

from acctpulse.llm import arrays, quality


def test_marginals_are_those_of_all_labellings():
    rng = np.random.default_rng(1)
    field = quality.Field(np.array([1.0]), rng.normal(size=(2, 2)))
    first = np.array([0, 1, 5, 7, 12])
    unary = rng.normal(size=12) * 2
    left, right = field.odds(unary, first)
    got = 1 / (1 + np.exp(-(left + right)))
    for s, e in itertools.pairwise(first):
        total, good = 0.0, np.zeros(e - s)
        for states in itertools.product((0, 1), repeat=e - s):
            score = sum(u for u, y in zip(unary[s:e], states, strict=True) if y)
            score += sum(field.step[a, b] for a, b in itertools.pairwise(states))
            total += np.exp(score)
            good += np.exp(score) * np.array(states)
        assert np.allclose(got[s:e], good / total)


def test_lines_are_those_of_split():
    texts = ["", "a\nb\n", "\n\n", None, "x", "A b!!\n|c|\n\n12", "é\nü"]
    x, size, first = quality.line_features(*arrays.utf8(pa.array(texts, pa.string())))
    for i, t in enumerate(texts):
        lines = (t or "").encode().split(b"\n")
        assert first[i + 1] - first[i] == len(lines)
        assert (size[first[i] : first[i + 1]] - 1).tolist() == [len(line) for line in lines]
    assert x.shape == (first[-1], quality.COLUMNS) and np.isfinite(x).all()


def test_neighbours_are_part_of_a_line():
    x, _, first = quality.line_features(*arrays.utf8(pa.array(["aa bb\nCC!!", "zz"])))
    n = quality.PLAIN
    assert (x[1, n : 2 * n] == x[0, :n]).all() and (x[0, 2 * n : 3 * n] == x[1, :n]).all()
    assert (x[2, n : 3 * n] == 0).all() and first.tolist() == [0, 2, 3]


def trained(rows):
    return quality.train(rows.select("doc_id", "text"), rows.select("doc_id", "label"))


def labelled(spark, n, seed):
    rows = []
    for i, t, *_ in corpus.rows(n, seed):
        bad = i % 3 == 0
        rows.append((i, t.upper().replace(" ", "!! ") if bad else t, 0 if bad else 1, 0.5))
    return spark.createDataFrame(rows, "doc_id long, text string, label int, score double")


def test_unseen_documents(spark):
    field = trained(labelled(spark, 240, 1))
    docs = labelled(spark, 150, 2)
    rows = quality.score(docs, field, ["doc_id", "label"], lines=True).collect()
    right = sum((r["score"] >= 0.5) == (r["label"] == 1) for r in rows)
    assert right >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 and len(r["good"]) for r in rows)


def test_awkward_rows_and_no_labels(spark):
    docs = corpus.frame(spark, corpus.awkward(), clashing=True)
    field = trained(labelled(spark, 60, 3))
    assert all(0 <= r["score"] <= 1 for r in quality.score(docs, field, ["doc_id"]).collect())
    for data in ([], [(1, "a", 1)], [(1, "a", None), (2, "b", 7)]):
        assert trained(spark.createDataFrame(data, "doc_id long, text string, label int")) is None
    assert {r["score"] for r in quality.score(docs, None, ["doc_id"]).collect()} == {0.5}
    assert quality.score(docs.limit(0), field, ["doc_id"]).count() == 0
    nulls = spark.createDataFrame([(2, None, 0), (1, "", 1), (1, "", 1), (None, "x", 1)], "doc_id long, text string, label int")
    assert trained(nulls) is not None


@pytest.mark.parametrize("n", [1, 3000])
def test_long_documents(n):
    text = "\n".join(["some words here."] * n)
    x, size, first = quality.line_features(*arrays.utf8(pa.array([text, "end"])))
    field = quality.Field(np.full(x.shape[1], 0.01), np.array([[1.0, 0], [0, 1.0]]))
    good = field.marginals(x, first)
    assert len(good) == n + 1 and np.isfinite(field.means(good, size, first)).all()


@pytest.mark.parametrize("limit", [1, 40, 10_000])
def test_a_text_in_pieces_is_the_text_whole(limit):
    rng = random.Random(3)
    lines = [rng.choice(["", "Same line of words.", "x | y | z!", "ab", "!!!", f"Number {rng.random()} here"]) for _ in range(300)]
    weights = np.random.default_rng(1).normal(size=quality.COLUMNS)
    for text in ["\n".join(lines), "\n".join(lines) + "\n", "", "\n", "one line"]:
        data = np.frombuffer(text.encode(), np.uint8)
        x, size, first = quality.line_features(data, np.array([0, len(data)]))
        unary, sizes = quality.long_unary(data, weights, limit)
        assert np.allclose(unary, x @ weights) and (sizes == size).all()
        cuts = [(s, min(s + 64, len(x))) for s in range(0, len(x), 64)]
        for (s, e), (own, own_size) in zip(cuts, quality.run_features(data, cuts, limit), strict=True):
            assert (own == x[s:e]).all() and (own_size == size[s:e]).all()


def test_a_long_page_of_short_lines_needs_little_memory():
    import tracemalloc

    data = np.frombuffer(b"ab\n" * 1_500_000, np.uint8)
    tracemalloc.start()
    unary, _ = quality.long_unary(data, np.ones(quality.COLUMNS))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(unary) == 1_500_001 and peak < 700e6
