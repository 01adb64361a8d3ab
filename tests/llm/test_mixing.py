import re

import corpus
import pytest

from acctpulse.llm import mixing
from acctpulse.llm.tables import KEY, keep, with_row_key


def mixed(spark, data):
    docs = with_row_key(corpus.frame(spark, data, clashing=True).repartition(4))
    sizes = docs.select(*KEY, "doc_id", "source", mixing.n_words(docs["text"]).alias("size"))
    return mixing.balance(keep(sizes, "sizes")).collect()


def plain_targets(sizes, most=3):
    names = sorted([s for s in sizes if s is not None], key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        left = total - sum(most * sizes[s] for s in full)
        share = sum(weight[s] for s in sizes if s not in full)
        if not share:
            break
        over = {s for s in sizes if s not in full and weight[s] * left / share >= most * sizes[s]}
        if not over:
            break
        full |= over
    return {s: most * sizes[s] if s in full else weight[s] * left / share for s in sizes}


def check(rows, data):
    assert len(rows) == len(data)
    own = {}
    for i, t, _, s, _ in data:
        own[s] = own.get(s, 0) + len(re.findall(mixing.SPACE, t or ""))
    want = plain_targets(own)
    taken = dict.fromkeys(own, 0)
    largest = dict.fromkeys(own, 0)
    for r in rows:
        assert r["source_size"] == own[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]], abs=1e-6)
        assert 0 <= r["copies"] <= 3
        taken[r["source"]] += r["copies"] * r["size"]
        largest[r["source"]] = max(largest[r["source"]], r["size"])
    for s in own:
        assert abs(taken[s] - want[s]) <= largest[s] / 2 + 1
    return taken


def test_sources_meet_their_targets(spark):
    data = corpus.rows(300, 3)
    check(mixed(spark, data), data)


def test_sizes_are_runs_of_other_than_blanks(spark):
    odd = ["a b", "\ta\x0bb\x0c", "a\xa0b", "", None, " \r\n", "é ü"]
    df = spark.createDataFrame([(t,) for t in odd], "text string")
    got = [r[0] for r in df.select(mixing.n_words(df["text"])).collect()]
    assert got == [len(re.findall(mixing.SPACE, t or "")) for t in odd]


def test_small_sources_stop_at_three_times_their_size(spark):
    data = corpus.rows(200, 4) + [(9000 + i, "one two", "en", f"tiny{i}", 7) for i in range(4)]
    data = [(*r[:3], "big" if r[3].startswith("src") else r[3], r[4]) for r in data]
    taken = check(mixed(spark, data), data)
    assert taken["tiny0"] == taken["tiny1"] == 6


def test_awkward_rows_and_reruns(spark):
    data = corpus.rows(80, 5) + corpus.awkward()
    first = sorted(map(str, mixed(spark, data)))
    check(mixed(spark, data), data)
    again = mixed(spark, data)
    assert sorted((r["doc_id"] or -1, r["copies"]) for r in again) == sorted(
        (r["doc_id"] or -1, r["copies"]) for r in mixed(spark, list(data)))
    assert len(first) == len(data)


def test_empty_table_and_wordless_texts(spark):
    assert mixed(spark, []) == []
    rows = mixed(spark, [(1, None, "en", "a", 0), (2, "", "en", None, 0)])
    assert [(r["size"], r["copies"]) for r in rows] == [(0, 1), (0, 1)]
