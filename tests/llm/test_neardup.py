import collections
import random
import re

import corpus
import numpy as np
import pyarrow as pa
import pytest

from acctpulse.llm import arrays, neardup
from acctpulse.llm.decontaminate import LOWER, UPPER, WORD
from acctpulse.llm.tables import with_row_key


def shingles(text):
    w = re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))
    runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [tuple(w)] * bool(w)
    return collections.Counter(runs)


def brute(data, similarity=0.8):
    sets = [shingles(r[1]) for r in data]
    once = {r[1] for r in data if r[1] is not None}
    df = collections.Counter(s for text in once for s in shingles(text))
    weigh = [{s: (1 + np.log(n)) * np.log1p(1 / max(df[s] / len(once), neardup.RARE)) for s, n in c.items()}
             for c in sets]
    parent = list(range(len(data)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(data)):
        for j in range(i):
            same = data[i][1] is not None and data[i][1] == data[j][1]
            common = sum(min(w, weigh[j][s]) for s, w in weigh[i].items() if s in weigh[j])
            either = sum(weigh[i].values()) + sum(weigh[j].values()) - common
            if same or (either > 0 and common >= (similarity - 1e-9) * either):
                parent[top(i)] = top(j)
    groups = collections.defaultdict(list)
    for i in range(len(data)):
        groups[top(i)].append(data[i][0])
    low = lambda ids: min((x for x in ids if x is not None), default=None)
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1]))
    return sorted(((data[i][0], low(groups[top(i)]), len(groups[top(i)])) for i in range(len(data))), key=key)


def edited(data, rng):
    out = []
    for _ in range(60):
        i, t, lang, source, n = rng.choice(data)
        words = t.split(" ")
        for _ in range(rng.choice([0, 1, 1, 2, 6])):
            words[rng.randrange(len(words))] = rng.choice(["new", "other"])
        out.append((10_000 + len(out), " ".join(words), lang, source, n))
    return out


def classes(spark, data, **how):
    docs = with_row_key(corpus.frame(spark, data, clashing=True).repartition(4))
    rows = neardup.near_duplicates(docs, [], **how).collect()
    kept = collections.Counter(str(r["class_id"]) for r in rows if r["kept"])
    key = lambda x: (x[0] is None, x[0] or 0, str(x[1]))
    return sorted(((r["doc_id"], r["class_id"], r["class_rows"]) for r in rows), key=key), kept


@pytest.mark.parametrize("how", [{}, {"block_rows": 3}, {"block_bytes": 2000}])
def test_classes_are_those_of_all_pairs(spark, how):
    data = corpus.rows(60, 11)
    data += edited(data, random.Random(5))
    got, kept = classes(spark, data, **how)
    assert got == brute(data)
    assert set(kept.values()) == {1}


def test_a_large_group_and_a_passage_that_many_share(spark):
    rng = random.Random(6)
    base = corpus.text(rng, "en", 90).split(" ")
    data = corpus.rows(40, 12)
    passage = corpus.text(rng, "fr", 25)
    data += [(3000 + i, passage + "\n" + corpus.text(rng, "de", 60), "de", "s", 0) for i in range(20)]
    for i in range(60):
        words = list(base)
        words[rng.randrange(len(words))] = f"w{i}"
        data.append((4000 + i, " ".join(words), "en", "s", 0))
    data += [(5000 + i, " ".join(base), "en", "s", 0) for i in range(40)]
    for how in ({}, {"block_rows": 5}):
        assert classes(spark, data, **how)[0] == brute(data)


def test_awkward_rows_and_empty_tables(spark):
    data = corpus.awkward()
    got, _ = classes(spark, data)
    assert got == brute(data)
    assert classes(spark, [])[0] == []
    assert classes(spark, [(1, None, None, None, None), (2, "", None, None, 0)])[0] == [(1, 1, 1), (2, 2, 1)]


def test_samples_agree_as_often_as_weights_overlap():
    rng = np.random.default_rng(1)
    h = arrays.mix(np.arange(300, dtype=np.uint64))
    a, b = rng.gamma(2, 1, 300), rng.gamma(2, 1, 300)
    b[:150] = a[:150]
    want = np.minimum(a, b).sum() / np.maximum(a, b).sum()
    sampler = neardup.Sampler(4000)
    one, two = (sampler.sign(h, w, np.array([0]))[0] for w in (a, b))
    assert abs((one == two).mean() - want) < 0.03


def test_document_counts_are_exact(spark):
    data = corpus.rows(400, 13) + [(9000 + i, "a common line of words " + str(i), "en", "s", 0) for i in range(50)]
    idf = neardup.fit_idf(corpus.frame(spark, data).repartition(7))
    df = collections.Counter(s for r in data for s in shingles(r[1]))
    want = sorted(n for n in df.values() if n >= neardup.RARE * len(data))
    assert idf.docs == len(data) and sorted(idf.df.astype(int).tolist()) == want
    words = arrays.Words(*arrays.utf8(pa.array(["a common line of words"])))
    assert idf.of(words.shingles(5)[0])[0] == pytest.approx(np.log1p(len(data) / 50))


def test_edits_of_a_text_that_fills_a_third_of_the_rows(spark):
    """Its near copies are those by plain five-word Jaccard: copies don't lower its weight."""
    rng = random.Random(8)
    base = corpus.text(rng, "en", 80).split()
    data = [(i, corpus.text(rng, "de", 60), "de", "s", 0) for i in range(170)]
    alike = lambda a, b: len(a & b) / len(a | b)
    own, edits = set(shingles(" ".join(base))), []
    for i in range(300):
        words = list(base)
        for _ in range(rng.choice([1, 2])):
            words[rng.randrange(len(words))] = f"w{i}"
        if 0.8 <= alike(own, set(shingles(" ".join(words)))) <= 0.9 and len(edits) < 6:
            edits.append((2000 + i, " ".join(words), "en", "s", 0))
    assert len(edits) == 6
    data += [(1000 + i, " ".join(base), "en", "s", 0) for i in range(90)] + edits
    got, kept = classes(spark, data)
    want = [(i, i, 1) for i in range(170)]
    want += [(r[0], 1000, 96) for r in data[170:]]
    assert got == sorted(want) and kept["1000"] == 1


def test_copies_leave_classes_as_they_are_without_them(spark):
    rng = random.Random(6)
    base = corpus.text(rng, "en", 90).split(" ")
    once = corpus.rows(40, 12)
    for i in range(60):
        words = list(base)
        words[rng.randrange(len(words))] = f"w{i}"
        once.append((4000 + i, " ".join(words), "en", "s", 0))
    once.append((5000, " ".join(base), "en", "s", 0))
    data = once + [(5001 + i, " ".join(base), "en", "s", 0) for i in range(40)]
    got, _ = classes(spark, data)
    class_of = {i: c for i, c, _ in got}
    assert [(i, class_of[i]) for i, _, _ in brute(once)] == [(i, c) for i, c, _ in brute(once)]
    assert all(class_of[5001 + i] == class_of[5000] for i in range(40))


def test_a_shared_passage_costs_in_proportion_to_its_documents(spark, monkeypatch):
    """Twice the documents hand about twice the rows to the comparison, not four times."""
    rng = random.Random(9)
    passage = corpus.text(rng, "fr", 30)
    handed = []
    compare = neardup.compare
    monkeypatch.setattr(neardup, "compare", lambda m, *a: handed.append(m.count()) or compare(m, *a))
    sums = []
    for n in (150, 300, 600):
        data = [(i, passage + "\n" + corpus.text(rng, "de", 50), "de", "s", 0) for i in range(n)]
        data += [(10_000 + i, data[i][1] + " more", "de", "s", 0) for i in range(0, n, 10)]
        handed.clear()
        got, _ = classes(spark, data, block_rows=20)
        assert {r[0]: r[2] for r in got} == {r[0]: 2 if r[0] % 10 == 0 else 1 for r in data}
        sums.append(sum(handed))
    assert sums[2] < 2.6 * sums[1] < 2.6 * 2.6 * sums[0], sums


def test_every_shingle_weighs_by_its_count(spark):
    """Texts that share a rare passage and differ in lines that a few texts hold: alike by exact counts only."""
    rng = random.Random(4)
    lines = [corpus.text(rng, "fr", 16) for _ in range(2)]
    passage = corpus.text(rng, "en", 100)
    data = [(i, corpus.text(rng, "de", 40) + "\n" + lines[i % 2], "de", "s", 0) for i in range(72)]
    data += [(100 + i, corpus.text(rng, "en", 40), "en", "s", 0) for i in range(720)]
    data += [(5000 + i, passage + "\n" + lines[i], "en", "s", 0) for i in range(2)]
    sets = [shingles(r[1]) for r in data]
    df = collections.Counter(s for c in sets for s in c)
    assert max(df.values()) < neardup.RARE * len(data)
    a, b = ({s: (1 + np.log(n)) * np.log1p(len(data) / df[s]) for s, n in c.items()} for c in sets[-2:])
    common = sum(min(w, b[s]) for s, w in a.items() if s in b)
    assert common >= 0.8 * (sum(a.values()) + sum(b.values()) - common)
    got, _ = classes(spark, data)
    assert [r for r in got if r[0] >= 5000] == [(5000, 5000, 2), (5001, 5000, 2)]
    assert all(r[2] == 1 for r in got if r[0] < 5000)


def test_counts_of_all_shingles_are_exact(spark):
    data = corpus.rows(200, 13) + [(9000 + i, "a common line of words " + str(i), "en", "s", 0) for i in range(50)]
    data += [(9500 + i, "one of two " * 3, "en", "s", 0) for i in range(2)]
    docs = with_row_key(corpus.frame(spark, data).repartition(7))
    once = neardup.one_of_each(docs, neardup.keep(neardup.name_texts(docs, ["doc_id"]), "named"))
    signed = neardup.sign(once, neardup.fit_idf(once), 0.8).join(once.select("cid", "text"), "cid").collect()
    df = collections.Counter(s for r in signed for s in shingles(r["text"]))
    assert len(signed) == len({r[1] for r in data if r[1] is not None})
    for r in signed:
        assert sorted(r["df"]) == sorted(df[s] for s in shingles(r["text"]))
