import hashlib
import random
import re

import corpus
import pytest

from acctpulse.llm import decontaminate
from acctpulse.llm.decontaminate import LOWER, UPPER, WORD
from acctpulse.llm.tables import with_row_key


def words(text):
    return re.findall(WORD, (text or "").translate(str.maketrans(UPPER, LOWER)))


def brute(docs, items):
    runs = {}
    for i, t in items:
        w = words(t)
        for j in range(max(1, len(w) - 12) if w else 0):
            runs.setdefault(tuple(w[j : j + 13]), set()).add(str(i))
    out = []
    for doc in docs:
        w, hit, found = words(doc[1]), set(), set()
        for n in {len(r) for r in runs}:
            for j in range(len(w) - n + 1):
                if tuple(w[j : j + n]) in runs:
                    hit.update(range(j, j + n))
                    found |= runs[tuple(w[j : j + n])]
        bad = len(hit) > 0 and 20 * len(hit) >= len(w)
        out.append((doc[0] if doc[0] is not None else -1, len(w), len(hit), sorted(found), bad))
    return sorted(out)


def spark_hits(spark, docs, items):
    docs = with_row_key(corpus.frame(spark, docs, clashing=True).repartition(3))
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.hits_per_row(docs, bench, ["doc_id"]).collect()
    return sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_words"], r["n_hit"],
                   r["items"], r["contaminated"]) for r in rows)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_hits_are_those_of_a_plain_search(spark, seed):
    rng = random.Random(seed)
    docs = corpus.rows(60, seed)
    items = []
    for i in range(25):
        base = words(rng.choice(docs)[1])
        s, n = rng.randrange(len(base)), rng.choice([1, 2, 4, 5, 6, 12, 13, 14, 30])
        items.append((i, " ".join(base[s : s + n]).title()))
    items += [(100, None), (101, ""), (102, "..."), (103, items[0][1]), (104, "a b c"), (None, "q")]
    docs = docs + corpus.awkward()
    # Few letters make repeats, overlaps and near misses.
    docs += [(5000 + i, " ".join(rng.choice("ab") for _ in range(80)), "en", "s", 0) for i in range(20)]
    items += [(200 + i, " ".join(rng.choice("ab") for _ in range(rng.choice([3, 6, 14])))) for i in range(8)]
    items = [x for x in items if x[0] is not None]
    assert spark_hits(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    assert spark_hits(spark, [], [(1, "the and")]) == []
    got = spark_hits(spark, corpus.awkward(), [])
    assert got == brute(corpus.awkward(), [])


def test_the_rule_of_a_twentieth(spark):
    run = " ".join(f"w{i}" for i in range(13))
    at, below = " ".join([run] + ["x"] * 247), " ".join([run] + ["x"] * 248)
    docs = [(1, at, "en", "s", 0), (2, below, "en", "s", 0)]
    assert [r[4] for r in spark_hits(spark, docs, [(7, run)])] == [True, False]
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
