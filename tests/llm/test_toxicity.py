import itertools
import random

import corpus
import numpy as np
import pyarrow as pa

from acctpulse.llm import arrays, toxicity

MARK = chr(toxicity.MARK)


def plain_kernel(a: str, b: str) -> float:
    def table(s):
        s, out = s.encode(), {}
        for i, j, k in itertools.combinations(range(len(s)), 3):
            if j - i <= toxicity.GAP + 1 and k - j <= toxicity.GAP + 1:
                key = (s[i], s[j], s[k])
                out[key] = out.get(key, 0) + toxicity.DECAY ** (k - i - 2)
        return out

    x, y = table(a), table(b)
    own = np.sqrt(sum(v * v for v in x.values()) * sum(v * v for v in y.values()))
    alike = sum(v * y.get(k, 0) for k, v in x.items()) / own if own else 0.0
    return alike**3 if alike >= toxicity.LEAST else 0.0


def test_kernel_is_the_sum_over_all_subsequences():
    rng = random.Random(1)
    words = [MARK + "".join(rng.choice("abcé") for _ in range(rng.randint(1, 9))) for _ in range(60)]
    marks = toxicity.Landmarks.of(words[:12])
    row, mark, value = marks.similarities(*toxicity.encode(words))
    got = np.zeros((60, 12))
    got[row, mark] = value
    want = np.array([[plain_kernel(a, b) for b in words[:12]] for a in words])
    assert np.allclose(got, want, atol=1e-9)


def test_tokens_join_what_was_pulled_apart():
    texts = ["you i d i o t, i.d.i.o.t! idiot bad. ok", "", None, "a b", "é è ê"]
    tokens = toxicity.Tokens(*arrays.utf8(pa.array(texts, pa.string())))
    own = [(int(tokens.doc[i]), tokens.text(i).removeprefix(MARK)) for i in range(len(tokens.doc))]
    assert own.count((0, "idiot")) == 3 and (4, "éèê") in own and (3, "ab") not in own
    assert {d for d, _ in own} == {0, 3, 4}


def trained(rows):
    return toxicity.train(rows.select("doc_id", "text"), rows.select("doc_id", "label"))


def labelled(spark, n, seed, insults=("vrek", "drolmok", "snirt")):
    rng = random.Random(seed)
    rows = []
    for i, t, *_ in corpus.rows(n, seed):
        words = t.split(" ")
        toxic = i % 4 == 0
        for _ in range(2 if toxic else 0):
            words.insert(rng.randrange(len(words) + 1), rng.choice(insults))
        rows.append((i, " ".join(words), int(toxic), 0.5))
    return spark.createDataFrame(rows, "doc_id long, text string, label int, score double")


def test_unseen_and_disguised_insults(spark):
    machine = trained(labelled(spark, 400, 1))
    rows = toxicity.score(labelled(spark, 200, 2), machine, ["doc_id", "label"]).collect()
    assert sum((r["score"] >= 0.7) == (r["label"] == 1) for r in rows) >= 0.97 * len(rows)
    odd = labelled(spark, 200, 3, ("d r o l m o k", "d.r.o.l.m.o.k", "drollmok", "Drolmoks"))
    rows = toxicity.score(odd, machine, ["doc_id", "label"]).where("label = 1").collect()
    assert sum(r["score"] >= 0.7 for r in rows) >= 0.9 * len(rows)


def test_awkward_rows_and_no_labels(spark):
    docs = corpus.frame(spark, corpus.awkward(), clashing=True)
    machine = trained(labelled(spark, 200, 4))
    scores = {r["doc_id"]: r["score"] for r in toxicity.score(docs, machine, ["doc_id"]).collect()}
    assert all(0 <= s < 0.7 for s in scores.values()) and scores[1000] == scores[1001]
    for data in ([], [(1, "a", 1)], [(1, "a", None), (2, "b", 7)]):
        assert trained(spark.createDataFrame(data, "doc_id long, text string, label int")) is None
    assert {r["score"] for r in toxicity.score(docs, None, ["doc_id"]).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), machine, ["doc_id"]).count() == 0


def test_a_word_counts_once_in_a_sentence(spark):
    machine = trained(labelled(spark, 200, 5))
    docs = spark.createDataFrame([(1, "the vre the"), (2, "the " + "vre " * 500)], "doc_id long, text string")
    a, b = (r["score"] for r in toxicity.score(docs, machine, ["doc_id"]).orderBy("doc_id").collect())
    assert a == b
