import random

import corpus
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from acctpulse.llm import arrays, langid


@pytest.fixture(scope="module")
def model(spark):
    return langid.fit_filter(corpus.frame(spark, corpus.rows(300)), F.col("doc_id"))


def predict(docs, model):
    return {r["doc_id"]: r for r in langid.identify(docs, model, ["doc_id"]).collect()}


def test_unseen_texts_get_their_language(spark, model):
    data = corpus.rows(200, seed=5)
    got = predict(corpus.frame(spark, data), model)
    long = [(i, lang) for i, t, lang, _, _ in data if len(t.split()) >= 3]
    assert sum(got[i]["lang_pred"] == lang for i, lang in long) >= 0.97 * len(long)
    assert all(0 <= r["score"] <= 1 for r in got.values())


def test_false_positives_are_measured(model):
    assert (model.false_rate < 0.05).all() and len(model.languages) == 3


def test_awkward_rows(spark, model):
    docs = corpus.frame(spark, corpus.awkward(), clashing=True)
    rows = langid.identify(docs, model, ["doc_id"]).collect()
    assert len(rows) == len(corpus.awkward())
    by = {r["doc_id"]: r for r in rows}
    for i in (1000, 1001, 1002, 1004, 1008):
        assert by[i]["lang_pred"] == "und" and by[i]["score"] == 0
    assert by[1005]["lang_pred"] == "en" and by[1003]["lang_pred"] == "en"


def test_nothing_learned(spark):
    empty = corpus.frame(spark, [])
    model = langid.fit_filter(empty, F.col("doc_id"))
    assert {r["lang_pred"] for r in predict(corpus.frame(spark, corpus.rows(5)), model).values()} == {"und"}
    assert langid.identify(empty, model, ["doc_id"]).count() == 0


def test_two_hundred_languages(spark):
    """Several words a mask; every language is found again in texts that taught nothing."""
    rng = random.Random(5)
    letters = "abcdefghijklmnopqrstuvwxyzäöüéèñçşğ"
    words = {f"l{n:03}": ["".join(rng.choices(letters, k=5)) for _ in range(12)] for n in range(200)}
    rows = [(i, " ".join(rng.choices(words[lang], k=40)), lang, "s", 0) for i, lang in enumerate([*words] * 4)]
    df = corpus.frame(spark, rows)
    model = langid.fit_filter(df.where("doc_id < 600"), F.col("doc_id"))
    assert len(model.languages) == 200 and model.rows.shape[1] == 4
    told = langid.identify(df.where("doc_id >= 600"), model, ["doc_id", "lang"]).collect()
    assert len(told) == 200 and all(r.lang == r.lang_pred for r in told)


def test_masks_hold_every_gram_and_few_others(spark):
    """Against plain sets: no n-gram of a language is missed, and false hits are as rare as reckoned."""
    df = corpus.frame(spark, corpus.rows(120, 4))
    model = langid.fit_filter(df, F.col("doc_id"), least_rate=0.0, least_share=0.0)
    grams = {}
    for _, t, lang, *_ in corpus.rows(120, 4):
        data, offsets = arrays.utf8(pa.array([f" {t.lower()} "]))
        grams.setdefault(lang, set()).update(langid._grams(data, offsets)[0].tolist())
    every = np.array(sorted(set().union(*grams.values())), np.uint32)
    mask = None
    for place in langid._places(every, len(model.rows), model.hashes):
        mask = model.rows[place] if mask is None else mask & model.rows[place]
    for no, lang in enumerate(model.languages):
        held = model.bit(mask, no).astype(bool)
        own = np.array([int(g) in grams[lang] for g in every])
        assert held[own].all()
        assert held[~own].mean() <= model.false_rate[no] + 0.02


def test_counting_holds_a_block_of_text_at_a_time():
    text = "the quick brown fox " * (arrays.BLOCK * 3 // 5 // 20)
    batch = pa.RecordBatch.from_pydict({"lang": ["en", "de", "en"], "text": [text] * 3})
    told = list(langid._count_grams(iter([batch])))
    assert len(told) == 3  # two of them would be more than a block
    assert sum(sum(b.column("n").to_pylist()) for b in told) == 3 * sum(told[0].column("n").to_pylist())
