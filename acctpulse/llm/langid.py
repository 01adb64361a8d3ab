"""Language identification by bit-sliced Bloom filters over byte n-grams.

A filter row holds one bit per language; the rows at an n-gram's positions, combined by AND, are
the mask of all languages that contain it. A text's hits are counted per language, freed from the
filters' expected false positives, and the language with the largest share of n-grams wins.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is everything if
nothing was learned. Equal hits go to the language with more training rows, then the
smaller name. Rows with null ``lang`` teach nothing. Repeated rows count as often as they occur. Any number of languages
is learned: a mask has a word for each ``WORD_BITS`` of them. Texts may be of any length and are read whole; an empty table
gives no rows, and an empty one to learn from makes every text ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acctpulse.llm import arrays

UNKNOWN = "und"
N = 4
WORD_BITS = 64


@dataclass
class LanguageFilter:
    """``rows``: per filter position a word of language bits, or several. ``false_rate``: per language."""

    languages: list[str]
    rows: np.ndarray
    false_rate: np.ndarray
    hashes: int = 3

    def bit(self, words: np.ndarray, no: int) -> np.ndarray:
        """Whether each row of ``words`` has the language's bit."""
        width = self.rows.dtype.itemsize * 8
        kind = self.rows.dtype.type
        return (words[:, no // width] >> kind(no % width)) & kind(1)


def _prepared(text: Column) -> Column:
    """Lower case with a blank at either end, so that word borders are in the n-grams."""
    return F.concat(F.lit(" "), F.lower(text), F.lit(" "))


def _grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """N-grams of letters and single blanks, packed into integers, and each one's text."""
    letter = np.zeros(256, bool)
    letter[97:123] = letter[128:] = True
    is_letter = letter[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    stay = is_letter.copy()
    stay[1:] |= is_letter[:-1]
    stay |= edge[:-1]
    kept = np.flatnonzero(stay)
    chars = np.where(is_letter[kept], data[kept], np.uint8(32)).astype(np.uint32)
    doc = np.searchsorted(offsets, kept, "right") - 1
    n = len(chars) - N + 1
    if n <= 0:
        return np.zeros(0, np.uint32), np.zeros(0, np.int64)
    packed = np.zeros(n, np.uint32)
    for j in range(N):
        packed = (packed << np.uint32(8)) | chars[j : j + n]
    same = np.flatnonzero(doc[:n] == doc[N - 1 :])
    return packed[same], doc[same]


def _places(grams: np.ndarray, size: int, hashes: int) -> list[np.ndarray]:
    h = arrays.mix(grams.astype(np.uint64) + np.uint64(1))
    cut = np.uint64(size - 1)
    return [((h >> np.uint64(21 * i)) & cut).astype(np.int64) for i in range(hashes)]


def _count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in arrays.blocks(batch, "text"):
            names = part.column("lang").to_pylist()
            known = sorted(set(names))
            code = np.array([known.index(x) for x in names], np.uint64)
            grams, doc = _grams(*arrays.utf8(part.column("text")))
            found, n = np.unique((code[doc] << np.uint64(32)) | grams, return_counts=True)
            yield pa.RecordBatch.from_pydict(
                {
                    "lang": pa.array(known, pa.string()).take(pa.array(found >> np.uint64(32))),
                    "gram": (found & np.uint64(0xFFFFFFFF)).astype(np.int64),
                    "n": n.astype(np.int64),
                }
            )


def fit_filter(
    labelled: DataFrame,
    key: Column,
    rows_per_language: int = 4000,
    least_rate: float = 5e-5,
    least_share: float = 0.2,
) -> LanguageFilter:
    """Learns from ``lang`` and ``text`` of at most about ``rows_per_language`` rows a language.

    ``key`` picks these rows by its hash, alike in every run. An n-gram enters a language's
    filter if it makes up ``least_rate`` of that language's n-grams (so a filter holds
    1 / least_rate at most) and its rate is ``least_share`` of the highest of all languages.
    """
    labelled = labelled.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    sizes = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}  # a row a language
    if not sizes:
        return LanguageFilter([], np.zeros((1, 1), np.uint8), np.zeros(0))
    languages = sorted(sizes, key=lambda x: (-sizes[x], x))
    share = F.create_map(
        *[F.lit(x) for k, n in sizes.items() for x in (k, min(1.0, rows_per_language / n))]
    )
    place = (F.xxhash64(key, F.lit("langid")).bitwiseAND(F.lit(0xFFFFFF))) / F.lit(float(1 << 24))
    sample = labelled.where(place < share[F.col("lang")])
    counted = (
        sample.select("lang", _prepared(F.col("text")).alias("text"))
        .mapInArrow(_count_grams, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram")
        .agg(F.sum("n").alias("n"))
    )
    totals = {r["lang"]: r["n"] for r in counted.groupBy("lang").agg(F.sum("n").alias("n")).collect()}
    least = F.create_map(*[F.lit(x) for k, n in totals.items() for x in (k, least_rate * n)])
    frequent = counted.where(F.col("n") >= least[F.col("lang")]).collect()  # 1 / least_rate each
    rates: dict[int, dict[str, float]] = {}
    for r in frequent:
        rates.setdefault(r["gram"], {})[r["lang"]] = r["n"] / totals[r["lang"]]
    member = {x: [] for x in languages}
    for gram, by in rates.items():
        top = max(by.values())
        for lang, rate in by.items():
            if rate >= least_share * top:
                member[lang].append(gram)
    most = max(map(len, member.values()))
    size = 1 << max(10, int(np.ceil(np.log2(max(1, 16 * most)))))
    word = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64)
                if np.dtype(t).itemsize * 8 >= min(WORD_BITS, len(languages)))
    width = np.dtype(word).itemsize * 8
    rows = np.zeros((size, -(-len(languages) // width)), word)
    model = LanguageFilter(languages, rows, np.zeros(len(languages)))
    for bit, lang in enumerate(languages):
        for place in _places(np.array(member[lang], np.uint32), size, model.hashes):
            rows[place, bit // width] |= word(1 << (bit % width))
        filled = float(model.bit(rows, bit).mean())
        model.false_rate[bit] = filled**model.hashes
    return model


def corrected_rates(model: LanguageFilter, data: np.ndarray, offsets: np.ndarray):
    """Per text and language the share of n-grams that the language holds; n-grams per text."""
    grams, doc = _grams(data, offsets)
    ends = np.searchsorted(doc, np.arange(len(offsets)))
    n = np.diff(ends)
    mask = None
    for place in _places(grams, len(model.rows), model.hashes):
        found = model.rows[place]
        mask = found if mask is None else mask & found
    rates = np.zeros((len(offsets) - 1, len(model.languages)))
    for bit in range(len(model.languages)):
        total = np.zeros(len(grams) + 1, np.int64)
        np.cumsum(model.bit(mask, bit), out=total[1:])
        share = np.diff(total[ends]) / np.maximum(n, 1)
        rates[:, bit] = np.maximum(0, share - model.false_rate[bit]) / (1 - model.false_rate[bit])
    return rates, n


def identify(docs: DataFrame, model: LanguageFilter, keys: list[str]) -> DataFrame:
    """``keys``, ``lang_pred``, ``score``, ``fit`` and ``n_grams`` for every row; one map over it.

    ``score`` is the winner's part of all corrected hits; ``fit`` is the share of the text's
    n-grams that the winner's filter holds.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vars(model))  # 8 bytes a position, see fit_filter

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = LanguageFilter(**shared.value)
        names = pa.array([*model.languages, UNKNOWN], pa.string())
        for batch in batches:
            for part in arrays.blocks(batch, "_acct_text"):
                legible = part.column("_acct_letters").to_numpy(zero_copy_only=False)
                legible = legible.astype(bool)
                data, offsets = arrays.utf8(part.column("_acct_text"))
                best = np.full(len(legible), len(model.languages))
                share, fit, n = np.zeros(len(best)), np.zeros(len(best)), np.zeros(len(best), int)
                if model.languages:
                    rates, n = corrected_rates(model, data, offsets)
                    best = np.where(legible, rates.argmax(1), best)
                    fit = np.where(legible, rates.max(1), 0.0)
                    share = np.where(legible, fit / np.maximum(rates.sum(1), 1e-12), 0.0)
                cols = [part.column(k) for k in keys] + [
                    names.take(pa.array(best)), pa.array(np.minimum(share, 1.0)),
                    pa.array(fit), pa.array(n.astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays(
                    cols, [*keys, "lang_pred", "score", "fit", "n_grams"]
                )

    text = F.col("text")
    given = docs.select(
        *keys,
        F.coalesce(_prepared(text), F.lit("")).alias("_acct_text"),
        F.coalesce(text.rlike(r"\p{L}"), F.lit(False)).alias("_acct_letters"),
    )
    kinds = ", ".join(f"{k} {given.schema[k].dataType.simpleString()}" for k in keys)
    return given.mapInArrow(
        score, f"{kinds}, lang_pred string, score double, fit double, n_grams bigint"
    )


def accepted(least_fit: float = 0.02, least_grams: int = 20) -> Column:
    """Rows to keep: in a learned language, unless a text of some length fits none of them."""
    misfit = (F.col("n_grams") >= least_grams) & (F.col("fit") < least_fit)
    return (F.col("lang_pred") != UNKNOWN) & ~misfit
