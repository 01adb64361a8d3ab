"""Document quality by a linear-chain conditional random field over lines.

Every line is good or bad. Its state depends on features of itself and of the lines before and
after it, and on the states next to it. The chance of each line to be good comes from the forward
and backward recursions over all lines; a document's quality is their mean, weighted by length,
brought to a probability by a logistic curve.

The field is fitted on at most ``docs_per_class`` documents of each label, chosen by hash, every line
taking its document's label; from a long document at most ``SEGMENTS`` runs of ``SEGMENT`` lines
teach. Scores are for whole texts.

A long text is never held as a matrix: its lines are taken in pieces of about ``PIECE`` bytes that keep a number for each line
and for what it says about its neighbours, and the recursions run over these numbers.

Defined cases: a null or empty text is one empty line; repeated rows score alike; extra columns are ignored; an empty table
gives no rows; without labelled rows every score is 0.5;
labels other than 0 and 1 teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctpulse.llm import arrays

SEGMENT, SEGMENTS = 64, 4
SHARES = 10
PLAIN = 2 * SHARES + 5
AGAIN = [8, SHARES + 8]  # columns that tell a line seen before
PIECE = 1 << 20
LONG = 2 * arrays.BLOCK  # bytes; only a text alone in its block is longer
COLUMNS = 3 * PLAIN + 1


def line_features(data: np.ndarray, offsets: np.ndarray):
    """Features of every line, each line's bytes and text, and the first line of each text."""
    plain, size, first, text_of, name = plain_features(data, offsets)
    plain[:, AGAIN] = seen_before(name, text_of)[:, None]
    before, after = np.zeros_like(plain), np.zeros_like(plain)
    if len(plain) > 1:
        linked = text_of[1:] == text_of[:-1]
        before[1:][linked] = plain[:-1][linked]
        after[:-1][linked] = plain[1:][linked]
    features = np.concatenate([plain, before, after, np.ones((len(plain), 1))], 1)
    return features, size, first


def seen_before(name: np.ndarray, text_of: np.ndarray) -> np.ndarray:
    """1 for lines whose words an earlier line of the text has; lines without words have the name 0."""
    again = np.zeros(len(name))
    rank = np.lexsort((name, text_of))
    twin = (name[rank][1:] == name[rank][:-1]) & (text_of[rank][1:] == text_of[rank][:-1])
    again[rank[1:][twin]] = 1
    again[name == 0] = 0
    return again


def plain_features(data: np.ndarray, offsets: np.ndarray):
    """A line's own features, but for ``AGAIN``; its bytes, the first line of each text, its text and its words' name."""
    n = len(data)
    newline = np.flatnonzero(data == 10)
    # A line ends at its newline or with its text.
    ends = np.concatenate([newline, offsets[1:]])
    text_of = np.concatenate(
        [np.searchsorted(offsets, newline, "right") - 1, np.arange(len(offsets) - 1)]
    )
    order = np.lexsort((ends, text_of))
    ends, text_of = ends[order], text_of[order]
    first = np.searchsorted(text_of, np.arange(len(offsets)))
    starts = np.zeros(len(ends), np.int64)
    starts[1:] = ends[:-1] + 1
    starts[first[:-1]] = offsets[:-1]
    size = ends - starts

    def count(flag: np.ndarray) -> np.ndarray:
        total = np.zeros(n + 1, np.int64)
        np.cumsum(flag, out=total[1:])
        return (total[ends] - total[starts]).astype(float)

    kind = np.zeros(256, np.uint8)  # 1 capital, 2 small, 3 digit, 4 blank, 5 usual mark, 6 other
    kind[33:127] = 6
    kind[65:91], kind[97:123], kind[48:58] = 1, 2, 3
    kind[[9, 11, 12, 13, 32]] = 4
    kind[[ord(c) for c in ".,;:'\"?()-"]] = 5
    kind[128:] = 2
    seen = kind[data]
    words = arrays.Words(data, offsets)
    line = np.searchsorted(ends, words.start, "right") if len(ends) else words.start
    line = np.minimum(line, max(0, len(ends) - 1))
    same = np.zeros(len(words.hash), bool)
    if len(same) > 1:
        same[1:] = (words.hash[1:] == words.hash[:-1]) & (line[1:] == line[:-1])
    per_line = np.bincount(line, minlength=len(ends)).astype(float)
    repeats = np.bincount(line, same, minlength=len(ends))
    letters = np.maximum(count((seen == 1) | (seen == 2)), 1)
    long = np.maximum(size, 1)
    bars, shouts = count(data == ord("|")), count(data == ord("!"))
    other = count(seen == 6) - bars - shouts
    # Words of a line, whatever their order, tell a line that was seen before in its text.
    spread = arrays.mix(words.hash + np.uint64(7))
    total = np.zeros(len(spread) + 1, np.uint64)
    np.cumsum(spread, out=total[1:])
    at = np.searchsorted(line, np.arange(len(ends) + 1))
    name = np.where(per_line == 0, np.uint64(0), np.maximum(total[at[1:]] - total[at[:-1]], np.uint64(1)))
    shares = np.stack([
        count(seen == 1) / letters, count(seen == 3) / long, count(seen == 4) / long,
        count(seen == 5) / long, other / long, bars / long, shouts / long,
        repeats / np.maximum(per_line, 1), np.zeros(len(ends)), letters / long,
    ], 1)
    plain = np.concatenate([
        shares, np.minimum(1, 12 * shares),
        np.stack([np.log1p(size) / 8, per_line == 0, per_line < 4,
                  np.minimum(letters / np.maximum(per_line, 1) / 10, 3),
                  np.minimum(size / long, 1)], 1),
    ], 1)
    return plain, size + 1.0, first, text_of, name


def pieces_of_lines(data: np.ndarray, limit: int = PIECE) -> Iterator[np.ndarray]:
    """One text in runs of whole lines of about ``limit`` bytes, without the newline between two runs."""
    start = 0
    while True:
        cut = start + limit
        rest = np.flatnonzero(data[cut:] == 10)[:1] if cut < len(data) else []
        if not len(rest):
            yield data[start:]
            return
        end = cut + int(rest[0])
        yield data[start:end]
        start = end + 1


def long_unary(data: np.ndarray, weights: np.ndarray, limit: int = PIECE) -> tuple[np.ndarray, np.ndarray]:
    """What ``line_features @ weights`` gives for one text, and the lines' sizes, piece by piece."""
    parts = weights[:-1].reshape(3, PLAIN)
    told, sizes, names = [], [], []
    for piece in pieces_of_lines(data, limit):
        plain, size, _, _, name = plain_features(piece, np.array([0, len(piece)]))
        told.append(plain @ parts.T)
        sizes.append(size)
        names.append(name)
    name = np.concatenate(names)
    own = np.concatenate(told) + seen_before(name, np.zeros(len(name), np.int8))[:, None] * parts[:, AGAIN].sum(1)
    unary = own[:, 0] + weights[-1]
    unary[1:] += own[:-1, 1]
    unary[:-1] += own[1:, 2]
    return unary, np.concatenate(sizes)


def run_features(data: np.ndarray, cuts: list[tuple[int, int]], limit: int = PIECE) -> list[tuple]:
    """Features and sizes of some runs of lines of one text, as ``line_features`` gives them."""
    newline = np.flatnonzero(data == 10)
    begin, end = np.concatenate([[0], newline + 1]), np.append(newline, len(data))
    names = [plain_features(p, np.array([0, len(p)]))[4] for p in pieces_of_lines(data, limit)]
    name = np.concatenate(names)
    again = seen_before(name, np.zeros(len(name), np.int8))
    out = []
    for s, e in cuts:
        low, high = max(0, s - 1), min(len(begin), e + 1)
        part = data[begin[low] : end[high - 1]]
        x, size, _ = line_features(part, np.array([0, len(part)]))
        near = np.zeros((high - low, 3))
        near[:, 0] = again[low:high]
        near[1:, 1] = near[:-1, 0]
        near[:-1, 2] = near[1:, 0]
        for k in range(3):
            x[:, [k * PLAIN + c for c in AGAIN]] = near[:, k, None]
        out.append((x[s - low : e - low], size[s - low : e - low]))
    return out


@dataclass
class Field:
    """``weights`` of the features for a good line, ``step[i, j]`` from state i to j, the curve."""

    weights: np.ndarray
    step: np.ndarray
    slope: float = 1.0
    offset: float = 0.0

    def odds(self, unary: np.ndarray, first: np.ndarray):
        """Log odds of "good" from the left (line included) and from the right (not included).

        All texts advance together, the longest first, so a position costs one vector step.
        """
        s = self.step
        lengths = np.diff(first)
        by_length = np.argsort(-lengths, kind="stable")
        start, lengths = first[:-1][by_length], lengths[by_length]
        left, right = unary.copy(), np.zeros(len(unary))
        most = int(lengths[0]) if len(lengths) else 0
        alive = np.searchsorted(-lengths, -np.arange(1, most + 1), "right")
        for t in range(1, most):
            at = start[: alive[t]] + t
            x = left[at - 1]
            left[at] += np.logaddexp(x + s[1, 1], s[0, 1]) - np.logaddexp(x + s[1, 0], s[0, 0])
        last = start + lengths - 1
        for t in range(1, most):
            at = last[: alive[t]] - t
            x = unary[at + 1] + right[at + 1]
            right[at] = np.logaddexp(x + s[1, 1], s[1, 0]) - np.logaddexp(x + s[0, 1], s[0, 0])
        return left, right

    def marginals(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        return self.chances(features @ self.weights, first)

    def chances(self, unary: np.ndarray, first: np.ndarray) -> np.ndarray:
        left, right = self.odds(unary, first)
        return 1 / (1 + np.exp(-np.clip(left + right, -30, 30)))

    def means(self, good: np.ndarray, size: np.ndarray, first: np.ndarray) -> np.ndarray:
        return np.add.reduceat(good * size, first[:-1]) / np.add.reduceat(size, first[:-1])

    def scores(self, mean: np.ndarray) -> np.ndarray:
        odds = np.log(np.clip(mean, 1e-6, 1 - 1e-6) / np.clip(1 - mean, 1e-6, 1))
        return 1 / (1 + np.exp(-np.clip(self.slope * odds + self.offset, -30, 30)))


def fit_field(
    features: np.ndarray, first: np.ndarray, good: np.ndarray, rounds: int = 150,
    penalty: float = 1e-3, rate: float = 0.15,
) -> Field:
    """Likelihood ascent (Adam); ``good`` is the label of each sequence, all its lines taking it."""
    field = Field(np.zeros(features.shape[1]), np.zeros((2, 2)))
    label = np.repeat(good, np.diff(first)).astype(float)
    inner = np.ones(len(label), bool)
    inner[first[:-1]] = False
    here = np.flatnonzero(inner)
    n = len(label)
    truth = np.zeros((2, 2))
    np.add.at(truth, (label[here - 1].astype(int), label[here].astype(int)), 1)
    m1, m2 = np.zeros(features.shape[1] + 4), np.zeros(features.shape[1] + 4)
    for t in range(1, rounds + 1):
        unary = features @ field.weights
        left, right = field.odds(unary, first)
        p = 1 / (1 + np.exp(-np.clip(left + right, -30, 30)))
        a, b = left[here - 1], unary[here] + right[here]
        pair = np.stack([np.stack([field.step[i, j] + i * a + j * b for j in (0, 1)])
                         for i in (0, 1)])
        pair = np.exp(pair - pair.max((0, 1)))
        pair /= pair.sum((0, 1))
        gradient = np.concatenate([
            features.T @ (label - p) / n - penalty * field.weights,
            ((truth - pair.sum(2)) / n - penalty * field.step).ravel(),
        ])
        m1 = 0.9 * m1 + 0.1 * gradient
        m2 = 0.99 * m2 + 0.01 * gradient**2
        change = rate * (m1 / (1 - 0.9**t)) / (np.sqrt(m2 / (1 - 0.99**t)) + 1e-8)
        field.weights += change[:-4]
        field.step += change[-4:].reshape(2, 2)
    return field


def logistic_curve(x: np.ndarray, y: np.ndarray, rounds: int = 60) -> tuple[float, float]:
    """Slope and offset of P(y) over x by damped Newton steps, with a slight pull to 0."""
    a = np.stack([x, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (y - p) - 1e-2 * w
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 1e-2 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        w += step * min(1.0, 4 / max(1e-9, np.abs(step).max()))
    return float(w[0]), float(w[1])


def _teach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in arrays.blocks(batch, "text"):
            data, offsets = arrays.utf8(part.column("text"))
            labels = part.column("label").to_pylist()
            out: dict[str, list] = {"label": [], "doc": [], "x": [], "size": []}
            long = len(data) > LONG
            if long:  # one text alone, see arrays.blocks
                first = np.array([0, 1 + int((data == 10).sum())])
            else:
                x, size, first = line_features(data, offsets)
            for i, label in enumerate(labels):
                cuts = np.arange(first[i], first[i + 1], SEGMENT)
                if len(cuts) > SEGMENTS:  # evenly over the document
                    cuts = cuts[np.linspace(0, len(cuts) - 1, SEGMENTS).astype(int)]
                runs = [(int(s), int(min(s + SEGMENT, first[i + 1]))) for s in cuts]
                found = run_features(data, runs) if long else [(x[s:e], size[s:e]) for s, e in runs]
                for own, sizes in found:
                    out["label"].append(label)
                    out["doc"].append(part.column("doc")[i].as_py())
                    out["x"].append(own.astype(np.float32).tobytes())
                    out["size"].append(sizes.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_pydict(out, pa.schema([
                ("label", pa.int32()), ("doc", pa.int64()), ("x", pa.binary()),
                ("size", pa.binary())]))


def labelled_sample(docs: DataFrame, labels: DataFrame, docs_per_class: int, salt: str):
    """Documents with their ``label``, about ``docs_per_class`` of each, and the labels' counts.

    The sample is drawn from the labels, by a hash of ``doc_id``; it is bounded, so it is broadcast and
    no text moves. None if either label has no rows.
    """
    labels = labels.select("doc_id", F.col("label").cast("int")).where(F.col("label").isin(0, 1))
    sizes = {r["label"]: r["count"] for r in labels.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    place = F.xxhash64(F.col("doc_id"), F.lit(salt)).bitwiseAND(F.lit(0xFFFFFF)) / (1 << 24)
    share = F.when(F.col("label") == 1, F.lit(docs_per_class / sizes[1])).otherwise(
        F.lit(docs_per_class / sizes[0]))
    chosen = labels.where(place < share).withColumnRenamed("doc_id", "_acct_id")
    found = docs.select("doc_id", "text").join(
        F.broadcast(chosen), F.col("doc_id") == F.col("_acct_id")
    )
    return found.select("doc_id", "text", "label"), sizes


def train(docs: DataFrame, labels: DataFrame, docs_per_class: int = 3000) -> Field | None:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1).

    None if a label has no rows. A document that has several labels teaches each of them.
    """
    drawn = labelled_sample(docs, labels, docs_per_class, "quality")
    if drawn is None:
        return None
    labelled, sizes = drawn
    rows = (
        labelled.select("text", "label", F.xxhash64("doc_id").alias("doc"))
        .mapInArrow(_teach, "label int, doc bigint, x binary, size binary")
        .orderBy("doc", F.xxhash64("x"))
        .collect()  # docs_per_class * 2 * SEGMENTS rows of SEGMENT lines at most
    )
    if len({r["label"] for r in rows}) < 2:
        return None
    x = [np.frombuffer(r["x"], np.float32).reshape(-1, COLUMNS) for r in rows]
    first = np.cumsum([0, *map(len, x)])
    features, label = np.concatenate(x).astype(float), np.array([r["label"] for r in rows])
    field = fit_field(features, first, label)
    size = np.concatenate([np.frombuffer(r["size"], np.float32) for r in rows]).astype(float)
    mean = field.means(field.marginals(features, first), size, first)
    # The classes were sampled evenly; weights bring the curve back to their true shares.
    odds = np.log(np.clip(mean, 1e-6, 1 - 1e-6) / np.clip(1 - mean, 1e-6, 1))
    field.slope, offset = logistic_curve(odds, label.astype(float))
    taken = {c: min(1.0, docs_per_class / sizes[c]) for c in (0, 1)}
    field.offset = offset + float(np.log(taken[0] / taken[1]))
    return field


def score(docs: DataFrame, field: Field | None, keys: list[str], lines: bool = False) -> DataFrame:
    """``keys`` and ``score`` for every row, and with ``lines`` each line's chance to be ``good``."""
    model = None if field is None else vars(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        field = None if model is None else Field(**model)
        for batch in batches:
            for part in arrays.blocks(batch, "_acct_text"):
                data, offsets = arrays.utf8(part.column("_acct_text"))
                weights = np.zeros(COLUMNS) if field is None else field.weights
                if len(data) > LONG:
                    unary, size = long_unary(data, weights)
                    first = np.array([0, len(unary)])
                else:
                    x, size, first = line_features(data, offsets)
                    unary = x @ weights
                if field is None:
                    good, scores = np.full(len(unary), 0.5), np.full(part.num_rows, 0.5)
                else:
                    good = field.chances(unary, first)
                    scores = field.scores(field.means(good, size, first))
                cols = [part.column(k) for k in keys] + [pa.array(scores)]
                if lines:
                    cols.append(pa.array(np.split(good, first[1:-1])))
                yield pa.RecordBatch.from_arrays(cols, [*keys, "score", *["good"] * lines])

    given = docs.select(*keys, F.coalesce("text", F.lit("")).alias("_acct_text"))
    kinds = ", ".join(f"{k} {given.schema[k].dataType.simpleString()}" for k in keys)
    return given.mapInArrow(run, f"{kinds}, score double" + ", good array<double>" * lines)
