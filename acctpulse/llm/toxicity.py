"""Toxicity by a support vector machine on a subsequence kernel between words.

The kernel counts the subsequences of three letters that two words share (the beginning of a word
counts as a letter), with up to ``GAP`` letters skipped before each next one, every skipped letter
costing a factor ``DECAY``; it is normalised and cubed, so that only close words count. A
sentence is the sum over its distinct words. Nyström landmarks are beginnings of words that tell
toxic documents from others; a linear machine with squared hinge loss is trained on sentences in
the space they span.

Letters that are not part of words ("i.d.i.o.t"), and single letters apart ("i d i o t") are joined
before the kernel sees them; inserted letters are gaps.

Labels belong to documents, so the sentence of a toxic document that scores highest
teaches as toxic, found anew in each of a few rounds. A document scores as its worst sentence, brought
to a probability by a logistic curve. Landmarks and machine are fitted on at most
``docs_per_class`` documents of each label, chosen by hash; scores are for whole texts.

Defined cases: a text that is null, empty or without words is an empty sentence; without labelled rows
of both kinds every score is 0. Labels other than 0 and 1 teach nothing.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acctpulse.llm import arrays
from acctpulse.llm.quality import labelled_sample, logistic_curve
from acctpulse.llm.tables import keep

GAP, DECAY = 2, 0.5  # subsequences have three letters
WIDTH = 24  # longer words are cut into pieces of this many bytes, each reaching into the next
STRIDE = 16
LEAST = 0.25  # smaller similarities count as none
STEPS = [(a, b, DECAY ** (a + b - 2)) for a in range(1, GAP + 2) for b in range(1, GAP + 2)]
LANDMARKS, PLAIN_LANDMARKS = 72, 8
PART = 11
MARK = 1
SENTENCES = 12
KNOWN_WORDS = 1 << 19


class Tokens:
    """Words of texts as the kernel sees them: ``data[start:end]``, with text and sentence."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray):
        letter = np.zeros(256, bool)
        letter[97:123] = letter[48:58] = letter[128:] = True
        blank = np.zeros(256, bool)
        blank[[9, 10, 11, 12, 13, 32]] = True
        stop = np.zeros(256, bool)
        stop[[10, 33, 46, 63]] = True
        is_letter, is_blank = letter[raw], blank[raw]
        kept = np.flatnonzero(is_letter)
        data = raw[kept]
        # Words begin after a blank or with a text; marks inside a word are dropped.
        text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
        gap = np.cumsum(is_blank, dtype=np.int32)[kept] + text[kept]
        begin = np.flatnonzero(np.diff(gap, prepend=-1))
        end = np.append(begin[1:], len(data))
        doc = text[kept[begin]].astype(np.int64) if len(begin) else begin
        # A stop that a blank follows (or the text's end) ends a sentence.
        ends = stop[raw]
        ends[:-1] &= is_blank[1:] | (raw[:-1] == 10)
        # A word's own first byte is no stop, so counting up to it counts those before it.
        stops = np.cumsum(ends, dtype=np.int32)
        sentence = stops[kept[begin]].astype(np.int64) if len(begin) else begin
        self.n_docs = len(offsets) - 1
        # Runs of three or more single letters are one more word.
        first = data[begin] if len(begin) else data
        single = (end - begin == 1) | ((end - begin == 2) & (first >= 192))
        edge = np.flatnonzero(np.diff(np.concatenate([[0], single.view(np.int8), [0]])))
        joined, at = [], []
        for s, e in zip(edge[::2], edge[1::2], strict=True):
            while s < e:
                stay = s + int(np.searchsorted(doc[s:e], doc[s], "right"))
                if stay - s >= 3:
                    joined.append(data[begin[s] : end[stay - 1]])
                    at.append(s)
                s = stay
        if joined:
            size = np.array([len(x) for x in joined])
            begin = np.append(begin, len(data) + np.cumsum(size) - size)
            end = np.append(end, len(data) + np.cumsum(size))
            doc, sentence = np.append(doc, doc[at]), np.append(sentence, sentence[at])
            data = np.concatenate([data, *joined])
        # A mark stands before each word, so that the kernel sees where it begins.
        data = np.insert(data, begin, MARK)
        begin = begin + np.arange(len(begin))
        end = begin + 1 + (end - begin + np.arange(len(begin)))
        order = np.lexsort((sentence, doc))
        self.data, self.start, self.end = data, begin[order], end[order]
        self.doc, self.sentence = doc[order], sentence[order]
        self.hash = arrays.hashes(self.data, self.start, self.end)

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")

    def distinct(self) -> tuple[np.ndarray, np.ndarray]:
        """A token of each distinct word, and each token's place among them."""
        _, at, place = np.unique(self.hash, return_index=True, return_inverse=True)
        return at, place


    def once(self, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Of the tokens ``at``, the first of each word in each sentence."""
        if not len(at):
            return at
        sentence = np.unique(self.doc[at] * (self.sentence.max() + 1) + self.sentence[at],
                             return_inverse=True)[1]
        key = sentence * (int(place.max()) + 1) + place[at]
        return at[np.sort(np.unique(key, return_index=True)[1])]


def _pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """Words as rows of a matrix, cut to ``WIDTH``: the matrix, its rows' lengths and words."""
    long = np.maximum(0, end - start - WIDTH)
    n = 1 + -(-long // STRIDE)
    word = np.repeat(np.arange(len(start)), n)
    no = np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)
    begin = start[word] + no * STRIDE
    size = np.minimum(end[word] - begin, WIDTH)
    at = begin[:, None] + np.arange(WIDTH)[None, :]
    matrix = data[np.minimum(at, max(0, len(data) - 1))].astype(np.int32)
    return matrix, size, word


def _flat_pieces(data: np.ndarray, start: np.ndarray, end: np.ndarray):
    """The same pieces one behind another: their bytes, where each begins, its length and word."""
    long = np.maximum(0, end - start - WIDTH)
    n = 1 + -(-long // STRIDE)
    word = np.repeat(np.arange(len(start)), n)
    begin = start[word] + (np.arange(len(word)) - np.repeat(np.cumsum(n) - n, n)) * STRIDE
    size = np.minimum(end[word] - begin, WIDTH)
    first = np.cumsum(size) - size
    at = np.arange(size.sum()) + np.repeat(begin - first, size)
    return data[at].astype(np.uint32), first, size, word


def _cell(code: np.ndarray) -> np.ndarray:
    return (code.astype(np.uint32) * np.uint32(2654435761)) >> np.uint32(16)


def _subsequences(matrix: np.ndarray, size: np.ndarray) -> Iterator[tuple]:
    """For each pattern of gaps: the three letters packed, whether they exist, and the weight."""
    place = np.arange(WIDTH)[None, :]
    for a, b, weight in STEPS:
        span = a + b
        code = (
            (matrix[:, : WIDTH - span] << 16)
            | (matrix[:, a : WIDTH - b] << 8)
            | matrix[:, span:]
        )
        yield code, place[:, : WIDTH - span] < (size - span)[:, None], weight


def _self_similarity(matrix: np.ndarray, size: np.ndarray) -> np.ndarray:
    codes, weights = [], []
    for code, there, weight in _subsequences(matrix, size):
        codes.append(np.where(there, code, -1))
        weights.append(np.where(there, weight, 0.0))
    code, weight = np.concatenate(codes, 1), np.concatenate(weights, 1)
    order = np.argsort(code, 1, kind="stable")
    code, weight = np.take_along_axis(code, order, 1), np.take_along_axis(weight, order, 1)
    flat, total = code.ravel(), weight.ravel()
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    new[:: code.shape[1]] = True
    at = np.flatnonzero(new)
    square = np.add.reduceat(total, at) ** 2
    return np.bincount(at // code.shape[1], square, len(code))


@dataclass
class Landmarks:
    """``words``; their subsequences as ``codes`` (sorted) with lists of word and weight."""

    words: list[str]
    codes: np.ndarray
    first: np.ndarray
    word: np.ndarray
    weight: np.ndarray
    own: np.ndarray

    @staticmethod
    def of(words: list[str]) -> Landmarks:
        raw = [w.encode()[:WIDTH] for w in words]
        size = np.array([len(w) for w in raw], np.int64)
        matrix = np.zeros((len(raw), WIDTH), np.int32)
        for i, w in enumerate(raw):
            matrix[i, : len(w)] = np.frombuffer(w, np.uint8)
        sums: dict[tuple[int, int], float] = {}
        for code, there, weight in _subsequences(matrix, size):
            for i, j in zip(*np.nonzero(there), strict=True):
                key = (int(code[i, j]), int(i))
                sums[key] = sums.get(key, 0.0) + weight
        keys = sorted(sums)
        every = np.array([k[0] for k in keys], np.int64)
        codes, first = np.unique(every, return_index=True)
        own = _self_similarity(matrix, size) if len(raw) else np.zeros(0)
        return Landmarks(
            words, codes, np.append(first, len(every)), np.array([k[1] for k in keys], np.int64),
            np.array([sums[k] for k in keys]), own,
        )

    def similarities(self, data: np.ndarray, start: np.ndarray, end: np.ndarray):
        """Non-zero cubed kernels: word, landmark, value. A long word counts by its best piece."""
        none = np.zeros(0, np.int64)
        if not len(start) or not len(self.codes):
            return none, none, np.zeros(0)
        flat, first, size, word = _flat_pieces(data, start, end)
        known = np.zeros(1 << 16, bool)  # by hash: small enough for a processor's cache
        known[_cell(self.codes)] = True
        # How many bytes of the piece follow each byte; a subsequence may not leave its piece.
        room = (np.repeat(first + size, size) - np.arange(1, len(flat) + 1)).astype(np.int8)
        piece = np.repeat(np.arange(len(size)), size)
        rows, codes, weights = [], [], []
        least = np.zeros(len(size))
        for a, b, weight in STEPS:
            span = a + b
            least += np.maximum(size - span, 0) * weight**2
            if len(flat) <= span:
                continue
            code = (flat[:-span] << 16) | (flat[a : len(flat) - b] << 8) | flat[span:]
            place = np.flatnonzero(known[_cell(code)])
            place = place[room[place] >= span]
            found = code[place]
            at = np.minimum(np.searchsorted(self.codes, found), len(self.codes) - 1)
            same = self.codes[at] == found
            rows.append(piece[place[same]])
            codes.append(at[same])
            weights.append(np.full(same.sum(), weight))
        if not rows:
            return none, none, np.zeros(0)
        row, at, weight = map(np.concatenate, (rows, codes, weights))
        n = self.first[at + 1] - self.first[at]
        pick = np.arange(n.sum()) + np.repeat(self.first[at] - (np.cumsum(n) - n), n)
        near, back = np.unique(row, return_inverse=True)
        cell = np.repeat(back, n) * len(self.words) + self.word[pick]
        value = np.bincount(cell, np.repeat(weight, n) * self.weight[pick], len(near) * len(self.words))
        cell = np.flatnonzero(value)
        if not len(cell):
            return none, none, np.zeros(0)
        row, mark, value = near[cell // len(self.words)], cell % len(self.words), value[cell]
        # ``least`` is below a word's similarity to itself, so this drops nothing too early.
        near = value >= LEAST * np.sqrt(least[row] * self.own[mark])
        row, mark, value = row[near], mark[near], value[near]
        involved, back = np.unique(row, return_inverse=True)
        begin = first[involved]
        matrix, sizes, _ = _pieces(flat, begin, begin + size[involved])
        own = _self_similarity(matrix, sizes)
        alike = value / np.sqrt(own[back] * self.own[mark])
        near = alike >= LEAST
        row, mark, alike = word[row[near]], mark[near], np.minimum(alike[near], 1.0) ** 3
        cell = row * len(self.words) + mark
        order = np.lexsort((-alike, cell))
        cell, alike = cell[order], alike[order]
        best = np.flatnonzero(np.diff(cell, prepend=-1))
        return cell[best] // len(self.words), cell[best] % len(self.words), alike[best]


def encode(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = [w.encode() for w in words]
    ends = np.cumsum([len(w) for w in raw], dtype=np.int64)
    return np.frombuffer(b"".join(raw), np.uint8), ends - [len(w) for w in raw], ends


def _part_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of each label that hold a word with each beginning of 4 to ``PART`` bytes."""
    for batch in batches:
        for part in arrays.blocks(batch, "text"):
            tokens = Tokens(*arrays.utf8(part.column("text")))
            label = part.column("label").to_numpy()
            data, n_docs = tokens.data, tokens.n_docs
            starts_char = np.append((data & 0xC0) != 0x80, True)
            begin, size, doc = [], [], []
            length = tokens.end - tokens.start
            for k in range(4, PART + 1):
                own = np.flatnonzero(length >= k)
                own = own[starts_char[tokens.start[own] + k]]
                begin.append(tokens.start[own])
                size.append(np.full(len(own), k))
                doc.append(tokens.doc[own])
            begin, size, doc = map(np.concatenate, (begin, size, doc))
            if not len(begin):
                continue
            name = arrays.hashes(data, begin, begin + size)
            _, at, place = np.unique(name, return_index=True, return_inverse=True)
            pair = np.unique(place.astype(np.int64) * n_docs + doc)
            toxic = np.bincount(pair // n_docs, label[pair % n_docs] == 1, len(at)).astype(np.int64)
            total = np.bincount(pair // n_docs, minlength=len(at)).astype(np.int64)
            texts = [data[b : b + k].tobytes().decode("utf-8", "replace")
                     for b, k in zip(begin[at].tolist(), size[at].tolist(), strict=True)]
            yield pa.RecordBatch.from_pydict({
                "part": pa.array(texts, pa.string()), "toxic": toxic, "clean": total - toxic})


def choose_landmarks(sample: DataFrame, n: int = LANDMARKS, plain: int = PLAIN_LANDMARKS):
    """Word beginnings that toxic documents hold far more often, none near another, and common ones."""
    counts = (
        sample.mapInArrow(_part_counts, "part string, toxic bigint, clean bigint")
        .groupBy("part")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    )
    told = F.col("toxic") * F.log((F.col("toxic") + 0.5) / (F.col("clean") + 0.5))
    clear = (F.col("toxic") >= 3) & (F.col("toxic") >= 8 * F.col("clean"))
    # Beginnings of one insult tell as much as it does; the longest of them comes first.
    best = counts.where(clear).orderBy(
        F.desc(F.round(told, 6)), F.desc(F.length("part")), "part").limit(12 * n)
    usual = counts.where(F.col("clean") > 8 * F.col("toxic")).orderBy(F.desc("clean"), "part")
    wanted = [[r["part"] for r in best.collect()], [r["part"] for r in usual.limit(plain).collect()]]
    chosen: list[str] = []
    for words, most in zip(wanted, (n, n + plain), strict=True):
        for w in words:
            if len(chosen) >= most:
                break
            if any(w.startswith(c) or c.startswith(w) for c in chosen):
                continue
            if chosen:
                _, _, alike = Landmarks.of(chosen).similarities(*encode([w]))
                if len(alike) and alike.max() > 0.5:
                    continue
            chosen.append(w)
    return chosen


@dataclass
class Machine:
    """``value`` of each landmark's kernel for a sentence, ``bias``, and the curve."""

    words: list[str]
    value: np.ndarray
    bias: float
    slope: float
    offset: float


def _sentence_sums(tokens: Tokens, marks: Landmarks):
    """Per sentence with any similar word: its text and its kernels with all landmarks."""
    at, place = tokens.distinct()
    word, mark, alike = marks.similarities(tokens.data, tokens.start[at], tokens.end[at])
    table_at = np.searchsorted(word, np.arange(len(at) + 1))
    token = tokens.once(np.flatnonzero(np.diff(table_at)[place] > 0), place)
    n = np.diff(table_at)[place[token]]
    pick = np.arange(n.sum()) + np.repeat(table_at[place[token]] - (np.cumsum(n) - n), n)
    width = int(tokens.sentence.max()) + 2 if len(tokens.sentence) else 1
    key = tokens.doc[token] * width + tokens.sentence[token]
    keys, back = np.unique(key, return_inverse=True)
    sums = np.zeros((len(keys), len(marks.words)))
    np.add.at(sums, (np.repeat(back, n), mark[pick]), alike[pick])
    return keys // width, sums


def train(
    docs: DataFrame, labels: DataFrame, docs_per_class: int = 2500, seed_rounds: int = 4
) -> Machine | None:
    """Learns from ``docs`` (doc_id, text) and ``labels`` (doc_id, label 0 or 1).

    None without rows of both labels. A document that has several labels teaches each of them.
    """
    drawn = labelled_sample(docs, labels, docs_per_class, "toxic")
    if drawn is None:
        return None
    labelled, sizes = drawn
    sample = keep(labelled.select(F.lower("text").alias("text"), "label"), "labelled")
    words = choose_landmarks(sample)
    if not words:
        return None

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marks = Landmarks.of(words)
        for batch in batches:
            for part in arrays.blocks(batch, "text"):
                doc, sums = _sentence_sums(Tokens(*arrays.utf8(part.column("text"))), marks)
                first = np.searchsorted(doc, np.arange(part.num_rows + 1))
                out = []
                for i in range(part.num_rows):
                    own = sums[first[i] : first[i + 1]]
                    own = own[np.argsort(-(own**2).sum(1), kind="stable")[:SENTENCES]]
                    out.append(own.astype(np.float32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("label"), pa.array(out, pa.binary())], ["label", "x"])

    rows = sample.mapInArrow(features, "label int, x binary").orderBy("label", "x").collect()
    label = np.array([r["label"] for r in rows])
    if len(set(label.tolist())) < 2:
        return None
    # Each document also has an empty sentence.
    bags = [np.concatenate([np.frombuffer(r["x"], np.float32).reshape(-1, len(words)),
                            np.zeros((1, len(words)))]) for r in rows]
    first = np.cumsum([0, *map(len, bags)])
    x = np.concatenate(bags)
    marks = Landmarks.of(words)
    between = np.zeros((len(words), len(words)))
    between[tuple(marks.similarities(*encode(words))[:2])] = marks.similarities(*encode(words))[2]
    values, vectors = np.linalg.eigh((between + between.T) / 2 + 1e-6 * np.eye(len(words)))
    root = vectors / np.sqrt(np.maximum(values, 1e-3)) @ vectors.T
    z = np.append(x @ root, np.ones((len(x), 1)), 1)
    owner = np.repeat(np.arange(len(rows)), np.diff(first))
    margin = x.sum(1)
    w = np.zeros(z.shape[1])
    for _ in range(seed_rounds):
        order = np.lexsort((-margin, owner))
        witness = order[first[:-1]]
        use = np.concatenate([witness[label == 1], np.flatnonzero(label[owner] == 0)])
        y = np.where(label[owner[use]] == 1, 1.0, -1.0)
        cost = np.where(y > 0, (y < 0).sum() / max(1, (y > 0).sum()), 1.0)
        w = _squared_hinge(z[use], y, cost)
        margin = z @ w
    worst = np.maximum.reduceat(margin, first[:-1])
    slope, offset = logistic_curve(worst, label.astype(float))
    taken = {c: min(1.0, docs_per_class / sizes[c]) for c in (0, 1)}
    offset += float(np.log(taken[0] / taken[1]))
    return Machine(words, root @ w[:-1], float(w[-1]), slope, offset)


def _squared_hinge(z: np.ndarray, y: np.ndarray, cost: np.ndarray, penalty: float = 1e-3):
    """The linear machine, by Newton steps over the rows inside the margin."""
    w = np.zeros(z.shape[1])
    ridge = penalty * cost.sum() * np.eye(z.shape[1])
    ridge[-1, -1] = 1e-6
    for _ in range(30):
        inside = y * (z @ w) < 1
        a, c = z[inside], cost[inside][:, None]
        new = np.linalg.solve((a * c).T @ a + ridge, (a * c).T @ y[inside])
        if np.allclose(new, w, rtol=1e-8, atol=1e-10):
            break
        w = new
    return w


class ToldWords:
    """What the machine says to each word, kept for a task's next blocks; begun anew at ``KNOWN_WORDS``."""

    def __init__(self, machine: Machine):
        self.marks, self.value = Landmarks.of(machine.words), machine.value
        self.hash, self.told = np.zeros(0, np.uint64), np.zeros(0)

    def of(self, tokens: Tokens, at: np.ndarray) -> np.ndarray:
        """For the tokens ``at``, one a word and in the order of their hashes."""
        name = tokens.hash[at]
        place = np.minimum(np.searchsorted(self.hash, name), max(len(self.hash) - 1, 0))
        known = self.hash[place] == name if len(self.hash) else np.zeros(len(name), bool)
        told = np.zeros(len(name))
        told[known] = self.told[place[known]]
        new = np.flatnonzero(~known)
        word, mark, alike = self.marks.similarities(tokens.data, tokens.start[at[new]], tokens.end[at[new]])
        told[new] = np.bincount(word, alike * self.value[mark], len(new))
        if len(self.hash) + len(new) > KNOWN_WORDS:
            self.hash, self.told = name, told
        else:
            self.hash = np.concatenate([self.hash, name[new]])
            self.told = np.concatenate([self.told, told[new]])
            order = np.argsort(self.hash, kind="stable")
            self.hash, self.told = self.hash[order], self.told[order]
        return told


def score(docs: DataFrame, machine: Machine | None, keys: list[str]) -> DataFrame:
    """``keys`` and ``score`` of every row; one map over the texts."""
    model = None if machine is None else vars(machine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = None if model is None else Machine(**model)
        words = None if machine is None else ToldWords(machine)
        for batch in batches:
            for part in arrays.blocks(batch, "_acct_text", 2 * arrays.BLOCK):
                scores = np.zeros(part.num_rows)
                if machine is not None:
                    tokens = Tokens(*arrays.utf8(part.column("_acct_text")))
                    worst = np.full(part.num_rows, machine.bias)
                    at, place = tokens.distinct()
                    each = words.of(tokens, at)[place]
                    hit = tokens.once(np.flatnonzero(each), place)
                    if len(hit):
                        doc, sentence = tokens.doc[hit], tokens.sentence[hit]
                        new = (np.diff(doc, prepend=-1) != 0) | (np.diff(sentence, prepend=-1) != 0)
                        begin = np.flatnonzero(new)
                        sums = np.add.reduceat(each[hit], begin) + machine.bias
                        np.maximum.at(worst, doc[begin], sums)
                    odds = np.clip(machine.slope * worst + machine.offset, -30, 30)
                    scores = 1 / (1 + np.exp(-odds))
                yield pa.RecordBatch.from_arrays(
                    [part.column(k) for k in keys] + [pa.array(scores)], [*keys, "score"])

    given = docs.select(*keys, F.coalesce(F.lower("text"), F.lit("")).alias("_acct_text"))
    kinds = ", ".join(f"{k} {given.schema[k].dataType.simpleString()}" for k in keys)
    return given.mapInArrow(run, f"{kinds}, score double")
