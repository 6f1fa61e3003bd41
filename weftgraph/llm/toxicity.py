"""Toxicity: a support vector machine on a subsequence string kernel with Nyström landmarks, trained on labelled sentences.

The kernel compares two spans of text by the subsequences of three and four characters that they share, each weighted by
``DECAY`` to the power of the stretch it takes up (at most ``REACH`` characters), so that inserted characters and gaps cost
little. A span is a word in lower case between marks of its start and end; letters that stand alone in a row ("i d i o t")
are one span, and spans over ``WIDE`` characters are cut into overlapping windows. A sentence's decision is that of its
most toxic span, a text's that of its most toxic sentence.

Labels are those of whole texts, so training is multiple-instance: all sentences of a clean text are clean; of a toxic
one, the worst sentence is toxic, and so are others that the machine calls toxic by now. Each round finds those sentences
and makes a Newton step for the squared hinge loss in the space that the landmarks span; sentences also train with
characters put into their worst word. Landmarks are words that toxic texts hold more often than clean ones, chosen so that
they are unlike each other, and common words of clean texts. The kernel has explicit (hashed) coordinates, so the whole
machine folds into one vector of them and scoring is a sparse dot product.

The machine is fitted on a bounded sample of labelled texts outside the held-out fold (``TOXIC`` and ``CLEAN`` at most,
about, chosen by a hash; equal texts once); every document is scored on its whole text.

Defined cases: null and empty texts, and texts of white space, have no span and score 0.0; without a toxic label every
other text scores 0.0, without a clean one 1.0; a text labelled several times is toxic if one label says so; a null doc_id
counts as held out by no fold and its label is not used; repeated documents score alike; texts over ``LONG`` characters are
read in pieces, cut at white space where there is some; other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import kernel
from weftgraph.llm.common import discard, materialise, share
from weftgraph.llm.quality_rules import _platt

#: Labelled texts that the machine is fitted on at most (about), by label.
TOXIC, CLEAN = 3000, 5000
#: Landmarks: words of toxic texts, and of clean ones.
LANDMARKS, COMMON, CANDIDATES = 224, 96, 1200
#: So many of the first landmarks are landmarks in their altered forms, too.
GAPPED = 30
BITS, WIDE, LONG = 18, 24, 1 << 20
REACH, DECAY = 5, 0.7
ROUNDS, SHARDS, RIDGE, MADE = 6, 8, 2e-4, 0.7
#: The decision from which further sentences of a toxic text count as toxic.
SURE = 0.5
BLOCK = 1 << 18
MEMO = 1 << 18

_SPACE = re.compile(r"[\x20\x09-\x0D]")
#: Which characters of a stretch a subsequence takes, the first one apart.
_TAKEN = [rest for p in (3, 4) for rest in combinations(range(1, REACH), p - 1)]
_WEIGHT = DECAY ** np.arange(8)
_P = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Spans:
    """The spans of a block of texts: their characters, where they lie, and the text and sentence of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # whether a window starts, and ends, where its word does
    last: np.ndarray
    text: np.ndarray
    sentence: np.ndarray
    keys: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        up, down = kernel.tables(len(self.data) + 1)
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * up[: len(self.data)], dtype=np.uint64)))
        marks = self.first + np.uint64(2) * self.last + np.uint64(4) * (self.ends - self.starts).astype(np.uint64)
        self.keys = kernel.mix((total[self.ends] - total[self.starts]) * down[self.starts] + marks * np.uint64(0xD6E8FEB86659FD93))

    def words(self, which: np.ndarray) -> list[str]:
        return [("\x01" if self.first[i] else "\x03") + self.data[self.starts[i] : self.ends[i]].tobytes().decode("utf-32-le", "replace") + ("\x02" if self.last[i] else "\x04") for i in which.tolist()]


def spans(texts: list[str]) -> Spans:
    lower = [t.lower() for t in texts]
    data = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    offsets = np.concatenate(([0], np.cumsum([len(t) for t in lower], dtype=np.int64)))
    space = (data == 32) | (data >= 9) & (data <= 13)
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    ink = ~space
    starts, ends = ink.copy(), ink.copy()
    starts[1:] &= space[:-1] | edge[1:-1]
    ends[:-1] &= space[1:] | edge[1:-1]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, starts, "right") - 1
    lines = np.concatenate(([0], np.cumsum(data == 10)))
    if len(starts):
        # letters that stand alone, three or more in a row
        alone = ends - starts == 1
        bound = alone[1:] & alone[:-1] & (text[1:] == text[:-1]) & (starts[1:] - ends[:-1] == 1) & (lines[starts[1:]] == lines[ends[:-1]])
        run = np.concatenate(([0], np.cumsum(~bound)))
        bound &= np.bincount(run)[run[1:]] >= 3
        head, tail = np.concatenate(([True], ~bound)), np.concatenate((~bound, [True]))
        starts, ends, text = starts[head], ends[tail], text[head]
        stop = np.isin(data[ends - 1], (33, 46, 63))
        new = (text[1:] != text[:-1]) | stop[:-1] | (lines[starts[1:]] != lines[ends[:-1]])
        sentence = np.concatenate(([0], np.cumsum(new)))
    else:
        sentence = text
    size = ends - starts
    windows = np.where(size > WIDE, -(-(size - WIDE) // (WIDE // 2)) + 1, 1)
    of = np.repeat(np.arange(len(starts)), windows)
    number = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    at = starts[of] + number * (WIDE // 2)
    to = np.minimum(at + WIDE, ends[of])
    return Spans(data, at, to, number == 0, to == ends[of], text[of], sentence[of])


@dataclass
class Features:
    """Subsequences of distinct spans: index, weight and span of each, and the length of each span's vector."""

    index: np.ndarray
    value: np.ndarray
    span: np.ndarray
    norm: np.ndarray


def _features(flat: np.ndarray, size: np.ndarray) -> Features:
    """Of spans whose characters (marks included) stand one after the other."""
    n = len(size)
    owner = np.repeat(np.arange(n), size)
    rest = np.repeat(np.cumsum(size), size) - np.arange(len(flat))
    code = np.concatenate((kernel.mix(flat.astype(np.uint64) * _P), np.zeros(REACH, np.uint64)))
    keys = []
    for taken in _TAKEN:
        at = np.flatnonzero(rest > taken[-1])
        h = code[at]
        for o in taken:
            h = h * _P + code[at + o]
        h = kernel.mix(h + np.uint64(len(taken))) >> np.uint64(64 - BITS)
        keys.append((owner[at] << (BITS + 3)) | (h.astype(np.int64) << 3) | (taken[-1] + 1))
    keys = np.sort(np.concatenate(keys))
    both = keys >> 3
    begin = np.flatnonzero(np.concatenate(([True], both[1:] != both[:-1]))) if len(keys) else np.zeros(0, np.int64)
    value = np.add.reduceat(_WEIGHT[keys & 7], begin) if len(keys) else np.zeros(0)
    span = both[begin] >> BITS
    return Features(both[begin] & ((1 << BITS) - 1), value, span, np.sqrt(np.bincount(span, value * value, n)) + 1e-12)


def features(found: Spans, which: np.ndarray) -> Features:
    """Of the spans with these places."""
    size = found.ends[which] - found.starts[which] + 2
    total = int(size.sum())
    begin = np.cumsum(size) - size
    within = np.arange(total) - np.repeat(begin, size)
    flat = found.data[np.clip(np.repeat(found.starts[which] - 1, size) + within, 0, max(len(found.data) - 1, 0))].astype(np.int64)
    flat[begin] = np.where(found.first[which], 1, 3)
    flat[begin + size - 1] = np.where(found.last[which], 2, 4)
    return _features(flat, size)


def features_of(words: list[str]) -> Features:
    """Of words with their marks, as ``Spans.words`` gives them."""
    flat = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    return _features(flat, np.array([len(w) for w in words], np.int64))


def project(x: Features, weights: np.ndarray) -> np.ndarray:
    """Of each span, the dot product of its vector (of length 1) with the weights."""
    return np.bincount(x.span, x.value * weights[x.index], len(x.norm)) / x.norm


@dataclass
class Landmarks:
    """Landmark words, their vectors in the columns that they use, and the map into the space that they span."""

    columns: np.ndarray
    matrix: np.ndarray
    root: np.ndarray

    @staticmethod
    def of(words: list[str]) -> Landmarks:
        x = features_of(words)
        columns = np.unique(x.index)
        matrix = np.zeros((len(columns), len(words)))
        matrix[np.searchsorted(columns, x.index), x.span] = x.value / x.norm[x.span]
        value, vector = np.linalg.eigh(matrix.T @ matrix)
        return Landmarks(columns, matrix, vector * np.where(value > 1e-6, 1 / np.sqrt(np.maximum(value, 1e-6)), 0) @ vector.T)

    def map(self, x: Features) -> np.ndarray:
        """The coordinates of spans, a row each, a last one of 1 for the intercept."""
        at = np.minimum(np.searchsorted(self.columns, x.index), len(self.columns) - 1)
        known = self.columns[at] == x.index
        at, value, span = at[known], (x.value / x.norm[x.span])[known], x.span[known]
        out = np.zeros((len(x.norm), self.matrix.shape[1]))
        for i in range(0, len(x.norm), 500):
            a, b = np.searchsorted(span, (i, i + 500))
            if a < b:
                begin = np.flatnonzero(np.concatenate(([True], span[a + 1 : b] != span[a : b - 1])))
                out[span[a + begin]] = np.add.reduceat(self.matrix[at[a:b]] * value[a:b, None], begin, axis=0)
        return np.concatenate((out @ self.root, np.ones((len(out), 1))), 1)

    def fold(self, w: np.ndarray) -> tuple[np.ndarray, float]:
        """The weights of all subsequences, and the intercept, that give a vector's decisions."""
        weights = np.zeros(1 << BITS)
        weights[self.columns] = self.matrix @ (self.root @ w[:-1])
        return weights, float(w[-1])


def pieces(column: pa.Array) -> Iterator[tuple[list[int], list[str]]]:
    """Blocks of (row, piece of its text); null texts give nothing."""
    rows, texts, size = [], [], 0
    for i in range(len(column)):
        text = column[i].as_py() or ""
        at = 0
        while at < len(text):
            to = len(text)
            if to - at > LONG:
                cut = _SPACE.search(text, at + LONG, min(at + 2 * LONG, len(text)))
                to = cut.start() if cut else min(at + 2 * LONG, len(text))
            rows.append(i)
            texts.append(text[at:to])
            size += to - at
            at = to
            if size >= BLOCK:
                yield rows, texts
                rows, texts, size = [], [], 0
    if rows:
        yield rows, texts


def best(values: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Of each run of equal groups, the place of its largest value (the first one)."""
    if not len(values):
        return np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    top = np.repeat(np.maximum.reduceat(values, begin), np.diff(np.append(begin, len(values))))
    at = np.flatnonzero(values == top)
    return at[np.concatenate(([True], group[at][1:] != group[at][:-1]))]


def altered(words: list[str]) -> list[str]:
    """Each word (with its marks) with characters between its letters, and with one more; which ones, its own hash says."""
    out = []
    for word in words:
        h = hash_of(word)
        inner = word[1:-1]
        if 4 <= len(inner) <= WIDE // 2:
            out.append(word[0] + ".-*_ "[h % 5].join(inner) + word[-1])
            at = 1 + h // 5 % (len(inner) - 1)
            out.append(word[0] + inner[:at] + ".-*_x'0e"[h // 80 % 8] + inner[at:] + word[-1])
    return out


def hash_of(word: str) -> int:
    return int.from_bytes(word.encode("utf-32-le", "surrogatepass")[:64], "little") % 1000003


@dataclass
class Model:
    weights: np.ndarray
    intercept: float
    slope: float = 1.0
    offset: float = 0.0
    constant: float | None = None  # the score of every text, where one class alone was labelled

    def probability(self, decision: np.ndarray) -> np.ndarray:
        return 1.0 / (1.0 + np.exp(-np.clip(self.slope * decision + self.offset, -40, 40)))


class Decisions:
    """Decisions of spans; those of distinct spans are worked out once and kept in a bounded memo."""

    def __init__(self, weights: np.ndarray, intercept: float) -> None:
        self.weights, self.intercept, self.memo = weights, intercept, {}

    def of(self, found: Spans) -> np.ndarray:
        keys, first, back = np.unique(found.keys, return_index=True, return_inverse=True)
        known = [self.memo.get(k) for k in keys.tolist()]
        new = np.array([i for i, x in enumerate(known) if x is None], np.int64)
        values = np.array(known, np.float64)  # None becomes nan
        if len(new):
            values[new] = project(features(found, first[new]), self.weights) + self.intercept
            if len(self.memo) + len(new) > MEMO:
                self.memo.clear()
            self.memo.update(zip(keys[new].tolist(), values[new].tolist()))
        return values[back]


def held_out(key: Column) -> Column:
    """The fold that the machine never learns from: crc32 of the key as text leaves 0 when divided by 5."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def sample(documents: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> tuple[DataFrame, float]:
    """Distinct labelled texts (text, label, fitting), and how much likelier a clean row was to be taken than a toxic one."""
    usable = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    wanted = usable.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("label"))
    counts = {row["label"]: row["n"] for row in wanted.where("label in (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    part = [min(1.0, most / max(counts.get(k, 0), 1)) for k, most in enumerate((clean, toxic))]
    # at most about as many ids as the parameters say
    chosen = wanted.where(share(F.col("doc_id"), 23) < F.when(F.col("label") == 1, part[1]).when(F.col("label") == 0, part[0]))
    found = documents.select("doc_id", "text").where("text is not null").join(F.broadcast(chosen), "doc_id")
    once = found.groupBy(F.sha2(F.col("text").cast("binary"), 256).alias("h")).agg(F.first("text").alias("text"), F.max("label").alias("label"))
    fitting = F.pmod(F.xxhash64("h"), F.lit(5)) != 0
    return materialise(once.select("text", "label", fitting.alias("fitting")).repartition(SHARDS, F.xxhash64("h"))), part[0] / part[1]


def counted(texts: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many toxic and clean texts each span stands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            label = batch.column("label").to_numpy()
            for rows, block in pieces(batch.column("text")):
                found = spans(block)
                _, which = np.unique(found.keys ^ kernel.mix(found.text.astype(np.uint64)), return_index=True)
                yield pa.RecordBatch.from_arrays([pa.array(found.words(which), pa.string()), pa.array(label[np.array(rows)[found.text[which]]] == 1)], ["word", "toxic"])

    marks = texts.select("text", "label").mapInArrow(run, "word string, toxic boolean")
    return marks.groupBy("word").agg(F.count_if("toxic").alias("toxic"), F.count_if(~F.col("toxic")).alias("clean"))


def landmarks(texts: DataFrame, many: int = LANDMARKS, common: int = COMMON, candidates: int = CANDIDATES) -> tuple[list[str], int]:
    """Landmark words, those of toxic texts first, and how many these are.

    Candidates differ most between toxic and clean texts (by the likelihood ratio); they are taken in turn by that ratio
    times what earlier ones leave unexplained of them (a pivoted Cholesky decomposition of the kernel). The first of them
    come with characters put into them, too.
    """
    total = texts.groupBy().agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).first()
    words = materialise(counted(texts))
    p, n = F.col("toxic"), F.col("clean")
    both, every = p + n, float(total["p"] + total["n"])
    term = lambda seen, wanted: F.when(seen > 0, seen * F.log(seen / wanted)).otherwise(0.0)
    ratio = term(p, both * total["p"] / every) + term(n, both * total["n"] / every) + term(total["p"] - p, (every - both) * total["p"] / every) + term(total["n"] - n, (every - both) * total["n"] / every)
    rows = words.where(p * total["n"] > n * total["p"]).select("word", ratio.alias("r")).orderBy(F.desc("r"), "word").limit(candidates).collect()
    often = [row["word"] for row in words.where(n > 0).orderBy(F.desc("clean"), "word").limit(common).collect()]
    discard(words)
    taken: list[int] = []
    if rows:
        names, value = [row["word"] for row in rows], np.maximum([row["r"] for row in rows], 1e-9)
        x = features_of(names)
        left, factors = np.ones(len(names)), np.zeros((len(names), 0))
        while len(taken) < min(many, len(names)):
            i = int((value * left).argmax())
            if left[i] < 0.02:
                break
            one = np.zeros(1 << BITS)
            own = x.span == i
            one[x.index[own]] = x.value[own] / x.norm[i]
            column = (project(x, one) - factors @ factors[i]) / math.sqrt(left[i])
            factors = np.concatenate((factors, column[:, None]), 1)
            left = np.maximum(left - column**2, 0)
            left[i] = 0
            taken.append(i)
        toxic = [names[i] for i in taken]
        toxic += altered(toxic[:GAPPED])
        return toxic + [w for w in often if w not in set(names)], len(toxic)
    return often, 0


def margin_sums(blocks: Iterator[tuple[np.ndarray, Spans]], space: Landmarks, weights: np.ndarray, intercept: float) -> list[np.ndarray]:
    """Of clean and of toxic texts, from blocks (whether each text is toxic, spans): sums over their sentences inside the margin.

    The rows are those of products of coordinates, then the coordinates, then (first entry) how many texts there are.
    """
    width = space.matrix.shape[1] + 1
    decisions = Decisions(weights, intercept)
    sums = [np.zeros((width + 2, width)) for _ in range(2)]

    def add(x: Features, toxic: np.ndarray, weight: float) -> None:
        where = space.map(x)
        for k, total in enumerate(sums):
            own = where[toxic == bool(k)]
            total[:-2] += weight * own.T @ own
            total[-2] += weight * own.sum(0)

    for label, found in blocks:
        value = decisions.of(found)
        worst = best(value, found.sentence)
        toxic, score = label[found.text[worst]], value[worst]
        top = np.zeros(len(worst), bool)
        top[best(score, found.text[worst])] = True
        for k, total in enumerate(sums):
            total[-1, 0] += (top & (toxic == bool(k))).sum()
        inside = np.where(toxic, (score < 1) & (top | (score > SURE)), score > -1)
        if inside.any():
            add(features(found, worst[inside]), toxic[inside], 1.0)
        for k in (False, True):
            made = altered(found.words(worst[top & (toxic == k)]))
            if made:
                x = features_of(made)
                score = project(x, weights) + intercept
                inside = score < 1 if k else score > -1
                if inside.any():
                    chosen = np.flatnonzero(inside)
                    add(features_of([made[i] for i in chosen.tolist()]), np.full(len(chosen), k), MADE)
    return sums


def _round(texts: DataFrame, space: Landmarks, weights: np.ndarray, intercept: float) -> list[np.ndarray]:
    """``margin_sums`` over all shards."""
    shared = texts.sparkSession.sparkContext.broadcast((space, weights, intercept))
    width = space.matrix.shape[1] + 1

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, Spans]]:
        for batch in batches:
            label = batch.column("label").to_numpy() == 1
            for rows, block in pieces(batch.column("text")):
                yield label[rows], spans(block)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in margin_sums(blocks(batches), *shared.value)], pa.binary())], ["sums"])

    # a row of fixed size for each label and shard
    out = [np.zeros((width + 2, width)) for _ in range(2)]
    for i, row in enumerate(texts.select("text", "label").mapInArrow(run, "sums binary").collect()):
        out[i % 2] += np.frombuffer(row["sums"]).reshape(width + 2, width)
    shared.destroy()
    return out


def newton(space: Landmarks, sums: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """The machine that minimises the squared hinge loss of the sentences inside the margin."""
    (g0, r0, n0), (g1, r1, n1) = ((s[:-2], s[-2], max(s[-1, 0], 1.0)) for s in sums)
    ridge = RIDGE * np.eye(len(r0))
    ridge[-1, -1] = 1e-9
    return space.fold(np.linalg.solve(ridge + g0 / n0 + g1 / n1, r1 / n1 - r0 / n0))


def _worst(texts: DataFrame, weights: np.ndarray, intercept: float) -> tuple[np.ndarray, np.ndarray]:
    """Decisions and labels of the texts of the bounded sample."""
    model = Model(weights, intercept)
    rows = _scored(texts.select(F.col("label").cast("long").alias("doc_id"), "text"), model).select("doc_id", "decision").toArrow()
    value = rows.column("decision").to_numpy()
    return value[~np.isnan(value)], rows.column("doc_id").to_numpy()[~np.isnan(value)].astype(float)


def fit(documents: DataFrame, labels: DataFrame, toxic: int = TOXIC, clean: int = CLEAN) -> Model:
    """The machine, from documents (doc_id, text) and labels (doc_id, toxic); held-out rows are left aside."""
    texts, ratio = sample(documents, labels, toxic, clean)
    fitting = texts.where("fitting")
    kinds = {row["label"] for row in fitting.select("label").distinct().collect()}
    nothing = np.zeros(1 << BITS)
    if len(kinds) < 2:
        discard(texts)
        return Model(nothing, 0.0, constant=float(kinds == {1}))
    words, many = landmarks(fitting)
    space = Landmarks.of(words)
    # the first machine tells the landmarks apart
    where = space.map(features_of(words))
    target = np.where(np.arange(len(words)) < many, 1.0, -1.0)
    weights, intercept = space.fold(np.linalg.solve(where.T @ where + 0.1 * np.eye(where.shape[1]), where.T @ target))
    for _ in range(ROUNDS):
        weights, intercept = newton(space, _round(fitting, space, weights, intercept))
    value, label = _worst(texts.where("not fitting"), weights, intercept)
    if len({*label.tolist()}) < 2:
        value, label = _worst(fitting, weights, intercept)
    slope, offset = _platt(value, label)
    discard(texts)
    return Model(weights, intercept, slope, offset + math.log(ratio))


def _scored(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, decision, score, sentences, toxic_sentences) of every document; decision is null without a span."""
    shared = documents.sparkSession.sparkContext.broadcast(Model(model.weights.astype(np.float32), model.intercept, model.slope, model.offset, model.constant))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        decisions = Decisions(model.weights, model.intercept)
        for batch in batches:
            top = np.full(batch.num_rows, -np.inf)
            sentences, toxic = np.zeros(batch.num_rows, np.int64), np.zeros(batch.num_rows, np.int64)
            for rows, block in pieces(batch.column("text")):
                found = spans(block)
                value = decisions.of(found)
                worst = best(value, found.sentence)
                row = np.array(rows, np.int64)[found.text[worst]] if len(worst) else np.zeros(0, np.int64)
                np.maximum.at(top, row, value[worst])
                np.add.at(sentences, row, 1)
                np.add.at(toxic, row, model.probability(value[worst]) >= 0.5)
            some = np.isfinite(top)
            score = np.where(some, model.probability(np.where(some, top, 0)) if model.constant is None else model.constant, 0.0)
            columns = [batch.column("doc_id"), pa.array(top, mask=~some), pa.array(score), pa.array(sentences), pa.array(toxic if model.constant is None else sentences * int(model.constant))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "decision", "score", "sentences", "toxic_sentences"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, decision double, score double, sentences long, toxic_sentences long")


def score(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score, sentences, toxic_sentences) of every document; the machine has a fixed size, so it travels by broadcast."""
    return _scored(documents, model).drop("decision")


def classify(documents: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score(documents, fit(documents, labels))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "sentences", "toxic_sentences")
