"""Quality rules: exact counts on whole texts, and a calibrated hashed n-gram model scored against a fixed threshold.

The model is a logistic regression on word uni- and bigrams and windows of four bytes, trained on a bounded sample of
labelled quality rows (``SAMPLE``, about); a fifth of the sample is left out of training and fixes the two parameters of
the probability scale (Platt's). A document is kept if it passes the base rules and its probability reaches
``THRESHOLD``. Defined cases: null, empty and white-space texts have no words, all counts 0 (``n_symbols`` counts any
text) and fail the base rule; repeated documents get equal rows; without labels of both classes the model keeps all that
passes the base rules; a null doc_id is judged like any; texts of any length are whole blocks of their own, so memory
follows the longest text by a small factor; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import kernel, linear
from weftgraph.llm.common import share

SAMPLE = 20_000
MIN_WORDS = 50
MAX_REPEATED = 50  # per cent of the words
THRESHOLD = 0.5

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, probability double"


@dataclass
class Model:
    weights: np.ndarray
    slope: float
    offset: float
    trained: bool


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> Model:
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    sample = linear.bounded_sample(documents, labels, F.lit(True), rows, 23)
    left_out = share(F.col("doc_id"), 29) < 0.2
    weights = linear.train(sample.where(~left_out), linear.word_char_features)
    found = _decisions(sample.where(left_out), weights).toArrow()
    decision, label = (found.column(c).to_numpy() for c in ("decision", "label"))
    slope, offset = _platt(decision, label)
    return Model(weights.astype(np.float32), slope, offset, len(np.unique(label)) == 2)


def _decisions(sample: DataFrame, weights: np.ndarray) -> DataFrame:
    weights = sample.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                value = linear.decision(linear.word_char_features(data, offsets), weights.value)
                yield pa.RecordBatch.from_arrays([pa.array(value), batch.column("label").slice(first, last - first)], ["decision", "label"])

    return sample.select("text", "label").mapInArrow(kernel.frugal(run), "decision double, label double")


def _platt(decision: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with Platt's softened targets."""
    if len(decision) == 0 or label.min() == label.max():
        return 1.0, 0.0
    ones = label.sum()
    target = np.where(label > 0.5, (ones + 1) / (ones + 2), 1 / (len(label) - ones + 2))
    x = np.stack([decision, np.ones_like(decision)], 1)
    w = np.array([1.0, 0.0])
    for _ in range(50):
        p = linear.sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target) + 1e-6 * (w - [1, 0]))
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(w[0]), float(w[1])


def per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    total = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
    return total[offsets[1:]] - total[offsets[:-1]]


def metrics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """The base counts of each text of a block."""
    starts, ends, counts = kernel.spans(data, offsets)
    ink = ~kernel.SPACE[data]
    owner = np.repeat(np.arange(len(counts)), counts)
    # windows of three words that stand twice or more in one text
    windows, ok = kernel.ngrams(kernel.hashes(data, starts, ends), 3), kernel.inside(counts, 3)
    at = np.flatnonzero(ok)
    key = kernel.mix(windows[at] + kernel.mix(owner[at].astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(at), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    covered = np.zeros(len(starts) + 1, bool)
    for k in range(3):
        covered[at[twice] + k] = True
    word_starts = np.concatenate(([0], np.cumsum(counts)))
    # lines with a word that equal an earlier one of the same text
    edge = np.zeros(len(data) + 1, bool)
    newline = np.flatnonzero(data == 10)
    edge[offsets] = True
    edge[newline + 1] = True
    line_starts = np.flatnonzero(edge[:-1])
    line_ends = np.append(line_starts[1:], len(data))[: len(line_starts)]
    line_ends = line_ends - ((line_ends > line_starts) & (data[np.maximum(line_ends - 1, 0)] == 10) if len(data) else 0)
    n_ink = np.concatenate(([0], np.cumsum(ink, dtype=np.int64)))
    worded = n_ink[line_ends] > n_ink[line_starts]
    line_starts, line_ends = line_starts[worded], line_ends[worded]
    line_owner = np.searchsorted(offsets, line_starts, "right") - 1
    lines = kernel.mix(kernel.hashes(data, line_starts, line_ends) + kernel.mix(line_owner.astype(np.uint64) + np.uint64(1)))
    _, first = np.unique(lines, return_index=True)
    dup = np.ones(len(lines), np.int64)
    dup[first] = 0
    return {
        "n_words": counts,
        "word_chars": per_text(ink & ((data & 0xC0) != 0x80), offsets),
        "n_symbols": per_text(_SYMBOL[data], offsets),
        "n_dup_lines": np.bincount(line_owner, dup, len(counts)).astype(np.int64),
        "n_repeat_words": per_text(covered[:-1], word_starts),
    }


def _verdicts(model: Model, data: np.ndarray, offsets: np.ndarray, threshold: float) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Of each text of a block: the counts, whether the base rules fail, whether it is kept, and its probability."""
    counts = metrics(data, offsets)
    failed = (counts["n_words"] < MIN_WORDS) | (100 * counts["n_repeat_words"] > MAX_REPEATED * counts["n_words"])
    p = linear.sigmoid(model.slope * linear.decision(linear.word_char_features(data, offsets), model.weights) + model.offset)
    return counts, failed, ~failed & ((p >= threshold) | (not model.trained)), p


def apply(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The counts and the verdict of every document; the model has a fixed size, so it travels by broadcast."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                counts, failed, kept, p = _verdicts(shared.value, data, offsets, threshold)
                columns = [batch.column("doc_id").slice(first, last - first), *map(pa.array, counts.values()), pa.array(failed), pa.array(kept), pa.array(p)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", *counts, "base_failed", "kept", "probability"])

    return documents.select("doc_id", "text").mapInArrow(kernel.frugal(run), SCHEMA)


def passing(documents: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that are kept, with all their columns; no join and no shuffle."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                yield batch.slice(first, last - first).filter(pa.array(_verdicts(shared.value, data, offsets, threshold)[2]))

    return documents.mapInArrow(kernel.frugal(run), documents.schema)


def judge(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return apply(documents, fit(documents, labels))
