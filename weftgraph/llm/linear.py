"""Logistic regression on hashed n-grams: follow-the-regularised-leader updates, scored as sparse dot products.

A featuriser turns a block of whole texts into families of hashed features; a text's vector holds, for each family,
the share of its n-grams that fall on each index, so a score is a sum of mean weights. Training is bulk-synchronous:
each shard of a bounded sample runs the per-coordinate updates in order from a common state, and the states are averaged
by index between rounds. The state has ``DIMENSIONS`` entries whatever the input.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import kernel
from weftgraph.llm.common import discard, materialise, share

DIMENSIONS = 1 << 18
#: Feature families of a block: for each, the hashed index of every n-gram and the number of n-grams of each text.
Families = list[tuple[np.ndarray, np.ndarray]]
Featuriser = Callable[[np.ndarray, np.ndarray], Families]


def index(hashes: np.ndarray, family: int) -> np.ndarray:
    return ((hashes ^ np.uint64(family * 0x9E3779B97F4A7C15 & kernel._MASK)) * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(46)).astype(np.int32)


def grams(words: np.ndarray, counts: np.ndarray, n: int, family: int) -> tuple[np.ndarray, np.ndarray]:
    ok = kernel.inside(counts, n)
    return index(kernel.ngrams(words, n)[ok] if n > 1 else words, family), np.maximum(counts - (n - 1), 0)


def _classes() -> np.ndarray:
    """Of each byte: 0 white space, 1 letter, digit or part of a longer character, 2 other."""
    out = np.full(256, 2, np.uint8)
    out[kernel.SPACE] = 0
    for a, b in ((48, 58), (65, 91), (97, 123), (128, 256)):
        out[a:b] = 1
    return out


_CLASS = _classes()


def token_features(data: np.ndarray, offsets: np.ndarray) -> Families:
    """Uni- and bigrams of word and symbol runs, and trigrams of their shapes (repeat, capitals, title, lower, symbol)."""
    kind = _CLASS[data]
    n = len(data)
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    edge[1:n] |= kind[1:] != kind[:-1]
    if not n:
        empty = np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        return [empty, empty, empty]
    cuts = np.flatnonzero(edge[: n + 1])
    starts, ends = cuts[:-1], cuts[1:]
    ink = kind[starts] > 0
    starts, ends = starts[ink], ends[ink]
    counts = np.diff(np.searchsorted(starts, offsets))
    words = kernel.hashes(data, starts, ends)
    wordy = kind[starts] == 1
    lower = np.concatenate(([0], np.cumsum((data >= 97) & (data < 123) | (data >= 128), dtype=np.int32)))
    upper = np.concatenate(([0], np.cumsum((data >= 65) & (data < 91), dtype=np.int32)))
    n_lower, n_upper = lower[ends] - lower[starts], upper[ends] - upper[starts]
    shape = np.where(n_lower == 0, np.where(n_upper > 0, 1, 2), np.where(n_upper > 0, 3, 4)).astype(np.uint64)
    again = np.zeros(len(words), bool)
    again[1:] = words[1:] == words[:-1]
    again[2:] |= words[2:] == words[:-2]
    shape[again & wordy] = 5
    shape = np.where(wordy, kernel.mix(shape + np.uint64(11)), words)
    words = np.where(again & wordy, np.uint64(5), words)
    return [grams(words, counts, 1, 1), grams(words, counts, 2, 2), grams(shape, counts, 3, 3)]


def word_char_features(data: np.ndarray, offsets: np.ndarray) -> Families:
    """Uni- and bigrams of words, and windows of four bytes."""
    starts, ends, counts = kernel.spans(data, offsets)
    words = kernel.hashes(data, starts, ends)
    size = np.diff(offsets)
    wide = np.zeros(0, np.uint64)
    if len(data) >= 4:
        wide = data[:-3].astype(np.uint64)
        for k in (1, 2, 3):
            wide |= data[k : len(data) - 3 + k].astype(np.uint64) << np.uint64(8 * k)
        wide = wide[kernel.inside(size, 4)] * np.uint64(0x9E3779B97F4A7C15)
    return [grams(words, counts, 1, 4), grams(words, counts, 2, 5), (index(wide, 6), np.maximum(size - 3, 0))]


def dot(families: Families, weights: np.ndarray) -> np.ndarray:
    """Of each text, the sum over families of the mean weight of its n-grams."""
    out = np.zeros(len(families[0][1]))
    for idx, counts in families:
        total = np.concatenate(([0.0], np.cumsum(weights[idx])))
        ends = np.cumsum(counts)
        out += (total[ends] - total[ends - counts]) / np.maximum(counts, 1)
    return out


def vectors(families: Families) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Of each text: its distinct indices and their values."""
    ends = [np.cumsum(c) for _, c in families]
    for i in range(len(families[0][1])):
        idx = [f[0][e[i] - f[1][i] : e[i]] for f, e in zip(families, ends)]
        value = np.concatenate([np.full(len(x), 1.0 / max(len(x), 1)) for x in idx])
        unique, where = np.unique(np.concatenate(idx), return_inverse=True)
        yield unique, np.bincount(where, value, len(unique))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40, 40)))


def ftrl_pass(rows: list[tuple[np.ndarray, np.ndarray, float]], z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> None:
    """One ordered pass of FTRL-proximal updates in place; the last entry of the state is the intercept."""
    for idx, value, label in rows:
        zi, ni = z[idx], n[idx]
        w = np.where(np.abs(zi) <= l1, 0.0, -(zi - np.sign(zi) * l1) / ((beta + np.sqrt(ni)) / alpha + l2))
        g = (sigmoid(w @ value) - label) * value
        sigma = (np.sqrt(ni + g * g) - np.sqrt(ni)) / alpha
        z[idx] += g - sigma * w
        n[idx] += g * g


def weights_of(z: np.ndarray, n: np.ndarray, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def bounded_sample(documents: DataFrame, labels: DataFrame, usable: Column, rows: int, seed: int) -> DataFrame:
    """About ``rows`` labelled documents (all of them, if fewer): (doc_id, text, label), chosen by a hash of doc_id.

    A document labelled several times takes the smallest label. The chosen ids are at most about ``rows``, so that they
    are sent to the documents rather than the documents to them.
    """
    wanted = labels.where(F.col("label").isNotNull() & F.col("doc_id").isNotNull() & usable).groupBy("doc_id").agg(F.min("label").cast("double").alias("label"))
    total = wanted.count()
    chosen = wanted.where(share(F.col("doc_id"), seed) < min(1.0, rows / max(total, 1)))
    return documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def train(sample: DataFrame, featurise: Featuriser, *, shards: int = 8, rounds: int = 3, updates: int = 60_000, alpha: float = 0.5, beta: float = 1.0, l1: float = 0.002, l2: float = 0.1) -> np.ndarray:
    """Weights (the intercept last) from a bounded sample (doc_id, text, label)."""
    spark = sample.sparkSession
    sample = materialise(sample.repartition(shards, F.xxhash64("doc_id")).sortWithinPartitions(F.xxhash64("doc_id", F.lit(7)), "text"))
    z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
    passes = min(40, max(2, updates // (rounds * max(sample.count(), 1))))  # small samples are gone through more often
    for _ in range(rounds):
        state = spark.sparkContext.broadcast((z, n))

        def local(batches: Iterator[pa.RecordBatch], state=state) -> Iterator[pa.RecordBatch]:
            z, n = (x.copy() for x in state.value)
            rows = []
            for batch in batches:
                labels = batch.column("label").to_numpy(zero_copy_only=False)
                for first, _, data, offsets in kernel.blocks(batch.column("text")):
                    for i, (idx, value) in enumerate(vectors(featurise(data, offsets))):
                        rows.append((np.append(idx, DIMENSIONS), np.append(value, 1.0), labels[first + i]))
            if rows:
                for _ in range(passes):
                    ftrl_pass(rows, z, n, alpha, beta, l1, l2)
                touched = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(touched.astype(np.int32)), pa.array(z[touched]), pa.array(n[touched])], ["i", "z", "n"])

        # averaged by index over the shards that met it; an index that only some met keeps what those found
        merged = sample.mapInArrow(kernel.frugal(local), "i int, z double, n double").groupBy("i").agg(F.avg("z").alias("z"), F.avg("n").alias("n")).toArrow()
        state.destroy()
        i = merged.column("i").to_numpy()
        z, n = np.zeros(DIMENSIONS + 1), np.zeros(DIMENSIONS + 1)
        z[i], n[i] = merged.column("z").to_numpy(), merged.column("n").to_numpy()
        del merged
    discard(sample)
    return weights_of(z, n, alpha, beta, l1, l2)


def decision(families: Families, weights: np.ndarray) -> np.ndarray:
    return dot(families, weights[:-1]) + weights[-1]
