"""Language identification by prediction by partial matching: variable-order byte contexts with escape probabilities.

Each language has a tree of contexts of up to ``ORDER`` bytes with the counts of the bytes that followed, gathered once
from a bounded sample of training documents and then frozen. A byte costs the exact length of its code under the tree:
from the longest known context downwards, the byte's share there and the share of an escape (method C: as many escapes
counted as distinct bytes seen) times its chance in the shorter context, down to equal chances for all 256 bytes. A text's
language is the one with the shortest code; its score is that language's share when code lengths are read as likelihoods.

Trees are frozen in Spark, one context length after the other, into rows of bits: of each context and byte seen, and of
each context's escape. What a tree holds is bounded by its language's sample, and no context is dropped. Languages are
taken in groups of ``GROUP``: one group's trees are a few tables in a worker's memory, and a text passes the groups one
after the other, so any number of languages can be told apart. Scoring is one look-up a byte, or one more for each
escape, in numpy.

Defined cases: null texts and texts without a letter are ``und`` with score 0; repeated documents score alike; ties go to
the first language in order of name; training leaves out documents with null text, null language or null doc_id; with no
training document at all every text is ``und``; texts of any length are scored whole, a block of their own; columns of
any name pass through ``passing``; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import kernel
from weftgraph.llm.common import discard, held_out, materialise, share

ORDER = 3
#: Training documents of each language at most (about: chosen by a hash).
SAMPLE = 1500
#: Languages whose sizes are sent to all executors at most.
SENT = 10_000
#: Languages whose trees are in memory together.
GROUP = 16
#: Documents whose code takes so many times the bits a byte that training documents of its language take on average are
#: in none of the languages; the fewest bytes for which that can be told.
STRANGE, STRANGE_BYTES = 1.75, 200


@dataclass
class Trees:
    """The frozen trees of a group of languages; bits have a column for each."""

    languages: list[str]
    symbol: np.ndarray  # byte -> its number; bytes never seen in training share the last
    bits: np.ndarray  # of windows seen: those of 1 byte, then of 2 ... ; the last row is that of a byte never seen
    escape: np.ndarray  # of contexts seen: the bits of an escape; the last row is that of a context never seen
    short: list[np.ndarray]  # for windows of 1, 2 and 3 bytes: row of ``bits``, or -1
    keys: np.ndarray  # open-addressing table of windows of 4 bytes ...
    rows: np.ndarray  # ... and their rows of ``bits``
    context: list[np.ndarray]  # for contexts of 1, 2 and 3 bytes: row of ``escape``
    rate: np.ndarray  # bits a byte that training documents take


def gather(documents: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    """(lang, key, n): counts of four-byte windows over a bounded sample of training documents.

    The first bytes of a text are counted in windows that start with byte 0.
    """
    usable = documents.select("doc_id", "text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    sizes = materialise(usable.groupBy("lang").agg((F.lit(float(per_language)) / F.count("*")).alias("part")))
    chosen = share(F.col("doc_id"), 31) < F.col("part")
    if sizes.count() <= SENT:
        sample = usable.join(F.broadcast(sizes), "lang").where(chosen).select("lang", "text")
    else:  # texts don't meet by language: the chosen ones are found without them
        ids = usable.select("doc_id", "lang").join(sizes, "lang").where(chosen).select("doc_id", "lang").distinct()
        sample = usable.join(ids, ["doc_id", "lang"], "left_semi").select("lang", "text")

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tags = np.array(batch.column("lang").to_pylist())
            for tag in sorted(set(tags.tolist())):
                column = batch.column("text").filter(pa.array(tags == tag))
                for _, _, data, offsets in kernel.blocks(column):
                    key, n = np.unique(window_keys(data, offsets), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array([tag] * len(key)), pa.array(key.astype(np.int64)), pa.array(n)], ["lang", "key", "n"])

    return sample.mapInArrow(kernel.frugal(windows), "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def window_keys(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Of each byte: itself and the three before it in its text (0 before the start) in one number."""
    key = data.astype(np.uint32)
    size = np.diff(offsets)
    into = np.arange(len(data)) - np.repeat(offsets[:-1], size)
    for k in (1, 2, 3):
        shifted = np.zeros(len(data), np.uint32)
        shifted[k:] = data[:-k]
        shifted[into < k] = 0
        key |= shifted << np.uint32(8 * k)
    return key


def frozen(counts: DataFrame) -> DataFrame:
    """(lang, size, key, bits, escape): of each language the windows (of ``size`` bytes) and their bits, and of each context its escape's.

    ``bits`` is null in rows of contexts, ``escape`` in rows of windows; a window's last byte is its key's lowest.
    """
    chance, made = None, []
    for k in range(ORDER + 1):
        mask = (1 << (8 * (k + 1))) - 1
        seen = counts.groupBy("lang", F.col("key").bitwiseAND(F.lit(mask)).alias("key")).agg(F.sum("n").alias("n"))
        seen = seen.withColumn("context", F.shiftright("key", 8))
        every = seen.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.count("*").alias("distinct"))
        seen = seen.join(every, ["lang", "context"])
        if chance is None:
            seen = seen.withColumn("below", F.lit(1 / 256))
        else:
            seen = seen.withColumn("shorter", F.col("key").bitwiseAND(F.lit(mask >> 8))).join(chance.select("lang", F.col("key").alias("shorter"), F.col("p").alias("below")), ["lang", "shorter"])
        # with exclusion of nothing: interpolated escape, so that probabilities stay exact for a frozen tree
        p = (F.col("n") + F.col("distinct") * F.col("below")) / (F.col("total") + F.col("distinct"))
        chance = materialise(seen.select("lang", "key", p.alias("p")))
        none = F.lit(None).cast("double")
        made.append(chance.select("lang", F.lit(k + 1).alias("size"), "key", (-F.log2("p")).alias("bits"), none.alias("escape")))
        escape = -F.log2(F.col("distinct") / (F.col("total") + F.col("distinct")))
        made.append(every.select("lang", F.lit(k).alias("size"), F.col("context").alias("key"), none, escape))
    out = made[0]
    for frame in made[1:]:
        out = out.union(frame)
    return out


def _numbers(keys: np.ndarray, symbol: np.ndarray, size: int, length: int) -> np.ndarray:
    """Windows of ``length`` bytes as numbers of symbols."""
    out = np.zeros(len(keys), np.int64)
    for k in range(length):
        out += symbol[keys >> (8 * k) & 255] * size**k
    return out


def trees_of(languages: list[str], rates: dict[str, float], rows: pa.Table) -> Trees:
    """The tables of a group of languages from the rows of ``frozen``."""
    which = np.searchsorted(languages, np.array(rows.column("lang").to_pylist()))
    length, key = rows.column("size").to_numpy(), rows.column("key").to_numpy().astype(np.int64)
    bits, escape = (rows.column(c).to_numpy().astype(np.float64) for c in ("bits", "escape"))
    window = ~np.isnan(bits)
    seen = np.unique(np.append(key[window & (length == 1)], 0))
    size = len(seen) + 1
    symbol = np.full(256, size - 1, np.int64)
    symbol[seen] = np.arange(len(seen))
    n = len(languages)
    # a language that lacks a context pays nothing for leaving it; one that lacks a byte there pays the escape and goes on
    escapes, context, at = [], [], 0
    for k in range(ORDER + 1):
        mine = ~window & (length == k)
        number, where = np.unique(_numbers(key[mine], symbol, size, k), return_inverse=True)
        table = np.zeros((len(number), n))
        table[where, which[mine]] = escape[mine]
        index = np.full(size**k, -1, np.int32)
        index[number] = at + np.arange(len(number))
        escapes.append(table)
        context.append(index)
        at += len(number)
    escapes = np.concatenate([*escapes, np.zeros((1, n))])
    below = np.full((size, n), 8.0) + escapes[context[0][0]] if len(languages) else np.zeros((size, 0))
    tables, short, at = [], [], 0
    for k in range(1, ORDER + 2):
        mine = window & (length == k)
        number, where = np.unique(_numbers(key[mine], symbol, size, k), return_inverse=True)
        # what a language that lacks the window pays: its escape here, and the shorter window's bits
        if k == 1:
            table = below[number % size].copy()
        else:
            shorter = short[-1][number % size ** (k - 1)]
            table = np.concatenate(tables)[shorter] + escapes[context[k - 1][number // size]]
        table[where, which[mine]] = bits[mine]
        tables.append(table)
        if k <= ORDER:
            index = np.full(size**k, -1, np.int32)
            index[number] = at + np.arange(len(number))
            short.append(index)
        else:
            keys, slots = _open_table(number, at + np.arange(len(number)))
        at += len(number)
    # a byte never seen in training costs an escape from the empty context and one of 256 chances
    table = np.concatenate([*tables, below[-1:]])
    return Trees(languages, symbol.astype(np.int32), table.astype(np.float32), escapes.astype(np.float32), short, keys, slots, context[1:], np.array([rates.get(x, 0.0) for x in languages]))


def _slot(keys: np.ndarray, mask: int) -> np.ndarray:
    return (kernel.mix(keys.astype(np.uint64)) & np.uint64(mask)).astype(np.int64)


def _open_table(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    mask = (1 << max(4, int(4 * len(keys)).bit_length())) - 1
    table, rows = np.full(mask + 1, -1, np.int64), np.full(mask + 1, -1, np.int32)
    slot, left = _slot(keys, mask), np.arange(len(keys))
    while len(left):  # all keys at once; of those that want one free slot the last gets it
        free = left[table[slot[left]] < 0]
        table[slot[free]] = keys[free]
        rows[slot[free]] = values[free]
        left = left[table[slot[left]] != keys[left]]
        slot[left] = (slot[left] + 1) & mask
    return table, rows


def _look_up(trees: Trees, keys: np.ndarray) -> np.ndarray:
    mask = len(trees.keys) - 1
    slot = _slot(keys, mask)
    out, met = trees.rows[slot], trees.keys[slot]
    out = np.where(met == keys, out, -1)
    left = np.flatnonzero((met != keys) & (met >= 0))
    while len(left):
        slot[left] = (slot[left] + 1) & mask
        met = trees.keys[slot[left]]
        hit = met == keys[left]
        out[left[hit]] = trees.rows[slot[left[hit]]]
        left = left[~hit & (met >= 0)]
    return out


def code_lengths(trees: Trees, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of each text of a block under each language of a group."""
    size = len(trees.short[0])
    out = np.zeros((len(offsets) - 1, len(trees.languages)))
    if not len(data):
        return out
    s = trees.symbol[data].astype(np.int64)
    start = int(trees.symbol[0])
    into = np.full(len(data), 3, np.int8)
    firsts = offsets[:-1][np.diff(offsets) > 0]
    for k in (2, 1, 0):
        at = firsts + k
        at = at[at < len(data)]
        into[at] = k
    number = s.copy()
    for k in (1, 2, 3):
        before = np.full(len(data), start, np.int64)
        before[k:] = s[:-k]
        before[into < k] = start
        number += before * size**k
    row = _look_up(trees, number)
    # bytes that were not seen after their three bytes: the escape, and the same one byte shorter
    open_, extra = np.flatnonzero(row < 0), []
    for k in range(ORDER, 0, -1):
        if not len(open_):
            break
        extra.append((open_, trees.context[k - 1][number[open_] // size % size**k]))
        found = trees.short[k - 1][number[open_] % size**k]
        row[open_[found >= 0]] = found[found >= 0]
        open_ = open_[found < 0]
    row[open_] = len(trees.bits) - 1
    owner = [(at, np.searchsorted(offsets, at, "right") - 1) for at, _ in extra]
    for lang in range(len(trees.languages)):
        total = np.concatenate(([0.0], np.cumsum(trees.bits[row, lang], dtype=np.float64)))
        out[:, lang] = total[offsets[1:]] - total[offsets[:-1]]
        for (_, context), (_, text) in zip(extra, owner):
            out[:, lang] += np.bincount(text, trees.escape[context, lang], len(out))
    return out


Model = list[Trees]


def _choices(model: Model, data: np.ndarray, offsets: np.ndarray, letters: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of each text of a block: the number of its language (that after the last for ``und``), its score, bits a byte, and
    those that training documents of its language take."""
    n = len(offsets) - 1
    best, least, rate = np.zeros(n, int), np.full(n, np.inf), np.zeros(n)
    weight = np.zeros(n)  # sum over languages of 2 ** (least - bits)
    before = 0
    for trees in model:
        bits = code_lengths(trees, data, offsets)
        lowest = bits.min(1)
        first = bits.argmin(1)
        better = lowest < least
        new = np.minimum(least, lowest)
        old = np.where(np.isfinite(least), np.exp2(-np.minimum(np.where(np.isfinite(least), least, new) - new, 1000)), 0.0)
        weight = weight * old + np.exp2(-np.minimum(bits - new[:, None], 1000)).sum(1)
        best = np.where(better, before + first, best)
        rate = np.where(better, trees.rate[first], rate)
        least = new
        before += len(trees.languages)
    if not before:
        return best, np.zeros(n), np.zeros(n), rate
    score = np.where(letters, 1 / np.maximum(weight, 1e-300), 0.0)
    return np.where(letters, best, before), score, least / np.maximum(np.diff(offsets), 1), rate


LETTER = r"\p{L}"


def _names(model: Model) -> list[str]:
    return [name for trees in model for name in trees.languages]


def predict(documents: DataFrame, model: Model) -> DataFrame:
    """(doc_id, lang_pred, score, bits_per_byte) of every document."""
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = np.array([*_names(shared.value), "und"], dtype=object)
        for batch in batches:
            letters = batch.column("letters").to_numpy(zero_copy_only=False).astype(bool)
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                best, score, bits, _ = _choices(shared.value, data, offsets, letters[first:last])
                columns = [batch.column("doc_id").slice(first, last - first), pa.array(names[best].tolist(), pa.string()), pa.array(score), pa.array(bits)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "lang_pred", "score", "bits_per_byte"])

    rows = documents.select("doc_id", "text", F.coalesce(F.col("text").rlike(LETTER), F.lit(False)).alias("letters"))
    return rows.mapInArrow(kernel.frugal(run), "doc_id long, lang_pred string, score double, bits_per_byte double")


def passing(documents: DataFrame, model: Model, least_score: float = 0.5, strange: float = STRANGE) -> DataFrame:
    """The documents with a language, with all their columns; no join.

    Left out are those that are ``und`` or score less, and those of some length that take ``strange`` times the bits a byte
    of training documents of their language: gibberish, and languages that were not learned.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)
    columns = documents.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = len(_names(shared.value))
        for batch in batches:
            # the last column tells whether the text has a letter; the others may have any names
            letters = batch.column(len(columns)).to_numpy(zero_copy_only=False).astype(bool)
            rows = pa.RecordBatch.from_arrays(batch.columns[:-1], columns)
            for first, last, data, offsets in kernel.blocks(rows.column(columns.index("text"))):
                best, score, bits, rate = _choices(shared.value, data, offsets, letters[first:last])
                odd = (bits > strange * rate) & (np.diff(offsets) >= STRANGE_BYTES)
                yield rows.slice(first, last - first).filter(pa.array((best < known) & (score >= least_score) & ~odd))

    flag = "letters"
    while flag in columns:
        flag += "_"
    return documents.withColumn(flag, F.coalesce(F.col("text").rlike(LETTER), F.lit(False))).mapInArrow(kernel.frugal(run), documents.schema)


def fit(documents: DataFrame, per_language: int = SAMPLE) -> Model:
    """The frozen trees of all languages, in groups."""
    counts = materialise(gather(documents, per_language))
    rows = materialise(frozen(counts))
    # the bits that a training byte takes: of every four-byte window its bits, by how often it stands in the sample
    mean = counts.join(rows.where(F.col("size") == ORDER + 1), ["lang", "key"]).groupBy("lang").agg((F.sum(F.col("n") * F.col("bits")) / F.sum("n")).alias("rate"))
    rates = {r["lang"]: r["rate"] for r in mean.collect()}
    languages = sorted(rates)
    groups = [languages[i : i + GROUP] for i in range(0, len(languages), GROUP)]
    model = [trees_of(some, rates, rows.where(F.col("lang").isin(some)).toArrow()) for some in groups]
    discard(counts, rows)
    return model


def identify(documents: DataFrame, per_language: int = SAMPLE) -> DataFrame:
    found = predict(documents, fit(documents, per_language))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "bits_per_byte")
