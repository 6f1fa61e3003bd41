"""Byte-level building blocks for Arrow batches: words, hashes and shingles of whole texts with numpy.

A block is a run of whole texts of about ``BLOCK`` bytes; longer texts are a block of their own and their words are
hashed chunk by chunk, so that memory follows the longest text by a small factor only.
"""

from __future__ import annotations

import ctypes
import functools
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

BLOCK = 1 << 19
Run = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]
#: What a Python worker keeps between the tasks of an operator, by name.
KEPT: dict[str, object] = {}
_ODD = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1

#: Space bytes of the word pattern ``[^\x20\x09-\x0D]+``.
SPACE = np.zeros(256, dtype=bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def begin(name: str) -> None:
    """Workers are used again by later stages: what others than the named one keep is dropped."""
    for other in [key for key in KEPT if key != name]:
        del KEPT[other]
    give_back()


def give_back() -> None:
    """Returns freed memory, which Arrow and the C library hold back, to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim is not None:
        trim(0)


def frugal(run: Run, name: str = "") -> Run:
    """A function for mapInArrow whose task starts without the memory of earlier ones and leaves none behind but what ``name`` keeps."""

    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin(name)
        yield from run(batches)
        give_back()

    return task


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    up, down = np.empty(n, np.uint64), np.empty(n, np.uint64)
    up[0] = down[0] = 1
    inverse = pow(_ODD, -1, 1 << 64)
    with np.errstate(over="ignore"):
        up[1:], down[1:] = np.uint64(_ODD), np.uint64(inverse)
        return np.multiply.accumulate(up), np.multiply.accumulate(down)


_TABLES: list[tuple[np.ndarray, np.ndarray]] = []


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _TABLES or len(_TABLES[0][0]) < n:
        _TABLES[:] = [_powers(max(n, BLOCK + 4096))]
    return _TABLES[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambler of 64-bit integers (the finaliser of splitmix64)."""
    x = x.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def blocks(column: pa.Array, size: int = BLOCK) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cuts a string column into (first row, row after the last, bytes, offsets); null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    if pa.types.is_large_string(column.type):
        offset_type = np.int64
    else:
        column, offset_type = column.cast(pa.string()), np.int32
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, offset_type)[column.offset : column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield first, last, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(data: np.ndarray, offsets: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words of a block, and the number of words of each text; no word crosses texts."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    ink = ~space[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    starts = ink.copy()
    starts[1:] &= ~ink[:-1] | first[1:n]
    ends = ink
    ends[:-1] &= ~ink[1:] | first[1:n]
    starts, ends = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offsets))


def hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are disjoint and ordered."""
    out, step = np.empty(len(starts), np.uint64), BLOCK
    i = 0
    while i < len(starts):
        j = max(int(np.searchsorted(ends, starts[i] + step, "right")), i + 1)
        at, to = int(starts[i]), int(ends[j - 1])
        up, down = tables(to - at + 1)
        edges = np.empty(2 * (j - i), np.int64)
        edges[::2], edges[1::2] = starts[i:j] - at, ends[i:j] - at
        value = (data[at:to].astype(np.uint64) + np.uint64(1)) * up[: to - at]
        total = np.add.reduceat(np.append(value, np.uint64(0)), edges)[::2]
        size = (ends[i:j] - starts[i:j]).astype(np.uint64)
        out[i:j] = mix(total * down[edges[::2]] + size * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out


def ngrams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every run of n neighbouring words (across texts too; callers mask those)."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.zeros(len(words) - n + 1, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xA0761D6478BD642F) + words[k : len(words) - n + 1 + k]
    return mix(out + np.uint64(n))


def inside(counts: np.ndarray, n: int) -> np.ndarray:
    """Of each n-gram position of ``ngrams``: whether it lies in one text."""
    total = int(counts.sum())
    if total < n:
        return np.zeros(0, bool)
    ok = np.ones(total, bool)
    ends = np.cumsum(counts)
    for k in range(1, n):
        at = ends - k
        ok[at[(at >= ends - counts)]] = False
    return ok[: total - n + 1]


def text_of(sets: list[np.ndarray]) -> pa.Array:
    offsets = np.zeros(len(sets) + 1, np.int32)
    np.cumsum([len(x) for x in sets], out=offsets[1:])
    flat = np.concatenate(sets) if sets else np.zeros(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text of a block, ASCII letters lower-cased.

    Fewer words than the width make one shingle of all of them; no words, the empty set.
    """
    data = LOWER[data]
    starts, ends, counts = spans(data, offsets)
    words = hashes(data, starts, ends)
    grams = ngrams(words, width)
    out, at = [], 0
    for c in counts.tolist():
        if c >= width:
            out.append(np.unique(grams[at : at + c - width + 1]))
        elif c:
            out.append(ngrams(words[at : at + c], c))
        else:
            out.append(np.zeros(0, np.uint64))
        at += c
    return out
