"""Byte-level BPE: a streaming transducer with bounded look-ahead, and the decoder back to text.

Encoding. A text is cut into pre-tokens (letters, digits, other characters, each with a leading space, contractions,
white space) by character classes, in numpy over a block of whole texts. Inside a pre-token, a merge can only be
decided by what stands to its right, and only through a chain of merges of falling rank, so the merge list itself
bounds how far to look: ``lookahead`` computes that many bytes. A pre-token longer than a window goes through the
transducer window by window: all tokens that start at least the look-ahead before the window's end are stable and
emitted, and the window moves to the first one that is not, so the state is one window whatever the text. Pre-tokens
of one block that are not yet in the (bounded) memo are merged side by side in numpy. Where a pre-token starts is known
from the text after it alone, so a text longer than a block goes through block-sized windows too: each starts at the last
pre-token start that the window before was sure of. Only a run without any pre-token start longer than a window makes the
window grow to its length.

Decoding. Token bytes go through an incremental UTF-8 state machine in pieces, with U+FFFD for malformed parts.
"""

from __future__ import annotations

import codecs
import hashlib
import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from weftgraph.llm import kernel

#: Bytes of a pre-token that are merged at once, besides the look-ahead; pre-tokens kept in the memo.
WINDOW = 256
MEMO = 200_000
CHUNK = 1 << 16
BLOCK = 1 << 20
#: Characters to the right of a pre-token's start that can change where it starts, besides the longest added token.
MARGIN = 4
_NONE = np.int32(2**31 - 1)


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in vocabulary files of byte-level BPE, to the byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Token bytes, merges and added tokens of a vocabulary file (JSON of the tokenizers library)."""

    def __init__(self, text: str):
        spec = json.loads(text)
        to_byte = byte_characters()
        as_bytes = lambda token: bytes(to_byte[c] for c in token)
        vocab = spec["model"]["vocab"]
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        size = max([*vocab.values(), *self.added.values()]) + 1
        self.tokens: list[bytes] = [b""] * size
        for token, i in vocab.items():
            if token not in self.added:
                self.tokens[i] = as_bytes(token)
        for token, i in self.added.items():
            self.tokens[i] = token.encode()
        merges = [tuple(m) if not isinstance(m, str) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
        self.left = np.array([vocab[a] for a, _ in merges], np.int64)
        self.right = np.array([vocab[b] for _, b in merges], np.int64)
        self.result = np.array([vocab[a + b] for a, b in merges], np.int32)
        self.of_byte = np.zeros(256, np.int32)
        for c, b in to_byte.items():
            self.of_byte[b] = vocab[c]
        self._table()

    def _table(self) -> None:
        """An open-addressing table from a pair of tokens to the rank of its merge."""
        bits = 20
        self._mask = (1 << bits) - 1
        keys = self.left << 32 | self.right
        self.keys, self.ranks, self.probes = np.full(1 << bits, -1, np.int64), np.full(1 << bits, _NONE, np.int32), 1
        for rank, (key, slot) in enumerate(zip(keys.tolist(), self._slot(keys).tolist())):
            step = 1
            while self.keys[slot] >= 0:
                slot, step = (slot + 1) & self._mask, step + 1
            self.keys[slot], self.ranks[slot], self.probes = key, rank, max(self.probes, step)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (kernel.mix(keys.astype(np.uint64)) >> np.uint64(44)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        out = np.where(self.keys[slot] == keys, self.ranks[slot], _NONE)
        open_ = np.flatnonzero((self.keys[slot] != keys) & (self.keys[slot] >= 0))
        for k in range(1, self.probes):
            if not len(open_):
                break
            at = (slot[open_] + k) & self._mask
            hit = self.keys[at] == keys[open_]
            out[open_[hit]] = self.ranks[at[hit]]
            open_ = open_[~hit & (self.keys[at] >= 0)]
        return out

    def lookahead(self) -> int:
        """Bytes to the right of a token's start that suffice to tell that the token is final.

        Whether merge j happens at a place depends on text from its left end on: on its own bytes; on earlier merges
        that make its parts; on earlier merges that take its left part away; and, starting where its right part
        starts, on earlier merges that make or take away that part. Going through the merges by rank, ``taken`` and
        ``made`` hold, for each token, how far the merges that start with it or make it depend on text.
        """
        size = [len(t) for t in self.tokens]
        taken, made = [0] * len(size), size.copy()
        for a, b, c in zip(self.left.tolist(), self.right.tolist(), self.result.tolist()):
            reach = max(size[a] + size[b], made[a], taken[a], size[a] + max(made[b], taken[b]))
            taken[a] = max(taken[a], reach)
            made[c] = max(made[c], reach)
        return max(max(taken), max(made))


def merge(vocabulary: Vocabulary, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of every word, one after the other, and how many each has: merges by rank, leftmost first, all words at once."""
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ids = vocabulary.of_byte[np.frombuffer(b"".join(words), np.uint8)]
    owner = np.repeat(np.arange(len(words)), sizes)
    done_ids, done_owner = [], []
    while len(ids):
        rank = np.full(len(ids), _NONE, np.int32)
        rank[:-1] = np.where(owner[:-1] == owner[1:], vocabulary.rank(ids[:-1], ids[1:]), _NONE)
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        least = np.minimum.reduceat(rank, first)
        counts = np.diff(np.append(first, len(ids)))
        least = np.repeat(least, counts)
        final = least == _NONE
        done_ids.append(ids[final])
        done_owner.append(owner[final])
        ids, owner, rank, least = ids[~final], owner[~final], rank[~final], least[~final]
        hit = rank == least
        # of overlapping pairs of one rank (runs of one token) every other one is merged, from the left
        at = np.flatnonzero(hit)
        run = np.concatenate(([True], (np.diff(at) != 1) | (owner[at[1:]] != owner[at[:-1]]))) if len(at) else np.zeros(0, bool)
        start = np.maximum.accumulate(np.where(run, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - start) % 2 == 0]
        ids[at] = vocabulary.result[rank[at]]
        keep = np.ones(len(ids), bool)
        keep[at + 1] = False
        ids, owner = ids[keep], owner[keep]
    owner = np.concatenate([*done_owner, np.zeros(0, np.int64)])
    order = np.argsort(owner, kind="stable")
    return np.concatenate([*done_ids, np.zeros(0, np.int32)])[order], np.bincount(owner, minlength=len(words))


def transduce(vocabulary: Vocabulary, words: list[bytes], lookahead: int, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """As ``merge``; pre-tokens longer than ``window + lookahead`` bytes pass through a window of that size."""
    long = [i for i, w in enumerate(words) if len(w) > window + lookahead]
    if not long:
        return merge(vocabulary, words)
    out: dict[int, list[np.ndarray]] = {i: [] for i in long}
    size = np.array([len(t) for t in vocabulary.tokens], np.int64)
    open_ = [(i, 0) for i in long]
    while open_:
        pieces = [words[i][at : at + window + lookahead] for i, at in open_]
        ids, counts = merge(vocabulary, pieces)
        later = []
        for (i, at), piece, mine in zip(open_, pieces, np.split(ids, np.cumsum(counts)[:-1])):
            if at + len(piece) < len(words[i]):
                starts = np.concatenate(([0], np.cumsum(size[mine])[:-1]))
                mine = mine[: int(np.searchsorted(starts, len(piece) - lookahead, "right"))]
                later.append((i, at + int(size[mine].sum())))
            out[i].append(mine)
        open_ = later
    ids, counts = merge(vocabulary, [b"" if i in out else w for i, w in enumerate(words)])
    parts = np.split(ids, np.cumsum(counts)[:-1])
    for i in long:
        parts[i] = np.concatenate(out[i])
        counts[i] = len(parts[i])
    return np.concatenate(parts), counts


# fixed values: letters and numbers that Unicode 16.0 has and 15.1 has not, as the tokenizers library knows them
LETTERS_16 = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
)
NUMBERS_16 = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))
# fixed values: white space of the pattern
SPACES = ((9, 13), (32, 32), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A), (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000))

_CLASSES: list[np.ndarray] = []


def classes() -> np.ndarray:
    """Of each code point: 1 letter, 2 number, 3 white space, 0 other, by Unicode 16.0."""
    if not _CLASSES:
        import unicodedata

        kind = {"L": 1, "N": 2}
        table = np.fromiter((kind.get(unicodedata.category(chr(c))[0], 0) for c in range(0x110000)), np.uint8, 0x110000)
        for which, ranges in ((1, LETTERS_16), (2, NUMBERS_16), (3, SPACES)):
            for a, b in ranges:
                table[a : b + 1] = which
        _CLASSES.append(table)
    return _CLASSES[0]


def pretokens(data: np.ndarray, offsets: np.ndarray, added: list[str]) -> np.ndarray:
    """Byte offsets at which the pre-tokens of a block of texts start, and the block's end."""
    raw = data.tobytes()
    cp = np.frombuffer(raw.decode().encode("utf-32-le"), np.uint32) if (data >= 128).any() else data
    n = len(cp)
    if not n:
        return np.zeros(1, np.int64)
    width = np.ones(n, np.int64)
    if cp.dtype != np.uint8:
        width += (cp >= 0x80).astype(np.int64) + (cp >= 0x800) + (cp >= 0x10000)
    at = np.concatenate(([0], np.cumsum(width)))
    edges = np.searchsorted(at, offsets) if cp.dtype != np.uint8 else offsets
    cut = np.zeros(n + 1, bool)  # texts, and added tokens, end here and start anew
    cut[edges] = True
    whole = []
    for token in added:
        token_bytes, found = token.encode(), raw.find(token.encode())
        while found >= 0:
            k = int(np.searchsorted(offsets, found, "right"))
            if k < len(offsets) and found + len(token_bytes) <= offsets[k]:
                a, b = int(np.searchsorted(at, found)), int(np.searchsorted(at, found + len(token_bytes)))
                whole.append((a, b))
                cut[a] = cut[b] = True
                found = raw.find(token_bytes, found + len(token_bytes))
            else:
                found = raw.find(token_bytes, found + 1)
    kind = classes()[cp]
    space = kind == 3
    start = np.empty(n + 1, bool)
    start[0] = start[n] = True
    start[1:n] = kind[1:] != kind[:-1]
    start |= cut
    # the last character of white space before other text stands alone or, if a blank, leads what follows
    leads = np.flatnonzero(space[:-1] & ~space[1:] & ~cut[1:n])
    start[leads] = True
    start[leads[cp[leads] == 32] + 1] = False
    # contractions, where the apostrophe starts a pre-token
    quote = np.flatnonzero(cp == 39)
    quote = quote[start[quote] & (quote + 1 < n)]
    if len(quote):
        quote = quote[~cut[quote + 1]]
        second, third = cp[quote + 1], cp[np.minimum(quote + 2, n - 1)]
        more = (quote + 2 < n) & ~cut[np.minimum(quote + 2, n)]
        two = np.isin(second, [115, 116, 109, 100])
        three = more & ((second == 114) & (third == 101) | (second == 118) & (third == 101) | (second == 108) & (third == 108))
        start[quote[two | three] + 1] = False
        start[quote[two] + 2] = True
        start[quote[three] + 3] = True
    for a, b in whole:
        start[a + 1 : b] = False
        start[a] = start[b] = True
    return at[np.flatnonzero(start)]


class Encoder:
    """Encodes blocks of texts; one lives in each Python worker."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.lookahead = vocabulary, vocabulary.lookahead()
        self._reset()

    def _reset(self) -> None:
        self.memo: dict[bytes, int] = {}
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.first, self.size = np.empty(1 << 14, np.int64), np.empty(1 << 14, np.int64)
        added = self.vocabulary.added
        self._add([t.encode() for t in added], np.array([*added.values()], np.int32), np.ones(len(added), np.int64))

    def _add(self, words: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n = len(self.memo)
        while n + len(words) > len(self.first):
            self.first, self.size = np.append(self.first, self.first), np.append(self.size, self.size)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.append(self.flat, self.flat)
        self.first[n : n + len(words)] = self.used + np.cumsum(sizes) - sizes
        self.size[n : n + len(words)] = sizes
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        self.memo.update(zip(words, range(n, n + len(words))))

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of a block of texts, one text after the other, and the number of tokens of each."""
        return self._encode(data, offsets, pretokens(data, offsets, list(self.vocabulary.added)))

    def _encode(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if len(cuts) < 2:
            return np.zeros(0, np.int32), np.zeros(len(offsets) - 1, np.int64)
        words = pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(cuts.astype(np.int32)), pa.py_buffer(data)])
        words = words.dictionary_encode()
        _, bounds, joined = words.dictionary.buffers()
        bounds, joined = np.frombuffer(bounds, np.int32)[: len(words.dictionary) + 1].tolist(), joined.to_pybytes()
        distinct = [joined[a:b] for a, b in zip(bounds, bounds[1:])]
        if len(self.memo) + len(distinct) > MEMO:
            self._reset()
        where = np.fromiter((-1 if k is None else k for k in map(self.memo.get, distinct)), np.int64, len(distinct))
        new = np.flatnonzero(where < 0)
        if len(new):
            where[new] = np.arange(len(self.memo), len(self.memo) + len(new))
            fresh = [distinct[i] for i in new.tolist()]
            self._add(fresh, *transduce(self.vocabulary, fresh, self.lookahead))
        where = where[words.indices.to_numpy()]
        size = self.size[where]
        ends = np.cumsum(size)
        take = np.repeat(self.first[where] - (ends - size), size) + np.arange(ends[-1])
        bounds = np.searchsorted(cuts, offsets)
        totals = np.concatenate(([0], ends))[bounds]
        return self.flat[take], np.diff(totals)

    def windows(self, data: np.ndarray, size: int = BLOCK) -> Iterator[np.ndarray]:
        """Token ids of one text in pieces, window by window."""
        margin = max([4 * MARGIN, *(len(t.encode()) for t in self.vocabulary.added)])
        at, n, span = 0, len(data), size
        while at < n:
            end = min(at + span, n)
            while end < n and data[end] & 0xC0 == 0x80:  # whole characters
                end += 1
            cuts = pretokens(data[at:end], np.array([0, end - at]), list(self.vocabulary.added))
            if end < n:
                cuts = cuts[: int(np.searchsorted(cuts, end - at - margin, "right"))]
                if len(cuts) < 2:
                    span *= 2
                    continue
                end = at + int(cuts[-1])
            yield self._encode(data[at:end], np.array([0, end - at]), cuts)[0]
            at, span = end, size


#: The name under which workers keep an encoder.
KEEPS = "bpe"


def encoder(spec: str) -> Encoder:
    """The worker's encoder for a vocabulary file's text."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if kernel.KEPT.get(KEEPS, ("", None))[0] != key:
        kernel.KEPT[KEEPS] = key, Encoder(Vocabulary(spec))
        kernel.give_back()
    return kernel.KEPT[KEEPS][1]


def decode(pieces: Iterator[bytes]) -> Iterator[str]:
    """Text of a stream of token bytes, as far as it is complete after each piece."""
    machine = codecs.getincrementaldecoder("utf-8")("replace")
    for piece in pieces:
        yield machine.decode(piece)
    yield machine.decode(b"", True)


def spec_of(path: str) -> str:
    with open(path, encoding="utf-8") as f:
        return f.read()


def encoded(coder: Encoder, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Of each block of texts of a column: first row, row after the last, token ids of all texts, and how many each has."""
    for first, last, data, offsets in kernel.blocks(column, BLOCK):
        if last == first + 1 and len(data) > BLOCK:
            ids = np.concatenate([np.zeros(0, np.int32), *coder.windows(data)])
            yield first, last, ids, np.array([len(ids)])
        else:
            yield first, last, *coder.encode(data, offsets)


def round_trip(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): every text encoded, and its ids decoded again.

    Null and empty texts have no token: the digests are those of the empty string. A text longer than a block is encoded,
    decoded and digested window by window. Repeated rows, a null doc_id, other columns of the input and an empty table
    need no care. ``path`` is read on the driver; the file's text, of fixed size, travels by broadcast.
    """
    spec = documents.sparkSession.sparkContext.broadcast(spec_of(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(spec.value)
        as_bytes = pa.array(coder.vocabulary.tokens, pa.large_binary())
        as_text = pa.array([b"%d," % i for i in range(len(coder.vocabulary.tokens))], pa.large_binary())
        for batch in batches:
            for first, last, data, offsets in kernel.blocks(batch.column("text"), BLOCK):
                if last == first + 1 and len(data) > BLOCK:
                    counts, digests = _long_digests(coder, data, as_text, as_bytes)
                else:
                    ids, counts = coder.encode(data, offsets)
                    bounds = np.concatenate(([0], np.cumsum(counts)))
                    digests = []
                    for table, digest in ((as_text, _digest_numbers), (as_bytes, _digest_text)):
                        joined, ends = _joined(table, ids)
                        ends = ends[bounds]
                        digests.append([digest(joined[a:b]) for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())])
                columns = [batch.column("doc_id").slice(first, last - first), pa.array(np.asarray(counts, np.int64)), *(pa.array(x, pa.string()) for x in digests)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return documents.select("doc_id", "text").mapInArrow(kernel.frugal(run, KEEPS), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _joined(table: pa.Array, ids: np.ndarray) -> tuple[memoryview, np.ndarray]:
    """The entries of a table for ids, one after the other, and where each ends (with a 0 in front)."""
    if not len(ids):
        return memoryview(b""), np.zeros(1, np.int64)
    taken = table.take(pa.array(ids))
    return memoryview(taken.buffers()[2] or b""), np.frombuffer(taken.buffers()[1], np.int64)[: len(ids) + 1]


def _long_digests(coder: Encoder, data: np.ndarray, as_text: pa.Array, as_bytes: pa.Array) -> tuple[list[int], list[list[str]]]:
    """The number of tokens of one long text and both its digests, from one window of ids at a time."""
    numbers, text = hashlib.sha256(), hashlib.sha256()
    machine, count = codecs.getincrementaldecoder("utf-8")("replace"), 0
    for ids in coder.windows(data):
        joined = _joined(as_text, ids)[0]
        if count and len(ids):
            numbers.update(b",")
        numbers.update(joined[:-1])
        text.update(machine.decode(bytes(_joined(as_bytes, ids)[0])).encode())
        count += len(ids)
    text.update(machine.decode(b"", True).encode())
    return [count], [[numbers.hexdigest()], [text.hexdigest()]]


def _digest_numbers(joined: memoryview) -> str:
    return hashlib.sha256(joined[:-1] if len(joined) else joined).hexdigest()


def _digest_text(joined: memoryview) -> str:
    digest = hashlib.sha256()
    for text in decode(bytes(joined[k : k + CHUNK]) for k in range(0, len(joined), CHUNK)):
        digest.update(text.encode())
    return digest.hexdigest()
