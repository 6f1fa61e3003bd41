"""Best-fit packing in bulk-synchronous supersteps.

Documents become pieces of at most ``capacity`` tokens, ranked within their length (a distributed sort on length and lane,
and running counts). Pieces of one length, and open sequences - gaps - of one free space, are interchangeable, so both are
ranges of ranks: a table with some thousand rows at most, whatever the input. Lengths are taken band by band from the
longest down. A superstep is one Spark job on this table: pieces and gaps are sorted by size on one line; a sweep gives
every run of pieces the gaps that follow it upwards, the nearest first (its successors); pieces that want one gap are
told apart by rank - the nth longest piece takes the nth smallest gap of its run - and longer runs of pieces than gaps
wait for the next superstep; gaps are updated, and pieces longer than every gap open new sequences. A band ends when it
has no piece left. The supersteps' decisions - for each range of ranks the first sequence, pieces per sequence and
offset - are sent to the pieces, which look themselves up by length and rank.

Defined cases: null and empty texts are a piece of one token (the separator); repeated documents are packed each, and so are
rows with one or no doc_id, which are told apart by piece, start, length and digest; a document of a multiple of
``capacity`` tokens has full pieces only, any longer other one starts with its short piece; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm import bpe, kernel
from weftgraph.llm.common import discard, materialise

CAPACITY = 2048
SEPARATOR = 0
#: Pieces of one length that one task ranks, about.
LANE_ROWS = 200_000


def pieces(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document (doc_id, text)."""
    spec = documents.sparkSession.sparkContext.broadcast(bpe.spec_of(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = bpe.encoder(spec.value)
        for batch in batches:
            for first, last, ids, counts in bpe.encoded(coder, batch.column("text")):
                ends = np.cumsum(counts)
                # every document's ids and its separator, one after the other
                ids = np.insert(ids, ends, SEPARATOR).astype("<u4")
                sizes = counts + 1
                n = -(-sizes // capacity)
                owner = np.repeat(np.arange(len(sizes)), n)
                piece = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
                head = (sizes - 1) % capacity + 1  # tokens of the first piece
                start = np.where(piece > 0, head[owner] + (piece - 1) * capacity, 0)
                length = np.where(piece > 0, capacity, head[owner])
                at = (np.cumsum(sizes) - sizes)[owner] + start
                raw = memoryview(ids.tobytes())
                crc = [zlib.crc32(raw[4 * a : 4 * (a + k)]) for a, k in zip(at.tolist(), length.tolist())]
                ident = batch.column("doc_id").slice(first, last - first).take(pa.array(owner))
                columns = [ident, pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32"])

    return documents.select("doc_id", "text").mapInArrow(kernel.frugal(run, bpe.KEEPS), "doc_id long, piece int, start long, length long, ids_crc32 long")


#: Bands of lengths end at the capacity divided by these, and at 0.
BANDS = (1, 2, 3, 4, 6, 8, 12, 16, 32, 64, 128)
LEFT, GAP, PLACED = 2, 1, 0
NAMES = ("kind", "size", "first", "n", "sequence", "each", "offset")
STATE = ", ".join(f"{name} long" for name in NAMES)
Row = tuple[int, ...]


def start(lengths: DataFrame) -> DataFrame:
    """The first state: pieces left (kind, length, first rank, how many), of lengths (length, n)."""
    values = {"kind": F.lit(LEFT), "size": F.col("length"), "n": F.col("n")}
    return lengths.select(*[values.get(name, F.lit(0)).cast("long").alias(name) for name in NAMES])


def swept(state: list[Row], capacity: int) -> list[Row]:
    """The state after one superstep: over the longest band that has pieces left.

    Rows are (LEFT, length, first rank, n), (GAP, space, first sequence, n) and (PLACED, length, first rank, n, first
    sequence, pieces a sequence, offset).
    """
    bands = [*dict.fromkeys(capacity // k for k in BANDS if capacity // k), 0]
    longest = max(row[1] for row in state if row[0] == LEFT)
    high, low = next((h, w) for h, w in zip(bands, bands[1:]) if longest > w)
    inside = lambda row: row[0] == LEFT and row[1] > low or row[0] == GAP and row[1] > low
    out, line = [row for row in state if not inside(row)], [row for row in state if inside(row)]
    # pieces longer than every gap open new sequences
    widest = max((row[1] for row in line if row[0] == GAP), default=0)
    longer = sum(row[3] for row in line if row[0] == LEFT and row[1] > widest)
    opened = max((row[2] + row[3] if row[0] == GAP else row[4] + -(-row[3] // row[5]) for row in state if row[0] != LEFT), default=0)
    if longer:
        line.append((GAP, capacity, opened, -(-longer // (capacity // high)), 0, 0, 0))
    # the sweep: every run of gaps, then the run of pieces below it
    line.sort(key=lambda row: (-row[1], row[0], row[2]))
    at = 0
    while at < len(line):
        end = at
        while end < len(line) and line[end][0] == GAP:
            end += 1
        stop = end
        while stop < len(line) and line[stop][0] == LEFT:
            stop += 1
        out += _by_rank(line[at:end][::-1], line[end:stop], high, capacity)
        at = stop
    return out


def _by_rank(gaps: list[Row], pieces: list[Row], high: int, capacity: int) -> list[Row]:
    """Matches pieces, longest first, with gaps, smallest first; a gap takes as many at once as it holds of the band's longest."""
    out, k, rank, many = [], 0, 0, 0

    def ready() -> bool:
        nonlocal k, rank, many
        if not many and k < len(pieces):
            rank, many = pieces[k][2:4]
            k += 1
        return many > 0

    for _, space, first, n, *_ in gaps:
        slots = max(1, space // high)
        while n and ready():
            length = pieces[k - 1][1]
            whole = min(n, many // slots)
            if whole:
                out.append((PLACED, length, rank, whole * slots, first, slots, capacity - space))
                out.append((GAP, space - slots * length, first, whole, 0, 0, 0))
                rank, many, first, n = rank + whole * slots, many - whole * slots, first + whole, n - whole
                continue
            used, free = 0, slots
            while free and ready():
                length, take = pieces[k - 1][1], min(free, many)
                out.append((PLACED, length, rank, take, first, take, capacity - space + used))
                rank, many, free, used = rank + take, many - take, free - take, used + take * length
            out.append((GAP, space - used, first, 1, 0, 0, 0))
            first, n = first + 1, n - 1
        if n:
            out.append((GAP, space, first, n, 0, 0, 0))
    if many:
        out.append((LEFT, pieces[k - 1][1], rank, many, 0, 0, 0))
    return [row for row in out + pieces[k:] if row[0] != GAP or row[1]]


def superstep(state: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``swept`` as a Spark job; the state has some thousand rows, in one partition."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [row for batch in batches for row in zip(*(column.to_pylist() for column in batch.columns))]
        if any(row[0] == LEFT for row in rows):
            rows = swept(rows, capacity)
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], list(NAMES))

    return state.select(*NAMES).coalesce(1).mapInArrow(run, STATE)


def plan(lengths: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """(size, first, n, sequence, each, offset) of lengths (length, n): where the pieces of a length from a rank on stand.

    A table is written after each superstep, so a lost executor costs one.
    """
    state = materialise(start(lengths))
    while not state.where(F.col("kind") == LEFT).isEmpty():
        before, state = state, materialise(superstep(state, capacity))
        discard(before)
    return state.where(F.col("kind") == PLACED).drop("kind")


def pack(made: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to pieces (doc_id, piece, start, length, ids_crc32), which should be materialised."""
    lengths = materialise(made.groupBy("length").agg(F.count("*").alias("n")))
    rows = lengths.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # some thousand rows
    found = plan(lengths, capacity).orderBy("size", "first").toArrow()
    table = made.sparkSession.sparkContext.broadcast(np.stack([found.column(c).to_numpy() for c in ("size", "first", "sequence", "each", "offset")], 1).reshape(-1, 5).astype(np.int64))
    lanes = max(16, rows // LANE_ROWS)
    made = made.withColumn("lane", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(lanes)))
    ranked = made.withColumn("rank", F.row_number().over(Window.partitionBy("length", "lane").orderBy("doc_id", "piece", "ids_crc32")) - 1)
    sizes = made.groupBy("length", "lane").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("length").orderBy("lane").rowsBetween(Window.unboundedPreceding, -1))
    ranked = ranked.join(sizes.select("length", "lane", F.coalesce(before, F.lit(0)).alias("before")), ["length", "lane"])
    ranked = ranked.select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("rank") + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, first_rank, sequence, each, offset = table.value.T
        key = of << 45 | first_rank
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(key, length << 45 | rank, "right") - 1
            into = rank - first_rank[k]
            columns = [*batch.columns[:5], pa.array(sequence[k] + into // each[k]), pa.array(offset[k] + into % each[k] * length)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    return ranked.mapInArrow(place, "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")


def best_fit(documents: DataFrame, path: str, capacity: int = CAPACITY) -> DataFrame:
    return pack(materialise(pieces(documents, path, capacity)), capacity)
