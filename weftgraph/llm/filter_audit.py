"""Filter interaction audit on sorted posting lists of failing documents.

The documents of a part (a language) are sorted by id and cut into ranges of ``RANGE`` documents; a range keeps, for each
filter, the sorted list of the places of documents that fail it. Unions of lists are merged one list at a time and
differences taken by galloping: the shorter list is searched in the longer. Every (filter, set of earlier filters) needs
one difference, 80 for five filters; their sizes are summed over ranges, and all orders of the filters follow from those
sums.

Defined cases: null texts are empty; a null language is the part with the empty name; repeated ids and rows count as
documents of their own; a text is a copy if any smaller doc_id has it, so that rows with the smallest id, or with none,
are not copies; documents with several labels are good or toxic if one label says so; labels without a document are
ignored; texts may be of any length; without documents there are no parts and no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weftgraph.llm.common import materialise

WORD = r"[^\x20\x09-\x0D]+"
#: Documents of one range of ids: the places in a posting list are below it.
RANGE = 4096
FILTERS = "ABCDE"
POSTINGS = f"part string, first_id long, n int, {', '.join(f'{f} array<int>' for f in FILTERS)}, good array<int>, toxic array<int>"
MEASURES = ("remaining", "removed", "good_lost", "toxic_lost", "fails", "unique_fails", "shapley")


def failures(text: Column) -> dict[str, Column]:
    """The conditions on which a text fails the filters A to D; E compares texts."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return {
        "A": F.size(words) < 100,
        "B": 100 * F.size(F.array_distinct(words)).cast("long") < 80 * F.size(words).cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def judged(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, doc_id, A to E, good, toxic) of every document (doc_id, text, lang)."""
    text = F.coalesce("text", F.lit(""))
    rows = documents.select(F.coalesce("lang", F.lit("")).alias("part"), "doc_id", F.unhex(F.sha2(text.cast("binary"), 256)).alias("same"), *[f.alias(k) for k, f in failures(text).items()])
    rows = materialise(rows)  # texts are read once; from here on rows are short
    first = rows.groupBy("same").agg(F.min("doc_id").alias("first"))
    says = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False)))
    marks = labels.where("doc_id is not null").groupBy("doc_id").agg(says("quality").alias("good"), says("toxic").alias("toxic"))
    copies = rows.join(first, "same", "left").withColumn("E", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False)))
    marked = copies.join(marks, "doc_id", "left")
    return marked.select("part", "doc_id", "same", *FILTERS, *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")])


def postings(rows: DataFrame) -> DataFrame:
    """Posting lists, a row for each range of ids of a part; ranges are cut within Spark's range partitions."""
    names = [*FILTERS, "good", "toxic"]

    def lists(part: str, ids: list[np.ndarray], marks: list[np.ndarray]) -> pa.RecordBatch:
        ids, marks = np.concatenate(ids), np.concatenate(marks)
        found = [pa.array([np.flatnonzero(marks[:, j]).astype(np.int32)], pa.list_(pa.int32())) for j in range(len(names))]
        return pa.RecordBatch.from_arrays([pa.array([part]), pa.array(ids[:1]), pa.array([len(ids)], pa.int32()), *found], ["part", "first_id", "n", *names])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, marks, size = None, [], [], 0
        for batch in batches:
            parts = batch.column("part").dictionary_encode()
            code, values = parts.indices.to_numpy(), parts.dictionary.to_pylist()
            edges = [0, *(np.flatnonzero(code[1:] != code[:-1]) + 1).tolist(), len(code)]
            key = batch.column("doc_id").fill_null(-(1 << 63)).to_numpy()
            mark = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(bool) for c in names], 1)
            for a, b in zip(edges, edges[1:]):
                while a < b:
                    if size and (values[code[a]] != now or size == RANGE):
                        yield lists(now, ids, marks)
                        ids, marks, size = [], [], 0
                    now, to = values[code[a]], min(b, a + RANGE - size)
                    ids.append(key[a:to])
                    marks.append(mark[a:to])
                    size += to - a
                    a = to
        if size:
            yield lists(now, ids, marks)

    ordered = rows.repartitionByRange("part", "doc_id", "same").sortWithinPartitions("part", "doc_id")
    return ordered.select("part", "doc_id", *names).mapInArrow(run, POSTINGS)


def within(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Of each member of the sorted list a: whether it is in the sorted list b. The shorter is searched in the longer."""
    out = np.zeros(len(a), bool)
    if len(a) and len(b):
        short, long = (a, b) if len(a) <= len(b) else (b, a)
        at = np.searchsorted(long, short)
        hit = at < len(long)
        hit[hit] = long[at[hit]] == short[hit]
        if len(a) <= len(b):
            out[:] = hit
        else:
            out[at[hit]] = True
    return out


def union(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The sorted union: what a lacks of b is put where it belongs."""
    more = b[~within(b, a)]
    return np.insert(a, np.searchsorted(a, more), more)


def pairs() -> list[tuple[int, int]]:
    """Every filter with every set (as bits) of filters that may stand before it."""
    return [(f, s) for f in range(len(FILTERS)) for s in range(1 << len(FILTERS)) if not s >> f & 1]


def differences(n: int, lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """The ``MEASURES`` of each of ``pairs()`` in one range of ids."""
    count = len(lists)
    unions = [np.zeros(0, np.int32)]
    for s in range(1, 1 << count):
        low = (s & -s).bit_length() - 1
        unions.append(union(unions[s & (s - 1)], lists[low]))
    lost = {(f, s): lists[f][~within(lists[f], unions[s])] for f, s in pairs()}
    everything = (1 << count) - 1
    shapley = [sum(factorial(s.bit_count()) * factorial(count - 1 - s.bit_count()) * len(x) for (g, s), x in lost.items() if g == f) for f in range(count)]
    return np.array([[n - len(unions[s]) - len(x), len(x), within(x, good).sum(), within(x, toxic).sum(), len(lists[f]), len(lost[f, everything ^ 1 << f]), shapley[f]] for (f, s), x in lost.items()], np.int64)


def interactions(lists: DataFrame) -> DataFrame:
    """(part, f, earlier, the ``MEASURES``) summed over all ranges: 80 rows a part."""
    key = np.array(pairs(), np.int32)

    def rows(part: str, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([part] * len(key)), pa.array(key[:, 0]), pa.array(key[:, 1]), *[pa.array(total[:, j]) for j in range(len(MEASURES))]], ["part", "f", "earlier", *MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, None
        for batch in batches:
            for i in range(batch.num_rows):
                part = batch.column("part")[i].as_py()
                if total is not None and part != now:
                    yield rows(now, total)
                    total = None
                found = [batch.column(c)[i].values.to_numpy() for c in (*FILTERS, "good", "toxic")]
                more = differences(batch.column("n")[i].as_py(), found[:-2], *found[-2:])
                now, total = part, more if total is None else total + more
        if total is not None:
            yield rows(now, total)

    found = lists.mapInArrow(run, f"part string, f int, earlier int, {', '.join(f'{m} long' for m in MEASURES)}")
    return found.groupBy("part", "f", "earlier").agg(*[F.sum(m).alias(m) for m in MEASURES])


def audit(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each part, order of the filters and step: what is kept, removed, redundant and lost."""
    steps = [("".join(FILTERS[f] for f in order), k + 1, f, sum(1 << g for g in order[:k])) for order in permutations(range(len(FILTERS))) for k, f in enumerate(order)]
    # as many rows as orders have steps: 600
    steps = documents.sparkSession.createDataFrame(steps, "filter_order string, step int, f int, earlier int")
    found = interactions(materialise(postings(judged(documents, labels))))
    return found.join(F.broadcast(steps), ["f", "earlier"]).select(
        "part", "filter_order", "step", F.col("remaining").alias("kept"), "removed", (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost", "shapley"
    )


def oracle_sql() -> str:
    """DuckDB SQL for ``audit``."""
    letters = ", ".join(f"('{f}', {1 << k})" for k, f in enumerate(FILTERS))
    return f"""
WITH RECURSIVE t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
good AS (SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic FROM labels GROUP BY doc_id),
fails AS (
  SELECT part, CAST(len(w) < 100 AS INTEGER) + 2 * CAST(100 * len(list_distinct(w)) < 80 * len(w) AS INTEGER)
    + 4 * CAST(100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) AS INTEGER) + 8 * CAST(regexp_matches(text, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY text), false) AS INTEGER) AS m, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic
  FROM t LEFT JOIN good USING (doc_id)),
atoms AS (SELECT part, m, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM fails GROUP BY ALL),
letters(f, b) AS (VALUES {letters}),
orders(o, used, k) AS (
  SELECT '', 0, 0 UNION ALL SELECT o || f, used + b, k + 1 FROM (SELECT o, used, k, f, b FROM orders, letters) WHERE used & b = 0),
steps AS (SELECT w.o AS filter_order, s.k AS step, l.f, l.b, s.used - l.b AS earlier FROM orders w JOIN orders s ON w.k = 5 AND s.k > 0 AND starts_with(w.o, s.o) JOIN letters l ON l.f = right(s.o, 1)),
found AS (
  SELECT part, filter_order, step, f, sum(n) FILTER (WHERE m & (earlier | b) = 0) AS kept, sum(n) FILTER (WHERE m & b > 0 AND m & earlier = 0) AS removed,
         sum(n) FILTER (WHERE m & b > 0 AND m & earlier > 0) AS redundant, sum(n) FILTER (WHERE m = b) AS unique_fails,
         sum(good) FILTER (WHERE m & b > 0 AND m & earlier = 0) AS good_lost, sum(toxic) FILTER (WHERE m & b > 0 AND m & earlier = 0) AS toxic_lost
  FROM steps, atoms GROUP BY ALL)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, {", ".join(f"CAST(coalesce({c}, 0) AS BIGINT) AS {c}" for c in ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost"))},
       CAST(sum(coalesce(removed, 0)) OVER (PARTITION BY part, f) AS BIGINT) AS shapley
FROM found"""
