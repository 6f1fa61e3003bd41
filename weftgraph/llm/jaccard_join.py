"""N-gram Jaccard join by parity sketches: documents whose shingle sets have a similarity of at least 0.75, exactly.

**Sketch.** A document's shingles are dealt to P chunks of 64 bits, and the hash of each is XORed into its chunk. Shingles
that two documents share cancel in the difference of their sketches, so the number of differing chunks is at most the
symmetric difference of the sets. A link of sets of a and b shingles needs a difference of at most D = (a + b) div 7. A
second sketch, in which each shingle toggles one of 4096 bits, bounds the difference by the number of differing bits.

**Pigeonhole.** P depends on the size band of the smaller set alone (bands double; a document also stands in the band
below if partners may lie there). At most D chunks differ. Of the s chunks of a document that are not zero, all but D
agree with its partner's; so if both sides put forward their first D + K chunks in one common order, K of those are
equal. K is 1 for sets of up to ``PLAIN`` shingles and a ``SPARE``-th of the set for larger ones. The order puts chunks of
frequent shingles (found in a bounded sample; it only steers the order) last. A document with s < D + K (never met, but
possible) takes part by the smallest quarter of its shingles, looked up among all shingles.

**Candidates.** Equal sets are one class from the start. Documents with an equal chunk form a bucket. Small buckets
compare all members. A link that no small bucket shows needs K equal chunks in large buckets (passages that many
documents share, groups of near copies); documents with so many are dealt anew by the rarest of single shingles. Only
connections count: documents first meet one partner each, components are contracted, and only members of different
components meet again, with the sketches in the join's condition. Candidates are dropped if the sketch of 4096 bits
shows too many differences, and the rest verified on the sets, which are made for the documents of such pairs alone.

Defined cases: documents without words (null and empty texts too) have no shingles and are components of their own;
fewer words than the width make one shingle; repeated documents are copies; a null doc_id gets a null component and
links nothing; documents that share a doc_id count as linked; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm import kernel
from weftgraph.llm.common import discard, materialise, share
from weftgraph.plans.iterate import components

WIDTH = 5
#: Smallest number of chunks, and the words of the sketch that candidates are compared by.
CHUNKS = 64
WORDS = 64
#: Sets up to this size put forward one chunk more than may differ; larger ones a part of their size more.
PLAIN, SPARE = 96, 12
#: Documents of the sample of frequent shingles, how often these stand there at least, and how many are kept.
HOT_SAMPLE, HOT_LEAST, HOT_KEPT = 8_000, 4, 50_000
#: Buckets of at most so many documents are compared in full.
SMALL = 12
#: Lanes that a chunk of frequent shingles is dealt over.
LANES = 64
#: Turns of contraction in large buckets at most; the turns end when fewer than one in ``TURN_GAIN`` pairs is a link.
TURNS, TURN_GAIN = 8, 20
#: Ids of copies that are sent to all executors at most; with more, the documents are joined by a shuffle.
SENT = 2_000_000


def _counted(frame: DataFrame) -> DataFrame:
    """A step that knows its number of rows: ``measured["rows"]``."""
    return materialise(frame, rows=F.count(F.lit(1)))


def most_differences(smaller: np.ndarray, larger: np.ndarray) -> np.ndarray:
    return (smaller + larger) // 7


def _flat(data: np.ndarray, offsets: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    sets = kernel.shingle_sets(data, offsets, width)
    return np.concatenate([*sets, np.zeros(0, np.uint64)]), np.array([len(x) for x in sets], np.int64)


def digests(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n, d1, d2) of every document: the size of its set and 128 bits that tell equal sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                flat, n = _flat(data, offsets, width)
                ends = np.cumsum(n)
                sums = []
                for salt in (1, 2):
                    total = np.concatenate(([np.uint64(0)], np.cumsum(kernel.mix(flat + np.uint64(salt)), dtype=np.uint64)))
                    sums.append(pa.array((total[ends] - total[ends - n]).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), pa.array(n), *sums], ["doc_id", "n", "d1", "d2"])

    return documents.select("doc_id", "text").mapInArrow(kernel.frugal(run), "doc_id long, n long, d1 long, d2 long")


def sets_of(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n, shingles, sketch, fold) of documents; fold is the sketch at a quarter of the length, for a first look."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                sets = kernel.shingle_sets(data, offsets, width)
                sketches = [_sketch(x) for x in sets]
                folds = [np.bitwise_xor.reduce(x.reshape(4, -1)) for x in sketches]
                n = pa.array([len(x) for x in sets], pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(first, last - first), n, kernel.text_of(sets), kernel.text_of(sketches), kernel.text_of(folds)], ["doc_id", "n", "shingles", "sketch", "fold"])

    return documents.select("doc_id", "text").mapInArrow(kernel.frugal(run), "doc_id long, n long, shingles array<long>, sketch array<long>, fold array<long>")


def _sketch(shingles: np.ndarray) -> np.ndarray:
    odd = np.bincount((shingles >> np.uint64(20)).astype(np.int64) & (64 * WORDS - 1), minlength=64 * WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


Levels = tuple[np.ndarray, np.ndarray]


def frequent(documents: DataFrame, rows: int, width: int = WIDTH) -> Levels:
    """Hashes, sorted, of shingles that many documents of a bounded sample have, and the magnitude of that number."""
    sample = documents.where(share(F.col("doc_id"), 47) < min(1.0, HOT_SAMPLE / max(rows, 1)))
    counts = sets_of(sample, width).select(F.explode("shingles").alias("h")).groupBy("h").count().where(F.col("count") >= HOT_LEAST)
    found = counts.orderBy(F.desc("count"), "h").limit(HOT_KEPT).collect()
    hashes = np.array([r["h"] for r in found], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return hashes[order], np.log2(np.array([r["count"] for r in found], np.float64) + 1)[order].astype(np.uint64)


def levels_of(shingles: np.ndarray, hot: Levels) -> np.ndarray:
    """0 for shingles that aren't frequent, else the magnitude; the common order of shingles and chunks starts with it."""
    hashes, levels = hot
    if not len(hashes):
        return np.zeros(len(shingles), np.uint64)
    at = np.minimum(np.searchsorted(hashes, shingles), len(hashes) - 1)
    return np.where(hashes[at] == shingles, levels[at], np.uint64(0))


def _band(n: np.ndarray) -> np.ndarray:
    """The chunks of the band of a set's size."""
    return np.maximum(CHUNKS, 1 << np.ceil(np.log2(n + 1)).astype(np.int64))


def chunks(flat: np.ndarray, n: np.ndarray, hot: Levels) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Put forward by the sets of a block: (hash of the chunk, number of the set); the sets with too few chunks; and of each chunk whether its shingles are all frequent."""
    rows, owners, rest, common = [], [], [], []
    level = levels_of(flat, hot)
    of = np.repeat(np.arange(len(n)), n)
    own = _band(n)
    below = own // 2  # the band of the partners of sizes under this one's
    low = -(-3 * n // 4)
    for many, most, member in (
        (own, most_differences(n, 4 * n // 3), n >= 3),
        (below, most_differences(n, n), (n >= 3) & (_band(low) < own)),
    ):
        need = np.where(member, most + np.where(n > PLAIN, n // SPARE, 1), 0)
        keep = member[of]
        h, doc = flat[keep], of[keep]
        p = (h >> np.uint64(32)).astype(np.int64) % many[doc]
        key = doc << 32 | p
        order = np.argsort(key, kind="stable")
        key, h, rare = key[order], h[order], level[keep][order]
        if not len(key):
            continue
        start = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        bits = np.bitwise_xor.reduceat(kernel.mix(h), start)
        rare = np.minimum.reduceat(rare, start)
        key = key[start]
        some = bits != 0
        bits, rare, key = bits[some], rare[some], key[some]
        doc = key >> 32
        name = kernel.mix(bits ^ kernel.mix((key & 0xFFFFFFFF).astype(np.uint64) << np.uint64(32) | many[doc].astype(np.uint64)))
        place = rare << np.uint64(58) | name >> np.uint64(6)
        order = np.lexsort((place, doc))
        name, doc, rare = name[order], doc[order], rare[order]
        have = np.bincount(doc, minlength=len(n))
        nth = np.arange(len(doc)) - np.repeat(np.cumsum(have) - have, have)
        first = nth < need[doc]
        rows.append(name[first])
        owners.append(doc[first])
        common.append(rare[first] > 0)
        rest.append(np.flatnonzero(have < need))
    none = np.zeros(0, np.int64)
    return np.concatenate([*rows, none.view(np.uint64)]), np.concatenate([*owners, none]), np.unique(np.concatenate([*rest, none])), np.concatenate([*common, none.astype(bool)])


def put_forward(documents: DataFrame, hot: Levels, width: int = WIDTH) -> DataFrame:
    """(chunk, lane, doc, n) of documents; a row without chunk for each document with too few.

    Chunks of frequent shingles alone may have any number of documents; they are dealt over ``LANES`` lanes, from 1 on.
    """
    shared = documents.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                flat, n = _flat(data, offsets, width)
                name, owner, rest, common = chunks(flat, n, shared.value)
                valid = np.concatenate((np.zeros(len(name), bool), np.ones(len(rest), bool)))
                owner = np.concatenate((owner, rest))
                chunk = pa.array(np.concatenate((name.view(np.int64), rest)), mask=valid)
                docs = ids[first:last][owner]
                lane = 1 + (kernel.mix(docs.astype(np.int64).view(np.uint64)) % np.uint64(LANES)).astype(np.int32)
                lane[: len(name)][~common] = 0
                yield pa.RecordBatch.from_arrays([chunk, pa.array(lane), pa.array(docs), pa.array(n[owner].astype(np.int32))], ["chunk", "lane", "doc", "n"])

    return documents.select("doc_id", "text").mapInArrow(kernel.frugal(run), "chunk long, lane int, doc long, n int")


def rarest(sets: DataFrame) -> DataFrame:
    """(chunk, doc, n, most): the rarest shingles of each set (doc_id, n, shingles) that other sets here have too.

    ``most`` counts a set's shingles that other sets have: no partner has more in common. A link needs three quarters of
    the set, so the others and one more must include a shingle in common; sets with fewer such shingles link nothing.
    Documents of a shingle are counted before they are shuffled, and the counts joined back, so no shingle needs one task.
    """
    each = sets.select(F.col("doc_id").alias("doc"), "n", F.xxhash64("shingles").alias("variant"), F.explode("shingles").alias("chunk"))
    counts = each.groupBy("chunk").agg(F.count("*").alias("df")).where("df > 1")
    each = each.join(counts, "chunk")
    own = Window.partitionBy("doc", "variant")
    each = each.withColumn("most", F.count("*").over(own)).where("4 * most >= 3 * n").withColumn("nth", F.row_number().over(own.orderBy("df", "chunk")))
    return each.where(F.col("nth") <= F.col("most") - F.ceil(F.col("n") * 3 / 4) + 1).select("chunk", "doc", F.col("n").cast("int"), F.col("most").cast("int"))


def _only(documents: DataFrame, ids: DataFrame, how: str, most: int | None = None) -> DataFrame:
    """Documents with (left_semi) or without (left_anti) these ids (doc_id); few ids are sent, more joined by a shuffle.

    They are counted only if ``most``, which they don't exceed, leaves that open.
    """
    few = (most is not None and most <= SENT) or ids.count() <= SENT
    return documents.join(F.broadcast(ids) if few else ids, "doc_id", how)


def _differing(a: str, b: str) -> Column:
    """The number of bits in which two sketches differ."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)


def _beside(pairs: DataFrame, of: DataFrame, *columns: str) -> DataFrame:
    """Pairs (a, b) with columns of both documents (doc_id, ...)."""
    for side in ("a", "b"):
        pairs = pairs.join(of.select(F.col("doc_id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in columns]), side)
    return pairs


def _verified(pairs: DataFrame, documents: DataFrame, width: int, sets: DataFrame | None = None) -> DataFrame:
    """The links among counted candidate pairs (a, b), by sketches and then by sets; ``sets`` may have all of these already."""
    ends = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    sketches = sets if sets is not None else materialise(sets_of(_only(documents, ends(pairs), "left_semi", 2 * pairs.measured["rows"]), width).select("doc_id", "n", "sketch"))
    near = _beside(pairs, sketches, "n", "sketch").where(7 * _differing("sketch_a", "sketch_b") <= F.col("n_a") + F.col("n_b"))
    near = _counted(near.select("a", "b"))
    sets = sets if sets is not None else materialise(sets_of(_only(documents, ends(near), "left_semi", 2 * near.measured["rows"]), width).select("doc_id", "n", "shingles"))
    common = F.size(F.array_intersect("shingles_a", "shingles_b"))
    both = _beside(near, sets, "n", "shingles")
    return _counted(both.where(100 * common >= 75 * (F.col("n_a") + F.col("n_b") - common)).select("a", "b").distinct())


def _spare(n: Column) -> Column:
    """Chunks that a set of a size puts forward beyond those that may differ."""
    return F.when(n > PLAIN, F.floor(n / SPARE)).otherwise(1)


def _small_pairs(buckets: DataFrame, many: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of members (doc, n) of small buckets that may be linked: their sizes allow it, and they have
    as many equal chunks as a link needs, if all large buckets that both stand in (doc, many) are counted as equal ones."""
    one = buckets.withColumn("x", F.explode("members")).withColumn("y", F.explode("members"))
    fits = (4 * F.col("x.n") >= 3 * F.col("y.n")) & (4 * F.col("y.n") >= 3 * F.col("x.n"))
    need = F.least(_spare(F.col("x.n")), _spare(F.col("y.n"))).alias("need")
    each = one.where((F.col("x.doc") < F.col("y.doc")) & fits).select(F.col("x.doc").alias("a"), F.col("y.doc").alias("b"), need)
    met = materialise(each.groupBy("a", "b").agg(F.count("*").alias("common"), F.min("need").alias("need")))
    weak = met.where("common < need")
    for side in ("a", "b"):
        weak = weak.join(many.select(F.col("doc").alias(side), F.col("many").alias(f"many_{side}")), side)
    weak = weak.where("common + least(many_a, many_b) >= need")
    return met.where("common >= need").select("a", "b").union(weak.select("a", "b"))


def _joined(new: DataFrame, labels: DataFrame | None) -> DataFrame:
    """Labels (v, c) with the counted new links too."""
    return components(new, labels) if labels is None or new.measured["rows"] else labels


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """The pairs (a, b) whose documents the labels (v, c) of the links found so far do not connect."""
    for side in ("a", "b"):
        pairs = pairs.join(labels.select(F.col("v").alias(side), F.col("c").alias(f"c_{side}")), side, "left")
    return pairs.where(F.coalesce("c_a", "a") != F.coalesce("c_b", "b")).select("a", "b")


def _connecting(pairs: DataFrame, documents: DataFrame, width: int, labels: DataFrame | None = None) -> DataFrame:
    """Labels (v, c) of what links among candidate pairs (a, b), and those of ``labels``, connect.

    In each of some turns every document meets one partner, another one each turn, and only pairs of documents that are
    not connected yet go on; so links, and nearly all verified pairs, grow with documents, not with pairs. What is left
    in the end is verified in full.
    """
    left = _counted(pairs if labels is None else _across(pairs, labels))
    for turn in range(TURNS // 2):
        order = F.col("a") if turn == 0 else F.xxhash64("a", F.lit(turn))
        one = _counted(left.groupBy("b").agg(F.min(F.struct(order.alias("h"), "a")).alias("x")).select("x.a", "b"))
        new = _verified(one, documents, width)
        labels = _joined(new, labels)
        rest = _counted(_across(left.join(one, ["a", "b"], "left_anti"), labels))
        discard(left)
        left = rest
        if not left.measured["rows"]:
            return labels
        if TURN_GAIN * new.measured["rows"] < one.measured["rows"]:
            break
    return _joined(_verified(left, documents, width), labels)


def _pairs(left: DataFrame, right: DataFrame) -> DataFrame:
    """Distinct pairs (a < b) of members of one bucket (chunk, doc, n, most, sketch, fold, c) that may be linked, across components."""
    x, y = left.alias("x"), right.alias("y")
    fits = 7 * F.least("x.most", "y.most") >= 3 * (F.col("x.n") + F.col("y.n"))
    close = lambda sketch: 7 * _differing(f"x.{sketch}", f"y.{sketch}") <= F.col("x.n") + F.col("y.n")
    met = x.join(y, (F.col("x.chunk") == F.col("y.chunk")) & (F.col("x.c") != F.col("y.c")) & fits & close("fold") & close("sketch"))
    return met.select(F.least("x.doc", "y.doc").alias("a"), F.greatest("x.doc", "y.doc").alias("b")).distinct()


def _rest_pairs(rest: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """Candidates of documents that put forward too few chunks: a partner has one of the smallest quarter of their shingles."""
    least = F.explode(F.slice(F.array_sort("shingles"), 1, (F.col("n") / 4).cast("int") + 1)).alias("h")
    few = sets_of(_only(documents, rest.distinct(), "left_semi"), width).select(F.col("doc_id").alias("x"), least)
    all_ = sets_of(documents, width).select(F.col("doc_id").alias("y"), F.explode("shingles").alias("h"))
    return few.join(all_, "h").where("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct()


def _open(member: DataFrame, labels: DataFrame) -> DataFrame:
    """Members with their component now, of buckets that have more than one."""
    now = materialise(member.drop("c").join(labels.withColumnRenamed("v", "doc"), "doc", "left").withColumn("c", F.coalesce("c", "doc")))
    several = now.groupBy("chunk").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    return _counted(now.join(several.select("chunk"), "chunk", "left_semi"))


def _star(member: DataFrame, turn: int) -> DataFrame:
    """One pair (a, b) for each member of open buckets: with the one document that its buckets have chosen, of another component."""
    order = F.col("doc") if turn == 0 else F.xxhash64("doc", F.lit(turn))
    chosen = member.groupBy("chunk").agg(F.min(F.struct(order.alias("h"), F.col("doc").alias("to"), F.col("c").alias("c_to"))).alias("x"))
    met = member.join(chosen.select("chunk", "x.*"), "chunk").where("c <> c_to")
    best = met.groupBy("doc").agg(F.min(F.struct("h", "to")).alias("x"))
    return best.select(F.least("doc", "x.to").alias("a"), F.greatest("doc", "x.to").alias("b")).distinct()


def _large_links(large: DataFrame, labels: DataFrame, documents: DataFrame, width: int) -> DataFrame:
    """``labels`` with the links of counted documents (doc_id) of large buckets too, dealt anew by their rarest shingles.

    In each of up to ``TURNS`` turns every bucket chooses a document, every document of another component meets one of
    these, and components are contracted; that leaves few components in large groups of near copies. Then members
    that are not in their bucket's largest component meet all members of other components, so no link is missed.
    """
    many = large.measured["rows"]
    sets = _counted(sets_of(_only(documents, large, "left_semi", many), width))
    if sets.measured["rows"] > many:  # a doc_id with several texts has several sets
        sets = materialise(sets.dropDuplicates(["doc_id", "shingles"]))
    member = materialise(rarest(sets))
    for turn in range(TURNS):
        member = _open(member, labels)
        if not member.measured["rows"]:
            return labels
        pairs = _counted(_star(member, turn))
        new = _verified(pairs, documents, width, sets)
        labels = _joined(new, labels)
        if TURN_GAIN * new.measured["rows"] < pairs.measured["rows"]:
            break
    member = _open(member, labels)
    if not member.measured["rows"]:
        return labels
    # members bring their sketches, so that only close pairs leave the join
    largest = member.groupBy("chunk", "c").count().groupBy("chunk").agg(F.max_by("c", F.struct("count", "c")).alias("main"))
    sketched = materialise(member.join(largest, "chunk").join(sets.select(F.col("doc_id").alias("doc"), "sketch", "fold"), "doc"))
    pairs = _counted(_pairs(sketched.where("c <> main"), sketched))
    return _joined(_verified(pairs, documents, width, sets), labels)


def connected(documents: DataFrame, rows: int, width: int = WIDTH) -> DataFrame:
    """(v, c) of documents with links to different sets: the smallest doc_id that is reachable."""
    member = put_forward(documents, frequent(documents, rows, width), width)
    size = F.count("*").over(Window.partitionBy("chunk", "lane"))
    # one row for each small bucket, one for each member of a large one, in the same partitions; lanes make a bucket large
    single = (F.col("lane") > 0) | F.col("chunk").isNull()
    member = member.withColumn("m", size).where((F.col("m") > 1) | single)
    alone = F.when((F.col("m") > SMALL) | single, F.col("doc")).alias("alone")
    buckets = materialise(member.groupBy("chunk", "lane", alone).agg(F.collect_list(F.struct("doc", "n")).alias("members")))
    large = buckets.where("chunk IS NOT NULL AND alone IS NOT NULL").select("chunk", F.explode("members").alias("x")).select("chunk", "x.*")
    # buckets of one document tell nothing
    shared = large.groupBy("chunk").agg(F.count("*").alias("m")).where("m > 1").select("chunk")
    many = materialise(large.join(shared, "chunk", "left_semi").groupBy("doc").agg(F.max("n").alias("n"), F.count("*").alias("many")))
    labels = _connecting(_small_pairs(buckets.where("alone IS NULL"), many), documents, width)
    rest = buckets.where("chunk IS NULL").select(F.col("alone").alias("doc_id"))
    if not rest.isEmpty():
        labels = _connecting(_rest_pairs(rest, documents, width), documents, width, labels)
    # a partner of a larger set puts forward at least three quarters as many chunks to spare as this one
    enough = F.when(F.col("n") > PLAIN * 4 // 3, F.floor(F.col("n") * 3 / 4 / SPARE)).otherwise(1)
    large = _counted(many.where(F.col("many") >= enough).select(F.col("doc").alias("doc_id")))
    if large.measured["rows"]:
        labels = _large_links(large, labels, documents, width)
    discard(buckets)
    return labels


def join(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """(doc_id, n_shingles, component_id) of every document (doc_id, text)."""
    made = materialise(digests(documents, width))
    usable = made.where("n > 0 AND doc_id IS NOT NULL")
    classes = _counted(usable.groupBy("n", "d1", "d2").agg(F.min("doc_id").alias("doc")))
    copies = usable.join(classes.select("doc"), F.col("doc_id") == F.col("doc"), "left_anti").select("doc_id").distinct()
    documents = documents.select("doc_id", "text").where(F.col("doc_id").isNotNull() & F.col("text").isNotNull())
    labels = connected(_only(documents, copies, "left_anti"), classes.measured["rows"], width)
    classes = classes.join(labels.withColumnRenamed("v", "doc"), "doc", "left")
    classes = classes.select("n", "d1", "d2", F.coalesce("c", "doc").alias("component_id"))
    linked = made.join(classes, ["n", "d1", "d2"], "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return linked.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def one_each(documents: DataFrame, width: int = WIDTH) -> DataFrame:
    """The documents (all columns) without those whose component has a smaller doc_id.

    Of rows with one doc_id the one with the smallest text stays (null first; ties by the other columns), whatever order
    they come in; rows with a null doc_id all stay.
    """
    found = materialise(join(documents, width))
    later = found.where("doc_id <> component_id").select("doc_id").distinct()
    kept = _only(documents, later, "left_anti")
    again = found.where("doc_id = component_id").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if again.isEmpty():
        return kept
    row = F.struct(*[F.col(c) for c in documents.columns])
    order = F.struct(F.col("text"), F.to_json(row))
    one = _only(kept, again, "left_semi").groupBy("doc_id").agg(F.min_by(row, order).alias("row")).select("row.*")
    return _only(kept, again, "left_anti").unionByName(one.select(documents.columns))
