"""Sharding by sampled splitters, with DataFrame functions only: shards of nearly equal bytes.

Records are ordered by a hash of their text, so that equal texts stand together. A sample of keys, each drawn with a
chance in proportion to the record's size, gives the quantile boundaries of some hundreds of ranges; records find their
range by binary search. Overfull ranges are subdivided: one text repeated often gets parts of its own by a hash of
doc_id, all other records of the range are dealt by a hash of their text, so that no group of equal texts is torn.
Running sums inside parts and the totals of the parts before give every record its exact place among all bytes and rows,
and the place its shard: no shard is off by more than a record or a group of equal texts that goes whole. A group of
equal texts goes whole to the shard of its first byte if it has at most ``TOGETHER`` of a shard's bytes; a larger one is
cut where shards end, since shards could not be nearly equal otherwise.

Defined cases: null and empty texts have size 1; repeated rows take neighbouring slots; a null doc_id keeps its row;
texts of any length are one record; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weftgraph.llm.common import materialise, share

SHARDS = 16
RANGES = 64
MAX_RANGES = 4096
RANGE_ROWS = 500_000
#: Sampled keys for each range; part of a shard that a group of equal texts may have to stay whole.
SAMPLED = 64
TOGETHER = 0.01


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, size, text_crc32, key) of every document."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return documents.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("key"))


def splitters(records: DataFrame, ranges: int, total: int) -> list[int]:
    """Quantile boundaries of keys, from a sample in which a byte, not a record, has an equal chance."""
    chance = F.col("size") * float(ranges * SAMPLED) / float(total)
    sample = records.where(share(F.struct("doc_id", "key"), 41) < chance)
    cuts = sample.agg(F.percentile_approx("key", [k / ranges for k in range(1, ranges)], 10 * ranges).alias("cuts")).first()["cuts"]
    return sorted(set(cuts or []))


def range_of(key: Column, cuts: list[int]) -> Column:
    """The number of boundaries at or below the key, by binary search."""
    bounds = F.array(*[F.lit(c).cast("long") for c in cuts]) if cuts else F.array().cast("array<long>")
    steps = [1 << k for k in reversed(range(max(len(cuts), 1).bit_length()))]
    narrow = lambda low, step: F.when(F.get(bounds, low + step - 1) <= key, low + step).otherwise(low)
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), narrow)


def often(records: DataFrame, most: int) -> DataFrame:
    """(key, lot, lots, key_bytes) of keys with more than ``most`` rows; there are fewer than rows / most of them."""
    counts = records.groupBy("key").agg(F.count("*").alias("rows"), F.sum("size").alias("key_bytes")).where(F.col("rows") > most)
    lot = F.row_number().over(Window.orderBy("key"))  # over some thousand rows at most
    return counts.select("key", lot.alias("lot"), F.ceil(F.col("rows") / float(most)).cast("int").alias("lots"), "key_bytes")


def placed(records: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Adds each record's place: ``row`` (rows before it) and ``shard``."""
    whole = records.agg(F.count("*").alias("rows"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")).first()
    rows, total = whole["rows"], max(whole["bytes"], 1)
    ranges = min(MAX_RANGES, max(RANGES, rows // RANGE_ROWS))
    most = max(1, 2 * rows // ranges)
    records = records.withColumn("range", range_of(F.col("key"), splitters(records, ranges, total)))
    # a repeated text is a lot of its own in its range, after the other records, which are lot 0
    records = records.join(F.broadcast(materialise(often(records, most))), "key", "left").fillna(0, ["lot"])
    fanout = records.where("lot = 0").groupBy("range").agg(F.ceil(F.count("*") / float(most)).cast("int").alias("fanout"))
    records = records.join(F.broadcast(fanout), "range", "left")
    spread = F.when(F.col("lot") > 0, share(F.col("doc_id"), 43) * F.col("lots")).otherwise(share(F.col("key"), 43) * F.col("fanout"))
    records = records.withColumn("part", F.floor(spread).cast("int"))
    sums = records.groupBy("range", "lot", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.orderBy("range", "lot", "part").rowsBetween(Window.unboundedPreceding, -1)  # over at most some thousand rows
    sums = sums.select("range", "lot", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in ("bytes", "rows")])
    sums = sums.withColumn("lot_before", F.min("bytes_before").over(Window.partitionBy("range", "lot")))
    group = Window.partitionBy("range", "lot", "part", "key")
    order = Window.partitionBy("range", "lot", "part").orderBy("key", "doc_id", "size", "text_crc32")
    running = order.rowsBetween(Window.unboundedPreceding, 0)
    records = records.withColumns({"local": F.sum("size").over(running) - F.col("size"), "nth": F.row_number().over(order) - 1})
    records = records.withColumns({"group_at": F.min("local").over(group), "group_bytes": F.coalesce("key_bytes", F.sum("size").over(group))})
    records = records.join(F.broadcast(sums), ["range", "lot", "part"])
    first = F.when(F.col("lot") > 0, F.col("lot_before")).otherwise(F.col("group_at") + F.col("bytes_before"))
    anchor = F.when(F.col("group_bytes") <= TOGETHER * total / shards, first).otherwise(F.col("local") + F.col("bytes_before"))
    shard = F.least(F.floor(anchor * shards / F.lit(total).cast("decimal(20,0)")), F.lit(shards - 1)).cast("int")
    return records.select("doc_id", "size", "text_crc32", (F.col("nth") + F.col("rows_before")).alias("row"), shard.alias("shard"))


def shard(documents: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard) of every document, under the law of equal bytes."""
    done = materialise(placed(materialise(sized(documents)), shards))
    firsts = done.groupBy("shard").agg(F.min("row").alias("first"))
    done = done.join(F.broadcast(firsts), "shard")
    slot = (F.col("row") - F.col("first")).cast("long").alias("slot")
    return done.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", slot, F.lit(None).cast("int").alias("grown_shard"))
