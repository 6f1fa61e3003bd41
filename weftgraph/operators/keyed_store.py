"""JSON by id that is merged in place: a store in buckets of ids, of which a merge rewrites those that it touches.

A merge takes rows (id, payload, seq): the last payload of an id replaces what the store has, a null one removes the id. It
writes the touched buckets as JSON lines to a folder of its own; the newest folder of each bucket holds. A merge that has been
written is not done again, and one that broke off is done from the same state, so a run can be taken up where it ended.

Defined cases: null ids are left out; equal (id, seq) take the greater payload; a merge without rows changes nothing; payloads
are kept as they are, also if they aren't JSON.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SCHEMA = "id string, payload string"
BUCKETS = 16


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def written(spark: SparkSession, folder: str, number: int) -> bool:
    """Whether a merge has been written as a whole."""
    where, files = _files(spark, f"{folder}/merge={number}/_SUCCESS")
    return files.exists(where)


def current(spark: SparkSession, folder: str, before: int | None = None, buckets: set[int] | None = None) -> DataFrame:
    """(id, payload) of the store now, or before a merge; all of it, or some buckets."""
    where, files = _files(spark, folder)
    newest: dict[int, tuple[int, str]] = {}
    for merge in files.listStatus(where) if files.exists(where) else ():
        number = int(merge.getPath().getName().removeprefix("merge="))
        if (before is None or number < before) and written(spark, folder, number):
            for part in files.listStatus(merge.getPath()):
                name = part.getPath().getName()
                if name.startswith("bucket="):
                    bucket = int(name[7:])
                    newest[bucket] = max(newest.get(bucket, (-1, "")), (number, part.getPath().toString()))
    paths = [path for bucket, (_, path) in sorted(newest.items()) if buckets is None or bucket in buckets]
    return spark.read.schema(SCHEMA).json(paths).where("id IS NOT NULL") if paths else spark.createDataFrame([], SCHEMA)


def merge(rows: DataFrame, folder: str, number: int) -> bool:
    """Merges rows (id, payload, seq) into the store as merge ``number``; false if that had been done."""
    spark = rows.sparkSession
    if written(spark, folder, number):
        return False
    bucket = F.pmod(F.xxhash64("id"), F.lit(BUCKETS)).cast("int").alias("bucket")
    # the order of payloads may be null: those come first, so that a payload beats a removal of the same place
    new = rows.where("id IS NOT NULL").groupBy("id").agg(F.max_by(F.struct("payload"), F.struct("seq", "payload")).alias("x")).select("id", "x.payload")
    touched = {r["bucket"] for r in new.select(bucket).distinct().collect()}  # at most BUCKETS
    kept = current(spark, folder, number, touched).join(new, "id", "left_anti").unionByName(new.where("payload IS NOT NULL"))
    marks = spark.createDataFrame([(b,) for b in sorted(touched)], "bucket int")  # buckets that are empty now have a folder, too
    both = kept.select("*", bucket).unionByName(marks, allowMissingColumns=True).hint("rebalance", "bucket")
    both.write.mode("overwrite").partitionBy("bucket").option("ignoreNullFields", False).json(f"{folder}/merge={number}")
    return True
