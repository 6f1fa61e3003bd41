"""Iterative DataFrame jobs: a table written per step, so that plans stay short and lost executors cost one step."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def shared_folder(spark: SparkSession) -> str:
    """The folder that all executors share: ``spark.checkpoint.dir``, or a new one where that is unset and the run local."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        master = spark.conf.get("spark.master", "local")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="weftgraph-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


@contextlib.contextmanager
def sparing(spark: SparkSession) -> Iterator[None]:
    """Tables written within take less of the disk: files are packed with zstd, and a job's shuffles are removed as it ends.

    For jobs whose rows are written and read back, so that nothing asks for their shuffles again.
    """
    wanted = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.parquet.compression.codec": "zstd"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def step(frame: DataFrame, *by: str, **measures: Column) -> DataFrame:
    """Writes a table to the shared folder and reads it back; the lineage ends there.

    Each value of the columns ``by`` is a folder of its own, so that readers of one read no other. ``measures`` are aggregates of the rows, taken as these are written; ``measured`` has them by name, so no job of their
    own is needed.
    """
    spark = frame.sparkSession
    path = f"{shared_folder(spark)}/weftgraph-{uuid.uuid4().hex}"
    seen = Observation()
    written = frame.observe(seen, *[measure.alias(name) for name, measure in measures.items()]) if measures else frame
    writer = written.write
    (writer.partitionBy(*by) if by else writer).parquet(path)
    out = spark.read.schema(frame.schema).parquet(path)
    out.step_path = path
    out.measured = seen.get if measures else {}
    return out


def discard(*frames: DataFrame) -> None:
    """Removes the tables of steps whose rows no later job reads."""
    for frame in frames:
        path = getattr(frame, "step_path", None)
        if path is not None:
            remove(frame.sparkSession, path)


def remove(spark: SparkSession, *paths: str) -> None:
    """Removes folders of the shared folder."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def components(links: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """(v, c): of each end of a link (a, b), the smallest vertex reachable from it.

    Labels start as the smallest neighbour and go down by neighbours' labels and by the label's own label until none
    changes, so that paths shrink geometrically; one aggregation and two joins a round, by vertex. The aggregation
    combines before it shuffles, and the joins have one label for each vertex on one side, so that the rows of a hub
    can be split over tasks. ``known`` has the labels (v, c) of earlier links: these are one vertex each by now, so
    rounds follow the new links alone.
    """
    ends = links.select("a", "b")
    if known is not None:
        for side in ("a", "b"):
            ends = ends.join(known.select(F.col("v").alias(side), "c"), side, "left").withColumn(side, F.coalesce("c", side)).drop("c")
    both = step(ends.select("a", "b").union(ends.select(F.col("b").alias("a"), F.col("a").alias("b"))).where("a <> b").distinct())
    labels = step(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("c")).withColumnRenamed("a", "v"))
    while True:
        near = both.join(labels, both["b"] == labels["v"]).groupBy("a").agg(F.min("c").alias("n"))
        far = labels.select(F.col("v").alias("c"), F.col("c").alias("f"))
        found = labels.join(near, labels["v"] == near["a"]).join(far, "c").select("v", F.least("c", "n", "f").alias("d"), "c")
        found = step(found, changed=F.count_if(F.col("d") != F.col("c")))
        if not found.measured["changed"]:
            discard(both, found)
            break
        discard(labels)
        labels = found.select("v", F.col("d").alias("c"))
        labels.step_path = found.step_path
    if known is None:
        return labels
    moved = known.join(labels.select(F.col("v").alias("c"), F.col("c").alias("d")), "c", "left").select("v", F.coalesce("d", "c").alias("c"))
    out = step(moved.union(labels.join(known, "v", "left_anti").select("v", "c")))
    discard(labels)
    return out
