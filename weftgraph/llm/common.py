"""What the operators share: reading tables, hash folds and samples, checkpoints in the cluster's folder."""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weftgraph.plans.iterate import discard, shared_folder  # noqa: F401 (the operators take them from here)
from weftgraph.plans.iterate import step as materialise  # noqa: F401
from weftgraph.plans.shipping import ship

#: Rows of an Arrow batch, where the session has Spark's default: whole texts are long, and workers small.
BATCH_ROWS = 500
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def prepared(query: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """A query or stage (spark, ...) whose session has the package on its workers and small Arrow batches."""

    @functools.wraps(query)
    def run(spark: SparkSession, *args: object) -> DataFrame:
        ship(spark)
        if spark.conf.get(_BATCH, "10000") == "10000":
            spark.conf.set(_BATCH, BATCH_ROWS)
        return query(spark, *args)

    return run


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    frame = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return frame.select(*columns) if columns else frame


def held_out(key: Column) -> Column:
    """The fold that models never learn from: crc32 of the key as text leaves 1 when divided by 3."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def share(key: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    return F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30)) / float(1 << 30)
