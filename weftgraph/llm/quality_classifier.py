"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader updates.

The model is fitted on a bounded sample of labelled rows (``SAMPLE`` documents at most, about) outside the held-out
fold; every document is scored, on its whole text. Defined cases: null and empty texts, and texts of white space, have
no n-gram and score 0.0; repeated documents score alike; a null doc_id counts as not held out; no labels at all, or none
of one class, give scores from the empty model or towards that class; other columns of the input are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftgraph.llm import kernel, linear
from weftgraph.llm.common import held_out

#: Labelled rows that the model is fitted on at most (about: rows are chosen by a hash).
SAMPLE = 20_000


def fit(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> np.ndarray:
    """Weights from documents (doc_id, text) and labels (doc_id, quality), held-out rows left aside."""
    labels = labels.select("doc_id", F.col("quality").alias("label"))
    return linear.train(linear.bounded_sample(documents, labels, ~held_out(F.col("doc_id")), rows, 17), linear.token_features)


def score(documents: DataFrame, weights: np.ndarray) -> DataFrame:
    """(doc_id, score) of every document; the weights have a fixed size, so they travel by broadcast."""
    weights = documents.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = np.zeros(batch.num_rows)
            for first, last, data, offsets in kernel.blocks(batch.column("text")):
                families = linear.token_features(data, offsets)
                out[first:last] = np.where(families[0][1] > 0, linear.sigmoid(linear.decision(families, weights.value)), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out)], ["doc_id", "score"])

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def classify(documents: DataFrame, labels: DataFrame, rows: int = SAMPLE) -> DataFrame:
    scored = score(documents, fit(documents, labels, rows))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
