"""Applying fitted models to a stream of articles.

Preprocessing, term weights, reductions and all predictions but nearest neighbours are narrow, so a
fitted chain scores each micro-batch as it comes: no state, no watermark.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from themata.operators.preprocess import preprocess
from themata.operators.reduce import Projection
from themata.plans.features import FeatureModel


def score(docs: DataFrame, features: FeatureModel, reducer: Projection | None, classifier, **lexicons) -> DataFrame:
    """``docs`` (doc_id, text, …) to the same rows with ``prediction``."""
    vectors = features.vectors(preprocess(docs, **lexicons))
    reduced = reducer.transform(vectors) if reducer else vectors
    return classifier.predict(reduced).drop("features")


def score_stream(
    docs: DataFrame,
    features: FeatureModel,
    reducer: Projection | None,
    classifier,
    write: Callable[[DataFrame, int], None],
    **lexicons,
) -> DataStreamWriter:
    """Score every micro-batch of ``docs`` and hand its rows and number to ``write``. After a failure a batch comes
    again with its number, by which ``write`` can replace what it wrote before."""

    def on_batch(batch: DataFrame, number: int) -> None:
        write(score(batch, features, reducer, classifier, **lexicons), number)

    return docs.writeStream.foreachBatch(on_batch)
