"""Scoring with fitted models (C1, C2): whole tables, one prediction per document.

A request of many lines becomes many verse rows; instead of keeping the first verse's
answer, the verse probabilities of a document are averaged (``Summarizer.mean``, a
partial aggregation per document) and the document gets the class of the largest mean.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def probability_map(pred: DataFrame, labels: Sequence[str], prob: str = "probability",
                    out: str = "class_probabilities") -> DataFrame:
    """class -> probability for the known labels only.

    With ``handleInvalid="keep"`` a label indexer adds one bucket for unseen labels;
    the vector is cut to the known labels, so that bucket never appears in the map.
    Frames without a probability column (e.g. SVM, regression) are returned unchanged.
    """
    if prob not in pred.columns:
        return pred
    names = F.array(*[F.lit(x) for x in labels])
    return pred.withColumn(out, F.map_from_arrays(names, F.slice(vector_to_array(prob), 1, len(labels))))


def score_documents(pred: DataFrame, id: str, labels: Sequence[str], prob: str = "probability") -> DataFrame:
    """One row per document: mean verse probability per class, predicted label = largest mean."""
    from pyspark.ml.stat import Summarizer
    agg = pred.groupBy(id).agg(Summarizer.mean(F.col(prob)).alias("_m"), F.count(F.lit(1)).alias("n_verses"))
    a = vector_to_array("_m")
    names = F.array(*[F.lit(x) for x in labels])
    known = F.slice(a, 1, len(labels))
    return agg.select(id, "n_verses", known.alias("mean_probability"),
                      names[F.array_position(known, F.array_max(known)) - 1].alias("predicted_label"))
