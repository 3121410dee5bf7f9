"""Linear classifiers by plain gradient steps (M3, M7, M8): sparse softmax steps as joins, hinge steps as sums.

Softmax: weights are a (class, term) table. One full-batch step joins the examples'
entries with the weights of their terms, sums scores per (example, class), turns them into
probabilities, joins the errors back to the entries and sums the gradient per (class,
term). Neither terms nor weights pass through the driver; each step's table is written to
the shared folder, so a lost executor costs one step and plans don't grow.

Hinge: dense features and one weight vector, as in a linear SVM by seeded mini-batch
subgradient descent. A step is one aggregation of the batch's violating examples.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import seeded_hash
from quarry.session import shared_path

BIAS = "\u0000"   # the term of the intercept, in every example with the value 1


@dataclass
class SoftmaxState:
    step: int
    loss: float            # of the weights before the step
    weights: DataFrame     # (term, label, w) after it


def softmax_steps(examples: DataFrame, entries: DataFrame, steps: int, rate: float = 1.0, ridge: float = 0.0) -> Iterator[SoftmaxState]:
    """Full-batch ridge steps from zero weights: w - rate * (mean gradient + ridge * w); the intercept has no ridge.

    ``examples``: (id, label), ids unique; ``entries``: (id, term, x), one row an id and term.
    Examples without a label take no part; those without entries have the intercept alone.
    The loss is the mean negative log-likelihood plus ridge / 2 times the squared weights.
    """
    spark, folder = examples.sparkSession, shared_path(examples.sparkSession, "softmax")
    known = examples.where(F.col("label").isNotNull()).select("id", F.col("label").cast("string").alias("label"))
    known.write.parquet(f"{folder}/examples")
    known = spark.read.parquet(f"{folder}/examples")
    entries.join(known.select("id"), "id", "left_semi").select("id", "term", F.col("x").cast("double").alias("x")).unionByName(
        known.select("id", F.lit(BIAS).alias("term"), F.lit(1.0).alias("x"))).write.parquet(f"{folder}/entries")
    data = spark.read.parquet(f"{folder}/entries")
    n = known.count()
    if not n:
        return
    classes = known.select(F.col("label").alias("c")).distinct()
    names = classes.agg(F.array_sort(F.collect_list("c")).alias("x")).scalar()   # a value per class
    weights = spark.createDataFrame([], "term string, label string, w double")
    for step in range(1, steps + 1):
        # weights of a term as one row of its classes
        rows = weights.groupBy("term").agg(F.map_from_entries(F.collect_list(F.struct("label", "w"))).alias("m"))
        parts = data.join(rows, "term").select("id", "x", F.explode("m").alias("c", "w"))
        sums = parts.groupBy("id", "c").agg(F.sum(F.col("x") * F.col("w")).alias("s"))
        by_id = sums.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("c", "s"))).alias("s"))
        scored = known.join(by_id, "id", "left").select("id", "label", "s", names.alias("_c"))
        score = F.transform("_c", lambda c: F.coalesce(F.try_element_at(F.col("s"), c), F.lit(0.0)))
        scored = scored.select("id", "label", "_c", score.alias("z")).withColumn("_m", F.array_max("z"))
        scored = scored.withColumn("e", F.transform("z", lambda z: F.exp(z - F.col("_m")))).withColumn("_t", F.aggregate("e", F.lit(0.0), lambda a, v: a + v))
        right = F.element_at("e", F.array_position("_c", F.col("label")).cast("int"))
        error = F.zip_with("_c", "e", lambda c, e: F.struct(c.alias("c"), (e / F.col("_t") - F.when(c == F.col("label"), 1.0).otherwise(0.0)).alias("d")))
        scored.select("id", error.alias("d"), (F.log("_t") - F.log(right)).alias("loss")).write.parquet(f"{folder}/errors-{step}")
        errors = spark.read.parquet(f"{folder}/errors-{step}")
        gradient = (data.join(errors.select("id", "d"), "id").select("term", "x", F.explode("d").alias("d"))
                    .groupBy("term", F.col("d.c").alias("label")).agg((F.sum(F.col("x") * F.col("d.d")) / F.lit(float(n))).alias("g")))
        w = F.coalesce("w", F.lit(0.0))
        pull = F.when(F.col("term") == BIAS, 0.0).otherwise(F.lit(ridge) * w)
        gradient.join(weights, ["term", "label"], "left").select("term", "label", (w - F.lit(rate) * (F.col("g") + pull)).alias("w")).write.parquet(
            f"{folder}/weights-{step}")
        square = weights.where(F.col("term") != BIAS).agg(F.sum(F.col("w") * F.col("w")).alias("q")).first()["q"] or 0.0
        loss = errors.agg(F.sum("loss").alias("l")).first()["l"] / n + ridge / 2 * square
        weights = spark.read.parquet(f"{folder}/weights-{step}")
        yield SoftmaxState(step, loss, weights)


@dataclass
class Hinge:
    weights: np.ndarray
    intercept: float
    counts: list[int]      # examples in each step's batch

    def margin(self, features: str | Column) -> Column:
        """w x + b of an array column; missing components count as 0."""
        w = F.from_json(F.lit(json.dumps([float(x) for x in self.weights])), "array<double>")
        return F.aggregate(F.zip_with(features, w, lambda x, v: F.coalesce(x, F.lit(0.0)) * F.coalesce(v, F.lit(0.0))), F.lit(self.intercept), lambda a, v: a + v)


def in_batch(id: str, step: int, share: float, seed: int) -> Column:
    """Whether a row belongs to a step's batch, by a seeded hash of step and id."""
    return seeded_hash(F.concat_ws(":", F.lit(str(step)), F.col(id).cast("string")), seed) < F.lit(round(share * (1 << 32)))


def hinge_sgd(df: DataFrame, id: str, features: str, label: str, steps: int = 100, step_size: float = 1.0, reg: float = 0.01,
              share: float = 1.0, seed: int = 42, intercept: bool = False) -> Hinge:
    """Linear SVM by mini-batch subgradient steps from zero: at step k the rate is step_size / sqrt(k), the weights
    shrink by rate * reg and move against the batch's mean hinge subgradient.

    ``label`` is 0 or 1; rows without label or features take no part; a step whose batch is
    empty changes nothing. The weight vector (as long as the features) is all that the
    driver holds; with ``intercept`` it has one more component, shrunk like the others.
    """
    kind = df.schema[features].dataType.simpleString()
    x = vector_to_array(features) if kind == "vector" else F.col(features).cast("array<double>")
    known = df.where(F.col(label).isNotNull() & F.col(features).isNotNull()).select(
        F.col(id).alias("id"), (F.concat(x, F.array(F.lit(1.0))) if intercept else x).alias("x"), (2.0 * F.col(label).cast("double") - 1.0).alias("y")).persist()
    try:
        size = known.select(F.max(F.size("x")).alias("d")).first()["d"] or 0
        w, counts = np.zeros(size), []
        for step in range(1, steps + 1 if size else 1):
            model = Hinge(w, 0.0, [])
            hit = known.where(in_batch("id", step, share, seed)).select("x", "y", (F.lit(1.0) - F.col("y") * model.margin("x") > 0).alias("bad"))
            g, n = _violations(hit, size)
            counts.append(n)
            if n:
                rate = step_size / step ** 0.5
                w = w * (1.0 - rate * reg) + rate * g / n
        return Hinge(w[:-1], float(w[-1]), counts) if intercept and size else Hinge(w, 0.0, counts)
    finally:
        known.unpersist()


def _violations(hit: DataFrame, size: int) -> tuple[np.ndarray, int]:
    """(sum of y x over the violating rows, rows): vectors are summed map-side."""
    from pyspark.ml.stat import Summarizer
    pad = F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda i: F.when(F.col("bad"), F.col("y") * F.coalesce(F.get("x", i), F.lit(0.0))).otherwise(0.0))
    r = hit.select(F.lit(0).alias("k"), array_to_vector(pad).alias("v")).groupBy("k").agg(
        Summarizer.sum(F.col("v")).alias("s"), F.count(F.lit(1)).alias("n")).first()   # no row for an empty batch
    return (r["s"].toArray(), int(r["n"])) if r else (np.zeros(size), 0)

