"""Multinomial naive Bayes as aggregations and one join.

Model, with smoothing l, classes c, vocabulary V (terms seen in training):
  prior_c  = ln(n_c + l) - ln(N + C*l)
  theta_ct = ln(tf_ct + l) - ln(S_c + |V|*l)        S_c = sum_t tf_ct
  score_dc = prior_c + sum_t x_dt * theta_ct          (t in V)
           = prior_c - X_d * ln(S_c + |V| l) + sum_t x_dt * ln(tf_ct + l)
The sparse table holds, for each (class, term) seen in training, what the term adds over
an unseen one: ln(tf_ct + l) - ln(l); a known term adds ln(l) to every class. Both tables
are rows (of classes, of terms), saved as Parquet and read back by a join, so neither the
vocabulary nor the classes go through the driver, and neither plan nor row width grows with
the classes: their constants enter a plan as one scalar subquery. This equals
``pyspark.ml.classification.NaiveBayes`` (multinomial) on count vectors over the same
vocabulary; ties go to the first class. Documents without a label train nothing.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


@dataclass
class NBModel:
    class_table: DataFrame       # (c int, class, n, prior, denom = ln(S_c + |V| l)), c in order of names
    term_weights: DataFrame      # (term, w array<struct<c int, g double>>): gains of the classes that saw the term
    vocab_size: int
    smoothing: float

    @property
    def classes(self) -> list[str]:
        """The class names in order: a row per class on the driver, for reports."""
        return [r["class"] for r in self.class_table.orderBy("c").collect()]

    def constants(self) -> Column:
        """array<struct<c, class, prior, denom>> in order, as a scalar subquery."""
        return self.class_table.agg(F.array_sort(F.collect_list(F.struct("c", "class", "prior", "denom"))).alias("x")).scalar()

    def names(self) -> Column:
        """array of class names in order, as a scalar subquery."""
        return self.class_table.agg(F.transform(F.array_sort(F.collect_list(F.struct("c", "class"))), lambda b: b["class"]).alias("x")).scalar()

    def save(self, path: str, settings: dict[str, str] | None = None) -> str:
        """Write the tables below ``path``; the settings last, so a path with settings is whole."""
        spark = self.term_weights.sparkSession
        self.class_table.write.mode("overwrite").parquet(f"{path}/classes")
        self.term_weights.write.mode("overwrite").parquet(f"{path}/terms")
        own = {"vocab_size": str(self.vocab_size), "smoothing": repr(self.smoothing), **(settings or {})}
        spark.createDataFrame(list(own.items()), "name string, value string").coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")
        return path

    @staticmethod
    def load(spark: SparkSession, path: str) -> tuple[NBModel, dict[str, str]]:
        """The model at ``path`` and its settings."""
        own = {r["name"]: r["value"] for r in spark.read.parquet(f"{path}/settings").collect()}
        model = NBModel(spark.read.parquet(f"{path}/classes"), spark.read.parquet(f"{path}/terms"), int(own["vocab_size"]), float(own["smoothing"]))
        return model, own


def nb_model(docs: DataFrame, label: str = "label", words: str = "words", smoothing: float = 1.0) -> NBModel:
    """Fit from training documents (one row each: label, word array); null labels take no part."""
    from quarry.operators.text import explode_rows
    from quarry.session import shared_root
    shared_root(docs.sparkSession)
    known = docs.filter(F.col(label).isNotNull()).withColumn("_c", F.col(label).cast("string"))
    # the model's tables: their lineage is cut once (reliable checkpoint in the shared folder)
    counts = explode_rows(known, ["_c"], F.col(words), "term").groupBy("term", "_c").agg(F.count(F.lit(1)).alias("tf")).checkpoint()
    vocabulary = counts.select("term").distinct().count()
    every = Window.partitionBy(F.lit(0))  # over a row per class
    sizes = known.groupBy("_c").agg(F.count(F.lit(1)).alias("n")).join(counts.groupBy("_c").agg(F.sum("tf").alias("s")), "_c", "left")
    classes = sizes.select(
        (F.row_number().over(every.orderBy("_c")) - 1).alias("c"), F.col("_c").alias("class"), "n",
        (F.log(F.col("n") + F.lit(smoothing)) - F.log(F.sum("n").over(every) + F.count(F.lit(1)).over(every) * F.lit(smoothing))).alias("prior"),
        F.log(F.coalesce("s", F.lit(0)) + F.lit(float(vocabulary * smoothing))).alias("denom")).checkpoint()
    number = classes.agg(F.map_from_entries(F.collect_list(F.struct("class", "c"))).alias("x")).scalar()
    gain = F.log(F.col("tf") + F.lit(smoothing)) - F.lit(math.log(smoothing))
    weights = (counts.select("term", F.element_at(number, F.col("_c")).alias("c"), gain.alias("g"))
               .groupBy("term").agg(F.collect_list(F.struct("c", "g")).alias("w")))
    return NBModel(classes, weights, vocabulary, smoothing)


def nb_scores(model: NBModel, docs: DataFrame, id: str = "doc_id", words: str = "words",
              carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, *carry, scores array<double>) for every document, also those with no known word.

    Terms are counted per document before the join, so a frequent word costs one row a
    document; documents without a known word join the sums as rows of their own.
    """
    from quarry.operators.text import explode_rows
    keys = [id, *carry]
    tf = explode_rows(docs, keys, F.col(words), "term").groupBy(*keys, "term").agg(F.count(F.lit(1)).alias("tf"))
    seen = tf.join(model.term_weights, "term")
    # one row per class that saw the term; the term's own count rides on the first
    gains = seen.select(*keys, "tf", F.posexplode("w").alias("_p", "_g")).select(
        *keys, F.col("_g.c").alias("_c"), (F.col("tf") * F.col("_g.g")).alias("_s"),
        F.when(F.col("_p") == 0, F.col("tf")).otherwise(F.lit(0)).alias("_x"))
    every = docs.select(*keys, F.lit(-1).alias("_c"), F.lit(0.0).alias("_s"), F.lit(0).cast("long").alias("_x"))
    per_class = gains.unionByName(every).groupBy(*keys, "_c").agg(F.sum("_s").alias("_s"), F.sum("_x").alias("_x"))
    per_doc = per_class.groupBy(*keys).agg(F.map_from_entries(F.collect_list(F.struct("_c", "_s"))).alias("_m"), F.sum("_x").alias("_x"))
    unseen = F.lit(math.log(model.smoothing))
    scores = F.transform("_k", lambda b: b["prior"] + F.col("_x") * (unseen - b["denom"]) + F.coalesce(F.try_element_at("_m", b["c"]), F.lit(0.0)))
    return per_doc.select(*keys, "_m", "_x", model.constants().alias("_k")).select(*keys, scores.alias("scores"))


def nb_score(model: NBModel, docs: DataFrame, id: str = "doc_id", words: str = "words",
             carry: tuple[str, ...] = ()) -> DataFrame:
    """Predicted class (first maximum), raw scores and probabilities (softmax) per document."""
    s = nb_scores(model, docs, id, words, carry)
    mx = F.array_max("scores")
    ex = F.transform("scores", lambda x: F.exp(x - mx))
    total = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return (s.withColumn("_pi", (F.array_position("scores", mx) - 1).cast("int"))
            .withColumn("prediction", F.get(model.names(), F.col("_pi")))
            .withColumn("probability", F.transform(ex, lambda x: x / total))
            .drop("_pi"))


def class_probabilities(scored: DataFrame, classes: list[str] | Column, prob: str = "probability",
                        out: str = "class_probabilities") -> DataFrame:
    """class -> probability map for the known classes only (C2); ``classes`` as names or ``NBModel.names()``."""
    names = _names(classes)
    return scored.withColumn(out, F.map_from_arrays(names, F.slice(prob, F.lit(1), F.size(names))))


def _names(classes: list[str] | Column) -> Column:
    return classes if isinstance(classes, Column) else F.array(*[F.lit(x) for x in classes])


def ranked_probabilities(scored: DataFrame, classes: list[str] | Column, id: str = "doc_id",
                         prob: str = "probability", prediction: str = "prediction",
                         scores: str = "scores") -> DataFrame:
    """One row per (document, class): probability, rank, share %, predicted flag.

    Ranked by raw score (the same order as probability, without ties from underflow),
    then by class. The window is per document and holds one row per class.
    """
    names = _names(classes)
    z = F.arrays_zip(F.col(prob).alias("p"), F.col(scores).alias("s"))
    long = scored.select(id, prediction, F.posexplode_outer(z).alias("_i", "_z")).filter(F.col("_i").isNotNull())
    long = long.select(id, prediction, F.get(names, F.col("_i")).alias("class"),
                       F.col("_z.p").alias("probability"), F.col("_z.s").alias("score"))
    w = Window.partitionBy(id).orderBy(F.col("score").desc(), F.col("class"))
    tot = F.sum("probability").over(Window.partitionBy(id))
    return (long.withColumn("rank", F.row_number().over(w))
            .withColumn("share", F.col("probability") / tot * 100.0)
            .withColumn("is_predicted", F.col("class") == F.col(prediction))
            .drop(prediction))


def mean_answers(scored: DataFrame, model: NBModel, requests: DataFrame, id: str = "doc_id", request: str = "request") -> DataFrame:
    """One row per request: n_verses, predicted_label, class_probabilities.

    ``scored`` has a row per verse with its request in ``request``; the verses' class
    probabilities are averaged, the class of the largest mean wins, ties to the first.
    Requests without verses have 0 of them and null answers; equal ids are one request.
    """
    names = model.names()
    each = scored.select(F.col(request).alias(id), F.posexplode("probability").alias("_i", "_p"))
    blank = requests.select(id, F.lit(-1).alias("_i"), F.lit(0.0).alias("_p"))
    mean = each.unionByName(blank).groupBy(id, "_i").agg(F.avg("_p").alias("_p"), F.count(F.lit(1)).alias("_n"))
    per = mean.groupBy(id).agg(F.array_sort(F.collect_list(F.struct("_i", "_p", "_n"))).alias("_a"))
    known = F.filter("_a", lambda x: x["_i"] >= 0)
    p = F.transform(known, lambda x: x["_p"])
    best = (F.array_position(p, F.array_max(p)) - 1).cast("int")
    some = F.size(known) > 0
    return per.select(id, F.when(some, known[0]["_n"]).otherwise(F.lit(0)).cast("long").alias("n_verses"),
                      F.when(some, F.get(names, best)).alias("predicted_label"),
                      F.when(some, F.map_from_arrays(names, p)).alias("class_probabilities"))
