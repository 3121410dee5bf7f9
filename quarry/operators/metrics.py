"""Counts, distributions and evaluation metrics as aggregations (A1..A3, O2, E3..E7).

Each metric is one or two aggregations over the prediction table; per-class tables
are bounded by the number of classes. AUC uses a distributed prefix sum over the
distinct scores (range partitions) instead of a global sort into one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def dataset_overview(df: DataFrame, text: str | None = None) -> DataFrame:
    """Row count (A1), plus character totals when a text column is given."""
    aggs = [F.count(F.lit(1)).alias("n_rows")]
    if text:
        aggs += [F.sum(F.length(text)).cast("bigint").alias("n_chars"),
                 F.count(F.when(F.col(text) != "", 1)).alias("n_nonempty")]
    return df.agg(*aggs)


def class_distribution(df: DataFrame, label: str, out: str = "n") -> DataFrame:
    """Rows per class (A2): partial counts per task, then one small final aggregate."""
    return df.groupBy(label).agg(F.count(F.lit(1)).alias(out))


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, n) ordered by label, prediction (A3, O1)."""
    return (pred.groupBy(label, prediction).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(label, prediction))


def sample_predictions(pred: DataFrame, n: int = 20, order=("doc_id",)) -> DataFrame:
    """The first ``n`` predictions in a total order (O2): a distributed top-n."""
    return pred.orderBy(*order).limit(n)


def prediction_pairs(scored: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(prediction, label) pairs."""
    return scored.select(prediction, label)


def is_correct(pred: DataFrame, label: str = "label", prediction: str = "prediction",
               out: str = "correct") -> DataFrame:
    """Integer parts of prediction and label are equal."""
    return pred.withColumn(out, F.col(prediction).cast("double").cast("bigint")
                           == F.col(label).cast("double").cast("bigint"))


def multiclass_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """accuracy, weighted f1 / precision / recall over the true classes.

    Same definitions as ``MulticlassClassificationEvaluator``: precision of a class
    that is never predicted is 0; weights are true-class shares.
    """
    # both sides as one type, so that a class is the same value whether true or predicted
    kinds = {pred.schema[c].dataType.simpleString() for c in (label, prediction)}
    kind = kinds.pop() if len(kinds) == 1 else ("string" if "string" in kinds else "double")
    cm = pred.groupBy(F.col(label).cast(kind).alias("l"), F.col(prediction).cast(kind).alias("p")).agg(
        F.count(F.lit(1)).alias("n"))
    # each confusion row is one row of its true class and one of its predicted class: one more aggregation
    none = F.lit(0).cast("long")
    hit = F.when(F.col("l") == F.col("p"), F.col("n")).otherwise(none)
    sides = F.array(F.struct(F.col("l").alias("c"), F.col("n").alias("t"), none.alias("q"), hit.alias("h")),
                    F.struct(F.col("p").alias("c"), none.alias("t"), F.col("n").alias("q"), none.alias("h")))
    per = (cm.select(F.explode(sides).alias("x")).groupBy("x.c")
           .agg(F.sum("x.t").alias("n_true"), F.sum("x.q").alias("n_pred"), F.sum("x.h").alias("tp"))
           .filter((F.col("n_true") > 0) & F.col("c").isNotNull()))
    prec = F.when(F.col("n_pred") > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.col("tp") / F.col("n_true")
    per = per.withColumn("prec", prec).withColumn("rec", rec)
    f1 = F.when((F.col("prec") + F.col("rec")) > 0,
                2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(0.0)
    tot = F.sum("n_true")
    return per.agg((F.sum("tp") / tot).alias("accuracy"),
                   (F.sum(f1 * F.col("n_true")) / tot).alias("f1"),
                   (F.sum(F.col("prec") * F.col("n_true")) / tot).alias("weighted_precision"),
                   (F.sum(F.col("rec") * F.col("n_true")) / tot).alias("weighted_recall"))


def least_squares(df: DataFrame, x: str, y: str) -> tuple[float, float]:
    """(slope, intercept) of one-feature least squares; rows with a null on either side take no part (M1)."""
    r = df.agg(F.regr_slope(y, x).alias("b"), F.regr_intercept(y, x).alias("a")).first()
    return (0.0 if r["b"] is None else r["b"]), (0.0 if r["a"] is None else r["a"])


def regression_metrics(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """rmse, mse, mae, r2 in one aggregation (E5)."""
    e = F.col(prediction) - F.col(label)
    a = pred.agg(F.avg(e * e).alias("mse"), F.avg(F.abs(e)).alias("mae"),
                 F.var_pop(label).alias("_v"))
    # a constant label has no variance: r2 is null rather than a division error (ANSI mode)
    return a.select(F.sqrt("mse").alias("rmse"), "mse", "mae",
                    (F.lit(1.0) - F.try_divide(F.col("mse"), F.col("_v"))).alias("r2"))


def auc_roc(df: DataFrame, score: str, label: str) -> DataFrame:
    """Area under ROC with average ranks for ties (Mann-Whitney), exact.

    Rows without a label or a score take no part.
    1. per distinct score: positives p_s, negatives n_s (partial aggregation);
    2. the scores are range-partitioned once, their layout is fixed by a reliable
       checkpoint; negatives below a score = those of earlier partitions (a prefix over
       one row per partition) + those of earlier scores of its partition;
    3. AUC = sum_s p_s * (neg_below_s + n_s / 2) / (P * N).
    """
    from quarry.session import shared_root
    shared_root(df.sparkSession)
    s, y = F.col(score).cast("double"), F.col(label).cast("double")
    g = df.select(s.alias("s"), y.alias("y")).filter(F.col("s").isNotNull() & F.col("y").isNotNull()).groupBy("s").agg(
        F.sum(F.when(F.col("y") > 0.5, 1).otherwise(0)).alias("p"),
        F.sum(F.when(F.col("y") > 0.5, 0).otherwise(1)).alias("n"))
    g = g.repartitionByRange("s").checkpoint().withColumn("_pid", F.spark_partition_id())
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (g.groupBy("_pid").agg(F.sum("n").alias("_n"))
               .select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("before")))
    inner = Window.partitionBy("_pid").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    # one row per partition: bounded by the partition count
    g = (g.join(F.broadcast(offsets), "_pid")
         .withColumn("below", F.col("before") + F.coalesce(F.sum("n").over(inner), F.lit(0))))
    # only one class present: AUC is undefined -> null, not a division error
    return g.agg(
        F.try_divide(F.sum(F.col("p") * (F.col("below") + F.col("n") / 2.0)),
                     F.sum("p").cast("double") * F.sum("n").cast("double")).alias("auc"),
        F.sum("p").cast("bigint").alias("n_pos"), F.sum("n").cast("bigint").alias("n_neg"))
