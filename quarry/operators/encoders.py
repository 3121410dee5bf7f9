"""Encoders and feature extraction (F1..F9, F14, F15).

Lookups are ``create_map`` literals (small, fixed vocabularies given by the caller);
fitted encoders use Spark ML estimators whose fit is one distributed aggregation and
whose model (labels, maxima) is bounded by the number of categories or features.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _map(mapping: Mapping) -> Column:
    kv = []
    for k, v in mapping.items():
        kv += [F.lit(k), F.lit(v)]
    return F.create_map(*kv)


def ordinal_encode(df: DataFrame, c: str, mapping: Mapping[str, float], default: float = 0.0,
                   out: str | None = None) -> DataFrame:
    """Level string -> number; unknown and null -> ``default`` (F1)."""
    return df.withColumn(out or f"{c}_code",
                         F.coalesce(_map({k: float(v) for k, v in mapping.items()})[F.col(c)],
                                    F.lit(float(default))))


def slot_encode(df: DataFrame, c: str, names: Sequence[str], other: int | None = None,
                out: str | None = None) -> DataFrame:
    """Category name -> slot index; unknown, blank and null -> ``other`` (F2).

    ``other`` defaults to ``len(names)`` (one extra slot after the known ones).
    """
    other = len(names) if other is None else other
    m = _map({n: i for i, n in enumerate(names)})
    return df.withColumn(out or f"{c}_slot", F.coalesce(m[F.trim(F.col(c))], F.lit(other)).cast("int"))


def slot_decode(df: DataFrame, c: str, names: Sequence[str], other_name: str = "Other",
                other: int | None = None, unknown: str = "notDefined", out: str | None = None) -> DataFrame:
    """Slot index -> category name; the other slot -> ``other_name``; anything else -> ``unknown``."""
    other = len(names) if other is None else other
    m = _map({i: n for i, n in enumerate(names)} | {other: other_name})
    return df.withColumn(out or f"{c}_name", F.coalesce(m[F.col(c)], F.lit(unknown)))


def one_hot_columns(slot: str, n_slots: int, prefix: str = "oh") -> list[Column]:
    """``n_slots`` 0/1 double columns for a slot index (dropLast = False)."""
    return [F.when(F.col(slot) == i, 1.0).otherwise(0.0).alias(f"{prefix}_{i}") for i in range(n_slots)]


def assemble(df: DataFrame, cols: Sequence[str], out: str = "features") -> DataFrame:
    """``VectorAssembler``: numeric columns -> one vector (sparse when it is smaller)."""
    from pyspark.ml.feature import VectorAssembler
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid="keep").transform(df)


def regression_examples(df: DataFrame, label: str, numeric: str, level: str, level_map: Mapping[str, float],
                        category: str, names: Sequence[str], out: str = "features",
                        other: int | None = None) -> DataFrame:
    """(label, features): [numeric, level code, one-hot slot of category incl. the other slot].

    ``other`` is the slot of unknown categories: by default one slot after ``names``;
    it may also be the position of an "Other" entry inside ``names``.
    """
    other = len(names) if other is None else other
    d = ordinal_encode(df, level, level_map, out="_lvl")
    d = slot_encode(d, category, names, other=other, out="_slot")
    n_slots = max(len(names), other + 1)
    d = d.select("*", *one_hot_columns("_slot", n_slots, "_oh"))
    d = d.withColumn("_x", F.col(numeric).cast("double"))
    d = assemble(d, ["_x", "_lvl"] + [f"_oh_{i}" for i in range(n_slots)], out)
    return d.select(F.col(label).cast("double").alias("label"), *[c for c in df.columns if c != label], out)


def clustering_examples(df: DataFrame, value: str, numeric: str, level: str,
                        level_map: Mapping[str, float], out: str = "features") -> DataFrame:
    """Dense [value, numeric, level code] vector."""
    d = ordinal_encode(df, level, level_map, out="_lvl")
    d = d.withColumn("_v", F.col(value).cast("double")).withColumn("_n", F.col(numeric).cast("double"))
    return assemble(d, ["_v", "_n", "_lvl"], out).drop("_v", "_n", "_lvl")


def vector_width(df: DataFrame, arr: str) -> int:
    """The one length of all arrays of a column (null arrays aside); different lengths are an error."""
    n = F.when(F.col(arr).isNotNull(), F.size(arr))
    r = df.agg(F.min(n).alias("lo"), F.max(n).alias("hi")).first()
    if r["lo"] != r["hi"]:
        raise ValueError(f"{arr}: lengths from {r['lo']} to {r['hi']}")
    return r["lo"] or 0


def widen(df: DataFrame, arr: str, n: int, prefix: str = "feat_") -> DataFrame:
    """Array column -> ``n`` scalar columns ``feat_1..feat_n``."""
    return df.select("*", *[F.col(arr)[i].cast("double").alias(f"{prefix}{i + 1}") for i in range(n)])


def wide_examples(df: DataFrame, cols: Sequence[str], label: str, out: str = "features") -> DataFrame:
    """Many numeric columns -> one vector."""
    return assemble(df, cols, out).select(*[c for c in df.columns if c not in cols], out)


def string_index(df: DataFrame, c: str, out: str | None = None, handle_invalid: str = "keep"):
    """Most frequent value -> 0, ties alphabetical (F6). Returns (frame, fitted model).

    The fit is one aggregation; its labels array has the column's cardinality, so this
    is for class columns (``ranking.global_index`` numbers values of any cardinality).
    """
    from pyspark.ml.feature import StringIndexer
    model = StringIndexer(inputCol=c, outputCol=out or f"{c}_index", handleInvalid=handle_invalid,
                          stringOrderType="frequencyDesc").fit(df)
    return model.transform(df), model


def index_to_string(df: DataFrame, c: str, labels: Sequence[str], out: str | None = None,
                    unknown: str = "Unknown") -> DataFrame:
    """Index -> label; indices outside the labels -> ``unknown``."""
    target, pos = out or f"{c}_label", f"_{c}_pos"
    names = df.sparkSession.createDataFrame([(float(i), s) for i, s in enumerate(labels)], f"{pos} double, {target} string")
    joined = df.drop(target).withColumn(pos, F.col(c).cast("double")).join(names, pos, "left").drop(pos)
    return joined.withColumn(target, F.coalesce(F.col(target), F.lit(unknown)))


def vector_index(df: DataFrame, c: str = "features", out: str = "indexed", max_categories: int = 10):
    """Features with at most ``max_categories`` distinct values become categorical (F8)."""
    from pyspark.ml.feature import VectorIndexer
    model = VectorIndexer(inputCol=c, outputCol=out, maxCategories=max_categories,
                          handleInvalid="keep").fit(df)
    return model.transform(df), model


def max_abs_fit(df: DataFrame, cols: Sequence[str]) -> dict[str, float]:
    """max |x| per column in one aggregation (bounded by the number of columns)."""
    row = df.agg(*[F.max(F.abs(F.col(c).cast("double"))).alias(c) for c in cols]).collect()[0]
    return {c: float(row[c] or 0.0) for c in cols}


def max_abs_scale(df: DataFrame, cols: Sequence[str], suffix: str = "_scaled",
                  maxima: Mapping[str, float] | None = None) -> DataFrame:
    """x / max|x| per column; a column whose maximum is 0 stays 0."""
    maxima = dict(maxima) if maxima is not None else max_abs_fit(df, cols)
    return df.select("*", *[(F.col(c).cast("double") / F.lit(maxima[c] if maxima[c] else 1.0))
                            .alias(f"{c}{suffix}") for c in cols])


def labeled_vectors(df: DataFrame, label: str, arr: str, out: str = "features") -> DataFrame:
    """(label double, features vector) from a numeric array column."""
    from pyspark.ml.functions import array_to_vector
    return df.select(F.col(label).cast("double").alias("label"),
                     array_to_vector(F.col(arr).cast("array<double>")).alias(out))


def class_by_name(df: DataFrame, c: str, classes: Mapping[str, float], out: str | None = None,
                  unknown: float = -1.0) -> DataFrame:
    """Trimmed, lower-cased class name -> class value; unknown -> -1."""
    m = _map({k.strip().lower(): float(v) for k, v in classes.items()})
    return df.withColumn(out or f"{c}_value", F.coalesce(m[F.lower(F.trim(F.col(c)))], F.lit(unknown)))


def class_by_value(df: DataFrame, c: str, classes: Mapping[str, float], out: str | None = None,
                   unknown: str = "unknown") -> DataFrame:
    """Class value -> class name; unknown values -> ``unknown``."""
    m = _map({float(v): k for k, v in classes.items()})
    return df.withColumn(out or f"{c}_name", F.coalesce(m[F.col(c).cast("double")], F.lit(unknown)))
