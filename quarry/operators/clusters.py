"""Cluster assignment, one Lloyd step, profiles and named levels.

Centres are a small list given by the caller or produced by a fit (k x d numbers);
distances are plain column arithmetic against literal centres (whole-stage codegen).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _sqdist(cols: Sequence[str], center: Sequence[float]) -> Column:
    e = None
    for c, v in zip(cols, center):
        t = (F.col(c) - F.lit(float(v))) * (F.col(c) - F.lit(float(v)))
        e = t if e is None else e + t
    return e


def assign_clusters(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]],
                    out: str = "cluster") -> DataFrame:
    """Nearest centre by squared Euclidean distance; ties to the lower index."""
    d = F.array(*[_sqdist(cols, c) for c in centers])
    return df.withColumn("_d", d).withColumn(
        out, (F.array_position("_d", F.array_min("_d")) - 1).cast("int")).drop("_d")


def update_centers(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """One Lloyd step: mean of the member rows per cluster."""
    return assigned.groupBy(cluster).agg(*[F.avg(c).alias(c) for c in cols])


def cluster_profile(assigned: DataFrame, cols: Sequence[str], cluster: str = "cluster") -> DataFrame:
    """Members and mean of each (original-unit) column per cluster."""
    return assigned.groupBy(cluster).agg(F.count(F.lit(1)).alias("n"),
                                         *[F.avg(c).alias(f"avg_{c}") for c in cols])


def level_from_cluster(profile: DataFrame, by: str, names: Sequence[str], cluster: str = "cluster",
                       unknown: str = "unknown") -> DataFrame:
    """Name clusters by the rank of their mean ``by`` (lowest -> names[0]) (C4).

    The profile has one row per cluster, so the ranking window is over k rows.
    """
    r = F.dense_rank().over(Window.orderBy(F.col(by), F.col(cluster)))
    m = F.create_map(*sum(([F.lit(i + 1), F.lit(n)] for i, n in enumerate(names)), []))
    return profile.withColumn("level_rank", r).withColumn(
        "level", F.coalesce(m[F.col("level_rank")], F.lit(unknown)))
