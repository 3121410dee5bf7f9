"""Projections and filters (P1..P7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def role_filter(df: DataFrame, c: str, contains: Sequence[str] = (), equals: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``c`` contains any of ``contains`` or equals any of ``equals``.

    Filters before any projection so the tested column is still there; plain
    predicates, so Parquet receives them as pushed filters where it can.
    """
    cond = F.lit(False)
    for s in contains:
        cond = cond | F.col(c).contains(s)
    if equals:
        cond = cond | F.col(c).isin(list(equals))
    return df.filter(cond)


def require_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Drop rows with a null in any of ``cols`` (P5)."""
    return df.na.drop(subset=list(cols))


def with_unknown_label(df: DataFrame, label: str = "label", value=-1.0, id: str | None = None,
                       id_value: str = "unknown") -> DataFrame:
    """Constant label (and optionally id) for rows of unknown class."""
    d = df.withColumn(label, F.lit(value))
    return d.withColumn(id, F.lit(id_value)) if id else d
