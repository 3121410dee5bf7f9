"""Parquet tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, root: str, name: str, partitions: int | None = None) -> DataFrame:
    """Read ``<root>/<name>.parquet``; filters and projections push into the scan.

    The scan's own splits are kept. A caller who knows that a table has fewer splits than
    the work needs may ask for ``partitions`` (or name tables for the session in
    ``spark.quarry.partitions``, as in ``documents=8,pages=8``); the rows are then dealt
    round by round.
    """
    df = spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
    if partitions is None:
        asked = dict(x.split("=") for x in spark.conf.get("spark.quarry.partitions", "").split(",") if x)
        partitions = int(asked.get(name, 0))
    return df.repartition(partitions) if partitions else df
