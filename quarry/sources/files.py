"""File sources and sinks (S1..S3, S5, S6, S9).

Paths are on the cluster's shared storage (see ``quarry.session.shared_path``).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import text as tf


def read_typed_csv(spark: SparkSession, path: str, schema: T.StructType | str,
                   header: bool = True) -> DataFrame:
    """CSV with a header and a fixed schema (S1): no inference pass, types known up front."""
    return spark.read.schema(schema).option("header", header).csv(path)


def read_inferred_csv(spark: SparkSession, path: str, header: bool = True) -> DataFrame:
    """CSV with inferred types (S2). Costs one extra pass; prefer a fixed schema at scale."""
    return spark.read.option("header", header).option("inferSchema", True).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_labeled_text(df: DataFrame, path: str, label: str, text: str) -> str:
    """One folder per class (``label=<value>``), text bodies as lines."""
    df.select(label, text).write.mode("overwrite").partitionBy(label).text(path)
    return path


def read_labeled_text(spark: SparkSession, path, label: str = "label",
                      whole: bool = False) -> DataFrame:
    """Labelled text directory (S3): one folder per class, class from the folder name.

    ``path`` may also be a ``{label: glob}`` mapping (see :func:`read_class_dirs`).

    ``whole=False``: one row per line (value, label, id = file path), keeping lines
    that are not empty and contain a space (P2, P3). ``whole=True``: one row per file
    (value = whole text), for the array lane, where line numbers are positions.
    """
    if isinstance(path, Mapping):
        return read_class_dirs(spark, path, whole)
    r = spark.read.text(path, wholetext=whole)   # the keyword: text() would reset an .option()
    r = r.withColumn("id", F.col("_metadata.file_path"))
    if not whole:
        r = r.filter((F.col("value") != "") & F.col("value").contains(" "))
    return r


def read_class_dirs(spark: SparkSession, dirs: Mapping[str, str], whole: bool = False) -> DataFrame:
    """Union of per-class folders given as {label: glob} (S3 + U1)."""
    out = None
    for label, glob in dirs.items():
        r = spark.read.text(glob, wholetext=whole).withColumn("id", F.col("_metadata.file_path"))
        if not whole:
            r = r.filter((F.col("value") != "") & F.col("value").contains(" "))
        r = r.withColumn("label", F.lit(label))
        out = r if out is None else out.unionByName(r)
    return out


def read_numbered_lines(spark: SparkSession, path, sep: str | None = "\n", reader_filter: bool = True) -> DataFrame:
    """Lines of text files with their file, byte block and number inside the file (S3, W1): (id, block, line_no, value).

    A large file is read in splits by many tasks. A line knows its split's first byte
    (``block``) and its place among the split's rows; lines of earlier splits of the file
    are a prefix over one row per (file, split). So a number needs no task that sees the
    whole file, and is the same for every split size. With ``reader_filter`` only lines
    that are not empty and contain a space are kept and numbered (P2, P3). ``path`` may
    be a ``{label: glob}`` mapping; then ``label`` is a column. Compressed files are one split.
    """
    if isinstance(path, Mapping):
        out = None
        for label, glob in path.items():
            r = read_numbered_lines(spark, glob, sep, reader_filter).withColumn("label", F.lit(label))
            out = r if out is None else out.unionByName(r)
        return out
    r = spark.read.text(path, lineSep=sep).select(
        F.col("_metadata.file_path").alias("id"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("_row"), "value")  # ascends with the rows of a split
    if reader_filter:
        r = r.filter((F.col("value") != "") & F.col("value").contains(" "))
    sizes = r.groupBy("id", "block").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)  # a row per split
    before = sizes.select("id", "block", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy("id", "block").orderBy("_row"))
    return (r.withColumn("_place", place).join(before, ["id", "block"])
            .select("id", "block", (F.col("_before") + F.col("_place")).cast("long").alias("line_no"), "value"))


def write_labeled_vectors(df: DataFrame, path: str, label: str, arr: str) -> str:
    """(label double, features vector) Parquet (S5): one projection, executors write."""
    from quarry.operators.encoders import labeled_vectors
    labeled_vectors(df, label, arr).write.mode("overwrite").parquet(path)
    return path


def requests_to_df(df: DataFrame, text: str = "text", keep=None) -> DataFrame:
    """Request bodies -> one row per line (S6, T9): (..., line_no, line), empty lines kept out."""
    cols = [c for c in df.columns if c != text] if keep is None else list(keep)
    arr = F.filter(tf.lines(text), lambda l: F.trim(l) != F.lit(""))
    from quarry.operators.text import explode_rows
    return explode_rows(df, cols, arr, "line", "line_no")


def to_labeled_csv(df: DataFrame, label, arr: str, out: str = "record") -> DataFrame:
    """``label,v1,v2,...`` text records (S9). ``label`` is a column or a Column rule."""
    lab = F.col(label) if isinstance(label, str) else label
    return df.select(F.concat_ws(",", lab.cast("string"),
                                 F.array_join(F.transform(arr, lambda x: x.cast("string")), ",")).alias(out))


def write_text(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").text(path)
    return path


def parse_labeled_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read ``label,v1,...`` records back: (label, values array<double>)."""
    parts = F.split(F.col("value"), ",")
    return spark.read.text(path).select(
        parts[0].cast("double").alias("label"),
        F.transform(F.slice(parts, 2, 1 << 30), lambda x: x.cast("double")).alias("values"))
