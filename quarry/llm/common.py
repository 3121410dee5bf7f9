"""Helpers shared by the operators: words, seeded order, running totals, lineage cuts."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.session import shared_root

# A word is a run of code points other than space and \t \n \v \f \r. On UTF-8 bytes
# that is exactly what bytes.split() without an argument gives.
WORD_CLASS = r"[^\x20\x09-\x0D]+"


def read_docs(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder (reliable, survives executors)."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def as_bytes(batch: pa.RecordBatch, i: int) -> list:
    """Column ``i`` of a batch as UTF-8 ``bytes`` (or None) without decoding."""
    c = batch.column(i)
    return c.cast(pa.large_binary() if pa.types.is_large_string(c.type) else pa.binary()).to_pylist()


def map_rows(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterable[Sequence] | None], schema: str,
             setup: Callable[[], object] | None = None) -> DataFrame:
    """``mapInArrow`` where ``fn(batch, state)`` gives columns (lists) of the output.

    ``setup`` runs once in each task; its value is passed to ``fn`` as ``state``.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    target = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for b in batches:
            if b.num_rows == 0:
                continue
            cols = fn(b, state)
            arrays = [c if isinstance(c, pa.Array) and c.type == f.type
                      else (c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, type=f.type))
                      for c, f in zip(cols, target, strict=True)]
            out = pa.RecordBatch.from_arrays(arrays, schema=target)
            if out.num_rows:
                yield out
        pa.default_memory_pool().release_unused()  # workers outlive their tasks

    return df.mapInArrow(run, schema)


def filter_rows(df: DataFrame, text_col: str, keep: Callable[[list, object], Sequence[bool]],
                setup: Callable[[], object] | None = None) -> DataFrame:
    """The rows of ``df``, all columns as they are, for whose texts (UTF-8 bytes or None) ``keep`` says so."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for b in batches:
            if b.num_rows:
                out = b.filter(pa.array([bool(k) for k in keep(as_bytes(b, at), state)], pa.bool_()))
                if out.num_rows:
                    yield out
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, df.schema)


def doc_crc(col: str | Column) -> Column:
    """CRC-32 of the id as decimal text; a null id counts as the empty text."""
    c = F.col(col) if isinstance(col, str) else col
    return F.crc32(F.coalesce(c.cast("string"), F.lit("")))


def seeded_key(col: str, seed: int) -> Column:
    """A seeded, engine-independent order: md5 of ``seed:id`` as hex text."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(col).cast("string"), F.lit("null"))))


def key_bucket(key: Column, n: int) -> Column:
    """Range bucket 0..n-1 of a hex key: buckets follow the order of the keys."""
    head = F.conv(F.substring(key, 1, 8), 16, 10).cast("long")
    return F.expr("cast(0 as long)") if n <= 1 else F.floor(head * F.lit(n) / F.lit(1 << 32)).cast("long")


def bucket_count(rows: int) -> int:
    """Square root of the rows: as many buckets in a key as rows in a bucket."""
    return max(1, int(rows ** 0.5) + 1)


def running_start(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: Column, out: str,
                  buckets: int, key: str = "_key") -> DataFrame:
    """``out`` = sum of ``value`` over the earlier rows of the same ``keys``.

    Rows are ordered by the hex column ``key`` and then by ``order``. A key's rows are
    never gathered: they are dealt to range buckets of the hex key, each bucket's total
    is taken first, and a window runs inside (keys, bucket) only. ``keys`` must hold no
    nulls.
    """
    b = df.withColumn("_rb", key_bucket(F.col(key), buckets)).withColumn("_rv", value.cast("long"))
    per = b.groupBy(*keys, "_rb").agg(F.sum("_rv").alias("_rs"))
    before = Window.partitionBy(*keys).orderBy("_rb").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(*keys, "_rb", F.coalesce(F.sum("_rs").over(before), F.lit(0)).alias("_ro"))
    inside = (Window.partitionBy(*keys, "_rb").orderBy(key, *order)
              .rowsBetween(Window.unboundedPreceding, -1))
    joined = b.join(per, [*keys, "_rb"])
    return (joined.withColumn(out, F.col("_ro") + F.coalesce(F.sum("_rv").over(inside), F.lit(0)))
            .drop("_rb", "_rv", "_ro"))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, sample: int, seed: int,
                    use: Column | None = None) -> tuple[DataFrame, dict[int, int]]:
    """(key, y, text) of at most ``sample`` labelled rows of each class, and the classes' sizes.

    The rows with the smallest seeded keys are chosen by id alone; the chosen ids (bounded
    by ``sample``) go to the texts, so no other text moves.
    """
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("y")).where("y in (0, 1)")
    rows = docs if use is None else docs.where(use)
    ids = rows.select(F.col(id_col).alias("_id")).join(known, "_id").withColumn("key", seeded_key("_id", seed))
    sizes = {r["y"]: r["n"] for r in ids.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    picked = [ids.where(F.col("y") == y).orderBy("key").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(picked[0].unionByName(picked[1]).distinct())
    texts = rows.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("text")).join(chosen, "_id")
    return texts.select("key", "y", "text"), sizes
