"""Sharding by vector bin packing: bytes, tokens and rows are balanced jointly.

Rows with equal texts form a group with a weight vector (bytes, tokens, rows), each as a
share of the whole table. A group goes to the shard where the dot product of its vector
with the shard's residual capacity is highest among the shards it fits into; where it
fits nowhere, the shard with most bytes left takes it, so bytes stay nearest to equal
(law ``bytes``).

Groups above ``1 / (n_shards * fine)`` of the whole in some dimension are few (at most
``3 * n_shards * fine`` of them, whatever the table) and are placed first, in one list;
one that exceeds a shard's whole capacity is split into equal parts by row number. All
others are dealt by their hash to cells of about ``cell_groups`` groups. Each cell places
its own groups, largest first, into its part of the capacity that the heavy groups left,
so no task and no driver list grows with the table.

Defined results: null text has 0 bytes and, like every text, one byte is added to the
size; equal rows are separate rows of one group; an empty table gives an empty frame.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import as_bytes, bucket_count, cut, map_rows, running_start, seeded_key


def text_vectors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, size, tokens, text_crc32, text_hash): the weight vector and group of each row."""
    def digest(batch: pa.RecordBatch, _):
        texts = [t or b"" for t in as_bytes(batch, 1)]
        return [batch.column(0), [len(t) + 1 for t in texts], [len(t.split()) for t in texts],
                [zlib.crc32(t) for t in texts],
                np.array([xxhash.xxh3_64_intdigest(t) for t in texts], dtype=np.uint64).view(np.int64).tolist()]

    t = docs.schema[id_col].dataType.simpleString()
    return map_rows(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), digest,
                    f"doc_id {t}, size long, tokens long, text_crc32 long, text_hash long")


def pack(weights: np.ndarray, residual: np.ndarray) -> np.ndarray:
    """Shard of each weight vector; ``residual`` (shards x dimensions) is used up in place.

    Most bytes (first dimension) first. Among shards that the vector fits into, the highest
    dot product with the residual capacity; else the most bytes left.
    """
    chosen = np.zeros(len(weights), dtype=np.int64)
    order = np.lexsort((np.arange(len(weights)), -weights[:, 0])) if len(weights) else []
    for i in order:
        w = weights[i]
        fits = (residual >= w).all(axis=1)
        s = int(np.where(fits, residual @ w, -np.inf).argmax()) if fits.any() else int(residual[:, 0].argmax())
        chosen[i] = s
        residual[s] -= w
    return chosen


def vector_shards(docs: DataFrame, n_shards: int = 16, id_col: str = "doc_id", text_col: str = "text",
                  fine: int = 64, cell_groups: int = 2000, seed: int = 29) -> DataFrame:
    """One row per document: doc_id, size, tokens, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    group = ["text_hash", "text_crc32", "size"]
    slim = cut(text_vectors(docs, id_col, text_col).withColumn("_key", seeded_key("doc_id", seed)))
    total = slim.agg(F.sum("size").alias("b"), F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("r")).first()
    whole = np.array([max(1, total["b"] or 0), max(1, total["t"] or 0), max(1, total["r"])], dtype=float)
    groups = slim.groupBy(*group).agg(F.sum("size").alias("gb"), F.sum("tokens").alias("gt"), F.count(F.lit(1)).alias("gr"))
    share = [F.col(c) / F.lit(float(w)) for c, w in zip(("gb", "gt", "gr"), whole, strict=True)]
    groups = cut(groups.withColumn("_top", F.greatest(*share)))
    n_groups = groups.count()
    limit = 1.0 / (n_shards * fine)

    # heavy groups: at most 3 * n_shards * fine rows, since each holds that share of a dimension
    heavy = sorted(groups.where(F.col("_top") > limit).collect(), key=lambda r: (-r["_top"], r["text_hash"], r["text_crc32"]))
    items, owner = [], []
    for g, r in enumerate(heavy):
        parts = max(1, min(int(np.ceil(r["_top"] * n_shards)), r["gr"]))
        for k in range(parts):
            n = r["gr"] * (k + 1) // parts - r["gr"] * k // parts
            items.append(np.array([r["gb"], r["gt"], r["gr"]], dtype=float) * n / r["gr"] / whole)
            owner.append((g, k, parts))
    residual = np.full((n_shards, 3), 1.0 / n_shards)
    placed = pack(np.array(items).reshape(-1, 3), residual)
    left = np.clip(residual, 0.0, None)
    spare = left / np.where(left.sum(axis=0) > 0, left.sum(axis=0), 1.0)
    spare[:, left.sum(axis=0) <= 0] = 1.0 / n_shards

    cells = max(1, -(-n_groups // cell_groups))
    columns = [*group, "gb", "gt", "gr"]

    def place(pdf: pd.DataFrame, cell: int) -> pd.DataFrame:
        pdf = pdf.sort_values(group, kind="stable")
        w = pdf[["gb", "gt", "gr"]].to_numpy(dtype=float)
        mine = w.sum(axis=0)
        w = w / np.where(mine > 0, mine, 1.0)
        turn = int(cell) % n_shards  # cells begin at different shards, so ties don't add up in one
        return pdf[group].assign(shard=((pack(w, np.roll(spare, turn, axis=0)) - turn) % n_shards).astype("int32"))

    light = (groups.where(F.col("_top") <= limit).select(*columns, F.pmod("text_hash", F.lit(cells)).alias("_cell"))
             .groupBy("_cell").applyInPandas(lambda key, pdf: place(pdf[columns], key[0]),
                                             "text_hash long, text_crc32 long, size long, shard int"))
    marks = spark.createDataFrame(
        [(heavy[g]["text_hash"], heavy[g]["text_crc32"], heavy[g]["size"], heavy[g]["gr"], k, parts, int(s))
         for (g, k, parts), s in zip(owner, placed, strict=True)],
        "text_hash long, text_crc32 long, size long, gr long, part int, parts int, shard int")
    buckets = bucket_count(total["r"])
    # rows of heavy groups are numbered inside their group; the table of heavy groups is bounded
    own = slim.join(F.broadcast(marks.select(*group, "gr", "parts").distinct()), group)
    own = running_start(own, group, [], F.lit(1), "_n", buckets)
    own = own.withColumn("part", _part_of("_n", "gr", "parts"))
    own = own.join(F.broadcast(marks.select(*group, "part", "shard")), [*group, "part"])
    keep = ["doc_id", "size", "tokens", "text_crc32", "_key", "shard"]
    rest = slim.join(light, group)
    placed_rows = cut(own.select(*keep).unionByName(rest.select(*keep)))
    numbered = running_start(placed_rows, ["shard"], ["doc_id", "text_crc32", "size"], F.lit(1), "slot", buckets)
    return numbered.select("doc_id", "size", "tokens", "text_crc32", F.lit("bytes").alias("law"), "shard",
                           F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def _part_of(n: str, rows: str, parts: str):
    """Part k holds the rows from rows * k // parts to rows * (k + 1) // parts - 1."""
    return F.expr(f"cast(((cast({n} as long) + 1) * {parts} - 1) div {rows} as int)")


def shard_report(placed: DataFrame) -> DataFrame:
    """Bytes, tokens and rows of each shard."""
    return placed.groupBy("shard").agg(F.sum("size").alias("bytes"), F.sum("tokens").alias("tokens"),
                                       F.count(F.lit(1)).alias("rows"))
