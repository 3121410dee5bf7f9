"""Reproducible splits, samples, folds, union and set difference.

Random splits in Spark depend on partitioning; these use a hash of a key instead, so
every row lands in the same part on any cluster, after retries and repartitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_fraction, seeded_hash

# The seeds of the original jobs' split and sample.
SPLIT_SEED = 42
SAMPLE_SEED = 0
FOLD_SEED = 1   # independent of the split, so folds stay level after it


def hash_split(df: DataFrame, key: str, weights: Sequence[float] = (0.8, 0.2),
               names: Sequence[str] = ("train", "test"), out: str = "split", seed: int = SPLIT_SEED) -> DataFrame:
    """Label each row with a part name by its key's 32-bit hash against the cumulative weights."""
    total = float(sum(weights))
    expr, acc = F.lit(names[-1]), 0.0
    conds = []
    for w, n in zip(weights[:-1], names[:-1], strict=True):
        acc += w / total
        conds.append((hash_fraction(key, seed, acc), n))
    for cond, n in reversed(conds):
        expr = F.when(cond, F.lit(n)).otherwise(expr)
    return df.withColumn(out, expr)


def split_parts(df: DataFrame, key: str, weights=(0.8, 0.2), seed: int = SPLIT_SEED) -> list[DataFrame]:
    """``randomSplit``-like list of frames, one per weight, from :func:`hash_split`."""
    names = [f"p{i}" for i in range(len(weights))]
    s = hash_split(df, key, weights, names, "_part", seed)
    return [s.filter(F.col("_part") == n).drop("_part") for n in names]


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = SAMPLE_SEED) -> DataFrame:
    """Bernoulli-like sample without replacement, fixed by the key's hash (R2)."""
    return df.filter(hash_fraction(key, seed, fraction))


def assign_folds(df: DataFrame, key: str, k: int, out: str = "fold", seed: int = FOLD_SEED) -> DataFrame:
    """Fold number 0..k-1 by key hash; rows of one key (one document) share a fold."""
    return df.withColumn(out, F.pmod(seeded_hash(key, seed), F.lit(k)).cast("int"))


def row_key(cols: Sequence[str]):
    """A string key over several columns (for hashing rows that have no key)."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("␀")) for c in cols])


def union_labeled(parts: dict) -> DataFrame:
    """UNION ALL of per-class frames, each given a constant ``label``."""
    out = None
    for label, frame in parts.items():
        f = frame.withColumn("label", F.lit(label) if label is not None else F.lit(None).cast("string"))
        out = f if out is None else out.unionByName(f, allowMissingColumns=True)
    return out


def holdout_complement(full: DataFrame, part: DataFrame) -> DataFrame:
    """Rows of ``full`` that equal no row of ``part`` (null-safe, whole row); all equal copies go.

    A left-anti equi-join on every column. The right side only has to prove existence,
    so it is de-duplicated first: a row repeated across a third of the table collapses
    to one row per map task (partial aggregation) before its shuffle. On the left, AQE
    splits a partition that a hot row makes large.
    """
    right = part.select(*full.columns).dropDuplicates()
    cond = [full[c].eqNullSafe(right[c]) for c in full.columns]
    return full.join(right, cond, "left_anti")
