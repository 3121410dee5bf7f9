"""Term statistics: document terms, vocabulary, count vectors, hashing TF, TF-IDF.

Long form throughout: (doc, term, tf) rows. Aggregations are partial (map-side
combine), so a hot term costs one row per map task before the shuffle. Joins of the
big term rows with per-term tables are plain equi-joins: AQE turns them into
broadcast joins when the per-term side is small at run time and splits skewed
partitions otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quarry.functions.hashing import hash_bucket


def document_terms(df: DataFrame, id: str = "doc_id", words: str = "words",
                   carry: Sequence[str] = (), out: str = "term") -> DataFrame:
    """(id, *carry, term, tf): occurrences of each term in each document (F11 long form)."""
    from quarry.operators.text import explode_rows
    return (explode_rows(df, [id, *carry], F.col(words), out)
            .groupBy(id, *carry, out).agg(F.count(F.lit(1)).alias("tf")))


def document_frequency(terms: DataFrame, term: str = "term") -> DataFrame:
    """(term, df): number of documents containing each term.

    Counts the ``tf`` column rather than rows so the (doc, term) aggregation below stays
    identical to the one that produced ``terms``; Spark then reuses that shuffle
    instead of running the text chain a second time.
    """
    return terms.groupBy(term).agg(F.count(F.when(F.col("tf") > 0, True)).alias("df"))


def tf_idf(terms: DataFrame, n_docs: int, term: str = "term", min_doc_freq: int = 0) -> DataFrame:
    """Adds df, idf = ln((m+1)/(df+1)) (0 below ``min_doc_freq``) and tfidf = tf*idf."""
    dfreq = document_frequency(terms, term)
    idf = F.when(F.col("df") >= min_doc_freq,
                 F.log((F.lit(float(n_docs)) + 1.0) / (F.col("df") + 1.0))).otherwise(F.lit(0.0))
    return (terms.join(dfreq, term)
            .withColumn("idf", idf)
            .withColumn("tfidf", F.col("tf") * F.col("idf")))


def top_terms(weighted: DataFrame, k: int, id: str = "doc_id", weight: str = "tfidf",
              term: str = "term", out: str = "rank") -> DataFrame:
    """Top-k terms per document by weight, ties by term.

    ``row_number() <= k`` lets Spark insert a per-partition group limit before the
    shuffle, so only k rows per document and map task move.
    """
    w = Window.partitionBy(id).orderBy(F.col(weight).desc(), F.col(term))
    return weighted.withColumn(out, F.row_number().over(w)).filter(F.col(out) <= k)


def vocabulary(terms: DataFrame, vocab_size: int | None = None, min_df: float = 1.0,
               n_docs: int | None = None, term: str = "term") -> DataFrame:
    """(term_index, term, term_count, doc_freq): the count-vector vocabulary.

    Terms in at least ``min_df`` documents (a fraction of ``n_docs`` when below 1), all of
    them or the ``vocab_size`` most frequent by corpus count, ties by term; index 0 is the
    most frequent. Terms are numbered by an exact distributed global index, so no task
    merges the vocabulary.
    """
    stats = terms.groupBy(term).agg(F.sum("tf").alias("term_count"),
                                    F.count(F.when(F.col("tf") > 0, True)).alias("doc_freq"))
    if min_df < 1.0:
        if n_docs is None:
            raise ValueError("fractional min_df needs n_docs")
        min_df = min_df * n_docs
    kept = stats.filter(F.col("doc_freq") >= F.lit(min_df))
    order = [F.col("term_count").desc(), F.col(term)]
    from quarry.operators.ranking import global_index
    numbered = global_index(kept, order, "term_index")
    if vocab_size is not None:
        numbered = numbered.filter(F.col("term_index") < vocab_size)
    return numbered.select(F.col("term_index").cast("int").alias("term_index"), term, "term_count", "doc_freq")


def count_terms(terms: DataFrame, vocab: DataFrame, term: str = "term") -> DataFrame:
    """Count-vector entries in long form: (id, term_index, term, tf) for vocabulary terms."""
    return terms.join(vocab.select("term_index", term), term)


def hashing_tf(df: DataFrame, id: str = "doc_id", words: str = "words", num_features: int = 1 << 18,
               carry: Sequence[str] = (), mode: str = "md5") -> DataFrame:
    """Hashed term counts.

    ``mode="md5"``: long form (id, bucket, tf) with portable md5 buckets (the same in SQL).
    ``mode="murmur3"``: Spark's ``HashingTF`` vector column ``tf`` for model pipelines.
    """
    if mode == "murmur3":
        return hashing_tf_vectors(df, words, "tf", num_features)
    if mode != "md5":
        raise ValueError(f"unknown mode {mode!r}")
    from quarry.operators.text import explode_rows
    return (explode_rows(df, [id, *carry], F.col(words), "_t")
            .withColumn("bucket", hash_bucket("_t", num_features).cast("int"))
            .groupBy(id, *carry, "bucket").agg(F.count(F.lit(1)).alias("tf")))


def hashing_tf_vectors(df: DataFrame, words: str = "words", out: str = "tf",
                       num_features: int = 1 << 18, binary: bool = False) -> DataFrame:
    """Spark's murmur3 ``HashingTF`` (vector column) for model pipelines."""
    from pyspark.ml.feature import HashingTF
    return HashingTF(inputCol=words, outputCol=out, numFeatures=num_features,
                     binary=binary).transform(df)
