"""Text operators: line split, cleanse, tokenize, stop words, explode, stem, unite, verses.

Two lanes share the same column expressions:

* **array lane** (``document_line_words``, ``text_verses``): one document stays one row;
  lines, words and verses are arrays inside it. Narrow projection, no shuffle, and a
  hot document never lands on a task of its own beyond the row it already is.
* **row lane** (``split_lines`` ... ``build_verses``): one row per line or per word, for
  callers that hold rows. Groupings there are bounded by one line or one verse.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import stemming as st
from quarry.functions import text as tf



def _is_array(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, T.ArrayType)


def explode_rows(df: DataFrame, keep, arr, out: str, pos: str | None = None) -> DataFrame:
    """explode / posexplode that keeps Catalyst from copying ``arr`` into a pushed-down filter.

    A plain ``explode`` makes the optimizer infer ``size(arr) > 0`` and push it below
    the projection, so an expensive ``arr`` (the whole text chain) would be computed
    twice, once before any exchange. The outer form infers nothing; rows of empty
    arrays, and null elements, are dropped by a filter on the generated column instead.
    """
    if pos is None:
        g = df.select(*keep, F.explode_outer(arr).alias(out))
        return g.filter(F.col(out).isNotNull())
    g = df.select(*keep, F.posexplode_outer(arr).alias("_p", out))
    return g.filter(F.col(out).isNotNull()).withColumn(pos, (F.col("_p") + 1).cast("int")).drop("_p")


# --- row-lane operators ------------------------------------------------------------

def split_lines(df: DataFrame, text: str = "text", out: str = "line", pos: str = "line_no",
                reader_filter: bool = True, keep: Sequence[str] | None = None) -> DataFrame:
    """One row per line with its 1-based number inside the text.

    With ``reader_filter`` empty lines and lines without a space are dropped first (P2, P3)
    and the remaining lines are numbered 1..n in text order - the number is the line's
    position, so no window or shuffle is needed.
    """
    arr = tf.nonempty_multiword_lines(text) if reader_filter else tf.lines(text)
    cols = [c for c in df.columns if c != text] if keep is None else list(keep)
    return explode_rows(df, cols, arr, out, pos)


def keep_nonempty(df: DataFrame, c: str = "value") -> DataFrame:
    """Rows whose text is not empty."""
    return df.filter(F.col(c) != "")


def keep_multiword(df: DataFrame, c: str = "value") -> DataFrame:
    """Rows whose text contains a space."""
    return df.filter(F.col(c).contains(" "))


def number_lines(df: DataFrame, by: str, order: str, out: str = "line_no",
                 bucket_size: int = 4096) -> DataFrame:
    """Row number per ``by`` in ``order`` (W1) for rows that are already one per line.

    Prefer :func:`split_lines`, which numbers lines of a text for free. For row input,
    a plain window over ``by`` would put a hot file (a third of all lines) into one
    task, so numbering is a two-level prefix count instead:
    rows are cut into position buckets of ``bucket_size`` (numeric ``order``); a row's
    number is the rows of earlier buckets of its file (a prefix over the small per-bucket
    counts, pre-aggregated before any shuffle) plus its rank inside its bucket
    (a window over at most ``bucket_size`` positions).
    """
    b = F.floor(F.col(order) / F.lit(bucket_size))
    d = df.withColumn("_b", b)
    counts = d.groupBy(by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(
        Window.partitionBy(by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    inner = F.row_number().over(Window.partitionBy(by, "_b").orderBy(order))
    # null keys and null positions are keys of their own: rows are numbered, not dropped
    right = before.select(F.col(by).alias("_k"), F.col("_b").alias("_kb"), "_before")
    match = F.col(by).eqNullSafe(F.col("_k")) & F.col("_b").eqNullSafe(F.col("_kb"))
    return (d.withColumn("_r", inner).join(right, match).drop("_k", "_kb")
            .withColumn(out, (F.col("_before") + F.col("_r")).cast("int")).drop("_b", "_r", "_before"))


def number_words(df: DataFrame, by: str, line: str, pos: str, out: str = "word_no") -> DataFrame:
    """Consecutive numbers per ``by`` over word rows in the order (line, pos).

    A line is a bucket: the words of each line are counted first, a prefix over the lines
    gives what lies before a line, and the number is that plus the rank in the line.
    """
    counts = df.groupBy(by, line).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(by).orderBy(line).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(by).alias("_k"), F.col(line).alias("_kl"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    rank = F.row_number().over(Window.partitionBy(by, line).orderBy(pos))
    match = F.col(by).eqNullSafe(F.col("_k")) & F.col(line).eqNullSafe(F.col("_kl"))
    return (df.withColumn("_r", rank).join(before, match)
            .withColumn(out, F.col("_before") + F.col("_r")).drop("_k", "_kl", "_before", "_r"))


def cleanse_text(df: DataFrame, c: str = "line", out: str = "clean") -> DataFrame:
    """Trim, strip punctuation and non-ASCII letters, collapse whitespace."""
    return df.withColumn(out, tf.cleanse(c))


def tokenize(df: DataFrame, c: str = "clean", out: str = "words") -> DataFrame:
    """Lower-case and split on whitespace, dropping empty tokens."""
    return df.withColumn(out, tf.tokens(c))


def remove_stop_words(df: DataFrame, c: str = "words", out: str = "filtered",
                      words: Sequence[str] = tf.ENGLISH_STOP_WORDS) -> DataFrame:
    """Drop stop words, keep order and duplicates."""
    return df.withColumn(out, tf.drop_stop_words(c, words))


def explode_words(df: DataFrame, c: str = "filtered", out: str = "word",
                  pos: str = "word_pos") -> DataFrame:
    """One row per word with its 1-based position; empty arrays give no rows (T4)."""
    cols = [x for x in df.columns if x != c]
    return explode_rows(df, cols, F.col(c), out, pos)


def stem_column(c, mode: str = "s", is_array: bool = True) -> Column:
    """Stem a word or an array of words. ``s``: plural stemmer; ``porter2``: English Snowball."""
    col = F.col(c) if isinstance(c, str) else c
    if mode == "s":
        return F.transform(col, tf.s_stem) if is_array else tf.s_stem(col)
    if mode == "porter2":
        return F.transform(col, st.stem) if is_array else st.stem(col)
    if mode in (None, "none"):
        return col
    raise ValueError(f"unknown stem mode {mode!r}")


def stem_words(df: DataFrame, c: str = "word", out: str = "stem", mode: str = "s", distinct: bool = False) -> DataFrame:
    """Stem a word column or a word-array column (T5).

    With ``porter2`` a word column goes through the table of its distinct words, each
    stemmed once and joined back; ``distinct`` says that the rows are such a table.
    """
    if mode != "porter2" or _is_array(df, c):
        return df.withColumn(out, stem_column(c, mode, _is_array(df, c)))
    if distinct:
        return st.stem_projection(df, c, out)
    table = st.stem_projection(df.select(F.col(c).alias("_word")).filter(F.col("_word").isNotNull()).distinct(), "_word", out)
    return df.join(table, F.col(c) == F.col("_word"), "left").drop("_word")


def unite_sentence(df: DataFrame, keys: Sequence[str] = ("doc_id", "line_no"),
                   word: str = "word", pos: str = "word_pos", out: str = "sentence",
                   carry: Sequence[str] = ()) -> DataFrame:
    """Join the words of one line back into a sentence, in word order.

    Row lane: groups by the line key; a group holds one line's words.
    """
    aggs = [F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(pos, word))),
                                     lambda x: x[word]), " ").alias(out)]
    aggs += [F.min_by(c, pos).alias(c) for c in carry]
    return df.groupBy(*keys).agg(*aggs)


def verse_ids(line_no, n: int) -> Column:
    """``floor((line_no - 1) / n) + 1``; gaps in line numbers do not shift ids."""
    ln = F.col(line_no) if isinstance(line_no, str) else line_no
    return (F.floor((ln - 1) / F.lit(n)) + 1).cast("int")


def build_verses(df: DataFrame, n: int = 1, id: str = "doc_id", line_no: str = "line_no",
                 words: str = "filtered", label: str | None = "label",
                 out: str = "verse") -> DataFrame:
    """Row lane verses (T7, A5): lines with words -> one row per (id, verse_id).

    Lines with no words are left out (as the word explode drops them); verse words are
    the words of its lines in line order; label is the label of its first line.
    """
    src = df.filter(F.size(words) > 0).withColumn("verse_id", verse_ids(line_no, n))
    aggs = [F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(line_no, words))),
                                  lambda x: x[words])).alias(out)]
    if label:
        aggs.append(F.min_by(label, line_no).alias(label))
    return src.groupBy(id, "verse_id").agg(*aggs)


def ngrams(df: DataFrame, c: str = "filtered", out: str = "ngrams", n: int = 2) -> DataFrame:
    """Word n-grams."""
    return df.withColumn(out, tf.ngrams(c, n))


def verse_text(df: DataFrame, c: str = "verse", out: str = "verse_text") -> DataFrame:
    """Verse words as one display string."""
    return df.withColumn(out, F.array_join(c, " "))


# --- array lane --------------------------------------------------------------------

def line_word_arrays(text, stop_words: Sequence[str] | None = tf.ENGLISH_STOP_WORDS,
                     stem: str | None = None, reader_filter: bool = True) -> Column:
    """array<array<string>>: per kept line, its cleaned tokens without stop words, stemmed."""
    arr = tf.nonempty_multiword_lines(text) if reader_filter else tf.lines(text)

    lw = F.transform(arr, lambda l: tf.clean_tokens(l, stop_words))
    if stem and stem != "none":
        if stem == "s":
            lw = F.transform(lw, lambda ws: F.transform(ws, tf.s_stem))
        else:
            lw = F.transform(lw, lambda ws: stem_column(ws, stem, True))
    return lw


def document_words(text, stop_words=tf.ENGLISH_STOP_WORDS, stem=None, multiword_lines: bool = False) -> Column:
    """All kept words of a document in order (equals the flattened line words)."""
    w = tf.document_tokens(text, stop_words, multiword_lines)
    if stem and stem != "none":
        w = stem_column(w, stem, True)
    return w


def text_verses(df: DataFrame, n: int = 1, id: str = "doc_id", text: str = "text",
                label: str | None = None, stop_words=tf.ENGLISH_STOP_WORDS, stem: str | None = None,
                out: str = "verse", carry: Sequence[str] = (), multiword_lines: bool = True) -> DataFrame:
    """Array lane T1..T7: a document row becomes its verses, with no shuffle.

    Equals ``split_lines -> cleanse -> tokenize -> remove_stop_words -> build_verses``.
    ``label`` and ``carry`` columns are kept on every verse.
    """
    lw = line_word_arrays(text, stop_words, stem, multiword_lines)
    extra = ([label] if label else []) + [c for c in carry if c != label]
    keep = [id] + extra
    staged = df.select(*keep, lw.alias("_lw"))
    nv = F.ceil(F.size("_lw") / F.lit(n)).cast("int")
    verses = F.when(F.size("_lw") > 0,
                    F.transform(F.sequence(F.lit(1), F.greatest(nv, F.lit(1))),
                                lambda v: F.flatten(F.slice(F.col("_lw"), (v - 1) * n + 1, n)))
                    ).otherwise(F.array().cast("array<array<string>>"))
    v = explode_rows(staged, keep, verses, out, "verse_id")
    return v.filter(F.size(out) > 0).select(id, "verse_id", *extra, out)
