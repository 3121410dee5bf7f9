"""Pipeline stages: the text chain as persistable ``Transformer``s.

Each stage wraps the column expressions of ``quarry.operators.text`` so it can sit in
a ``Pipeline``, be tuned (``sentencesInVerse`` is a grid parameter), saved and loaded.
"""

from __future__ import annotations

from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.functions import text as tf
from quarry.functions.hashing import hash_bucket
from quarry.operators import encoders as en
from quarry.operators import filters as fl
from quarry.operators import text as tx


class VerseSplitter(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(id, text, label...) -> one row per verse: (id, verse_id, label..., verse array<string>).

    Array lane: cleanse, tokenize, drop stop words, optionally stem and group
    ``sentencesInVerse`` kept lines per verse inside each document row (no shuffle).
    """

    idCol = Param(Params._dummy(), "idCol", "document id column", TypeConverters.toString)
    textCol = Param(Params._dummy(), "textCol", "document text column", TypeConverters.toString)
    carryCols = Param(Params._dummy(), "carryCols", "columns kept per verse", TypeConverters.toListString)
    outputCol = Param(Params._dummy(), "outputCol", "verse words column", TypeConverters.toString)
    sentencesInVerse = Param(Params._dummy(), "sentencesInVerse", "lines per verse", TypeConverters.toInt)
    stem = Param(Params._dummy(), "stem", "none, s or porter2", TypeConverters.toString)
    removeStopWords = Param(Params._dummy(), "removeStopWords", "drop English stop words",
                            TypeConverters.toBoolean)
    multiwordLines = Param(Params._dummy(), "multiwordLines", "only lines with a space, as the text reader keeps",
                           TypeConverters.toBoolean)

    def __init__(self, idCol="doc_id", textCol="text", carryCols=("label",), outputCol="verse",
                 sentencesInVerse=1, stem="none", removeStopWords=True, multiwordLines=True):
        super().__init__()
        self._setDefault(idCol="doc_id", textCol="text", carryCols=["label"], outputCol="verse",
                         sentencesInVerse=1, stem="none", removeStopWords=True, multiwordLines=True)
        self._set(idCol=idCol, textCol=textCol, carryCols=list(carryCols), outputCol=outputCol,
                  sentencesInVerse=sentencesInVerse, stem=stem, removeStopWords=removeStopWords,
                  multiwordLines=multiwordLines)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        carry = [c for c in g(self.carryCols) if c in df.columns]
        stop = tf.ENGLISH_STOP_WORDS if g(self.removeStopWords) else None
        return tx.text_verses(df, n=g(self.sentencesInVerse), id=g(self.idCol), text=g(self.textCol),
                              stop_words=stop, stem=g(self.stem), out=g(self.outputCol), carry=carry,
                              multiword_lines=g(self.multiwordLines))


class DocumentWords(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(text) -> words array: the whole document as one bag (all lines, cleaned, no stop words)."""

    textCol = Param(Params._dummy(), "textCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "words column", TypeConverters.toString)
    stem = Param(Params._dummy(), "stem", "none, s or porter2", TypeConverters.toString)

    def __init__(self, textCol="text", outputCol="words", stem="none"):
        super().__init__()
        self._setDefault(textCol="text", outputCol="words", stem="none")
        self._set(textCol=textCol, outputCol=outputCol, stem=stem)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return df.withColumn(g(self.outputCol), tx.document_words(g(self.textCol), stem=g(self.stem)))


class PlainWords(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(text) -> words array: tokens of the whole text without stop words; letters of any language stay."""

    textCol = Param(Params._dummy(), "textCol", "text column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "words column", TypeConverters.toString)

    def __init__(self, textCol="text", outputCol="words"):
        super().__init__()
        self._setDefault(textCol="text", outputCol="words")
        self._set(textCol=textCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return df.withColumn(g(self.outputCol), tf.drop_stop_words(tf.tokens(g(self.textCol))))


class BucketWords(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(words) -> the portable hash bucket of every word, as text."""

    inputCol = Param(Params._dummy(), "inputCol", "array of words", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "bucket array column", TypeConverters.toString)
    numFeatures = Param(Params._dummy(), "numFeatures", "number of buckets", TypeConverters.toInt)

    def __init__(self, inputCol="words", outputCol="buckets", numFeatures=4096):
        super().__init__()
        self._setDefault(inputCol="words", outputCol="buckets", numFeatures=4096)
        self._set(inputCol=inputCol, outputCol=outputCol, numFeatures=numFeatures)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        n = g(self.numFeatures)
        return df.withColumn(g(self.outputCol), F.transform(g(self.inputCol), lambda w: hash_bucket(w, n).cast("string")))


class TextStep(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """One step of the text chain over a column: ``cleanse``, ``tokens``, ``stop_words``, ``s_stem`` or ``unite``.

    ``cleanse`` and ``tokens`` take text, the others an array of words; ``unite`` joins it
    with spaces.
    """

    step = Param(Params._dummy(), "step", "name of the step", TypeConverters.toString)
    inputCol = Param(Params._dummy(), "inputCol", "input column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "output column", TypeConverters.toString)

    def __init__(self, step="cleanse", inputCol="text", outputCol="clean"):
        super().__init__()
        self._setDefault(step="cleanse", inputCol="text", outputCol="clean")
        self._set(step=step, inputCol=inputCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        c = F.col(g(self.inputCol))
        made = {"cleanse": lambda: tf.cleanse(c), "tokens": lambda: tf.tokens(c), "stop_words": lambda: tf.drop_stop_words(c),
                "s_stem": lambda: F.transform(c, tf.s_stem), "unite": lambda: F.array_join(c, " ")}
        return df.withColumn(g(self.outputCol), made[g(self.step)]())


class LineNumberer(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Consecutive numbers of rows within ``idCol`` in the order of ``orderCol``."""

    idCol = Param(Params._dummy(), "idCol", "document id column", TypeConverters.toString)
    orderCol = Param(Params._dummy(), "orderCol", "position column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "number column", TypeConverters.toString)

    def __init__(self, idCol="id", orderCol="pos", outputCol="line_no"):
        super().__init__()
        self._setDefault(idCol="id", orderCol="pos", outputCol="line_no")
        self._set(idCol=idCol, orderCol=orderCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return tx.number_lines(df, g(self.idCol), g(self.orderCol), g(self.outputCol))


class WordExploder(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A row per word, with its position (T4); all other columns are kept."""

    inputCol = Param(Params._dummy(), "inputCol", "array of words", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "word column", TypeConverters.toString)
    positionCol = Param(Params._dummy(), "positionCol", "position column", TypeConverters.toString)

    def __init__(self, inputCol="words", outputCol="word", positionCol="word_pos"):
        super().__init__()
        self._setDefault(inputCol="words", outputCol="word", positionCol="word_pos")
        self._set(inputCol=inputCol, outputCol=outputCol, positionCol=positionCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        keep = [c for c in df.columns if c != g(self.inputCol)]
        return tx.explode_rows(df, keep, F.col(g(self.inputCol)), g(self.outputCol), g(self.positionCol))


class RegressionExamples(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(label, number, level, category, ...) -> label and [number, level code, one-hot slots]."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    numericCol = Param(Params._dummy(), "numericCol", "numeric column", TypeConverters.toString)
    levelCol = Param(Params._dummy(), "levelCol", "level column", TypeConverters.toString)
    levelNames = Param(Params._dummy(), "levelNames", "known levels", TypeConverters.toListString)
    levelCodes = Param(Params._dummy(), "levelCodes", "code of each known level", TypeConverters.toListFloat)
    categoryCol = Param(Params._dummy(), "categoryCol", "category column", TypeConverters.toString)
    categories = Param(Params._dummy(), "categories", "known categories, in order of their slots", TypeConverters.toListString)
    otherSlot = Param(Params._dummy(), "otherSlot", "slot of other categories; -1: one after the known ones", TypeConverters.toInt)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    def __init__(self, labelCol="label", numericCol="number", levelCol="level", levelNames=(), levelCodes=(), categoryCol="category",
                 categories=(), otherSlot=-1, outputCol="features"):
        super().__init__()
        self._setDefault(labelCol="label", numericCol="number", levelCol="level", levelNames=[], levelCodes=[], categoryCol="category",
                         categories=[], otherSlot=-1, outputCol="features")
        self._set(labelCol=labelCol, numericCol=numericCol, levelCol=levelCol, levelNames=list(levelNames), levelCodes=list(levelCodes),
                  categoryCol=categoryCol, categories=list(categories), otherSlot=otherSlot, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        levels = dict(zip(g(self.levelNames), g(self.levelCodes), strict=True))
        return en.regression_examples(df, g(self.labelCol), g(self.numericCol), g(self.levelCol), levels, g(self.categoryCol), g(self.categories),
                                      g(self.outputCol), other=None if g(self.otherSlot) < 0 else g(self.otherSlot))


class ClusteringExamples(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """(value, number, level, ...) -> dense [value, number, level code]."""

    valueCol = Param(Params._dummy(), "valueCol", "value column", TypeConverters.toString)
    numericCol = Param(Params._dummy(), "numericCol", "numeric column", TypeConverters.toString)
    levelCol = Param(Params._dummy(), "levelCol", "level column", TypeConverters.toString)
    levelNames = Param(Params._dummy(), "levelNames", "known levels", TypeConverters.toListString)
    levelCodes = Param(Params._dummy(), "levelCodes", "code of each known level", TypeConverters.toListFloat)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    def __init__(self, valueCol="value", numericCol="number", levelCol="level", levelNames=(), levelCodes=(), outputCol="features"):
        super().__init__()
        self._setDefault(valueCol="value", numericCol="number", levelCol="level", levelNames=[], levelCodes=[], outputCol="features")
        self._set(valueCol=valueCol, numericCol=numericCol, levelCol=levelCol, levelNames=list(levelNames), levelCodes=list(levelCodes), outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        levels = dict(zip(g(self.levelNames), g(self.levelCodes), strict=True))
        return en.clustering_examples(df, g(self.valueCol), g(self.numericCol), g(self.levelCol), levels, g(self.outputCol))


class WideExamples(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Many numeric columns -> one vector; the others are kept."""

    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    outputCol = Param(Params._dummy(), "outputCol", "feature vector column", TypeConverters.toString)

    def __init__(self, inputCols=(), labelCol="label", outputCol="features"):
        super().__init__()
        self._setDefault(inputCols=[], labelCol="label", outputCol="features")
        self._set(inputCols=list(inputCols), labelCol=labelCol, outputCol=outputCol)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return en.wide_examples(df, g(self.inputCols), g(self.labelCol), g(self.outputCol))


class Labeler(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """A constant label, and an id where ``idCol`` is given, for rows of unknown class."""

    labelCol = Param(Params._dummy(), "labelCol", "label column", TypeConverters.toString)
    labelValue = Param(Params._dummy(), "labelValue", "the label", TypeConverters.toFloat)
    idCol = Param(Params._dummy(), "idCol", "id column; empty: none", TypeConverters.toString)
    idValue = Param(Params._dummy(), "idValue", "the id", TypeConverters.toString)

    def __init__(self, labelCol="label", labelValue=-1.0, idCol="", idValue="unknown"):
        super().__init__()
        self._setDefault(labelCol="label", labelValue=-1.0, idCol="", idValue="unknown")
        self._set(labelCol=labelCol, labelValue=labelValue, idCol=idCol, idValue=idValue)

    def _transform(self, df: DataFrame) -> DataFrame:
        g = self.getOrDefault
        return fl.with_unknown_label(df, g(self.labelCol), g(self.labelValue), g(self.idCol) or None, g(self.idValue))
