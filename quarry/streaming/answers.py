"""Answers from a table-backed model that may change while the stream runs.

Model versions are folders ``v=<n>`` of Parquet tables below one root; a version counts
once its settings are written (they come last). Every micro-batch takes the newest
version, joins its words with the model's term table (a stream-static join per batch: no
vocabulary on the driver or inside a pipeline) and writes its answers to a folder of its
own number. A batch that is replayed after a failure finds the version noted at its first
try and overwrites its own folder, so answers are neither lost nor doubled, nor changed by
a newer model.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators import bayes as nb
from quarry.operators import text as tx
from quarry.sources.models import path_exists


def publish(model: nb.NBModel, root: str, version: int, settings: dict[str, str] | None = None) -> str:
    """Write a model as version ``version`` below ``root``; a version is never overwritten."""
    path = f"{root}/v={version}"
    if path_exists(model.term_weights.sparkSession, f"{path}/settings/_SUCCESS"):
        raise ValueError(f"{path} is there")
    return model.save(path, settings)


def newest(spark: SparkSession, root: str) -> int:
    """The largest whole version below ``root``."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(root)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []
    whole = [int(n[2:]) for n in names if n.startswith("v=") and n[2:].isdigit() and path_exists(spark, f"{root}/{n}/settings/_SUCCESS")]
    if not whole:
        raise ValueError(f"no model version in {root}")
    return max(whole)


def verse_answers(model: nb.NBModel, settings: dict[str, str], requests: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """One answer per request: its verses, cut and stemmed as the model's settings say, are scored and averaged."""
    known = requests.filter(F.col(id).isNotNull()).select(id, text).dropDuplicates([id])
    verses = tx.text_verses(known, n=int(settings["sentencesInVerse"]), id=id, text=text, stem=settings["stem"], out="words")
    verses = verses.select(F.struct(F.col(id).alias("request"), "verse_id").alias("verse"), "words")
    scored = nb.nb_score(model, verses, "verse", "words").select(F.col("verse.request").alias("request"), "probability")
    return nb.mean_answers(scored, model, known, id)


def _version_of(spark: SparkSession, root: str, notes: str, batch: int) -> int:
    note = f"{notes}/batch={batch}"
    if not path_exists(spark, f"{note}/_SUCCESS"):
        spark.createDataFrame([(newest(spark, root),)], "version int").coalesce(1).write.mode("overwrite").parquet(note)
    return spark.read.parquet(note).first()["version"]


def batch_writer(spark: SparkSession, root: str, sink: str, answer: Callable[[nb.NBModel, dict[str, str], DataFrame], DataFrame]
                 ) -> Callable[[DataFrame, int], None]:
    """What a micro-batch does: pick or recall its model version, answer, overwrite its own folder."""
    def write(batch: DataFrame, number: int) -> None:
        version = _version_of(spark, root, f"{sink}-versions", number)
        model, settings = nb.NBModel.load(spark, f"{root}/v={version}")
        answer(model, settings, batch).withColumn("model_version", F.lit(version)).write.mode("overwrite").parquet(f"{sink}/batch={number}")
    return write


def answer_stream(spark: SparkSession, root: str, source: str, schema: T.StructType | str, sink: str, checkpoint: str,
                  answer: Callable[[nb.NBModel, dict[str, str], DataFrame], DataFrame] = verse_answers, available_now: bool = True,
                  max_files_per_trigger: int = 64, interval: str = "10 seconds"):
    """Start (and with ``available_now`` run to completion) the stream over a folder of Parquet requests; returns the query.

    ``answer`` gets (model, settings, requests of the batch). Answers are read from ``sink``
    as one table, with their ``batch`` and ``model_version``.
    """
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger).parquet(source)
    w = stream.writeStream.foreachBatch(batch_writer(spark, root, sink, answer)).option("checkpointLocation", checkpoint)
    q = (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()
    if available_now:
        q.awaitTermination()
    return q
