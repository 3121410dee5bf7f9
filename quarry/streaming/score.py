"""Always-on scoring as a Structured Streaming query.

Files arriving in a folder are scored by a fitted ``PipelineModel`` and appended to
a Parquet sink. The text stages are array-lane projections, so the stream is
stateless: no watermark, no state store, exactly-once through the sink's log and the
checkpoint folder on shared storage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def score_stream(spark: SparkSession, model, source: str, schema: T.StructType | str, sink: str,
                 checkpoint: str, select=None, available_now: bool = True, max_files_per_trigger: int = 64):
    """Start (and with ``available_now`` run to completion) a scoring stream; returns the query."""
    stream = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
              .parquet(source))
    scored: DataFrame = model.transform(stream)
    if select:
        scored = scored.select(*select)
    w = (scored.writeStream.format("parquet").option("path", sink)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    q = w.start()
    if available_now:
        q.awaitTermination()
    return q
