"""Structured Streaming scoring (I3 on a stream).

The fitted preprocessing is a projection with literals and the ML pipeline is a row-wise transform, so a
streaming DataFrame goes through exactly the batch code: ``readStream`` → ``score_new`` →
``writeStream`` to a Parquet sink with a checkpoint, one micro-batch per arriving file set.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from propensity.operators.score import LoadedRun, score_new


def stream_scores(spark: SparkSession, run: LoadedRun, source_dir: str, schema, sink_dir: str, checkpoint_dir: str,
                  available_now: bool = True, max_files_per_trigger: int = 16) -> StreamingQuery:
    """Score every new Parquet file under ``source_dir`` into ``sink_dir`` (exactly-once file sink)."""
    stream: DataFrame = (spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files_per_trigger)
                         .parquet(source_dir))
    out = score_new(run, stream)
    writer = out.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(sink_dir)
