"""Scoring a stream of requests: the batch scorer applied by Structured Streaming.

The transformation is stateless (no watermark or state store needed); the checkpoint makes the
file sink exactly-once, so a restarted query neither loses nor repeats requests. ``availableNow``
processes what has arrived and stops, which suits scheduled runs and tests alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from cardwatch.plans.predict import predict
from cardwatch.schemas import REQUEST

RESULT = T.StructType([
    T.StructField("id", T.LongType()),
    T.StructField("prediction", T.StringType()),
    T.StructField("fraude_probabilite", T.DoubleType()),
    T.StructField("explication", T.ArrayType(T.StringType())),
])


def request_schema(id_type: T.DataType = T.LongType()) -> T.StructType:
    return T.StructType([T.StructField("id", id_type)] + [T.StructField(f.name, f.dataType) for f in REQUEST.fields])


def start(spark: SparkSession, inbox: str, outbox: str, checkpoint: str, model=None, available_now: bool = True,
          max_files_per_trigger: int | None = None):
    """Start the scoring query from parquet request files in ``inbox`` to parquet in ``outbox``."""
    reader = spark.readStream.schema(request_schema())
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    requests = reader.parquet(inbox)
    scored = predict(requests, model)
    writer = scored.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start(outbox)


def run_to_completion(spark: SparkSession, inbox: str, outbox: str, checkpoint: str, model=None) -> DataFrame:
    q = start(spark, inbox, outbox, checkpoint, model, available_now=True)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return spark.read.schema(RESULT).parquet(outbox)
