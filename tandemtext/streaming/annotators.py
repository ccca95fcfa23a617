"""The row-local annotators on a stream of pairs. They hold no state, so the same expressions run unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tandemtext.functions import quality
from tandemtext.sources.readers import PAIR_SCHEMA


def stream_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """JSON-lines files of pairs as they arrive in a folder."""
    return spark.readStream.schema(PAIR_SCHEMA).json(folder)


def annotated(stream: DataFrame) -> DataFrame:
    return quality.annotate(stream)


def write(stream: DataFrame, output: str, checkpoint: str, once: bool = True):
    """Append annotated pairs as Parquet; ``once`` ends when all files that are there have been read."""
    writer = stream.writeStream.format("parquet").option("path", output).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
