"""Product events from batch files and from the stream landing folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from subsight import schemas
from subsight.sources.tables import typed


def empty_stream_df(spark: SparkSession) -> DataFrame:
    """Zero rows in the landing format, for when nothing has been streamed yet."""
    return spark.createDataFrame([], schemas.STREAM_LANDING)


def read_stream_files(spark: SparkSession, path: str) -> DataFrame:
    """Landed events; columns that a file lacks read as NULL.

    The schema is given, so no footer is read to find it.
    """
    return typed(spark.read.schema(schemas.STREAM_LANDING).parquet(path), schemas.STREAM_LANDING)


def stg_events(batch: DataFrame, streamed: DataFrame | None = None) -> DataFrame:
    """One row per event id over both ingestion paths.

    A batch row wins over a streamed one, then the earliest timestamp.  The
    remaining columns make the order total, so reruns agree.  Spark limits each
    key to one row per map task before the shuffle (window group limit), so an
    id repeated billions of times never gathers in one task.
    """
    combined = typed(batch, schemas.EVENTS).withColumn("source_priority", F.lit(1))
    if streamed is not None:
        combined = combined.unionByName(
            typed(streamed, schemas.EVENTS).withColumn("source_priority", F.lit(2))
        )
    first = Window.partitionBy("event_id").orderBy(
        "source_priority",
        "event_timestamp",
        "user_id",
        "event_name",
        "event_version",
        "account_id",
    )
    return (
        combined.withColumn("occurrence", F.row_number().over(first))
        .where("occurrence = 1")
        .select(*schemas.EVENTS.fieldNames())
    )


def merge_stream_into_events(batch: DataFrame, landing: DataFrame) -> DataFrame:
    """Rebuild of the event table after streaming: the second dedup guard."""
    return stg_events(batch, landing)


def read_events_kafka(
    spark: SparkSession,
    servers: str,
    topic: str = "product-events",
    max_per_trigger: int | None = None,
) -> DataFrame:
    """Unbounded (value, partition, offset) rows of a topic, from the start.

    Needs the Kafka connector on the class path.  Everything downstream takes
    any stream with these three columns.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        "value", F.col("partition").cast("long"), F.col("offset").cast("long")
    )
