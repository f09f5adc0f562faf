"""Message streams: a Kafka topic, or a folder in which files arrive."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from speechviews.functions.formats import message_json
from speechviews.schemas import CORRUPT, TRANSCRIPT, UPLOAD, with_corrupt_record
from speechviews.sources.tables import transcript_columns


def kafka_messages(spark: SparkSession, brokers: str, topic: str,
                   starting_offsets="latest", max_per_trigger=None) -> DataFrame:
    """Raw messages of a topic with their arrival time.

    The starting point counts on the first start only; afterwards the query's checkpoint
    holds the offsets, so nothing that arrives while the query is down gets lost.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", starting_offsets)
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(
        F.col("value").cast("string").alias("value"), F.col("timestamp").alias("arrived_at")
    )


def file_messages(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """The same from text files, one JSON message per line."""
    reader = spark.readStream.format("text").schema("value string")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.load(path).select("value", F.current_timestamp().alias("arrived_at"))


def arrived_json(spark: SparkSession, path: str, schema, max_files_per_trigger=None) -> DataFrame:
    """Records of JSON files that land in a folder; broken ones keep their text in ``_corrupt_record``.

    ``sources.tables.rejected_json`` takes those to the quarantine; the streams of messages below
    leave them out.
    """
    reader = spark.readStream.schema(with_corrupt_record(schema)).option("pathGlobFilter", "*.json")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.json(path)


def _whole(records: DataFrame) -> DataFrame:
    return records.where(F.col(CORRUPT).isNull())


def arrived_objects(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """Messages for JSON reports that land in a folder: one per report, key and file name."""
    return _whole(arrived_json(spark, path, UPLOAD, max_files_per_trigger)).select(
        F.concat(F.col("id"), F.lit(".json")).alias("key"),
        F.col("_metadata.file_name").alias("file_name"),
    )


def arrived_reports(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """The same with the text of each report as the message's body."""
    return _whole(arrived_json(spark, path, UPLOAD, max_files_per_trigger)).select(
        F.concat(F.col("id"), F.lit(".json")).alias("key"), F.col("text").alias("body")
    )


def arrived_transcripts(spark: SparkSession, path: str, max_files_per_trigger=None) -> DataFrame:
    """Messages for transcription results that land in a folder, transcripts as bodies."""
    found = transcript_columns(_whole(arrived_json(spark, path, TRANSCRIPT, max_files_per_trigger)))
    return found.select(F.concat(F.col("job_name"), F.lit(".json")).alias("key"), F.col("text").alias("body"))


def as_raw(messages: DataFrame) -> DataFrame:
    """Key and body as the JSON that a topic would carry, with the arrival time."""
    return messages.select(
        message_json(F.col("key"), F.col("body")).alias("value"), F.current_timestamp().alias("arrived_at")
    )
