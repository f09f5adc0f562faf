"""Batch writers."""

from pyspark import StorageLevel
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from speechviews.functions.formats import message_json
from speechviews.operators.serving import upsert
from speechviews.schemas import RECORDING, UPLOAD, VIEW
from speechviews.sources.tables import COMMIT, SLOT, newest_version, view_slots, view_table


def write_csv(df: DataFrame, path: str, bytes_per_file=64 << 20):
    """CSV without header, in pieces of about ``bytes_per_file`` that one task can read back."""
    line = F.octet_length(F.concat_ws(",", *[F.col(c).cast("string") for c in df.columns]))
    rows_per_file = max(1, int(bytes_per_file / (df.agg(F.avg(line)).first()[0] or 1)))
    (
        df.write.mode("overwrite")
        .option("sep", ",").option("quote", '"').option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)
        .option("maxRecordsPerFile", rows_per_file)
        .csv(path)
    )


def write_recordings(recordings: DataFrame, path: str, mode="overwrite"):
    """The typed source table in ORC."""
    recordings.select(*[F.col(f.name).cast(f.dataType) for f in RECORDING]).write.mode(mode).orc(path)


def save_view_table(view: DataFrame, name: str, path: str | None = None):
    """Replace a catalog table by the view, in the warehouse or at ``path``."""
    writer = view.select(*VIEW.names).write.mode("overwrite")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def write_view(view: DataFrame, path: str, version: int, held_batch: int | None = None):
    """Write one version of a view, then announce it with the last ledger batch that it holds.

    Readers follow the announcements, so they see whole versions only, and a view may be
    computed from the version it replaces. Partitions are evened out while writing, and sorted
    by key so that a lookup skips most of a file; a bloom filter on the key spares a lookup by key
    alone the row groups of all files but one.
    """
    _write_slots(view, path, version)
    _announce(view.sparkSession, path, version, held_batch, None)


def upsert_view(changes: DataFrame, path: str, held_batch: int | None = None) -> int:
    """Rows of ``changes`` replace those of the same groups in the newest version; the new version's number.

    Only the partitions (season and time of day) with a changed group are written anew; for the others the
    announcement names the version that wrote them. Writing is done by one job at a time.
    """
    spark = changes.sparkSession
    newest = newest_version(spark, path)
    version = newest.version + 1
    changes = changes.select(*VIEW.names).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        touched = changes.select(*SLOT).distinct().collect()
        old = view_table(spark, path).join(F.broadcast(changes.select(*SLOT).distinct()), SLOT, "left_semi")  # a few slots, see SLOT
        _write_slots(upsert(old, changes), path, version)
    finally:
        changes.unpersist()
    slots = {f"{r.season}/{r.time_of_day}": version for r in touched}
    _announce(spark, path, version, held_batch, {**view_slots(spark, path, newest), **slots})
    return version


def _write_slots(view: DataFrame, path: str, version: int):
    (
        view.select(*VIEW.names).hint("rebalance", *SLOT).sortWithinPartitions(*SLOT, "row_key")
        .write.mode("overwrite").partitionBy(*SLOT)
        .option("parquet.bloom.filter.enabled#row_key", True).option("parquet.bloom.filter.adaptive.enabled", True)
        .parquet(f"{path}/data/version={version}")
    )


def _announce(spark: SparkSession, path: str, version: int, held_batch: int | None, slots: dict[str, int] | None):
    spark.createDataFrame([(version, held_batch, slots)], COMMIT).coalesce(1).write.mode("append").parquet(f"{path}/commits")


def write_reports(uploads: DataFrame, path: str):
    """One JSON report per upload; the report's ``id`` is its object key."""
    uploads.select(*UPLOAD.names).write.mode("overwrite").json(path)


def write_transcripts(transcripts: DataFrame, path: str):
    """Texts with their job names in the shape of transcription results."""
    results = F.struct(F.array(F.struct(F.col("text").alias("transcript"))).alias("transcripts"))
    transcripts.select(F.col("job_name").alias("jobName"), results.alias("results")).write.mode("overwrite").json(path)


def write_messages(messages: DataFrame, path: str):
    """Messages (key, body) as JSON lines."""
    messages.select(message_json(F.col("key"), F.col("body")).alias("value")).write.mode("overwrite").text(path)


def send_messages(messages: DataFrame, brokers: str, topic: str):
    """Messages (key, body) to a Kafka topic, from a batch frame."""
    (
        messages.select(message_json(F.col("key"), F.col("body")).alias("value"))
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers).option("topic", topic)
        .save()
    )


def save_model(model: PipelineModel, path: str):
    model.write().overwrite().save(path)
