"""Batch readers with declared schemas."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F

from speechviews.functions.formats import first_transcript
from speechviews.schemas import CORRUPT, RECORDING, TRANSCRIPT, UPLOAD, VIEW, with_corrupt_record

#: A view's partitions; seasons and times of day are a few fixed words.
SLOT = ["season", "time_of_day"]
COMMIT = "version long, held_batch long, slots map<string,long>"
CSV = {"sep": ",", "quote": '"', "escape": '"'}


def recordings_csv(spark: SparkSession, path: str, multi_line=False) -> DataFrame:
    """Recordings from a folder of CSV files without header.

    One record per line by default, so that large files are split among tasks. A line that is no
    whole record, as each line of a quoted text with newlines, is left to ``rejected_csv``; no
    text is ever shortened. Files with such texts need ``multi_line``; each of those is read by
    one task, so write them in pieces (see ``sinks.tables.write_csv``).
    """
    if multi_line:
        return spark.read.schema(RECORDING).options(**CSV, multiLine=True).csv(path)
    return _csv_lines(spark, path).where("whole").select("record.*").drop(CORRUPT)


def rejected_csv(spark: SparkSession, path: str) -> DataFrame:
    """The lines that ``recordings_csv`` leaves out, as they are."""
    return _csv_lines(spark, path).where("not whole").select(F.col("value").alias(CORRUPT))


def _csv_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines with their record, and whether they are whole: all fields, and no open quote."""
    lines = spark.read.option("lineSep", "\n").text(path)
    schema = with_corrupt_record(RECORDING)
    record = F.from_csv("value", schema.toDDL(), {**CSV, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    closed = F.length(F.regexp_replace("value", '[^"]', "")) % 2 == 0
    fits = F.col("record").isNotNull() & F.col(f"record.{CORRUPT}").isNull()
    return lines.withColumn("record", record).withColumn("whole", F.coalesce(closed & fits, F.lit(False)))


def recordings_orc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(RECORDING).orc(path)


def recordings_table(spark: SparkSession, name: str) -> DataFrame:
    """Recordings from a catalog table, columns by name in the declared order."""
    return spark.table(name).select(*[F.col(f.name).cast(f.dataType) for f in RECORDING])


def reviews_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Labelled reviews; extra columns of the file are not read."""
    return spark.read.parquet(path).select("id", "review", "score")


def stop_words_text(spark: SparkSession, path: str) -> DataFrame:
    """One word per line, taken as it is."""
    return spark.read.text(path).select(F.col("value").alias("word"))


def stop_word_list(stop_words: DataFrame, most=100_000) -> list[str]:
    """The words as a Python list, for the feature stage that keeps them as a parameter.

    More than ``most`` are refused: a table of that size is joined, not listed.
    """
    rows = stop_words.select("word").where("word <> ''").take(most + 1)
    if len(rows) > most:
        raise ValueError(f"more than {most} stop words: join against the table instead")
    return [r.word for r in rows]


def uploads_json(spark: SparkSession, path: str) -> DataFrame:
    """Upload reports; a report that cannot be parsed is kept in ``_corrupt_record``."""
    return spark.read.schema(with_corrupt_record(UPLOAD)).json(path)


def transcript_columns(raw: DataFrame) -> DataFrame:
    """Job name (the file's, if the result does not tell) and text of transcription results."""
    file_stem = F.regexp_replace(F.col("_metadata.file_name"), r"\.json$", "")
    return raw.select(
        F.coalesce("jobName", file_stem).alias("job_name"),
        first_transcript(F.col("results")).alias("text"),
    )


def transcripts_json(spark: SparkSession, path: str) -> DataFrame:
    """Transcripts of all transcription results in a folder; broken ones are in ``rejected_json``."""
    raw = spark.read.schema(with_corrupt_record(TRANSCRIPT)).json(path)
    return transcript_columns(raw.where(F.col(CORRUPT).isNull()))


def rejected_json(raw: DataFrame) -> DataFrame:
    """Records of a JSON source, batch or stream, that could not be parsed, with their file.

    All columns stay: Spark refuses to read the corrupt record alone.
    """
    return raw.where(F.col(CORRUPT).isNotNull()).select("*", F.col("_metadata.file_name").alias("file_name"))


def local_rows(spark: SparkSession, rows, schema) -> DataFrame:
    """A small lookup from Python rows."""
    return spark.createDataFrame(rows, schema)


def sentiment_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def view_versions(spark: SparkSession, path: str) -> DataFrame:
    """Announced versions, each with the last ledger batch that it holds (null: none)."""
    return spark.read.schema(COMMIT).parquet(f"{path}/commits")


def newest_version(spark: SparkSession, path: str):
    """``version``, ``held_batch`` and ``slots`` of the newest version."""
    newest = F.max_by(F.struct("version", "held_batch", "slots"), "version").alias("newest")
    return view_versions(spark, path).agg(newest).first().newest


def view_slots(spark: SparkSession, path: str, announced) -> dict[str, int]:
    """Which version wrote each partition of an announced one."""
    if announced.slots is not None:
        return announced.slots
    rows = _version(spark, path, announced.version).select(*SLOT).distinct().collect()
    return {f"{r.season}/{r.time_of_day}": announced.version for r in rows}


def _version(spark: SparkSession, path: str, version: int) -> DataFrame:
    return spark.read.schema(VIEW).parquet(f"{path}/data/version={version}")


def held_batch(spark: SparkSession, path: str) -> int | None:
    """The last ledger batch that the newest version holds."""
    return newest_version(spark, path).held_batch


def view_table(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """One version of a view, the newest committed one unless told otherwise."""
    announced = newest_version(spark, path) if version is None else view_versions(spark, path).where(F.col("version") == version).first()
    if announced is None or announced.slots is None:
        return _version(spark, path, version if announced is None else announced.version).select(*VIEW.names)
    folders = []
    for slot, written in sorted(announced.slots.items()):
        season, time_of_day = slot.split("/")
        folders.append(f"{path}/data/version={written}/season={season}/time_of_day={time_of_day}")
    return spark.read.schema(VIEW).option("basePath", f"{path}/data").parquet(*folders).select(*VIEW.names)
