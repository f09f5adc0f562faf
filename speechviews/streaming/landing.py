"""Landed files into the source table, each once, and out of the way afterwards."""

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from speechviews.operators.prepare import new_recordings, quarantined
from speechviews.schemas import CORRUPT, RECORDING, with_corrupt_record
from speechviews.sinks import manifest as mf
from speechviews.sinks.tables import write_recordings
from speechviews.sources.tables import CSV, recordings_orc
from speechviews.streaming.live import ALL_AVAILABLE

REJECTED = with_corrupt_record(RECORDING).add("problem", "string").add("batch_id", "long")
COUNTED = "batch_id long, read long, rejected long, appended long"


def start_append(spark: SparkSession, landing: str, table: str, archive: str, checkpoint: str,
                 trigger=ALL_AVAILABLE, quarantine: str | None = None) -> StreamingQuery:
    """Append what lands in a folder of CSV files to the source table.

    Files of finished batches are moved to ``archive`` while later ones run. A batch that runs
    again adds nothing, as its rows are held already. Rows that cannot be appended go to ``quarantine`` with
    their problem, a batch at a time and once, next to the numbers of rows read, rejected and appended, taken
    while the rows go by; of a batch that had to run again, those of the run that finished it.
    """

    def append(batch: DataFrame, batch_id: int):
        read, added = Observation(), Observation()
        rows = batch.observe(read, F.count("*").alias("n")).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            whole = rows.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
            fresh = new_recordings(whole, recordings_orc(spark, table))
            write_recordings(fresh.observe(added, F.count("*").alias("n")), table, mode="append")
            if quarantine:
                broken = rows.where(F.col(CORRUPT).isNotNull()).withColumn("problem", F.lit("broken line"))
                bad = broken.unionByName(quarantined(whole), allowMissingColumns=True)
                folder = f"batches/batch_id={batch_id}"
                mf.land(bad, quarantine, folder)
                # a batch that runs again finds its folder and its numbers
                if batch_id not in mf.read(spark, quarantine)["live"]:
                    kept = spark.read.parquet(f"{quarantine}/{folder}").count()
                    numbers = {"read": read.get["n"], "rejected": kept, "appended": added.get["n"]}
                    mf.add_batch(spark, quarantine, batch_id, **{f"batch {batch_id}": numbers})
        finally:
            rows.unpersist()

    landed = (
        spark.readStream.schema(with_corrupt_record(RECORDING)).options(**CSV, multiLine=True, columnNameOfCorruptRecord=CORRUPT)
        .option("cleanSource", "archive").option("sourceArchiveDir", archive).csv(landing)
    )
    return landed.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def rejected_landings(spark: SparkSession, quarantine: str) -> DataFrame:
    """All rows that were not appended, with their problem and batch."""
    return mf.batches(spark, quarantine, mf.read(spark, quarantine), REJECTED)


def landing_counts(spark: SparkSession, quarantine: str) -> DataFrame:
    """Rows read, rejected and appended by batch. What was read and neither was held already or repeated."""
    facts = mf.read(spark, quarantine)["facts"]
    rows = [(int(k.split()[1]), v["read"], v["rejected"], v["appended"]) for k, v in facts.items()]
    return spark.createDataFrame(rows, COUNTED)
