"""Live counters: an event ledger that survives replays, and running totals kept in state.

Ledger: every micro-batch writes its events, one row each, to a partition named by the batch.
A batch that runs again overwrites its own partition, and totals are taken over distinct
events, so neither a retry nor a second message about the same upload counts twice, however
far apart they arrive. A body that comes late still adds its positive.

A view holds the ledger up to some batch. What it lacks is counted by event, not by row: an event
with a message up to that batch is in the view, also if a copy arrives afterwards.

Compaction folds the oldest batches into one row per event, so that readers open few files
however long the stream has run. What is live stands in a manifest, which readers open instead of
listing folders.

Bounded counts keep no event for ever. The ledger marks what comes more than a delay behind the
newest event of the batches before it as late. A second stream counts the others; its watermark is never ahead
of that mark, so it drops none of them, and ends the state of events that can only come late. Late
events are looked up in the ledger and counted exactly.
"""

from contextlib import contextmanager

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from speechviews.functions.formats import message_json
from speechviews.operators import messages as M
from speechviews.operators.serving import merge_counters
from speechviews.schemas import GROUP
from speechviews.session import broadcast_if_small
from speechviews.sinks import manifest as mf
from speechviews.sinks.tables import upsert_view
from speechviews.sources.tables import held_batch, newest_version, view_table

DELAY_HOURS = 24
STATE_STORE = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
MICRO_BATCH = {"processingTime": "2 seconds"}
ALL_AVAILABLE = {"availableNow": True}
SALTS = 8

LEDGER = T.StructType([
    T.StructField("event_id", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in GROUP],
    T.StructField("positive", T.BooleanType()),
    T.StructField("event_time", T.TimestampType()),
    T.StructField("late", T.BooleanType()),
    T.StructField("batch_id", T.LongType()),
])
FOLDED = T.StructType([
    T.StructField("event_id", T.StringType()),
    *[T.StructField(c, T.StringType()) for c in GROUP],
    T.StructField("batch_id", T.LongType()),
    T.StructField("positive_batch", T.LongType()),
    T.StructField("on_time", T.BooleanType()),
])
COUNTS = T.StructType([
    *[T.StructField(c, T.StringType()) for c in GROUP],
    T.StructField("sentiment_score_total", T.LongType()),
    T.StructField("batch_id", T.LongType()),
])


def live_events(raw: DataFrame, model: PipelineModel | None = None) -> DataFrame:
    """Raw messages to parsed events with ``positive``; without a model nothing is positive.

    The model is applied to the stream itself, not inside each micro-batch.
    """
    parsed = M.parse_keys(M.decode(raw))
    if model is None:
        return parsed.withColumn("positive", F.lit(False))
    # The tokeniser accepts no null text. Messages without body are scored as '' and not counted.
    scored = model.transform(parsed.withColumn("review", F.coalesce("body", F.lit(""))))
    return M.with_positive(scored).select(*parsed.columns, "positive")


def start_ledger(raw: DataFrame, ledger: str, checkpoint: str, quarantine: str | None = None,
                 model: PipelineModel | None = None, trigger=MICRO_BATCH, delay_hours=DELAY_HOURS,
                 view: str | None = None, view_every=1) -> list[StreamingQuery]:
    """Keep a ledger of events up to date; messages that cannot be parsed go to ``quarantine``.

    An event is late if it is ``delay_hours`` or more older than the newest of the batches before.
    A stored ``view`` is advanced after every ``view_every`` batches; it must have no other writer meanwhile.
    """

    def write(batch: DataFrame, batch_id: int):
        spark = batch.sparkSession
        newest = mf.read(spark, ledger)["facts"].get("newest")
        late = F.lit(False) if newest is None else F.unix_micros("event_time") <= newest - delay_hours * 3_600_000_000
        timed = batch.withColumn("event_time", F.timestamp_micros(F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01', event_time)")))
        rows = timed.groupBy("event_id", *GROUP).agg(F.max("positive").alias("positive"), F.min("event_time").alias("event_time"))
        landed = mf.land(rows.withColumn("late", late), ledger, f"batches/batch_id={batch_id}")
        own = spark.read.schema(LEDGER).parquet(landed).agg(F.max(F.unix_micros("event_time"))).first()[0]
        mf.add_batch(spark, ledger, batch_id, newest=max((t for t in (newest, own) if t is not None), default=None))
        if view is not None and (batch_id + 1) % view_every == 0:
            advance_view(spark, view, ledger)

    queries = [
        live_events(raw, model).writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{checkpoint}/ledger").trigger(**trigger).start()
    ]
    if quarantine:
        queries.append(
            M.malformed(M.decode(raw)).writeStream.format("json").option("path", quarantine)
            .option("checkpointLocation", f"{checkpoint}/quarantine").trigger(**trigger).start()
        )
    return queries


def ledger_events(spark: SparkSession, ledger: str, up_to_batch: int | None = None) -> DataFrame:
    """Events with the first batch that has one and the first that calls it positive (or null).

    Reads the newest compaction and the batches after it. ``up_to_batch`` leaves later batches out.
    """
    return _once(_rows_up_to(spark, ledger, up_to_batch))


def _rows_up_to(spark: SparkSession, ledger: str, up_to_batch: int | None) -> DataFrame:
    rows = _ledger_rows(spark, ledger)
    if up_to_batch is None:
        return rows
    late = F.col("positive_batch") > up_to_batch
    return rows.where(F.col("batch_id") <= up_to_batch).withColumn("positive_batch", F.when(~late, F.col("positive_batch")))


def _once(rows: DataFrame) -> DataFrame:
    once = rows.groupBy("event_id", *GROUP).agg(
        F.min("batch_id").alias("batch_id"), F.min("positive_batch").alias("positive_batch"), F.max("on_time").alias("on_time")
    )
    return once.withColumn("positive", F.col("positive_batch").isNotNull())


def _ledger_rows(spark: SparkSession, ledger: str) -> DataFrame:
    """Rows of the folded and the live batches, of an event as many as there are batches with it."""
    found = mf.read(spark, ledger)
    rows = mf.batches(spark, ledger, found, LEDGER).select(
        "event_id", *GROUP, "batch_id", F.when(F.col("positive"), F.col("batch_id")).alias("positive_batch"), (~F.col("late")).alias("on_time")
    )
    folded = mf.folded(spark, ledger, found, FOLDED)
    return rows if folded is None else rows.unionByName(folded)


def totals_after(events: DataFrame, held: int | None) -> DataFrame:
    """Positive events and events per group that a view holding the batches up to ``held`` lacks.

    A positive of an event that the view counts already is added alone. Without ``held`` the
    view holds no event.
    """
    if held is None:
        return M.live_totals(events)
    new, newly_positive = F.col("batch_id") > held, F.col("positive_batch") > held
    counts = events.groupBy(*GROUP).agg(
        F.count_if(newly_positive).alias("sentiment_score_sum"), F.count_if(new).alias("sentiment_score_total")
    )
    return counts.where("sentiment_score_sum > 0 or sentiment_score_total > 0")


def last_batch(spark: SparkSession, ledger: str) -> int | None:
    """The newest batch of the ledger."""
    return mf.newest_batch(mf.read(spark, ledger))


def current_view(spark: SparkSession, view: str, ledger: str) -> DataFrame:
    """The newest version of a stored view with all events added that it does not hold."""
    held = held_batch(spark, view)
    return merge_counters(view_table(spark, view), totals_after(ledger_events(spark, ledger), held))


def events_after(spark: SparkSession, ledger: str, held: int | None, up_to_batch: int | None = None) -> DataFrame:
    """The events of ``ledger_events`` that a view holding the batches up to ``held`` may lack, whole.

    Those are the events with a row or a positive after ``held``. Their ids pick their older rows; where they
    are proven few they are broadcast, so that the ledger's history is read and not shuffled.
    """
    rows = _rows_up_to(spark, ledger, up_to_batch)
    if held is None:
        return _once(rows)
    after = (F.col("batch_id") > held) | F.coalesce(F.col("positive_batch") > held, F.lit(False))
    fresh = rows.where(after)
    ids, _ = broadcast_if_small(fresh.select("event_id").distinct())
    return _once(fresh.unionByName(rows.where(~after).join(ids, "event_id", "left_semi")))


def advance_view(spark: SparkSession, view: str, ledger: str, up_to_batch: int | None = None) -> int:
    """Add the events that a stored view lacks to it; the number of its newest version.

    Only groups with such events are merged, and only their partitions are written anew. A version is announced
    together with the last batch that it holds, so a call that is repeated after a failure adds nothing twice. If no
    group changes, no version is written. ``current_view`` gives the same rows before and after.
    """
    newest = newest_version(spark, view)
    last = last_batch(spark, ledger)
    last = last if up_to_batch is None or last is None else min(last, up_to_batch)
    if last is None or (newest.held_batch is not None and last <= newest.held_batch):
        return newest.version
    counts = totals_after(events_after(spark, ledger, newest.held_batch, last), newest.held_batch).persist()
    try:
        if counts.isEmpty():
            return newest.version
        groups, _ = broadcast_if_small(counts.select(*GROUP))
        return upsert_view(merge_counters(view_table(spark, view).join(groups, GROUP, "left_semi"), counts), view, held_batch=last)
    finally:
        counts.unpersist()


def compact_ledger(spark: SparkSession, ledger: str, up_to_batch: int):
    """Fold the batches up to ``up_to_batch``, and what was folded before, into one row per event.

    The result is written whole, then takes the place of the batches in the manifest. ``manifest.expire``
    removes what no manifest names any more.
    """
    mf.fold(ledger_events(spark, ledger, up_to_batch).drop("positive"), ledger, up_to_batch)


def running_counts(raw: DataFrame) -> DataFrame:
    """Events per group as a stateful stream, for update mode.

    Every event counts once, however late it or a copy of it arrives: its id stays in the state,
    which grows with the number of events. Sessions with many of them keep state in RocksDB
    (``spark.sql.streaming.stateStore.providerClass``). Where that is too much, count the ledger.

    Copies are dropped twice, first within ``SALTS`` slices of the input, so that an event with
    very many copies does not send all of them to one task.
    """
    once = (
        M.parse_keys(M.decode(raw))
        .select("event_id", *GROUP, F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt"))
        .dropDuplicates(["event_id", "salt"])
        .dropDuplicates(["event_id"])
    )
    return once.groupBy(*GROUP).agg(F.count("*").alias("sentiment_score_total"))


def start_running_counts(raw: DataFrame, path: str, checkpoint: str, trigger=MICRO_BATCH, files=4) -> StreamingQuery:
    """Write changed totals of every micro-batch to its own partition, in a few files."""

    return _write_counts(running_counts(raw), path, checkpoint, trigger, files)


def _write_counts(counts: DataFrame, path: str, checkpoint: str, trigger, files: int) -> StreamingQuery:
    def write(batch: DataFrame, batch_id: int):
        mf.land(batch.repartition(files, *GROUP), path, f"batches/batch_id={batch_id}")
        mf.add_batch(batch.sparkSession, path, batch_id)

    return counts.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def bounded_counts(spark: SparkSession, ledger: str, delay_hours=DELAY_HOURS) -> DataFrame:
    """Events of the ledger that came in time, per group, as a stream for update mode.

    ``delay_hours`` is that of the ledger. The state holds the events of that long and the groups,
    however long the stream runs. Each of the ledger's batches must be read whole before the
    next: files are not taken in portions.
    """
    mf.ensure(spark, f"{ledger}/batches")
    events = spark.readStream.schema(LEDGER).parquet(f"{ledger}/batches").where("NOT late")
    once = events.withWatermark("event_time", f"{delay_hours} hours").dropDuplicates(["event_id", "event_time"])
    return once.groupBy(*GROUP).agg(F.count("*").alias("sentiment_score_total"))


def start_bounded_counts(spark: SparkSession, ledger: str, path: str, checkpoint: str, trigger=MICRO_BATCH, files=4, delay_hours=DELAY_HOURS) -> StreamingQuery:
    """``bounded_counts`` with the state in RocksDB; ``exact_counts`` reads the result."""
    with _setting(spark, *STATE_STORE):
        return _write_counts(bounded_counts(spark, ledger, delay_hours), path, checkpoint, trigger, files)


@contextmanager
def _setting(spark: SparkSession, key: str, value: str):
    """A session setting for queries that start inside; running ones keep theirs."""
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def late_events(spark: SparkSession, ledger: str) -> DataFrame:
    """Events none of whose messages came in time: the side output that bounded counts lack.

    Few events are late, so their ids pick the rows to compare with; the ledger is not shuffled for it.
    """
    rows = _ledger_rows(spark, ledger)
    late = rows.where("NOT on_time").select("event_id", *GROUP).distinct()
    ids, _ = broadcast_if_small(late.select("event_id"))
    known = rows.where("on_time").join(ids, "event_id", "left_semi").select("event_id").distinct()
    return late.join(known, "event_id", "left_anti")


def exact_counts(spark: SparkSession, path: str, ledger: str) -> DataFrame:
    """Bounded counts and the late events on top of them: every event once."""
    late = late_events(spark, ledger).groupBy(*GROUP).agg(F.count("*").alias("sentiment_score_total"))
    both = latest_counts(spark, path).unionByName(late)
    return both.groupBy(*GROUP).agg(F.sum("sentiment_score_total").alias("sentiment_score_total"))


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """The newest total of each group, from the newest compaction and the batches after it."""
    return _newest(spark, path).drop("batch_id")


def compact_counts(spark: SparkSession, path: str, up_to_batch: int):
    """Fold the batches up to ``up_to_batch`` into the newest total of each group."""
    mf.fold(_newest(spark, path, up_to_batch), path, up_to_batch)


def _newest(spark: SparkSession, path: str, up_to_batch: int | None = None) -> DataFrame:
    found = mf.read(spark, path)
    rows, folded = mf.batches(spark, path, found, COUNTS), mf.folded(spark, path, found, COUNTS)
    rows = rows if folded is None else rows.unionByName(folded)
    if up_to_batch is not None:
        rows = rows.where(F.col("batch_id") <= up_to_batch)
    newest = F.max(F.struct("batch_id", "sentiment_score_total")).alias("newest")
    return rows.groupBy(*GROUP).agg(newest).select(*GROUP, "newest.sentiment_score_total", "newest.batch_id")


def start_console(df: DataFrame, rows=10, trigger=MICRO_BATCH) -> StreamingQuery:
    """Show the first rows of every micro-batch. Showing never limits what is processed."""
    return (
        df.writeStream.format("console").outputMode("append")
        .option("numRows", rows).option("truncate", False).trigger(**trigger).start()
    )


def start_kafka_sink(messages: DataFrame, brokers: str, topic: str, checkpoint: str, trigger=MICRO_BATCH) -> StreamingQuery:
    """Send a stream of messages (key, body) to a topic as JSON."""
    return (
        messages.select(message_json(F.col("key"), F.col("body")).alias("value"))
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers).option("topic", topic)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def finish(*queries: StreamingQuery, timeout=None):
    """Wait until the queries end (or ``timeout`` seconds pass, then stop them)."""
    for query in queries:
        if timeout is None:
            query.awaitTermination()
        elif not query.awaitTermination(timeout):
            query.stop()
