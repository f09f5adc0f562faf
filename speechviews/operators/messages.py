"""Messages about recordings: decoding, key parsing, de-duplication, live counters.

All operators take batch and streaming frames alike, unless they aggregate.
"""

from pyspark.sql import Column, DataFrame, functions as F

from speechviews.functions import keys
from speechviews.functions.daytime import season_of, time_bucket
from speechviews.functions.formats import parse_message
from speechviews.schemas import CORRUPT, GROUP, STORAGE_EVENT


def decode(raw: DataFrame) -> DataFrame:
    """``value`` as key and body; broken JSON stays in ``_corrupt_record``."""
    others = [c for c in raw.columns if c != "value"]
    return raw.select(*others, parse_message(F.col("value")).alias("m")).select(*others, "m.*")


def has_body() -> Column:
    body = F.col("body")
    return F.coalesce(body.isNotNull() & (F.length(body) > 0), F.lit(False))


def _event_time() -> Column:
    key = F.col("key")
    return F.when(keys.is_well_formed(key), keys.key_time(key))


def parse_keys(messages: DataFrame) -> DataFrame:
    """Messages with a well-formed key, with event id, event time and the four group columns."""
    key = F.col("key")
    return messages.withColumn("event_time", _event_time()).where("event_time is not null").withColumns({
        "event_id": keys.event_id(key),
        "dept_name": keys.key_dept(key),
        "zone": keys.key_zone(key),
        "time_of_day": time_bucket(F.hour("event_time")),
        "season": season_of(F.month("event_time")),
    })


def malformed(messages: DataFrame) -> DataFrame:
    """The other messages, as they came."""
    return messages.where(_event_time().isNull())


def union_producers(*producers: DataFrame) -> DataFrame:
    """Messages of several producers; those that send no body get a null one."""
    first, *rest = producers
    for producer in rest:
        first = first.unionByName(producer, allowMissingColumns=True)
    return first


def deduplicated(messages: DataFrame) -> DataFrame:
    """One message per event, one with a body if there is any.

    An aggregate rather than a window: copies of one event are folded before the shuffle.
    """
    body_first = F.struct((~has_body()).alias("bodyless"), "body", "key")
    return (
        messages.withColumn("event_id", keys.event_id(F.col("key")))
        .groupBy("event_id").agg(F.min(body_first).alias("kept"))
        .select("event_id", F.col("kept.key").alias("key"), F.col("kept.body").alias("body"))
    )


def events(parsed: DataFrame) -> DataFrame:
    """One row per event: group and whether any of its messages was positive.

    Takes parsed messages with a boolean ``positive``. Applying it to its own output, or to
    output of several batches, changes nothing, which makes replays harmless.
    """
    return parsed.groupBy("event_id", *GROUP).agg(F.max("positive").alias("positive"))


def live_counts(parsed: DataFrame) -> DataFrame:
    """Events per group, each counted once however many messages it sent."""
    once = parsed.select("event_id", *GROUP).distinct()
    return once.groupBy(*GROUP).agg(F.count("*").alias("sentiment_score_total"))


def live_totals(parsed: DataFrame) -> DataFrame:
    """Positive events and events per group."""
    return events(parsed).groupBy(*GROUP).agg(
        F.count_if(F.col("positive")).alias("sentiment_score_sum"),
        F.count("*").alias("sentiment_score_total"),
    )


def with_positive(scored: DataFrame) -> DataFrame:
    """``positive``: the message has a body and its prediction is above 0."""
    return scored.withColumn("positive", has_body() & (F.col("prediction") > 0))


def object_texts(reports: DataFrame, transcripts: DataFrame) -> DataFrame:
    """(event_id, text) from upload reports and transcription results, one row per event."""
    of_reports = reports.select(F.col("id").alias("event_id"), "text")
    of_transcripts = transcripts.select(F.col("job_name").alias("event_id"), "text")
    return of_reports.unionByName(of_transcripts).groupBy("event_id").agg(F.max("text").alias("text"))


def with_bodies(messages: DataFrame, texts: DataFrame) -> DataFrame:
    """Messages without body take the text of the object their key names, if there is one."""
    keyed = messages.withColumn("event_id", keys.event_id(F.col("key")))
    body = F.when(has_body(), F.col("body")).otherwise(F.col("text"))
    return keyed.join(texts, "event_id", "left").select("event_id", "key", body.alias("body"))


def storage_event_keys(raw: DataFrame) -> DataFrame:
    """Bucket and decoded object key of every record in storage events (JSON in ``value``)."""
    event = F.from_json("value", STORAGE_EVENT)
    return raw.select(F.explode(event.getField("Records")).alias("r")).select(
        F.col("r.s3.bucket.name").alias("bucket"),
        F.url_decode(F.col("r.s3.object.key")).alias("key"),
    )


def not_yet_done(recordings: DataFrame, done: DataFrame) -> DataFrame:
    """Audio files whose transcription job name is not taken."""
    return recordings.join(done.select("job_name"), "job_name", "left_anti")


def already_done(recordings: DataFrame, done: DataFrame) -> DataFrame:
    return recordings.join(done.select("job_name"), "job_name", "left_semi")


def corrupt(decoded: DataFrame) -> DataFrame:
    """Messages that were no JSON."""
    return decoded.where(F.col(CORRUPT).isNotNull())
