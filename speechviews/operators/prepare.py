"""Validation, bucketing and normalisation of recordings and uploads."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from speechviews.functions import daytime, text
from speechviews.functions.formats import empty_to_null
from speechviews.functions.keys import audio_flag, epoch_millis, upload_key
from speechviews.session import broadcast_if_small

REQUIRED = ["dept_name", "zone", "time_of_day", "date_of_event", "duration", "text"]
REQUIRED_UPLOAD = ["dept_name", "zone", "date", "time", "duration"]


def _any_null(columns) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def drop_nulls(recordings: DataFrame) -> DataFrame:
    """Rows with every required field; ``id`` may be null.

    One condition per field, unlike ``dropna``, so that the optimiser can place each of them.
    """
    return recordings.where(~_any_null(REQUIRED))


def _readable(check_ranges: bool) -> tuple[Column, Column]:
    """Whether time and date can be read, never null."""
    hour = daytime.hour_of(F.col("time_of_day"))
    month = daytime.month_of(F.col("date_of_event"))
    if not check_ranges:
        return hour.isNotNull(), month.isNotNull()
    never = F.lit(False)
    return F.coalesce(hour.between(0, 23), never), F.coalesce(month.between(1, 12), never)


def valid(recordings: DataFrame, check_ranges=False) -> DataFrame:
    """Recordings that can be placed in a group.

    Hours and months out of range are placed (night, winter, fall) unless ``check_ranges``. The
    conditions are separate, so that nulls are dropped at the scan and no text is shuffled for
    its null check.
    """
    good_time, good_date = _readable(check_ranges)
    return drop_nulls(recordings).where(good_time).where(good_date)


def quarantined(recordings: DataFrame, check_ranges=False) -> DataFrame:
    """The rest of the rows, each with its problem."""
    good_time, good_date = _readable(check_ranges)
    problem = (
        F.when(_any_null(REQUIRED), "missing field")
        .when(~good_time, "bad time")
        .when(~good_date, "bad date")
    )
    return recordings.withColumn("problem", problem).where("problem is not null")


def grouped(recordings: DataFrame) -> DataFrame:
    """Valid recordings with bucket and season in place of time and date; text untouched."""
    return valid(recordings).select(
        "id", "dept_name", "zone",
        daytime.time_bucket(daytime.hour_of(F.col("time_of_day"))).alias("time_of_day"),
        daytime.season_of(daytime.month_of(F.col("date_of_event"))).alias("season"),
        "duration", "text",
    )


def prepare(recordings: DataFrame) -> DataFrame:
    """Valid recordings with bucket, season and normalised text."""
    return grouped(recordings).withColumn("text", text.normalise(F.col("text")))


def _filled(column: str) -> Column:
    return empty_to_null(F.col(column))


def clean_uploads(uploads: DataFrame) -> DataFrame:
    """Empty form fields become null."""
    fields = [*REQUIRED_UPLOAD, "text"]
    return uploads.withColumns({c: _filled(c) for c in fields})


def valid_uploads(uploads: DataFrame) -> DataFrame:
    """Uploads with every required field; the text may be missing."""
    return clean_uploads(uploads).where(~_any_null(REQUIRED_UPLOAD))


def rejected_uploads(uploads: DataFrame) -> DataFrame:
    return clean_uploads(uploads).where(_any_null(REQUIRED_UPLOAD))


def with_upload_key(uploads: DataFrame, event_time: str) -> DataFrame:
    """Set ``id`` to the event key. Its unique part is the event time, so reruns agree."""
    key = upload_key(
        F.col("date"), F.col("time"), F.col("dept_name"), F.col("zone"),
        F.col("recording"), epoch_millis(F.col(event_time)),
    )
    return uploads.withColumn("id", key)


def text_uploads(uploads: DataFrame) -> DataFrame:
    return uploads.where(~F.col("recording"))


def audio_uploads(uploads: DataFrame) -> DataFrame:
    return uploads.where("recording")


def with_audio_flag(uploads: DataFrame) -> DataFrame:
    return uploads.withColumn("audio_flag", audio_flag(F.col("recording")))


def _among(history: DataFrame, wanted: DataFrame, key: str) -> DataFrame:
    """The keys of a long history that are wanted at all: what a few new rows have to be compared with.

    New keys proven few are broadcast, so the history is read and not shuffled.
    """
    few, _ = broadcast_if_small(wanted.select(key))
    return history.select(key).join(few, key, "left_semi").distinct()


def _not_among(landed: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """The rows whose key the history does not hold.

    Keys alone are compared first: when few are new, rows that are held go before anything wide is shuffled.
    """
    wanted = landed.select(key).distinct()
    new = wanted.join(_among(history, wanted, key), key, "left_anti")
    few, _ = broadcast_if_small(new)
    return landed.join(few, key, "left_semi")


def new_recordings(landed: DataFrame, source: DataFrame) -> DataFrame:
    """Valid landed recordings that the source table does not hold, each once.

    A recording is known by its id, or by a digest of all its fields where it has none. Of
    landed rows with one id the first by that digest is taken. Appending the result twice, or a
    landing that repeats itself, changes nothing. Digests of the source are needed, and its texts
    read, for rows without id only.
    """
    content = F.sha2(F.to_json(F.struct(*landed.columns)), 256)
    by_id = Window.partitionBy("id").orderBy(content)
    fresh = valid(landed)
    named = _not_among(fresh.where("id is not null"), source.where("id is not null").select("id"), "id")
    named = named.withColumn("nth", F.row_number().over(by_id)).where("nth = 1")
    digests = source.where("id is null").select(content.alias("digest"))
    unnamed = _not_among(fresh.where("id is null").withColumn("digest", content), digests, "digest").dropDuplicates(["digest"])
    return named.select(*landed.columns).unionByName(unnamed.select(*landed.columns))
