"""Scans, round trips through files, validation, bucketing, normalised text."""

from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import with_ctes
from speechviews.catalogue.registry import query
from speechviews.functions import daytime, text
from speechviews.functions.keys import row_key
from speechviews.operators import prepare as P
from speechviews.schemas import GROUP
from speechviews.session import scratch_path
from speechviews.sinks import tables as sinks
from speechviews.sources import tables

ALL_RECORDINGS = with_ctes("SELECT * FROM recordings")


@query(ALL_RECORDINGS)
def recordings_scan(spark, folder):
    return I.recordings(spark, folder)


@query(ALL_RECORDINGS)
def recordings_orc_roundtrip(spark, folder):
    path = scratch_path(spark, "recordings-orc")
    sinks.write_recordings(I.recordings(spark, folder), path)
    return tables.recordings_orc(spark, path)


@query(ALL_RECORDINGS)
def recordings_csv_roundtrip(spark, folder):
    path = scratch_path(spark, "recordings-csv")
    sinks.write_csv(I.recordings(spark, folder), path)
    return tables.recordings_csv(spark, path, multi_line=True)


@query(with_ctes("""
    SELECT id, text, CAST(1 AS BIGINT) AS lines FROM recordings WHERE NOT contains(text, chr(10))
    UNION ALL
    SELECT NULL, NULL, CAST(coalesce(sum(1 + length(text) - length(replace(text, chr(10), ''))), 0) AS BIGINT)
    FROM recordings WHERE contains(text, chr(10))"""))
def csv_quarantine(spark, folder):
    """Read line by line: whole records, and the number of lines that were none."""
    path = scratch_path(spark, "recordings-csv")
    sinks.write_csv(I.recordings(spark, folder), path)
    good = tables.recordings_csv(spark, path).select("id", "text", F.lit(1).cast("long").alias("lines"))
    none = F.lit(None).cast("string")
    bad = tables.rejected_csv(spark, path).agg(F.count("*").alias("lines"))
    return good.unionByName(bad.select(none.alias("id"), none.alias("text"), "lines"))


@query(with_ctes("""
    SELECT id, zone, duration FROM recordings"""))
def recordings_projection(spark, folder):
    return I.recordings(spark, folder).select("id", "zone", "duration")


@query(with_ctes("""
    SELECT * FROM dirty WHERE dept_name IS NOT NULL AND zone IS NOT NULL AND time_of_day IS NOT NULL
      AND date_of_event IS NOT NULL AND duration IS NOT NULL AND text IS NOT NULL"""))
def complete_recordings(spark, folder):
    return P.drop_nulls(I.dirty_recordings(spark, folder))


@query(with_ctes("""
    SELECT * FROM dirty
    WHERE dept_name IS NOT NULL AND zone IS NOT NULL AND duration IS NOT NULL AND text IS NOT NULL
      AND TRY_CAST(left(time_of_day, 2) AS INTEGER) IS NOT NULL
      AND TRY_CAST(right(left(date_of_event, 7), 2) AS INTEGER) IS NOT NULL"""))
def valid_recordings(spark, folder):
    return P.valid(I.dirty_recordings(spark, folder))


@query(with_ctes("""
    SELECT * FROM (
      SELECT *, CASE
        WHEN dept_name IS NULL OR zone IS NULL OR time_of_day IS NULL OR date_of_event IS NULL
          OR duration IS NULL OR text IS NULL THEN 'missing field'
        WHEN TRY_CAST(left(time_of_day, 2) AS INTEGER) IS NULL THEN 'bad time'
        WHEN TRY_CAST(right(left(date_of_event, 7), 2) AS INTEGER) IS NULL THEN 'bad date' END AS problem
      FROM dirty) AS d
    WHERE problem IS NOT NULL"""))
def quarantined_recordings(spark, folder):
    return P.quarantined(I.dirty_recordings(spark, folder))


@query(with_ctes("""
    SELECT id, CAST(hour(event_ts) AS INTEGER) AS hour,
           CASE WHEN hour(event_ts) < 6 THEN 'latenight' WHEN hour(event_ts) < 12 THEN 'morn'
                WHEN hour(event_ts) < 18 THEN 'aftrn' ELSE 'night' END AS bucket
    FROM sources"""))
def time_bucket(spark, folder):
    hour = daytime.hour_of(F.col("time_of_day"))
    return I.recordings(spark, folder).select("id", hour.alias("hour"), daytime.time_bucket(hour).alias("bucket"))


@query(with_ctes("""
    SELECT id, CAST(substr(date_of_event, 6, 2) AS INTEGER) AS month,
           CASE quarter(CAST(date_of_event AS DATE)) WHEN 1 THEN 'winter' WHEN 2 THEN 'spring'
                WHEN 3 THEN 'summer' ELSE 'fall' END AS season
    FROM recordings"""))
def season(spark, folder):
    month = daytime.month_of(F.col("date_of_event"))
    return I.recordings(spark, folder).select("id", month.alias("month"), daytime.season_of(month).alias("season"))


@query(with_ctes("""
    SELECT id, dept_name, zone, time_of_day, season, duration, array_to_string(words, ' ') AS text FROM tokenised"""))
def prepared_recordings(spark, folder):
    return P.prepare(I.recordings(spark, folder))


@query(with_ctes("SELECT id, array_to_string(words, ' ') AS text FROM tokenised"))
def normalised_text(spark, folder):
    return I.recordings(spark, folder).select("id", text.normalise(F.col("text")).alias("text"))


@query(with_ctes("""
    SELECT id, len(words) AS n_words, words[1] AS first_word, words[len(words)] AS last_word FROM tokenised"""))
def token_array(spark, folder):
    tokens = I.recordings(spark, folder).select("id", text.words(F.col("text")).alias("words"))
    return tokens.select(
        "id", F.size("words").cast("long").alias("n_words"),
        F.get("words", F.lit(0)).alias("first_word"), F.get("words", F.size("words") - 1).alias("last_word"),
    )


@query(with_ctes("SELECT id, dept_name || zone || time_of_day || season AS row_key FROM grouped"))
def row_keys(spark, folder):
    return P.grouped(I.recordings(spark, folder)).select("id", row_key(*GROUP).alias("row_key"))
