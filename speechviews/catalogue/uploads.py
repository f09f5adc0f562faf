"""Uploads: validation, routing, keys, JSON reports."""

from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import with_ctes
from speechviews.catalogue.registry import query
from speechviews.functions import keys
from speechviews.operators import messages as M, prepare as P
from speechviews.schemas import UPLOAD
from speechviews.session import scratch_path
from speechviews.sinks.tables import write_reports, write_transcripts
from speechviews.sources.tables import transcripts_json, uploads_json


@query(with_ctes("""
    SELECT source_id AS id, dept_name, zone, date, time, duration, nullif(text, '') AS text, recording
    FROM uploads WHERE zone <> ''"""))
def upload_validation(spark, folder):
    return P.valid_uploads(I.uploads(spark, folder)).select(*UPLOAD.names)


@query(with_ctes("""
    SELECT source_id AS id, dept_name, nullif(zone, '') AS zone, date, time, duration, nullif(text, '') AS text, recording
    FROM uploads WHERE zone = ''"""))
def rejected_uploads(spark, folder):
    return P.rejected_uploads(I.uploads(spark, folder)).select(*UPLOAD.names)


@query(with_ctes("SELECT id, dept_name, zone, date, time, duration, text FROM keyed_uploads WHERE NOT recording"))
def text_uploads(spark, folder):
    return P.text_uploads(I.keyed_uploads(spark, folder)).drop("recording")


@query(with_ctes("SELECT id, dept_name, zone, date, time, duration, text FROM keyed_uploads WHERE recording"))
def audio_uploads(spark, folder):
    """Told apart by the flag in the key alone."""
    return I.keyed_uploads(spark, folder).where(keys.has_audio_flag(F.col("id"))).drop("recording")


@query(with_ctes("""
    SELECT id, CASE WHEN recording THEN 'yesAudio' ELSE 'noAudio' END AS audio_flag FROM keyed_uploads"""))
def upload_keys(spark, folder):
    return P.with_audio_flag(I.keyed_uploads(spark, folder)).select("id", "audio_flag")


@query(with_ctes("SELECT id, job_name || '.mp3' AS key FROM listener_files"))
def listener_keys(spark, folder):
    return I.listener_files(spark, folder).select("id", "key")


@query(with_ctes("SELECT id, job_name FROM listener_files"))
def job_names(spark, folder):
    return I.listener_files(spark, folder).select("id", "job_name")


@query(with_ctes(f"SELECT id, 's3://{I.BUCKET}/' || job_name || '.mp3' AS uri FROM listener_files"))
def object_uris(spark, folder):
    return I.listener_files(spark, folder).select("id", keys.object_uri(I.BUCKET, F.col("key")).alias("uri"))


@query(with_ctes("SELECT * FROM keyed_uploads"))
def upload_json_roundtrip(spark, folder):
    path = scratch_path(spark, "reports")
    write_reports(I.keyed_uploads(spark, folder), path)
    return uploads_json(spark, path).select(*UPLOAD.names)


@query(with_ctes("SELECT job_name, text FROM listener_files"))
def transcript_text(spark, folder):
    """Texts wrapped as transcription results, written, read and taken out again."""
    path = scratch_path(spark, "transcripts")
    write_transcripts(I.listener_files(spark, folder), path)
    return transcripts_json(spark, path)


# Audio files of events other than views and clicks have been transcribed before.
@query(with_ctes("SELECT id, job_name FROM listener_files WHERE kind IN ('view', 'click')"))
def untranscribed_recordings(spark, folder):
    files = I.listener_files(spark, folder)
    done = files.where(~F.col("kind").isin("view", "click"))
    return M.not_yet_done(files.drop("kind"), done).select("id", "job_name")


@query(with_ctes("SELECT id, job_name FROM listener_files WHERE kind NOT IN ('view', 'click')"))
def transcribed_recordings(spark, folder):
    files = I.listener_files(spark, folder)
    done = files.where(~F.col("kind").isin("view", "click"))
    return M.already_done(files.drop("kind"), done).select("id", "job_name")
