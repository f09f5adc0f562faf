"""Messages: JSON, keys, storage events, union, de-duplication, live counters."""

from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import with_ctes
from speechviews.catalogue.registry import query
from speechviews.functions.formats import message_json
from speechviews.operators import messages as M
from speechviews.schemas import GROUP
from speechviews.session import scratch_path
from speechviews.sinks.tables import write_reports, write_transcripts
from speechviews.sources.tables import transcripts_json, uploads_json


def _encoded(spark, folder):
    """The messages as JSON, and page texts as messages that are none."""
    good = I.messages(spark, folder).select(message_json(F.col("key"), F.col("body")).alias("value"))
    return good.unionByName(I.table(spark, folder, "pages").select(F.col("html").alias("value")))


@query(with_ctes("SELECT key, body FROM messages"))
def message_json_roundtrip(spark, folder):
    return M.decode(_encoded(spark, folder)).where("key is not null").select("key", "body")


@query("SELECT html AS value FROM pages")
def corrupt_messages(spark, folder):
    return M.corrupt(M.decode(_encoded(spark, folder))).select(F.col("_corrupt_record").alias("value"))


@query(with_ctes("""
    SELECT key, event_id, strftime(event_time, '%Y-%m-%d %H:%M:%S') AS event_time, dept_name, zone, time_of_day, season FROM parsed"""))
def parse_keys(spark, folder):
    event_time = F.col("event_time").cast("string").alias("event_time")
    return M.parse_keys(I.messages(spark, folder)).select("key", "event_id", event_time, *GROUP)


@query(with_ctes("""
    SELECT key, body FROM keyed WHERE event_time IS NULL OR dept_name IS NULL OR zone IS NULL"""))
def malformed_keys(spark, folder):
    return M.malformed(I.messages(spark, folder))


@query(with_ctes("SELECT * FROM messages"))
def messages_union(spark, folder):
    return I.messages(spark, folder)


@query(with_ctes(r"""
    SELECT event_id, arg_min(key, rank) AS key, max(body) AS body
    FROM (SELECT *, (CASE WHEN length(body) > 0 THEN '0' ELSE '1' END) || key AS rank FROM keyed) AS k
    GROUP BY event_id"""))
def messages_deduped(spark, folder):
    return M.deduplicated(I.messages(spark, folder))


@query(with_ctes("SELECT * FROM live_counts"))
def live_counts(spark, folder):
    return M.live_counts(M.parse_keys(I.messages(spark, folder)))


@query(with_ctes("""
    SELECT k.event_id, k.key, CASE WHEN length(k.body) > 0 THEN k.body ELSE t.text END AS body
    FROM keyed k LEFT JOIN (
      SELECT event_id, max(text) AS text
      FROM (SELECT id AS event_id, text FROM keyed_uploads UNION ALL SELECT job_name, text FROM listener_files) AS u
      GROUP BY event_id) AS t ON t.event_id = k.event_id"""))
def messages_with_bodies(spark, folder):
    """Messages that only name an object get the text of that object: reports and transcription
    results written as JSON and read in one go."""
    reports, transcripts = scratch_path(spark, "reports"), scratch_path(spark, "transcripts")
    write_reports(I.keyed_uploads(spark, folder), reports)
    write_transcripts(I.listener_files(spark, folder), transcripts)
    texts = M.object_texts(uploads_json(spark, reports), transcripts_json(spark, transcripts))
    return M.with_bodies(I.messages(spark, folder), texts)


# A long body stands for a positive prediction.
@query(with_ctes("""
    SELECT dept_name, zone, time_of_day, season, count(*) FILTER (positive) AS sentiment_score_sum,
           count(*) AS sentiment_score_total
    FROM (SELECT event_id, dept_name, zone, time_of_day, season, coalesce(max(length(body)), 0) > 1000 AS positive
          FROM parsed GROUP BY ALL) AS e
    GROUP BY ALL"""))
def live_positive_counts(spark, folder):
    parsed = M.parse_keys(I.messages(spark, folder))
    scored = parsed.withColumn("prediction", (F.coalesce(F.length("body"), F.lit(0)) > 1000).cast("int"))
    return M.live_totals(M.with_positive(scored))


def _storage_events(spark, folder):
    """Storage events of two records each: the object of a message and the page it names."""
    records = [
        F.struct(F.struct(
            F.struct(F.lit(bucket).alias("name")).alias("bucket"),
            F.struct(F.url_encode(F.col(column)).alias("key")).alias("object"),
        ).alias("s3"))
        for bucket, column in (("pages", "url"), ("texts", "title"))
    ]
    pages = I.table(spark, folder, "pages").select("url", F.regexp_extract("html", "<title>(.*?)</title>", 1).alias("title"))
    return pages.select(F.to_json(F.struct(F.array(*records).alias("Records"))).alias("value"))


@query("""
    SELECT 'pages' AS bucket, url AS key FROM pages
    UNION ALL SELECT 'texts', regexp_extract(html, '<title>(.*?)</title>', 1) FROM pages""")
def arrival_event_keys(spark, folder):
    return M.storage_event_keys(_storage_events(spark, folder))


@query("SELECT page_id, replace(url_decode(replace(url, '+', ' ')), '+', ' ') AS url FROM pages")
def url_decoded_keys(spark, folder):
    """Names in which a blank was sent as ``+``."""
    sent = F.replace(F.url_encode("url"), F.lit("%2B"), F.lit("+"))
    return I.table(spark, folder, "pages").select("page_id", F.url_decode(sent).alias("url"))
