"""How the supplied tables stand for recordings, reviews, uploads and messages.

Every input is defined twice, as DataFrames and as SQL, and always over whole tables. Faults
(missing texts, unreadable times, empty form fields) are put in by event type, so that the
quarantine and validation operators have work to do; no row is left out for them.
"""

import re
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from speechviews.functions import keys
from speechviews.operators import messages as M
from speechviews.operators.prepare import clean_uploads, grouped, text_uploads, valid_uploads, with_upload_key
from speechviews.plans.batch_view import view_of
from speechviews.schemas import GROUP, RECORDING, UPLOAD
from speechviews.session import scratch_path, spread
from speechviews.sinks.manifest import file_state
from speechviews.sinks.tables import write_view
from speechviews.sources.tables import view_table

BUCKET = "recordings"

# Frequent function words of the four languages in the supplied texts.
STOP_WORDS = [
    "and", "are", "but", "for", "from", "has", "have", "not", "that", "the", "this", "was", "with",
    "das", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht", "und", "von",
    "avec", "dans", "des", "est", "les", "par", "pour", "que", "qui", "sur", "une",
    "con", "del", "las", "los", "para", "por", "una",
]


TABLES = {
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "labels": "doc_id bigint, quality int, toxic int",
    "pages": "page_id bigint, url string, html string",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def stop_word_table(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(w) for w in STOP_WORDS])).alias("word"))


def sources(spark: SparkSession, folder: str) -> DataFrame:
    """Recordings with the extra columns the other inputs are made from.

    A document without event or order has no time or date and ends in the quarantine.
    """
    documents = spread(table(spark, folder, "documents"), "doc_id").select("doc_id", "text", "lang", "source")
    events = table(spark, folder, "events").select(
        F.col("event_id").alias("doc_id"), F.col("ts").alias("event_ts"),
        F.col("event_type").alias("kind"), "value", "props",
    )
    orders = table(spark, folder, "orders").select(F.col("o_orderkey").alias("doc_id"), "o_orderdate")
    department = F.substring("source", 4, 10).cast("int") % 3
    return documents.join(events, "doc_id", "left").join(orders, "doc_id", "left").select(
        "doc_id",
        F.col("doc_id").cast("string").alias("id"),
        F.concat(F.lit("dept"), department.cast("string")).alias("dept_name"),
        F.col("lang").alias("zone"),
        F.substring(F.col("event_ts").cast("string"), 12, 8).alias("time_of_day"),
        F.substring(F.col("o_orderdate").cast("string"), 1, 10).alias("date_of_event"),
        F.col("value").alias("duration"),
        "text", "event_ts", "kind", "props",
    )


def recordings(spark: SparkSession, folder: str) -> DataFrame:
    return sources(spark, folder).select(*RECORDING.names)


def dirty_recordings(spark: SparkSession, folder: str) -> DataFrame:
    """Recordings with missing texts, unreadable times and unreadable dates."""
    kind = F.col("kind")
    return sources(spark, folder).withColumns({
        "text": F.when(kind != "error", F.col("text")),
        "time_of_day": F.when(kind == "signup", "xx:00:00").otherwise(F.col("time_of_day")),
        "date_of_event": F.when((kind == "purchase") & (F.col("zone") == "es"), "unknown")
        .otherwise(F.col("date_of_event")),
    }).select(*RECORDING.names)


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    """Grouped recordings whose quality label plays the part of the prediction."""
    labels = table(spark, folder, "labels").select("doc_id", "quality")
    rows = sources(spark, folder).join(labels, "doc_id", "left")
    with_label = rows.select("id", F.coalesce("quality", F.lit(0)).alias("prediction"), *RECORDING.names[1:])
    return grouped_keeping(with_label, "prediction")


def grouped_keeping(df: DataFrame, extra: str) -> DataFrame:
    """``grouped`` with one more column kept, carried next to the id."""
    packed = df.withColumn("id", F.struct("id", F.col(extra).alias(extra)))
    return grouped(packed).select(F.col("id.id").alias("id"), *GROUP, "duration", "text", f"id.{extra}")


def labelled_view(spark: SparkSession, folder: str) -> DataFrame:
    return view_of(labelled(spark, folder), STOP_WORDS)


def stored_view(spark: SparkSession, folder: str) -> DataFrame:
    """The same, written once for a state of the tables and read back as a server would."""
    return view_table(spark, _written_view(spark, folder, tables_state(spark, folder, "documents", "events", "orders", "labels")))


def tables_state(spark: SparkSession, folder: str, *names: str) -> tuple:
    return file_state(spark, [f for name in names for f in table(spark, folder, name).inputFiles()])


@lru_cache(maxsize=4)
def _written_view(spark, folder, state):
    path = scratch_path(spark, "view")
    write_view(labelled_view(spark, folder), path, version=1)
    return path


def reviews(spark: SparkSession, folder: str) -> DataFrame:
    documents = spread(table(spark, folder, "documents"), "doc_id").select(
        F.col("doc_id").alias("id"), F.col("text").alias("review")
    )
    labels = table(spark, folder, "labels").select(F.col("doc_id").alias("id"), F.col("quality").alias("score"))
    return documents.join(labels, "id")


def uploads(spark: SparkSession, folder: str) -> DataFrame:
    """Form posts, some with an empty zone or text; audio when the event is a view.

    Next to the form fields stand the event time and the zone the recording is really from.
    """
    kind = F.col("kind")
    return sources(spark, folder).select(
        F.col("id"), "dept_name",
        F.when(kind == "error", "").otherwise(F.col("zone")).alias("zone"),
        F.col("date_of_event").alias("date"),
        F.substring("time_of_day", 1, 5).alias("time"),
        F.regexp_extract("props", r"\d+", 0).alias("duration"),
        F.when(kind == "signup", "").otherwise(F.col("text")).alias("text"),
        (kind == "view").alias("recording"),
        "event_ts", F.col("zone").alias("spoken_zone"),
    )


def keyed_uploads(spark: SparkSession, folder: str) -> DataFrame:
    """Valid uploads under their event key."""
    return with_upload_key(valid_uploads(uploads(spark, folder)), "event_ts").select(*UPLOAD.names)


def listener_files(spark: SparkSession, folder: str) -> DataFrame:
    """Audio files captured by listeners, and the job name each would be transcribed under."""
    key = keys.listener_key(F.col("event_ts"), F.col("dept_name"), F.col("zone"))
    return sources(spark, folder).select("id", "kind", "text", key.alias("key")).withColumn(
        "job_name", keys.job_name(F.col("key"))
    )


def unpadded_key(zone="zone") -> Column:
    """The key an old listener would give: day and month are not padded."""
    written = F.col("event_ts").cast("string")
    return F.concat(
        F.dayofmonth("event_ts").cast("string"), F.month("event_ts").cast("string"),
        F.substring(written, 1, 4), F.substring(written, 12, 2), F.substring(written, 15, 2), F.lit("00."), "dept_name", F.lit("."), zone, F.lit(".mp3"),
    )


def producers(spark: SparkSession, folder: str) -> list[DataFrame]:
    """What each producer sends: the web form its text uploads, the notifier every object that
    arrives, old listeners keys without padding, and web crawlers keys that are none."""
    sent = keyed_uploads(spark, folder)
    web = text_uploads(sent).select(F.col("id").alias("key"), F.col("text").alias("body"))
    notifier = sent.select(F.concat("id", F.lit(".json")).alias("key"))
    transcribed = listener_files(spark, folder).select(F.concat("job_name", F.lit(".json")).alias("key"))
    unpadded = sources(spark, folder).select(unpadded_key().alias("key"))
    return [web, notifier, transcribed, unpadded, crawled(spark, folder)]


def crawled(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "pages").select(F.col("url").alias("key"))


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """The messages of all producers, those about recordings from one pass over them."""
    upload_key, no_body = F.col("id"), F.lit(None).cast("string")
    listener_key = keys.listener_key(F.col("event_ts"), F.col("dept_name"), F.col("spoken_zone"))
    keyed = with_upload_key(clean_uploads(uploads(spark, folder)), "event_ts")
    sent = F.array(
        F.struct(F.when(~F.col("recording"), upload_key).alias("key"), F.col("text").alias("body")),
        F.struct(F.concat(upload_key, F.lit(".json")).alias("key"), no_body.alias("body")),
        F.struct(F.concat(keys.job_name(listener_key), F.lit(".json")).alias("key"), no_body.alias("body")),
        F.struct(unpadded_key("spoken_zone").alias("key"), no_body.alias("body")),
    )
    about_recordings = keyed.select(F.inline(sent)).where("key is not null")
    return M.union_producers(about_recordings, crawled(spark, folder))


# ---- the same in SQL -------------------------------------------------------------------------

_GROUP = "dept_name, zone, time_of_day, season"
_STOP_VALUES = ", ".join(f"('{w}')" for w in STOP_WORDS)

CTES = {
    "sources": """
        SELECT d.doc_id, CAST(d.doc_id AS VARCHAR) AS id,
               'dept' || CAST(CAST(substr(d.source, 4) AS INTEGER) % 3 AS VARCHAR) AS dept_name,
               d.lang AS zone, strftime(e.ts, '%H:%M:%S') AS time_of_day,
               strftime(o.o_orderdate, '%Y-%m-%d') AS date_of_event, e.value AS duration, d.text AS text,
               e.ts AS event_ts, e.event_type AS kind, e.props AS props
        FROM documents d LEFT JOIN events e ON e.event_id = d.doc_id LEFT JOIN orders o ON o.o_orderkey = d.doc_id""",
    "recordings": """
        SELECT id, dept_name, zone, time_of_day, date_of_event, duration, text FROM sources""",
    "dirty": """
        SELECT id, dept_name, zone,
               CASE WHEN kind = 'signup' THEN 'xx:00:00' ELSE time_of_day END AS time_of_day,
               CASE WHEN kind = 'purchase' AND zone = 'es' THEN 'unknown' ELSE date_of_event END AS date_of_event,
               duration, CASE WHEN kind <> 'error' THEN text END AS text
        FROM sources""",
    "numbered": """
        SELECT *, CAST(substr(time_of_day, 1, 2) AS INTEGER) AS hh,
               CAST(substr(date_of_event, 6, 2) AS INTEGER) AS mm
        FROM sources""",
    "grouped": """
        SELECT doc_id, id, dept_name, zone,
               CASE WHEN hh BETWEEN 0 AND 5 THEN 'latenight' WHEN hh BETWEEN 6 AND 11 THEN 'morn'
                    WHEN hh BETWEEN 12 AND 17 THEN 'aftrn' ELSE 'night' END AS time_of_day,
               CASE WHEN mm <= 3 THEN 'winter' WHEN mm <= 6 THEN 'spring' WHEN mm <= 9 THEN 'summer'
                    ELSE 'fall' END AS season,
               duration, text
        FROM numbered""",
    "tokenised": r"""
        SELECT g.doc_id, g.id, g.dept_name, g.zone, g.time_of_day, g.season, g.duration,
               list_filter(
                 list_transform(string_split(g.text, ' '), lambda t: lower(regexp_replace(
                   regexp_replace(t, '[,.!?:;)( \t\n]', '', 'g'), '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g'))),
                 lambda t: length(t) > 2) AS words
        FROM grouped g""",
    "group_words": f"""
        SELECT {_GROUP}, unnest(words) AS word FROM tokenised""",
    "word_counts": f"""
        SELECT {_GROUP}, word, count(*) AS cnt FROM group_words GROUP BY ALL""",
    "stop_words": f"""
        SELECT * FROM (VALUES {_STOP_VALUES}) AS s(word)""",
    "kept_counts": """
        SELECT * FROM word_counts WHERE word NOT IN (SELECT word FROM stop_words)""",
    "ordered": f"""
        SELECT *, row_number() OVER (PARTITION BY {_GROUP} ORDER BY cnt DESC, word) AS rn,
               count(*) OVER (PARTITION BY {_GROUP}) AS n
        FROM kept_counts""",
    "word_lists": f"""
        SELECT {_GROUP}, string_agg(word, ',' ORDER BY rn) FILTER (rn <= 5) AS most_common_words,
               string_agg(word, ',' ORDER BY rn) FILTER (rn > n - 5) AS least_common_words
        FROM ordered GROUP BY {_GROUP}""",
    "labelled": """
        SELECT g.*, coalesce(l.quality, 0) AS prediction FROM grouped g LEFT JOIN labels l ON l.doc_id = g.doc_id""",
    "counters": f"""
        SELECT {_GROUP}, CAST(sum(prediction) AS BIGINT) AS sentiment_score_sum, count(*) AS sentiment_score_total
        FROM labelled GROUP BY {_GROUP}""",
    "the_view": """
        SELECT c.dept_name || c.zone || c.time_of_day || c.season AS row_key,
               c.dept_name, c.zone, c.time_of_day, c.season,
               coalesce(w.most_common_words, '') AS most_common_words,
               coalesce(w.least_common_words, '') AS least_common_words,
               c.sentiment_score_sum, c.sentiment_score_total
        FROM counters c LEFT JOIN word_lists w
          ON w.dept_name = c.dept_name AND w.zone = c.zone
         AND w.time_of_day = c.time_of_day AND w.season = c.season""",
    "reviews": """
        SELECT d.doc_id AS id, d.text AS review, l.quality AS score
        FROM documents d JOIN labels l ON l.doc_id = d.doc_id""",
    "uploads": r"""
        SELECT dept_name, CASE WHEN kind = 'error' THEN '' ELSE zone END AS zone, date_of_event AS date,
               substr(time_of_day, 1, 5) AS time, regexp_extract(props, '\d+') AS duration,
               CASE WHEN kind = 'signup' THEN '' ELSE text END AS text, kind = 'view' AS recording, event_ts, id AS source_id
        FROM sources""",
    "keyed_uploads": """
        SELECT strftime(CAST(date AS DATE), '%d%m%Y') || replace(time, ':', '') || '00.' || dept_name || '.' || zone
               || CASE WHEN recording THEN '.yesAudio.' ELSE '.noAudio.' END
               || CAST(epoch_us(event_ts) // 1000 AS VARCHAR) AS id,
               dept_name, zone, date, time, duration, nullif(text, '') AS text, recording
        FROM uploads WHERE zone <> ''""",
    "listener_files": r"""
        SELECT id, kind, text, strftime(event_ts, '%d%m%Y%H%M') || '00.' || dept_name || '.' || zone || '.'
               || CAST(epoch_us(event_ts) // 1000000 AS VARCHAR) || '.'
               || lpad(CAST(epoch_us(event_ts) % 1000000 AS VARCHAR), 6, '0') AS job_name
        FROM sources""",
    "messages": """
        SELECT id AS key, text AS body FROM keyed_uploads WHERE NOT recording
        UNION ALL SELECT id || '.json', NULL FROM keyed_uploads
        UNION ALL SELECT job_name || '.json', NULL FROM listener_files
        UNION ALL SELECT CAST(day(event_ts) AS VARCHAR) || CAST(month(event_ts) AS VARCHAR)
                         || strftime(event_ts, '%Y%H%M') || '00.' || dept_name || '.' || zone || '.mp3', NULL FROM sources
        UNION ALL SELECT url, NULL FROM pages""",
    "keyed": r"""
        SELECT key, body, regexp_replace(key, '\.json$', '') AS event_id,
               try_strptime(regexp_extract(key, '^(\d{14})\.([^.]*)\.([^.]*)\.', 1), '%d%m%Y%H%M%S') AS event_time,
               nullif(regexp_extract(key, '^(\d{14})\.([^.]*)\.([^.]*)\.', 2), '') AS dept_name,
               nullif(regexp_extract(key, '^(\d{14})\.([^.]*)\.([^.]*)\.', 3), '') AS zone
        FROM messages""",
    "parsed": """
        SELECT key, body, event_id, event_time, dept_name, zone,
               CASE WHEN hour(event_time) < 6 THEN 'latenight' WHEN hour(event_time) < 12 THEN 'morn'
                    WHEN hour(event_time) < 18 THEN 'aftrn' ELSE 'night' END AS time_of_day,
               CASE WHEN month(event_time) <= 3 THEN 'winter' WHEN month(event_time) <= 6 THEN 'spring'
                    WHEN month(event_time) <= 9 THEN 'summer' ELSE 'fall' END AS season
        FROM keyed WHERE event_time IS NOT NULL AND dept_name IS NOT NULL AND zone IS NOT NULL""",
    "live_counts": f"""
        SELECT {_GROUP}, count(DISTINCT event_id) AS sentiment_score_total FROM parsed GROUP BY {_GROUP}""",
}


def with_ctes(select: str) -> str:
    """The statement with every table expression it mentions, directly or through another."""
    needed, texts = set(), [select]
    while texts:
        body = texts.pop()
        for name, definition in CTES.items():
            if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", body):
                needed.add(name)
                texts.append(definition)
    listed = ", ".join(f"{name} AS ({body})" for name, body in CTES.items() if name in needed)
    return f"WITH {listed} {select}" if listed else select
