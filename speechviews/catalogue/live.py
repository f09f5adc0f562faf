"""Streams that read messages and reports as files, run until all input is processed."""

from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import with_ctes
from speechviews.catalogue.model import fixed_model, trained_model
from speechviews.catalogue.registry import query
from speechviews.operators import messages as M, prepare as P, serving as S
from speechviews.schemas import RECORDING
from speechviews.session import scratch_path
from speechviews.sinks import manifest as mf
from speechviews.sinks.tables import write_csv, write_messages, write_recordings, write_reports, write_transcripts, write_view
from speechviews.sources.streams import arrived_objects, arrived_transcripts, as_raw, file_messages
from speechviews.sources.tables import recordings_orc, view_table
from speechviews.streaming import live as L
from speechviews.streaming.landing import rejected_landings, start_append


def _landed(spark, folder):
    """A folder of message files and the stream that reads it."""
    path = scratch_path(spark, "messages")
    write_messages(I.messages(spark, folder), path)
    return file_messages(spark, path)


def _ledger(spark, folder, model=None):
    ledger, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "stream")
    L.finish(*L.start_ledger(_landed(spark, folder), ledger, checkpoint, model=model, trigger=L.ALL_AVAILABLE))
    return L.ledger_events(spark, ledger)


def _in_two_landings(spark, folder, step):
    """Lands half of the messages, calls ``step(0, stream)``, lands the rest, and calls it again.

    The halves go by a hash of the key, so copies of many events are in both.
    """
    path = scratch_path(spark, "landings")
    half = F.pmod(F.xxhash64("key"), F.lit(2))
    for n in range(2):
        write_messages(I.messages(spark, folder).where(half == n), f"{path}/{n}")
        step(n, file_messages(spark, f"{path}/*"))


def _two_batches(spark, folder, between=lambda ledger: None):
    """A ledger of two batches; ``between`` is called after the first."""
    ledger, checkpoint = scratch_path(spark, "ledger"), scratch_path(spark, "stream")

    def step(n, stream):
        L.finish(*L.start_ledger(stream, ledger, checkpoint, trigger=L.ALL_AVAILABLE))
        if n == 0:
            between(ledger)

    _in_two_landings(spark, folder, step)
    return ledger


@query(with_ctes("SELECT id || '.json' AS key FROM keyed_uploads"))
def stream_arrivals(spark, folder):
    reports, out = scratch_path(spark, "reports"), scratch_path(spark, "arrivals")
    write_reports(I.keyed_uploads(spark, folder), reports)
    arriving = arrived_objects(spark, reports).select("key")
    L.finish(
        arriving.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", scratch_path(spark, "stream")).trigger(**L.ALL_AVAILABLE).start()
    )
    return spark.read.schema("key string").parquet(out)


@query(with_ctes("SELECT * FROM live_counts"))
def stream_live_counts(spark, folder):
    return M.live_totals(_ledger(spark, folder)).drop("sentiment_score_sum")


@query(with_ctes("SELECT * FROM live_counts"))
def stream_running_counts(spark, folder):
    """The same counts kept in streaming state."""
    out = scratch_path(spark, "running")
    L.finish(L.start_running_counts(_landed(spark, folder), out, scratch_path(spark, "stream"), L.ALL_AVAILABLE))
    return L.latest_counts(spark, out)


@query(with_ctes("SELECT * FROM live_counts"))
def stream_late_events(spark, folder):
    """Running counts of messages that arrive up to a year after others, copies included."""
    out, checkpoint = scratch_path(spark, "running"), scratch_path(spark, "stream")

    def step(n, stream):
        late = stream.withColumn("arrived_at", F.col("arrived_at") - F.make_interval(years=F.lit(n)))
        L.finish(L.start_running_counts(late, out, checkpoint, L.ALL_AVAILABLE))

    _in_two_landings(spark, folder, step)
    return L.latest_counts(spark, out)


@query(with_ctes("SELECT * FROM live_counts"))
def stream_counts_compacted(spark, folder):
    """Running counts whose first batch was folded before the second arrived."""
    out, checkpoint = scratch_path(spark, "running"), scratch_path(spark, "stream")

    def step(n, stream):
        L.finish(L.start_running_counts(stream, out, checkpoint, L.ALL_AVAILABLE))
        if n == 0:
            L.compact_counts(spark, out, 0)

    _in_two_landings(spark, folder, step)
    return L.latest_counts(spark, out)


@query(with_ctes("SELECT * FROM live_counts"))
def stream_bounded_counts(spark, folder):
    """Counts whose state forgets events after a day, with what came later taken from the ledger.

    The second landing repeats the times of the first, so most of what it brings is late.
    """
    ledger, out, checkpoint = (scratch_path(spark, n) for n in ("ledger", "bounded", "stream"))

    def step(n, stream):
        L.finish(*L.start_ledger(stream, ledger, checkpoint, trigger=L.ALL_AVAILABLE))
        L.finish(L.start_bounded_counts(spark, ledger, out, f"{checkpoint}/counts", L.ALL_AVAILABLE))

    _in_two_landings(spark, folder, step)
    return L.exact_counts(spark, out, ledger)


@query(with_ctes("SELECT * FROM live_counts"))
def ledger_expired(spark, folder):
    """Totals when the folders of the folded batches are gone."""
    ledger = _two_batches(spark, folder, lambda ledger: L.compact_ledger(spark, ledger, L.last_batch(spark, ledger)))
    L.compact_ledger(spark, ledger, L.last_batch(spark, ledger))
    mf.expire(spark, ledger, versions=1)
    return M.live_totals(L.ledger_events(spark, ledger)).drop("sentiment_score_sum")


@query(with_ctes("SELECT * FROM live_counts"))
def ledger_compacted(spark, folder):
    """Totals of a ledger folded after each of its two batches."""
    ledger = _two_batches(spark, folder, lambda ledger: L.compact_ledger(spark, ledger, L.last_batch(spark, ledger)))
    L.compact_ledger(spark, ledger, L.last_batch(spark, ledger))
    return M.live_totals(L.ledger_events(spark, ledger)).drop("sentiment_score_sum")


@query(with_ctes("""
    SELECT key, body FROM keyed WHERE event_time IS NULL OR dept_name IS NULL OR zone IS NULL"""))
def stream_quarantine(spark, folder):
    rejected = scratch_path(spark, "rejected")
    L.finish(*L.start_ledger(
        _landed(spark, folder), scratch_path(spark, "ledger"), scratch_path(spark, "stream"),
        quarantine=rejected, trigger=L.ALL_AVAILABLE,
    ))
    return spark.read.schema("key string, body string").json(rejected)


@query(with_ctes("SELECT job_name || '.json' AS key, text AS body FROM listener_files"))
def stream_transcripts(spark, folder):
    """Transcription results that arrive as files, sent on as messages with bodies and decoded."""
    landed, sent = scratch_path(spark, "transcripts"), scratch_path(spark, "sent")
    write_transcripts(I.listener_files(spark, folder), landed)
    L.finish(
        as_raw(arrived_transcripts(spark, landed)).select("value").writeStream.format("text").option("path", sent)
        .option("checkpointLocation", scratch_path(spark, "stream")).trigger(**L.ALL_AVAILABLE).start()
    )
    return M.decode(spark.read.text(sent)).select("key", "body")


@query(with_ctes("SELECT * FROM live_scored"))
def stream_scored_counts(spark, folder):
    return M.live_totals(_ledger(spark, folder, fixed_model()))


@query()
def stream_counts_trained(spark, folder):
    """Totals with the trained model's predictions."""
    return M.live_totals(_ledger(spark, folder, trained_model(spark, folder)))


@query(with_ctes("""
    SELECT coalesce(v.dept_name, l.dept_name) || coalesce(v.zone, l.zone)
             || coalesce(v.time_of_day, l.time_of_day) || coalesce(v.season, l.season) AS row_key,
           coalesce(v.dept_name, l.dept_name) AS dept_name, coalesce(v.zone, l.zone) AS zone,
           coalesce(v.time_of_day, l.time_of_day) AS time_of_day, coalesce(v.season, l.season) AS season,
           coalesce(most_common_words, '') AS most_common_words,
           coalesce(least_common_words, '') AS least_common_words,
           coalesce(sentiment_score_sum, 0) AS sentiment_score_sum,
           coalesce(v.sentiment_score_total, 0) + coalesce(l.sentiment_score_total, 0) AS sentiment_score_total
    FROM the_view v FULL JOIN live_counts l
      ON v.dept_name = l.dept_name AND v.zone = l.zone AND v.time_of_day = l.time_of_day AND v.season = l.season"""))
def merged_view_after_stream(spark, folder):
    live = M.live_totals(_ledger(spark, folder))
    return S.merge_counters(I.labelled_view(spark, folder), live)


_VIEW_AND_EVENTS = with_ctes("""
    SELECT coalesce(v.dept_name, l.dept_name) || coalesce(v.zone, l.zone)
             || coalesce(v.time_of_day, l.time_of_day) || coalesce(v.season, l.season) AS row_key,
           coalesce(v.dept_name, l.dept_name) AS dept_name, coalesce(v.zone, l.zone) AS zone,
           coalesce(v.time_of_day, l.time_of_day) AS time_of_day, coalesce(v.season, l.season) AS season,
           coalesce(most_common_words, '') AS most_common_words,
           coalesce(least_common_words, '') AS least_common_words,
           CAST(0 AS BIGINT) AS sentiment_score_sum, coalesce(l.sentiment_score_total, 0) AS sentiment_score_total
    FROM the_view v FULL JOIN live_counts l
      ON v.dept_name = l.dept_name AND v.zone = l.zone AND v.time_of_day = l.time_of_day AND v.season = l.season""")


def _counted_view(spark, folder, view):
    """Called between the batches of a ledger: writes a view that holds the first of them."""
    zero = F.lit(0).cast("long")

    def build(ledger):
        held = L.last_batch(spark, ledger)
        words = I.labelled_view(spark, folder).withColumns({"sentiment_score_sum": zero, "sentiment_score_total": zero})
        counted = S.merge_counters(words, M.live_totals(L.ledger_events(spark, ledger, up_to_batch=held)))
        write_view(counted, view, version=1, held_batch=held)

    return build


@query(_VIEW_AND_EVENTS)
def merged_view_after_cut(spark, folder):
    """Words of the recordings and counters of all events, when the view holds the ledger's first
    batch and the rest, with copies of events that it holds, is added live."""
    view = scratch_path(spark, "view")
    ledger = _two_batches(spark, folder, _counted_view(spark, folder, view))
    return L.current_view(spark, view, ledger)


@query(_VIEW_AND_EVENTS)
def maintained_view_after_cut(spark, folder):
    """The same from a stored view that the second batch advances, read without the ledger."""
    view, ledger, checkpoint = scratch_path(spark, "view"), scratch_path(spark, "ledger"), scratch_path(spark, "stream")

    def step(n, stream):
        L.finish(*L.start_ledger(stream, ledger, checkpoint, trigger=L.ALL_AVAILABLE, view=view if n else None))
        if n == 0:
            _counted_view(spark, folder, view)(ledger)

    _in_two_landings(spark, folder, step)
    return view_table(spark, view)


@query(with_ctes("SELECT * FROM recordings"))
def append_new_recordings(spark, folder):
    """Recordings of one kind are in the source table already; a landing that holds all of them
    adds the others only."""
    path = scratch_path(spark, "source")
    landed = I.sources(spark, folder)
    write_recordings(landed.where(F.col("kind") == "view"), path)
    added = P.new_recordings(I.recordings(spark, folder), recordings_orc(spark, path))
    write_recordings(added, path, mode="append")
    return recordings_orc(spark, path)


@query(with_ctes("SELECT * FROM recordings"))
def append_from_landing(spark, folder):
    """Three landings of CSV files, the last of which repeats the first, appended as they arrive."""
    landing, table, checkpoint = (scratch_path(spark, n) for n in ("landing", "source", "stream"))
    rows = I.recordings(spark, folder)
    write_recordings(rows.limit(0), table)
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for n, part in enumerate((0, 1, 0)):
        write_csv(rows.where(half == part), f"{landing}/{n}")
        L.finish(start_append(spark, f"{landing}/*", table, f"{table}-archive", checkpoint))
    return recordings_orc(spark, table)


@query(with_ctes("""
    SELECT id, dept_name, zone, time_of_day, date_of_event, duration, text, CASE
      WHEN dept_name IS NULL OR zone IS NULL OR time_of_day IS NULL OR date_of_event IS NULL
        OR duration IS NULL OR text IS NULL THEN 'missing field'
      WHEN TRY_CAST(left(time_of_day, 2) AS INTEGER) IS NULL THEN 'bad time'
      WHEN TRY_CAST(right(left(date_of_event, 7), 2) AS INTEGER) IS NULL THEN 'bad date' ELSE 'appended' END AS problem
    FROM dirty"""))
def append_quarantine(spark, folder):
    """A landing with faults: what was appended, and what was kept aside with its problem."""
    landing, table, checkpoint, rejected = (scratch_path(spark, n) for n in ("landing", "source", "stream", "rejected"))
    rows = I.dirty_recordings(spark, folder)
    write_recordings(rows.limit(0), table)
    write_csv(rows, f"{landing}/0")
    L.finish(start_append(spark, f"{landing}/*", table, f"{table}-archive", checkpoint, quarantine=rejected))
    bad = rejected_landings(spark, rejected).select(*RECORDING.names, "problem")
    return recordings_orc(spark, table).withColumn("problem", F.lit("appended")).unionByName(bad)


@query(with_ctes("""
    SELECT CASE WHEN kind <> 'error' THEN id END AS id, dept_name, zone, time_of_day, date_of_event, duration, text FROM sources"""))
def append_twice(spark, folder):
    """A landing that repeats itself, some rows without id, appended two times."""
    path, landing = (scratch_path(spark, n) for n in ("source", "landing"))
    landed = I.sources(spark, folder)
    landed = landed.select(F.when(F.col("kind") != "error", F.col("id")).alias("id"), *RECORDING.names[1:], "kind")
    landed.write.parquet(landing)  # read several times
    landed = spark.read.schema(landed.schema).parquet(landing)
    write_recordings(landed.where(F.col("kind") == "view"), path)
    twice = landed.unionByName(landed).select(*RECORDING.names)
    for _ in range(2):
        added = P.new_recordings(twice, recordings_orc(spark, path))
        write_recordings(added, path, mode="append")
    return recordings_orc(spark, path)
