"""Messages and streams: bad input, duplicates, late bodies, replays."""

import json

import pytest
from pyspark.sql import functions as F

from speechviews.operators import messages as M
from speechviews.schemas import VIEW
from speechviews.sinks import manifest as mf
from speechviews.sinks.tables import write_view
from speechviews.sources.streams import arrived_objects, arrived_reports, as_raw, file_messages, kafka_messages
from speechviews.sources.tables import view_table
from speechviews.streaming import live as L

KEY = "09122020143000.cpd.zone1.noAudio.1607"
OTHER = "09122020143000.cpd.zone1.noAudio.1608"
MORNING = "01022020083000.cpd.zone2.yesAudio.5"


def raw(spark, *values):
    return spark.createDataFrame([(v if isinstance(v, str) else json.dumps(v),) for v in values], "value string")


def land(folder, name, *values):
    folder.mkdir(exist_ok=True)
    lines = [v if isinstance(v, str) else json.dumps(v) for v in values]
    (folder / name).write_text("\n".join(lines) + "\n")


def totals(df):
    return {r.zone: (r.sentiment_score_sum, r.sentiment_score_total) for r in M.live_totals(df).collect()}


def test_decode(spark):
    rows = M.decode(raw(spark, {"key": KEY, "body": "hi"}, {"key": KEY}, "nope", {"key": KEY, "extra": 1})).collect()
    assert [(r.key, r.body) for r in rows] == [(KEY, "hi"), (KEY, None), (None, None), (KEY, None)]
    assert M.corrupt(M.decode(raw(spark, "nope", {"key": KEY}))).first()["_corrupt_record"] == "nope"


def test_parsed_and_malformed_split_the_messages(spark):
    decoded = M.decode(raw(spark, {"key": KEY}, {"key": "1122020103000.cpd.zone1.1607.mp3"}, "nope"))
    row = M.parse_keys(decoded).first()
    assert (row.dept_name, row.zone, row.time_of_day, row.season) == ("cpd", "zone1", "aftrn", "fall")
    assert M.malformed(decoded).count() == 2


def test_duplicate_upload_counts_once_and_keeps_the_body(spark):
    decoded = M.decode(raw(spark, {"key": KEY + ".json"}, {"key": KEY, "body": "text"}, {"key": KEY, "body": ""}, {"key": OTHER}))
    kept = {r.event_id: (r.key, r.body) for r in M.deduplicated(decoded).collect()}
    assert kept == {KEY: (KEY, "text"), OTHER: (OTHER, None)}
    assert M.live_counts(M.parse_keys(decoded)).first().sentiment_score_total == 2


def test_storage_event_with_several_records(spark):
    event = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in ("a+b%C3%A9", "c%2Bd")]}
    assert [(r.bucket, r.key) for r in M.storage_event_keys(raw(spark, event)).collect()] == [("b", "a bé"), ("b", "c+d")]


def start(spark, tmp_path, **options):
    source = file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    L.finish(*L.start_ledger(source, str(tmp_path / "ledger"), str(tmp_path / "checkpoint"),
                             quarantine=str(tmp_path / "bad"), trigger=L.ALL_AVAILABLE, **options))
    return L.ledger_events(spark, str(tmp_path / "ledger"))


def test_ledger_over_several_batches_and_restarts(spark, tmp_path):
    land(tmp_path / "in", "1.txt", {"key": KEY + ".json"}, {"key": KEY, "body": "x"}, "nope")
    assert totals(start(spark, tmp_path)) == {"zone1": (0, 1)}
    land(tmp_path / "in", "2.txt", {"key": KEY + ".json"}, {"key": OTHER})
    land(tmp_path / "in", "3.txt", {"key": MORNING}, {"key": "bad.key"})
    ledger = start(spark, tmp_path)
    assert totals(ledger) == {"zone1": (0, 2), "zone2": (0, 1)}
    assert spark.read.json(str(tmp_path / "bad")).count() == 2
    # A view that holds the first batch lacks the events that have no message in it.
    lacking = {r.zone: r.sentiment_score_total for r in L.totals_after(ledger, 0).collect()}
    assert lacking == {"zone1": 1, "zone2": 1}
    # A batch that runs again overwrites its own partition.
    first = spark.read.schema(L.LEDGER).parquet(str(tmp_path / "ledger" / "batches")).where("batch_id = 0").drop("batch_id").cache()
    first.count()
    first.write.mode("overwrite").parquet(str(tmp_path / "ledger" / "batches" / "batch_id=0"))
    assert totals(L.ledger_events(spark, str(tmp_path / "ledger"))) == {"zone1": (0, 2), "zone2": (0, 1)}


def test_what_a_view_lacks_is_counted_by_event(spark, tmp_path):
    def events(*rows):
        return spark.createDataFrame(rows, "event_id string, dept_name string, zone string, time_of_day string, season string, batch_id long, positive_batch long")

    group = ("cpd", "z", "morn", "fall")
    found = events(("held", *group, 0, 0), ("held, later positive", *group, 0, 2), ("new", *group, 1, None), ("new and positive", *group, 2, 2))
    row = L.totals_after(found, 0).first()
    assert (row.sentiment_score_sum, row.sentiment_score_total) == (2, 2)
    assert L.totals_after(found, 2).count() == 0
    everything = L.totals_after(found.withColumn("positive", F.col("positive_batch").isNotNull()), None).first()
    assert (everything.sentiment_score_sum, everything.sentiment_score_total) == (3, 4)


def test_a_maintained_view_equals_the_merged_one(spark, tmp_path):
    view, ledger = str(tmp_path / "view"), str(tmp_path / "ledger")
    known = [(KEY[:14], "cpd", "zone1", "aftrn", "fall", "a", "b", 0, 0), ("k", "x", "zone9", "night", "winter", "c", "d", 4, 7)]
    write_view(spark.createDataFrame(known, VIEW), view, version=1)
    rows = lambda df: sorted(map(tuple, df.drop("row_key").collect()))
    batches = [({"key": KEY},), ({"key": KEY}, {"key": OTHER}), ({"key": KEY},), ({"key": MORNING}, {"key": KEY})]
    versions = []
    for n, values in enumerate(batches):
        land(tmp_path / "in", f"{n}.json", *values)
        start(spark, tmp_path)
        expected = rows(L.current_view(spark, view, ledger))
        if n == 2:
            L.compact_ledger(spark, ledger, 1)
        versions.append(L.advance_view(spark, view, ledger))
        assert L.advance_view(spark, view, ledger) == versions[-1]
        assert rows(view_table(spark, view)) == rows(L.current_view(spark, view, ledger)) == expected
    assert versions == [2, 3, 3, 4]  # the third batch has copies alone
    found = {r.zone: (r.sentiment_score_sum, r.sentiment_score_total) for r in view_table(spark, view).collect()}
    assert found == {"zone1": (0, 2), "zone2": (0, 1), "zone9": (4, 7)}


def test_a_positive_that_comes_later_is_added_to_a_maintained_view(spark, tmp_path):
    view, ledger = str(tmp_path / "view"), str(tmp_path / "ledger")
    write_view(spark.createDataFrame([], VIEW), view, version=1)
    event = ("cpd", "zone1", "aftrn", "fall")
    for batch, rows in enumerate(([("e", False), ("f", True)], [("e", True), ("f", True)])):
        table = spark.createDataFrame([(i, *event, p, None, False) for i, p in rows], ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in L.LEDGER[:-1]))
        mf.land(table, ledger, f"batches/batch_id={batch}")
        mf.add_batch(spark, ledger, batch)
        L.advance_view(spark, view, ledger)
        r = view_table(spark, view).first()
        assert (r.sentiment_score_sum, r.sentiment_score_total) == (1 + batch, 2)


def test_compaction_keeps_events_and_their_batches(spark, tmp_path):
    land(tmp_path / "in", "1.txt", {"key": KEY}, {"key": OTHER})
    start(spark, tmp_path)
    land(tmp_path / "in", "2.txt", {"key": KEY + ".json"}, {"key": MORNING})
    before = sorted(map(tuple, start(spark, tmp_path).collect()), key=repr)
    ledger = str(tmp_path / "ledger")
    for up_to in (0, 1):
        L.compact_ledger(spark, ledger, up_to)
        after = L.ledger_events(spark, ledger)
        assert sorted(map(tuple, after.collect()), key=repr) == before
        assert {r.zone: r.sentiment_score_total for r in L.totals_after(after, 0).collect()} == {"zone2": 1}
    land(tmp_path / "in", "3.txt", {"key": "09121999143000.cpd.zone1.noAudio.1"})
    assert totals(start(spark, tmp_path)) == {"zone1": (0, 3), "zone2": (0, 1)}


def test_broken_reports_do_not_become_messages(spark, tmp_path):
    from speechviews.schemas import UPLOAD
    from speechviews.sources.streams import arrived_json
    from speechviews.sources.tables import rejected_json

    land(tmp_path / "in", "a.json", {"id": KEY, "text": "x"}, "{broken")
    for name, frame in (("good", arrived_reports(spark, str(tmp_path / "in"))), ("bad", rejected_json(arrived_json(spark, str(tmp_path / "in"), UPLOAD)))):
        L.finish(frame.writeStream.format("memory").queryName(name).trigger(availableNow=True).start(), timeout=60)
    assert [(r.key, r.body) for r in spark.table("good").collect()] == [(KEY + ".json", "x")]
    assert [r["_corrupt_record"] for r in spark.table("bad").collect()] == ["{broken"]


def test_late_body_adds_its_positive_only(spark):
    def batch(*messages):
        parsed = M.parse_keys(M.decode(raw(spark, *messages)))
        return M.events(M.with_positive(parsed.withColumn("prediction", F.lit(1.0))))

    without, later = batch({"key": KEY + ".json"}), batch({"key": KEY, "body": "good"})
    assert totals(without) == {"zone1": (0, 1)}
    assert totals(without.unionByName(later)) == {"zone1": (1, 1)}
    assert totals(later.unionByName(without).unionByName(later)) == {"zone1": (1, 1)}


def test_running_counts_drop_copies_but_no_old_event(spark, tmp_path):
    land(tmp_path / "in", "1.txt", {"key": KEY}, {"key": KEY + ".json"}, {"key": OTHER})
    land(tmp_path / "in", "2.txt", {"key": KEY}, {"key": "09121999143000.cpd.zone1.noAudio.1"}, {"key": MORNING})
    source = file_messages(spark, str(tmp_path / "in"), max_files_per_trigger=1)
    L.finish(L.start_running_counts(source, str(tmp_path / "out"), str(tmp_path / "cp"), L.ALL_AVAILABLE))
    L.compact_counts(spark, str(tmp_path / "out"), 0)
    counts = {r.zone: r.sentiment_score_total for r in L.latest_counts(spark, str(tmp_path / "out")).collect()}
    assert counts == {"zone1": 3, "zone2": 1}


def test_arrived_objects(spark, tmp_path):
    land(tmp_path / "in", "a.json", {"id": KEY, "text": "x"}, {"id": OTHER})
    land(tmp_path / "in", "ignored.mp3", "noise")
    query = arrived_objects(spark, str(tmp_path / "in")).writeStream.format("memory").queryName("arrived").trigger(availableNow=True).start()
    L.finish(query, timeout=60)
    assert {(r.key, r.file_name) for r in spark.table("arrived").collect()} == {(KEY + ".json", "a.json"), (OTHER + ".json", "a.json")}


def test_body_from_the_object(spark):
    messages = M.decode(raw(spark, {"key": KEY + ".json"}, {"key": OTHER, "body": "own"}, {"key": MORNING}))
    reports = spark.createDataFrame([(KEY, "report"), (OTHER, "not used")], "id string, text string")
    transcripts = spark.createDataFrame([("other job", "x")], "job_name string, text string")
    got = {r.event_id: r.body for r in M.with_bodies(messages, M.object_texts(reports, transcripts)).collect()}
    assert got == {KEY: "report", OTHER: "own", MORNING: None}


def test_arrived_reports_feed_the_ledger(spark, tmp_path):
    land(tmp_path / "in", "a.json", {"id": KEY, "text": "x"}, {"id": OTHER, "text": "y"})
    stream = as_raw(arrived_reports(spark, str(tmp_path / "in")))
    L.finish(*L.start_ledger(stream, str(tmp_path / "ledger"), str(tmp_path / "cp"), trigger=L.ALL_AVAILABLE))
    assert totals(L.ledger_events(spark, str(tmp_path / "ledger"))) == {"zone1": (0, 2)}


def test_landed_files_are_appended_once_and_archived(spark, tmp_path, recordings):
    from speechviews.sinks.tables import write_csv, write_recordings
    from speechviews.sources.tables import recordings_orc
    from speechviews.streaming.landing import start_append

    group = ("cpd", "zone1", "14:30:00", "2020-12-09")
    table, archive = str(tmp_path / "table"), tmp_path / "archive"
    write_recordings(recordings([]), table)
    for n, ids in enumerate(("ab", "bc", "d")):
        write_csv(recordings([(i, *group, f"text\n{i}") for i in ids]).coalesce(1), str(tmp_path / f"in/{n}"))
        L.finish(start_append(spark, str(tmp_path / "in/*"), table, str(archive), str(tmp_path / "cp")))
    assert sorted((r.id, r.text) for r in recordings_orc(spark, table).collect()) == [(i, f"text\n{i}") for i in "abcd"]
    assert any(archive.rglob("*.csv"))


def test_console_shows_rows(spark, tmp_path):
    land(tmp_path / "in", "1.txt", {"key": KEY})
    decoded = M.decode(file_messages(spark, str(tmp_path / "in"))).select("key", "body")
    query = L.start_console(decoded, trigger=L.ALL_AVAILABLE)
    L.finish(query, timeout=60)
    assert query.exception() is None


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        kafka_messages(spark, "localhost:9092", "topic", max_per_trigger=10)
