"""The manifest of batches, and counts whose state is bounded."""

import threading

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

from speechviews.operators import messages as M
from speechviews.sinks import manifest as mf
from speechviews.sources.streams import file_messages
from speechviews.streaming import live as L

from speechviews.operators import serving as S
from speechviews.schemas import VIEW
from speechviews.sinks.tables import upsert_view, write_csv, write_recordings, write_view
from speechviews.sources.tables import held_batch, recordings_orc, view_table
from speechviews.streaming.landing import landing_counts, rejected_landings, start_append

from test_live import land


def key(day, hour, n, zone="zone1"):
    return f"{day:02d}122020{hour:02d}0000.cpd.{zone}.noAudio.{n}"


def test_writers_that_meet_lose_no_version(spark, tmp_path):
    table = str(tmp_path / "t")
    assert mf.read(spark, table) == mf.EMPTY and mf.newest_batch(mf.EMPTY) is None

    def add(first):
        for b in range(first, first + 15):
            mf.add_batch(spark, table, b)

    threads = [threading.Thread(target=add, args=(n,)) for n in (0, 15, 30)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    found = mf.read(spark, table)
    assert found["live"] == list(range(45)) and found["version"] == 44
    assert mf.add_batch(spark, table, 3) == found  # a batch that runs again
    assert len(list((tmp_path / "t" / "manifest").glob("0*.json"))) == mf.KEPT_VERSIONS


def test_readers_open_live_folders_only_after_a_thousand_batches(spark, tmp_path):
    ledger, count = tmp_path / "ledger", 1000
    for b in range(count):
        folder = ledger / "batches" / f"batch_id={b}"
        folder.mkdir(parents=True)
        ids = [f"e{b}", f"e{b // 2}"]  # every event is in several batches
        columns = {"event_id": ids, **{c: ["x"] * 2 for c in ("dept_name", "zone", "time_of_day", "season")}, "positive": [False, b % 3 == 0]}
        table = pa.table({**columns, "event_time": pa.array([None, None], pa.timestamp("us", "UTC")), "late": [False] * 2})
        pq.write_table(table, folder / "part.parquet")
    mf.swap(spark, str(ledger), lambda old: {"live": list(range(count))})
    before = M.live_totals(L.ledger_events(spark, str(ledger))).first()
    assert before.sentiment_score_total == count
    L.compact_ledger(spark, str(ledger), count - 6)
    (ledger / "batches" / "batch_id=5000").mkdir()  # landing, not yet named
    events = L.ledger_events(spark, str(ledger))
    assert len(events.inputFiles()) <= 5 + 8
    assert M.live_totals(events).first() == before
    assert mf.expire(spark, str(ledger), up_to=9) == 0  # the first manifest still needs them
    assert mf.expire(spark, str(ledger), up_to=9, versions=1) == 10
    assert mf.expire(spark, str(ledger), versions=1) == count - 5 - 10
    assert len(list((ledger / "batches").iterdir())) == 6
    assert M.live_totals(L.ledger_events(spark, str(ledger))).first() == before
    L.compact_ledger(spark, str(ledger), count - 1)
    assert M.live_totals(L.ledger_events(spark, str(ledger))).first() == before


def test_a_landed_folder_is_never_replaced(spark, tmp_path):
    table = str(tmp_path / "t")
    for n in (1, 2):
        mf.land(spark.range(n), table, "batches/batch_id=0")
    assert spark.read.parquet(f"{table}/batches/batch_id=0").count() == 1
    assert not list((tmp_path / "t" / "staged").iterdir())


def test_state_stays_flat_over_two_days_and_late_events_count_once(spark, tmp_path):
    ledger, out, cp = (str(tmp_path / n) for n in ("ledger", "out", "cp"))
    states, sent = [], set()
    for part in range(6):
        day, hour = 1 + part // 3, 8 * (part % 3)
        keys = [key(day, hour + n % 8, 100 * part + n) for n in range(40)]
        copies = [k + ".json" for k in keys[::2]] + [key(1 + (part - 1) // 3, 8 * ((part - 1) % 3) + 7, 100 * (part - 1) + 39)] * (part > 0)
        late = [key(1, 0, f"late{n}", "zone2") for n in range(part)] + ([key(1, 0, 0)] if part > 2 else [])  # new ones, repeated ones, a copy
        land(tmp_path / "in", f"{part}.txt", *[{"key": k} for k in keys + copies + late])
        sent |= {k.removesuffix(".json") for k in keys + copies + late}
        L.finish(*L.start_ledger(file_messages(spark, str(tmp_path / "in")), ledger, cp, trigger=L.ALL_AVAILABLE, delay_hours=8))
        query = L.start_bounded_counts(spark, ledger, out, f"{cp}/counts", L.ALL_AVAILABLE, delay_hours=8)
        L.finish(query)
        operators = query.recentProgress[-1].stateOperators
        assert sum(o.numRowsDroppedByWatermark for p in query.recentProgress for o in p.stateOperators) == 0
        assert all("rocksdbGetCount" in o.customMetrics for o in operators)
        states.append(sum(o.numRowsTotal for o in operators))
    assert max(states[2:]) <= 100 and max(states[2:]) - min(states[2:]) <= 10  # of 240 events
    found = {r.zone: r.n for r in L.exact_counts(spark, out, ledger).groupBy("zone").agg(F.sum("sentiment_score_total").alias("n")).collect()}
    assert found == {z: sum(f".{z}." in k for k in sent) for z in ("zone1", "zone2")}
    assert {r.zone: r.n for r in L.late_events(spark, ledger).groupBy("zone").agg(F.count("*").alias("n")).collect()}["zone2"] == 4
    assert L.ledger_events(spark, ledger).count() == len(sent)
    L.compact_ledger(spark, ledger, 3)
    assert L.late_events(spark, ledger).count() == 4
    L.compact_counts(spark, out, 3)
    again = L.exact_counts(spark, out, ledger).agg(F.sum("sentiment_score_total")).first()[0]
    assert again == len(sent)


def test_counting_may_start_before_the_first_batch(spark, tmp_path):
    ledger, out, cp = (str(tmp_path / n) for n in ("ledger", "out", "cp"))
    for expected in (0, 2):
        L.finish(L.start_bounded_counts(spark, ledger, out, f"{cp}/counts", L.ALL_AVAILABLE))
        assert sum(r.sentiment_score_total for r in L.exact_counts(spark, out, ledger).collect()) == expected
        land(tmp_path / "in", "0.txt", {"key": key(1, 1, 1)}, {"key": key(1, 2, 2)})
        L.finish(*L.start_ledger(file_messages(spark, str(tmp_path / "in")), ledger, cp, trigger=L.ALL_AVAILABLE))


def view_rows(spark, *groups, total=1):
    return spark.createDataFrame([(f"cpd{z}{t}{s}", "cpd", z, t, s, "a,b", "c", 1, total) for z, t, s in groups], VIEW)


def test_an_upsert_writes_the_partitions_that_change(spark, tmp_path):
    path = str(tmp_path / "view")
    groups = [(z, t, s) for z in "xyz" for t in ("morn", "night") for s in ("fall", "winter")]
    write_view(view_rows(spark, *groups), path, version=1, held_batch=3)
    assert upsert_view(view_rows(spark, ("y", "morn", "fall"), total=9), path, held_batch=4) == 2
    assert upsert_view(view_rows(spark, ("new", "eve", "fall"), total=5), path) == 3
    assert upsert_view(view_rows(spark), path, held_batch=5) == 4
    written = sorted(str(p.relative_to(tmp_path / "view" / "data")) for p in (tmp_path / "view" / "data").glob("version=[23]/*/*"))
    assert written == ["version=2/season=fall/time_of_day=morn", "version=3/season=fall/time_of_day=eve"]
    expected = {g: 1 for g in groups} | {("y", "morn", "fall"): 9, ("new", "eve", "fall"): 5}
    found = view_table(spark, path).collect()
    assert {(r.zone, r.time_of_day, r.season): r.sentiment_score_total for r in found} == expected and len(found) == 13
    assert view_table(spark, path).columns == VIEW.names and held_batch(spark, path) == 5
    assert {r.sentiment_score_total for r in view_table(spark, path, version=1).collect()} == {1}
    assert view_table(spark, path, version=2).count() == 12
    files = S.lookup_group(view_table(spark, path), "cpd", "y", "morn", "fall").inputFiles()
    assert any("version=2" in f for f in files)


def scanned(df):
    """Rows that the scan of a plan gave."""
    df.collect()
    node = df._jdf.queryExecution().executedPlan()
    while node.children().size() or node.nodeName() == "AdaptiveSparkPlan":
        node = node.executedPlan() if node.nodeName() == "AdaptiveSparkPlan" else node.children().apply(0)
    return node.metrics().apply("numOutputRows").value()


def test_a_lookup_by_key_skips_files_without_the_key(spark, tmp_path):
    path = str(tmp_path / "view")
    groups = [(f"zone{n:04d}", t, s) for n in range(400) for t in ("morn", "night") for s in ("fall", "winter")]
    write_view(view_rows(spark, *groups), path, version=1)
    view = view_table(spark, path)
    assert scanned(view) == 1600
    assert scanned(S.lookup(view, "cpdzone0200nightfall")) <= 400  # one file of four, though the key is in the range of all
    assert S.lookup(view, "cpdzone0200nightfall").count() == 1
    assert scanned(S.lookup(view, "cpdzone0200nowhere")) == 0


def test_landed_rows_are_appended_or_kept_with_their_problem(spark, tmp_path, recordings):
    table, archive, kept = str(tmp_path / "table"), str(tmp_path / "archive"), str(tmp_path / "rejected")
    good, late = ("cpd", "zone1", "14:30:00", "2020-12-09"), ("cpd", "zone1", "xx", "2020-12-09")
    write_recordings(recordings([("held", *good, "t")]), table)
    write_csv(recordings([("a", *good, "x"), ("a", *good, "x"), ("held", *good, "t"), ("b", *late, "y"), ("c", *good, None)]).coalesce(1), str(tmp_path / "in/0"))
    (tmp_path / "in/1").mkdir()
    (tmp_path / "in/1/torn.csv").write_text("d,cpd,zone1,14:30:00,2020-12-09,not a number,text\ne,cpd,zone1,14:30:00,2020-12-09,1.0,fine\n")
    for _ in range(2):
        L.finish(start_append(spark, str(tmp_path / "in/*"), table, archive, str(tmp_path / "cp"), quarantine=kept))
    assert sorted(r.id for r in recordings_orc(spark, table).collect()) == ["a", "e", "held"]
    assert sorted((r.id, r.problem) for r in rejected_landings(spark, kept).collect()) == [("b", "bad time"), ("c", "missing field"), ("d", "broken line")]
    (counts,) = landing_counts(spark, kept).collect()
    assert (counts.read, counts.rejected, counts.appended) == (7, 3, 2)
