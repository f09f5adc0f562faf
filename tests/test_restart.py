"""Streams on a clock: stopped, killed between two steps of a batch, and started again."""

import time

import pytest
from pyspark.errors import StreamingQueryException

from speechviews.sinks import manifest as mf
from speechviews.sources.streams import file_messages
from speechviews.streaming import live as L
from speechviews.streaming.progress import Progress

from test_live import land


def key(n):
    return f"09122020143000.cpd.zone1.noAudio.{n}"


def waited(condition, seconds=60):
    end = time.time() + seconds
    while not condition() and time.time() < end:
        time.sleep(0.2)
    assert condition()


@pytest.fixture
def progress(spark):
    listener = Progress().attached(spark)
    yield listener
    spark.streams.removeListener(listener)


def test_a_stream_on_a_clock_is_stopped_and_started_again(spark, tmp_path, progress):
    ledger, cp = str(tmp_path / "ledger"), str(tmp_path / "cp")
    for part in range(3):
        land(tmp_path / "in", f"{part}.txt", *[{"key": key(n)} for n in range(10 * part, 10 * part + 15)])  # five in the next file too
        (query,) = L.start_ledger(file_messages(spark, str(tmp_path / "in")), ledger, cp)
        assert query.isActive
        waited(lambda: mf.newest_batch(mf.read(spark, ledger)) == part)
        query.stop()
    assert L.ledger_events(spark, ledger).count() == 35
    waited(lambda: sum(b["rows"] for b in progress.batches) >= 30)
    assert not progress.errors


@pytest.mark.parametrize("step", ["land", "add_batch"])
def test_a_batch_killed_between_its_steps_loses_and_doubles_nothing(spark, tmp_path, monkeypatch, progress, step):
    ledger, out, cp = (str(tmp_path / n) for n in ("ledger", "out", "cp"))
    real, killed = getattr(mf, step), []

    def dies_after(*args, **facts):
        result = real(*args, **facts) if step == "land" else None  # written and not named, or not even written to the manifest
        if not killed:
            killed.append(1)
            raise RuntimeError("killed")
        return result or real(*args, **facts)

    land(tmp_path / "in", "0.txt", *[{"key": key(n)} for n in range(20)])
    monkeypatch.setattr(mf, step, dies_after)
    with pytest.raises(StreamingQueryException):
        L.finish(*L.start_ledger(file_messages(spark, str(tmp_path / "in")), ledger, cp, trigger=L.ALL_AVAILABLE))
    assert mf.read(spark, ledger) == mf.EMPTY and (tmp_path / "ledger" / "batches" / "batch_id=0").exists()
    monkeypatch.setattr(mf, step, real)
    land(tmp_path / "in", "1.txt", *[{"key": key(n)} for n in range(15, 30)])
    L.finish(*L.start_ledger(file_messages(spark, str(tmp_path / "in")), ledger, cp, trigger=L.ALL_AVAILABLE))
    assert L.ledger_events(spark, ledger).count() == 30 and mf.read(spark, ledger)["live"] == [0, 1]
    L.finish(L.start_bounded_counts(spark, ledger, out, f"{cp}/counts", L.ALL_AVAILABLE))
    assert sum(r.sentiment_score_total for r in L.exact_counts(spark, out, ledger).collect()) == 30
    waited(lambda: progress.errors)
    assert all(b["dropped"] == 0 for b in progress.batches)
