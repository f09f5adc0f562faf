"""Column expressions against literal values."""

import datetime

import pytest
from pyspark.sql import functions as F

from speechviews.functions import daytime, formats, keys, text

T, K = F.col("t"), F.col("k")


@pytest.mark.parametrize("raw, expected", [
    ("Go! (Officer), no; 10-4?", "officer 10-4"),
    ("stop\nnow please", "stopnow please"),
    ("tab\there", "tabhere"),
    ("don't", "don't"),
    ("a an to", ""),
    ("", ""),
    ("  two  blanks  ", "two blanks"),
    ("\x01abc\x02 \rxyz\r", "abc xyz"),
    ("in\x01side", "in\x01side"),
    ("UPPER Größe", "upper größe"),
    ("ab\U0001F600 \U0001F600x \U0001F600 ab", "ab\U0001F600 \U0001F600x"),
    ("one,two . three", "onetwo three"),
    ("\r", ""),
])
def test_normalise(one, raw, expected):
    assert one(text.normalise(T), t=("string", raw)) == expected


def test_letter_words(one):
    assert one(text.letter_words(T), t=("string", "Don't STOP 24 Zürich")) == ["don", "t", "stop", "zürich"]


def test_drop_listed_keeps_repetitions(one):
    kept = text.drop_listed(F.split(T, " "), ["THE"])
    assert one(kept, t=("string", "the cat The cat")) == ["cat", "cat"]


def test_lists(one):
    assert one(text.display_list(T), t=("string", "a,b,c")) == "a, b, c"
    assert one(text.display_list(T), t=("string", "")) == ""
    assert one(text.comma_list(F.split(T, " ")), t=("string", "a b")) == "a,b"


@pytest.mark.parametrize("time, bucket", [
    ("00:00:00", "latenight"), ("05:59:59", "latenight"), ("06:00:00", "morn"), ("11:59:00", "morn"),
    ("12:00:00", "aftrn"), ("17:59:00", "aftrn"), ("18:00:00", "night"), ("23:59:00", "night"),
    ("99:00:00", "night"), ("-1:00", "night"), ("9:15", None), ("xx:00", None),
])
def test_time_bucket(one, time, bucket):
    assert one(daytime.time_bucket(daytime.hour_of(T)), t=("string", time)) == bucket


@pytest.mark.parametrize("date, season", [
    ("2020-01-31", "winter"), ("2020-03-31", "winter"), ("2020-04-01", "spring"), ("2020-06-30", "spring"),
    ("2020-07-01", "summer"), ("2020-09-30", "summer"), ("2020-10-01", "fall"), ("2020-12-01", "fall"),
    ("2020-00-01", "winter"), ("2020-13-01", "fall"), ("unknown", None),
])
def test_season(one, date, season):
    assert one(daytime.season_of(daytime.month_of(T)), t=("string", date)) == season


def test_key_parts(one):
    key = "09122020143000.cpd.zone1.noAudio.1607"
    assert one(keys.key_time(K), k=("string", key)) == datetime.datetime(2020, 12, 9, 14, 30)
    assert one(keys.key_dept(K), k=("string", key)) == "cpd"
    assert one(keys.key_zone(K), k=("string", key)) == "zone1"


@pytest.mark.parametrize("key", [
    "1122020103000.cpd.zone1.1607.mp3", "nonsense", "", "09122020143000.cpd", "31022020143000.cpd.zone1.x",
    "09132020143000.cpd.zone1.x", "09122020253000.cpd.zone1.x", "09122020143000..zone1.x",
])
def test_malformed_key(one, key):
    time = F.when(keys.is_well_formed(K), keys.key_time(K))
    assert one(time, k=("string", key)) is None


def test_upload_key(one):
    ts = datetime.datetime(2020, 12, 9, 14, 30, 1, 234567)
    key = keys.upload_key(F.lit("2020-12-09"), F.lit("14:30"), F.lit("cpd"), F.lit("zone1"), F.lit(True), keys.epoch_millis(T))
    assert one(key, t=("timestamp_ntz", ts)) == "09122020143000.cpd.zone1.yesAudio.1607524201234"


def test_upload_key_is_null_without_zone(one):
    key = keys.upload_key(F.lit("2020-12-09"), F.lit("14:30"), F.lit("cpd"), T, F.lit(False), F.lit(1))
    assert one(key, t=("string", None)) is None


def test_listener_key_is_padded(one):
    ts = datetime.datetime(2020, 2, 1, 3, 4, 5, 60)
    key = one(keys.listener_key(T, F.lit("cpd"), F.lit("zone1")), t=("timestamp_ntz", ts))
    assert key == "01022020030400.cpd.zone1.1580526245.000060.mp3"
    assert one(keys.key_time(K), k=("string", key)) == datetime.datetime(2020, 2, 1, 3, 4)
    assert one(keys.job_name(K), k=("string", key)) == "01022020030400.cpd.zone1.1580526245.000060"


def test_event_id_and_uri(one):
    assert one(keys.event_id(K), k=("string", "a.b.json")) == "a.b"
    assert one(keys.event_id(K), k=("string", "a.json.b")) == "a.json.b"
    assert one(keys.object_uri("bucket", K), k=("string", "x.mp3")) == "s3://bucket/x.mp3"


@pytest.mark.parametrize("parts", [("a", "b"), ('with "quotes"', "and, commas"), ("", "]["), ("\\", "\u0001é")])
def test_packed_round_trip(spark, parts):
    df = spark.createDataFrame([parts], "a string, b string").select(keys.packed("a", "b").alias("p"))
    assert tuple(df.select(*keys.unpacked(F.col("p"), ["a", "b"])).first()) == parts


@pytest.mark.parametrize("hexed, number", [("000000000000002A", 42), ("FFFFFFFFFFFFFFFE", -2), ("0000000000000000", 0)])
def test_counter(one, hexed, number):
    assert one(formats.counter_value(F.unhex(T)), t=("string", hexed)) == number
    assert one(F.hex(formats.counter_bytes(F.lit(number))), t=("string", "")) == hexed


def test_percent(one):
    share = formats.percent(F.col("a"), F.col("b"))
    assert one(share, a=("bigint", 1), b=("bigint", 3)) == 1 / 3 * 100
    assert one(share, a=("bigint", 0), b=("bigint", 0)) is None
    assert one(formats.percent_text(share), a=("bigint", 1), b=("bigint", 3)) == "33.33%"
    assert one(formats.percent_text(share), a=("bigint", 0), b=("bigint", 0)) is None


def test_transcript_with_a_bracket(spark, tmp_path):
    from speechviews.sources.tables import transcripts_json

    (tmp_path / "t.json").write_text('{"results":{"transcripts":[{"transcript":"hi [x] there"}],"items":[1]}}\n')
    assert tuple(transcripts_json(spark, str(tmp_path)).first()) == ("t", "hi [x] there")


def test_times_do_not_depend_on_the_session_zone(spark, one):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # This hour is skipped in New York.
        assert one(F.hour(keys.key_time(K)), k=("string", "08032020023000.cpd.zone1.x")) == 2
        ts = datetime.datetime(2020, 3, 8, 2, 30)
        assert one(keys.epoch_millis(T), t=("timestamp_ntz", ts)) == 1583634600000
        assert one(keys.listener_key(T, F.lit("d"), F.lit("z")), t=("timestamp_ntz", ts)).startswith("08032020023000.d.z.1583634600.")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
