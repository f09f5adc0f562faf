"""Row keys and event keys: ``DDMMYYYYHHMMSS.dept.zone[.audioFlag].unique[.extension]``."""

from pyspark.sql import Column, functions as F

from speechviews.functions.daytime import two_digits

# Fixed values of the key format.
KEY_START = r"^[0-9]{14}\.[^.]+\.[^.]+\."
WITH_AUDIO = "yesAudio"
WITHOUT_AUDIO = "noAudio"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def row_key(*parts) -> Column:
    """Parts joined without separator. For display only: joins use the four columns."""
    return F.concat(*[_col(p) for p in parts])


def packed(*parts) -> Column:
    """Non-null strings as one string from which they can be taken out again.

    Counting and sorting by one short string costs about half of doing so by four.
    """
    return F.to_json(F.array(*[_col(p) for p in parts]))


def unpacked(key: Column, names) -> list[Column]:
    parts = F.from_json(key, "array<string>")
    return [parts[i].alias(name) for i, name in enumerate(names)]


def _epoch_micros(ts: Column) -> Column:
    """Microseconds since the epoch of a zone-less timestamp, taken as UTC whatever the session's zone."""
    days = F.datediff(ts.cast("timestamp_ntz").cast("date"), F.lit("1970-01-01").cast("date")).cast("long")
    minutes = days * 1440 + F.hour(ts) * 60 + F.minute(ts)
    return minutes * 60_000_000 + (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("long")


def epoch_millis(ts: Column) -> Column:
    return F.floor(_epoch_micros(ts) / 1000).cast("long")


def epoch_seconds_text(ts: Column) -> Column:
    """Seconds since the epoch with six decimals."""
    micros = _epoch_micros(ts)
    fraction = F.pmod(micros, F.lit(1_000_000))
    seconds = ((micros - fraction) / 1_000_000).cast("long")
    return F.concat(seconds.cast("string"), F.lit("."), F.lpad(fraction.cast("string"), 6, "0"))


def _dotted(*parts: Column) -> Column:
    """Parts joined by dots; null when any part is null."""
    joined = parts[0]
    for part in parts[1:]:
        joined = F.concat(joined, F.lit("."), part)
    return joined


def audio_flag(recording: Column) -> Column:
    return F.when(recording, WITH_AUDIO).otherwise(WITHOUT_AUDIO)


def has_audio_flag(key: Column) -> Column:
    return key.contains(WITH_AUDIO)


def upload_key(date: Column, time: Column, dept: Column, zone: Column,
               recording: Column, unique: Column) -> Column:
    """Key of an upload from a form date ``YYYY-MM-DD`` and time ``HH:MM``."""
    digits = F.replace(date, F.lit("-"), F.lit(""))
    stamp = F.concat(
        F.substring(digits, 7, 2), F.substring(digits, 5, 2), F.substring(digits, 1, 4),
        F.replace(time, F.lit(":"), F.lit("")), F.lit("00"),
    )
    return _dotted(stamp, dept, zone, audio_flag(recording), unique.cast("string"))


def listener_key(ts: Column, dept: Column, zone: Column) -> Column:
    """Key of a captured audio file. Day and month are padded, so the key can be parsed."""
    stamp = F.concat(
        two_digits(F.dayofmonth(ts)), two_digits(F.month(ts)), F.lpad(F.year(ts).cast("string"), 4, "0"),
        two_digits(F.hour(ts)), two_digits(F.minute(ts)), F.lit("00"),
    )
    return _dotted(stamp, dept, zone, epoch_seconds_text(ts), F.lit("mp3"))


def is_well_formed(key: Column) -> Column:
    return key.rlike(KEY_START)


def key_time(key: Column) -> Column:
    """Time stamp of a well-formed key (DDMMYYYYHHMMSS), null when there is no such time."""

    def number(start, length):
        return F.substring(key, start, length).try_cast("int")

    return F.try_make_timestamp_ntz(
        number(5, 4), number(3, 2), number(1, 2), number(9, 2), number(11, 2), number(13, 2)
    )


def key_part(key: Column, number: int) -> Column:
    """A dot-separated part, counted from 1; null when it is empty or absent."""
    return F.nullif(F.split_part(key, F.lit("."), F.lit(number)), F.lit(""))


def key_dept(key: Column) -> Column:
    return key_part(key, 2)


def key_zone(key: Column) -> Column:
    return key_part(key, 3)


def event_id(key: Column) -> Column:
    """The key without ``.json``: both messages of one upload share it."""
    stem = F.substring(key, F.lit(1), F.length(key) - len(".json"))
    return F.when(key.endswith(".json"), stem).otherwise(key)


def job_name(key: Column) -> Column:
    return F.regexp_replace(key, r"\.mp3$", "")


def object_uri(bucket: str, key: Column) -> Column:
    return F.concat(F.lit(f"s3://{bucket}/"), key)
