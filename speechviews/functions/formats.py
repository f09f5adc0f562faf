"""Percentages, counters, empty form fields and JSON."""

from pyspark.sql import Column, functions as F

from speechviews.schemas import MESSAGE, with_corrupt_record


def empty_to_null(field: Column) -> Column:
    return F.nullif(field, F.lit(""))


def percent(part: Column, total: Column) -> Column:
    """``part / total * 100``; null when the total is 0."""
    return F.try_divide(part, total) * 100


def percent_text(value: Column) -> Column:
    """Two decimals and ``%``; null stays null."""
    return F.when(value.isNotNull(), F.format_string("%.2f%%", value))


def counter_bytes(number: Column) -> Column:
    """A long as 8 big-endian bytes, the form in which counters are kept in key-value stores."""
    return F.unhex(F.lpad(F.hex(number.cast("long")), 16, "0"))


def counter_value(cell: Column) -> Column:
    """8 big-endian bytes as a signed long."""
    return F.conv(F.hex(cell), 16, -10).cast("long")


def message_json(key: Column, body: Column) -> Column:
    """``{"key":…,"body":…}``; a null body is left out."""
    return F.to_json(F.struct(key.alias("key"), body.alias("body")))


def parse_message(value: Column) -> Column:
    """Key, body and, for broken JSON, the raw text in ``_corrupt_record``."""
    return F.from_json(value, with_corrupt_record(MESSAGE), {"mode": "PERMISSIVE"})


def first_transcript(results: Column) -> Column:
    """The transcript of a transcription result; brackets in the text do not matter."""
    return F.get(results.getField("transcripts"), F.lit(0)).getField("transcript")
