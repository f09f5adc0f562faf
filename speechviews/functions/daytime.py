"""Time-of-day buckets and seasons from time and date strings."""

from pyspark.sql import Column, functions as F


def hour_of(time: Column) -> Column:
    """First two characters as a number, null when they are none."""
    return F.substring(time, 1, 2).try_cast("int")


def month_of(date: Column) -> Column:
    """The last two of the first seven characters as a number, null when they are none."""
    return F.substring(F.substring(date, 1, 7), -2, 2).try_cast("int")


def time_bucket(hour: Column) -> Column:
    """Six-hour buckets; any hour outside 0..17 is night."""
    return (
        F.when(hour.between(0, 5), "latenight")
        .when(hour.between(6, 11), "morn")
        .when(hour.between(12, 17), "aftrn")
        .when(hour.isNotNull(), "night")
    )


def season_of(month: Column) -> Column:
    """Calendar quarters; months below 1 are winter, above 12 fall."""
    return (
        F.when(month <= 3, "winter")
        .when(month <= 6, "spring")
        .when(month <= 9, "summer")
        .when(month.isNotNull(), "fall")
    )


def two_digits(number: Column) -> Column:
    return F.lpad(number.cast("string"), 2, "0")
