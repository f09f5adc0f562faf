"""Counters of groups: segments, sentiment, texts, filter values."""

from pyspark.sql import DataFrame, functions as F

from speechviews.functions.formats import percent, percent_text
from speechviews.functions.keys import row_key
from speechviews.schemas import GROUP
from speechviews.session import broadcast_if_small

SLICES = 32

ANY = {
    "dept_name": "any_pd", "zone": "any_zone",
    "time_of_day": "any_time_of_day", "season": "any_time_of_year",
}


def by_id():
    """Order of texts for the first of a group: by id, those without one last."""
    return F.struct(F.col("id").isNull(), F.col("id"))


def segment_counts(grouped: DataFrame) -> DataFrame:
    """Texts per group; a text without surviving words counts."""
    return grouped.groupBy(*GROUP).agg(F.count("*").alias("segments"))


def sentiment_sums(scored: DataFrame) -> DataFrame:
    """Positive texts and texts per group, from a 0/1 ``prediction``."""
    return scored.groupBy(*GROUP).agg(
        F.sum(F.col("prediction").cast("long")).alias("sentiment_score_sum"),
        F.count("*").alias("sentiment_score_total"),
    )


def sentiment_first_plus_one(scored: DataFrame) -> DataFrame:
    """One plus the prediction of one text, the first by id, as the sum; texts as the total."""
    return scored.groupBy(*GROUP).agg(
        (1 + F.min_by(F.col("prediction").cast("long"), by_id())).alias("sentiment_score_sum"),
        F.count("*").alias("sentiment_score_total"),
    )


def texts_per_group(grouped: DataFrame, rows_per_part=1000, bytes_per_part=32 << 20) -> DataFrame:
    """The texts of each group as arrays, ordered by id.

    A group is cut into as many parts as its rows and bytes ask for, each of about
    ``rows_per_part`` texts or ``bytes_per_part`` bytes chosen by a hash of the id (of the text
    where there is no id), so no array grows with the data. The sizes, one row per group, are
    broadcast when proven few: texts are then shuffled once, by group and part, and no task gets
    a whole group. More groups than that are joined in slices by the same hash first.
    """
    digest = F.conv(F.substring(F.md5(F.coalesce("id", "text")), 1, 8), 16, 10).cast("long")
    sizes = grouped.groupBy(*GROUP).agg(
        F.greatest(
            F.ceil(F.count("*") / F.lit(rows_per_part)), F.ceil(F.sum(F.octet_length("text")) / F.lit(bytes_per_part))
        ).alias("parts")
    )
    sizes, few = broadcast_if_small(sizes)
    if few:
        sized = grouped.join(sizes, GROUP)
    else:
        slices = sizes.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
        sliced = grouped.withColumn("slice", F.pmod(digest, F.lit(SLICES)).cast("int"))
        sized = sliced.join(slices, [*GROUP, "slice"]).drop("slice")
    part = F.pmod(digest, F.col("parts"))
    entries = F.sort_array(F.collect_list(F.struct("id", "text")))
    return (
        sized.withColumn("part", part)
        .groupBy(*GROUP, "part")
        .agg(entries.alias("entries"))
        .select(
            *GROUP, "part",
            F.size("entries").cast("long").alias("n_texts"),
            F.col("entries.id").alias("ids"),
            F.col("entries.text").alias("texts"),
        )
    )


def filter_values(view: DataFrame) -> DataFrame:
    """The distinct values of each grouping column, one row per (filter, value)."""
    choices = F.array(*[F.struct(F.lit(c).alias("filter"), F.col(c).alias("value")) for c in GROUP])
    return view.select(F.inline(choices)).distinct()


def any_group_totals(view: DataFrame) -> DataFrame:
    """Counters for every combination of chosen and open filters.

    Counters add up, so this cubes the view (one row per group), never the recordings.
    """
    return (
        view.cube(*GROUP)
        .agg(
            F.sum("sentiment_score_sum").alias("sentiment_score_sum"),
            F.sum("sentiment_score_total").alias("sentiment_score_total"),
        )
        .select(
            *[F.coalesce(c, F.lit(label)).alias(c) for c, label in ANY.items()],
            "sentiment_score_sum", "sentiment_score_total",
        )
    )


def with_percent(view: DataFrame) -> DataFrame:
    share = percent(F.col("sentiment_score_sum"), F.col("sentiment_score_total"))
    return view.withColumn("percent_positive", share).withColumn(
        "percent_text", percent_text(F.col("percent_positive"))
    )


def with_row_key(df: DataFrame) -> DataFrame:
    return df.withColumn("row_key", row_key(*GROUP))
