"""Lookups in the view, upserts and the merge of batch and live counters."""

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from speechviews.functions.formats import percent, percent_text
from speechviews.functions.keys import row_key
from speechviews.functions.text import display_list
from speechviews.operators.groups import with_percent
from speechviews.schemas import GROUP, VIEW

REQUEST = {"dept": "dept_name", "zone": "zone", "time_of_day": "time_of_day", "time_of_year": "season"}
COUNTERS = ["sentiment_score_sum", "sentiment_score_total"]
WORD_LISTS = ["most_common_words", "least_common_words"]


def lookup(view: DataFrame, key: str) -> DataFrame:
    """The row of one row key."""
    return view.where(F.col("row_key") == key)


def lookup_group(view: DataFrame, dept: str, zone: str, time_of_day: str, season: str) -> DataFrame:
    """The row of one group. On a written view this opens one partition only."""
    wanted = zip(GROUP, (dept, zone, time_of_day, season))
    return view.where(reduce(lambda a, b: a & b, [F.col(c) == v for c, v in wanted]))


def displayed(view: DataFrame) -> DataFrame:
    """What is shown of a group: both word lists and the share of positive texts."""
    return with_percent(view).select(
        "row_key",
        *[display_list(F.col(c)).alias(c) for c in WORD_LISTS],
        "percent_text",
    )


def answer_requests(requests: DataFrame, view: DataFrame) -> DataFrame:
    """Requests (dept, zone, time_of_day, time_of_year) with the display columns of their group.

    Requests for groups that do not exist keep nulls. Many requests may ask for one group: the
    view has one row per group, so adaptive execution may split the request side.
    """
    renamed = requests.select(*[F.col(a).alias(b) for a, b in REQUEST.items()])
    found = view.select(*GROUP, *WORD_LISTS, *COUNTERS)
    share = percent(F.col("sentiment_score_sum"), F.col("sentiment_score_total"))
    return renamed.join(found, GROUP, "left").select(
        *GROUP,
        *[display_list(F.col(c)).alias(c) for c in WORD_LISTS],
        percent_text(share).alias("percent_text"),
    )


def rename_positional(df: DataFrame, names=tuple(VIEW.names)) -> DataFrame:
    """Columns renamed by position."""
    return df.toDF(*names)


def upsert(old: DataFrame, new: DataFrame, keys=GROUP) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same keys; all other rows stay."""
    values = [c for c in old.columns if c not in keys]
    marked = new.withColumn("_new", F.lit(True))
    merged = old.alias("o").join(marked.alias("n"), keys, "full_outer")
    return merged.select(
        *keys,
        *[F.when(F.col("_new"), F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in values],
    ).select(*old.columns)


def merge_counters(view: DataFrame, live: DataFrame) -> DataFrame:
    """Live counters added to the view. Groups known only from the stream get a row with empty
    word lists."""
    merged = view.alias("v").join(live.alias("l"), GROUP, "full_outer")
    zero, empty = F.lit(0).cast("long"), F.lit("")
    summed = [
        (F.coalesce(F.col(f"v.{c}"), zero) + F.coalesce(F.col(f"l.{c}"), zero)).alias(c) for c in COUNTERS
    ]
    return merged.select(
        row_key(*GROUP).alias("row_key"),
        *GROUP,
        *[F.coalesce(F.col(f"v.{c}"), empty).alias(c) for c in WORD_LISTS],
        *summed,
    )
