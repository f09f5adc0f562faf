"""The view with sentiment, its lookups, percentages, upserts and merges.

The quality label stands for the model's prediction, which makes every number checkable.
"""

from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import with_ctes
from speechviews.catalogue.registry import query
from speechviews.functions.formats import counter_bytes, counter_value
from speechviews.operators import groups as G, messages as M, serving as S
from speechviews.session import scratch_path
from speechviews.sinks.tables import save_view_table, upsert_view, write_view
from speechviews.sources.tables import view_table

@contextmanager
def kept(view):
    """The view in memory or on disk while it is written more than once: its recordings are counted in one pass."""
    view = view.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield view
    finally:
        view.unpersist()


WHOLE_VIEW = with_ctes("SELECT * FROM the_view")


@query(WHOLE_VIEW)
def batch_view_labelled(spark, folder):
    return I.labelled_view(spark, folder)


@query(WHOLE_VIEW)
def view_write_and_scan(spark, folder):
    """Two versions written, the newest committed one read."""
    path = scratch_path(spark, "view")
    with kept(I.labelled_view(spark, folder)) as view:
        write_view(view.withColumn("most_common_words", F.lit("")), path, version=1)
        write_view(view, path, version=2)
    return view_table(spark, path)


@query(WHOLE_VIEW)
def view_as_catalog_table(spark, folder):
    """A catalog table written, then replaced as a whole."""
    path = scratch_path(spark, "view_table")
    name = "speech_view"  # one name, so that calls leave one table behind
    with kept(I.labelled_view(spark, folder)) as view:
        save_view_table(view.withColumn("row_key", F.lit("old")), name, path)
        save_view_table(view, name, path)
    return spark.table(name)


@query(with_ctes("""
    SELECT 'dept_name' AS filter, dept_name AS value FROM the_view
    UNION SELECT 'zone', zone FROM the_view
    UNION SELECT 'time_of_day', time_of_day FROM the_view
    UNION SELECT 'season', season FROM the_view"""))
def filter_options(spark, folder):
    return G.filter_values(I.stored_view(spark, folder))


@query(with_ctes("SELECT * FROM the_view WHERE row_key = 'dept1enmornspring'"))
def view_lookup(spark, folder):
    return S.lookup(I.stored_view(spark, folder), "dept1enmornspring")


_PERCENT_TEXT = """
    CASE WHEN sentiment_score_total > 0 THEN
      CAST((20000 * sentiment_score_sum + sentiment_score_total) // (2 * sentiment_score_total) // 100 AS VARCHAR) || '.' ||
      lpad(CAST((20000 * sentiment_score_sum + sentiment_score_total) // (2 * sentiment_score_total) % 100 AS VARCHAR), 2, '0') || '%'
    END"""


@query(with_ctes("""
    SELECT * FROM the_view
    WHERE dept_name = 'dept1' AND zone = 'en' AND time_of_day = 'morn' AND season = 'spring'"""))
def view_group_lookup(spark, folder):
    """One group of a written view."""
    return S.lookup_group(I.stored_view(spark, folder), "dept1", "en", "morn", "spring")


def _requests(spark, folder):
    """One request per event type, zone and hour of the day, for one department that exists and
    one that does not."""
    asked = I.sources(spark, folder).select("kind", "zone", F.substring("time_of_day", 1, 2).cast("int").alias("hour"))
    return asked.select(
        F.when(F.col("kind") == "error", "nowhere").otherwise("dept1").alias("dept"),
        "zone",
        F.when(F.col("hour") < 12, "morn").otherwise("night").alias("time_of_day"),
        F.when(F.col("kind") == "view", "summer").otherwise("winter").alias("time_of_year"),
    )


@query(with_ctes(f"""
    SELECT r.dept_name, r.zone, r.time_of_day, r.season,
           replace(most_common_words, ',', ', ') AS most_common_words,
           replace(least_common_words, ',', ', ') AS least_common_words,
           {_PERCENT_TEXT} AS percent_text
    FROM (SELECT CASE WHEN kind = 'error' THEN 'nowhere' ELSE 'dept1' END AS dept_name, zone,
                 CASE WHEN CAST(substr(time_of_day, 1, 2) AS INTEGER) < 12 THEN 'morn' ELSE 'night' END AS time_of_day,
                 CASE WHEN kind = 'view' THEN 'summer' ELSE 'winter' END AS season
          FROM sources) AS r
    LEFT JOIN the_view v ON v.dept_name = r.dept_name AND v.zone = r.zone
                        AND v.time_of_day = r.time_of_day AND v.season = r.season"""))
def view_request_join(spark, folder):
    return S.answer_requests(_requests(spark, folder), I.stored_view(spark, folder))


@query(with_ctes("""
    SELECT row_key, sentiment_score_sum / sentiment_score_total * 100 AS percent_positive FROM the_view"""))
def percent_positive(spark, folder):
    return G.with_percent(I.stored_view(spark, folder)).select("row_key", "percent_positive")


@query(with_ctes(f"SELECT row_key, {_PERCENT_TEXT} AS percent_text FROM the_view"))
def percent_text(spark, folder):
    return G.with_percent(I.stored_view(spark, folder)).select("row_key", "percent_text")


@query(with_ctes(f"""
    SELECT row_key, replace(most_common_words, ',', ', ') AS most_common_words,
           replace(least_common_words, ',', ', ') AS least_common_words, {_PERCENT_TEXT} AS percent_text
    FROM the_view"""))
def view_display(spark, folder):
    return S.displayed(I.stored_view(spark, folder))


@query(with_ctes("SELECT * FROM counters"))
def sentiment_sum(spark, folder):
    return G.sentiment_sums(I.labelled(spark, folder))


@query(with_ctes("""
    SELECT dept_name, zone, time_of_day, season,
           CAST(1 + arg_min(prediction, id) AS BIGINT) AS sentiment_score_sum, count(*) AS sentiment_score_total
    FROM labelled GROUP BY ALL"""))
def sentiment_first_plus_one(spark, folder):
    return G.sentiment_first_plus_one(I.labelled(spark, folder))


@query(with_ctes("""
    SELECT coalesce(dept_name, 'any_pd') AS dept_name, coalesce(zone, 'any_zone') AS zone,
           coalesce(time_of_day, 'any_time_of_day') AS time_of_day, coalesce(season, 'any_time_of_year') AS season,
           CAST(sum(prediction) AS BIGINT) AS sentiment_score_sum, count(*) AS sentiment_score_total
    FROM labelled GROUP BY CUBE (dept_name, zone, time_of_day, season)"""))
def view_cube(spark, folder):
    view = G.sentiment_sums(I.labelled(spark, folder))
    return G.any_group_totals(view)


@query(WHOLE_VIEW)
def view_rename_positional(spark, folder):
    """A view whose columns have other names takes the declared names by position."""
    other = I.labelled_view(spark, folder).toDF(
        "id", "dept_name", "zone", "time_of_day", "date_of_event", "most", "least", "sent_score", "sent_count"
    )
    return S.rename_positional(other)


# Versions for the upsert: the older view knows the mornings and nights and has older counters,
# the newer one knows the mornings and afternoons.
@query(with_ctes("""
    SELECT row_key, dept_name, zone, time_of_day, season, most_common_words, least_common_words,
           CASE WHEN time_of_day = 'night' THEN 0 ELSE sentiment_score_sum END AS sentiment_score_sum,
           sentiment_score_total
    FROM the_view WHERE time_of_day <> 'latenight'"""))
def view_upsert(spark, folder):
    view = I.stored_view(spark, folder)
    old = view.where(F.col("time_of_day").isin("morn", "night")).withColumn("sentiment_score_sum", F.lit(0).cast("long"))
    new = view.where(F.col("time_of_day").isin("morn", "aftrn"))
    return S.upsert(old, new)


@query(with_ctes("""
    SELECT row_key, dept_name, zone, time_of_day, season, most_common_words, least_common_words,
           CASE WHEN time_of_day = 'morn' THEN sentiment_score_sum + 1 ELSE sentiment_score_sum END AS sentiment_score_sum,
           sentiment_score_total
    FROM the_view"""))
def view_upsert_written(spark, folder):
    """A written view whose mornings are replaced in place; the other partitions stay as they were written."""
    path = scratch_path(spark, "view")
    view = I.stored_view(spark, folder)
    write_view(view, path, version=1)
    upsert_view(view.where("time_of_day = 'morn'").withColumn("sentiment_score_sum", F.col("sentiment_score_sum") + 1), path)
    return view_table(spark, path)


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
def counter_merge(spark, folder):
    live = M.live_counts(M.parse_keys(I.messages(spark, folder)))
    with_sum = live.withColumn("sentiment_score_sum", F.lit(0).cast("long"))
    return S.merge_counters(I.labelled_view(spark, folder), with_sum)


@query(with_ctes("""
    SELECT row_key, sentiment_score_sum AS counter, -sentiment_score_total AS negative FROM the_view"""))
def counter_decode(spark, folder):
    """Counters to their 8-byte form and back."""
    cells = I.stored_view(spark, folder).select(
        "row_key",
        counter_bytes(F.col("sentiment_score_sum")).alias("counter"),
        counter_bytes(-F.col("sentiment_score_total")).alias("negative"),
    )
    return cells.select("row_key", *[counter_value(F.col(c)).alias(c) for c in ("counter", "negative")])
