"""Word counts, stop words, most and least common words, texts and segments per group."""

from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import with_ctes
from speechviews.catalogue.registry import query
from speechviews.functions.text import display_list
from speechviews.operators import groups as G, words as W
from speechviews.operators.prepare import grouped
from speechviews.plans import batch_view as B
from speechviews.schemas import GROUP
from speechviews.session import scratch_path
from speechviews.sources.tables import stop_words_text

ROWS_PER_PART = 8


def _grouped(spark, folder):
    return grouped(I.recordings(spark, folder))


def _ranked(spark, folder, side):
    return W.word_ranking(_grouped(spark, folder), I.STOP_WORDS, sides=(side,))


@query(with_ctes("""
    SELECT s.word, count(g.word) AS uses FROM stop_words s LEFT JOIN group_words g ON g.word = s.word GROUP BY s.word"""))
def stop_words_scan(spark, folder):
    """The list written one word per line, read back, and how often each word is used."""
    path = scratch_path(spark, "stop-words")
    I.stop_word_table(spark).write.text(path)
    listed = stop_words_text(spark, path)
    used = W.words_of(_grouped(spark, folder)).groupBy("word").agg(F.count("*").alias("n"))
    return listed.join(used, "word", "left").select("word", F.coalesce("n", F.lit(0)).alias("uses"))


@query(with_ctes(f"""
    SELECT dept_name, zone, time_of_day, season, part, count(*) AS n_texts,
           string_agg(id, ',' ORDER BY id) AS ids, string_agg(text, chr(30) ORDER BY id) AS texts
    FROM (
      SELECT *, CAST('0x' || substr(md5(id), 1, 8) AS BIGINT)
                % CAST(ceil(count(*) OVER (PARTITION BY dept_name, zone, time_of_day, season) / {ROWS_PER_PART}.0) AS BIGINT) AS part
      FROM grouped) AS p
    GROUP BY ALL"""))
def texts_per_group(spark, folder):
    parts = G.texts_per_group(_grouped(spark, folder), ROWS_PER_PART)
    return parts.withColumns({"ids": F.array_join("ids", ","), "texts": F.array_join("texts", "\x1e")})


@query(with_ctes("SELECT dept_name, zone, time_of_day, season, count(*) AS segments FROM grouped GROUP BY ALL"))
def segment_counts(spark, folder):
    return G.segment_counts(_grouped(spark, folder))


@query(with_ctes("SELECT * FROM word_counts"))
def group_word_counts(spark, folder):
    return W.word_counts(_grouped(spark, folder))


@query(with_ctes("SELECT * FROM kept_counts"))
def stop_word_exclusion(spark, folder):
    pieces = W.words_of(_grouped(spark, folder), *GROUP)
    counts = W.counts_without_stop_words(pieces, I.stop_word_table(spark), F.count("*").alias("cnt"))
    return counts.select(*GROUP, "word", "cnt")


@query(with_ctes("""
    SELECT dept_name, zone, time_of_day, season, word, cnt, CAST(rn AS INTEGER) AS rank FROM ordered WHERE rn <= 5"""))
def most_common_words(spark, folder):
    return _ranked(spark, folder, "most").select(*GROUP, "word", "cnt", "rank")


@query(with_ctes("""
    SELECT dept_name, zone, time_of_day, season, word, cnt, CAST(n - rn + 1 AS INTEGER) AS rank
    FROM ordered WHERE rn > n - 5"""))
def least_common_words(spark, folder):
    return _ranked(spark, folder, "least").select(*GROUP, "word", "cnt", "rank")


@query(with_ctes("""
    SELECT row_key, dept_name, zone, time_of_day, season, most_common_words, least_common_words, sentiment_score_total
    FROM the_view"""))
def batch_view_words(spark, folder):
    """Flagship: recordings to ranked words and segment counts of every group, in one pass."""
    return B.words_view(I.recordings(spark, folder), I.STOP_WORDS)


@query(with_ctes("SELECT * FROM the_view"))
def batch_view_dirty_stop_words(spark, folder):
    """A list with an empty line, a null and a short word gives the same view, as a list and as a table."""
    dirty = [*I.STOP_WORDS, "", None, "a"]
    rows = I.labelled(spark, folder)
    table = spark.createDataFrame([(w,) for w in dirty], "word string")
    as_list, as_table = B.view_of(rows, dirty), B.view_of(rows, table)
    return as_list.intersectAll(as_table)


@query(with_ctes("""
    SELECT dept_name, zone, time_of_day, season, replace(most_common_words, ',', ', ') AS most_common_words,
           replace(least_common_words, ',', ', ') AS least_common_words
    FROM word_lists"""))
def display_words(spark, folder):
    lists = W.word_lists(W.word_ranking(_grouped(spark, folder), I.STOP_WORDS))
    return lists.select(*GROUP, *[display_list(F.col(c)).alias(c) for c in ("most_common_words", "least_common_words")])
