"""The batch view: words, sentiment and segment count of every group, from one scan.

Each recording is turned into its words plus one leading row that stands for the recording
itself (the empty word, which cannot be a real one). One aggregation by (group, word) then
yields word counts and group totals together, so texts are read, cleaned and scored once, and
the one large shuffle carries partial counts rather than texts.
"""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from speechviews.functions.keys import packed, row_key, unpacked
from speechviews.functions.text import clean_text, comma_list, is_word, normalise
from speechviews.operators.groups import by_id
from speechviews.operators.prepare import grouped
from speechviews.operators.words import WORDS_KEPT, counts_without_stop_words, listed_words, ranked
from speechviews.schemas import GROUP, VIEW


def score(df: DataFrame, model: PipelineModel, score_on="cleaned") -> DataFrame:
    """Add ``prediction`` for ``text``, as it is ('raw') or after clean-up ('cleaned')."""
    text = normalise(F.col("text")) if score_on == "cleaned" else F.col("text")
    scored = model.transform(df.withColumn("review", text))
    return scored.select(*df.columns, "prediction")


def _pieces(scored: DataFrame, cleaned: bool, *extra) -> DataFrame:
    # The blank put in front makes the first token empty: the row of the recording itself.
    text = F.col("text") if cleaned else clean_text(F.col("text"))
    tokens = F.split(F.concat(F.lit(" "), text), " ")
    word, is_recording = F.col("word"), F.col("pos") == 0
    names = [f"extra_{k}" for k in range(len(extra))]
    return (
        # A step of its own, or the packing would be done for every word.
        scored.select(packed(*GROUP).alias("group"), F.col("prediction").cast("long").alias("prediction"), "text",
                      *[e.alias(n) for e, n in zip(extra, names)])
        .select("group", "prediction", *names, F.posexplode(tokens).alias("pos", "word"))
        .where(is_recording | is_word(word))
        .select("group", "word", F.when(is_recording, F.col("prediction")).otherwise(F.lit(0)).alias("positive"),
                *[F.when(is_recording, F.col(n)).alias(n) for n in names])
    )


def group_word_totals(scored: DataFrame, stop_words, cleaned=False, score_mode="sum") -> DataFrame:
    """(group, word, cnt, positive) with the group's columns packed into one; the empty word's
    row holds the totals of the group."""
    if score_mode == "sum":
        extra, positive = [], F.sum("positive")
    else:
        first = F.struct(by_id(), F.col("prediction").cast("long").alias("prediction"))
        extra, positive = [first], 1 + F.min("extra_0")["prediction"]
    return counts_without_stop_words(
        _pieces(scored, cleaned, *extra), stop_words,
        F.count("*").alias("cnt"), positive.alias("positive"), by=["group"],
    )


def view_of(scored: DataFrame, stop_words, words_kept=WORDS_KEPT, cleaned=False, score_mode="sum") -> DataFrame:
    """The view from grouped recordings with a 0/1 ``prediction``.

    ``text`` is raw, or ``cleaned`` already. ``stop_words`` is a list, or a table ``word`` of
    any size. For ``score_mode`` see ``batch_view``.
    """
    totals = F.col("side") == "all"
    return (
        ranked(group_word_totals(scored, stop_words, cleaned, score_mode), words_kept, by=["group"])
        .groupBy("group")
        .agg(
            comma_list(listed_words("most")).alias("most_common_words"),
            comma_list(listed_words("least")).alias("least_common_words"),
            F.sum(F.when(totals, F.col("positive"))).alias("sentiment_score_sum"),
            F.sum(F.when(totals, F.col("cnt"))).alias("sentiment_score_total"),
        )
        .select("*", *unpacked(F.col("group"), GROUP))
        .withColumn("row_key", row_key(*GROUP))
        .select(*VIEW.names)
    )


def words_view(recordings: DataFrame, stop_words, words_kept=WORDS_KEPT) -> DataFrame:
    """The view without sentiment: no model is needed, the sum column is absent."""
    unscored = grouped(recordings).withColumn("prediction", F.lit(0))
    return view_of(unscored, stop_words, words_kept).drop("sentiment_score_sum")


def batch_view(recordings: DataFrame, stop_words, model: PipelineModel,
               score_on="cleaned", score_mode="sum") -> DataFrame:
    """The view of all valid recordings.

    ``score_mode='sum'`` adds up the predictions of all texts of a group;
    ``'first_plus_one'`` is one plus the prediction of the text that comes first by id. Either
    way texts are read, cleaned and scored once.
    """
    if score_mode not in ("sum", "first_plus_one"):
        raise ValueError(f"unknown score_mode {score_mode!r}")
    rows, cleaned = grouped(recordings), score_on == "cleaned"
    if cleaned:
        rows = rows.withColumn("text", normalise(F.col("text")))
    return view_of(score(rows, model, "raw"), stop_words, cleaned=cleaned, score_mode=score_mode)
