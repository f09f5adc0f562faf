"""Term statistics of reviews as tables: tokens, vocabulary, inverse document frequency."""

from pyspark.sql import DataFrame, Window, functions as F

from speechviews.functions.text import drop_listed, letter_words
from speechviews.session import broadcast_if_small

VOCABULARY_SIZE = 2 ** 17
MIN_DOCUMENTS = 5


def review_tokens(reviews: DataFrame) -> DataFrame:
    return reviews.select("id", letter_words(F.col("review")).alias("words"))


def filtered_tokens(reviews: DataFrame, stop_words) -> DataFrame:
    """Tokens without stop words, in any letter case; repetitions stay."""
    return review_tokens(reviews).select("id", drop_listed(F.col("words"), stop_words).alias("words"))


def term_frequencies(tokens: DataFrame) -> DataFrame:
    """(id, word, tf), one row per distinct word of each document.

    A document is one row, so its words are counted inside the row: sort them, find where a new
    word starts, and take the distance to the next start. Nothing is shuffled.
    """
    words, starts, start = F.col("sorted"), F.col("starts"), F.col("start")
    positions = F.transform(words, lambda _, i: i)
    is_start = lambda i: (i == 0) | (F.get(words, i) != F.get(words, i - 1))
    following = F.coalesce(F.get(starts, F.col("p") + 1), F.size(words))
    # Exploding an array of one element gives the array a name that the optimiser keeps;
    # a plain column would be sorted anew at each of its uses.
    return (
        tokens.select("id", F.explode(F.array(F.sort_array("words"))).alias("sorted"))
        .select("id", "sorted", F.explode(F.array(F.filter(positions, is_start))).alias("starts"))
        .select("id", "sorted", "starts", F.posexplode("starts").alias("p", "start"))
        .select("id", F.get(words, start).alias("word"), (following - start).alias("tf"))
    )


def vocabulary(tokens: DataFrame, min_documents=MIN_DOCUMENTS, size=VOCABULARY_SIZE) -> DataFrame:
    """(word, documents, total): words of enough documents, the ``size`` most frequent of them.

    How many words have each total tells the least total that can be among the first ``size``.
    Only words with at least that total, and of those the first of each partition, go to the task
    that puts them in order.
    """
    counts = (
        term_frequencies(tokens)
        .groupBy("word")
        .agg(F.count("*").alias("documents"), F.sum("tf").alias("total"))
        .where(F.col("documents") >= min_documents)
    )
    above = F.sum("words").over(Window.orderBy(F.desc("total"))) - F.col("words")
    totals = counts.groupBy("total").agg(F.count("*").alias("words")).withColumn("above", above)
    least = totals.where(F.col("above") < size).agg(F.min("total")).scalar()
    return counts.where(F.col("total") >= least).orderBy(F.desc("total"), "word").limit(size)


def idf_weights(tokens: DataFrame, **options) -> DataFrame:
    """The vocabulary with ``idf = ln((documents in all + 1) / (documents with the word + 1))``."""
    documents = tokens.agg(F.count("*")).scalar()
    weight = F.log((documents + 1) / (F.col("documents") + 1))
    return vocabulary(tokens, **options).withColumn("idf", weight)


def tfidf_terms(tokens: DataFrame, weights: DataFrame) -> DataFrame:
    """(id, word, tf, tfidf) for the words of ``weights``, best a written table of idf weights.

    Weights proven small are broadcast; otherwise both sides are shuffled by word, where
    adaptive execution splits the words that occur everywhere.
    """
    listed, _ = broadcast_if_small(weights.select("word", "idf"))
    return term_frequencies(tokens).join(listed, "word").select(
        "id", "word", "tf", (F.col("tf") * F.col("idf")).alias("tfidf")
    )


def _parts(slot, weights):
    return F.when(slot < weights[0], 0).when(slot < weights[0] + weights[1], 1).otherwise(2)


def random_split(df: DataFrame, weights=(6, 3, 1), seed=0) -> DataFrame:
    """``part`` 0, 1 or 2 at random. Which rows go where depends on how they are laid out."""
    return df.withColumn("part", _parts(F.rand(seed) * sum(weights), weights))


def hash_split(df: DataFrame, weights=(6, 3, 1), id_column="id") -> DataFrame:
    """``part`` 0, 1 or 2 in the given proportions, from a hash of the id alone.

    Unlike a random split this does not depend on how the rows are laid out, so a recomputed
    partition puts every row where it was before.
    """
    digest = F.substring(F.md5(F.col(id_column).cast("string")), 1, 8)
    slot = F.conv(digest, 16, 10).cast("long") % sum(weights)
    return df.withColumn("part", _parts(slot, weights))
