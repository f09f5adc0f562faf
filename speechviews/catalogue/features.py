"""Term statistics of the labelled reviews, and the split of the data."""

from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import STOP_WORDS, with_ctes
from speechviews.catalogue.registry import query
from speechviews.operators import features as X
from speechviews.session import scratch_path

I.CTES.update({
    "review_words": r"""
        SELECT id, regexp_extract_all(lower(review), '\p{L}+') AS words FROM reviews""",
    "review_kept": """
        SELECT id, list_filter(words, lambda w: w NOT IN (%s)) AS words FROM review_words"""
    % ", ".join(f"'{w}'" for w in STOP_WORDS),
    "terms": """
        SELECT id, word, count(*) AS tf FROM (SELECT id, unnest(words) AS word FROM review_kept) AS u GROUP BY ALL""",
    "vocabulary": """
        SELECT word, count(*) AS documents, CAST(sum(tf) AS BIGINT) AS total FROM terms
        GROUP BY word HAVING count(*) >= 5 ORDER BY total DESC, word LIMIT 131072""",
    "weights": """
        SELECT *, ln(((SELECT count(*) FROM reviews) + 1) / (documents + 1)) AS idf FROM vocabulary""",
})


def _tokens(spark, folder):
    return X.filtered_tokens(I.reviews(spark, folder), STOP_WORDS)


def _joined(tokens):
    return tokens.select("id", F.size("words").cast("long").alias("n_words"), F.array_join("words", " ").alias("words"))


@query(with_ctes("SELECT id, len(words) AS n_words, array_to_string(words, ' ') AS words FROM review_words"))
def review_tokens(spark, folder):
    return _joined(X.review_tokens(I.reviews(spark, folder)))


@query(with_ctes("SELECT id, len(words) AS n_words, array_to_string(words, ' ') AS words FROM review_kept"))
def review_tokens_filtered(spark, folder):
    return _joined(_tokens(spark, folder))


@query(with_ctes("SELECT id, word, CAST(tf AS INTEGER) AS tf FROM terms"))
def term_frequencies(spark, folder):
    return X.term_frequencies(_tokens(spark, folder))


@query(with_ctes("SELECT * FROM vocabulary"))
def vocabulary(spark, folder):
    return X.vocabulary(_tokens(spark, folder))


@query(with_ctes("SELECT word, documents, total, round(idf, 9) AS idf FROM weights"))
def idf_weights(spark, folder):
    return X.idf_weights(_tokens(spark, folder)).withColumn("idf", F.round("idf", 9))


@query(with_ctes("""
    SELECT t.id, t.word, CAST(t.tf AS INTEGER) AS tf, round(t.tf * w.idf, 9) AS tfidf
    FROM terms t JOIN weights w ON w.word = t.word"""))
def tfidf_terms(spark, folder):
    """Weights are computed once, written, and applied from the table."""
    path, tokens = scratch_path(spark, "weights"), _tokens(spark, folder)
    X.idf_weights(tokens).write.parquet(path)
    weights = spark.read.schema("word string, documents bigint, total bigint, idf double").parquet(path)
    return X.tfidf_terms(tokens, weights).withColumn("tfidf", F.round("tfidf", 9))


@query(with_ctes("""
    SELECT id, score, CASE WHEN slot < 6 THEN 0 WHEN slot < 9 THEN 1 ELSE 2 END AS part
    FROM (SELECT id, score, CAST('0x' || substr(md5(CAST(id AS VARCHAR)), 1, 8) AS BIGINT) % 10 AS slot FROM reviews) AS s"""))
def dataset_split(spark, folder):
    return X.hash_split(I.reviews(spark, folder)).select("id", "score", "part")


# The share of reviews whose length agrees with their label stands for a model's accuracy.
@query(with_ctes("""
    SELECT avg(CASE WHEN score = (CASE WHEN length(review) > 500 THEN 1 ELSE 0 END) THEN 1.0 ELSE 0.0 END) AS accuracy,
           count(*) AS reviews
    FROM reviews"""))
def label_accuracy(spark, folder):
    prediction = (F.length("review") > 500).cast("double")
    hit = (F.col("score") == prediction).cast("float")
    return I.reviews(spark, folder).agg(F.avg(hit).alias("accuracy"), F.count("*").alias("reviews"))
