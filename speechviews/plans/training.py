"""The sentiment model: TF-IDF features and logistic regression, chosen by grid search.

Features are computed once and kept; all models are fitted together, a pass over the features serving each of
them, and evaluated in one more. The split depends on the id alone, so partitions that have to be recomputed after
an executor is lost hold the same rows as before.
"""

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import IDF, CountVectorizer, RegexTokenizer, StopWordsRemover
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import DataFrame, functions as F

from speechviews.functions.text import LETTERS
from speechviews.operators.features import MIN_DOCUMENTS, VOCABULARY_SIZE, hash_split
from speechviews.plans.joint_fit import fit_together

TRAINING, VALIDATION, TEST = 0, 1, 2

# Fixed values of the search and of the two single models.
REG_PARAMS = [0.0, 0.01, 0.02]
ELASTIC_NET_PARAMS = [0.0, 0.2, 0.4]
PLAIN = {"regParam": 0.0, "elasticNetParam": 0.0}
ELASTIC_NET = {"elasticNetParam": 0.3}
MAX_ITERATIONS = 10


def token_stages(stop_words: list[str]) -> PipelineModel:
    """Tokens of ``review`` without stop words; nothing to fit."""
    return PipelineModel(stages=[
        RegexTokenizer(gaps=False, pattern=LETTERS, inputCol="review", outputCol="words"),
        StopWordsRemover(stopWords=stop_words, caseSensitive=False, inputCol="words", outputCol="filtered"),
    ])


def term_stages(tokens: DataFrame, vocabulary_size=VOCABULARY_SIZE, min_documents=MIN_DOCUMENTS) -> PipelineModel:
    """Term counts and document frequencies fitted on tokens, which are read twice."""
    return Pipeline(stages=[
        CountVectorizer(inputCol="filtered", outputCol="tf", vocabSize=vocabulary_size, minDF=min_documents, minTF=1),
        IDF(inputCol="tf", outputCol="tfidf"),
    ]).fit(tokens)


def feature_model(reviews: DataFrame, stop_words: list[str], **options) -> PipelineModel:
    """Fit tokeniser, stop words, term counts and document frequencies on ``review``."""
    splitting = token_stages(stop_words)
    tokens = splitting.transform(reviews).select("filtered").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return PipelineModel(stages=[splitting, term_stages(tokens, **options)])
    finally:
        tokens.unpersist()


def regression(**params) -> LogisticRegression:
    return LogisticRegression(labelCol="score", featuresCol="tfidf", maxIter=MAX_ITERATIONS, **params)


def grid_points() -> list[dict[str, float]]:
    """The nine points, regularisation outermost."""
    lr = regression()
    maps = (
        ParamGridBuilder().addGrid(lr.regParam, REG_PARAMS)
        .addGrid(lr.elasticNetParam, ELASTIC_NET_PARAMS).build()
    )
    return [{p.name: v for p, v in point.items()} for point in maps]


def accuracies(models: list[LogisticRegressionModel], features: DataFrame) -> list[float]:
    """Share of right predictions of each model, all from one pass over the features."""
    names = [f"prediction_{i}" for i in range(len(models))]
    scored = features.select("score", "tfidf")
    for name, model in zip(names, models):
        plain = model.copy().setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("")
        scored = plain.transform(scored)
    hits = [F.avg((F.col("score") == F.col(n)).cast("float")).alias(n) for n in names]
    return list(scored.agg(*hits).first())


def best_index(scores: list[float]) -> int:
    """The first of the greatest."""
    return max(range(len(scores)), key=lambda i: (scores[i], -i))


@dataclass
class Training:
    model: PipelineModel             # features and the best regression
    points: list[dict[str, float]]
    validation: list[float]          # accuracy of each point
    best: int
    test: float                      # accuracy of the best point on held-out reviews
    single: dict[str, float]         # validation accuracy of the two single models


def train(reviews: DataFrame, stop_words: list[str], fit_features_on="all", split=hash_split,
          singles=False) -> Training:
    """Fit the grid on the training part, choose on the validation part, report on the test part.

    ``fit_features_on`` is 'all' or 'train': which reviews give vocabulary and document
    frequencies.
    """
    parts, splitting = split(reviews.select("id", "review", "score")), token_stages(stop_words)
    # Texts are tokenised once. Both tables are kept in memory or on disk; blocks lost with an
    # executor are computed again.
    tokens = splitting.transform(parts).select("part", "score", "filtered").persist(StorageLevel.MEMORY_AND_DISK)
    terms = term_stages(tokens if fit_features_on == "all" else tokens.where(F.col("part") == TRAINING))
    features_of = PipelineModel(stages=[splitting, terms])
    features = terms.transform(tokens).select("part", "score", "tfidf").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        train_part = features.where(F.col("part") == TRAINING)
        points = grid_points()
        wanted = points + ([PLAIN, ELASTIC_NET] if singles else [])
        models = fit_together(train_part, wanted, MAX_ITERATIONS)
        scores = accuracies(models, features.where(F.col("part") == VALIDATION))
        grid_scores = scores[: len(points)]
        best = best_index(grid_scores)
        test = accuracies([models[best]], features.where(F.col("part") == TEST))[0]
    finally:
        features.unpersist()
        tokens.unpersist()
    return Training(
        model=PipelineModel(stages=[features_of, models[best]]),
        points=points, validation=grid_scores, best=best, test=test,
        single=dict(zip(["plain", "elastic_net"], scores[len(points):])),
    )
