"""Training, and scoring with a model.

No SQL can say what a training finds, so the queries that score apply a model of fixed weights,
an ML pipeline like the trained one, whose predictions SQL can say too.
"""

from functools import lru_cache

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import functions as F

from speechviews.catalogue import inputs as I
from speechviews.catalogue.inputs import STOP_WORDS, with_ctes
from speechviews.catalogue.registry import query
from speechviews.operators.prepare import grouped
from speechviews.plans.batch_view import batch_view, score
from speechviews.plans.training import token_stages, train
from speechviews.schemas import GROUP
from speechviews.session import scratch_path
from speechviews.sinks.tables import save_model
from speechviews.sources.tables import sentiment_model


def _trained(spark, folder):
    """One training per session and state of the tables, and where its best model was saved."""
    return _trained_on(spark, folder, I.tables_state(spark, folder, "documents", "labels"))


@lru_cache(maxsize=4)
def _trained_on(spark, folder, state):
    training = train(I.reviews(spark, folder), STOP_WORDS, singles=True)
    path = scratch_path(spark, "model")
    save_model(training.model, path)
    return training, path


def trained_model(spark, folder):
    return sentiment_model(_trained(spark, folder)[1])


def _accuracies(spark, training):
    rows = [(i, p["regParam"], p["elasticNetParam"], a) for i, (p, a) in enumerate(zip(training.points, training.validation))]
    return spark.createDataFrame(rows, "point int, reg_param double, elastic_net_param double, accuracy double")


@query()
def grid_accuracy(spark, folder):
    return _accuracies(spark, _trained(spark, folder)[0])


def first_best(points):
    """The row of greatest ``accuracy``, of equal ones that of the least ``point``."""
    best = F.max_by(F.struct(*points.columns), F.struct("accuracy", -F.col("point")))
    return points.agg(best.alias("best")).select("best.*")


@query()
def best_model(spark, folder):
    """The first point of greatest accuracy, chosen by the table itself."""
    return first_best(_accuracies(spark, _trained(spark, folder)[0]))


@query()
def test_accuracy(spark, folder):
    training, _ = _trained(spark, folder)
    return spark.createDataFrame([(training.best, training.test)], "point int, accuracy double")


@query()
def plain_lr_accuracy(spark, folder):
    return spark.createDataFrame([(_trained(spark, folder)[0].single["plain"],)], "accuracy double")


@query()
def elastic_net_accuracy(spark, folder):
    return spark.createDataFrame([(_trained(spark, folder)[0].single["elastic_net"],)], "accuracy double")


#: Weights of words in the fixed model; a text is positive when they add up to more than 0.
WEIGHTS = {
    "tion": 2, "ing": 1, "ther": 1, "thin": 1, "sich": 2, "elle": 1, "con": 1, "erin": 1,
    "ble": -2, "thon": -1, "than": -1, "thth": -1, "auf": -2, "pas": -1, "como": -1, "thre": -1,
}
_CASES = " ".join(f"WHEN '{w}' THEN {n}" for w, n in WEIGHTS.items())


def fixed_model() -> PipelineModel:
    """Tokens as the trained model has them, and ``prediction`` by the weights."""
    total = f"aggregate(transform(filtered, w -> CASE w {_CASES} ELSE 0 END), 0, (a, b) -> a + b)"
    weigh = SQLTransformer(statement=f"SELECT *, CASE WHEN {total} > 0 THEN 1.0D ELSE 0.0D END AS prediction FROM __THIS__")
    return PipelineModel(stages=[token_stages(STOP_WORDS), weigh])


def _sql_prediction(text):
    listed = ", ".join(f"'{w}'" for w in STOP_WORDS)
    words = rf"list_filter(regexp_extract_all(lower({text}), '\p{{L}}+'), lambda w: w NOT IN ({listed}))"
    return f"CAST(coalesce(list_sum(list_transform({words}, lambda w: CASE w {_CASES} ELSE 0 END)), 0) > 0 AS INTEGER)"


I.CTES.update({
    "scored": f"""
        SELECT id, dept_name, zone, time_of_day, season, {_sql_prediction("array_to_string(words, ' ')")} AS prediction FROM tokenised""",
    "scored_totals": """
        SELECT dept_name, zone, time_of_day, season, CAST(sum(prediction) AS BIGINT) AS positive_texts,
               CAST(1 + arg_min(prediction, id) AS BIGINT) AS first_plus_one
        FROM scored GROUP BY ALL""",
    "live_scored": f"""
        SELECT dept_name, zone, time_of_day, season, count(*) FILTER (positive) AS sentiment_score_sum, count(*) AS sentiment_score_total
        FROM (SELECT event_id, dept_name, zone, time_of_day, season,
                     coalesce(bool_or(length(body) > 0 AND {_sql_prediction("body")} > 0), false) AS positive
              FROM parsed GROUP BY ALL) AS e
        GROUP BY ALL""",
})
_VIEW_WITH = """
    SELECT v.row_key, v.dept_name, v.zone, v.time_of_day, v.season, v.most_common_words, v.least_common_words,
           s.{} AS sentiment_score_sum, v.sentiment_score_total
    FROM the_view v JOIN scored_totals s
      ON v.dept_name = s.dept_name AND v.zone = s.zone AND v.time_of_day = s.time_of_day AND v.season = s.season"""


@query(with_ctes("SELECT * FROM scored"))
def scored_recordings(spark, folder):
    scored = score(grouped(I.recordings(spark, folder)), fixed_model())
    return scored.select("id", *GROUP, F.col("prediction").cast("int").alias("prediction"))


@query(with_ctes(_VIEW_WITH.format("positive_texts")))
def batch_view_full(spark, folder):
    return batch_view(I.recordings(spark, folder), STOP_WORDS, fixed_model())


@query(with_ctes(_VIEW_WITH.format("first_plus_one")))
def batch_view_first_plus_one(spark, folder):
    return batch_view(I.recordings(spark, folder), STOP_WORDS, fixed_model(), score_mode="first_plus_one")


@query()
def batch_view_trained(spark, folder):
    """The view with the trained model's predictions."""
    return batch_view(I.recordings(spark, folder), STOP_WORDS, trained_model(spark, folder))


# Nine rules, one for each length from which a review would be called good, stand for nine models.
_RULES = [100 * 2 ** k for k in range(9)]


@query(with_ctes(f"""
    SELECT point, accuracy FROM (
      SELECT point, avg(CASE WHEN score = (CASE WHEN length(review) > least_length THEN 1 ELSE 0 END) THEN 1.0 ELSE 0.0 END) AS accuracy
      FROM reviews, (VALUES {", ".join(f"({k}, {n})" for k, n in enumerate(_RULES))}) AS p(point, least_length) GROUP BY point) AS a
    ORDER BY accuracy DESC, point LIMIT 1"""))
def best_rule(spark, folder):
    """The first point of greatest accuracy, all points evaluated in one pass."""
    right = [((F.length("review") > n).cast("int") == F.col("score")).cast("double") for n in _RULES]
    found = I.reviews(spark, folder).agg(*[F.avg(r).alias(f"a{k}") for k, r in enumerate(right)])
    points = F.array(*[F.struct(F.lit(k).alias("point"), F.col(f"a{k}").alias("accuracy")) for k in range(len(_RULES))])
    return first_best(found.select(F.inline(points)))
