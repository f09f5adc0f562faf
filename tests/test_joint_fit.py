"""Fitting several regressions in shared passes, against brute force and the single fits."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from speechviews.plans import joint_fit as J

POINTS = [{"regParam": r, "elasticNetParam": e} for r in (0.01, 0.1) for e in (0.0, 0.3, 1.0)]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(5)
    weights = np.array([2.0, -1.5, 0.0, 0.7, 0.0, 0.0, 3.0])
    out = []
    for _ in range(400):
        x = rng.normal(size=7) * (rng.random(7) < 0.6) * [1, 5, 1, 0.1, 1, 2, 1]
        x[5] = 0.0  # a feature that never occurs
        out.append((x, int(rng.random() < 1 / (1 + np.exp(-(x @ weights + 0.4))))))
    return out


@pytest.fixture(scope="module")
def train(spark, rows):
    vectors = [Vectors.dense(x) if k % 3 else Vectors.sparse(7, np.flatnonzero(x), x[np.flatnonzero(x)]) for k, (x, _) in enumerate(rows)]
    return spark.createDataFrame([(v, y) for v, (_, y) in zip(vectors, rows)], ["tfidf", "score"]).repartition(3).cache()


def test_joint_fits_end_where_single_fits_end(train):
    together = J.fit_together(train, POINTS, 300)
    for point, model in zip(POINTS, together):
        alone = LogisticRegression(labelCol="score", featuresCol="tfidf", maxIter=300, tol=1e-9, **point).fit(train)
        assert model.coefficients.toArray() == pytest.approx(alone.coefficients.toArray(), abs=0.01)
        assert model.intercept == pytest.approx(alone.intercept, abs=0.01)
        assert model.getRegParam() == point["regParam"]
        same = model.transform(train).select(F.col("prediction").alias("p"), "tfidf").join(alone.transform(train).select("prediction", "tfidf"), "tfidf")
        assert same.where("p <> prediction").count() <= 2


def test_a_pass_adds_up_in_any_number_of_tasks(spark, train, rows, monkeypatch):
    monkeypatch.setattr(J, "COLUMNS", 3)
    monkeypatch.setattr(J, "ENTRIES", 10)
    trials = np.random.default_rng(0).normal(size=(8, 3))
    x = np.array([np.append(v, 1.0) for v, _ in rows])
    y = np.array([label for _, label in rows])
    margins = x @ trials
    expected = (np.logaddexp(0, margins) - margins * y[:, None]).mean(0), x.T @ (1 / (1 + np.exp(-margins)) - y[:, None]) / len(y)
    vector = F.unwrap_udt("tfidf")
    flat = train.select(F.col("score").alias("label"), F.when(vector.type == 0, vector.indices).otherwise(F.sequence(F.lit(0), F.lit(6))).alias("indices"), vector["values"].alias("values"))
    for tasks in (1, 40, 300):
        losses, gradients = J.losses_and_gradients(flat.repartition(tasks), trials, tasks)
        assert losses == pytest.approx(expected[0]) and gradients == pytest.approx(expected[1])


def test_a_pass_sends_the_driver_each_sum_once(train, monkeypatch):
    monkeypatch.setattr(J, "COLUMNS", 3)
    sent, real = [], type(train).toArrow
    monkeypatch.setattr(type(train), "toArrow", lambda df: sent.append(real(df)) or sent[-1])
    row = [F.col("score").alias("label"), F.sequence(F.lit(0), F.lit(6)).alias("indices"), F.array(*[F.lit(1.0)] * 7).alias("values")]
    J.losses_and_gradients(train.repartition(12).select(*row), np.zeros((8, 2)), 12)
    assert sorted(sent[0]["part"].to_pylist()) == [0, 3, 6, 9]


def test_passes_are_those_of_one_model(train, monkeypatch):
    passes, real = [], J.losses_and_gradients
    monkeypatch.setattr(J, "losses_and_gradients", lambda rows, trials, tasks: passes.append(trials.shape[1]) or real(rows, trials, tasks))
    J.fit_together(train, [*POINTS, {"regParam": 0.0, "elasticNetParam": 0.0}, {"regParam": 0.0, "elasticNetParam": 0.4}], 10)
    assert len(passes) <= 25 and passes[0] == 7  # models without penalty are one


def test_rows_of_one_label_and_no_rows(train):
    model = J.fit_together(train.where("score = 1"), [POINTS[0]], 5)[0]
    assert model.transform(train).where("prediction = 0").count() == 0
    with pytest.raises(ValueError):
        J.fit_together(train.limit(0), POINTS, 5)
