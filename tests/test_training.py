"""The sentiment model: features, grid, choice, saving, scoring in batch and stream."""

import pytest
from pyspark.sql import functions as F

from speechviews.operators import features as X
from speechviews.plans import training as T
from speechviews.plans.batch_view import batch_view, score
from speechviews.sinks.tables import save_model, write_messages
from speechviews.sources.streams import file_messages
from speechviews.sources.tables import sentiment_model, stop_word_list, stop_words_text
from speechviews.streaming import live as L


@pytest.fixture(scope="module")
def reviews(spark):
    good, bad = "good great lovely film", "bad awful boring film"
    rows = [(i, f"{good if i % 2 else bad} number{i % 7} the The", i % 2) for i in range(300)]
    return spark.createDataFrame(rows, "id bigint, review string, score int").repartition(4).cache()


@pytest.fixture(scope="module")
def trained(reviews):
    return T.train(reviews, ["the"], singles=True)


def test_grid_order():
    points = T.grid_points()
    assert len(points) == 9
    assert [(p["regParam"], p["elasticNetParam"]) for p in points[:4]] == [(0.0, 0.0), (0.0, 0.2), (0.0, 0.4), (0.01, 0.0)]


def test_first_best_wins():
    assert T.best_index([0.1, 0.9, 0.9]) == 1
    assert T.best_index([0.0, 0.0]) == 0


def test_training(trained):
    assert trained.validation == [1.0] * 9 and trained.best == 0 and trained.test == 1.0
    assert trained.single == {"plain": 1.0, "elastic_net": 1.0}


def test_vocabulary_of_model_equals_the_table(spark, reviews):
    model = T.feature_model(reviews, ["the"])
    tokens = X.filtered_tokens(reviews, ["the"])
    rows = {r.word: r for r in X.idf_weights(tokens).collect()}
    counter, idf = model.stages[1].stages
    assert set(counter.vocabulary) == set(rows) and "the" not in rows
    for word, weight in zip(counter.vocabulary, idf.idf.toArray()):
        assert weight == pytest.approx(rows[word].idf, abs=1e-12)
    assert rows["film"].documents == rows["film"].total == 300


def test_small_vocabulary_keeps_the_most_frequent(reviews):
    tokens = X.filtered_tokens(reviews, ["the"])
    assert [r.word for r in X.vocabulary(tokens, size=3).collect()] == ["film", "number", "awful"]
    assert X.vocabulary(tokens, min_documents=301).count() == 0


def test_term_frequencies_match_brute_force(spark):
    rows = [(1, ["b", "a", "b"]), (2, []), (3, ["z"]), (4, ["x", "x", "x"])]
    tokens = spark.createDataFrame(rows, "id bigint, words array<string>")
    got = {(r.id, r.word): r.tf for r in X.term_frequencies(tokens).collect()}
    assert got == {(1, "a"): 1, (1, "b"): 2, (3, "z"): 1, (4, "x"): 3}


def test_split_ignores_the_layout(reviews):
    first = {(r.id, r.part) for r in X.hash_split(reviews).collect()}
    second = {(r.id, r.part) for r in X.hash_split(reviews.repartition(7)).collect()}
    assert first == second
    sizes = [sum(p == k for _, p in first) for k in (0, 1, 2)]
    assert sum(sizes) == 300 and 150 < sizes[0] < 210 and 60 < sizes[1] < 120


def test_random_split(reviews):
    from functools import partial

    parts = X.random_split(reviews, seed=0).groupBy("part").count().collect()
    assert sum(p["count"] for p in parts) == 300 and {p.part for p in parts} == {0, 1, 2}
    assert T.train(reviews, ["the"], split=partial(X.random_split, seed=1)).validation[0] == 1.0


def test_features_from_the_training_part_only(reviews):
    assert T.train(reviews, ["the"], fit_features_on="train").test == 1.0


def test_saved_model_scores_batch_and_stream_alike(spark, trained, recordings, tmp_path):
    path = str(tmp_path / "model")
    save_model(trained.model, path)
    save_model(trained.model, path)
    model = sentiment_model(path)
    rows = [(str(i), "cpd", "zone1", "14:30:00", "2020-12-09", t)
            for i, t in enumerate(["Good, great!", "awful; boring", "lovely", "a an"])]
    scored = score(recordings(rows), model)
    assert {r.id: r.prediction for r in scored.collect()}["1"] == 0.0
    positives = scored.where("prediction > 0").count()
    view = batch_view(recordings(rows), ["the"], model).first()
    assert (view.sentiment_score_sum, view.sentiment_score_total) == (positives, 4)
    other = batch_view(recordings(rows), ["the"], model, score_mode="first_plus_one").first()
    assert other.sentiment_score_sum == 2

    messages = recordings(rows).select(
        F.concat(F.lit("09122020143000.cpd.zone1.noAudio."), "id").alias("key"), F.col("text").alias("body"))
    write_messages(messages.unionByName(messages.withColumn("body", F.lit(None).cast("string"))), str(tmp_path / "in"))
    ledger = str(tmp_path / "ledger")
    L.finish(*L.start_ledger(file_messages(spark, str(tmp_path / "in")), ledger, str(tmp_path / "cp"), model=model, trigger=L.ALL_AVAILABLE))
    live = L.M.live_totals(L.ledger_events(spark, ledger)).first()
    assert (live.sentiment_score_sum, live.sentiment_score_total) == (positives, 4)


def test_stop_word_file(spark, tmp_path):
    (tmp_path / "stop").write_text("the\n and\nDie\n")
    assert stop_word_list(stop_words_text(spark, str(tmp_path / "stop"))) == ["the", " and", "Die"]
