"""Exact quantiles against the built-in aggregate and numpy; stored models and scores of changed rows."""

import dataclasses

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewatch.operators import forest as K
from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.settings import ASSET_15M, DEFAULTS
from tidewatch.streaming.scoring import ModelStore, ScoreStore

FRACTIONS = (0.0, 0.1, 0.5, 0.9, 0.95, 1.0)


@pytest.mark.parametrize("small", [3, 50, 100_000])
def test_quantiles_equal_the_built_in_aggregate(spark, small):
    rng = np.random.default_rng(1)
    ties = np.where(rng.random(3000) < 0.4, 7.0, rng.normal(0, 100, 3000))
    columns = [ties, rng.pareto(0.3, 3000), np.zeros(500), np.array([2.5]), np.array([1.0, -4.0]), np.repeat([0.0, 1.0], 400), rng.integers(-3, 3, 999).astype(float)]
    rows = [(k, float(v)) for k, column in enumerate(columns) for v in column] + [(0, None), (9, None)]
    frame = spark.createDataFrame(rows, "pos int, v double")
    got = {r.pos: r.q for r in exact_quantiles(frame, "pos", "v", FRACTIONS, small).collect()}
    built_in = frame.where("v is not null").groupBy("pos").agg(F.percentile("v", F.array(*[F.lit(f) for f in FRACTIONS])).alias("q"))
    assert got == {r.pos: r.q for r in built_in.collect()} and set(got) == set(range(7))
    for k, column in enumerate(columns):
        assert np.allclose(got[k], np.quantile(column, FRACTIONS))


def test_quantiles_of_nothing(spark):
    none = exact_quantiles(spark.createDataFrame([], "pos int, v double"), "pos", "v", (0.5,))
    assert none.columns == ["pos", "q"] and none.count() == 0


SPEC = dataclasses.replace(ASSET_15M, vector=ASSET_15M.vector[:3])


def behaviors(spark, rows):
    """(id, x) as behaviour rows with three features."""
    empty = "array<struct<name:string,value:double,baseline:double,deviation:double>>"
    none = lambda t, n: F.lit(None).cast(t).alias(n)
    return spark.createDataFrame(rows, "behavior_id string, x array<double>").select(
        "behavior_id", F.struct(F.lit(100).alias("data_quality_score")).alias("quality"),
        F.struct(F.lit(True).alias("ready"), F.array(*[F.lit(n) for n in SPEC.vector]).alias("feature_names"), F.col("x").alias("feature_vector"),
                 none("string", "model_name"), none("string", "model_version"), none("double", "anomaly_score"), none("boolean", "is_anomaly"),
                 none("timestamp", "scored_at"), F.lit("not_scored").alias("scoring_status"), F.array().cast(empty).alias("top_features")).alias("ml"),
        F.struct(none("double", "ml"), none("double", "final"), F.lit("none").alias("severity"), F.array().cast("array<string>").alias("reasons")).alias("score"))


def at(hours):
    return F.timestamp_seconds(F.lit(hours * 3600))


def test_a_model_is_reused_until_stale_and_only_changed_rows_are_scored(spark, tmp_path):
    rng = np.random.default_rng(2)
    first = [(f"b{i:02d}", rng.normal(size=3).tolist()) for i in range(40)]
    settings = dataclasses.replace(DEFAULTS, trees=10)
    models = ModelStore(spark, f"file://{tmp_path}/models", SPEC, settings)
    store = ScoreStore(models, f"file://{tmp_path}/scores", buckets=2)
    trained = []

    def training(rows):
        def ask():
            trained.append(len(rows))
            return behaviors(spark, rows)
        return ask

    assert store.applied(behaviors(spark, first)).where("ml.anomaly_score is not null").count() == 0
    assert store.score(behaviors(spark, first[:5]), 0, training(first[:5]), at(0)) is None  # too few rows: no version, nothing scored
    assert models.versions().count() == 0 and store.scores.read() is None
    assert store.score(behaviors(spark, first), 1, training(first), at(0)).number == 1
    scores = lambda: {r.behavior_id: r for r in store.scores.read().collect()}
    before = scores()
    assert len(before) == 40 and {(r.model, r.scored_batch) for r in before.values()} == {(1, 1)}

    second = [(n, [x[0] + 5, *x[1:]]) if n in ("b03", "b07") else (n, x) for n, x in first] + [("new", [9.0, 9.0, 9.0])]
    trained.clear()
    assert store.score(behaviors(spark, second), 2, training(second), at(1)).number == 1 and trained == []
    after = scores()
    assert {n for n, r in after.items() if r.scored_batch == 2} == {"b03", "b07", "new"} and {r.model for r in after.values()} == {1}
    assert all(after[n] == r for n, r in before.items() if n not in ("b03", "b07"))
    store.score(behaviors(spark, second), 2, training(second), at(1))  # the batch again
    assert scores() == after and trained == []
    assert store.score(behaviors(spark, second), 3, training(second), at(9)) is None and trained == []  # nothing changed: no training although stale

    third = [("b07", [1.0, 1.0, 1.0])]
    assert store.score(behaviors(spark, third), 4, training(second), at(9)).number == 2 and trained == [41]
    last = scores()
    assert (last["b07"].model, last["b07"].scored_batch) == (2, 4) and all(last[n] == r for n, r in after.items() if n != "b07")
    assert [tuple(r) for r in models.versions().orderBy("number").select("number", "training_rows", F.unix_seconds("trained_at")).collect()] == [(1, 40, 0), (2, 41, 32400)]
    shown = {r.behavior_id: r.ml.anomaly_score for r in store.applied(behaviors(spark, second)).collect()}
    assert shown["b03"] == last["b03"].ml.anomaly_score and shown["b07"] is None and None not in [s for n, s in shown.items() if n != "b07"]


def test_a_stored_model_scores_as_the_fitted_one_and_unfinished_versions_are_not_loaded(spark, tmp_path):
    rng = np.random.default_rng(3)
    rows = behaviors(spark, [(f"b{i:02d}", rng.normal(size=3).tolist()) for i in range(30)])
    settings = dataclasses.replace(DEFAULTS, trees=5)
    models = ModelStore(spark, f"file://{tmp_path}/m", SPEC, settings)
    fitted = K.fit(rows, SPEC, settings)
    models.train(rows, at(0))
    scores = lambda m: sorted((r.behavior_id, r.s, r.a) for r in K.score_with(m, rows, SPEC, settings, at(0)).select("behavior_id", F.col("ml.anomaly_score").alias("s"), F.col("ml.is_anomaly").alias("a")).collect())
    assert scores(models.load(1)) == scores(fitted)
    (tmp_path / "m/versions/version-2").mkdir()
    assert models.current(lambda: rows, at(1)).number == 1
    other = ModelStore(spark, f"file://{tmp_path}/m", dataclasses.replace(SPEC, vector=SPEC.vector[::-1]), settings)
    asked = []
    assert other.current(lambda: asked.append(1) or rows.limit(0), at(1)) is None and asked == [1]  # other features: the stored model is stale
