"""Scores of behaviours as they change: a stored, versioned model and a keyed table of scores.

A model is trained only where none is stored, where the newest one is too old, or where it was trained on other features; until then every batch
loads the same version. A behaviour is scored only where no score of the same vector is stored, so unchanged rows keep theirs, also across models.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidewatch.operators.forest import NODE_SCHEMA, Model, fit, model_is_stale, score_with, unscored
from tidewatch.session import stored
from tidewatch.settings import ASSET_15M, DEFAULTS, FeatureSpec, Settings
from tidewatch.sources.keyed import KeyedTable, finished_versions

c = F.col
BASELINE_SCHEMA = "pos int, feature string, median double, spread double"
VERSION_SCHEMA = "number int, feature_set string, features bigint, training_rows bigint, cutoff double, trained_at timestamp"


class ModelStore:
    """Node table, baseline and cut-off per version. The version's row is written last, so a half-written model is never loaded."""

    def __init__(self, spark: SparkSession, path: str, spec: FeatureSpec = ASSET_15M, settings: Settings = DEFAULTS):
        self.spark, self.path, self.spec, self.settings = spark, path.rstrip("/"), spec, settings

    def _features(self) -> Column:
        return F.xxhash64(F.array(*[F.lit(n) for n in self.spec.vector]))

    def versions(self) -> DataFrame:
        """One row per finished version."""
        paths = [f"{self.path}/versions/version-{n}" for n in finished_versions(self.spark, f"{self.path}/versions")]
        return self.spark.read.schema(VERSION_SCHEMA).parquet(*paths) if paths else self.spark.createDataFrame([], VERSION_SCHEMA)

    def load(self, number: int) -> Model:
        row = self.versions().where(c("number") == number).first()
        nodes = self.spark.read.schema(NODE_SCHEMA).parquet(f"{self.path}/nodes/version-{number}")
        baseline = self.spark.read.schema(BASELINE_SCHEMA).parquet(f"{self.path}/baseline/version-{number}")
        return Model(nodes, baseline, row.cutoff, row.training_rows, number)

    def train(self, training: DataFrame, as_of: Column) -> Model | None:
        """The next version; None, and nothing stored, where the training rows are too few."""
        model = fit(training, self.spec, self.settings)
        if model is None:
            return None
        number = (finished_versions(self.spark, f"{self.path}/versions") or [0])[-1] + 1
        model.nodes.write.mode("overwrite").parquet(f"{self.path}/nodes/version-{number}")
        model.baseline.write.mode("overwrite").parquet(f"{self.path}/baseline/version-{number}")
        row = self.spark.range(1).select(
            F.lit(number).alias("number"), F.lit(self.spec.feature_set).alias("feature_set"), self._features().alias("features"),
            F.lit(model.training_rows).cast("bigint").alias("training_rows"), F.lit(model.cutoff).alias("cutoff"), as_of.alias("trained_at"))
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/versions/version-{number}")
        return self.load(number)

    def current(self, training: Callable[[], DataFrame], as_of: Column, force: bool = False) -> Model | None:
        """The newest version, or a new one where that is stale. ``training`` is asked for its rows only then."""
        stale = model_is_stale(c("trained_at"), as_of, self.settings, force) | (c("features") != self._features())
        newest = self.versions().orderBy(c("number").desc()).select("number", stale.alias("stale")).first()
        return self.train(training(), as_of) if newest is None or newest.stale else self.load(newest.number)


class ScoreStore:
    """Per behaviour its newest score, the hash of the vector it stands for, the model's number and the batch that scored it."""

    def __init__(self, models: ModelStore, path: str, buckets: int = 16):
        self.models = models
        self.scores = KeyedTable(models.spark, path, ["behavior_id"], buckets=buckets)

    @staticmethod
    def _hashed(behaviors: DataFrame) -> DataFrame:
        return behaviors.withColumn("vector_hash", F.xxhash64("ml.feature_names", "ml.feature_vector"))

    def score(self, behaviors: DataFrame, batch_id: int, training: Callable[[], DataFrame], as_of: Column, force: bool = False) -> Model | None:
        """Score the new and changed rows of a batch; the model that was used, or None where nothing was scored.

        A batch without such rows neither loads nor trains a model. Running the last batch again gives the same table.
        """
        ready = self._hashed(unscored(behaviors, self.models.settings))
        known = self.scores.lookup(ready.select("behavior_id"), batch_id)
        if known is not None:
            ready = ready.join(known.select("behavior_id", "vector_hash"), ["behavior_id", "vector_hash"], "left_anti")
        changed = stored(ready, "changed")
        if changed.isEmpty():
            return None
        model = self.models.current(training, as_of, force)
        if model is None:
            return None
        scored = score_with(model, changed, self.models.spec, self.models.settings, as_of).where("ml.anomaly_score is not null")
        self.scores.write(scored.select("behavior_id", "vector_hash", "ml", "score", F.lit(model.number).alias("model"), F.lit(batch_id).alias("scored_batch")), batch_id)
        return model

    def applied(self, behaviors: DataFrame) -> DataFrame:
        """``behaviors`` with their stored scores; a row whose vector has changed since, or that was never scored, stays as it is."""
        known = self.scores.read()
        if known is None:
            return behaviors
        marks = known.select("behavior_id", "vector_hash", c("ml").alias("_ml"), c("score").alias("_score"))
        rows = self._hashed(behaviors).join(marks, ["behavior_id", "vector_hash"], "left")
        return rows.withColumns({"ml": F.coalesce("_ml", "ml"), "score": F.coalesce("_score", "score")}).select(*behaviors.columns)
