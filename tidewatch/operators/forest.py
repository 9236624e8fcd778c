"""Robust-scaled isolation forest as tables: training rows -> node table -> scores.

Rows are dealt to trees by hash, each tree grows from at most ``sample_size`` rows in its own
task, and the model is a plain table of nodes (at most trees x 2 x sample_size rows, the only
data ever brought to the driver, to ship it to the scoring tasks).
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewatch.operators.quantiles import exact_quantiles
from tidewatch.session import stored
from tidewatch.settings import DEFAULTS, FeatureSpec, Settings

c = F.col
NODE_SCHEMA = "tree int, node int, feature int, threshold double, left int, right int, path double"
MODEL_NAME = "robust_scaled_isolation_forest"


def training_rows(behaviors: DataFrame, current: DataFrame | None = None, feedback: DataFrame | None = None,
                  settings: Settings = DEFAULTS, require_scored: bool = False) -> DataFrame:
    """Ready rows of good quality, without the rows being
    scored now and without windows an analyst marked as wrong or benign.

    ``require_scored`` restores the original's rule that training rows must already be scored,
    which can never start from an empty model.  ``feedback`` has (behavior_id, status).
    """
    rows = behaviors.where(c("ml.ready") & (c("quality.data_quality_score") >= settings.training_min_quality))
    if require_scored:
        rows = rows.where(c("ml.scoring_status") == "scored")
    if current is not None:
        rows = rows.join(current.select("behavior_id"), "behavior_id", "left_anti")
    if feedback is not None:
        marked = feedback.where(F.lower("status").isin(*settings.excluded_feedback)).select("behavior_id")
        rows = rows.join(marked, "behavior_id", "left_anti")
    return rows


def feature_matrix(behaviors: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(behavior_id, x): ready rows whose names and vector length agree with the spec."""
    names = F.array(*[F.lit(n) for n in spec.vector])
    good = c("ml.ready") & (c("ml.feature_names") == names) & (F.size("ml.feature_vector") == len(spec.vector))
    x = F.transform("ml.feature_vector", lambda v: F.coalesce(v, F.lit(0.0)))
    return behaviors.where(good).select("behavior_id", x.alias("x"))


def robust_baseline(matrix: DataFrame, spec: FeatureSpec) -> DataFrame:
    """(pos, feature, median, spread): exact percentiles, one row per feature; zero spread becomes 1.  Starts jobs."""
    q = exact_quantiles(matrix.select(F.posexplode("x").alias("pos", "v")), "pos", "v", (0.1, 0.5, 0.9))
    names = F.array(*[F.lit(n) for n in spec.vector])
    spread = c("q")[2] - c("q")[0]
    return q.select("pos", F.get(names, c("pos")).alias("feature"), c("q")[1].alias("median"),
                    F.when(spread == 0, 1.0).otherwise(spread).alias("spread"))


def scaled(matrix: DataFrame, baseline: DataFrame) -> DataFrame:
    """x -> (x - median) / spread.  The baseline is one array value, read as a scalar subquery."""
    model = baseline.agg(F.array_sort(F.collect_list(F.struct("pos", "median", "spread"))).alias("m")).scalar()
    return matrix.withColumn("m", model).select(
        "behavior_id", F.zip_with("x", "m", lambda v, b: (v - b.median) / b.spread).alias("x"))


def deal_to_trees(matrix: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """(tree, behavior_id, x): about 1.5 samples' worth of rows per tree by hash, trimmed to the sample.

    Only the rows a tree draws are emitted, so the work after the scan does not grow with the
    table.  Every tree sees every row when the table is no larger than the sample.
    """
    total = matrix.agg(F.count("*")).scalar()
    share = F.lit(1.5 * settings.sample_size) / total
    draw = lambda t: F.pmod(F.xxhash64("behavior_id", t, F.lit(settings.seed)), F.lit(1 << 40)) / F.lit(float(1 << 40))
    trees = F.filter(F.sequence(F.lit(0), F.lit(settings.trees - 1)), lambda t: draw(t) < c("share"))
    dealt = matrix.withColumn("share", share).select("behavior_id", "x", F.explode(trees).alias("tree"))
    order = Window.partitionBy("tree").orderBy(F.xxhash64("behavior_id", "tree"), "behavior_id")
    return dealt.withColumn("rank", F.row_number().over(order)).where(c("rank") <= settings.sample_size).drop("rank")


def average_path(n) -> np.ndarray:
    """Expected path length of an unsuccessful search among n points."""
    n = np.asarray(n, dtype=float)
    safe = np.maximum(n, 3)
    value = 2.0 * (np.log(safe - 1.0) + np.euler_gamma) - 2.0 * (safe - 1.0) / safe
    return np.where(n <= 1, 0.0, np.where(n == 2, 1.0, value))


def _grow(x: np.ndarray, rng: np.random.Generator) -> list[tuple]:
    limit = int(np.ceil(np.log2(max(len(x), 2))))
    nodes: list[tuple] = []
    todo = [(0, np.arange(len(x)), 0)]
    next_id = 1
    while todo:
        node, rows, depth = todo.pop()
        part = x[rows]
        low, high = part.min(axis=0), part.max(axis=0)
        usable = np.flatnonzero(high > low)
        if depth >= limit or len(rows) <= 1 or len(usable) == 0:
            nodes.append((node, -1, 0.0, -1, -1, depth + float(average_path(len(rows)))))
            continue
        feature = int(rng.choice(usable))
        cut = float(rng.uniform(low[feature], high[feature]))
        side = part[:, feature] <= cut
        nodes.append((node, feature, cut, next_id, next_id + 1, 0.0))
        todo += [(next_id, rows[side], depth + 1), (next_id + 1, rows[~side], depth + 1)]
        next_id += 2
    return nodes


def train_forest(matrix: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Node table.  One task per tree sees at most ``sample_size`` rows."""
    seed = settings.seed

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("behavior_id")
        tree = int(pdf["tree"].iloc[0])
        nodes = _grow(np.array(pdf["x"].tolist(), dtype=float), np.random.default_rng([seed, tree]))
        out = pd.DataFrame(nodes, columns=["node", "feature", "threshold", "left", "right", "path"])
        out.insert(0, "tree", tree)
        return out

    return deal_to_trees(matrix, settings).groupBy("tree").applyInPandas(grow, NODE_SCHEMA)


def score_function(nodes: DataFrame, sample_rows: int):
    """Arrow scoring function over the node table: x -> 2^(-mean path / expected path)."""
    table = nodes.orderBy("tree", "node").toPandas()  # bounded by trees x nodes per tree
    trees = [
        tuple(g[k].to_numpy() for k in ("feature", "threshold", "left", "right", "path"))
        for _, g in table.groupby("tree", sort=True)
    ]
    shipped = nodes.sparkSession.sparkContext.broadcast(trees)
    norm = float(average_path(sample_rows)) or 1.0

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        forest = shipped.value
        for s in batches:
            if len(s) == 0:
                yield pd.Series([], dtype=float)
                continue
            x = np.array(s.tolist(), dtype=float)
            total, every = np.zeros(len(x)), np.arange(len(x))
            for feature, threshold, left, right, path in forest:
                at = np.zeros(len(x), dtype=int)
                while True:
                    f = feature[at]
                    inner = f >= 0
                    if not inner.any():
                        break
                    go_left = x[every, np.maximum(f, 0)] <= threshold[at]
                    at = np.where(inner, np.where(go_left, left[at], right[at]), at)
                total += path[at]
            yield pd.Series(np.power(2.0, -(total / len(forest)) / norm))

    return score


def model_is_stale(trained_at: Column, as_of: Column, settings: Settings = DEFAULTS, force: bool = False) -> Column:
    age = F.unix_seconds(as_of) - F.unix_seconds(trained_at)
    return F.lit(force) | trained_at.isNull() | (age >= settings.retrain_seconds)


def model_row(matrix: DataFrame, spec: FeatureSpec, settings: Settings = DEFAULTS, trained_at: Column | None = None) -> DataFrame:
    """Metadata row of a trained model, or the reason why there is none."""
    rows = c("training_rows")
    return matrix.agg(F.count("*").alias("training_rows")).select(
        F.lit(MODEL_NAME).alias("name"), F.lit(f"{spec.feature_set}_iforest_v1").alias("version"),
        F.lit(spec.feature_set).alias("feature_set"), F.lit("IsolationForest").alias("model_type"), rows,
        F.lit(settings.contamination).alias("contamination"), F.lit(settings.training_min_quality).alias("training_min_quality_score"),
        F.when(rows < settings.min_training_rows, "not_enough_training_data").otherwise("trained").alias("status"),
        (F.current_timestamp() if trained_at is None else trained_at).alias("trained_at"))


# ---------------------------------------------------------------- scores as columns

def squash(raw: Column) -> Column:
    """Score into 0..1; a raw score in (0, 1] lands between 0.5 and 0.731."""
    value = F.lit(1.0) / (F.lit(1.0) + F.pow(F.lit(2.718281828), -raw))
    return F.round(F.greatest(F.lit(0.0), F.least(F.lit(1.0), value)), 6)


def top_drivers(names: Column, values: Column, baseline: Column, limit: int = 5) -> Column:
    """Features farthest from the baseline; ties by name descending, zero deviation dropped."""
    rows = F.zip_with(F.arrays_zip(names.alias("n"), values.alias("v")), baseline, lambda a, b: F.struct(
        F.abs(a.v - b).alias("gap"), a.n.alias("name"), a.v.alias("value"), b.alias("base")))
    best = F.slice(F.reverse(F.array_sort(rows)), 1, limit)
    return F.transform(F.filter(best, lambda r: r.value != r.base), lambda r: F.struct(
        r["name"].alias("name"), r.value.alias("value"), F.round(r.base, 6).alias("baseline"), F.round(r.value - r.base, 6).alias("deviation")))


def severity(score: Column, anomaly: Column) -> Column:
    return F.when(anomaly & (score >= 0.9), "high").when(anomaly, "medium").otherwise("none")


def driver_reasons(anomaly: Column, drivers: Column) -> Column:
    named = F.transform(F.slice(drivers, 1, 3), lambda d: F.concat(F.lit("high_"), d["name"]))
    return (
        F.when(anomaly & (F.size(named) > 0), named).when(anomaly, F.array(F.lit("ml_behavior_anomaly")))
        .otherwise(F.array().cast("array<string>"))
    )


def apply_scores(behaviors: DataFrame, raw_scores: DataFrame, cutoff: Column, baseline: Column, spec: FeatureSpec,
                 scored_at: Column | None = None) -> DataFrame:
    """Write scores onto behaviour rows.  ``raw_scores`` is (behavior_id, raw); rows without one pass through."""
    rows = behaviors.join(raw_scores.select("behavior_id", "raw"), "behavior_id", "left").withColumns({
        "_score": squash(c("raw")), "_anomaly": c("raw") > cutoff,
        "_drivers": top_drivers(c("ml.feature_names"), c("ml.feature_vector"), baseline)})
    hit = c("raw").isNotNull()
    keep = lambda name, value: F.when(hit, value).otherwise(c(name))
    ml = {
        "model_name": F.lit(MODEL_NAME), "model_version": F.lit(f"{spec.feature_set}_iforest_v1"), "anomaly_score": c("_score"),
        "is_anomaly": c("_anomaly"), "scored_at": F.current_timestamp() if scored_at is None else scored_at,
        "scoring_status": F.lit("scored"), "top_features": c("_drivers"),
    }
    score = {"ml": c("_score"), "final": F.round(c("_score") * 100, 2), "severity": severity(c("_score"), c("_anomaly")),
             "reasons": driver_reasons(c("_anomaly"), c("_drivers"))}
    ml_fields = dict(behaviors.select("ml.*").dtypes)
    return rows.select(*[n for n in behaviors.columns if n not in ("ml", "score")],
                       F.struct(*[(keep(f"ml.{n}", ml[n]) if n in ml else c(f"ml.{n}")).alias(n) for n in ml_fields]).alias("ml"),
                       F.struct(*[keep(f"score.{n}", v).alias(n) for n, v in score.items()]).alias("score"))


def with_status(behaviors: DataFrame, status: str) -> DataFrame:
    """No model: the reason is written as scoring status and as the only score reason."""
    return behaviors.withColumns({
        "ml": c("ml").withField("scoring_status", F.lit(status)), "score": c("score").withField("reasons", F.array(F.lit(status)))})


def unscored(behaviors: DataFrame, settings: Settings = DEFAULTS) -> DataFrame:
    """Ready rows of good quality that still need a score."""
    return behaviors.where(
        c("ml.ready") & (c("quality.data_quality_score") >= settings.training_min_quality)
        & ~F.coalesce(c("ml.scoring_status") == "scored", F.lit(False)))


@dataclass(frozen=True)
class Model:
    """``nodes`` and ``baseline`` are stored tables; both are bounded by the settings."""

    nodes: DataFrame
    baseline: DataFrame
    cutoff: float
    training_rows: int
    number: int = 0


def fit(training: DataFrame, spec: FeatureSpec, settings: Settings = DEFAULTS) -> Model | None:
    """A model of the training rows, or None where they are too few.  Starts jobs."""
    matrix = stored(feature_matrix(training, spec), "matrix")
    n = matrix.count()
    if n < settings.min_training_rows:
        return None
    baseline = stored(robust_baseline(matrix, spec), "baseline")
    fitted = scaled(matrix, baseline)
    nodes = stored(train_forest(fitted, settings), "nodes")
    scores = stored(fitted.select(F.lit(0).alias("k"), score_function(nodes, min(settings.sample_size, n))("x").alias("s")), "training-scores")
    cutoff = exact_quantiles(scores, "k", "s", (1.0 - settings.contamination,)).first().q[0]
    return Model(nodes, baseline, cutoff, n)


def score_with(model: Model, current: DataFrame, spec: FeatureSpec, settings: Settings = DEFAULTS, scored_at: Column | None = None) -> DataFrame:
    """``current`` with the model's scores on its ready rows."""
    medians = [r.median for r in model.baseline.orderBy("pos").select("median").collect()]  # one value per feature
    score = score_function(model.nodes, min(settings.sample_size, model.training_rows))
    raw = scaled(feature_matrix(current, spec), model.baseline).select("behavior_id", score("x").alias("raw"))
    return apply_scores(current, raw, F.lit(model.cutoff), F.array(*[F.lit(float(m)) for m in medians]), spec, scored_at)


def score_behaviors(current: DataFrame, training: DataFrame, spec: FeatureSpec, settings: Settings = DEFAULTS) -> DataFrame:
    """Train on ``training`` and score ``current``."""
    model = fit(training, spec, settings)
    return with_status(current, "not_enough_training_data") if model is None else score_with(model, current, spec, settings)
