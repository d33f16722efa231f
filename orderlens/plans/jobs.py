"""Batch jobs: train and score the three models, explain them, report on return lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.feature import SQLTransformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import explain, orders, quality, recommend, returns
from ..operators.metrics import binary_metrics
from ..operators.sampling import (class_weights, smote, stratified_split, validation_split)
from ..sources.store import materialize, write_recommendations, write_splits
from ..sources.tables import Tables
from . import learners


@dataclass(frozen=True)
class ReturnConfig:
    discount_min: float = 0.2
    net_max: float = 200
    smote_ratio: float = 0.3
    threshold: float = 0.3
    hidden: Sequence[int] = (32, 16)
    max_iter: int = 50
    seed: int = 42
    learner: str = "perceptron"
    #: Share of the training side held out (real rows) to stop the network; 0 for none.
    hold_out: float = 0.25
    step: int = 5
    patience: int = 2
    min_delta: float = 0.001
    splits_path: str | None = None


@dataclass(frozen=True)
class ReorderConfig:
    since: str = "1997-05-06"
    fanout: bool = True
    horizon_days: int = 180
    reliable_months: int = 6
    variant: str = "smote"
    smote_ratio: float = 0.5
    smote_before_split: bool = False
    threshold: float = 0.5
    hidden: Sequence[int] = (64, 32)
    max_iter: int = 30
    seed: int = 42
    hold_out: float = 0.2
    step: int = 5
    patience: int = 2
    min_delta: float = 0.0


@dataclass(frozen=True)
class RecommendConfig:
    trees: int = 200
    rate: float = 0.05
    depth: int = 5
    k: int = 5
    smote_ratio: float = 1.0
    balanced_weights: bool = True
    scale_before_split: bool = False
    early_stop: bool = False
    exclude_purchased: bool = False
    #: Bound on the labelled pairs that the fit reads; the sample holds as many bought ones as
    #: others if there are enough.
    fit_pairs: int = 100_000
    seed: int = 42
    #: Folder in which the recommendations are stored for lookups.
    top_path: str | None = None


@dataclass(frozen=True)
class Trained:
    """A fitted model with its metric rows, its scored test set and its training rows; a network
    also has the loss curve of its fit."""
    model: PipelineModel
    metrics: DataFrame
    scored_test: DataFrame
    train: DataFrame
    columns: list[str] = field(default_factory=list)
    curve: DataFrame | None = None
    #: The reorder model behind the stage that makes the quarter columns: it takes orders as
    #: ``reorder_labels`` returns them (with ``net_spent_winsorized``).
    raw_model: PipelineModel | None = None


def _scaled_columns(cols: Sequence[str]) -> list[str]:
    return [f"{c}_scaled" for c in cols]


def _network(stages: Sequence, cols: Sequence[str], cfg: ReturnConfig | ReorderConfig,
             label: str, key: str, ready: DataFrame, ratio: float | None
             ) -> tuple[PipelineModel, DataFrame]:
    """A network fitted on scaled rows, oversampled to ``ratio`` unless it is None, with a part of
    the rows held out before that; and its loss curve."""
    scaled, spark = _scaled_columns(cols), ready.sparkSession
    held = ready.limit(0)
    if cfg.hold_out:
        parts = materialize(validation_split(ready, label, key, cfg.hold_out), "network-parts")
        held = parts.where("is_validation").drop("is_validation")
        ready = parts.where(~F.col("is_validation")).drop("is_validation")
    if ratio is not None:
        ready = smote(ready, scaled, label, key, ratio, seed=cfg.seed)
    ready = materialize(ready.select(label, *scaled), "network-train")
    network = learners.perceptron(len(cols), cfg.hidden, label, cfg.max_iter, cfg.seed)
    model, curve = learners.fitted_with_patience(
        stages, cols, network, ready, held, label, cfg.step, cfg.patience, cfg.min_delta)
    return model, curve.table(spark)


def train_returns(tables: Tables, cfg: ReturnConfig = ReturnConfig()) -> Trained:
    """Split, scale on the training side, oversample it, fit, evaluate on untouched rows."""
    cols, label, key = returns.RETURN_FEATURES, "is_returned", "line_id"
    lines = returns.return_lines(tables, cfg.discount_min, cfg.net_max).select(key, label, *cols)
    rows = materialize(stratified_split(lines, label, key, seed=cfg.seed), "return-rows")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    scaling = learners.scaling_stage(train, cols)
    scaled = scaling.transform(rows).select(key, label, "split", *_scaled_columns(cols))
    if cfg.splits_path:
        write_splits(scaled, cfg.splits_path)
    ready, curve = scaled.where("split = 'train'").drop("split"), None
    if cfg.learner == "logistic":
        balanced = materialize(smote(ready, _scaled_columns(cols), label, key, cfg.smote_ratio,
                                     seed=cfg.seed), "return-train")
        model = learners.fitted([scaling], cols, learners.logistic(label, cfg.max_iter), balanced)
    else:
        model, curve = _network([scaling], cols, cfg, label, key, ready, cfg.smote_ratio)
    scored = materialize(learners.score(model, test, cfg.threshold), "return-scores")
    return Trained(model, binary_metrics(scored, label), scored, train, list(cols), curve)


def score_returns(model: PipelineModel, requests: DataFrame, threshold: float = 0.3) -> DataFrame:
    """Score request rows; the probability is also given to three places, and as text."""
    scored = learners.score(model, requests, threshold, texts=("not returned", "returned"))
    return scored.withColumn("return_probability", F.round("probability", 3))


def explain_returns(trained: Trained, key: str = "line_id", n: int = 5,
                    n_background: int = 100) -> dict[str, DataFrame]:
    """Attributions of the test rows, their mean size per feature, and the first risky rows."""
    background = explain.background_sample(trained.train, trained.columns, key, n_background)
    values = materialize(explain.shapley_values(
        explain.model_score(trained.model), trained.scored_test, trained.columns, background, key),
        "attributions")   # two of the tables read them
    return {"values": values, "importance": explain.feature_importance(values),
            "risky": explain.explain_risky(trained.model, trained.scored_test, trained.columns,
                                           background, key, n)}


def reorder_training_rows(tables: Tables, cfg: ReorderConfig
                          ) -> tuple[DataFrame, list[str], SQLTransformer]:
    """Labelled orders with the quarter as 0/1 columns, the feature names, and the stage that
    made those columns. The reliability flag is constant after filtering and is left out."""
    # Labels, their dates and the limits all read the features, and behind them lie all lines.
    features = materialize(orders.order_features(tables, cfg.since, cfg.fanout), "order-features")
    labelled = materialize(orders.reorder_labels(features, cfg.horizon_days, cfg.reliable_months),
                           "reorder-labels")
    winsorized = quality.winsorize(features, "net_spent").select("order_id", "net_spent_winsorized")
    quarter = learners.quarter_stage(orders.quarter_levels(labelled))
    rows = quarter.transform(labelled).join(winsorized, "order_id")
    rows = rows.withColumn("will_reorder_6m", F.col("will_reorder_6m").cast("int")).withColumn(
        "order_id", F.col("order_id").cast("string"))
    quarters = [c for c in rows.columns if c.startswith("year_quarter_")]
    cols = ["net_spent", "total_quantity", "avg_discount", "avg_unit_price", "total_orders",
            "net_spent_winsorized", *quarters]
    return rows.select("order_id", "will_reorder_6m", *cols), cols, quarter


def train_reorder(tables: Tables, cfg: ReorderConfig = ReorderConfig()) -> Trained:
    """``variant="plain"`` fits on the rows as they are, ``"smote"`` on oversampled ones: by
    default only the training side, with ``smote_before_split`` all rows."""
    label, key = "will_reorder_6m", "order_id"
    rows, cols, quarter = reorder_training_rows(tables, cfg)
    if cfg.variant == "smote" and cfg.smote_before_split:
        rows = smote(rows, cols, label, key, cfg.smote_ratio, seed=cfg.seed)
    rows = materialize(stratified_split(rows, label, key, seed=cfg.seed), "reorder-rows")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    scaling = learners.scaling_stage(train, cols)
    ready = scaling.transform(train).select(key, label, *_scaled_columns(cols))
    ratio = cfg.smote_ratio if cfg.variant == "smote" and not cfg.smote_before_split else None
    model, curve = _network([scaling], cols, cfg, label, key, ready, ratio)
    scored = materialize(learners.score(model, test, cfg.threshold), "reorder-scores")
    raw_model = PipelineModel(stages=[quarter, *model.stages])
    return Trained(model, binary_metrics(scored, label), scored, train, cols, curve, raw_model)


@dataclass(frozen=True)
class Recommender:
    """A fitted recommender: its best k products per customer with all feature columns, and its
    metric rows."""
    model: PipelineModel
    top: DataFrame
    metrics: DataFrame


def train_recommender(tables: Tables, cfg: RecommendConfig = RecommendConfig(),
                      candidates: DataFrame | None = None) -> Recommender:
    """Fit boosted trees on a bounded sample of labelled pairs, score every customer with every
    product (or the ``candidates``), and keep the best k per customer.

    The fit sees at most about ``cfg.fit_pairs`` pairs, drawn before any grid is built; metrics
    come from the held-out part of the sample, each pair weighted by the pairs it stands for, and
    precision@k from the recommendations of all customers. Scored pairs stream from the grid
    through the model to the ranking; no table of the grid's size is written.
    """
    cols, label, key = recommend.RECOMMEND_FEATURES, "purchased", "pair_id"
    ids = ["customer_id", "product_id"]
    known = recommend.summarize(tables)
    sample = materialize(recommend.sample_pairs(tables, cfg.fit_pairs, cfg.seed, known),
                         "recommend-pairs")
    features = recommend.recommend_features(tables, sample, known).join(
        sample.select(*ids, "weight"), ids).select(
        *ids, F.concat_ws("|", *ids).alias(key), label, F.col("weight").alias("stands_for"), *cols)
    rows = materialize(stratified_split(features, label, key, seed=cfg.seed), "recommend-rows")
    train, test = rows.where("split = 'train'"), rows.where("split = 'test'")
    scaling = learners.scaling_stage(rows if cfg.scale_before_split else train, cols)
    ready = scaling.transform(train).select(key, label, *_scaled_columns(cols))
    validation = None
    if cfg.early_stop:
        # Held-out rows are real ones: they are set aside before oversampling.
        validation = "is_validation"
        parts = materialize(validation_split(ready, label, key), "recommend-parts")
        held = parts.where(validation)
        ready = smote(parts.where(~F.col(validation)).drop(validation), _scaled_columns(cols),
                      label, key, cfg.smote_ratio, seed=cfg.seed)
        ready = ready.withColumn(validation, F.lit(False)).unionByName(
            held.withColumn("is_synthetic", F.lit(0)))
    else:
        ready = smote(ready, _scaled_columns(cols), label, key, cfg.smote_ratio, seed=cfg.seed)
    ready = materialize(ready, "recommend-train")
    weight = "weight" if cfg.balanced_weights else None
    if weight:
        ready = class_weights(ready, label)
    model = learners.fitted([scaling], cols, learners.boosted_trees(
        label, cfg.trees, cfg.rate, cfg.depth, weight, validation, cfg.seed), ready)

    probability = "purchase_probability"
    tested = learners.probability_of(model, test, probability).select(
        label, "stands_for", probability,
        F.when(F.col(probability) > 0.5, 1).otherwise(0).alias("prediction"))
    pairs = recommend.recommend_features(tables, candidates, known)
    scored = learners.probability_of(model, pairs.select(*ids, label, *cols), probability)
    best = materialize(recommend.top_of_stream(scored, cfg.k, probability, cfg.exclude_purchased),
                       "recommend-top")
    precision = recommend.precision_at_k(best, cfg.k)
    top = recommend.recommend_features(tables, best, known).join(
        best.select(*ids, probability, "rank"), ids)
    if cfg.top_path:
        write_recommendations(top, cfg.top_path)
    metrics = binary_metrics(materialize(tested, "recommend-tested"), label, probability,
                             "stands_for").unionByName(precision.select(
        F.lit(f"precision@{cfg.k}").alias("metric"), F.lit("1").alias("class"),
        F.col("precision").alias("value")))
    return Recommender(model, top, metrics)


def eda_report(lines: DataFrame) -> dict[str, DataFrame]:
    """The exploratory tables of return lines, by name.

    The plan behind ``lines`` runs once, into a work table. One pass over that gives rows, NULLs and
    moments of all columns, one pass by grouping sets all counts per group, and one all outlier
    counts; the quartiles are found once for the tables that need them.
    """
    cols = ["net_spent", "quantity", "discount", "unit_price",
            "avg_discount_by_product", "avg_net_spent_by_product"]
    rows, found = quality.counted(lines, cols)
    quartiles = quality.quartiles(rows, cols)
    spread = quality.spread_report(rows, quartiles)
    counts = returns.line_counts(rows)
    return {
        "preview": quality.table_preview(rows, ["order_id", "product_id", "line_id"]),
        "profile": quality.counted_profile(rows, found),
        "describe": quality.counted_moments(rows, cols, found).join(
            quartiles, "column").select(
            "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"),
        "outliers": spread.select("column", "n_outliers", "pct_outliers", "lower", "upper"),
        "boxplots": spread.select("column", F.col("q25").alias("q1"), F.col("q50").alias("median"),
                                  F.col("q75").alias("q3"), "whisker_low", "whisker_high",
                                  F.col("n_outliers").alias("n_fliers")),
        **counts,
    }
