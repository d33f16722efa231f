"""Registered queries: the flagship, one entry per operator, and their check SQL."""

from __future__ import annotations

import importlib.util
import os
import sys
from collections.abc import Callable
from functools import reduce

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

import oracles  # noqa: E402
from orderlens.functions.measures import parse_date  # noqa: E402
from orderlens.operators import (explain, metrics, orders, quality, recommend,  # noqa: E402
                                 returns, sampling)
from orderlens.plans import jobs, learners  # noqa: E402
from orderlens.sources import (load_model, materialize, new_work_path, read_recommendations,  # noqa: E402
                               read_recommendations_csv, read_split, save_model,
                               tables_from_star_schema, write_recommendations,
                               write_recommendations_csv, write_splits)

# The training-data operators and their pipeline are an add-on: without them the rest still works.
LLM = importlib.util.find_spec("orderlens.llm") is not None
if LLM:
    from orderlens.llm import queries as llm_queries  # noqa: E402
PIPELINE = LLM and importlib.util.find_spec("corpus_pipeline") is not None
if PIPELINE:
    import corpus_pipeline  # noqa: E402

# The test data has no discount above 0.10, so the rule label uses lower limits than the default.
RULE = {"discount_min": 0.08, "net_max": 10_000}
LINE_FEATURES = returns.RETURN_FEATURES


def _columns(key: str, df: DataFrame) -> DataFrame:
    """The output contract of a query, in types both engines share."""
    casts = {
        "i": lambda c: F.col(c).cast("bigint"),
        "d": lambda c: F.col(c).cast("double") + F.lit(0.0),
        "r4": lambda c: F.round(F.col(c).cast("double"), 4) + F.lit(0.0),
        "r6": lambda c: F.round(F.col(c).cast("double"), 6) + F.lit(0.0),
        "t": lambda c: F.col(c).cast("date").cast("string"),
        "s": lambda c: F.col(c).cast("string"),
    }
    return df.select(*[casts[kind](c).alias(c) for c, kind in oracles.COLUMNS[key].items()])


def _tables(spark: SparkSession, sf_dir: str):
    return tables_from_star_schema(spark, sf_dir)


def _features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.order_features(_tables(spark, sf_dir))


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders.reorder_labels(_features(spark, sf_dir))


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return returns.return_lines(_tables(spark, sf_dir), **RULE)


def _labelled_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("line_id", "is_returned")


def _closed_form_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines with a score computed from two columns, so that SQL can check the metrics."""
    score = F.col("discount").cast("double") * 5 + (50 - F.col("quantity")) * F.lit(0.01)
    scored = _lines(spark, sf_dir).select("line_id", F.col("is_returned").alias("label"),
                                          score.alias("score"))
    return metrics.score_threshold(scored, 0.5, "score")


def _closed_form_score(df: DataFrame) -> DataFrame:
    buyers = F.col("product_buyers")
    score = F.col("category_spend_share") + buyers / (buyers + 10.0) / (1 + F.col("price_ratio"))
    return df.withColumn("purchase_probability", score)


#: More buyers and a lower price never lower that score, unless a price below 0 turns its sign.
CLOSED_FORM_ORDER = recommend.ScoreOrder(
    rising=("product_buyers",), falling=("product_price",),
    products="product_price is null or product_price >= 0",
    customers="customer_avg_price is null or customer_avg_price >= 0")


def _closed_form_grid(spark: SparkSession, sf_dir: str,
                      known: recommend.Summaries | None = None, k: int = 5) -> DataFrame:
    """The grid with a score computed from its columns, without pairs that can't be among the k
    best of their customer."""
    tables = _tables(spark, sf_dir)
    known = recommend.summarize(tables) if known is None else known
    within = recommend.contenders(tables, known, _closed_form_score, CLOSED_FORM_ORDER, k)
    return _closed_form_score(recommend.recommend_features(tables, known=known, within=within))


def _closed_form_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _tables(spark, sf_dir)
    known = recommend.summarize(tables)
    return recommend.recommend_top(_closed_form_grid(spark, sf_dir, known), tables, known=known)


def _linear_score() -> explain.AdditiveScore:
    return explain.AdditiveScore({c: F.col(c) * F.lit(w) for c, w in
                                  zip(LINE_FEATURES, oracles.LINEAR_WEIGHTS)})


def _attributions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir)
    background = explain.background_sample(lines, LINE_FEATURES, "line_id")
    return explain.shapley_values(_linear_score(), lines, LINE_FEATURES, background, "line_id")


_trained: dict[tuple[str, str, str], object] = {}


def _once(spark: SparkSession, sf_dir: str, name: str, train: Callable):
    """What ``train`` returns, worked out once per session and data folder."""
    at = (spark.sparkContext.applicationId, sf_dir, name)
    if at not in _trained:
        _trained[at] = train()
    return _trained[at]


def _return_model(spark: SparkSession, sf_dir: str) -> jobs.Trained:
    return _once(spark, sf_dir, "returns", lambda: jobs.train_returns(
        _tables(spark, sf_dir), jobs.ReturnConfig(**RULE)))


def _parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order dates as text, malformed for one order status."""
    raw = spark.read.parquet(f"{sf_dir.rstrip('/')}/orders.parquet")
    text = F.concat(F.when(F.col("o_orderstatus") == "F", "on ").otherwise(""),
                    F.date_format("o_orderdate", "yyyy-MM-dd"))
    return raw.select(F.col("o_orderkey").alias("order_id"), parse_date(text).alias("order_date"))


def _grid_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole grid, every column of it, summed up per customer and category."""
    grid = recommend.recommend_grid(_tables(spark, sf_dir))
    same = ["customer_orders", "customer_spend", "customer_avg_price", "last_order_date",
            "category_spend", "category_quantity", "category_last_order"]
    added = ["product_price", "discontinued", "category_spend_share", "product_orders",
             "product_buyers", "price_ratio", "purchased"]
    return grid.groupBy("customer_id", "category_id", "category_name").agg(
        F.count("*").alias("n"), F.sum("product_id").alias("product_ids"),
        *[F.max(c).alias(c) for c in same], *[F.sum(c).alias(c) for c in added],
        F.sum(F.col("purchased") * F.col("product_id")).alias("purchased_ids"))


def _feature_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole feature frame, summed up per product."""
    added = ["recency_days", "category_recency_days", "category_spend_share", "price_ratio",
             "category_quantity", "purchased"]
    return recommend.recommend_features(_tables(spark, sf_dir)).groupBy("product_id").agg(
        F.count("*").alias("n"), F.sum("customer_id").alias("customer_ids"),
        *[F.sum(c).alias(c) for c in added])


def _recommend_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A group of customers looked up in the stored recommendations, which are made once."""
    def store() -> str:
        path = new_work_path(spark, "recommendations")
        write_recommendations(_closed_form_top(spark, sf_dir), path)
        return path

    keys = _tables(spark, sf_dir)["customers"].where("city = 'BUILDING'")
    path = _once(spark, sf_dir, "recommendations", store)
    return recommend.recommend_lookup(read_recommendations(spark, path), keys)


def _csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The recommendations with all their columns, written and read back."""
    path = new_work_path(spark, "recommendations-csv")
    top = _closed_form_top(spark, sf_dir).select(*oracles.FILE_COLUMNS)
    write_recommendations_csv(top, path)
    return read_recommendations_csv(spark, path, top.schema)


def _split_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scale on the training side, save by split, read both sides back."""
    lines = _lines(spark, sf_dir).select("line_id", "is_returned", *LINE_FEATURES)
    rows = sampling.stratified_split(lines, "is_returned", "line_id")
    scaled, _ = sampling.standard_scale(rows, LINE_FEATURES, rows.where("split = 'train'"))
    path = new_work_path(spark, "splits")
    write_splits(scaled.select("line_id", "is_returned", "split", *LINE_FEATURES), path)
    return read_split(spark, path, "train").unionByName(read_split(spark, path, "test"))


def _quarter_dummies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 0/1 columns of the quarters, one row per order and column."""
    dummies = orders.quarter_dummies(_labels(spark, sf_dir))
    marks = [c for c in dummies.columns if c.startswith("year_quarter_")]
    return dummies.select("order_id", F.inline(F.array(*[
        F.struct(F.lit(c).alias("quarter"), F.col(c).alias("flag")) for c in marks])))


def _model_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all lines by the saved and reloaded model next to those of the fitted one."""
    model, path = _return_model(spark, sf_dir).model, new_work_path(spark, "return-model")
    save_model(model, path)
    lines = _lines(spark, sf_dir).select("line_id", *LINE_FEATURES)
    both = learners.probability_of(load_model(path), lines, "reloaded")
    return learners.probability_of(model, both, "fitted").select("line_id", "fitted", "reloaded")


def _smote(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = _lines(spark, sf_dir).select("line_id", "is_returned", *LINE_FEATURES)
    return sampling.smote(lines, LINE_FEATURES, "is_returned", "line_id", ratio=0.3)


def _pca(spark: SparkSession, sf_dir: str) -> DataFrame:
    # Moments, components and both sides of the join read the rows.
    resampled = materialize(_smote(spark, sf_dir), "resampled")
    return learners.pca_2d(resampled, LINE_FEATURES, "line_id").join(
        resampled.select("line_id", "is_returned"), "line_id")


def _score_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    requests = _lines(spark, sf_dir).select(
        *[F.col(c).cast("double").alias(c) for c in LINE_FEATURES])
    return jobs.score_returns(_return_model(spark, sf_dir).model, requests)


def _explain_risky(spark: SparkSession, sf_dir: str) -> DataFrame:
    trained = _return_model(spark, sf_dir)
    background = explain.background_sample(trained.train, LINE_FEATURES, "line_id")
    return explain.explain_risky(trained.model, trained.scored_test, LINE_FEATURES, background,
                                 "line_id")


def _reorder_model(spark: SparkSession, sf_dir: str, variant: str = "smote") -> jobs.Trained:
    return _once(spark, sf_dir, f"reorder-{variant}", lambda: jobs.train_reorder(
        _tables(spark, sf_dir), jobs.ReorderConfig(variant=variant)))


def _reorder_scores(spark: SparkSession, sf_dir: str, variant: str = "smote") -> DataFrame:
    return _reorder_model(spark, sf_dir, variant).scored_test.select(
        "order_id", "will_reorder_6m", "probability", "prediction")


def _validation_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loss curves of the networks, from the fits whose scores the other queries return."""
    curves = {"return": _return_model(spark, sf_dir), "reorder": _reorder_model(spark, sf_dir)}
    first, second = (t.curve.select(F.lit(n).alias("network"), "*") for n, t in curves.items())
    return first.unionByName(second)


def _recommender(spark: SparkSession, sf_dir: str) -> jobs.Recommender:
    return _once(spark, sf_dir, "recommender", lambda: jobs.train_recommender(_tables(spark, sf_dir)))


def _eda_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All exploratory tables of one job in long form: report, item, measure, value."""
    report = jobs.eda_report(_lines(spark, sf_dir))
    parts = []
    for name, (item, measures) in oracles.REPORTS.items():
        cells = F.array(*[F.struct(F.lit(m).alias("measure"), _report_value(m).alias("value"))
                          for m in measures])
        key = F.concat_ws("/", *[F.col(c).cast("string") for c in item])
        parts.append(report[name].select(F.lit(name).alias("report"), key.alias("item"),
                                         F.inline(cells)))
    return reduce(DataFrame.unionByName, parts)


def _report_value(measure: str) -> F.Column:
    value = F.col(measure).cast("double")
    return F.round(value, 4) if measure in oracles.ROUNDED else value


def entry(spark: SparkSession) -> DataFrame:
    """Return-risk lines on the smallest test data."""
    return queries()["return_lines"](spark, "/root/testdata/sf0.001")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    numeric = orders.ORDER_NUMERIC
    checked = {
        "scan_order_lines": lambda s, d: _tables(s, d)["order_details"],
        "order_features": _features,
        "order_totals": lambda s, d: orders.order_features(_tables(s, d), fanout=False),
        "reorder_labels": _labels,
        "confirmed_lapsed": lambda s, d: orders.confirmed_lapsed(_labels(s, d)),
        "quarter_dummies": _quarter_dummies,
        "parse_dates": _parse_dates,
        "return_lines": _lines,
        "product_stats": lambda s, d: returns.product_stats(_tables(s, d)["order_details"]),
        "line_product_stats": lambda s, d: returns.line_product_stats(
            _tables(s, d)["order_details"]),
        "return_status_counts": lambda s, d: returns.return_status_counts(_lines(s, d)),
        "return_summary": lambda s, d: returns.return_summary(_lines(s, d)),
        "top_products": lambda s, d: returns.top_products(_lines(s, d)),
        "top_returned_products": lambda s, d: returns.top_returned_products(_lines(s, d)),
        "customer_summary": lambda s, d: recommend.customer_summary(_tables(s, d)),
        "product_popularity": lambda s, d: recommend.product_popularity(_tables(s, d)),
        "customer_category_spend": lambda s, d: recommend.customer_category_spend(_tables(s, d)),
        "purchased_pairs": lambda s, d: recommend.purchased_pairs(_tables(s, d)),
        "recommend_grid": _grid_totals,
        "recommend_features": _feature_totals,
        "top_k_per_customer": _closed_form_top,
        "precision_at_k": lambda s, d: recommend.precision_at_k(_closed_form_grid(s, d)),
        "recommend_lookup": _recommend_lookup,
        "csv_roundtrip": _csv_roundtrip,
        "iqr_bounds": lambda s, d: quality.iqr_bounds(_features(s, d), numeric),
        "outlier_report": lambda s, d: quality.outlier_report(_lines(s, d), LINE_FEATURES),
        "remove_outliers": lambda s, d: quality.remove_outliers(_features(s, d), numeric),
        "winsorize_net": lambda s, d: quality.winsorize(_features(s, d), "net_spent"),
        "outlier_customers": lambda s, d: quality.outlier_customers(_features(s, d)),
        "table_preview": lambda s, d: quality.table_preview(
            _lines(s, d), ["order_id", "product_id", "line_id"]),
        "table_profile": lambda s, d: quality.table_profile(_lines(s, d)),
        "describe_numeric": lambda s, d: quality.describe_numeric(_lines(s, d), LINE_FEATURES),
        "boxplot_stats": lambda s, d: quality.boxplot_stats(_lines(s, d), LINE_FEATURES),
        "discount_spend_bins": lambda s, d: quality.discount_spend_bins(_lines(s, d)),
        "eda_report": _eda_report,
        "pair_bins": lambda s, d: quality.pair_bins(_features(s, d), numeric),
        "stratified_split": lambda s, d: sampling.stratified_split(
            _labelled_lines(s, d), "is_returned", "line_id"),
        "validation_split": lambda s, d: sampling.validation_split(
            _labelled_lines(s, d), "is_returned", "line_id", 0.25),
        "standard_scale": lambda s, d: sampling.standard_scale(
            _lines(s, d).select("line_id", *LINE_FEATURES), LINE_FEATURES)[0],
        "split_roundtrip": _split_roundtrip,
        "class_weights": lambda s, d: sampling.class_weights(
            _labelled_lines(s, d), "is_returned"),
        "smote_neighbors": lambda s, d: sampling.smote_neighbors(
            _lines(s, d).where("is_returned = 1"), LINE_FEATURES, "line_id", leaf_sites=250),
        "resampled_counts": lambda s, d: sampling.class_counts(_smote(s, d), "is_returned"),
        "score_threshold": lambda s, d: metrics.score_threshold(
            _closed_form_lines(s, d).withColumnRenamed("score", "probability"), 0.5,
            texts=("not returned", "returned")),
        "roc_auc": lambda s, d: metrics.roc_auc(_closed_form_lines(s, d)),
        "f1_score": lambda s, d: metrics.f1_score(_closed_form_lines(s, d)),
        "confusion_matrix": lambda s, d: metrics.confusion_matrix(_closed_form_lines(s, d)),
        "classification_report": lambda s, d: metrics.classification_report(
            _closed_form_lines(s, d)),
        "shapley_values": _attributions,
        "feature_importance": lambda s, d: explain.feature_importance(_attributions(s, d)),
    }

    def contract(key, make):
        return lambda spark, sf_dir: _columns(key, make(spark, sf_dir))

    result = {key: contract(key, make) for key, make in checked.items()}
    result |= {
        "model_roundtrip": _model_roundtrip,
        "smote": _smote,
        "pca_2d": _pca,
        "return_scores": lambda s, d: _return_model(s, d).scored_test,
        "return_metrics": lambda s, d: _return_model(s, d).metrics,
        "score_requests": _score_requests,
        "explain_risky": _explain_risky,
        "reorder_scores": _reorder_scores,
        "reorder_plain_scores": lambda s, d: _reorder_scores(s, d, "plain"),
        "reorder_metrics": lambda s, d: _reorder_model(s, d).metrics,
        "validation_curve": _validation_curve,
        "recommend_scores": lambda s, d: _recommender(s, d).top,
        "recommend_metrics": lambda s, d: _recommender(s, d).metrics,
    }
    if LLM:
        result |= llm_queries.QUERIES
    if PIPELINE:
        result["pipeline"] = corpus_pipeline.run
    return result


def oracle_sql() -> dict[str, str]:
    result = {key: oracles.oracle_text(key) for key in oracles.BODIES}
    if LLM:
        result |= llm_queries.ORACLES
    if PIPELINE and corpus_pipeline.ORACLE_SQL is not None:
        result["pipeline"] = corpus_pipeline.ORACLE_SQL
    return result
