"""Training jobs, saved models, streams and sinks."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators import orders, quality, recommend, returns
from orderlens.plans import jobs, learners
from orderlens.sources import (base_schemas, jdbc_options, load_model, load_tables, read_split,
                               save_model, tables_from_star_schema)
from orderlens.streaming.scoring import read_requests, score_request_stream

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def tables(spark):
    return tables_from_star_schema(spark, SF_DIR)


@pytest.fixture(scope="module")
def trained(tables, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("splits"))
    cfg = jobs.ReturnConfig(0.08, 10_000, max_iter=30, splits_path=path)
    return jobs.train_returns(tables, cfg), path


def metric(df, name, cls="1"):
    return df.where((F.col("metric") == name) & (F.col("class") == cls)).first()["value"]


def test_return_model(spark, trained, tmp_path):
    model, path = trained
    assert metric(model.metrics, "roc_auc") > 0.95
    curve = model.curve.orderBy("iteration").collect()
    assert sum(r["best"] for r in curve) == 1 and curve[-1]["iteration"] <= 30
    assert all(r["hold_loss"] > 0 for r in curve)
    assert model.metrics.where("value is null").count() == 0
    assert read_split(spark, path, "test").count() == model.scored_test.count()
    plan = read_split(spark, path, "test")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull" in plan
    save_model(model.model, str(tmp_path / "model"))
    rows = model.scored_test.drop("probability", "prediction")
    again = learners.score(load_model(str(tmp_path / "model")), rows, 0.3)
    assert again.exceptAll(model.scored_test.select(*again.columns)).count() == 0


def test_return_explanations(trained):
    model, _ = trained
    small = jobs.Trained(model.model, model.metrics, model.scored_test.where("prediction = 1").limit(20),
                         model.train, model.columns)
    found = jobs.explain_returns(small, n_background=10)
    assert found["importance"].count() == 6 and found["risky"].count() == 30


def test_logistic_returns(tables):
    cfg = jobs.ReturnConfig(0.08, 10_000, max_iter=20, learner="logistic")
    assert metric(jobs.train_returns(tables, cfg).metrics, "roc_auc") > 0.9


@pytest.mark.parametrize("variant,before", [("plain", False), ("smote", True)])
def test_reorder_model(tables, tmp_path, variant, before):
    cfg = jobs.ReorderConfig(max_iter=15, variant=variant, smote_before_split=before)
    trained = jobs.train_reorder(tables, cfg)
    assert metric(trained.metrics, "roc_auc") > 0.55
    if before:
        return
    # Saved and reloaded, the model makes the quarter columns itself; a quarter it has not seen
    # gives the same as the first one, which has no column.
    save_model(trained.raw_model, str(tmp_path / "raw"))
    raw = load_model(str(tmp_path / "raw"))
    features = orders.order_features(tables, cfg.since, cfg.fanout)
    rows = orders.reorder_labels(features).join(
        quality.winsorize(features, "net_spent").select("order_id", "net_spent_winsorized"), "order_id")
    ids = F.col("order_id").cast("string").alias("order_id")
    scored = learners.probability_of(raw, rows, "again").select(ids, "again")
    both = trained.scored_test.join(scored, "order_id")
    assert both.count() == trained.scored_test.count() > 0
    assert both.where("abs(again - probability) > 1e-9").count() == 0
    first = orders.quarter_levels(rows)[0]
    old, none, base = (learners.probability_of(
        raw, rows.withColumn("year_quarter", F.lit(q).cast("string")), "p").select("order_id", "p")
        for q in ("1901Q1", None, first))
    assert old.exceptAll(base).count() == none.exceptAll(base).count() == 0


@pytest.mark.parametrize("stop", [False, True])
def test_recommender(spark, stop):
    small = tables_from_star_schema(spark, "/root/testdata/sf0.001")
    cfg = jobs.RecommendConfig(trees=3, depth=3, early_stop=stop)
    found = jobs.train_recommender(small, cfg)
    top, metrics = found.top, found.metrics
    assert top.groupBy("customer_id").count().agg(F.min("count"), F.max("count")).first()[:] == (5, 5)
    assert 0 <= metric(metrics, "precision@5") <= 1
    assert set(recommend.RECOMMEND_FEATURES) <= set(top.columns)


def test_recommender_writes_nothing_of_the_grids_size(spark, monkeypatch):
    """The fit is bounded, and scores stream from the grid to the ranking."""
    small = tables_from_star_schema(spark, "/root/testdata/sf0.001")
    n_grid = small["customers"].count() * small["products"].count()
    sizes, write = {}, jobs.materialize

    def counted(df, name):
        table = write(df, name)
        sizes[name] = table.count()
        return table

    monkeypatch.setattr(jobs, "materialize", counted)
    found = jobs.train_recommender(small, jobs.RecommendConfig(trees=3, depth=3, fit_pairs=4000))
    assert sizes["recommend-pairs"] < 4600
    assert max(sizes.values()) < n_grid / 4
    # All customers are ranked over all products: the same as scoring the whole grid at once.
    pairs = recommend.recommend_features(small)
    scored = learners.probability_of(found.model, pairs, "purchase_probability")
    want = recommend.top_k_per_customer(scored, 5).select("customer_id", "product_id", "rank")
    assert sorted(want.collect()) == sorted(
        found.top.select("customer_id", "product_id", "rank").collect())


def test_sample_of_pairs(spark):
    small = tables_from_star_schema(spark, "/root/testdata/sf0.001")
    known = recommend.summarize(small)
    grid = {(r[0], r[1]): r[2] for r in recommend.recommend_grid(small, known=known).where(
        "customer_orders is not null").select("customer_id", "product_id", "purchased").collect()}
    whole = recommend.sample_pairs(small, 10**9, known=known).collect()
    assert {(r[0], r[1]): r[2] for r in whole} == grid and len(whole) == len(grid)
    assert {r["weight"] for r in whole} == {1.0}
    few = recommend.sample_pairs(small, 3000, known=known).collect()
    assert all(grid[r[0], r[1]] == r[2] for r in few)
    assert len({(r[0], r[1]) for r in few}) == len(few)
    bought = sum(r["purchased"] for r in few)
    assert abs(bought - 1500) < 200 and abs(len(few) - 3000) < 300
    assert abs(sum(r["weight"] for r in few) - len(grid)) < 0.05 * len(grid)
    assert recommend.sample_pairs(small, 3000, known=known).exceptAll(
        spark.createDataFrame(few)).count() == 0


def test_streamed_ranking_is_the_ranking(spark):
    import random
    rng = random.Random(2)
    rows = [(f"c{rng.randint(0, 30)}", p, rng.randint(0, 1), rng.choice([0.1, 0.5, 0.5, rng.random()]))
            for p in range(4000)]
    scored = spark.createDataFrame(rows, "customer_id string, product_id int, purchased int, "
                                         "purchase_probability double").repartition(5)
    for only_new in (False, True):
        want = recommend.top_k_per_customer(scored, 3, exclude_purchased=only_new)
        got = recommend.top_of_stream(scored, 3, exclude_purchased=only_new)
        assert sorted(got.select(*want.columns).collect()) == sorted(want.collect())
    assert recommend.top_of_stream(scored.limit(0)).collect() == []


def network_rows(spark, n, noise):
    """Two classes, apart from each other by their first feature; ``noise`` flips labels."""
    import random
    rng = random.Random(n)
    rows = []
    for k in range(n):
        y = int(rng.random() < 0.5)
        rows.append((f"r{k}", y if rng.random() >= noise else 1 - y,
                     2.0 * y - 1 + rng.gauss(0, 0.3), rng.gauss(0, 1)))
    return spark.createDataFrame(rows, "k string, y int, a_scaled double, b_scaled double")


def test_network_stops_when_held_out_loss_does(spark):
    """Noisy labels: more iterations only learn the noise. The best step is what is returned."""
    train, held = network_rows(spark, 300, 0.25), network_rows(spark, 301, 0.25)
    network = learners.perceptron(2, (24, 12), "y", 200)
    model, curve = learners.fitted_with_patience([], ["a", "b"], network, train, held, "y",
                                                 step=10, patience=2, min_delta=0.0)
    iterations = [r[0] for r in curve.rows]
    assert iterations == list(range(10, 10 * len(iterations) + 1, 10)) and iterations[-1] < 200
    losses = [r[2] for r in curve.rows]
    best = [i for i, r in enumerate(curve.rows) if r[3]]
    assert len(best) == 1 and losses[best[0]] == min(losses)
    assert len(losses) - 1 - best[0] == 2 and losses[-1] > losses[best[0]]
    again = learners.log_loss(learners.probability_of(model, held), "y")
    assert abs(again - losses[best[0]]) < 1e-9
    fit = [r[1] for r in curve.rows]
    assert all(a >= b - 1e-9 for a, b in zip(fit, fit[1:]))     # steps go on from the last weights


def test_network_steps_read_a_work_table(spark, monkeypatch):
    """Rows are joined and spread before the first step, so no step shuffles them again."""
    plans, real = [], learners.MultilayerPerceptronClassifier.fit

    def fit(self, df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return real(self, df, *more)

    monkeypatch.setattr(learners.MultilayerPerceptronClassifier, "fit", fit)
    train, held = network_rows(spark, 60, 0.1).coalesce(1), network_rows(spark, 40, 0.1)
    learners.fitted_with_patience([], ["a", "b"], learners.perceptron(2, (3,), "y", 6), train, held,
                                  "y", step=3)
    assert plans and all("Scan parquet" in p and "Exchange" not in p for p in plans)


def test_network_without_held_rows(spark):
    train = network_rows(spark, 200, 0.0)
    network = learners.perceptron(2, (4,), "y", 12)
    _, curve = learners.fitted_with_patience([], ["a", "b"], network, train, train.limit(0), "y")
    assert [r[0] for r in curve.rows][-1] <= 12 and all(r[2] is None for r in curve.rows)
    assert curve.rows[-1][3]
    assert curve.table(spark).columns == ["iteration", "fit_loss", "hold_loss", "best"]


def test_request_stream(spark, trained, tmp_path):
    model, _ = trained
    requests = model.scored_test.select(*returns.RETURN_FEATURES).limit(40).collect()
    (tmp_path / "in").mkdir()

    def send(name, part):
        (tmp_path / "in" / name).write_text("\n".join(
            json.dumps({k: float(v) for k, v in r.asDict().items()}) for r in part))

    def run():
        score_request_stream(model.model, read_requests(spark, str(tmp_path / "in")),
                             str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
        return spark.read.parquet(str(tmp_path / "out"))

    send("a.json", requests[:25])
    assert run().count() == 25
    send("b.json", requests[25:])
    out = run()
    assert out.count() == 40 and {r[0] for r in out.select("prediction_text").collect()} <= {
        "returned", "not returned"}


def test_load_tables_from_parquet(spark, tables, tmp_path):
    for name, df in tables.items():
        df.write.parquet(str(tmp_path / f"{name}.parquet"))
    loaded = load_tables(spark, str(tmp_path), T.LongType())
    assert {n: d.schema for n, d in loaded.items()} == base_schemas(T.LongType())
    assert loaded["order_details"].count() == 60_000


def test_jdbc_options():
    options = jdbc_options("jdbc:postgresql://db/shop", "orders", "order_id", (1, 1000), 20)
    assert options["numPartitions"] == "20" and options["lowerBound"] == "1"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:postgresql://db/shop", "orders", "order_id")
