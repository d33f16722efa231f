"""Properties of sampling, quantiles, neighbours, attributions and metrics."""

import datetime as dt
import itertools
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from orderlens.functions.measures import parse_date, safe_ratio, within_days
from orderlens.functions.quantiles import quantile_table
from orderlens.operators import explain, metrics, neighbors, orders, quality, recommend, sampling
from orderlens.plans import learners


def frame(spark, **cols):
    return spark.createDataFrame(pd.DataFrame(cols))


@pytest.mark.parametrize("n", [1, 2, 5, 6, 7, 20, 101, 30_000])
@pytest.mark.parametrize("accuracy", [50, 10_000])
def test_quantiles_equal_pandas(spark, n, accuracy):
    rng = np.random.default_rng(n)
    data = {"smooth": rng.normal(size=n), "few": rng.integers(0, 4, n).astype(float),
            "skewed": np.where(rng.random(n) < 0.4, 7.0, rng.exponential(1e6, n))}
    probs, names = [0.0, 0.05, 0.25, 0.5, 0.75, 0.95, 1.0], list("abcdefg")
    got = {r["column"]: [r[c] for c in names] for r in
           quantile_table(frame(spark, **data), list(data), probs, names, accuracy).collect()}
    for col, values in data.items():
        assert got[col] == list(pd.Series(values).quantile(probs))


@pytest.mark.parametrize("n", [1, 7, 20, 40, 101])
def test_winsorize(spark, n):
    values = np.random.default_rng(n).permutation(n).astype(float)
    got = sorted(r["v_winsorized"] for r in quality.winsorize(frame(spark, v=values), "v").collect())
    k = int(0.05 * n)
    want = np.sort(values)
    want[:k], want[n - k:] = want[k], want[n - k - 1]
    assert got == list(want)


def test_winsorize_keeps_nulls(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "v double")
    got = [r["v_winsorized"] for r in quality.winsorize(df, "v").collect()]
    assert got.count(None) == 1 and len(got) == 3


def test_next_order_with_same_day_orders(spark):
    rng = np.random.default_rng(3)
    n = 400
    days = [dt.date(2020, 1, 31) + dt.timedelta(days=int(x)) for x in rng.integers(0, 40, n)]
    data = pd.DataFrame({"customer_id": rng.choice(["a", "b", "c"], n, p=[.8, .1, .1]),
                         "order_id": np.arange(n), "order_date": days})
    want = data.sort_values(["customer_id", "order_date", "order_id"])
    want = want.assign(nxt=want.groupby("customer_id")["order_date"].shift(-1))
    got = orders.next_order_dates(spark.createDataFrame(
        data, "customer_id string, order_id long, order_date date")).collect()
    assert {r["order_id"]: r["next_order_date"] for r in got} == {
        o: (None if pd.isna(d) else d) for o, d in zip(want["order_id"], want["nxt"])}


def test_month_ends_and_missing_dates(spark):
    row = spark.sql("select date'2021-08-31' d, cast(null as date) n").select(
        F.add_months("d", 6).alias("six"), within_days(F.col("n"), F.col("d"), 180).alias("none"))
    assert row.first()["six"] == dt.date(2022, 2, 28) and row.first()["none"] is False


def test_parse_dates(spark):
    df = spark.createDataFrame([("1997-05-06",), ("soon",), (None,)], "t string")
    assert [r[0] for r in df.select(parse_date("t")).collect()] == [dt.date(1997, 5, 6), None, None]
    with pytest.raises(Exception, match="CANNOT_PARSE|CAST_INVALID|cannot be"):
        df.select(parse_date("t", strict=True)).collect()


def test_safe_ratio(spark):
    df = spark.createDataFrame([(1.005, 1.0), (1.0, 0.0), (-0.125, 1.0), (2.0, 3.0)], "a double, b double")
    assert [r[0] for r in df.select(safe_ratio(F.col("a"), F.col("b"), 2)).collect()] == [
        1.01, None, -0.13, 0.67]


def labelled(spark, n, share, seed=0):
    rng = np.random.default_rng(seed)
    return frame(spark, key=[f"k{i}" for i in range(n)],
                 label=(rng.random(n) < share).astype(int), x=rng.normal(size=n),
                 y=rng.normal(size=n))


def test_split_is_complete_and_exact_per_class(spark):
    df = labelled(spark, 3001, 0.07)
    split = sampling.stratified_split(df, "label", "key").cache()
    assert split.select("key").distinct().count() == split.count() == 3001
    for row in split.groupBy("label").agg(
            F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert row["t"] == int(0.2 * row["n"] + 0.5)
    again = sampling.stratified_split(df.repartition(5), "label", "key")
    assert again.exceptAll(split).count() == 0


def test_split_keeps_copies_of_a_key_together(spark):
    """Copies have one draw; the side that reaches the wanted number takes all of them."""
    df = spark.range(40).selectExpr("id % 4 as key", "id % 2 as label")
    sides = sampling.stratified_split(df, "label", "key", test=0.3).groupBy("key").agg(
        F.count_distinct("split").alias("sides"), F.count_if(F.col("split") == "test").alias("n"))
    assert {(r["sides"], r["n"]) for r in sides.collect()} == {(1, 0), (1, 10)}
    assert sides.where("n > 0").count() == 2


def test_cut_equals_the_nth_draw(spark):
    drawn = labelled(spark, 5000, 0.3).withColumn("_draw", F.md5("key")).select("label", "_draw")
    order = drawn.toPandas().sort_values("_draw").groupby("label")["_draw"].apply(list)
    for n in (1, 2, 77, 900):
        cuts = sampling._draw_cuts(drawn, "label", lambda rows: F.lit(n)).collect()
        assert {r["label"]: r["_cut"] for r in cuts} == {c: order[c][n - 1] for c in order.index}


def test_split_without_test_rows(spark):
    split = sampling.stratified_split(labelled(spark, 50, 0.5), "label", "key", test=0.0)
    assert {r["split"] for r in split.collect()} == {"train"}


def test_scaling(spark):
    df = labelled(spark, 500, 0.5).withColumn("flat", F.lit(3.0))
    scaled, params = sampling.standard_scale(df, ["x", "y", "flat"])
    row = scaled.agg(F.avg("x"), F.stddev_pop("x"), F.max("flat")).first()
    assert row[0] == pytest.approx(0, abs=1e-12) and row[1] == pytest.approx(1) and row[2] == 0
    assert {r["column"] for r in params.collect()} == {"x", "y", "flat"}


def brute_neighbours(x, keys, k):
    found = {}
    for i, key in enumerate(keys):
        square = sum((x[:, d] - x[i, d]) ** 2 for d in range(x.shape[1]))
        order = sorted((j for j in range(len(keys)) if j != i), key=lambda j: (square[j], keys[j]))
        found[key] = [keys[j] for j in order[:k]]
    return found


@pytest.mark.parametrize("cells", [1, 3, 256])
@pytest.mark.parametrize("kind", ["smooth", "ties", "copies"])
def test_neighbours_equal_brute_force(spark, monkeypatch, kind, cells):
    """Small leaves and groups, so that the search crosses cells and leaves and splits hot ones."""
    monkeypatch.setattr(neighbors, "LEAF_SITES", 40)
    monkeypatch.setattr(neighbors, "CELLS", cells)
    monkeypatch.setattr(neighbors, "SAMPLES_PER_LEAF", 8)
    monkeypatch.setattr(neighbors, "QUERIES_PER_GROUP", 50)
    rng = np.random.default_rng(5)
    n = 500
    x = rng.normal(size=(n, 3))
    if kind == "ties":
        x = rng.integers(0, 6, (n, 3)).astype(float)
    if kind == "copies":   # a third of all rows is the same point
        x[: n // 3] = 0.5
    keys = [f"k{i:04d}" for i in rng.permutation(n)]
    df = frame(spark, key=keys, a=x[:, 0], b=x[:, 1], c=x[:, 2])
    got = {}
    for r in sampling.smote_neighbors(df, ["a", "b", "c"], "key").orderBy("key", "rank").collect():
        got.setdefault(r["key"], []).append(r["neighbour_key"])
    assert got == brute_neighbours(x, keys, 5)


def test_sites_of_one_cell_get_many_leaves(spark, monkeypatch):
    """The leaves that tasks cut aren't limited by the cells the driver cuts."""
    monkeypatch.setattr(neighbors, "CELLS", 2)
    x = np.random.default_rng(6).normal(size=(4_000, 2))
    df = frame(spark, key=[f"k{i}" for i in range(len(x))], a=x[:, 0], b=x[:, 1])
    placed = neighbors._placed(neighbors._sites(df, ["a", "b"], "key", 5), 2, 50)
    sizes = [r["count"] for r in placed.groupBy("leaf").count().collect()]
    assert placed.select("cell").distinct().count() == 2
    assert sum(sizes) == len(x) and len(sizes) > 40 and max(sizes) < 400


@pytest.mark.parametrize("n", [0, 1, 2])
def test_neighbours_of_few_rows(spark, n):
    df = frame(spark, key=["a", "b"], x=[1.0, 2.0]).limit(n)
    got = {r["key"]: [o["key"] for o in r["neighbours"]] for r in
           neighbors.neighbour_lists(df, ["x"], "key").collect()}
    assert got == [{}, {"a": []}, {"a": ["b"], "b": ["a"]}][n]


def test_smote_rows(spark):
    df = labelled(spark, 800, 0.06)
    out = sampling.smote(df, ["x", "y"], "label", "key", ratio=0.5).cache()
    sizes = {r["label"]: r["n"] for r in sampling.class_counts(df, "label").collect()}
    new = out.where("is_synthetic = 1")
    assert new.count() == int(0.5 * sizes[0] - sizes[1])
    assert out.where("is_synthetic = 0").count() == 800
    assert out.select("key").distinct().count() == out.count()
    points = {r["key"]: (r["x"], r["y"]) for r in df.where("label = 1").collect()}
    near = {}
    for r in sampling.smote_neighbors(df.where("label = 1"), ["x", "y"], "key").collect():
        near.setdefault(r["key"], []).append(points[r["neighbour_key"]])
    for r in new.collect():
        (x0, y0), made = points[r["key"].split("#")[0]], (r["x"], r["y"])
        assert any(abs((made[0] - x0) * (y1 - y0) - (made[1] - y0) * (x1 - x0)) < 1e-9
                   and min(x0, x1) - 1e-12 <= made[0] <= max(x0, x1) + 1e-12
                   for x1, y1 in near[r["key"].split("#")[0]])


def test_smote_edges(spark):
    balanced = labelled(spark, 60, 0.5)
    assert sampling.smote(balanced, ["x", "y"], "label", "key", 0.5).where("is_synthetic = 1").count() == 0
    few = frame(spark, key=list("abcdefgh"), label=[1, 1, 0, 0, 0, 0, 0, 0],
                x=np.arange(8.0), y=np.zeros(8))
    assert sampling.smote(few, ["x", "y"], "label", "key").where("label = 1").count() == 6
    with pytest.raises(ValueError):
        sampling.smote(few.where("label = 0"), ["x", "y"], "label", "key")


def scored(spark, score, label):
    return metrics.score_threshold(frame(spark, score=score, label=label), 0.5, "score")


def test_auc_with_ties_and_monotone_transforms(spark):
    score, label = [0.1, 0.4, 0.4, 0.4, 0.8, 0.8, 0.9, 0.2], [0, 0, 1, 0, 1, 0, 1, 1]
    pos = [s for s, y in zip(score, label) if y]
    neg = [s for s, y in zip(score, label) if not y]
    want = np.mean([(p > q) + 0.5 * (p == q) for p in pos for q in neg])
    df = scored(spark, score, label)
    assert metrics.roc_auc(df).first()["value"] == pytest.approx(want)
    stretched = df.withColumn("score", F.exp(3 * F.col("score")))
    assert metrics.roc_auc(stretched).first()["value"] == pytest.approx(want)


def test_auc_of_scores_of_all_sizes(spark):
    rng = np.random.default_rng(8)
    score = np.concatenate([
        rng.normal(size=400), rng.normal(size=400) * 10.0 ** rng.integers(-320, 300, 400),
        0.5 + rng.integers(0, 40, 400) * 2.0 ** -52, [0.0, -0.0, 5e-324, -5e-324, np.inf, -np.inf] * 9])
    label = rng.integers(0, 2, len(score))
    pos, neg = score[label == 1][:, None], score[label == 0][None]
    want = ((pos > neg) + 0.5 * (pos == neg)).mean()
    df = frame(spark, score=score, label=label)
    assert metrics.roc_auc(df).first()["value"] == pytest.approx(want, abs=1e-15)
    extra = spark.createDataFrame([(None, 1), (0.5, None), (None, None)], "score double, label long")
    assert metrics.roc_auc(df.unionByName(extra)).first()["value"] == pytest.approx(want, abs=1e-15)
    nan = spark.createDataFrame([(float("nan"), 1), (float("inf"), 0)], "score double, label long")
    assert metrics.roc_auc(nan).first()["value"] == 1
    for single in (df.where("label = 1"), df.limit(0)):
        assert [tuple(r) for r in metrics.roc_auc(single).collect()] == [("roc_auc", None)]


def test_report_with_a_class_never_predicted(spark):
    df = scored(spark, [0.1, 0.2, 0.3, 0.4], [0, 0, 1, 1])
    report = {r["class"]: r for r in metrics.classification_report(df).collect()}
    assert report["1"]["precision"] == report["1"]["f1"] == 0
    assert report["0"]["recall"] == 1 and report["accuracy"]["f1"] == 0.5
    assert metrics.f1_score(df).first()["value"] == 0
    assert metrics.confusion_matrix(df).count() == 4


def test_threshold_is_strict(spark):
    assert [r["prediction"] for r in scored(spark, [0.5, 0.5000001], [0, 1]).collect()] == [0, 1]


def test_shapley_values_add_up(spark):
    df = labelled(spark, 12, 0.5)
    cols = ["x", "y"]
    background = explain.background_sample(df, cols, "key", n=7)

    def product(d):
        return d.withColumn("score", F.col("x") * F.col("y") + F.col("x"))

    values = explain.shapley_values(product, df, cols, background, "key")
    mean = product(background).agg(F.avg("score")).first()[0]
    total = {r["key"]: r["v"] for r in values.groupBy("key").agg(F.sum("value").alias("v")).collect()}
    for r in product(df).collect():
        assert total[r["key"]] == pytest.approx(r["score"] - mean)
    with pytest.raises(ValueError):
        explain.shapley_values(product, df, ["x"] * 11, background, "key")


def test_shapley_values_by_definition(spark):
    """Rows that repeat, a background that repeats, and a NULL, against all coalitions."""
    rows = [("a", 1.0, 2.0, 0.0), ("b", 1.0, 2.0, 0.0), ("c", -1.0, None, 3.0), ("d", 0.5, 4.0, 3.0)]
    ground = [(0.0, 1.0, 1.0), (0.0, 1.0, 1.0), (2.0, 1.0, 5.0), (3.0, 0.0, 1.0)]
    cols = ["x", "y", "z"]

    def score(x, y, z):
        return x * (0 if y is None else y) + max(x, z) - 2 * z

    def score_fn(df):
        x, y, z = (F.col(c) for c in cols)
        return df.withColumn("score", x * F.coalesce(y, F.lit(0.0)) + F.greatest(x, z) - 2 * z)

    df = spark.createDataFrame(rows, "key string, x double, y double, z double")
    background = spark.createDataFrame(ground, "x double, y double, z double")
    got = {(r["key"], r["feature"]): r["value"] for r in explain.shapley_values(
        score_fn, df, cols, background, "key").collect()}

    def kept(row, subset):
        return np.mean([score(*[row[i] if i in subset else b[i] for i in range(3)]) for b in ground])

    for name, *row in rows:
        for i, col in enumerate(cols):
            want = np.mean([kept(row, set(p[:p.index(i)]) | {i}) - kept(row, set(p[:p.index(i)]))
                            for p in itertools.permutations(range(3))])
            assert got[name, col] == pytest.approx(want)
    assert len(got) == 12


def test_pca_matches_numpy(spark):
    df = labelled(spark, 200, 0.5).withColumn("z", 2 * F.col("x") - F.col("y") + 5)
    data = df.select("key", "x", "y", "z").toPandas().set_index("key")
    centred = data - data.mean()
    vectors = np.linalg.svd(centred.to_numpy(), full_matrices=False)[2]
    want = np.abs(centred.to_numpy() @ vectors[:2].T)
    got = learners.pca_2d(df, ["x", "y", "z"], "key").toPandas().set_index("key").loc[data.index]
    assert np.allclose(np.abs(got.to_numpy()), want, atol=1e-8)


def test_top_k_breaks_ties_by_product(spark):
    df = frame(spark, customer_id=["a"] * 4, product_id=[4, 2, 3, 1],
               purchased=[0] * 4, purchase_probability=[0.5, 0.5, 0.9, 0.5])
    got = recommend.top_k_per_customer(df, 3).orderBy("rank").collect()
    assert [r["product_id"] for r in got] == [3, 1, 2]


@pytest.mark.parametrize("accuracy", [20, 10_000])
def test_quantiles_of_ties_nans_and_extremes(spark, accuracy):
    """Heavy ties, few distinct values, infinities, signed zeros, NaN last, empty columns."""
    rng = np.random.default_rng(3)
    data = {"tie": [7.0] * 4000 + list(range(1000)), "two": [0.0, 1.0] * 2500,
            "far": [*(10.0 ** rng.uniform(-300, 300, 4997)), math.inf, -math.inf, 0.0],
            "holes": [None if k % 3 else float(k) for k in range(5000)], "none": [None] * 5000}
    rows = spark.createDataFrame(list(zip(*[[None if v is None else float(v) for v in c]
                                            for c in data.values()])),
                                 ", ".join(f"{c} double" for c in data)).repartition(4)
    probs = [0.0, 0.05, 0.25, 0.5, 0.77, 1.0]
    names = [f"q{i}" for i in range(len(probs))]
    got = {r["column"]: [r[n] for n in names]
           for r in quantile_table(rows, list(data), probs, names, accuracy).collect()}
    assert set(got) == {"tie", "two", "far", "holes"}
    for col in ("tie", "two", "holes"):
        assert got[col] == list(pd.Series(data[col], dtype=float).quantile(probs))
    values = sorted(data["far"])
    assert got["far"][0] == -math.inf and got["far"][-1] == math.inf
    assert values[int(0.25 * 4999)] <= got["far"][2] <= values[int(0.25 * 4999) + 1]


def test_quantiles_use_no_window(spark, monkeypatch):
    """Every pass is an aggregate to one row: nothing is sorted, ranked or shuffled by value."""
    from orderlens.functions import quantiles
    plans, run = [], quantiles._aggregates

    def seen(df, wanted):
        plans.append(df.agg(*[c.alias(f"a{i}") for i, c in enumerate(wanted)])
                     ._jdf.queryExecution().executedPlan().toString())
        return run(df, wanted)

    monkeypatch.setattr(quantiles, "_aggregates", seen)
    df = spark.range(20_000).selectExpr("cast(id * 7919 % 20000 as double) as x")
    row = quantile_table(df, ["x"], [0.1, 0.9], ["a", "b"], 100).first()
    assert (row["a"], row["b"]) == tuple(pd.Series(range(20_000)).quantile([0.1, 0.9]))
    assert len(plans) > 3
    assert not any(word in plan for plan in plans for word in ("Window", "Sort ", "hashpartitioning"))


def test_next_order_keeps_rows_without_keys(spark):
    """An order without a date or a customer stays, and is nobody's next."""
    day = dt.date(2020, 1, 1)
    rows = [(1, 7, day), (2, 7, None), (3, None, day), (4, 7, day + dt.timedelta(3)), (5, None, None)]
    got = orders.next_order_dates(spark.createDataFrame(
        rows, "order_id long, customer_id long, order_date date")).collect()
    assert {r["order_id"]: r["next_order_date"] for r in got} == {
        1: day + dt.timedelta(3), 2: None, 3: None, 4: None, 5: None}
