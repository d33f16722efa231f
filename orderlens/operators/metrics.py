"""Evaluation of scored rows (label 0/1, score, prediction 0/1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.measures import flag


def score_threshold(df: DataFrame, threshold: float, score: str = "probability",
                    texts: tuple[str, str] | None = None) -> DataFrame:
    """``df`` + prediction: 1 where the score lies strictly above the threshold; with
    ``texts`` also prediction_text (for 0, for 1)."""
    above = F.col(score) > F.lit(threshold)
    df = df.withColumn("prediction", flag(above))
    if texts is None:
        return df
    return df.withColumn("prediction_text", F.when(above, texts[1]).otherwise(texts[0]))


#: Hex digits of a score's fraction that each level of ``roc_auc`` looks at: a group has at most
#: 16 to the power of the difference of neighbours, 65,536, members at the next level.
FRACTION_DIGITS = (0, 3, 6, 9, 13)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """Exact area under the ROC curve, ties counted half: metric, value.

    Lazy, and without a sort of all scores. Scores are counted per value, then per prefix of their
    binary form: sign and exponent, and more and more of the fraction. Every prefix covers a range
    of scores, and two different scores part at exactly one level, so the pairs that a positive
    wins are the sum, over the levels, of its prefix's positives times the negatives of lower
    prefixes with the same parent. Windows see the prefixes of one parent only, which the format
    of a double bounds. Rows with a NULL label or score take no part; a NaN ranks above all
    numbers; one class alone has no value (NULL).
    """
    value = F.col(score).cast("double") + F.lit(0.0)   # -0.0 is 0.0
    labelled = df.select(F.col(label).cast("int").alias("_label"), value.alias("_score")).where(
        "_label is not null and _score is not null")
    counted = labelled.groupBy("_score").agg(
        F.count_if(F.col("_label") == 1).alias("_pos"), F.count_if(F.col("_label") != 1).alias("_neg"))
    # Each score is written out once, as in -0x1.8p-3, and taken apart once; the prefixes, which
    # name both parts several times, are columns of a plan step above.
    written = counted.withColumn("_text", F.format_string("%a", "_score"))
    written = written.withColumns({
        "_head": F.regexp_replace("_text", r"\.[0-9a-f]*", ""),
        "_fraction": F.rpad(F.regexp_extract("_text", r"\.([0-9a-f]*)", 1),
                            FRACTION_DIGITS[-1], "0")})
    shorter = [F.lit(""), *[F.concat_ws(".", "_head", F.substring("_fraction", 1, n))
                            for n in FRACTION_DIGITS]]
    levels = written.select("_score", "_pos", "_neg", F.inline(F.array(*[
        F.struct(F.lit(i).alias("_level"), parent.alias("_parent"), prefix.alias("_prefix"))
        for i, (parent, prefix) in enumerate(zip(shorter, shorter[1:]))])))
    grouped = levels.groupBy("_level", "_parent", "_prefix").agg(
        F.min("_score").alias("_from"), F.sum("_pos").alias("_pos"), F.sum("_neg").alias("_neg"))
    lower = Window.partitionBy("_level", "_parent").orderBy("_from").rowsBetween(
        Window.unboundedPreceding, -1)
    wide = "decimal(19,0)"                             # products of counts are exact
    below = F.coalesce(F.sum("_neg").over(lower), F.lit(0)).cast(wide)
    last = F.col("_level") == len(FRACTION_DIGITS) - 1
    ranked = grouped.select("_pos", "_neg", last.alias("_last"), below.alias("_below"))
    pos, neg = (F.sum(F.when(F.col("_last"), F.col(c))).cast("double") for c in ("_pos", "_neg"))
    won = F.sum(F.col("_pos").cast(wide) * F.col("_below")).cast("double")
    tied = F.sum(F.when(F.col("_last"), F.col("_pos").cast(wide) * F.col("_neg").cast(wide)))
    return ranked.agg(F.try_divide(won + tied.cast("double") / 2, pos * neg).alias("value")).select(
        F.lit("roc_auc").alias("metric"), "value")


def _rows_where(condition: Column, weight: str | None) -> Column:
    """How many rows a condition holds for; with ``weight``, how many they stand for."""
    if weight is None:
        return F.count_if(condition)
    return F.round(F.sum(F.when(condition, F.col(weight)).otherwise(0.0))).cast("long")


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction",
                     weight: str | None = None) -> DataFrame:
    """Rows per label and prediction, with 0 for a combination that does not occur."""
    cells = [(actual, said) for actual in (0, 1) for said in (0, 1)]
    counts = df.agg(*[_rows_where((F.col(label) == a) & (F.col(prediction) == p), weight)
                      .alias(f"n{a}{p}") for a, p in cells])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("label"), F.lit(p).alias("prediction"), F.col(f"n{a}{p}").alias("n"))
        for a, p in cells])))


def _confusion_counts(df: DataFrame, label: str, prediction: str,
                      weight: str | None = None) -> DataFrame:
    actual, said = F.col(label), F.col(prediction)
    return df.agg(_rows_where((actual == 1) & (said == 1), weight).alias("tp"),
                  _rows_where((actual == 0) & (said == 1), weight).alias("fp"),
                  _rows_where((actual == 1) & (said == 0), weight).alias("fn"),
                  _rows_where((actual == 0) & (said == 0), weight).alias("tn"))


def _or_zero(numerator: Column, denominator: Column) -> Column:
    return F.coalesce(F.try_divide(numerator.cast("double"), denominator.cast("double")),
                      F.lit(0.0))


def f1_score(df: DataFrame, label: str = "label", prediction: str = "prediction",
             weight: str | None = None) -> DataFrame:
    """F1 of class 1, 0 where it is undefined."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return _confusion_counts(df, label, prediction, weight).select(
        F.lit("f1").alias("metric"), _or_zero(2 * tp, 2 * tp + fp + fn).alias("value"))


def classification_report(df: DataFrame, label: str = "label", prediction: str = "prediction",
                          weight: str | None = None) -> DataFrame:
    """Precision, recall, F1 and support per class, and accuracy (in f1), macro and weighted
    averages; undefined ratios are 0."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    parts = {"0": (tn, fn, fp), "1": (tp, fp, fn)}   # hits, false alarms, misses
    columns = {}
    for name, (hits, alarms, misses) in parts.items():
        columns[f"p{name}"] = _or_zero(hits, hits + alarms)
        columns[f"r{name}"] = _or_zero(hits, hits + misses)
        columns[f"f{name}"] = _or_zero(2 * hits, 2 * hits + alarms + misses)
        columns[f"s{name}"] = hits + misses
    one_row = _confusion_counts(df, label, prediction, weight).withColumns(columns).withColumn(
        "total", F.col("s0") + F.col("s1"))

    def row(name: str, precision: Column, recall: Column, f1: Column, support: Column) -> Column:
        return F.struct(F.lit(name).alias("class"), precision.alias("precision"),
                        recall.alias("recall"), f1.alias("f1"), support.alias("support"))

    def macro(measure: str) -> Column:
        return (F.col(f"{measure}0") + F.col(f"{measure}1")) / 2

    def weighted(measure: str) -> Column:
        return _or_zero(F.col(f"{measure}0") * F.col("s0") + F.col(f"{measure}1") * F.col("s1"),
                        F.col("total"))

    absent = F.lit(None).cast("double")
    total = F.col("total")
    return one_row.select(F.inline(F.array(
        *[row(c, *[F.col(f"{m}{c}") for m in "prfs"]) for c in parts],
        row("accuracy", absent, absent, _or_zero(tp + tn, total), total),
        row("macro avg", *[macro(m) for m in "prf"], total),
        row("weighted avg", *[weighted(m) for m in "prf"], total))))


def binary_metrics(scored: DataFrame, label: str, score: str = "probability",
                   weight: str | None = None) -> DataFrame:
    """metric, class, value rows of a scored test set: AUC, F1, the report, the confusion
    counts. With ``weight`` each row counts as the rows it stands for (one weight per class, on
    which the AUC does not depend)."""
    rows = [roc_auc(scored, label, score), f1_score(scored, label, weight=weight)]
    singles = rows[0].unionByName(rows[1]).select("metric", F.lit("1").alias("class"), "value")
    report = classification_report(scored, label, weight=weight)
    per_class = report.select(F.col("class"), F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value"))
        for m in ("precision", "recall", "f1", "support")])))
    confusion = confusion_matrix(scored, label, weight=weight).select(
        F.lit("confusion").alias("metric"),
        F.concat_ws("->", "label", "prediction").alias("class"), F.col("n").cast("double").alias("value"))
    return singles.unionByName(per_class.where("value is not null and not (metric = 'f1' and class = '1')")
                               .select("metric", "class", "value")).unionByName(confusion)
