"""Evaluation metrics as aggregations.

Everything starts from the (true, predicted) count table, which has at most
k^2 rows for k classes, so the per-class arithmetic runs on a tiny table
after one distributed aggregation. ``zero_division=0`` semantics: an empty
denominator gives 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .joins import attach_row


def _div0(a, b):
    return F.coalesce(a / F.nullif(b, F.lit(0)), F.lit(0.0))


def pair_counts(df: DataFrame, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    return df.groupBy(F.col(y).alias("t"), F.col(yhat).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def per_class(df: DataFrame, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """label, tp, fp, fn, support, precision, recall, f1 for every label seen
    in either column."""
    pc = pair_counts(df, y, yhat)
    as_true = pc.groupBy(F.col("t").alias("label")).agg(
        F.sum("n").alias("support"), F.sum(F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0)).alias("tp")
    )
    as_pred = pc.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    j = as_true.join(as_pred, "label", "full").na.fill(0, ["support", "tp", "predicted"])
    j = j.withColumns({"fp": F.col("predicted") - F.col("tp"), "fn": F.col("support") - F.col("tp")})
    return j.select(
        "label", "tp", "fp", "fn", "support",
        _div0(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _div0(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
        _div0(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")).alias("f1"),
    )


def classification_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """One row with accuracy and macro / weighted precision, recall, F1."""
    pcl = per_class(df, y, yhat)
    n = F.sum("support")
    return pcl.agg(
        (F.sum("tp") / n).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        _div0(F.sum(F.col("precision") * F.col("support")), n).alias("precision_weighted"),
        _div0(F.sum(F.col("recall") * F.col("support")), n).alias("recall_weighted"),
        _div0(F.sum(F.col("f1") * F.col("support")), n).alias("f1_weighted"),
    )


def regression_metrics(df: DataFrame, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """MAE, RMSE, R^2 in one pass (R^2 via n * var_pop(y))."""
    e = F.col(yhat) - F.col(y)
    return df.agg(
        F.avg(F.abs(e)).alias("mae"),
        F.sqrt(F.avg(e * e)).alias("rmse"),
        (F.lit(1.0) - F.sum(e * e) / F.nullif(F.count(F.col(y)) * F.var_pop(F.col(y)), F.lit(0.0))).alias("r2"),
    )


def class_report(df: DataFrame, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """Per-class rows plus 'accuracy', 'macro avg', 'weighted avg'."""
    pcl = per_class(df, y, yhat)
    rows = pcl.select(F.col("label").cast("string").alias("clase"), "precision", "recall", F.col("f1").alias("f1_score"),
                      F.col("support").cast("double").alias("support"))
    m = classification_metrics(df, y, yhat)
    tot = pcl.agg(F.sum("support").cast("double").alias("_n"))
    m = attach_row(m, tot)
    summary = m.select(F.explode(F.array(
        F.struct(F.lit("accuracy").alias("clase"), F.col("accuracy").alias("precision"), F.col("accuracy").alias("recall"),
                 F.col("accuracy").alias("f1_score"), F.col("_n").alias("support")),
        F.struct(F.lit("macro avg").alias("clase"), F.col("precision_macro").alias("precision"), F.col("recall_macro").alias("recall"),
                 F.col("f1_macro").alias("f1_score"), F.col("_n").alias("support")),
        F.struct(F.lit("weighted avg").alias("clase"), F.col("precision_weighted").alias("precision"),
                 F.col("recall_weighted").alias("recall"), F.col("f1_weighted").alias("f1_score"), F.col("_n").alias("support")),
    )).alias("_r")).select("_r.*")
    return rows.unionByName(summary)


def confusion_matrix(df: DataFrame, labels: Sequence, y: str = "y_true", yhat: str = "y_pred") -> DataFrame:
    """Rows Real_<label>, columns Pred_<label>, zeros kept, in ``labels`` order."""
    pc = pair_counts(df, y, yhat)
    spark = df.sparkSession
    lab = spark.createDataFrame([(i, v) for i, v in enumerate(labels)], "pos int, t " + _ddl(labels))
    wide = pc.where(F.col("p").isin(list(labels))).groupBy("t").pivot("p", list(labels)).agg(F.sum("n"))
    for v in labels:
        wide = wide.withColumnRenamed(str(v), f"Pred_{v}")
    out = lab.join(wide, "t", "left").na.fill(0, [f"Pred_{v}" for v in labels])
    return out.select(F.concat(F.lit("Real_"), F.col("t").cast("string")).alias("real"), "pos",
                      *[F.col(f"Pred_{v}").cast("long") for v in labels])


def _ddl(labels: Sequence) -> str:
    if all(isinstance(v, bool) for v in labels):
        return "boolean"
    if all(isinstance(v, int) for v in labels):
        return "int"
    return "string"
