"""Exact classification metrics, curves and forecast errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from casefile.functions.values import col
from casefile.operators.ranking import running_totals
from casefile.session import broadcast_if_small


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((col(label) == col(prediction)).cast("double")).alias("accuracy"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """(label, prediction, count) with zero cells. The classes are those seen as label
    or prediction; pairing them concerns only that short list."""
    counts = df.groupBy(col(label).alias("label"), col(prediction).alias("prediction")).count()
    counts, _ = broadcast_if_small(counts)
    classes = counts.select(F.explode(F.array_distinct(F.array("label", "prediction"))).alias("c")).distinct()
    every = classes.agg(F.collect_list("c").alias("all"))
    cells = every.select(F.explode("all").alias("label"), "all").select("label", F.explode("all").alias("prediction"))
    filled = cells.join(counts, ["label", "prediction"], "left")
    return filled.withColumn("count", F.coalesce("count", F.lit(0).cast("long")))


def macro_f1(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Unweighted mean of the per-class F1 over the classes seen on either side."""
    hit = (col(label) == col(prediction)).cast("long")
    sides = F.array(
        F.struct(col(label).alias("c"), hit.alias("hit"), F.lit(1).alias("n")),
        F.struct(col(prediction).alias("c"), F.lit(0).cast("long").alias("hit"), F.lit(1).alias("n")),
    )
    per_class = df.select(F.inline(sides)).groupBy("c").agg((2.0 * F.sum("hit") / F.sum("n")).alias("f1"))
    return per_class.agg(F.avg("f1").alias("macro_f1"))


def score_table(
    df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int | None = None
) -> DataFrame:
    """One row per distinct score, highest first in rank: pos, neg, running cum_pos and
    cum_neg (this score included), and the counts of the next lower score."""
    by_score = df.groupBy(col(score).cast("double").alias("score")).agg(
        F.count_if(col(label) == 1).alias("pos"), F.count_if(col(label) != 1).alias("neg")
    )
    return running_totals(by_score, "score", ["pos", "neg"], descending=True, leads=["pos", "neg"], rows_per_bucket=rows_per_bucket)


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int | None = None) -> DataFrame:
    """Area under the ROC curve, ties counted half."""
    return ranking_metrics(score_table(df, label, score, rows_per_bucket)).select("roc_auc")


def average_precision(df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int | None = None) -> DataFrame:
    """Sum of recall steps times precision."""
    return ranking_metrics(score_table(df, label, score, rows_per_bucket)).select("avg_precision")


def ranking_metrics(table: DataFrame) -> DataFrame:
    """ROC AUC and average precision from a `score_table`, in one aggregate."""
    won = F.col("neg").cast("double") * (F.col("cum_pos") - F.col("pos") / 2)
    pairs = F.sum("pos").cast("double") * F.sum("neg")
    precision = F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))
    return table.agg(
        F.try_divide(F.sum(won), pairs).alias("roc_auc"),
        F.try_divide(F.sum(F.col("pos") * precision), F.sum("pos")).alias("avg_precision"),
    )


def _class_totals(table: DataFrame) -> tuple[int, int]:
    pos, neg = table.agg(F.sum("pos"), F.sum("neg")).first()
    return pos or 0, neg or 0


def roc_points(df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int | None = None) -> DataFrame:
    """(fpr, tpr, threshold), points on a straight line between neighbours left out,
    starting at the origin with an infinite threshold."""
    return roc_curve(score_table(df, label, score, rows_per_bucket))


def pr_points(df: DataFrame, label: str = "label", score: str = "score", rows_per_bucket: int | None = None) -> DataFrame:
    """(precision, recall, threshold) for every distinct score, ending at precision 1
    and recall 0 without threshold."""
    return pr_curve(score_table(df, label, score, rows_per_bucket))


def roc_curve(table: DataFrame) -> DataFrame:
    """ROC points from a `score_table`."""
    pos, neg = _class_totals(table)
    first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    bend = F.col("next_pos").isNull() | (F.col("next_pos") != F.col("pos")) | (F.col("next_neg") != F.col("neg"))
    points = table.filter(first | bend).select(
        F.try_divide(F.col("cum_neg").cast("double"), F.lit(neg)).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.lit(pos)).alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = table.sparkSession.createDataFrame([(0.0, 0.0, float("inf"))], "fpr double, tpr double, threshold double")
    return origin.unionByName(points)


def pr_curve(table: DataFrame) -> DataFrame:
    """Precision and recall from a `score_table`."""
    pos, _ = _class_totals(table)
    points = table.select(
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.coalesce(F.try_divide(F.col("cum_pos").cast("double"), F.lit(pos)), F.lit(1.0)).alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = table.sparkSession.createDataFrame([(1.0, 0.0, None)], "precision double, recall double, threshold double")
    return points.unionByName(end)


def forecast_errors(
    df: DataFrame, by: Sequence[str], actual: str = "y", predicted: str = "yhat"
) -> DataFrame:
    """MAE, RMSE and MAPE% per group; the MAPE denominator is 1 where the actual is 0."""
    error = col(actual) - col(predicted)
    relative = F.abs(error / F.when(col(actual) == 0, 1.0).otherwise(col(actual)))
    return df.groupBy(*[col(b) for b in by]).agg(
        F.avg(F.abs(error)).alias("MAE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        (F.avg(relative) * 100).alias("MAPE%"),
    )


def average_errors(metrics: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Mean error per model over splits, lowest RMSE first."""
    return (
        metrics.groupBy(*[col(b) for b in by])
        .agg(*[F.avg(col(m)).alias(m) for m in ("MAE", "RMSE", "MAPE%")])
        .orderBy("RMSE", *by)
    )


def comparison_table(results: DataFrame) -> DataFrame:
    """Model, score and seconds of the models that trained, best first."""
    return (
        results.na.drop(subset=["cv_score"])
        .select("model", "cv_score", "duration_seconds")
        .orderBy(F.desc("cv_score"), "model")
    )
