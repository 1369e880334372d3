"""Evaluation of any (y, pred) table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobsift import lexicons


def label_order(spark, labels: list[str] | None = None) -> DataFrame:
    """(label_idx, label) in the fixed order."""
    names = lexicons.AREA_LABELS if labels is None else labels
    return spark.createDataFrame(list(enumerate(names)), "label_idx int, label string")


def pair_counts(predictions: DataFrame) -> DataFrame:
    """(y, pred, n): every metric below is computed from this small table."""
    return predictions.groupBy("y", "pred").agg(F.count(F.lit(1)).alias("n"))


def accuracy(predictions: DataFrame) -> DataFrame:
    return predictions.agg(
        F.avg((F.col("y") == F.col("pred")).cast("double")).alias("accuracy")
    )


def class_report(predictions: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, macro and weighted means.

    Classes are all labels seen in either column; undefined ratios are 0.
    """
    sides = pair_counts(predictions).select(
        F.explode(
            F.array(
                F.struct(
                    F.col("y").alias("label"),
                    F.when(F.col("y") == F.col("pred"), F.col("n")).otherwise(0).alias("tp"),
                    F.col("n").alias("true_n"),
                    F.lit(0).cast("long").alias("pred_n"),
                ),
                F.struct(
                    F.col("pred").alias("label"),
                    F.lit(0).cast("long").alias("tp"),
                    F.lit(0).cast("long").alias("true_n"),
                    F.col("n").alias("pred_n"),
                ),
            )
        ).alias("s")
    ).select("s.*")
    sums = sides.groupBy("label").agg(
        F.sum("tp").alias("tp"), F.sum("true_n").alias("support"), F.sum("pred_n").alias("pred_n")
    )
    zero = F.lit(0.0)
    ratios = sums.select(
        "label",
        F.coalesce(F.try_divide(F.col("tp"), F.col("pred_n")), zero).alias("precision"),
        F.coalesce(F.try_divide(F.col("tp"), F.col("support")), zero).alias("recall"),
        F.coalesce(
            F.try_divide(F.col("tp") * 2.0, F.col("pred_n") + F.col("support")), zero
        ).alias("f1"),
        "support",
    )
    # each class row also feeds the two means, so the counts are scanned once
    copies = F.array(
        F.struct(F.lit("class").alias("kind"), F.col("label").alias("name")),
        F.struct(F.lit("macro").alias("kind"), F.lit("macro avg").alias("name")),
        F.struct(F.lit("weighted").alias("kind"), F.lit("weighted avg").alias("name")),
    )

    def mean(c: str):
        by_support = F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support"))
        return (
            F.when(F.col("kind") == "weighted", F.coalesce(by_support, zero))
            .otherwise(F.avg(c))
            .alias(c)
        )

    return (
        ratios.withColumn("copy", F.explode(copies))
        .select(F.col("copy.kind"), F.col("copy.name"), "precision", "recall", "f1", "support")
        .groupBy("kind", "name")
        .agg(
            *[mean(c) for c in ["precision", "recall", "f1"]],
            F.sum("support").alias("support"),
        )
        .select(F.col("name").alias("label"), "precision", "recall", "f1", "support")
    )


def confusion_matrix(predictions: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """(true_idx, true_label, pred_idx, pred_label, n) for every pair of fixed labels."""
    names = lexicons.AREA_LABELS if labels is None else labels
    spark = predictions.sparkSession
    grid = spark.createDataFrame(
        [(i, a, j, b) for i, a in enumerate(names) for j, b in enumerate(names)],
        "true_idx int, true_label string, pred_idx int, pred_label string",
    )
    seen = pair_counts(predictions).select(
        F.col("y").alias("true_label"), F.col("pred").alias("pred_label"), "n"
    )
    return grid.join(seen, ["true_label", "pred_label"], "left").select(
        "true_idx", "true_label", "pred_idx", "pred_label",
        F.coalesce("n", F.lit(0)).cast("long").alias("n"),
    )


def confusion_grid(matrix: DataFrame, labels: list[str] | None = None) -> DataFrame:
    """Square form: one row per true label, one column per predicted label."""
    names = lexicons.AREA_LABELS if labels is None else labels
    return (
        matrix.groupBy("true_idx", "true_label")
        .pivot("pred_label", names)
        .agg(F.sum("n"))
        .orderBy("true_idx")
    )
