"""Exact relational classification metrics."""

from __future__ import annotations

import operator

from pyspark.sql import Column, DataFrame, functions as F

from stayline.functions.numeric import count_if, nan_to_null, ratio
from stayline.functions.ranking import cut_blocks, running_before
from stayline.session import staged


def _f1(precision: Column, recall: Column) -> Column:
    return ratio(2 * precision * recall, precision + recall)


def confusion_metrics(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """One row: the four cells, accuracy, precision, recall and F1; 0 where undefined."""
    y, p = F.col(label).cast("int"), F.col(prediction).cast("int")
    cells = df.agg(
        count_if((y == 0) & (p == 0)).alias("true_negatives"),
        count_if((y == 0) & (p == 1)).alias("false_positives"),
        count_if((y == 1) & (p == 0)).alias("false_negatives"),
        count_if((y == 1) & (p == 1)).alias("true_positives"),
    )
    tn, fp = F.col("true_negatives"), F.col("false_positives")
    fn, tp = F.col("false_negatives"), F.col("true_positives")
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return cells.select(
        "*",
        ratio(tp + tn, tn + fp + fn + tp).alias("accuracy"),
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1_score"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    """One row: positives, negatives and the exact area under the ROC curve.

    Equal scores count half. Rows are first folded to one per distinct score and
    written once, since three passes follow; negatives are then accumulated over
    ordered blocks of scores, so neither a hot score nor many distinct scores
    end up in one task. NULL without both classes.
    """
    clean = df.select(F.col(label).cast("int").alias("y"), nan_to_null(F.col(score).cast("double")).alias("s"))
    scores = (
        clean.where(F.col("y").isNotNull() & F.col("s").isNotNull())
        .groupBy("s")
        .agg(count_if(F.col("y") == 1).alias("pos"), count_if(F.col("y") == 0).alias("neg"))
    )
    ranked = running_before(cut_blocks(staged(scores, "scores"), "s"), "s", {"_below": ("neg", F.sum, operator.add)})
    wins = F.col("pos") * (F.coalesce(F.col("_below"), F.lit(0)) + F.col("neg") / 2)
    return ranked.agg(
        F.coalesce(F.sum("pos"), F.lit(0)).alias("positives"),
        F.coalesce(F.sum("neg"), F.lit(0)).alias("negatives"),
        F.sum(wins).alias("_wins"),
    ).select(
        "positives",
        "negatives",
        (F.col("_wins") / F.nullif(F.col("positives").cast("double") * F.col("negatives"), F.lit(0.0))).alias(
            "roc_auc"
        ),
    )


def classification_report(
    df: DataFrame, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """Per class precision, recall, F1 and support, then accuracy, macro and weighted rows.

    Every class that is either true or predicted gets a row. Accuracy is given
    in the f1_score column, as the usual report prints it.
    """
    pairs = df.groupBy(
        F.col(label).cast("string").alias("y"), F.col(prediction).cast("string").alias("p")
    ).agg(F.count(F.lit(1)).alias("n"))
    # At most classes squared rows from here on.
    sides = pairs.select(
        F.inline(
            F.array(
                F.struct(
                    F.col("y").alias("class"),
                    F.col("n").alias("support"),
                    F.lit(0).cast("bigint").alias("predicted"),
                    F.when(F.col("y") == F.col("p"), F.col("n")).otherwise(0).alias("hits"),
                ),
                F.struct(
                    F.col("p").alias("class"),
                    F.lit(0).cast("bigint").alias("support"),
                    F.col("n").alias("predicted"),
                    F.lit(0).cast("bigint").alias("hits"),
                ),
            )
        )
    )
    totals = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "hits")])
    precision = ratio(F.col("hits"), F.col("predicted"))
    recall = ratio(F.col("hits"), F.col("support"))
    classes = totals.select(
        "class",
        precision.alias("precision"),
        recall.alias("recall"),
        _f1(precision, recall).alias("f1_score"),
        "support",
        "hits",
    )
    names = ("precision", "recall", "f1_score")
    overall = classes.agg(
        F.sum("support").alias("support"),
        F.sum("hits").alias("hits"),
        *[F.avg(c).alias(f"macro_{c}") for c in names],
        *[(F.sum(F.col(c) * F.col("support")) / F.sum("support")).alias(f"weighted_{c}") for c in names],
    )
    none = F.lit(None).cast("double")
    averages = overall.select(
        F.inline(
            F.array(
                F.struct(
                    F.lit("accuracy").alias("class"),
                    none.alias("precision"),
                    none.alias("recall"),
                    ratio(F.col("hits"), F.col("support")).alias("f1_score"),
                    F.col("support").alias("support"),
                ),
                *[
                    F.struct(
                        F.lit(f"{kind} avg").alias("class"),
                        *[F.col(f"{kind}_{c}").alias(c) for c in names],
                        F.col("support").alias("support"),
                    )
                    for kind in ("macro", "weighted")
                ],
            )
        )
    )
    return classes.drop("hits").unionByName(averages)
