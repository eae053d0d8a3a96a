"""Evaluation as aggregates: everything but the ranking metrics follows from the confusion counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom import scale

AVERAGES = ("micro", "macro", "weighted")
MEASURES = ("precision", "recall", "f1")
# The names a search may optimise.
METRICS = ("accuracy", "average_precision", "f1", "precision", "recall",
           "f1_micro", "f1_macro", "f1_weighted",
           "precision_micro", "precision_macro", "precision_weighted",
           "recall_micro", "recall_macro", "recall_weighted", "roc_auc")


def confusion(scored: DataFrame, truth: str = "Category", predicted: str = "prediction") -> DataFrame:
    """``(truth, predicted, n)``; the only pass over the scored rows."""
    return scored.groupBy(F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))


def confusion_table(counts: DataFrame, classes: list | None = None) -> DataFrame:
    """One row per true class, one column per predicted class."""
    return counts.groupBy("truth").pivot("predicted", classes).agg(F.sum("n")).fillna(0)


def accuracy(counts: DataFrame) -> DataFrame:
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    return counts.agg((F.sum(hit) / F.sum("n")).alias("accuracy"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def _measures(counts: DataFrame) -> DataFrame:
    precision = _ratio(F.col("tp"), F.col("claimed"))
    recall = _ratio(F.col("tp"), F.col("support"))
    return (counts.withColumn("precision", precision).withColumn("recall", recall)
            .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall"))))


def class_report(counts: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class; undefined ratios are 0."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    zero = F.lit(0).cast("bigint")
    sides = counts.select(F.inline(F.array(
        F.struct(F.col("truth").alias("class"), hit.cast("bigint").alias("tp"), zero.alias("claimed"),
                 F.col("n").alias("support")),
        F.struct(F.col("predicted").alias("class"), zero.alias("tp"), F.col("n").alias("claimed"),
                 zero.alias("support")))))
    per_class = sides.groupBy("class").agg(
        F.sum("tp").alias("tp"), F.sum("claimed").alias("claimed"), F.sum("support").alias("support"))
    return _measures(per_class).select("class", *MEASURES, "support", "tp", "claimed")


def averaged(report: DataFrame) -> DataFrame:
    """``(average, precision, recall, f1, support)`` for micro, macro and weighted."""
    pooled = _measures(report.agg(
        F.sum("tp").alias("tp"), F.sum("claimed").alias("claimed"), F.sum("support").alias("support")))
    micro = pooled.select(F.lit("micro").alias("average"), *MEASURES, "support")
    macro = report.agg(*[F.avg(m).alias(m) for m in MEASURES], F.sum("support").alias("support"))
    share = report.agg(*[(F.sum(F.col(m) * F.col("support")) / F.sum("support")).alias(m)
                         for m in MEASURES], F.sum("support").alias("support"))
    return (micro.unionByName(macro.withColumn("average", F.lit("macro")))
            .unionByName(share.withColumn("average", F.lit("weighted"))))


def evaluation_report(counts: DataFrame) -> DataFrame:
    """The report per class with the support-weighted average as last row."""
    report = class_report(counts)
    total = averaged(report).filter(F.col("average") == "weighted").select(
        F.lit("avg / total").alias("class"), *MEASURES, "support")
    return report.select(F.col("class").cast("string").alias("class"), *MEASURES,
                         "support").unionByName(total)


def _by_score(scored: DataFrame, truth: str, score: str, positive) -> DataFrame:
    """Positives and negatives per distinct score, so that ties share one row."""
    is_positive = F.col(truth) == F.lit(positive)
    return scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.count_if(is_positive).alias("pos"), F.count_if(~is_positive).alias("neg"))


def roc_auc(scored: DataFrame, truth: str, score: str, positive) -> DataFrame:
    """Share of (positive, negative) pairs in the right order, ties counting half."""
    steps = scale.running_totals(_by_score(scored, truth, score, positive), ["score"], ["neg"])
    ahead = F.col("pos") * (F.col("running_neg") - F.col("neg") / 2)
    return steps.agg((F.sum(ahead) / (F.sum("pos") * F.sum("neg"))).alias("roc_auc"))


def average_precision(scored: DataFrame, truth: str, score: str, positive) -> DataFrame:
    """Sum over distinct thresholds of the recall gained times the precision reached."""
    steps = scale.running_totals(_by_score(scored, truth, score, positive),
                                 [F.desc("score")], ["pos", "neg"])
    reached = F.col("pos") * F.col("running_pos") / (F.col("running_pos") + F.col("running_neg"))
    return steps.agg((F.sum(reached) / F.sum("pos")).alias("average_precision"))


def evaluate(scored: DataFrame, metric: str = "accuracy", truth: str = "Category",
             predicted: str = "prediction", score: str | None = None, positive=None) -> float:
    """One number for one of :data:`METRICS`. The binary ones need ``positive``."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric {metric!r}; one of {', '.join(METRICS)}")
    if metric in ("roc_auc", "average_precision"):
        if score is None or positive is None:
            raise ValueError(f"{metric} needs a score column and the positive class")
        measure = roc_auc if metric == "roc_auc" else average_precision
        value = measure(scored, truth, score, positive).first()[0]
        if value is None:
            raise ValueError(f"{metric} needs rows of the class {positive!r} and of others; the rows to score lack one")
        return float(value)
    counts = confusion(scored, truth, predicted)
    if metric == "accuracy":
        return float(accuracy(counts).first()[0])
    report = class_report(counts)
    if metric in MEASURES:
        if positive is None:
            raise ValueError(f"{metric} needs the positive class")
        row = report.filter(F.col("class") == F.lit(positive)).select(metric).first()
        return float(row[0]) if row else 0.0
    measure, average = metric.rsplit("_", 1)
    return float(averaged(report).filter(F.col("average") == average).first()[measure])


def prediction_summary(predicted: DataFrame, label: str = "Category") -> DataFrame:
    """Documents per predicted class."""
    return predicted.groupBy(label).agg(F.count(F.lit(1)).alias("documents"))


def fold_table(scores: DataFrame, folds: int) -> DataFrame:
    """One row per candidate: score per fold, mean, standard deviation, rank by mean.

    ``scores`` holds ``(candidate, fold, score)``, one row per evaluated fit.
    """
    stats = scores.groupBy("candidate").agg(
        F.avg("score").alias("mean_score"), F.stddev_pop("score").alias("std_score"),
        *[F.max(F.when(F.col("fold") == i, F.col("score"))).alias(f"fold_{i}")
          for i in range(folds)])
    # One row per candidate that was fitted, hence few enough to rank in one task.
    return (stats.withColumn("rank", F.rank().over(Window.orderBy(F.desc(F.round("mean_score", 12)))))
            .select("candidate", *[f"fold_{i}" for i in range(folds)], "mean_score", "std_score",
                    "rank"))


def best_candidate(table: DataFrame) -> DataFrame:
    """The first candidate among those with the highest mean score."""
    return table.orderBy(F.desc(F.round("mean_score", 12)), "candidate").limit(1)


def stage_metrics(spark, rows) -> DataFrame:
    """Row counts and durations: one ``(stage, rows, features, seconds)`` row per step."""
    return spark.createDataFrame(list(rows), "stage string, rows long, features long, seconds double")
