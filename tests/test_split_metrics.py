"""Splits and metrics."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom.operators import metrics as M
from labelloom.operators import split as SP


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i * 7, "a" if i % 3 else "b") for i in range(500)] + [(9999, None), (8888, "single")]
    return spark.createDataFrame(rows, "Id long, Category string")


@pytest.mark.parametrize("fraction", [0.0, 0.25, 0.5, 1.0])
def test_holdout(docs, fraction):
    rows = SP.holdout(docs, fraction).collect()
    assert len(rows) == 502
    total = Counter(r["Category"] for r in rows)
    test = Counter(r["Category"] for r in rows if r["is_test"])
    for category, n in total.items():
        want = 0 if category is None else math.floor(n * fraction + 0.5)
        assert test[category] == want


def test_holdout_refuses_other_fractions(docs):
    with pytest.raises(ValueError):
        SP.holdout(docs, 1.5)


@pytest.mark.parametrize("k", [2, 7])
def test_folds(docs, k):
    rows = SP.folds(docs, k, buckets=16).collect()
    for category in ("a", "b"):
        ids = sorted(r["Id"] for r in rows if r["Category"] == category)
        fold = {r["Id"]: r["fold"] for r in rows if r["Category"] == category}
        size, odd = divmod(len(ids), k)
        want = [f for f in range(k) for _ in range(size + (f < odd))]
        assert [fold[i] for i in ids] == want
    assert {r["Category"]: r["fold"] for r in rows}[None] is None
    assert {r["Category"]: r["fold"] for r in rows}["single"] == 0


@pytest.fixture(scope="module")
def scored(spark):
    dice = random.Random(5)
    rows = [(i, dice.choice("xyz"), dice.choice("xyw"), float(dice.randrange(8))) for i in range(400)]
    return spark.createDataFrame(rows, "Id long, Category string, prediction string, score double")


def test_reports(scored):
    rows = scored.collect()
    counts = M.confusion(scored)
    report = {r["class"]: r for r in M.class_report(counts).collect()}
    for c in "xyzw":
        tp = sum(r["Category"] == c == r["prediction"] for r in rows)
        claimed = sum(r["prediction"] == c for r in rows)
        support = sum(r["Category"] == c for r in rows)
        p = tp / claimed if claimed else 0.0
        q = tp / support if support else 0.0
        f = 2 * p * q / (p + q) if p + q else 0.0
        assert (report[c]["precision"], report[c]["recall"], report[c]["support"]) == (p, q, support)
        assert abs(report[c]["f1"] - f) < 1e-12
    accuracy = sum(r["Category"] == r["prediction"] for r in rows) / len(rows)
    assert abs(M.evaluate(scored, "accuracy") - accuracy) < 1e-12
    for name in ("f1_micro", "precision_micro", "recall_micro"):
        assert abs(M.evaluate(scored, name) - accuracy) < 1e-12
    assert abs(M.evaluate(scored, "f1_macro") - sum(r["f1"] for r in report.values()) / 4) < 1e-12
    assert M.evaluate(scored, "recall", positive="x") == report["x"]["recall"]
    assert M.evaluation_report(counts).count() == 5
    table = {r["truth"]: r for r in M.confusion_table(counts).collect()}
    assert sum(table["x"][c] for c in "xyw") == report["x"]["support"]


def test_ranking_metrics(scored):
    rows = [(r["score"], r["Category"] == "x") for r in scored.collect()]
    pos = [s for s, y in rows if y]
    neg = [s for s, y in rows if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    assert abs(M.evaluate(scored, "roc_auc", score="score", positive="x") - auc) < 1e-12
    ap, before = 0.0, 0
    for t in sorted({s for s, _ in rows}, reverse=True):
        hit = sum(y for s, y in rows if s >= t)
        ap += (hit - before) / len(pos) * hit / sum(s >= t for s, _ in rows)
        before = hit
    assert abs(M.evaluate(scored, "average_precision", score="score", positive="x") - ap) < 1e-12


def test_metric_arguments(scored):
    with pytest.raises(ValueError):
        M.evaluate(scored, "samples")
    with pytest.raises(ValueError):
        M.evaluate(scored, "f1")
    with pytest.raises(ValueError):
        M.evaluate(scored, "roc_auc")


def test_summary_and_stage_metrics(spark, scored):
    assert sum(r["documents"] for r in M.prediction_summary(scored, "prediction").collect()) == 400
    assert M.stage_metrics(spark, [("fit", 3, 4, 0.5)]).first()["rows"] == 3
