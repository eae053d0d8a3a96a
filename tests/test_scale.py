"""Skew-proof building blocks give the same result as the plain operation."""

import random

import pytest
from pyspark.sql import functions as F

from labelloom import scale


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows share one key; some keys are missing."""
    dice = random.Random(1)
    rows = [(i, 0 if i % 3 == 0 else (None if i % 50 == 1 else dice.randrange(500)))
            for i in range(3000)]
    left = spark.createDataFrame(rows, "i int, k int")
    right = spark.createDataFrame([(k, f"v{k}{j}") for k in range(0, 400) for j in range(1 + k % 2)],
                                  "k int, v string")
    return left, right


@pytest.fixture(autouse=True)
def small_groups_count(monkeypatch):
    monkeypatch.setattr(scale, "HOT_ROWS", 1)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join(skewed, how):
    left, right = skewed
    plain = left.join(right, ["k"], how)
    salted = scale.skew_join(left, right, ["k"], how)
    assert sorted(map(str, salted.select(plain.columns).collect())) == sorted(
        map(str, plain.collect()))


def test_skew_join_spreads_the_hot_key(skewed):
    left, right = skewed
    hot = {r[0] for r in scale.hot_keys(left, ["k"], 100).collect()}
    assert 0 in hot and len(hot) <= 100


def test_attach_without_broadcast(skewed):
    left, right = skewed
    assert not scale.fits(right, 10) and not scale.fits(right, max_bytes=100) and scale.fits(right)
    a = scale.attach(left, right, ["k"], "left", max_rows=10)
    assert a.count() == left.join(right, ["k"], "left").count()


def test_running_totals(spark):
    values = random.Random(2).sample(range(10000), 700)
    df = spark.createDataFrame([(v, v % 7) for v in values], "v int, x int")
    got = {r["v"]: r["running_x"] for r in scale.running_totals(df, [F.desc("v")], ["x"], 5).collect()}
    total = 0
    for v in sorted(values, reverse=True):
        total += v % 7
        assert got[v] == total


def test_order_cutoffs_with_a_hot_value(spark):
    rows = [("a", 5 if i % 3 == 0 else i) for i in range(300)] + [("b", i) for i in range(10)]
    df = spark.createDataFrame(rows, "g string, v int")
    cut = scale.order_cutoffs(df, "g", ["v"], F.floor(F.col("v") / 16).cast("int"),
                              lambda n: F.array(F.floor(n / 4), F.floor(n / 2)))
    got = {(r["g"], r["rank_no"]): r["cut"]["v"] for r in cut.collect()}
    for g in "ab":
        ordered = sorted(v for h, v in rows if h == g)
        for i, part in enumerate((4, 2)):
            assert got[g, i] == ordered[len(ordered) // part - 1]


def test_pin_and_stage(spark):
    df = spark.range(20).withColumn("s", F.struct("id", F.lit("x").alias("y")))
    for pinned in (scale.pin(df), scale.pin(df, 5), scale.stage(df)):
        assert pinned.schema.simpleString() == df.schema.simpleString()
        assert sorted(map(str, pinned.collect())) == sorted(map(str, df.collect()))


class Settings:
    """Stands in for a session; the real setting is fixed when a session starts."""

    def __init__(self, **values):
        self.conf = {k.replace("_", "."): v for k, v in values.items()}


def test_shared_folder_is_the_configured_one():
    assert scale.shared_folder(Settings(spark_checkpoint_dir="s3a://b/x/")) == "s3a://b/x"


def test_a_cluster_needs_a_shared_folder():
    with pytest.raises(ValueError):
        scale.shared_folder(Settings(spark_master="yarn"))
