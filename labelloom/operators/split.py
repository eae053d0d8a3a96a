"""Stratified hold-out and folds, reproducible from the document id alone."""

from __future__ import annotations

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale

# Fixed value: the seed of the hold-out.
SPLIT_SEED = 123456


def order_hash(key: str, seed: int):
    """A pseudo-random but reproducible order of the documents."""
    return F.md5(F.concat_ws("-", F.col(key).cast("string"), F.lit(str(seed))))


def holdout(docs: DataFrame, fraction: float = 0.25, seed: int = SPLIT_SEED,
            label: str = "Category", key: str = "Id") -> DataFrame:
    """Add ``is_test``: in each class the given share, rounded, of documents by hash order.

    Finds the border hash per class and compares each row with it, so rows are never moved.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("the test fraction must lie between 0 and 1")
    keys = docs.select(label, key).filter(F.col(label).isNotNull()).withColumn(
        "_h", order_hash(key, seed))
    cut = scale.order_cutoffs(
        keys, label, ["_h", key], F.conv(F.substring("_h", 1, 3), 16, 10).cast("int"),
        lambda n: F.array(F.floor(n * fraction + 0.5)))
    cut = scale.pin(cut.select(label, "cut"))
    marked = scale.attach(docs.withColumn("_h", order_hash(key, seed)), cut, [label])
    inside = F.struct(F.col("_h"), F.col(key)) <= F.col("cut")
    return (marked.withColumn("is_test", F.coalesce(inside, F.lit(False)))
            .select(*docs.columns, "is_test"))


def folds(docs: DataFrame, k: int, label: str = "Category", key: str = "Id",
          buckets: int = 256) -> DataFrame:
    """Add ``fold`` (0 to ``k - 1``): equal runs of each class in id order.

    Earlier folds get the odd documents. Only the border ids of each class are looked up.
    """
    if k < 2:
        raise ValueError("at least two folds are needed")
    keys = docs.select(label, key).filter(F.col(label).isNotNull())
    probabilities = [i / buckets for i in range(1, buckets)]
    borders = sorted(set(keys.select(F.col(key).cast("double").alias(key))
                         .approxQuantile(key, probabilities, 0.5 / buckets)))
    placed = Bucketizer(splits=[float("-inf"), *borders, float("inf")], inputCol="_d",
                        outputCol="_q").transform(keys.withColumn("_d", F.col(key).cast("double")))
    ends = F.sequence(F.lit(1), F.lit(k - 1))
    cut = scale.order_cutoffs(
        placed.select(label, key, "_q"), label, [key], F.col("_q"),
        lambda n: F.transform(ends, lambda i: F.floor(n / k) * i + F.least(i, n % k)))
    cut = scale.pin(cut.groupBy(label).agg(F.collect_list(F.col(f"cut.{key}")).alias("_ends")))
    marked = scale.attach(docs, cut, [label])
    before = F.size(F.filter(F.col("_ends"), lambda e: e < F.col(key)))
    found = F.when(F.col(label).isNotNull(), F.when(F.col("_ends").isNull(), F.lit(0))
                   .otherwise(before))
    return marked.withColumn("fold", found.cast("int")).select(*docs.columns, "fold")
