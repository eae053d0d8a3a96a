"""Scoring terms against the class and keeping the best."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.operators import features as FT
from labelloom.operators.blocks import Scaled

TERM = ["branch", "term"]
# For joins: a sort compares the first bytes of its first key, and those of a branch tell nothing.
BY_TERM = ["term", "branch"]
# Beyond this many, a top-k is cut at its exact border rank instead of being merged in one task.
MERGED_TOP_K = 5_000
# Up to this many classes a term's sums per class stand side by side in one row.
SIDE_BY_SIDE = 32


def class_sizes(docs: DataFrame, label: str = "Category") -> DataFrame:
    """Documents per class, as a table with one row per class."""
    return scale.pin(docs.groupBy(label).agg(F.count(F.lit(1)).alias("n_class")))


def with_term_idf(per_term: DataFrame, idf: DataFrame) -> DataFrame:
    """Rows that are aggregated by term already, at most one per class, with the term's idf."""
    slim = idf.select(*TERM, "idf")
    return per_term.join(F.broadcast(slim) if scale.fits(slim) else slim, BY_TERM)


def _own_idf(sums: DataFrame, n: Column) -> DataFrame:
    """The idf of terms that were counted (``_df``) in the aggregate that summed their ``u``."""
    return sums.filter(F.col("u").isNotNull()).withColumn("idf", F.log((1 + n) / (1 + F.col("_df"))) + 1)


def chi2_scores(scaled: DataFrame | Scaled, idf: DataFrame | None, docs: DataFrame, label: str = "Category") -> DataFrame:
    """Chi-squared of each term's weight per class against the class shares.

    ``idf`` None: the weights' idf is that of these pairs and ``docs`` themselves; then document frequencies are
    counted in the aggregate that sums the weights, and no table is joined.

    A class's sum of weights is the term's idf times its sum of ``u``, so pairs are summed before they
    meet the idf table. With observed ``o``, expected ``e = share * total`` and both summing to ``total``,
    the sum of ``(o - e)^2 / e`` over all classes is ``sum(o^2 / share) / total - total``: classes in which
    the term never occurs drop out, so zero cells never become rows.
    """
    n = docs.agg(F.count(F.lit(1))).scalar()
    sizes = class_sizes(docs, label)
    classes = [r for r in sizes.take(SIDE_BY_SIDE + 2) if r[label] is not None]
    if isinstance(scaled, Scaled):
        if len(classes) <= SIDE_BY_SIDE and (idf is None or idf is scaled.blocks.idf):
            sums = scaled.class_sums(label, [r[label] for r in classes])
            return _side_by_side(_own_idf(sums.withColumnRenamed("df", "_df"), n), n, classes)
        scaled = scaled.rows()
    if len(classes) <= SIDE_BY_SIDE:
        return _chi2_side_by_side(scaled, idf, n, classes, label)
    if idf is None:
        per_term = scaled.groupBy(*TERM).agg(F.count(F.lit(1)).alias("_df"), F.sum("u").alias("u"))
        idf = scale.stage(_own_idf(per_term, n).select(*TERM, "idf"), "idf")
    per_class = scaled.groupBy(*TERM, label).agg(F.sum("u").alias("u")).filter(F.col("u").isNotNull())
    sums = with_term_idf(per_class, idf)
    observed = sums.select(*TERM, label, (F.col("u") * F.col("idf")).alias("o"))
    cells = (scale.attach(observed, sizes, [label])
             .withColumn("share", F.col("n_class") / n))
    return cells.groupBy(*TERM).agg(
        (F.sum(F.col("o") * F.col("o") / F.col("share")) / F.sum("o") - F.sum("o")).alias("score"))


def _chi2_side_by_side(scaled: DataFrame, idf: DataFrame | None, n: Column, classes: Sequence, label: str) -> DataFrame:
    """One row per term from one aggregate, which the idf table meets without a further shuffle of it."""
    own = [F.sum(F.when(F.col(label) == F.lit(r[label]), F.col("u"))).alias(f"_u{i}")
           for i, r in enumerate(classes)]
    sums = scaled.groupBy(*BY_TERM).agg(F.count(F.lit(1)).alias("_df"), F.sum("u").alias("u"), *own)
    sums = _own_idf(sums, n) if idf is None else with_term_idf(sums.filter(F.col("u").isNotNull()), idf)
    return _side_by_side(sums, n, classes)


def _side_by_side(sums: DataFrame, n: Column, classes: Sequence) -> DataFrame:
    """The scores of terms whose sums of ``u``, in all and per class, and idf stand in one row."""
    seen = [F.col(f"_u{i}") * F.col("idf") for i in range(len(classes))]
    squares = sum((F.coalesce(o * o / (F.lit(r["n_class"]) / n), F.lit(0.0))
                   for o, r in zip(seen, classes)), F.lit(0.0))
    total = F.col("u") * F.col("idf")
    # A term of unlabelled documents alone has no score.
    labelled = F.coalesce(F.lit(None).cast("double"), *[F.col(f"_u{i}") for i in range(len(classes))]).isNotNull()
    return sums.select(*TERM, F.when(labelled, squares / total - total).alias("score"))


def mutual_information(scaled: DataFrame | Scaled, idf: DataFrame, docs: DataFrame, label: str = "Category",
                       digits: int = 12) -> DataFrame:
    """Mutual information of each term's (discrete) weight and the class.

    Documents without the term form one more value. Its cells follow from the class sizes, and
    the classes the term never meets share one closed expression.
    """
    n = docs.agg(F.count(F.lit(1))).scalar()
    value = F.round(F.col("u") * F.col("idf"), digits).alias("x")
    if isinstance(scaled, Scaled) and idf is scaled.blocks.idf:
        # The pairs know their idf; dealt by term once, no aggregate below moves them again.
        pairs = scaled.rows().filter(F.col("u").isNotNull()).select(*TERM, label, value).repartition(*BY_TERM)
        cells = pairs.groupBy(*TERM, label, "x").agg(F.count(F.lit(1)).alias("cell"))
    else:
        scaled = scaled.rows() if isinstance(scaled, Scaled) else scaled
        equal = FT.with_idf(scaled.filter(F.col("u").isNotNull()).groupBy(*TERM, label, "u")
                            .agg(F.count(F.lit(1)).alias("cell")), idf.select(*TERM, "df", "idf")).drop("df")
        cells = equal.groupBy(*TERM, label, value).agg(F.sum("cell").alias("cell"))
    cells = scale.attach(cells, class_sizes(docs, label), [label])
    by_value = cells.groupBy(*TERM, "x").agg(
        F.sum("cell").alias("n_x"),
        F.sum(F.col("cell") * F.log(F.col("cell") / F.col("n_class"))).alias("part"))
    present = by_value.groupBy(*TERM).agg(
        F.sum(F.col("part") + F.col("n_x") * F.log(n / F.col("n_x"))).alias("present"),
        F.sum("n_x").alias("df"))
    by_class = cells.groupBy(*TERM, label).agg(
        F.sum("cell").alias("seen"), F.max("n_class").alias("n_class"))
    zero = F.col("n_class") - F.col("seen")
    absent = by_class.groupBy(*TERM).agg(
        F.sum(F.when(zero > 0, zero * F.log(zero / F.col("n_class"))).otherwise(0.0)).alias("part"))
    rest = n - F.col("df")
    return present.join(absent, BY_TERM).select(
        *TERM, ((F.col("present") + F.col("part")
                 + F.when(rest > 0, rest * F.log(n / rest)).otherwise(0.0)) / n).alias("score"))


def best_first() -> list:
    """Ranking order: higher score first, ties to the later column."""
    return [F.round("score", 9).desc(), F.desc("branch"), F.desc("term")]


def select_k_best(scores: DataFrame, k: int) -> DataFrame:
    """The ``k`` best terms. A tie at the border keeps the later column."""
    if k <= MERGED_TOP_K:
        return scores.orderBy(*best_first()).limit(k)
    return rank_terms(scores).filter(F.col("rank") <= k).drop("rank")


def rank_terms(scores: DataFrame) -> DataFrame:
    """All terms with their exact overall rank, without sorting them in one task."""
    return scale.row_numbers(scores, best_first())


def sweep_k(scores: DataFrame, sizes: Sequence[int],
            evaluate: Callable[[DataFrame], float]) -> DataFrame:
    """``(k, score)`` for each size: the terms are ranked once and filtered per size."""
    ranked = scale.stage(rank_terms(scores), "ranked")
    rows = [(int(k), float(evaluate(ranked.filter(F.col("rank") <= k)))) for k in sizes]
    return scores.sparkSession.createDataFrame(rows, "k int, score double")
