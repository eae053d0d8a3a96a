"""Tree ensembles on Spark ML, and the ensembles Spark ML has no class for."""

from __future__ import annotations

import json
import math
from collections.abc import Callable, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.ml import PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import Binarizer, ElementwiseProduct, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom import scale

# Seed, impurity threshold and feature share of every ensemble.
CLASSIFIER_SEED = 162534
MIN_GAIN = 1e-5
FEATURES_PER_SPLIT = "log2"
# Spark ML grows trees to this depth at most.
DEEPEST = 30


def effective_depth(max_depth: int | None) -> int:
    """The depth that is fitted: no limit means the deepest that there is; more is refused."""
    depth = DEEPEST if max_depth is None else int(max_depth)
    if not 0 <= depth <= DEEPEST:
        raise ValueError(f"max_depth must lie between 0 and {DEEPEST}, not {depth}")
    return depth


def _trees(n_estimators: int, max_depth: int | None, min_samples_leaf: int, seed: int,
           **more) -> RandomForestClassifier:
    return RandomForestClassifier(
        numTrees=int(n_estimators), maxDepth=effective_depth(max_depth), minInstancesPerNode=int(min_samples_leaf),
        featureSubsetStrategy=FEATURES_PER_SPLIT, minInfoGain=MIN_GAIN, seed=seed,
        labelCol="label", featuresCol="features", **more)


def random_forest(n_estimators: int = 200, max_depth: int | None = 10, min_samples_leaf: int = 1,
                  seed: int = CLASSIFIER_SEED) -> RandomForestClassifier:
    return _trees(n_estimators, max_depth, min_samples_leaf, seed, bootstrap=True)


def extra_trees(n_estimators: int = 200, max_depth: int | None = 10, min_samples_leaf: int = 1,
                seed: int = CLASSIFIER_SEED) -> RandomForestClassifier:
    """Every tree sees all rows; splits use Spark ML's quantile thresholds.

    An approximation: thresholds are not random. See :class:`RandomThresholdTrees`.
    """
    return _trees(n_estimators, max_depth, min_samples_leaf, seed, bootstrap=False)


# --- ensembles of separate trees ------------------------------------------------------------------


def _member_votes(df: DataFrame, members: Sequence[PipelineModel], hard: bool) -> DataFrame:
    """Add ``_votes``: per member, an array of one vote per class. A narrow chain of projections."""
    names = []
    for i, member in enumerate(members):
        before = df.columns
        df = member.transform(df)
        vote = vector_to_array("probability")
        if hard:
            classes = F.size(vote)
            vote = F.transform(F.sequence(F.lit(0), classes - 1), lambda c: F.when(
                F.col("prediction") == c, 1.0).otherwise(0.0))
        names.append(f"_vote{i}")
        df = df.select(*before, vote.alias(names[-1]))
    return df.withColumn("_votes", F.array(*names)).drop(*names)


# More members than this in one plan make it slow to optimise.
MEMBERS_PER_PLAN = 40


def _chunks(count: int) -> list[range]:
    return [range(i, min(i + MEMBERS_PER_PLAN, count)) for i in range(0, count, MEMBERS_PER_PLAN)]


def _best_class(totals: Column) -> Column:
    return (F.array_position(totals, F.array_max(totals)) - 1).cast("double")


class Ensemble:
    """Separate one-tree models and their weights; votes are summed per class."""

    def __init__(self, members: Sequence[PipelineModel], weights: Sequence[float], classes: int,
                 hard: bool):
        self.members, self.weights = list(members), [float(w) for w in weights]
        self.classes, self.hard = classes, hard

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``class_votes`` (array, one entry per class), their shares ``probability``, ``prediction``."""
        columns = df.columns
        df = df.withColumn("class_votes", F.array(*[F.lit(0.0)] * self.classes))
        for i, chunk in enumerate(_chunks(len(self.members))):
            if i:
                df = scale.stage(df, "votes")
            votes = _member_votes(df, [self.members[m] for m in chunk], self.hard)
            weighted = F.zip_with("_votes", F.array(*[F.lit(self.weights[m]) for m in chunk]),
                                  lambda v, w: F.transform(v, lambda p: p * w))
            totals = F.aggregate(weighted, F.col("class_votes"),
                                 lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
            df = votes.select(*columns, totals.alias("class_votes"))
        total = F.aggregate("class_votes", F.lit(0.0), lambda a, v: a + v)
        shares = F.transform("class_votes", lambda v: F.when(total > 0, v / total).otherwise(1.0 / self.classes))
        return (df.withColumn("probability", array_to_vector(shares))
                .withColumn("prediction", _best_class(F.col("class_votes"))))

    def save(self, folder: str) -> None:
        stages = [stage for member in self.members for stage in member.stages]
        PipelineModel(stages).write().overwrite().save(f"{folder}/members")
        meta = json.dumps({"weights": self.weights, "classes": self.classes, "hard": self.hard,
                           "lengths": [len(m.stages) for m in self.members]})
        spark = SparkSession.getActiveSession()
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(
            f"{folder}/ensemble")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "Ensemble":
        meta = json.loads(spark.read.schema("meta string").json(f"{folder}/ensemble").first()[0])
        stages, members = PipelineModel.load(f"{folder}/members").stages, []
        for length in meta["lengths"]:
            members.append(PipelineModel(stages[:length]))
            stages = stages[length:]
        return cls(members, meta["weights"], meta["classes"], meta["hard"])


def _fit_parallel(jobs: Sequence[Callable], parallelism: int) -> list:
    pool = ThreadPool(max(1, min(parallelism, len(jobs))))
    try:
        return pool.map(lambda job: job(), jobs)
    finally:
        pool.close()


def _class_count(df: DataFrame) -> int:
    return int(df.agg(F.max("label")).first()[0]) + 1


class RandomThresholdTrees:
    """Extremely randomised trees: each tree draws ``cuts`` random thresholds per feature.

    The first lies close to zero, so a tree can tell whether a term occurs; the others lie anywhere up to
    the largest value. A tree sees one on/off feature per threshold (a feature scaled by the inverse of the
    threshold, compared with one), which keeps vectors sparse and gives deeper nodes fresh thresholds.
    """

    def __init__(self, n_estimators: int = 50, max_depth: int | None = 10,
                 min_samples_leaf: int = 1, seed: int = CLASSIFIER_SEED, parallelism: int = 4,
                 cuts: int = 4):
        self.n_estimators, self.max_depth, self.cuts = int(n_estimators), max_depth, int(cuts)
        self.min_samples_leaf, self.seed, self.parallelism = min_samples_leaf, seed, parallelism

    def fit(self, df: DataFrame) -> Ensemble:
        import numpy as np
        top = df.select(Summarizer.max(F.col("features")).alias("top")).first()["top"].toArray()
        jobs = [self._one(df, np.where(top > 0, top, 1.0), i) for i in range(self.n_estimators)]
        members = _fit_parallel(jobs, self.parallelism)
        return Ensemble(members, [1.0] * len(members), _class_count(df), hard=False)

    def _one(self, df: DataFrame, top, i: int) -> Callable[[], PipelineModel]:
        import numpy as np

        def job() -> PipelineModel:
            dice = np.random.default_rng([self.seed, i])
            stages, names = [], []
            for cut in range(self.cuts):
                share = dice.uniform(1e-9, 1e-6, len(top)) if cut == 0 else dice.uniform(1e-6, 1.0, len(top))
                names.append(f"_on_{cut}")
                stages += [ElementwiseProduct(scalingVec=DenseVector(1.0 / (top * share)),
                                              inputCol="features", outputCol=f"_scaled_{cut}"),
                           Binarizer(threshold=1.0, inputCol=f"_scaled_{cut}", outputCol=names[-1])]
            stages.append(VectorAssembler(inputCols=names, outputCol="_on_off"))
            tree = _trees(1, self.max_depth, self.min_samples_leaf, self.seed + i, bootstrap=False)
            tree.setFeaturesCol("_on_off").setMaxBins(2)
            return PipelineModel([*stages, tree.fit(PipelineModel(stages).transform(df))])
        return job


class BoostedTrees:
    """AdaBoost (SAMME; Zhu et al. 2009) over a forest or extra-trees base estimator."""

    def __init__(self, base: Callable[..., RandomForestClassifier] = extra_trees, rounds: int = 10,
                 n_estimators: int = 10, max_depth: int | None = 10, seed: int = CLASSIFIER_SEED,
                 stage_every: int = 5, min_samples_leaf: int = 1):
        self.base, self.rounds, self.n_estimators = base, int(rounds), n_estimators
        self.min_samples_leaf = min_samples_leaf
        self.max_depth, self.seed, self.stage_every = max_depth, seed, stage_every

    def fit(self, df: DataFrame) -> Ensemble:
        classes = _class_count(df)
        current = scale.stage(df.select("Id", "label", "features", F.lit(1.0).alias("weight")),
                              "boost")
        members, weights = [], []
        for i in range(self.rounds):
            learner = self.base(self.n_estimators, self.max_depth, self.min_samples_leaf, seed=self.seed + i)
            model = PipelineModel([learner.setWeightCol("weight").fit(current)])
            judged = model.transform(current).withColumn(
                "_miss", (F.col("prediction") != F.col("label")).cast("double"))
            total, wrong = judged.agg(F.sum("weight"), F.sum(F.col("weight") * F.col("_miss"))).first()
            error = wrong / total
            if error >= 1.0 - 1.0 / classes:
                if not members:
                    raise ValueError("the base estimator is no better than chance")
                break
            members.append(model)
            if error <= 0.0:
                weights.append(1.0)
                break
            weights.append(math.log((1.0 - error) / error) + math.log(classes - 1.0))
            # Weights are kept at a mean of one.
            raised = F.col("weight") * F.exp(F.lit(weights[-1]) * F.col("_miss"))
            mean = (total - wrong + wrong * math.exp(weights[-1])) / total
            current = judged.select("Id", "label", "features", (raised / mean).alias("weight"))
            if (i + 1) % self.stage_every == 0:
                current = scale.stage(current, "boost")
        return Ensemble(members, weights, classes, hard=True)


# --- out-of-bag score -----------------------------------------------------------------------------

# Poisson(1) cumulative probabilities for drawing 0, 1, 2, ... copies of a row.
POISSON_ONE = [sum(math.exp(-1.0) / math.factorial(i) for i in range(n + 1)) for n in range(9)]


def bag_weight(tree: int | Column, seed: int = CLASSIFIER_SEED, key: str = "Id") -> Column:
    """How often a tree's bag holds a row: Poisson(1), drawn from a hash of row, tree and seed."""
    tree = F.lit(tree) if isinstance(tree, int) else tree
    digest = F.md5(F.concat_ws("-", F.col(key).cast("string"), tree.cast("string"),
                               F.lit(str(seed))))
    uniform = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(2 ** 32)
    copies = F.lit(0.0)
    for limit in POISSON_ONE:
        copies = copies + F.when(uniform >= limit, 1.0).otherwise(0.0)
    return copies


def cumulative_votes(votes: DataFrame, key: str = "Id") -> DataFrame:
    """``votes(key, tree, class, vote)`` with ``votes_so_far``: the sum over trees up to this one.

    A window per row and class; it holds one entry per tree.
    """
    so_far = (Window.partitionBy(key, "class").orderBy("tree")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return votes.withColumn("votes_so_far", F.sum("vote").over(so_far))


def curve(votes: DataFrame, truth: DataFrame, sizes: Sequence[int], key: str = "Id") -> DataFrame:
    """``(n, oob_score)``: share of rows whose leading class after ``n`` trees is right.

    ``votes`` needs a row for every (row, tree, class). Rows no tree has left out so far do not
    count.
    """
    steps = cumulative_votes(votes, key).filter(
        (F.col("tree") + 1).isin([int(n) for n in sizes]))
    leading = steps.groupBy(key, "tree").agg(
        F.max_by("class", F.struct(F.round("votes_so_far", 9), -F.col("class"))).alias("leading"),
        F.max("votes_so_far").alias("most")).filter(F.col("most") > 0)
    return (leading.join(truth.select(key, "label"), key)
            .groupBy((F.col("tree") + 1).cast("int").alias("n"))
            .agg(F.avg((F.col("leading") == F.col("label")).cast("double")).alias("oob_score")))


class BaggedTrees:
    """Trees on explicit bags, so that each row knows which trees have never seen it."""

    def __init__(self, n_estimators: int = 50, max_depth: int | None = 10,
                 min_samples_leaf: int = 1, seed: int = CLASSIFIER_SEED, parallelism: int = 4):
        self.n_estimators, self.max_depth = int(n_estimators), max_depth
        self.min_samples_leaf, self.seed, self.parallelism = min_samples_leaf, seed, parallelism

    def fit(self, df: DataFrame) -> Ensemble:
        def job(i: int) -> Callable[[], PipelineModel]:
            def run() -> PipelineModel:
                bag = df.withColumn("weight", bag_weight(i, self.seed)).filter("weight > 0")
                tree = _trees(1, self.max_depth, self.min_samples_leaf, self.seed + i,
                              bootstrap=False)
                return PipelineModel([tree.setWeightCol("weight").fit(bag)])
            return run
        members = _fit_parallel([job(i) for i in range(self.n_estimators)], self.parallelism)
        return Ensemble(members, [1.0] * len(members), _class_count(df), hard=False)

    def votes(self, ensemble: Ensemble, df: DataFrame) -> DataFrame:
        """``(Id, tree, class, vote)``; trees that saw the row vote 0."""
        out = None
        for chunk in _chunks(len(ensemble.members)):
            voted = _member_votes(df.select("Id", "features"),
                                  [ensemble.members[m] for m in chunk], ensemble.hard)
            part = voted.select("Id", F.posexplode("_votes").alias("tree", "_vote")).withColumn(
                "tree", F.col("tree") + chunk.start)
            out = part if out is None else out.unionByName(part)
        unseen = F.when(bag_weight(F.col("tree"), self.seed) == 0, 1.0).otherwise(0.0)
        return (out.withColumn("_unseen", unseen)
                .select("Id", "tree", "_unseen", F.posexplode("_vote").alias("class", "p"))
                .select("Id", "tree", "class", (F.col("p") * F.col("_unseen")).alias("vote")))

    def oob_curve(self, df: DataFrame, smallest: int = 25) -> DataFrame:
        """Out-of-bag score for every ensemble size from ``smallest`` on.

        Each tree is fitted once. The sizes are running sums over its votes inside the row; only counts of
        right and counted rows per size are shuffled. Equal to :func:`curve` over :meth:`votes`.
        """
        ensemble = self.fit(df)
        smallest = min(smallest, self.n_estimators)
        zeros = F.array(*[F.lit(0.0)] * ensemble.classes)
        now = df.select("Id", "label", "features", zeros.alias("_totals"))
        out = None
        for i, chunk in enumerate(_chunks(len(ensemble.members))):
            if i:
                now = scale.stage(now, "votes")
            voted = _member_votes(now, [ensemble.members[m] for m in chunk], ensemble.hard)
            unseen = F.array(*[F.when(bag_weight(m, self.seed) == 0, 1.0).otherwise(0.0) for m in chunk])
            votes = F.zip_with("_votes", unseen, lambda v, u: F.transform(v, lambda p: p * u))
            # Totals after each tree of the chunk, the state before them first.
            steps = F.aggregate(votes, F.array("_totals"), lambda a, v: F.concat(a, F.array(
                F.zip_with(F.element_at(a, -1), v, lambda x, y: x + y))))
            voted = voted.select("Id", "label", "features", steps.alias("_steps"))
            at = voted.select("label", F.posexplode(F.slice("_steps", 2, len(chunk))).alias("n", "_totals"))
            at = at.withColumn("n", F.col("n") + chunk.start + 1).filter(F.col("n") >= smallest)
            rounded = F.transform("_totals", lambda v: F.round(v, 9))
            counted = at.filter(F.array_max("_totals") > 0).groupBy("n").agg(
                F.avg((_best_class(rounded) == F.col("label")).cast("double")).alias("oob_score"))
            out = counted if out is None else out.unionByName(counted)
            now = voted.select("Id", "label", "features", F.element_at("_steps", -1).alias("_totals"))
        return out.select(F.col("n").cast("int").alias("n"), "oob_score")


# --- feature importance ---------------------------------------------------------------------------


def feature_importances(model, terms: DataFrame) -> DataFrame:
    """``(rank, branch, term, importance, std)``, most important first.

    ``terms`` names the vector positions; the spread is taken over the trees.
    """
    import numpy as np
    size = model.numFeatures
    spread_sum, spread_sq = np.zeros(size), np.zeros(size)
    for tree in model.trees:
        one = tree.featureImportances.toArray()
        spread_sum += one
        spread_sq += one * one
    n = len(model.trees)
    std = np.sqrt(np.maximum(spread_sq / n - (spread_sum / n) ** 2, 0.0))
    overall = model.featureImportances.toArray()
    values = scale.local_table(
        terms.sparkSession, {"position": range(size), "importance": overall, "std": std},
        "position int, importance double, std double")
    # One row per entry of the model's vectors.
    order = Window.orderBy(F.desc("importance"), "branch", "term")
    return (scale.attach(terms, values, ["position"], "inner")
            .withColumn("rank", F.row_number().over(order))
            .select("rank", "branch", "term", "importance", "std"))
