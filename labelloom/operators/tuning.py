"""Choosing parameters: candidates, cross-validated scores, and the three search methods.

The driver holds candidates and scores only; every feature table, fit and score is a Spark job.
"""

from __future__ import annotations

import hashlib
import itertools
import random
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.operators import classifiers as C
from labelloom.operators import growth as G
from labelloom.operators import metrics as M
from labelloom.operators.split import folds
from labelloom.operators.features import doc_terms
from labelloom.operators.vectors import fit_features

CLASSIFIERS = {"extra_trees": C.extra_trees, "random_forest": C.random_forest,
               "random_threshold_trees": C.RandomThresholdTrees,
               "boosted_trees": lambda n_estimators, max_depth, min_samples_leaf: C.BoostedTrees(
                   n_estimators=n_estimators, max_depth=max_depth, min_samples_leaf=min_samples_leaf),
               # grown by aggregates: best-first with a leaf limit (bagged), and a random threshold a node
               "best_first_trees": lambda n_estimators, max_depth, min_samples_leaf, **more: G.GrownForest(
                   n_estimators, max_depth, min_samples_leaf, splitter="best", bootstrap=True, **more),
               "random_split_trees": lambda n_estimators, max_depth, min_samples_leaf, **more: G.GrownForest(
                   n_estimators, max_depth, min_samples_leaf, splitter="random", bootstrap=False, **more)}
# Only the trees grown by aggregates know these parameters.
GROWN_ONLY = {"min_samples_split": 2, "max_leaf_nodes": None}
# What a candidate means where it says nothing.
DEFAULTS = {"k": 4000, "score": "chi2", "without": "", "classifier": "extra_trees",
            "n_estimators": 200, "max_depth": 10, "min_samples_leaf": 1}


def effective(space: dict) -> dict:
    """The space with the depths that are fitted; one that cannot be fitted is an error."""
    if "max_depth" not in space:
        return dict(space)
    return {**space, "max_depth": list(dict.fromkeys(map(C.effective_depth, space["max_depth"])))}


def grid(space: dict) -> list[dict]:
    """Every combination of the value lists."""
    names = sorted(space)
    return [dict(zip(names, values)) for values in itertools.product(*[space[n] for n in names])]


def draw(space: dict, n_iter: int, seed: int) -> list[dict]:
    """``n_iter`` combinations in a reproducible random order, without repeats."""
    everything = grid(space)
    order = sorted(range(len(everything)),
                   key=lambda i: hashlib.md5(f"{i}-{seed}".encode()).hexdigest())
    return [everything[i] for i in order[:n_iter]]


def candidate_table(spark: SparkSession, candidates: Sequence[dict]) -> DataFrame:
    rows = [(i, {n: str(v) for n, v in c.items()}) for i, c in enumerate(candidates)]
    return spark.createDataFrame(rows, "candidate int, params map<string,string>")


def classifier(params: dict):
    params = {**DEFAULTS, **GROWN_ONLY, **params}
    more = {n: (None if params[n] in (None, "None") else int(params[n])) for n in GROWN_ONLY}
    if params["classifier"] in ("best_first_trees", "random_split_trees"):
        return CLASSIFIERS[params["classifier"]](params["n_estimators"], params["max_depth"],
                                                 params["min_samples_leaf"], **more)
    if more != GROWN_ONLY:
        raise ValueError(f"{params['classifier']} has no min_samples_split or max_leaf_nodes; "
                         "use best_first_trees or random_split_trees")
    return CLASSIFIERS[params["classifier"]](params["n_estimators"], params["max_depth"],
                                             params["min_samples_leaf"])


def label_table(docs: DataFrame, label: str = "Category") -> list[str]:
    """The classes in sorted order; as many as Spark ML can train on, held on the driver by it."""
    return [r[0] for r in docs.select(label).filter(F.col(label).isNotNull()).distinct()
            .orderBy(label).collect()]


def with_label(df: DataFrame, classes: Sequence[str], label: str = "Category") -> DataFrame:
    """Add the class number ``label`` that Spark ML trains on."""
    position = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    return df.withColumn("label", position.cast("double"))


class CrossValidation:
    """Scores candidates on stratified folds and remembers what it has scored.

    With ``leak_free`` the features and the selection are fitted inside each fold. Otherwise they
    are fitted once on all rows, which is cheaper and lets the held-out rows influence them.
    """

    def __init__(self, docs: DataFrame, branches: Sequence, k_folds: int,
                 metric: str = "accuracy", positive: str | None = None, leak_free: bool = True,
                 parallelism: int = 4):
        self.docs = scale.stage(folds(docs, k_folds), "folds")
        self.branches, self.k_folds, self.metric = list(branches), k_folds, metric
        self.positive, self.leak_free, self.parallelism = positive, leak_free, parallelism
        self.classes = label_table(docs)
        # The texts are cut once for all folds and settings.
        self.counts = scale.stage(doc_terms(self.docs, self.branches, ["Id", "Category", "fold"]), "counts")
        self._vectors: dict = {}
        self._scores: dict = {}

    def _parts(self, params: dict, fold: int) -> tuple[DataFrame, DataFrame]:
        """Stored training and held-out vectors for one feature setting and fold."""
        used = tuple(b for b in self.branches if b.name != params["without"])
        setting = (tuple(b.name for b in used), params["k"], params["score"])
        within = fold if self.leak_free else None
        if (setting, within) not in self._vectors:
            train = (self.docs.filter(F.col("fold") != fold) if self.leak_free else self.docs)
            counts = self.counts.filter(F.col("branch").isin([b.name for b in used]))
            seen = counts.filter(F.col("fold") != fold) if self.leak_free else counts
            fitted = fit_features(train, used, params["k"], params["score"], counts=seen.drop("fold"))
            rows = with_label(fitted.transform(self.docs, counts=counts), self.classes)
            self._vectors[setting, within] = scale.stage(
                rows.select("Id", "Category", "label", "fold", "features"), "vectors")
        rows = self._vectors[setting, within]
        return rows.filter(F.col("fold") != fold), rows.filter(F.col("fold") == fold)

    def _evaluate(self, params: dict, train: DataFrame, held_out: DataFrame) -> float:
        scored = classifier(params).fit(train).transform(held_out)
        if self.positive is not None:
            at = float(self.classes.index(self.positive))
            from pyspark.ml.functions import vector_to_array
            scored = scored.withColumn("score", vector_to_array("probability")[int(at)])
            return M.evaluate(scored, self.metric, "label", "prediction", "score", at)
        return M.evaluate(scored, self.metric, "label", "prediction")

    def score(self, candidates: Sequence[dict]) -> list[list[float]]:
        """Scores per candidate and fold. A candidate seen before costs nothing."""
        keys = [tuple(sorted(c.items(), key=lambda kv: kv[0])) for c in candidates]
        new = {key: {**DEFAULTS, **c} for key, c in zip(keys, candidates)
               if key not in self._scores}
        jobs = []
        for fold in range(self.k_folds):
            for key, params in new.items():
                train, held_out = self._parts(params, fold)
                jobs.append((key, fold, params, train, held_out))
        done = C._fit_parallel([lambda j=j: self._evaluate(*j[2:]) for j in jobs],
                               self.parallelism) if jobs else []
        for (key, fold, *_), value in zip(jobs, done):
            self._scores.setdefault(key, {})[fold] = value
        return [[self._scores[key][f] for f in range(self.k_folds)] for key in keys]


class SearchResult:
    """All candidates with their scores; ``table`` is the report, ``best`` the winner."""

    def __init__(self, spark: SparkSession, candidates: Sequence[dict],
                 scores: Sequence[Sequence[float]]):
        rows = [(i, fold, float(v)) for i, line in enumerate(scores) for fold, v in enumerate(line)]
        self.candidates = list(candidates)
        self.scores = spark.createDataFrame(rows, "candidate int, fold int, score double")
        self.table = M.fold_table(self.scores, len(scores[0])).join(
            candidate_table(spark, candidates), "candidate")
        best = M.best_candidate(self.table).first()
        self.best, self.best_score = self.candidates[best["candidate"]], best["mean_score"]


def search_candidates(spark: SparkSession, candidates: Sequence[dict],
                      score: Callable[[Sequence[dict]], list[list[float]]]) -> SearchResult:
    return SearchResult(spark, candidates, score(candidates))


def evolve(spark: SparkSession, space: dict, score: Callable[[Sequence[dict]], list[list[float]]],
           population: int = 50, mutation: float = 0.10, crossover: float = 0.5,
           tournament: int = 3, generations: int = 5, seed: int = 32135) -> SearchResult:
    """Evolutionary search: tournaments pick parents, genes are exchanged and mutated.

    Each generation scores its new candidates only.
    """
    dice = random.Random(seed)
    names = sorted(space)
    fitness: dict[tuple, list[float]] = {}

    def rate(genes: list[tuple]) -> None:
        new = [g for g in dict.fromkeys(genes) if g not in fitness]
        for g, line in zip(new, score([dict(zip(names, g)) for g in new]) if new else []):
            fitness[g] = list(line)

    def mean(g: tuple) -> float:
        return sum(fitness[g]) / len(fitness[g])

    people = [tuple(dice.choice(list(space[n])) for n in names) for _ in range(population)]
    rate(people)
    for _ in range(generations):
        parents = [max(dice.choices(people, k=tournament), key=mean) for _ in range(population)]
        children = []
        for left, right in zip(parents[::2], parents[1::2]):
            if dice.random() < crossover:
                swap = [dice.random() < 0.5 for _ in names]
                left, right = (tuple(b if s else a for a, b, s in zip(left, right, swap)),
                               tuple(a if s else b for a, b, s in zip(left, right, swap)))
            children += [left, right]
        if len(parents) % 2:
            children.append(parents[-1])
        people = [tuple(dice.choice(list(space[n])) if dice.random() < mutation else v
                        for n, v in zip(names, child)) for child in children]
        rate(people)
    genes = list(fitness)
    return SearchResult(spark, [dict(zip(names, g)) for g in genes], [fitness[g] for g in genes])


def search(docs: DataFrame, branches: Sequence, method: str, space: dict, settings: dict,
           metric: str = "accuracy", positive: str | None = None, leak_free: bool = True,
           parallelism: int = 4) -> SearchResult:
    """Run one of ``grid``, ``randomized`` and ``evolutionary`` on cross-validated scores."""
    validation = CrossValidation(docs, branches, settings["folds"], metric, positive, leak_free,
                                 parallelism)
    spark, space = docs.sparkSession, effective(space)
    if method == "grid":
        return search_candidates(spark, grid(space), validation.score)
    if method == "randomized":
        return search_candidates(spark, draw(space, settings["n_iter"], settings["seed"]),
                                 validation.score)
    if method == "evolutionary":
        return evolve(spark, space, validation.score,
                      **{n: settings[n] for n in ("population", "mutation", "crossover",
                                                  "tournament", "generations", "seed")})
    raise ValueError("the method must be grid, randomized or evolutionary")
