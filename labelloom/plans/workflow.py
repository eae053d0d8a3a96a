"""The tasks a user runs: preprocess, enrich, tune, score, train, predict."""

from __future__ import annotations

import json
import time
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.functions import text as T
from labelloom.operators import classifiers as C
from labelloom.operators import growth as G
from labelloom.operators import enrich as E
from labelloom.operators import metrics as M
from labelloom.operators import selection as S
from labelloom.operators import tuning
from labelloom.operators import vectors as V
from labelloom.operators.features import lengths, scaled
from labelloom.operators.split import holdout
from labelloom.plans import config
from labelloom.sources import articles as A


def preprocess(docs: DataFrame, stop_words: Iterable[str] | None = None,
               dictionary: DataFrame | None = None) -> DataFrame:
    """Add ``Tokens``, a ``;`` list of cleaned words of the shape's text column."""
    column = A.text_column(A.detect_shape(docs))
    stop_words = T.default_stop_words() if stop_words is None else stop_words
    out = docs.withColumn("Tokens", T.tokenise(F.col(column), stop_words))
    if dictionary is not None:
        out = E.normalise(out, "Tokens", dictionary)
    return out.withColumn("Tokens", T.join_list(F.col("Tokens")))


def enrich(docs: DataFrame, corpus: DataFrame, stop_words: Iterable[str] = ()) -> DataFrame:
    """The side table of terms and keywords; only for articles with titles."""
    if A.detect_shape(docs) != "binary":
        raise ValueError("keywords and terms are looked up by title; these articles have none")
    return E.lookup(docs, corpus, stop_words=stop_words)


def identified(docs: DataFrame) -> DataFrame:
    """Rejects repeated ids, which would merge two documents into one."""
    twice = docs.groupBy("Id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"Id {twice[0]['Id']} occurs {twice[0]['n']} times; ids must be unique")
    return docs


@dataclass
class LabelModel:
    """A trained model: fitted features, classifier and class names."""

    features: V.FittedFeatures
    classifier: object
    classes: list[str]
    params: dict = field(default_factory=dict)

    def score(self, docs: DataFrame) -> DataFrame:
        """Adds ``prediction`` (class number), ``probability`` and ``predicted`` (class name)."""
        out = self.classifier.transform(self.features.transform(docs))
        names = F.array(*[F.lit(c) for c in self.classes])
        return out.withColumn("predicted", F.get(names, F.col("prediction").cast("int")))

    def predict(self, docs: DataFrame) -> DataFrame:
        """``(Id, Category)`` for every document."""
        return self.score(docs).select("Id", F.col("predicted").alias("Category"))

    def save(self, folder: str) -> None:
        spark = self.features.idf.sparkSession
        self.features.save(f"{folder}/features")
        several = isinstance(self.classifier, C.Ensemble)
        grown = isinstance(self.classifier, G.GrownTrees)
        if several or grown:
            self.classifier.save(f"{folder}/classifier")
        else:
            PipelineModel([self.classifier]).write().overwrite().save(f"{folder}/classifier")
        meta = json.dumps({"classes": self.classes, "params": self.params, "several": several, "grown": grown})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode("overwrite").json(
            f"{folder}/model")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "LabelModel":
        meta = json.loads(spark.read.schema("meta string").json(f"{folder}/model").first()[0])
        classifier = (C.Ensemble.load(spark, f"{folder}/classifier") if meta.get("several")
                      else G.GrownTrees.load(spark, f"{folder}/classifier") if meta.get("grown")
                      else PipelineModel.load(f"{folder}/classifier").stages[0])
        return cls(V.FittedFeatures.load(spark, f"{folder}/features"), classifier,
                   meta["classes"], meta["params"])


def available(docs: DataFrame, branches: Sequence) -> list:
    """The branches whose source column the table has."""
    found = [b for b in branches if b.column in docs.columns]
    if not found:
        raise ValueError("none of the feature columns is present")
    return found


def parameters(shape: str, **changes) -> dict:
    """The fixed parameters of a shape, with changes."""
    out = {**tuning.DEFAULTS, **config.FIXED[shape], **changes}
    return {**out, "max_depth": C.effective_depth(out["max_depth"])}


def tune(docs: DataFrame, method: str = "config", metric: str = "accuracy",
         branches: Sequence | None = None, positive: str | None = None, space: dict | None = None,
         settings: dict | None = None, leak_free: bool = True, parallelism: int = 4
         ) -> tuple[dict, tuning.SearchResult | None]:
    """Parameters by ``config``, ``grid``, ``randomized`` or ``evolutionary``."""
    shape = A.detect_shape(docs)
    if method == "config":
        return parameters(shape), None
    docs = identified(A.labelled(docs))
    branches = available(docs, branches or config.branches(shape))
    space = dict(space or config.SPACES[method][shape])
    if len(branches) < 2:
        space.pop("without", None)
    found = tuning.search(docs, branches, method, space,
                          {**config.SEARCH[method], **(settings or {})}, metric, positive,
                          leak_free, parallelism)
    return {**tuning.DEFAULTS, **found.best}, found


def train(docs: DataFrame, params: dict | None = None, branches: Sequence | None = None
          ) -> LabelModel:
    """Fit features and classifier on all labelled rows."""
    shape = A.detect_shape(docs)
    params = parameters(shape, **(params or {}))
    rows = identified(A.labelled(docs))
    used = [b for b in available(docs, branches or config.branches(shape))
            if b.name != params["without"]]
    fitted = V.fit_features(rows, used, params["k"], params["score"])
    classes = tuning.label_table(rows)
    vectors = fitted.transform(rows, counts=fitted.counts, norms=fitted.norms)
    vectors = scale.stage(tuning.with_label(vectors, classes).select("Id", "label", "features"),
                          "vectors")
    return LabelModel(fitted, tuning.classifier(params).fit(vectors), classes, params)


@dataclass
class Evaluation:
    """What scoring on held-out rows gives."""

    report: DataFrame
    confusion: DataFrame
    accuracy: float
    metrics: DataFrame
    scored: DataFrame
    model: LabelModel
    oob: DataFrame | None = None
    importances: DataFrame | None = None


def score(docs: DataFrame, params: dict | None = None, branches: Sequence | None = None,
          test_size: float = config.HOLDOUT_FRACTION, oob: bool = False, importance: bool = False
          ) -> Evaluation:
    """Train on one part of the labelled rows and evaluate on the rest."""
    spark, seconds = docs.sparkSession, [time.time()]
    split = scale.stage(holdout(identified(A.labelled(docs)), test_size), "split")
    seconds.append(time.time())
    training, held_out = split.filter("NOT is_test"), split.filter("is_test")
    model = train(training.drop("is_test"), params, branches)
    seconds.append(time.time())
    scored = scale.stage(model.score(held_out.drop("is_test"))
                         .select("Id", "Category", "prediction", "predicted", "probability"),
                         "scored")
    counts = scale.pin(M.confusion(scored, "Category", "predicted"))
    seconds.append(time.time())
    rows = [(name, frame.count(), model.features.size, end - start) for name, frame, start, end in
            zip(("split", "fit", "evaluate"), (split, training, scored), seconds, seconds[1:])]
    out = Evaluation(M.evaluation_report(counts), counts, float(M.accuracy(counts).first()[0]),
                     M.stage_metrics(spark, rows), scored, model)
    if oob:
        out.oob = oob_scores(training, model)
    if importance:
        out.importances = C.feature_importances(model.classifier, model.features.selected_terms())
    return out


def oob_scores(training: DataFrame, model: LabelModel) -> DataFrame:
    """Out-of-bag curve of an ensemble with the model's parameters on explicit bags."""
    vectors = scale.stage(tuning.with_label(model.features.transform(training), model.classes)
                          .select("Id", "label", "features"), "vectors")
    trees = C.BaggedTrees(model.params["n_estimators"], model.params["max_depth"],
                          model.params["min_samples_leaf"])
    return trees.oob_curve(vectors, config.OOB_SMALLEST)


def sweep_selection(docs: DataFrame, branches: Sequence, sizes: Sequence[int] = config.SWEEP,
                    n_estimators: int = 25, max_depth: int | None = 10) -> DataFrame:
    """``(k, score)``: out-of-bag score of the ensemble for each number of kept terms."""
    docs = A.labelled(docs)
    counts, idf = V.fit_idf(docs, branches)
    norms = scale.stage(lengths(counts, idf), "lengths")
    scores = S.chi2_scores(scaled(counts, idf, norms=norms), None, docs)
    classes = tuning.label_table(docs)

    def oob(best: DataFrame) -> float:
        fitted = V.with_selection(branches, idf, best)
        vectors = tuning.with_label(fitted.transform(docs, counts=counts, norms=norms), classes)
        vectors = scale.stage(vectors.select("Id", "label", "features"), "vectors")
        trees = C.BaggedTrees(n_estimators, max_depth)
        return trees.oob_curve(vectors, n_estimators).first()["oob_score"]

    return S.sweep_k(scores, sizes, oob)


def predict(model: LabelModel, docs: DataFrame) -> DataFrame:
    """``(Id, Category)`` for documents without a label."""
    return model.predict(identified(docs))
