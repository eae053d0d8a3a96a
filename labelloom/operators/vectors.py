"""The selected features as sparse vectors for Spark ML.

The long table decides which terms are kept. A document's vector is then built inside its row
from the selected terms alone. Its length, however, counts all terms of the branch: the part that
belongs to terms not selected is one number per document and branch, found by a join with the idf
table, appended as an extra entry before normalising and cut off after.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import (CountVectorizerModel, ElementwiseProduct, Normalizer,
                                VectorAssembler, VectorSlicer)
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.operators import features as FT
from labelloom.operators import selection as S
from labelloom.operators.blocks import Blocks

# Chi-squared counts the terms' frequencies itself: the idf table is fitted on the same documents.
SCORES = {"chi2": lambda scaled, idf, docs, label: S.chi2_scores(scaled, None, docs, label),
          "mutual_information": S.mutual_information}


class FittedFeatures:
    """Fitted branches: the idf table (``selected`` marks the kept terms) and vector stages."""

    def __init__(self, branches: Sequence[FT.Branch], idf: DataFrame, stages: PipelineModel,
                 size: int, counts: DataFrame | Blocks | None = None, norms: DataFrame | None = None):
        self.branches, self.idf, self.stages, self.size = tuple(branches), idf, stages, size
        self.counts, self.norms = counts, norms

    def transform(self, docs: DataFrame, key: str = "Id", counts: DataFrame | Blocks | None = None,
                  norms: DataFrame | None = None) -> DataFrame:
        """Add ``features``. ``key`` must identify a row of ``docs``.

        ``counts`` may hand over the stored term counts of the same documents, ``norms`` their lengths over
        all terms: then only the selected terms are looked up.
        """
        branches = self.branches
        if counts is None:
            counts = FT.doc_terms(docs, branches, [key])
            if not scale.fits(self.idf):
                # The large table is joined in two passes; do not cut the texts twice.
                counts = scale.stage(counts, "counts")
        pairs = FT.term_counts(counts).select(key, "branch", "term", "tf")
        squares = F.col("tf") * F.col("idf") * F.col("tf") * F.col("idf")
        if norms is None:
            rest = FT.with_idf(pairs, self.idf.filter(~F.col("selected"))).withColumn("square", squares)
        else:
            chosen = self.idf.filter("selected").select("branch", "term", "idf")
            inside = scale.attach(pairs, chosen, ["term", "branch"], "inner").groupBy(key, "branch").agg(
                F.sum(squares).alias("inside"))
            square = F.col("norm") * F.col("norm") - F.coalesce("inside", F.lit(0.0))
            rest = norms.join(inside, [key, "branch"], "left").withColumn(
                "square", F.greatest(square, F.lit(0.0)))
        lengths = rest.groupBy(key).agg(*[
            F.sqrt(F.sum(F.when(F.col("branch") == b.name, F.col("square")).otherwise(0.0)))
            .alias(f"_rest_{b.name}") for b in branches])
        # Only the terms that the vectors have; to cut all of a text's runs into an array took most of the time.
        chosen = {s.getInputCol(): s.vocabulary for s in self.stages.stages if isinstance(s, CountVectorizerModel)}
        wide = docs.select("*", *[FT.kept_terms(b, chosen[c]).alias(c) for b in branches
                                  if (c := f"_terms_{b.name}") in chosen])
        lengths = scale.stage(lengths, "rest")
        few = scale.fits(lengths, FT.LENGTHS)
        wide = wide.join(F.broadcast(lengths) if few else lengths, key, "left").fillna(0.0, [f"_rest_{b.name}" for b in branches])
        return self.stages.transform(wide).select(*docs.columns, "features")

    def selected_terms(self) -> DataFrame:
        """``(branch, term, position)``, position being the place in the vector."""
        return self.idf.filter("selected").select("branch", "term", "position")

    def save(self, folder: str, mode: str = "overwrite") -> None:
        spark = self.idf.sparkSession
        self.idf.write.mode(mode).parquet(f"{folder}/terms")
        self.stages.write().overwrite().save(f"{folder}/vectors")
        meta = json.dumps({"branches": [asdict(b) for b in self.branches], "size": self.size})
        spark.createDataFrame([(meta,)], "meta string").coalesce(1).write.mode(mode).json(
            f"{folder}/branches")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> "FittedFeatures":
        meta = json.loads(spark.read.schema("meta string").json(f"{folder}/branches").first()[0])
        branches = [FT.Branch(b["name"], b["column"], b["kind"], tuple(b["ngrams"]),
                              tuple(b["stop_words"])) for b in meta["branches"]]
        return cls(branches, spark.read.parquet(f"{folder}/terms"),
                   PipelineModel.load(f"{folder}/vectors"), meta["size"])


def _vector_stages(branches: Sequence[FT.Branch], chosen: dict[str, list]) -> PipelineModel:
    stages, outputs = [], []
    for b in branches:
        terms = chosen.get(b.name, [])
        if not terms:
            continue
        size = len(terms)
        stages += [
            CountVectorizerModel.from_vocabulary(
                [t for t, _ in terms], inputCol=f"_terms_{b.name}", outputCol=f"_tf_{b.name}",
                minTF=1.0),
            ElementwiseProduct(scalingVec=DenseVector([w for _, w in terms]),
                               inputCol=f"_tf_{b.name}", outputCol=f"_w_{b.name}"),
            VectorAssembler(inputCols=[f"_w_{b.name}", f"_rest_{b.name}"],
                            outputCol=f"_all_{b.name}"),
            Normalizer(p=2.0, inputCol=f"_all_{b.name}", outputCol=f"_unit_{b.name}"),
            VectorSlicer(indices=list(range(size)), inputCol=f"_unit_{b.name}",
                         outputCol=f"_cut_{b.name}"),
        ]
        outputs.append(f"_cut_{b.name}")
    stages.append(VectorAssembler(inputCols=outputs, outputCol="features"))
    return PipelineModel(stages)


def fit_idf(docs: DataFrame, branches: Sequence[FT.Branch], label: str = "Category",
            key: str = "Id", counts: DataFrame | None = None) -> tuple[DataFrame | Blocks, DataFrame]:
    """The stored term counts per document, packed, and the stored idf table of a training set.

    ``counts`` may hand over stored counts of these documents and branches; they are returned as they are."""
    if counts is None:
        blocks = Blocks(docs, branches, [key, label])
        return blocks, blocks.idf
    vocab = FT.vocabulary(FT.term_counts(counts))
    return counts, scale.stage(FT.inverse_frequency(vocab, docs), "idf")


def fit_features(docs: DataFrame, branches: Sequence[FT.Branch], k: int, score: str = "chi2",
                 label: str = "Category", key: str = "Id", counts: DataFrame | None = None
                 ) -> FittedFeatures:
    """Weigh all terms, keep the ``k`` best against the label, prepare the vector stages."""
    counts, idf = fit_idf(docs, branches, label, key, counts)
    norms = scale.stage(FT.lengths(counts, idf, key), "lengths")
    scores = SCORES[score](FT.scaled(counts, idf, key, norms), idf, docs, label)
    return with_selection(branches, idf, scale.pin(S.select_k_best(scores, k)), counts, norms)


def with_selection(branches: Sequence[FT.Branch], idf: DataFrame, best: DataFrame,
                   counts: DataFrame | Blocks | None = None, norms: DataFrame | None = None) -> FittedFeatures:
    """Fitted features for a chosen set of terms.

    The chosen terms are the width of the vectors, which Spark ML keeps on the driver anyway.
    """
    kept = scale.attach(idf, best.select("branch", "term"), ["branch", "term"], "inner")
    chosen: dict[str, list] = {}
    rows = sorted((r["branch"], r["term"], r["idf"]) for r in kept.collect())
    for branch, term, idf_value in rows:
        chosen.setdefault(branch, []).append((term, idf_value))
    if not rows:
        raise ValueError("no term was selected")
    position, places = 0, []
    for b in branches:
        for term, _ in chosen.get(b.name, []):
            places.append((b.name, term, position))
            position += 1
    names = ("branch", "term", "position")
    placed = scale.local_table(idf.sparkSession, dict(zip(names, zip(*places))),
                               "branch string, term string, position int")
    marked = scale.attach(idf, placed, ["branch", "term"]).withColumn("selected", F.col("position").isNotNull())
    if not scale.fits(placed):
        marked = scale.stage(marked, "terms")
    return FittedFeatures(branches, marked, _vector_stages(branches, chosen), position,
                          counts, norms)
