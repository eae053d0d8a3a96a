"""Packed counts against the plain ones: the same weights and scores, and no pair travels as a row of its own."""

import numpy as np
import pyarrow as pa
import pytest

from labelloom import scale
from labelloom.operators import blocks as B
from labelloom.operators import features as FT
from labelloom.operators import selection as S
from labelloom.operators import vectors as V

WORDS = FT.Branch("words", "Text", "words", (1, 3), ("the",))
CHARS = FT.Branch("chars", "Text", "chars", (2, 4))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"The café; a naïve word{i % 7} word{i % 3} common xy the ab{i} \U0001f600", "ab"[i % 2]) for i in range(60)]
    rows += [(None, "only here", "a"), (3, "the same id again", "b"), (50, None, "a"), (51, "", "b"), (52, "unlabelled term", None)]
    return spark.createDataFrame(rows, "Id long, Text string, Category string").repartition(3, "Text").cache()


@pytest.fixture
def packed(docs, monkeypatch):
    """Fitted counts and idf table, in many blocks and buckets."""
    for name, size in (("BLOCK_PAIRS", 200), ("BUCKET_LEAST", 64), ("BUCKET_TERMS", 64), ("SAMPLED", 8), ("OPENED", 7)):
        monkeypatch.setattr(B, name, size)
    monkeypatch.setattr(FT, "COUNTED_ROWS", 4)
    return V.fit_idf(docs, [WORDS, CHARS])


def plain_fit(docs):
    return V.fit_idf(docs, [WORDS, CHARS], counts=scale.stage(FT.doc_terms(docs, [WORDS, CHARS], ["Id", "Category"]), "counts"))


def rows(df, *columns):
    return sorted((tuple(round(v, 9) if isinstance(v, float) else v for v in r) for r in df.select(*columns).collect()), key=repr)


def test_numbers_and_terms_come_back():
    for values in ([], [0], [3, 0, 255], [70_000, 1], [1 << 40, 5]):
        assert B.expand(B.squeeze(np.array(values, np.int64))).tolist() == values
    assert B.expand(B.squeeze(np.array([0.1, -2.5]))).tolist() == [0.1, -2.5]
    for terms in ([], [""], ["", "a", "ab", "abc d", "abc e", "b" * 300, "b" * 301, "été", "été \U0001f600"]):
        found = pa.array(["cut", *terms, "off"])[1:-1]
        assert B.expand_terms(B.squeeze_terms(found)).to_pylist() == terms
    alike = pa.array([f"{'common start ' * 9}{i:05d}" for i in range(5000)])
    assert B.expand_terms(B.squeeze_terms(alike)).equals(alike) and len(B.squeeze_terms(alike[:1])) < 100


def test_packed_counts_are_those_of_the_rows(docs, packed):
    counts, idf = packed
    plain_counts, plain_idf = plain_fit(docs)
    assert idf.dtypes == plain_idf.dtypes and rows(idf, *idf.columns) == rows(plain_idf, *idf.columns)
    columns = ["Id", "Category", "branch", "term", "tf"]
    assert rows(FT.term_counts(counts), *columns) == rows(FT.term_counts(plain_counts), *columns)


def test_weights_are_those_of_the_rows(docs, packed):
    got, want = FT.weights(*packed), FT.weights(*plain_fit(docs))
    assert got.columns == want.columns and rows(got, *want.columns) == rows(want, *want.columns)
    foreign = FT.weights(packed[0], plain_fit(docs)[1])
    assert rows(foreign, *want.columns) == rows(want, *want.columns)


@pytest.mark.parametrize("score, side_by_side", [("chi2", 32), ("chi2", 0), ("mutual_information", 32)])
def test_scores_are_those_of_the_rows(docs, packed, score, side_by_side, monkeypatch):
    monkeypatch.setattr(S, "SIDE_BY_SIDE", side_by_side)
    get = lambda counts, idf: V.SCORES[score](FT.scaled(counts, idf), idf, docs, "Category")
    got, want = get(*packed), get(*plain_fit(docs))
    assert rows(got, "branch", "term", "score") == rows(want, "branch", "term", "score")


def test_vectors_are_those_of_the_rows(docs):
    once = docs.filter("Id IS NOT NULL AND Category IS NOT NULL").dropDuplicates(["Id"])
    entries = lambda m: {r["Id"]: r["features"].toArray().round(9).tolist() for r in m.transform(
        once, counts=m.counts, norms=m.norms).collect()}
    counts = scale.stage(FT.doc_terms(once, [WORDS, CHARS], ["Id", "Category"]), "counts")
    assert entries(V.fit_features(once, [WORDS, CHARS], 20)) == entries(V.fit_features(once, [WORDS, CHARS], 20, counts=counts))


def test_no_pair_is_written_or_shuffled(docs, monkeypatch):
    """Neither the stored tables nor the shuffles of weights and chi-squared hold a row per pair or term."""
    stored, plain = [], scale.stage
    monkeypatch.setattr(scale, "stage", lambda *a: stored.append(plain(*a)) or stored[-1])
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 10)
    known = docs.filter("Id IS NOT NULL").dropDuplicates(["Id"])
    counts, idf = V.fit_idf(known, [WORDS, CHARS])
    weighted, scores = FT.weights(counts, idf), S.chi2_scores(FT.scaled(counts, idf), None, known)
    terms = idf.count()
    assert 0 < scores.count() <= terms < weighted.count() and all(t.count() < terms / 4 for t in stored)
    for df in (weighted, scores):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert "Join" not in plan or "term#" not in plan[plan.index("Join"):]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "Id long, Text string, Category string")
    counts, idf = V.fit_idf(none, [WORDS])
    assert idf.count() == FT.weights(counts, idf).count() == S.chi2_scores(FT.scaled(counts, idf), None, none).count() == 0
