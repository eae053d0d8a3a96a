"""The forms of counting, weighing and scoring that large tables take, against the plain ones."""

import pytest
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.functions import text as T
from labelloom.operators import features as FT
from labelloom.operators import selection as S
from labelloom.operators import vectors as V

WORDS = FT.Branch("words", "Text", "words", (1, 3), ("the",))
LIST = FT.Branch("list", "Text", "list", (1, 2))
CHARS = FT.Branch("chars", "Text", "chars", (3, 5))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"The caf\u00e9; a na\u00efve word{i % 7} word{i % 3};xy z the the ab{i}", "ab"[i % 2]) for i in range(40)]
    rows += [(None, "only here", "a"), (3, "the same id again", "b"), (50, None, "a"), (51, "", "b"),
             (52, "unlabelled term", None)]
    return spark.createDataFrame(rows, "Id long, Text string, Category string").cache()


@pytest.fixture
def large(monkeypatch):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 10)


@pytest.mark.parametrize("branch", [WORDS, LIST, CHARS, FT.Branch("c", "Text", "chars", (6, 9))])
def test_counts_are_those_of_the_columns(docs, branch):
    plain = docs.select("Id", F.lit(branch.name).alias("branch"), F.inline(T.count_terms(branch.terms())))
    counted = FT.term_counts(FT.doc_terms(docs, [branch], ["Id"]))
    order = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert counted.dtypes == plain.dtypes and order(counted) == order(plain)


def test_branch_counts_are_those_of_the_pairs(docs):
    pairs = FT.term_counts(FT.doc_terms(docs, [WORDS, LIST, CHARS], ["Id"]))
    want = sorted(map(tuple, FT.feature_counts(pairs).collect()))
    assert sorted(map(tuple, FT.branch_counts(docs, [WORDS, LIST, CHARS]).collect())) == want


def test_no_scores_are_found_twice(docs, large, monkeypatch):
    """A table that is aggregated by term is not counted for hot keys, which found all of it again."""
    def never(*_):
        raise AssertionError("read once more")

    monkeypatch.setattr(scale, "hot_keys", never)
    counts, idf = V.fit_idf(docs, [WORDS])
    known = FT.scaled(counts, idf)
    for score in (S.chi2_scores, S.mutual_information):
        assert score(known, idf, docs).count()


def test_pairs_meet_the_idf_table_once(docs, large, monkeypatch):
    counts, idf = V.fit_idf(docs, [WORDS])
    met, plain = [], FT.with_idf
    monkeypatch.setattr(FT, "with_idf", lambda *a: met.append(1) or plain(*a))
    FT.weights(counts, idf).count()
    assert len(met) == 1


def test_classes_side_by_side(docs, monkeypatch):
    counts, idf = V.fit_idf(docs, [WORDS])
    get = lambda: {r["term"]: r["score"] for r in S.chi2_scores(FT.scaled(counts, idf), idf, docs).collect()}
    wide = get()
    monkeypatch.setattr(S, "SIDE_BY_SIDE", 0)
    long = get()
    assert wide.keys() == long.keys() and wide["unlabelled"] is None and long["unlabelled"] is None
    assert all(abs(wide[t] - long[t]) < 1e-9 for t in wide if long[t] is not None)


@pytest.mark.parametrize("k", [5, 10_000])
def test_vectors_by_known_lengths(docs, k):
    once = docs.filter("Id is not null and Text is not null and Category is not null").dropDuplicates(["Id"])
    model = V.fit_features(once, [WORDS, CHARS], k)
    plain = {r["Id"]: r["features"].toArray() for r in model.transform(once).collect()}
    known = {r["Id"]: r["features"].toArray()
             for r in model.transform(once, counts=model.counts, norms=model.norms).collect()}
    assert plain.keys() == known.keys() and all(abs(plain[i] - known[i]).max() < 1e-12 for i in plain)


def test_branch_counts_read_their_table_once(spark, docs):
    """Every branch reads a stored column; a table that is joined together is not made again for each."""
    rows = spark.sparkContext.accumulator(0)
    seen = F.udf(lambda text: rows.add(1) or text).asNondeterministic()
    made = docs.withColumn("Text", seen("Text"))
    FT.branch_counts(made, [WORDS, LIST, CHARS]).collect()
    assert rows.value == docs.count()


def test_chi_squared_by_own_frequencies(docs, large, monkeypatch):
    """Frequencies are counted with the sums: no idf table is joined, rows without a key count for them."""
    counts, idf = V.fit_idf(docs, [WORDS])
    known = FT.scaled(counts, idf)
    get = lambda idf: {r["term"]: r["score"] for r in S.chi2_scores(known, idf, docs).collect()}
    for side_by_side in (32, 0):
        monkeypatch.setattr(S, "SIDE_BY_SIDE", side_by_side)
        joined, own = get(idf), get(None)
        assert joined.keys() == own.keys() and "only" not in own
        assert all(own[t] is None if joined[t] is None else abs(own[t] - joined[t]) < 1e-9 for t in joined)


def test_ranks_move_rows_once(docs, monkeypatch):
    def never(*_, **__):
        raise AssertionError("a window over ranges shuffles every row again")

    monkeypatch.setattr(scale, "running_totals", never)
    scores = docs.selectExpr("'b' AS branch", "concat(coalesce(Text, ''), coalesce(string(Id), 'x')) AS term", "Id % 3 AS score")
    got = sorted((r["rank"], r["score"], r["term"]) for r in S.rank_terms(scores).collect())
    rows = [(r["score"], r["term"]) for r in scores.collect()]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]), reverse=True)
    assert got == [(i + 1, s, t) for i, (s, t) in enumerate(rows)]
