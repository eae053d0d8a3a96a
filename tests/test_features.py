"""TF-IDF, selection and the two forms of the feature matrix against brute force."""

import math
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.operators import features as FT
from labelloom.operators import selection as S
from labelloom.operators import vectors as V

BRANCH = FT.Branch("b", "Tokens", "list", (1, 1))
OTHER = FT.Branch("c", "Tokens", "chars", (3, 3))


@pytest.fixture(scope="module")
def docs(spark):
    dice = random.Random(3)
    rows = []
    for i in range(60):
        kind = "abc"[dice.randrange(3)] if i % 3 else "a"
        words = [f"{kind}{dice.randrange(6)}" if dice.random() < 0.5 else f"w{dice.randrange(30)}"
                 for _ in range(dice.randrange(1, 20))]
        rows.append((i, ";".join(["common", *words]), kind))
    return spark.createDataFrame(rows, "Id long, Tokens string, Category string").cache()


def brute_weights(rows):
    counts = {r["Id"]: Counter(r["Tokens"].split(";")) for r in rows}
    df = Counter(t for c in counts.values() for t in c)
    idf = {t: math.log((1 + len(rows)) / (1 + n)) + 1 for t, n in df.items()}
    out = {}
    for i, c in counts.items():
        norm = math.sqrt(sum((n * idf[t]) ** 2 for t, n in c.items()))
        out.update({(i, t): n * idf[t] / norm for t, n in c.items()})
    return out


def fitted(docs, branches=(BRANCH,)):
    counts, idf = V.fit_idf(docs, branches)
    return FT.weights(counts, idf), idf


def scaled(docs):
    counts, idf = V.fit_idf(docs, (BRANCH,))
    return FT.scaled(counts, idf), idf


def test_weights(docs):
    weighted, _ = fitted(docs)
    want = brute_weights(docs.collect())
    got = {(r["Id"], r["term"]): r["w"] for r in weighted.collect()}
    assert got.keys() == want.keys()
    assert all(abs(got[k] - want[k]) < 1e-12 for k in want)


def test_large_vocabulary_path(docs, monkeypatch):
    """Frequent terms by broadcast and the others by shuffle: the same weights."""
    weighted, idf = fitted(docs)
    want = {(r["Id"], r["term"]): r["w"] for r in weighted.collect()}
    monkeypatch.setattr(scale, "BROADCAST_ROWS", 3)
    monkeypatch.setattr(FT, "HOT_TERMS", 20)
    split = FT.weights(FT.doc_terms(docs, [BRANCH], ["Id", "Category"]), idf)
    got = {(r["Id"], r["term"]): r["w"] for r in split.collect()}
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-12 for k in want)


def brute_chi2(rows, weights):
    size = Counter(r["Category"] for r in rows)
    kind = {r["Id"]: r["Category"] for r in rows}
    observed = defaultdict(float)
    total = defaultdict(float)
    for (i, t), w in weights.items():
        observed[t, kind[i]] += w
        total[t] += w
    return {t: sum((observed[t, c] - total[t] * n / len(rows)) ** 2 / (total[t] * n / len(rows))
                   for c, n in size.items()) for t in total}


def test_chi2(docs):
    rows = docs.collect()
    want = brute_chi2(rows, brute_weights(rows))
    got = {r["term"]: r["score"] for r in S.chi2_scores(*scaled(docs), docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_mutual_information(docs):
    rows = docs.collect()
    weights = brute_weights(rows)
    want = {}
    for term in {t for _, t in weights}:
        joint = Counter((round(weights.get((r["Id"], term), 0.0), 12), r["Category"]) for r in rows)
        x, y = Counter(), Counter()
        for (a, b), n in joint.items():
            x[a] += n
            y[b] += n
        want[term] = sum(n / len(rows) * math.log(n * len(rows) / (x[a] * y[b]))
                         for (a, b), n in joint.items())
    got = {r["term"]: r["score"] for r in S.mutual_information(*scaled(docs), docs).collect()}
    assert got.keys() == want.keys() and all(abs(got[t] - want[t]) < 1e-9 for t in want)


def test_selection_and_rank_agree(spark, monkeypatch):
    scores = spark.createDataFrame([("b", f"t{i:03d}", float(i % 5)) for i in range(200)],
                                   "branch string, term string, score double")
    order = sorted(((r["score"], r["branch"], r["term"]) for r in scores.collect()), reverse=True)
    want = {t for _, _, t in order[:37]}
    assert {r["term"] for r in S.select_k_best(scores, 37).collect()} == want
    monkeypatch.setattr(S, "MERGED_TOP_K", 10)
    assert {r["term"] for r in S.select_k_best(scores, 37).collect()} == want
    ranks = {r["term"]: r["rank"] for r in S.rank_terms(scores).collect()}
    assert all(ranks[t] == i + 1 for i, (_, _, t) in enumerate(order))


def test_sweep(spark):
    scores = spark.createDataFrame([("b", f"t{i}", float(i)) for i in range(30)],
                                   "branch string, term string, score double")
    got = S.sweep_k(scores, (5, 10), lambda best: best.count())
    assert [(r["k"], r["score"]) for r in got.orderBy("k").collect()] == [(5, 5.0), (10, 10.0)]


@pytest.mark.parametrize("k", [7, 1000])
def test_vector_form_equals_long_form(docs, k):
    weighted, idf = fitted(docs, (BRANCH, OTHER))
    model = V.fit_features(docs, (BRANCH, OTHER), k)
    place = {(r["branch"], r["term"]): r["position"] for r in model.selected_terms().collect()}
    want = {(r["Id"], place[r["branch"], r["term"]]): r["w"] for r in weighted.collect()
            if (r["branch"], r["term"]) in place}
    got = {}
    for row in model.transform(docs).collect():
        vector = row["features"].toArray()
        assert len(vector) == model.size == min(k, len(place))
        got.update({(row["Id"], i): v for i, v in enumerate(vector) if v})
    assert got.keys() == want.keys() and all(abs(got[x] - want[x]) < 1e-12 for x in want)


def test_unseen_terms_are_ignored(spark, docs):
    model = V.fit_features(docs, [BRANCH], 1000)
    new = spark.createDataFrame([(1, "common;never seen"), (2, "never seen"), (3, "")],
                                "Id long, Tokens string")
    got = {r["Id"]: r["features"].toArray() for r in model.transform(new).collect()}
    assert abs(max(got[1]) - 1.0) < 1e-12 and not got[2].any() and not got[3].any()


def test_empty_item_is_a_term(spark):
    rows = spark.createDataFrame([(1, ""), (2, None)], "Id long, Tokens string")
    got = FT.term_counts(FT.doc_terms(rows, [BRANCH], ["Id"])).collect()
    assert [(r["Id"], r["term"], r["tf"]) for r in got] == [(1, "", 1)]


def test_feature_counts(docs):
    pairs = FT.term_counts(FT.doc_terms(docs, [BRANCH], ["Id"]))
    row = FT.feature_counts(pairs).first()
    assert row["n_features"] == len({t for r in docs.collect() for t in r["Tokens"].split(";")})
    assert row["n_rows"] == 60


def test_kept_terms_are_the_wanted_ones_as_often_as_they_occur(spark):
    docs = spark.createDataFrame([(1, "ab cab  abc é"), (2, None), (3, ""), (4, "ab ab")], "Id int, Text string")
    chars = FT.Branch("c", "Text", "chars", (2, 4))
    words = FT.Branch("w", "Text", "words", (1, 2))
    found = docs.select("Id", FT.kept_terms(chars, [" ab", "ab", " e ", "zz"]).alias("chars"),
                        FT.kept_terms(words, ["ab", "ab ab", "cab abc"]).alias("words"))
    rows = {r["Id"]: (sorted(r["chars"]), sorted(r["words"])) for r in found.collect()}
    assert rows == {1: ([" ab", " ab", " e ", "ab", "ab", "ab"], ["ab", "cab abc"]), 2: ([], []), 3: ([], []),
                    4: ([" ab", " ab", "ab", "ab"], ["ab", "ab", "ab ab"])}


def test_counting_few_items_together_gives_the_same_terms(monkeypatch):
    import pyarrow as pa
    items = pa.array([["a b", "c", "a b"], None, [], ["a", "b", "c"], ["é𝒳\0"]], pa.list_(pa.string()))
    batch = pa.RecordBatch.from_arrays([items], ["items"])
    for kind, third in (("list", {"a": 1, "b": 1, "c": 1, "a b": 1, "b c": 1}), ("chars", {" a ": 1, " b ": 1, " c ": 1})):
        for together in (1, 50_000):
            monkeypatch.setattr(FT, "COUNTED_ITEMS", together)
            count = FT._counting([FT.Branch("x", "y", kind, (1, 2) if kind == "list" else (3, 4))], 0)
            counted = [r for b in count(iter([batch])) for r in b.column(1).to_pylist()]
            counted = [{t["term"]: t["tf"] for t in r} for r in counted]
            assert counted[1:4] == [{}, {}, third]
            assert counted[0] == ({"a b": 2, "c": 1, "a b c": 1, "c a b": 1} if kind == "list" else
                                  {" a ": 2, "a b": 2, " b ": 2, " a b": 2, "a b ": 2, " c ": 1})
    assert counted[4] == {" é𝒳": 1, "é𝒳\0": 1, "𝒳\0 ": 1, " é𝒳\0": 1, "é𝒳\0 ": 1}
