"""Joins, lookups and dictionaries."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.operators import enrich as E
from labelloom.sources import articles as A


def brute_lookup(titles, corpus):
    sets = {i: frozenset(t.split()) for i, t in corpus}
    df = Counter(w for s in sets.values() for w in s)
    idf = {w: math.log((1 + len(sets)) / (1 + n)) + 1 for w, n in df.items()}
    out = {}
    for i, t in titles:
        best = min(((-round(sum(idf[w] for w in set(t.split()) & s), 9), j) for j, s in sets.items()
                    if set(t.split()) & s), default=None)
        out[i] = best and best[1]
    return out


@pytest.mark.parametrize("rare,growth", [(200, 50), (3, 4), (1, 1000)])
def test_most_relevant_is_exact(spark, monkeypatch, rare, growth):
    """Frequent words, copies holding a third of the corpus, titles without rare words or match."""
    monkeypatch.setattr(E, "POSTINGS_GROWTH", growth)
    monkeypatch.setattr(scale, "HOT_ROWS", 1 if growth == 4 else 10_000)
    dice = random.Random(7)

    def text(n):
        return " ".join(f"w{int(dice.paretovariate(0.6)) % 90:02d}" for _ in range(n))
    corpus = [(i, "w01 w02 w77 copy" if i % 3 == 0 else text(dice.randrange(3, 12)))
              for i in range(240)]
    titles = ([(i, text(dice.randrange(1, 8))) for i in range(60)]
              + [(100, "w01"), (101, "w01 w02"), (102, "nowhere"), (103, ""), (104, "copy")]
              + [(200 + i, "w01 w02 w03") for i in range(30)])
    found = E.most_relevant(spark.createDataFrame(titles, "Id long, Title string"),
                            spark.createDataFrame(corpus, "cit_id long, title string"),
                            rare_postings=rare)
    assert {r["Id"]: r["cit_id"] for r in found.collect()} == brute_lookup(titles, corpus)


def test_lookup_gives_a_side_table(spark):
    corpus = spark.createDataFrame(
        [(1, "alpha beta", [("Humans",), ("Cells",)], [["k1", "k2"], ["k3"]]),
         (2, "gamma delta", None, None)],
        "cit_id long, title string, mesh array<struct<DescriptorName:string>>, "
        "keyword_lists array<array<string>>")
    titles = spark.createDataFrame([(7, "beta"), (8, "gamma"), (9, "none")],
                                   "Id long, Title string")
    side = E.lookup(titles, corpus)
    assert {r["Id"]: (r["Terms"], r["Keywords"]) for r in side.collect()} == {
        7: ("Humans;Cells", "k1;k2"), 8: ("", ""), 9: ("", "")}
    assert tuple(E.coverage(side).first()) == (3, 1, 1)
    last = E.running_coverage(side).orderBy(F.desc("Id")).first()
    assert (last["articles"], last["with_keywords"], last["with_terms"]) == (3, 1, 1)


@pytest.mark.parametrize("rows", [200_000, 1])
def test_dictionary(spark, monkeypatch, rows):
    monkeypatch.setattr(scale, "BROADCAST_ROWS", rows)
    lemmas = spark.createDataFrame([("ran", "v", "run"), ("mice", "n", "mouse")],
                                   "token string, pos string, lemma string")
    synonyms = spark.createDataFrame(
        [("run", "v", "x-ray"), ("mouse", "n", "the"), ("car", "n", "Auto_mobile")],
        "lemma string, pos string, synonym string")
    lexicon = spark.createDataFrame([("ran", "VBD")], "token string, tag string")
    docs = spark.createDataFrame([(1, ["ran", "mice", "car", "other"]), (2, []), (3, ["mice"])],
                                 "Id long, Tokens array<string>")
    out = E.normalise(docs, "Tokens", E.compose_dictionary(lemmas, synonyms, lexicon, ["the"]))
    assert {r["Id"]: r["Tokens"] for r in out.collect()} == {
        1: ["x-ray", "x-ray", "Auto_mobile", "other"], 2: [], 3: []}
    once = E.normalise(docs, "Tokens", E.compose_dictionary(lemmas, synonyms, None, [], once=True))
    assert {r["Id"]: r["Tokens"] for r in once.collect()}[1] == ["ran", "the", "Auto_mobile", "other"]


def test_word_classes(spark):
    rows = spark.createDataFrame([("NN",), ("VBD",), ("RB",), ("JJ",), ("IN",), (None,)], "t string")
    assert [r[0] for r in rows.select(E.word_class(F.col("t"))).collect()] == list("nvrann")


def test_side_table_join(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "Id long, Text string")
    side = spark.createDataFrame([(1, "x"), (1, "y"), (2, None)], "Id long, Terms string")
    inner = A.load(left, side)
    assert sorted((r["Id"], r["Terms"]) for r in inner.collect()) == [(1, "x"), (1, "y"), (2, "")]
    assert A.load(left, side, "left").count() == 4
    with pytest.raises(ValueError):
        A.join_side_table(left, side.withColumn("Text", F.lit("")))
