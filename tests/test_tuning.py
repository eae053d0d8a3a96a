"""Candidates, searches and the choice of the best."""

import math

import pytest

from labelloom.operators import metrics as M
from labelloom.operators import tuning as TU

SPACE = {"x": [-1.0, 0.0, 1.0], "y": [-1.0, 0.0, 1.0], "z": [True, False]}


def value(candidates):
    """One score per fold; the same function on both folds."""
    return [[math.exp(-(c["x"] ** 2 + c["y"] ** 2)) + float(c["z"])] * 2 for c in candidates]


def test_grid_finds_the_maximum(spark):
    found = TU.search_candidates(spark, TU.grid(SPACE), value)
    assert len(found.candidates) == 18
    assert found.best == {"x": 0.0, "y": 0.0, "z": True} and found.best_score == 2.0
    assert found.table.filter("rank = 1").count() == 1
    assert found.table.columns == ["candidate", "fold_0", "fold_1", "mean_score", "std_score",
                                   "rank", "params"]


def test_evolution_finds_the_maximum(spark):
    found = TU.evolve(spark, SPACE, value, population=20, seed=1)
    assert found.best == {"x": 0.0, "y": 0.0, "z": True} and found.best_score == 2.0
    again = TU.evolve(spark, SPACE, value, population=20, seed=1)
    assert again.candidates == found.candidates


def test_evolution_scores_a_candidate_once(spark):
    seen = []

    def score(candidates):
        seen.extend(tuple(sorted(c.items())) for c in candidates)
        return value(candidates)
    TU.evolve(spark, SPACE, score, population=30, generations=4, seed=2)
    assert len(seen) == len(set(seen)) <= 18


def test_draw():
    a, b = TU.draw(SPACE, 5, 1), TU.draw(SPACE, 5, 1)
    assert a == b and len({str(c) for c in a}) == 5
    assert TU.draw(SPACE, 5, 2) != a and len(TU.draw(SPACE, 100, 1)) == 18


def test_ties_share_a_rank(spark):
    scores = spark.createDataFrame([(0, 0, .5), (0, 1, .7), (1, 0, .6), (1, 1, .6), (2, 0, .1),
                                    (2, 1, .1)], "candidate int, fold int, score double")
    table = {r["candidate"]: r for r in M.fold_table(scores, 2).collect()}
    assert [table[i]["rank"] for i in range(3)] == [1, 1, 3]
    assert abs(table[0]["std_score"] - .1) < 1e-12
    assert M.best_candidate(M.fold_table(scores, 2)).first()["candidate"] == 0


def test_unknown_method(spark):
    docs = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(8)], "Id long, Category string")
    with pytest.raises(ValueError):
        TU.search(docs, [], "random", {}, {"folds": 2})
