"""Near-duplicate documents and vectors, and components, against brute force."""

import random

import numpy as np
import pytest
from labelloom.llm import bagminhash, flat_graph
from labelloom.llm.components import components


def plain_components(vertices, links):
    parent = {v: v for v in vertices}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in links:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {v: root(v) for v in vertices}


def test_components(spark):
    rng = random.Random(5)
    links = [(i, i + 1) for i in range(100, 140)] + [(0, i) for i in range(1, 60)] + [(200, 200), (300, 299)]
    links += [(rng.randint(400, 500), rng.randint(400, 500)) for _ in range(70)]
    found = components(spark.createDataFrame(links + [(None, 3)], "a bigint, b bigint")).collect()
    want = plain_components({v for p in links for v in p}, links)
    linked = {v for a, b in links if a != b for v in (a, b)}
    assert {r["vertex"]: r["component"] for r in found} == {v: want[v] for v in linked} and len(found) == len(linked)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(6)
    keys = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    left, right = rng.integers(0, 9, 400), rng.integers(0, 9, 400)
    want = np.minimum(left, right).sum() / np.maximum(left, right).sum()
    a = bagminhash.signature(keys[left > 0], left[left > 0], 4000)
    b = bagminhash.signature(keys[right > 0], right[right > 0], 4000)
    assert abs((a == b).mean() - want) < 0.04
    # The same set twice, and a heavier set that holds a lighter one.
    assert (bagminhash.signature(keys[:1], np.array([1]), 100) == bagminhash.signature(keys[:1], np.array([1]), 100)).all()
    heavy = (bagminhash.signature(keys[:9], np.full(9, 10), 4000) == bagminhash.signature(keys[:9], np.full(9, 5), 4000)).mean()
    assert abs(heavy - 0.5) < 0.04


def corpus(seed=7):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = []
    for g in range(12):
        base = rng.choices(vocabulary, k=rng.randint(30, 120))
        for _ in range(rng.choice([1, 2, 5, 60])):
            copy = list(base)
            for _ in range(rng.randint(0, 3)):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            texts.append(" ".join(copy))
    texts += ["one two", "One  two!", "", None, "", "spam spam spam spam spam spam spam", texts[0], texts[0]]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("small, block", [(bagminhash.SMALL, bagminhash.BLOCK), (1, 7)])
def test_classes_equal_brute_force(spark, monkeypatch, small, block):
    monkeypatch.setattr(bagminhash, "SMALL", small)
    monkeypatch.setattr(bagminhash, "BLOCK", block)
    texts = corpus()
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)],
                                 "doc_id bigint, text string, band string, key string")
    found = {r["doc_id"]: r for r in bagminhash.classes(docs).collect()}
    links = [(i, j) for i in range(len(texts)) for j in range(i)
             if (texts[i] or "") == (texts[j] or "") or bagminhash.similarity(texts[i] or "", texts[j] or "") >= 0.8]
    want = plain_components(range(len(texts)), links)
    assert {i: r["class_id"] for i, r in found.items()} == want
    assert sum(r["kept"] for r in found.values()) == len(set(want.values()))
    kept = bagminhash.keep_one(docs.union(docs.filter("doc_id < 20")))
    assert kept.columns == docs.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_class_edge_cases(spark):
    docs = spark.createDataFrame([(None, "a b c d e f"), (3, "a b c d e f"), (None, "x"), (4, None)], "doc_id bigint, text string")
    rows = bagminhash.classes(docs).collect()
    assert sorted((r["doc_id"] or -1, r["class_id"] or -1, r["kept"]) for r in rows) == [
        (-1, -1, True), (-1, 3, False), (3, 3, True), (4, 4, True)]
    assert sorted(r["doc_id"] or -1 for r in bagminhash.keep_one(docs).collect()) == [-1, 3, 4]
    assert bagminhash.classes(docs.limit(0)).count() == 0


def test_vectors_equal_brute_force(spark):
    rng = np.random.default_rng(8)
    centres = rng.normal(size=(150, 16))
    rows = np.concatenate([centres[rng.integers(0, 150, 900)] + rng.normal(size=(900, 16)) * 0.12,
                           centres[:1] + rng.normal(size=(400, 16)) * 0.05, rng.normal(size=(200, 16))])
    rows = np.concatenate([rows, rows[:40], rows[:1].repeat(50, 0)])
    vectors = [(i, [float(x) for x in v], "x") for i, v in enumerate(rows)]
    n = len(vectors)
    odd = [(n, None, "x"), (n + 1, [0.0] * 16, "x"), (n + 2, [float("nan")] * 16, "x"), (n + 3, [None] * 16, "x"), (n + 4, [], "x"),
           (n + 5, [1.0, 2.0], "x")]
    table = spark.createDataFrame(vectors + odd, "vec_id bigint, embedding array<double>, unit string")
    result = flat_graph.near_duplicates(table)
    found = {r["vec_id"]: r for r in result.collect()}
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    hits = unit @ unit.T >= 0.95
    want = hits.sum(1) - 1
    assert len(found) == n + 6 and all(found[i]["n_links"] <= want[i] for i in range(n))
    assert sum(found[i]["n_links"] for i in range(n)) >= 0.97 * want.sum()
    parts = plain_components(range(n), [(int(i), int(j)) for i, j in zip(*np.nonzero(hits)) if j < i])
    assert sum(found[i]["component_id"] == parts[i] for i in range(n)) >= 0.98 * n
    assert all(found[n + k]["n_links"] == 0 and found[n + k]["kept"] for k in range(6))
    got, there = flat_graph.audit(table, result)
    assert there > 0 and got >= 0.9 * there
    assert flat_graph.near_duplicates(table.limit(0)).count() == 0


def test_a_link_counts_for_both_ends():
    """Vertex 1 asks in its cell 0. Point 2 is at home in cell 5, where 1 is not; point 3 in cell 7, where 1 is."""
    import pandas as pd
    unit = np.array([1.0, 0.0]).tobytes()
    points = pd.DataFrame({"vertex": [1, 2, 3], "n": [4, 1, 1], "unit": [unit] * 3, "base": [0, 5, 7], "near": [[2, 3], [1], [1]]})
    asked = pd.DataFrame({"asked": [1], "copies": [4], "sought": [unit], "cells": [np.array([0, 7])]})
    found = flat_graph._search_rows(None, points, asked).set_index("vertex")
    assert found["links"].to_dict() == {1: 2, 2: 4, 3: 0} and (found["low"] == 1).all()


def test_counts_and_components_with_many_cells(spark, monkeypatch):
    monkeypatch.setattr(flat_graph, "CELL", 20)  # about 120 cells
    rng = np.random.default_rng(11)
    rows = np.repeat(rng.normal(size=(60, 8)), 20, 0) + rng.normal(size=(1200, 8)) * 0.28
    unit = rows / np.linalg.norm(rows, axis=1)[:, None]
    hits = unit @ unit.T >= 0.95
    np.fill_diagonal(hits, False)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id bigint, embedding array<double>")
    found = {r["vec_id"]: r for r in flat_graph.near_duplicates(table).collect()}
    links, want = np.array([found[i]["n_links"] for i in range(1200)]), hits.sum(1)
    assert (links <= want).all()
    assert links.sum() >= 0.955 * want.sum()
    assert all((found[i]["n_links"] > 0) or found[i]["component_id"] == i for i in range(1200))


def test_robust_prune_keeps_diverse_neighbours():
    points = np.array([[1, 0], [0.999, 0.02], [0.998, 0.03], [0, 1]], float)
    points /= np.linalg.norm(points, axis=1)[:, None]
    links = flat_graph.build(points)
    assert set(links[0][links[0] >= 0]) >= {1, 3} and 2 not in links[0][links[0] >= 0]


def test_a_worker_keeps_few_word_hashes(monkeypatch):
    """Up to 500,000 hashed words stayed in every worker, some 100 MB of an executor's memory each."""
    text = " ".join(f"word{i}" for i in range(60_000))
    monkeypatch.setattr(bagminhash, "_numbers", bagminhash._Numbers())
    keys, weights = bagminhash.shingles(text)
    assert len(bagminhash._numbers) <= 50_000
    monkeypatch.setattr(bagminhash, "REMEMBERED", 10)
    monkeypatch.setattr(bagminhash, "_numbers", bagminhash._Numbers())
    again = bagminhash.shingles(text)
    assert (again[0] == keys).all() and (again[1] == weights).all() and len(bagminhash._numbers) <= 10
