"""Trees grown by aggregates against a plain best-first builder, and random thresholds per node."""

import heapq
import random

from pyspark.ml.linalg import Vectors

from labelloom.operators.growth import GrownForest


def _data(n=90, seed=3):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        x = [rng.choice([0.0, 0.0, 1.0, 2.0, 3.5]), rng.choice([0.0, 0.5, 1.5]), rng.choice([0.0, 4.0, 5.0, 6.0])]
        label = (1 if x[0] > 1.5 else 0) + (1 if x[2] >= 5 and x[1] > 0 else 0)
        if rng.random() < 0.1:
            label = rng.randrange(3)
        rows.append((i, float(label), x))
    return rows


def _gini_sum(c):
    n = sum(c)
    return n - sum(v * v for v in c) / n if n else 0.0


def _brute(rows, classes, max_depth, min_leaf, min_split, max_leaf):
    """Exact best-first tree: thresholds at every distinct value and 0, ties to smaller feature and threshold."""
    cuts = [sorted({r[2][f] for r in rows if r[2][f] != 0} | {0.0}) for f in range(3)]
    total = len(rows)

    def counts(part):
        c = [0.0] * classes
        for r in part:
            c[int(r[1])] += 1
        return c

    def best(part, depth):
        c = counts(part)
        if depth >= max_depth or len(part) < min_split or max(c) == len(part):
            return None
        found = None
        for f in range(3):
            for t in cuts[f]:
                left = [r for r in part if r[2][f] <= t]
                right = [r for r in part if r[2][f] > t]
                if len(left) < min_leaf or len(right) < min_leaf:
                    continue
                dec = round(_gini_sum(c) - _gini_sum(counts(left)) - _gini_sum(counts(right)), 9)
                key = (dec, -f, -cuts[f].index(t))
                if found is None or key > found[0]:
                    found = (key, f, t, left, right)
        if found is None or found[0][0] / total <= 1e-7:
            return None
        return found[0][0] / total, found[1], found[2], found[3], found[4]

    tree = {1: (rows, 0, best(rows, 0))}
    queue = [(-tree[1][2][0], 0, 1)] if tree[1][2] else []
    expanded = 0
    while queue and (max_leaf is None or expanded < max_leaf - 1):
        _, depth, n = heapq.heappop(queue)
        expanded += 1
        _, f, t, left, right = tree[n][2]
        for child, part in ((2 * n, left), (2 * n + 1, right)):
            tree[child] = (part, depth + 1, best(part, depth + 1))
            if tree[child][2]:
                heapq.heappush(queue, (-tree[child][2][0], depth + 1, child))
    inner = {n for n in tree if 2 * n in tree}

    def shares(x):
        n = 1
        while n in inner:
            f, t = tree[n][2][1], tree[n][2][2]
            n = 2 * n if x[f] <= t else 2 * n + 1
        c = counts(tree[n][0])
        return [v / sum(c) for v in c]
    return shares, len(tree) - len(inner)


def _frame(spark, rows):
    return spark.createDataFrame([(i, y, Vectors.dense(x)) for i, y, x in rows], ["Id", "label", "features"])


def test_best_first_equals_brute_force(spark):
    rows = _data()
    df = _frame(spark, rows)
    for max_leaf, min_split, min_leaf, depth in ((4, 2, 1, 10), (None, 12, 3, 4), (3, 2, 5, 2), (7, 5, 1, 6)):
        model = GrownForest(1, depth, min_samples_leaf=min_leaf, min_samples_split=min_split,
                            max_leaf_nodes=max_leaf, max_features=None, bins=400).fit(df)
        shares, leaves = _brute(rows, 3, depth, min_leaf, min_split, max_leaf)
        assert model.leaves() == [leaves]
        if max_leaf:
            assert leaves <= max_leaf
        got = {r["Id"]: list(r["probability"]) for r in model.transform(df).collect()}
        for i, _, x in rows:
            assert [round(v, 9) for v in got[i]] == [round(v, 9) for v in shares(x)]


def test_random_thresholds_differ_between_nodes(spark):
    rows = _data(300, seed=5)
    model = GrownForest(3, 6, splitter="random", max_features=None, seed=11).fit(_frame(spark, rows))
    for tree in model.trees:
        inner = [(f, t) for f, t in zip(tree["feat"], tree["thr"]) if f >= 0]
        assert len(inner) >= 3
        assert len({t for _, t in inner}) == len(inner)  # a fresh threshold at every node
        # thresholds are drawn, not taken at data values
        values = {x[f] for _, _, x in rows for f in range(3)}
        assert sum(t not in values for _, t in inner) >= len(inner) - 1
    out = model.transform(_frame(spark, rows)).collect()
    right = sum(r["prediction"] == y for r, (_, y, _) in zip(sorted(out, key=lambda r: r["Id"]), rows))
    assert right / len(rows) > 0.7


def test_bootstrap_leaf_limit_and_empty(spark):
    rows = _data(120)
    model = GrownForest(5, 8, max_leaf_nodes=5, bootstrap=True).fit(_frame(spark, rows))
    assert all(2 <= n <= 5 for n in model.leaves()) and len(model.trees) == 5
    from pyspark.ml.linalg import VectorUDT
    from pyspark.sql.types import DoubleType, LongType, StructField, StructType
    empty = spark.createDataFrame([], StructType([StructField("Id", LongType()), StructField("label", DoubleType()),
                                                  StructField("features", VectorUDT())]))
    assert GrownForest(2, 3).fit(empty).transform(empty).collect() == []
