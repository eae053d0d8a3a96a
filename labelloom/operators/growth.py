"""Trees grown by DataFrame aggregates: leaf limits, split minimums and a random threshold per node.

Spark ML's forests have no ``max_leaf_nodes`` and no ``min_samples_split``, and draw no threshold per node.
:class:`GrownForest` grows all trees of an ensemble together, one level a pass:

* every training row is one row per tree that holds it (a bootstrap bag weighs it by a Poisson(1) draw
  hashed from row and tree), carrying the node it has reached;
* the class counts of every open node are one aggregate; the split candidates of every (tree, node,
  feature) are another, over the non-zero entries of the feature vectors only (zeros are counted as the
  node's total minus the rest), summed map-side before the shuffle;
* ``splitter="best"`` tries every border of per-feature quantile bins (``bins``; the value 0 is always a
  border), ``splitter="random"`` one threshold drawn uniformly between the node's own minimum and maximum
  of the feature, by a hash of (seed, tree, node, feature): extremely randomised trees;
* a node splits when it holds at least ``min_samples_split`` (weight), both children at least
  ``min_samples_leaf``, and the Gini decrease weighted by the node's share is above ``MIN_DECREASE``;
* with ``max_leaf_nodes``, nodes are expanded best first (largest weighted decrease first) up to
  ``max_leaf_nodes - 1`` expansions a tree. The gains do not depend on the order, so the driver replays the
  priority queue over the nodes known so far after every level; a node it does not pick now is never picked
  later, so only picked nodes send rows on, and the frontier stays within ``2 (max_leaf_nodes - 1)`` nodes a
  tree.

``max_features`` ("log2", "sqrt", a number or None for all) keeps each feature at a node with chance
``m / k`` by a hash, so a node sees ``m`` features on average; a node whose drawn features give no valid
split is searched again over all features, in one more pass for all such nodes of the level. The fitted model walks each tree inside the
row (arrays of the tree's nodes, one step a level): no join, no Python.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.operators.classifiers import CLASSIFIER_SEED, bag_weight, effective_depth

# The smallest weighted Gini decrease that splits a node, and trees per projection.
MIN_DECREASE = 1e-7
TREES_PER_PLAN = 25


def _uniform(*parts: Column) -> Column:
    """A number in [0, 1) from a hash of the parts."""
    return (F.xxhash64(*parts).bitwiseAND(F.lit((1 << 53) - 1)).cast("double") / float(1 << 53))


def _gini_sum(counts: Sequence[Column], total: Column) -> Column:
    """``n * gini`` of class counts: ``n - sum(c^2) / n``; 0 for an empty side."""
    squares = sum((c * c for c in counts), F.lit(0.0))
    return F.when(total > 0, total - squares / total).otherwise(F.lit(0.0))


class GrownForest:
    """An ensemble of decision trees grown level-wise by Spark aggregates (see the module)."""

    def __init__(self, n_estimators: int = 100, max_depth: int | None = 10, min_samples_leaf: int = 1,
                 min_samples_split: int = 2, max_leaf_nodes: int | None = None, splitter: str = "best",
                 max_features: str | int | None = "log2", bootstrap: bool = False, bins: int = 32,
                 seed: int = CLASSIFIER_SEED):
        if splitter not in ("best", "random"):
            raise ValueError(f"splitter is best or random, not {splitter}")
        if max_leaf_nodes is not None and int(max_leaf_nodes) < 2:
            raise ValueError("max_leaf_nodes must be at least 2")
        if int(min_samples_split) < 2:
            raise ValueError("min_samples_split must be at least 2")
        self.n_estimators, self.max_depth = int(n_estimators), effective_depth(max_depth)
        self.min_samples_leaf, self.min_samples_split = float(min_samples_leaf), float(min_samples_split)
        self.max_leaf_nodes = None if max_leaf_nodes is None else int(max_leaf_nodes)
        self.splitter, self.max_features, self.bootstrap = splitter, max_features, bootstrap
        self.bins, self.seed = int(bins), int(seed)

    def _features_kept(self, k: int) -> float:
        m = {"log2": max(1, int(math.log2(k))) if k > 1 else 1, "sqrt": max(1, int(math.sqrt(k))),
             None: k}.get(self.max_features) if not isinstance(self.max_features, int) else self.max_features
        return min(1.0, m / max(k, 1))

    def fit(self, df: DataFrame) -> GrownTrees:
        spark = df.sparkSession
        x = vector_to_array("features")
        k = df.select(F.size(x)).first()[0] if not df.isEmpty() else 0
        classes = int(df.agg(F.max("label")).first()[0] or 0) + 1
        entries = F.filter(F.transform(x, lambda v, i: F.struct(i.alias("f"), v.alias("v"))), lambda e: e["v"] != 0)
        nonzero = scale.stage(df.select("Id", F.inline(entries)), "grow-entries")
        share = self._features_kept(k)
        cuts = None
        if self.splitter == "best":
            probs = [i / self.bins for i in range(1, self.bins)]
            cuts = scale.pin(nonzero.groupBy("f").agg(F.array_sort(F.array_distinct(F.concat(
                F.percentile_approx("v", probs, 10000), F.array(F.lit(0.0))))).alias("_cuts")), 1_000_000)
        trees = F.explode(F.sequence(F.lit(0), F.lit(self.n_estimators - 1))).alias("tree")
        rows = df.select("Id", F.col("label").cast("int").alias("label"), trees)
        weight = bag_weight(F.col("tree"), self.seed) if self.bootstrap else F.lit(1.0)
        at = scale.stage(rows.withColumn("w", weight).filter(F.col("w") > 0)
                         .withColumn("node", F.lit(1).cast("long")), "grow-rows")
        counts = [F.sum(F.when(F.col("label") == c, F.col("w")).otherwise(0.0)).alias(f"_c{c}")
                  for c in range(classes)]
        known: dict[int, dict[int, dict]] = {t: {} for t in range(self.n_estimators)}
        picked: dict[int, set[int]] = {t: set() for t in range(self.n_estimators)}
        roots: dict[int, float] = {}
        for depth in range(self.max_depth + 1):
            stats = at.groupBy("tree", "node").agg(*counts).collect()
            if not stats:
                break
            for r in stats:
                c = [r[f"_c{i}"] for i in range(classes)]
                known[r["tree"]][r["node"]] = {"counts": c, "depth": depth, "gain": None}
                if depth == 0:
                    roots[r["tree"]] = sum(c)
            if depth == self.max_depth:
                break
            open_nodes = [(r["tree"], r["node"], *[r[f"_c{i}"] for i in range(classes)]) for r in stats
                          if sum(r[f"_c{i}"] for i in range(classes)) >= self.min_samples_split
                          and max(r[f"_c{i}"] for i in range(classes)) < sum(r[f"_c{i}"] for i in range(classes))]
            if not open_nodes:
                break
            totals = spark.createDataFrame(open_nodes, "tree int, node long, " + ", ".join(
                f"_t{c} double" for c in range(classes)))
            found = self._splits(at, nonzero, totals, cuts, classes, share).collect()
            if share < 1:
                # as in the usual forests: a node whose drawn features give no split looks at all of them
                done = {(r["tree"], r["node"]) for r in found}
                rest = [o for o in open_nodes if (o[0], o[1]) not in done]
                if rest:
                    others = spark.createDataFrame(rest, totals.schema)
                    found += self._splits(at, nonzero, others, cuts, classes, 1.0).collect()
            for r in found:
                node = known[r["tree"]][r["node"]]
                node["gain"] = r["_dec"] / roots[r["tree"]]
                node["split"] = (int(r["f"]), float(r["t"]))
            chosen = []
            for t in range(self.n_estimators):
                picked[t] = self._pick(known[t])
                chosen += [(t, n, *known[t][n]["split"]) for n in picked[t] if known[t][n]["depth"] == depth]
            if not chosen:
                break
            split = F.broadcast(spark.createDataFrame(chosen, "tree int, node long, f int, t double"))
            moved = (at.join(split, ["tree", "node"]).join(nonzero, ["Id", "f"], "left")
                     .withColumn("node", F.col("node") * 2 + F.when(F.coalesce("v", F.lit(0.0)) <= F.col("t"), 0)
                                 .otherwise(1))
                     .select("Id", "label", "tree", "w", "node"))
            at = scale.stage(moved, "grow-rows")
        return GrownTrees([_compact(known[t], picked[t], classes) for t in range(self.n_estimators)], classes)

    def _pick(self, nodes: dict[int, dict]) -> set[int]:
        """Nodes to expand: all that can split, or best first up to ``max_leaf_nodes - 1`` of them."""
        can = {n for n, d in nodes.items() if d["gain"] is not None and d["gain"] > MIN_DECREASE}
        if self.max_leaf_nodes is None:
            return can
        out, queue = set(), []
        if 1 in can:
            heapq.heappush(queue, (-nodes[1]["gain"], nodes[1]["depth"], 1))
        while queue and len(out) < self.max_leaf_nodes - 1:
            _, _, n = heapq.heappop(queue)
            out.add(n)
            for child in (2 * n, 2 * n + 1):
                if child in can:
                    heapq.heappush(queue, (-nodes[child]["gain"], nodes[child]["depth"], child))
        return out

    def _splits(self, at: DataFrame, nonzero: DataFrame, totals: DataFrame, cuts: DataFrame | None,
                classes: int, share: float) -> DataFrame:
        """``(tree, node, f, t, _dec)``: the best split of every open node (weighted Gini decrease)."""
        cls = range(classes)
        keep = _uniform(F.lit(self.seed), F.col("tree"), F.col("node"), F.col("f")) < share if share < 1 else F.lit(True)
        joined = (at.join(F.broadcast(totals.select("tree", "node")), ["tree", "node"])
                  .join(nonzero, "Id").filter(keep))
        sums = [F.sum(F.when(F.col("label") == c, F.col("w")).otherwise(0.0)).alias(f"_c{c}") for c in cls]
        if self.splitter == "best":
            binned = joined.join(F.broadcast(cuts), "f").withColumn(
                "bin", F.size(F.filter("_cuts", lambda c: c < F.col("v"))))
            hist = binned.groupBy("tree", "node", "f", "bin").agg(*sums)
            nz = hist.groupBy("tree", "node", "f").agg(*[F.sum(f"_c{c}").alias(f"_c{c}") for c in cls])
            zeros = (nz.join(F.broadcast(totals), ["tree", "node"]).join(F.broadcast(cuts), "f")
                     .select("tree", "node", "f", F.size(F.filter("_cuts", lambda c: c < 0)).alias("bin"),
                             *[(F.col(f"_t{c}") - F.col(f"_c{c}")).alias(f"_c{c}") for c in cls]))
            full = (hist.unionByName(zeros).groupBy("tree", "node", "f", "bin")
                    .agg(*[F.sum(f"_c{c}").alias(f"_c{c}") for c in cls]))
            upto = Window.partitionBy("tree", "node", "f").orderBy("bin").rowsBetween(
                Window.unboundedPreceding, Window.currentRow)
            left = full.select("tree", "node", "f", "bin", *[F.sum(f"_c{c}").over(upto).alias(f"_l{c}") for c in cls])
            cand = (left.join(F.broadcast(totals), ["tree", "node"]).join(F.broadcast(cuts), "f")
                    .withColumn("t", F.try_element_at("_cuts", F.col("bin") + 1)).filter(F.col("t").isNotNull())
                    .withColumn("_order", F.col("bin")))
        else:
            span = joined.groupBy("tree", "node", "f").agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"), *sums)
            drawn = (span.join(F.broadcast(totals), ["tree", "node"])
                     .withColumn("_zero", sum((F.col(f"_t{c}") - F.col(f"_c{c}") for c in cls), F.lit(0.0)) > 1e-9)
                     .withColumn("_lo", F.when(F.col("_zero"), F.least("_lo", F.lit(0.0))).otherwise(F.col("_lo")))
                     .withColumn("_hi", F.when(F.col("_zero"), F.greatest("_hi", F.lit(0.0))).otherwise(F.col("_hi")))
                     .filter(F.col("_hi") > F.col("_lo"))
                     .withColumn("t", F.col("_lo") + _uniform(F.lit(self.seed + 1), F.col("tree"), F.col("node"),
                                                              F.col("f")) * (F.col("_hi") - F.col("_lo"))))
            thresholds = drawn.select("tree", "node", "f", "t")
            below = (joined.join(thresholds, ["tree", "node", "f"]).filter(F.col("v") <= F.col("t"))
                     .groupBy("tree", "node", "f").agg(*[F.sum(F.when(F.col("label") == c, F.col("w"))
                                                               .otherwise(0.0)).alias(f"_b{c}") for c in cls]))
            cand = (drawn.join(below, ["tree", "node", "f"], "left")
                    .select("tree", "node", "f", "t", *[F.col(f"_t{c}") for c in cls],
                            *[(F.coalesce(F.col(f"_b{c}"), F.lit(0.0))
                               + F.when(F.col("t") >= 0, F.col(f"_t{c}") - F.col(f"_c{c}")).otherwise(0.0))
                              .alias(f"_l{c}") for c in cls])
                    .withColumn("_order", F.lit(0)))
        total = sum((F.col(f"_t{c}") for c in cls), F.lit(0.0))
        lefts = [F.col(f"_l{c}") for c in cls]
        rights = [F.col(f"_t{c}") - F.col(f"_l{c}") for c in cls]
        n_left = sum(lefts, F.lit(0.0))
        n_right = total - n_left
        tot = [F.col(f"_t{c}") for c in cls]
        dec = F.round(_gini_sum(tot, total) - _gini_sum(lefts, n_left) - _gini_sum(rights, n_right), 9)
        return (cand.withColumn("_dec", dec)
                .filter((n_left >= self.min_samples_leaf) & (n_right >= self.min_samples_leaf))
                .groupBy("tree", "node")
                .agg(F.max_by(F.struct("f", "t"), F.struct("_dec", -F.col("f"), -F.col("_order"))).alias("_s"),
                     F.max("_dec").alias("_dec"))
                .select("tree", "node", "_s.f", "_s.t", "_dec"))


def _compact(nodes: dict[int, dict], picked: set[int], classes: int) -> dict:
    """One tree as arrays over compact node numbers: feature (-1: leaf), threshold, children, class shares."""
    keep = [1]
    order, depth = [], 0
    while keep:
        order += keep
        keep = [c for n in keep if n in picked for c in (2 * n, 2 * n + 1) if c in nodes]
        depth += 1 if keep else 0
    place = {n: i for i, n in enumerate(order)}
    feat, thr, left, right, probs = [], [], [], [], []
    for n in order:
        inner = n in picked and 2 * n in place
        feat.append(nodes[n]["split"][0] if inner else -1)
        thr.append(nodes[n]["split"][1] if inner else 0.0)
        left.append(place[2 * n] if inner else place[n])
        right.append(place[2 * n + 1] if inner else place[n])
        c = nodes[n]["counts"] if n in nodes else [0.0] * classes
        s = sum(c)
        probs.append([v / s for v in c] if s > 0 else [1.0 / classes] * classes)
    return {"feat": feat, "thr": thr, "left": left, "right": right, "probs": probs, "depth": depth,
            "leaves": sum(1 for f in feat if f < 0)}


class GrownTrees:
    """A fitted :class:`GrownForest`: class shares averaged over trees, walked inside the row."""

    def __init__(self, trees: list[dict], classes: int):
        self.trees, self.classes = trees, classes

    def _walk(self, tree: dict, x: Column) -> Column:
        feat, thr, left, right = (F.lit(tree[k]) for k in ("feat", "thr", "left", "right"))
        steps = F.sequence(F.lit(1), F.lit(max(tree["depth"], 1)))
        end = F.aggregate(steps, F.lit(0), lambda n, _: F.when(
            F.element_at(feat, n + 1) < 0, n).otherwise(F.when(
                F.element_at(x, F.element_at(feat, n + 1) + 1) <= F.element_at(thr, n + 1),
                F.element_at(left, n + 1)).otherwise(F.element_at(right, n + 1))))
        return F.element_at(F.lit(tree["probs"]), end + 1)

    def transform(self, df: DataFrame) -> DataFrame:
        """Add ``probability`` (vector) and ``prediction`` (class number, first of equal shares)."""
        columns = df.columns
        out = df.withColumn("_shares", F.array(*[F.lit(0.0)] * self.classes))
        for i in range(0, len(self.trees), TREES_PER_PLAN):
            if i:
                out = scale.stage(out, "votes")
            x = vector_to_array("features")
            total = F.col("_shares")
            for tree in self.trees[i:i + TREES_PER_PLAN]:
                total = F.zip_with(total, self._walk(tree, x), lambda a, b: a + b)
            out = out.select(*columns, total.alias("_shares"))
        n = float(max(len(self.trees), 1))
        shares = F.transform("_shares", lambda v: v / n)
        best = (F.array_position(F.col("_shares"), F.array_max("_shares")) - 1).cast("double")
        return (out.withColumn("probability", array_to_vector(shares)).withColumn("prediction", best)
                .drop("_shares"))

    def leaves(self) -> list[int]:
        return [t["leaves"] for t in self.trees]

    def save(self, folder: str) -> None:
        spark = SparkSession.getActiveSession()
        rows = [(i, json.dumps(t)) for i, t in enumerate(self.trees)]
        spark.createDataFrame(rows, "tree int, body string").write.mode("overwrite").parquet(f"{folder}/trees")
        spark.createDataFrame([(self.classes,)], "classes int").write.mode("overwrite").parquet(f"{folder}/meta")

    @classmethod
    def load(cls, spark: SparkSession, folder: str) -> GrownTrees:
        trees = [json.loads(r["body"]) for r in spark.read.parquet(f"{folder}/trees").orderBy("tree").collect()]
        return cls(trees, spark.read.parquet(f"{folder}/meta").first()["classes"])

