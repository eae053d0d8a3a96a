"""Near-duplicate vectors by a robust-pruned flat graph.

1. Equal vectors are one: every distinct direction (of the bytes of the vector) is one vertex with a count.
2. Cluster centres are drawn from a bounded sample by a hash and moved by a few rounds of k-means there;
   their number follows the number of vertices. A vertex belongs to the cells of its ``OVERLAP`` nearest
   centres. A cell with more than ``CELL`` vertices is cut into blocks by a hash of the vertex.
3. In each cell block a graph is built: each vertex's nearest vertices of the block, pruned robustly (a
   neighbour is dropped when a closer one lies ``ALPHA`` times nearer to it), at most ``DEGREE`` links.
   Each link gets its reverse; a vertex with more than twice ``DEGREE`` is pruned again. The lists that a
   vertex has in several cells are united.
4. Every vertex is searched in all blocks of its nearest cell, over the united lists: greedily with a beam
   from the block's medoids (vertices such that each other one has a cosine of ``COVER`` to one of them),
   and from there in range: every vertex found near the threshold is expanded. What is found is verified by
   the cosine in double precision.
5. Recall is audited: vertices whose id is divisible by 50 are compared with all vectors, in blocks.

A link counts for both ends. A vertex counts what its own search finds. Where a vertex is not in a cell to
which the found one is at home, the found one cannot find it and counts it then and there; two vertices at
home in one block count each other when either finds the other. Links between copies count each copy. A search task returns, for each vertex, the number of links and the smallest vertex that it reaches through
links of the task, so no group of near copies is written as pairs.

Defined cases: vectors that are null, empty, zero, of another length than the most common one, or hold a
null or non-finite component link with nothing and are kept. Repeated ids are vectors of their own but
share the id. Empty tables give empty results. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.llm.components import components

THRESHOLD = 0.95
CELL, OVERLAP, DEGREE, ALPHA, BEAM = 1_000, 2, 24, 1.2, 8
SAMPLE_ROWS, MAX_CENTRES, KMEANS_ROUNDS = 20_000, 4_096, 6
CANDIDATES = 48
COVER = 0.8
SLACK = 0.02  # the search goes on from vertices this far below the threshold


def matrix(column) -> np.ndarray:
    """Vectors written as little-endian doubles."""
    return np.frombuffer(b"".join(column), "<f8").reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def _unit_rows(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``unit``: the direction in double precision, null for a vector that links with nothing."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            units = []
            for v in frame["embedding"]:
                unit = None
                if v is not None and len(v) and not any(x is None for x in v):
                    v = np.asarray(v, np.float64)
                    if np.isfinite(v).all() and (peak := np.abs(v).max()) > 0:
                        v = v / peak
                        unit = ((v / np.sqrt((v * v).sum())) + 0.0).astype("<f8").tobytes()
                units.append(unit)
            yield pd.DataFrame({"vec_id": frame["vec_id"], "unit": units})

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", "embedding").mapInPandas(run, f"vec_id {kind}, unit binary")


def _centres(vertices: DataFrame, n: int) -> np.ndarray:
    """About one centre per ``CELL / 2`` vertices, from a bounded sample."""
    k = int(min(MAX_CENTRES, max(1, 2 * n // CELL)))
    share = min(1.0, SAMPLE_ROWS / n)
    rows = (vertices.filter(F.pmod(F.xxhash64("unit"), F.lit(1_000_000)) < share * 1_000_000)
            .select("unit").orderBy(F.xxhash64("unit", F.lit(1))).limit(2 * SAMPLE_ROWS).collect())
    sample = matrix([r[0] for r in rows] or [r[0] for r in vertices.select("unit").limit(1).collect()])
    centres = sample[np.linspace(0, len(sample) - 1, min(k, len(sample))).astype(int)]
    for _ in range(KMEANS_ROUNDS):
        near = (sample @ centres.T).argmax(1)
        moved = np.zeros_like(centres)
        np.add.at(moved, near, sample)
        length = np.linalg.norm(moved, axis=1, keepdims=True)
        centres = np.where(length > 0, moved / np.maximum(length, 1e-300), centres)
    return centres


def _assign(centres: np.ndarray):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            near = matrix(frame["unit"]) @ centres.T
            cells = np.argsort(-near, axis=1, kind="stable")[:, :OVERLAP]
            yield pd.DataFrame({"vertex": frame["vertex"], "n": frame["n"], "unit": frame["unit"],
                                "cells": list(cells.astype(np.int64))})

    return run


def robust_prune(points: np.ndarray, near: np.ndarray, sims: np.ndarray, degree: int = DEGREE) -> np.ndarray:
    """Per point at most ``degree`` of its candidates (nearest first), -1 where there is none.

    A candidate goes when a chosen one is ``ALPHA`` times closer to it than the point is.
    """
    n, c = near.shape
    among = np.einsum("ncd,ned->nce", points[near], points[near])
    far = np.sqrt(np.maximum(2 - 2 * sims, 0))
    apart = np.sqrt(np.maximum(2 - 2 * among, 0))
    open_, chosen = sims > -2, np.full((n, degree), -1, np.int64)
    rows = np.arange(n)
    for slot in range(min(degree, c)):
        pick = open_.argmax(1)
        any_ = open_[rows, pick]
        chosen[any_, slot] = near[rows, pick][any_]
        open_ &= ~(ALPHA * apart[rows, pick] <= far)
        open_[rows, pick] = False
        if not any_.any():
            break
    return chosen


def build(points: np.ndarray) -> np.ndarray:
    """The pruned graph of one block: neighbours by position, -1 for none."""
    n = len(points)
    width = min(CANDIDATES, n - 1)
    if width < 1:
        return np.full((n, DEGREE), -1, np.int64)
    out = []
    for at in range(0, n, 256):
        sims = points[at:at + 256] @ points.T
        own = np.arange(len(sims))
        sims[own, own + at] = -3
        near = np.argpartition(-sims, width - 1, axis=1)[:, :width]
        found = np.take_along_axis(sims, near, 1)
        order = np.argsort(-found, axis=1, kind="stable")
        near, found = np.take_along_axis(near, order, 1), np.take_along_axis(found, order, 1)
        out.append(robust_prune(points, near, found))
    return np.concatenate(out)


def both_ways(points: np.ndarray, links: np.ndarray) -> list[np.ndarray]:
    """The links of a block with their reverses, pruned again where there are more than twice ``DEGREE``."""
    who, slot = np.nonzero(links >= 0)
    what = links[who, slot]
    pairs = np.unique(np.concatenate([who * len(points) + what, what * len(points) + who]))
    who, what = pairs // len(points), pairs % len(points)
    out = np.split(what, np.searchsorted(who, np.arange(1, len(points))))
    for i, own in enumerate(out):
        if len(own) > 2 * DEGREE:
            sims = points[own] @ points[i]
            order = np.argsort(-sims, kind="stable")
            kept = robust_prune(points, own[order][None], sims[order][None], 2 * DEGREE)[0]
            out[i] = kept[kept >= 0]
    return out


def medoids(points: np.ndarray) -> np.ndarray:
    """Vertices such that every vertex is close to one of them."""
    near, open_, out = points @ points.T >= COVER, np.ones(len(points), bool), []
    while open_.any():
        out.append(int(open_.argmax()))
        open_ &= ~near[out[-1]]
        open_[out[-1]] = False
    return np.array(out)


def search(points: np.ndarray, links: list[np.ndarray], queries: np.ndarray) -> np.ndarray:
    """Range-expanding greedy search of all queries at once: (query, vertex) is True where it is in range."""
    n, q = len(points), len(queries)
    sims, opened = np.full((q, n), -2.0), np.zeros((q, n), bool)
    starts = medoids(points)
    sims[:, starts] = queries @ points[starts].T
    reach = np.zeros((n, max([1, *map(len, links)])), np.int64) - 1
    for i, own in enumerate(links):
        reach[i, :len(own)] = own
    beam = min(BEAM, n)
    while True:
        best = np.partition(sims, n - beam, axis=1)[:, n - beam][:, None]
        ready = (sims > -2) & ~opened & ((sims >= best) | (sims >= THRESHOLD - SLACK))
        who, what = np.nonzero(ready)
        if not len(who):
            return sims >= THRESHOLD - 1e-9
        opened[who, what] = True
        who, what = np.repeat(who, reach.shape[1]), reach[what].ravel()
        fresh = np.unique((who * n + what)[(what >= 0) & (sims[who, what] == -2)])
        who, what = fresh // n, fresh % n
        for at in range(0, len(who), 200_000):
            w, v = who[at:at + 200_000], what[at:at + 200_000]
            sims[w, v] = np.einsum("ij,ij->i", queries[w], points[v])


def _build_rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("vertex", ignore_index=True)
    points = matrix(frame["unit"])
    ids = frame["vertex"].to_numpy()
    return pd.DataFrame({"vertex": ids, "near": [ids[row] for row in both_ways(points, build(points))]})


def _search_rows(key, points: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """One cell block with its graph against a block of the vertices at home in the cell."""
    if not len(points) or not len(queries):
        return pd.DataFrame({"vertex": [], "links": [], "low": []})
    points = points.sort_values("vertex", ignore_index=True)
    ids, units = points["vertex"].to_numpy(), matrix(points["unit"])
    place = {v: i for i, v in enumerate(ids)}
    links = [np.array([place[v] for v in near if v in place], np.int64) for near in points["near"]]
    asked, sought = queries["asked"].to_numpy(), matrix(queries["sought"])
    hit = search(units, links, sought)
    who, what = np.nonzero(hit)
    good = np.einsum("ij,ij->i", sought[who], units[what]) >= THRESHOLD
    hit[:] = False
    hit[who[good], what[good]] = True
    at = np.array([place.get(v, -1) for v in asked])
    if (at >= 0).all():  # the asked are points of this block: a link found from one end holds for both
        hit[:, at] |= hit[:, at].T
    other = hit & (ids[None, :] != asked[:, None])
    count = other.astype(np.int64) @ points["n"].to_numpy(np.int64)
    # A point at home in a cell that the asked vertex is not in cannot find it and counts it here.
    who, what = np.nonzero(other)
    unseen = (np.stack(queries["cells"].to_numpy())[who] != points["base"].to_numpy()[what, None]).all(1)
    back = np.bincount(what[unseen], queries["copies"].to_numpy()[who[unseen]], len(ids)).astype(np.int64)
    # The smallest vertex reachable through the links of this task, for both sides.
    hit = other | (ids[None, :] == asked[:, None])
    low_q, low_p, big = asked.astype(np.int64), ids.astype(np.int64), np.iinfo(np.int64).max
    while True:
        new_q = np.minimum(low_q, np.where(hit, low_p[None, :], big).min(1))
        new_p = np.minimum(low_p, np.where(hit, new_q[:, None], big).min(0))
        if (new_q == low_q).all() and (new_p == low_p).all():
            break
        low_q, low_p = new_q, new_p
    some, moved = (count > 0) | (low_q != asked), (back > 0) | (low_p != ids)
    return pd.DataFrame({"vertex": np.concatenate([asked[some], ids[moved]]),
                         "links": np.concatenate([count[some], back[moved]]),
                         "low": np.concatenate([low_q[some], low_p[moved]])})


def graph_search(vertices: DataFrame, n: int) -> DataFrame:
    """``(vertex, links, low)``: links found, counting copies, and the smallest vertex linked with."""
    blocks = scale.stage(vertices.mapInPandas(
        _assign(_centres(vertices, n)), "vertex bigint, n bigint, unit binary, cells array<bigint>"), "cells")
    placed = blocks.select("vertex", "n", "unit", "cells", F.posexplode("cells").alias("rank", "cell"))
    sizes = placed.groupBy("cell").agg(F.count(F.lit(1)).alias("size"))
    cut = scale.pin(sizes.select("cell", F.ceil(F.col("size") / CELL).cast("bigint").alias("cuts")), MAX_CENTRES)
    placed = placed.join(F.broadcast(cut), "cell").withColumn("block", F.pmod(F.xxhash64("vertex"), F.col("cuts")))
    lists = placed.select("cell", "block", "vertex", "unit").groupBy("cell", "block").applyInPandas(_build_rows, "vertex bigint, near array<bigint>")
    united = scale.stage(lists.groupBy("vertex").agg(
        F.array_distinct(F.flatten(F.collect_list("near"))).alias("near")), "graph")
    points = placed.join(united, "vertex").select(
        "cell", "block", "vertex", "n", "unit", F.col("cells")[0].alias("base"), "near")
    # The home vertices of a cell, in blocks too, meet each of its blocks.
    homes = placed.filter("rank = 0").select(
        F.col("cell").alias("home"), F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("at"),
        F.col("block").alias("own"), F.col("vertex").alias("asked"), F.col("n").alias("copies"), "cells",
        F.col("unit").alias("sought"))
    parts = cut.select("cell", F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("part"))
    points = points.join(F.broadcast(parts), "cell")
    found = points.groupBy("cell", "block", "part").cogroup(homes.groupBy("home", "at", "own")).applyInPandas(
        _search_rows, "vertex bigint, links bigint, low bigint")
    return found.groupBy("vertex").agg(F.sum("links").alias("links"), F.collect_set("low").alias("lows"))


def _prepared(vectors: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    units = scale.stage(_unit_rows(vectors), "units")
    usual = units.filter("unit is not null").groupBy(F.length("unit").alias("w")).count().orderBy(
        F.desc("count"), "w").first()
    width = usual[0] if usual else 0
    usable = units.filter((F.length("unit") == width) & F.col("unit").isNotNull())
    vertices = usable.groupBy("unit").agg(F.min("vec_id").alias("low_id"), F.count(F.lit(1)).alias("n"))
    vertices = scale.stage(vertices.withColumn("vertex", F.monotonically_increasing_id()), "vertices")
    return units, vertices, vertices.count()


def near_duplicates(vectors: DataFrame) -> DataFrame:
    """One row per vector: ``vec_id``, ``n_links``, ``component_id``, ``kept``."""
    units, vertices, n = _prepared(vectors)
    alone = F.col("vec_id")
    if not n:
        return units.select("vec_id", F.lit(0).cast("bigint").alias("n_links"), alone.alias("component_id"),
                            F.lit(True).alias("kept"))
    found = scale.stage(graph_search(vertices, n), "found")
    groups = components(found.select(F.col("vertex").alias("a"), F.explode("lows").alias("b")))
    about = (vertices.join(found.select("vertex", "links"), "vertex", "left").join(groups, "vertex", "left")
             .select("unit", "low_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("component", "vertex").alias("component"),
                     F.col("component").isNotNull().alias("linked")))
    about = scale.stage(about, "about")
    ids = about.groupBy("component").agg(F.min("low_id").alias("component_id"))
    known = about.filter("n_links > 0 or linked").join(ids, "component").select("unit", "n_links", "component_id")
    component = F.coalesce("component_id", "vec_id")
    return units.join(known, "unit", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"), component.eqNullSafe(alone).alias("kept"))


def audit(vectors: DataFrame, result: DataFrame, every: int = 50, block: int = 2_000) -> tuple[int, int]:
    """(links found, links there are) of the vectors whose id is divisible by ``every``, by brute force in
    blocks of queries. The rows of the other side are read once per block and never shuffled."""
    units, vertices, _ = _prepared(vectors)
    asked = units.filter((F.col("vec_id") % every == 0) & F.col("unit").isNotNull()).select("vec_id", "unit")
    there, part = 0, []

    def count(rows) -> int:
        sought, own = matrix([r["unit"] for r in rows]), len(rows)

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                hits = (matrix(frame["unit"]) @ sought.T >= THRESHOLD).sum(1) * frame["n"]
                yield pd.DataFrame({"hits": [int(hits.sum())]})

        total = vertices.select("unit", "n").mapInPandas(run, "hits bigint").agg(F.sum("hits")).first()[0] or 0
        return total - own

    for row in asked.toLocalIterator():
        part.append(row)
        if len(part) == block:
            there += count(part)
            part = []
    there += count(part) if part else 0
    found = result.filter(F.col("vec_id") % every == 0).agg(F.sum("n_links")).first()[0] or 0
    return found, there
