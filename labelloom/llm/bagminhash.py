"""Near-duplicate documents by BagMinHash signatures of their word shingles, with repeats counted.

A text is lower-cased and split into words; its shingles are runs of five words, each with its number of
occurrences as weight. The weight axis is cut at 1, 2, 4, 8, ...: every (shingle, block of the axis) has a
Poisson process of its own, with the block's width as rate, and each of its points carries a level within
the block. A shingle with weight w owns the points at levels below w, so a partly covered block is thinned
and a block costs no more than its points. Points fall on signature positions at random, and each position
keeps its earliest point: two positions are equal with probability (sum of minima) / (sum of maxima) of
the weights. Points are made only up to a time by which all positions are likely filled; where one is not,
the time is doubled, so signatures are exact.

Signatures are cut into bands; texts that share a band are candidates. In each bucket all texts are
compared with its smallest key first. A bucket whose texts then lie in one component is done. In another
one, texts of different components are compared: as pairs where the bucket holds at most ``SMALL`` texts;
else in blocks of at most about ``BLOCK`` texts outside the largest component against as many of all, inside
tasks that return only the links that join components (fewer than there are components in the task). So no
bucket is multiplied out and none is cut. Every link is verified on the exact multisets: overlap / union >= 0.8.

Equal texts are one text throughout (by the MD5 of the text), so copies cost nothing. Texts of fewer than
five words are one shingle of all their words; texts without a word are linked to equal texts only. A null
text is an empty one. Documents with a null id are grouped but never give the group its id unless all
members lack one. Repeated rows are copies. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, OrderedDict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.llm.components import components
from labelloom.llm.inputs import pieces, text_or_empty

WORD = re.compile(r"\w+")
SHINGLE, SIMILARITY = 5, 0.8
BANDS, ROWS = 20, 5
SMALL, BLOCK = 32, 256


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


GOLDEN = 0x9E3779B97F4A7C15


REMEMBERED = 50_000  # words whose hashes a worker keeps; a hash is cheap, and workers keep what they hold


class _Numbers(dict):
    """Hashes of words; common ones are computed once for each task."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED:
            self.clear()
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


_numbers = _Numbers()


def shingles(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, weights) of the distinct shingles of a text, ordered by hash."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    coded = np.fromiter(map(_numbers.__getitem__, words), np.uint64, len(words))
    width = min(SHINGLE, len(words))
    key = np.full(len(words) - width + 1, width, np.uint64)
    for k in range(width):
        key = _mix(key + coded[k: len(coded) - width + 1 + k]) + np.uint64(GOLDEN)
    return np.unique(key, return_counts=True)


def _points(keys: np.ndarray, weights: np.ndarray, owner: np.ndarray, until: np.ndarray, size: int):
    """All points of some weighted sets up to each one's time: (place, time, point)."""
    low, width, salt, found = 0, 1, 1, []
    while len(keys):
        # One block of the weight axis: [0,1), [1,2), [2,4), [4,8), ...
        base = _mix(keys + np.uint64(salt * GOLDEN & (1 << 64) - 1))
        live, time, step = np.arange(len(keys)), np.zeros(len(keys)), 0
        while len(live):
            step += 1
            draw = _mix(base[live] + np.uint64(step * GOLDEN & (1 << 64) - 1))
            time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0 ** -53) / width
            early = np.flatnonzero(time <= until[owner[live]])
            live, time, draw = live[early], time[early], draw[early]
            more = _mix(draw + np.uint64(0xD6E8FEB86659FD93))
            level = low + (more >> np.uint64(32)).astype(np.float64) * (width * 2.0 ** -32)
            owned = np.flatnonzero(level < weights[live])
            place = ((more[owned] & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            found.append((owner[live[owned]] * size + place, time[owned], draw[owned]))
        low, width, salt = low + width, max(1, low + width), salt + 1
        heavier = np.flatnonzero(weights > low)
        keys, weights, owner = keys[heavier], weights[heavier], owner[heavier]
    return [np.concatenate(c) for c in zip(*found)]


def signatures(sets: list[tuple[np.ndarray, np.ndarray]], size: int = BANDS * ROWS) -> np.ndarray:
    """The BagMinHash signatures of weighted sets that are not empty, one per row."""
    out = np.zeros((len(sets), size), np.uint64)
    rows = np.arange(len(sets))
    until = np.array([size / float(w.sum()) * (np.log(size) + 2.5) for _, w in sets])
    while len(rows):
        some = [sets[r] for r in rows]
        owner = np.repeat(np.arange(len(rows)), [len(k) for k, _ in some])
        place, time, point = _points(np.concatenate([k for k, _ in some]), np.concatenate([w for _, w in some]),
                                     owner, until, size)
        order = np.argsort(-time, kind="stable")  # the earliest point of a place is written last
        made, filled = np.zeros(len(rows) * size, np.uint64), np.zeros(len(rows) * size, bool)
        made[place[order]], filled[place] = point[order], True
        whole = filled.reshape(-1, size).all(1)
        out[rows[whole]] = made.reshape(-1, size)[whole]
        rows, until = rows[~whole], 2 * until[~whole]
    return out


def signature(keys: np.ndarray, weights: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    return signatures([(keys, weights)], size)[0]


def bands(texts: list[str]) -> list[np.ndarray | None]:
    """One hash per band and text; equal hashes make two texts candidates. None without a word."""
    sets = [shingles(t) for t in texts]
    some = [i for i, (k, _) in enumerate(sets) if len(k)]
    out: list[np.ndarray | None] = [None] * len(texts)
    if some:
        rows = signatures([sets[i] for i in some]).reshape(len(some), BANDS, ROWS)
        made = np.arange(1, BANDS + 1, dtype=np.uint64)[None] * np.uint64(GOLDEN)
        for r in range(ROWS):
            made = _mix(made + rows[:, :, r]) + np.uint64(GOLDEN)
        for i, row in zip(some, made.view(np.int64)):
            out[i] = row
    return out


def units(text: str) -> np.ndarray:
    """The multiset as a set: the i-th occurrence of a shingle is an element of its own."""
    keys, weights = shingles(text)
    nth = np.arange(weights.sum()) - np.repeat(np.cumsum(weights) - weights, weights)
    return _mix(np.repeat(keys, weights) + nth.astype(np.uint64) * np.uint64(GOLDEN)).view(np.int64)


def similarity(left: str, right: str) -> float:
    """Weighted Jaccard similarity of two texts, counted plainly."""
    (a, x), (b, y) = shingles(left), shingles(right)
    a, b = Counter(dict(zip(a.tolist(), x.tolist()))), Counter(dict(zip(b.tolist(), y.tolist())))
    total = sum((a | b).values())
    return sum((a & b).values()) / total if total else 0.0


class _Recent:
    """Remembers the last keys that a task has seen."""

    def __init__(self, size: int = 50_000):
        self.size, self.keys = size, OrderedDict()

    def new(self, key: str) -> bool:
        if key in self.keys:
            self.keys.move_to_end(key)
            return False
        self.keys[key] = None
        if len(self.keys) > self.size:
            self.keys.popitem(last=False)
        return True


def _band_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in pieces(_first_rows(frames), 256):
        made = [(k, b) for k, b in zip(frame["key"], bands(list(frame["text"]))) if b is not None]
        if made:
            yield pd.DataFrame({"key": [k for k, _ in made], "bands": [b for _, b in made]})


def _first_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen = _Recent()
    for frame in pieces(frames, 512):
        fresh = np.array([seen.new(k) for k in frame["key"]], bool)
        if fresh.any():
            yield frame[fresh]


def _unit_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for frame in pieces(_first_rows(frames), 256):
        yield pd.DataFrame({"key": frame["key"], "units": [units(t) for t in frame["text"]]})


def _unit_sets(keys: DataFrame, texts: DataFrame) -> DataFrame:
    """``(key, units)`` of the texts with these keys."""
    wanted = scale.stage(keys.distinct(), "wanted")
    if scale.fits(wanted):
        near = texts.join(F.broadcast(wanted), "key", "left_semi")
    else:
        near = texts.mapInPandas(_first_rows, texts.schema).join(wanted, "key", "left_semi")
    made = near.mapInPandas(_unit_rows, "key string, units array<bigint>")
    return scale.stage(made.dropDuplicates(["key"]), "units")


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose multisets overlap enough."""
    left = sets.select(F.col("key").alias("a"), F.col("units").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("units").alias("y"))
    both = F.size(F.array_intersect("x", "y"))
    either = F.size("x") + F.size("y") - both
    # Sizes alone rule out most pairs that do not match. A quotient is exact at the threshold.
    possible = F.least(F.size("x"), F.size("y")) / F.greatest(F.size("x"), F.size("y")) >= SIMILARITY
    return (pairs.join(left, "a").join(right, "b").filter(possible)
            .filter(both / either >= SIMILARITY).select("a", "b"))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key")))


def _block_rows(_key, members: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
    """Links between two blocks of a bucket, as many as join what the blocks' links join."""
    out: list[tuple[str, str]] = []
    if len(members) and len(asked):
        members = members.sort_values("key", ignore_index=True)
        sizes = np.array([len(u) for u in members["units"]])
        flat = np.concatenate(list(members["units"]))
        order = np.argsort(flat, kind="stable")
        flat, owner = flat[order], np.repeat(np.arange(len(members)), sizes)[order]
        keys, components_ = members["key"].to_numpy(), members["component"].to_numpy()
        joined: dict[str, str] = {}

        def head(c: str) -> str:
            while c in joined:
                c = joined[c]
            return c

        for key, component, own in zip(asked["asked"], asked["other"], asked["own"]):
            low, high = np.searchsorted(flat, own, "left"), np.searchsorted(flat, own, "right")
            both = np.bincount(np.concatenate([owner[i:j] for i, j in zip(low, high)]), minlength=len(members))
            near = both / (sizes + len(own) - both) >= SIMILARITY
            for i in np.flatnonzero(near & (components_ != component)):
                one, other = sorted((head(component), head(components_[i])))
                if one != other:
                    joined[other] = one
                    out.append((max(key, keys[i]), min(key, keys[i])))
    return pd.DataFrame(out, columns=["a", "b"], dtype=object)


def _block_links(rest: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between components in large buckets: ``rest`` has band, key, component, n, minor, largest."""
    rows = rest.join(sets, "key")

    def cut(size: str):
        return F.ceil(F.col(size) / BLOCK).cast("int")

    def block(size: str):
        return F.pmod(F.xxhash64("key"), cut(size)).cast("int")

    def every(size: str):
        return F.explode(F.sequence(F.lit(0), cut(size) - 1))

    members = rows.withColumn("at", block("n")).select(
        "band", "at", every("minor").alias("part"), "key", "component", "units")
    asked = rows.filter(F.col("component") != F.col("largest")).withColumn("mine", block("minor")).select(
        F.col("band").alias("bucket"), every("n").alias("there"), "mine", F.col("key").alias("asked"),
        F.col("component").alias("other"), F.col("units").alias("own"))
    return members.groupBy("band", "at", "part").cogroup(asked.groupBy("bucket", "there", "mine")).applyInPandas(
        _block_rows, "a string, b string")


def groups(docs: DataFrame, text: str = "text") -> DataFrame:
    """``(key, component)``: MD5 of each text that has near duplicates, and the smallest of its group."""
    texts = docs.select(F.md5(text_or_empty(text)).alias("key"), text_or_empty(text).alias("text"))
    made = texts.mapInPandas(_band_rows, "key string, bands array<bigint>")
    members = scale.stage(made.dropDuplicates(["key"]).select("key", F.explode("bands").alias("band")), "bands")
    hubs = (members.groupBy("band").agg(F.min("key").alias("hub"), F.count(F.lit(1)).alias("n"))
            .filter("n > 1").select("band", "hub"))
    # The smallest key of a bucket is compared with all others here and so need not be again.
    members = scale.stage(members.join(hubs, "band").filter(F.col("key") != F.col("hub")), "buckets")
    pairs = scale.stage(members.select(F.col("key").alias("a"), F.col("hub").alias("b")).distinct(), "pairs")
    links = scale.stage(_verified(pairs, _unit_sets(_ends(pairs), texts)), "verified")
    found = components(links)
    placed = members.select("band", "key").join(found.withColumnRenamed("vertex", "key"), "key", "left").withColumn(
        "component", F.coalesce("component", "key"))
    shares = placed.groupBy("band", "component").agg(F.count(F.lit(1)).alias("n"))
    mixed = (shares.groupBy("band").agg(F.sum("n").alias("n"), F.max(F.struct("n", "component")).alias("most"))
             .filter("most.n < n").select("band", "n", F.col("most.component").alias("largest"),
                                          (F.col("n") - F.col("most.n")).alias("minor")))
    rest = scale.stage(placed.join(mixed, "band"), "mixed")
    few = rest.filter(F.col("n") <= SMALL)
    other = few.select("band", F.col("key").alias("b"), F.col("component").alias("other"))
    more = (few.join(other, "band").filter((F.col("b") < F.col("key")) & (F.col("component") != F.col("other")))
            .select(F.col("key").alias("a"), "b").distinct().join(pairs, ["a", "b"], "left_anti"))
    more, large = scale.stage(more, "pairs"), rest.filter(F.col("n") > SMALL)
    sets = _unit_sets(_ends(more).union(large.select("key")), texts)
    new = scale.stage(_verified(more, sets).union(_block_links(large, sets)), "verified")
    # What is known of a component is a star; the new links join stars.
    return found if new.isEmpty() else components(
        found.select(F.col("vertex").alias("a"), F.col("component").alias("b")).union(new))


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.md5(text_or_empty(text)).alias("key"))
    return scale.stage(rows.join(groups(docs, text).withColumnRenamed("vertex", "key"), "key", "left").select(
        "doc_id", "key", F.coalesce("component", "key").alias("component")), "keyed")


def _classes(keyed: DataFrame) -> DataFrame:
    heads = keyed.groupBy("component").agg(F.min("doc_id").alias("class_id"), F.min("key").alias("head"),
                                           F.count(F.lit(1)).alias("class_size"))
    # Most groups hold one document; only the others need the join.
    lone = heads.filter("class_size = 1").select(
        F.col("class_id").alias("doc_id"), F.col("head").alias("key"), "class_id", "class_size")
    shared = keyed.join(heads.filter("class_size > 1").drop("head"), "component").select(
        "doc_id", "key", "class_id", "class_size")
    return lone.union(shared).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def classes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id``, ``class_id`` (smallest id of its group), ``class_size``, ``kept``.

    ``kept`` marks one id of every group. Rows that repeat an id share its mark.
    """
    return _classes(_keyed(docs, doc_id, text)).drop("key")


def keep_one(docs: DataFrame) -> DataFrame:
    """Pipeline stage: one document of each group stays (repeated rows once), with all columns."""
    def row(key):
        return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), key).alias("_ll_row")

    gone = _classes(_keyed(docs, "doc_id", "text")).filter("not kept").select(row(F.col("key"))).distinct()
    left = docs.withColumn("_ll_row", row(F.md5(text_or_empty("text")))).join(gone, "_ll_row", "left_anti")
    return left.dropDuplicates(["_ll_row"]).select(*docs.columns)
