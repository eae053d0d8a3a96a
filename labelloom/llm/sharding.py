"""Sharding by sampled splitters: documents go to shards of near-equal bytes.

Law ``bytes``. A document's size is the UTF-8 length of its text (null: 0) plus 8. Documents are put in one
order by the key (crc32 of the text, xxhash64 of the text, doc_id, a row tag fixed when the narrow table is
written), so that equal texts lie side by side, and a shard holds the documents whose byte prefix P (the sizes
of all documents before it in that order) lies in ``[s T / S, (s + 1) T / S)``, T all bytes, S the shard count.
Each shard therefore differs from ``T / S`` by less than one document's size.

The prefix is found without ordering the table in one place:

1. size-weighted samples of keys (a document is drawn with chance ``min(1, size m / bytes)``) give the key
   quantiles of a range by bytes; they cut it into ``fanout`` sub-ranges (the whole key space into
   ``S * fanout``);
2. the exact bytes of every sub-range are summed by one aggregate, so each sub-range knows the bytes before it;
3. a sub-range wholly inside one shard is done; at most ``S - 1`` sub-ranges hold a cut, and only these are
   subdivided again, by a new weighted sample of their own rows, until they hold at most ``leaf_bytes``;
4. inside such small ranges a running sum of sizes gives the exact prefix of each document.

The slot numbers a shard's documents gaplessly from 0 in the order of the written narrow table's partitions
and the key inside a partition; counts per (shard, partition) give the offsets. A group of equal texts (copies)
is one run of the order and is split between shards like any run; the row tag makes every key unique, so no
range is ever too large to cut. Only DataFrame functions run on the rows; the driver sees samples of a bounded
number of keys (``oversample`` per sub-range) and per-range totals.

Defined cases: a null text has size 8 and crc32 0 (that of no bytes); null ids are documents like any other
(key: before all ids); repeated rows are separate documents; an empty table gives no rows; extra columns are
ignored.
"""

from __future__ import annotations

import random

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom import scale

SHARDS = 24
LAW = "bytes"
FANOUT = 8
OVERSAMPLE = 64
LEAF_BYTES = 64 << 20
SEED = 20260


_FIELDS = ("_crc", "_hash", "_id", "_tag")


def _key() -> Column:
    return F.struct(*[F.col(c).cast("long").alias(c) for c in _FIELDS])


def _literal(value: tuple) -> Column:
    return F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip(_FIELDS, value)])


def _bucket(key: Column, bounds: list[tuple], lo: int = 0) -> Column:
    """How many of the sorted ``bounds`` are at most ``key``: a binary search written as nested conditions."""
    if not bounds:
        return F.lit(lo)
    mid = len(bounds) // 2
    pivot = _literal(bounds[mid])
    return F.when(key < pivot, _bucket(key, bounds[:mid], lo)).otherwise(_bucket(key, bounds[mid + 1:], lo + mid + 1))


def _inside(key: Column, lo: tuple | None, hi: tuple | None) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (key >= _literal(lo))
    if hi is not None:
        cond = cond & (key < _literal(hi))
    return cond


def _quantiles(sample: list[tuple], parts: int) -> list[tuple]:
    """Keys that cut a weighted, sorted sample into ``parts`` runs of near-equal weight (distinct, ascending)."""
    total = sum(w for _, w in sample)
    if total <= 0 or parts <= 1:
        return []
    bounds, seen, step = [], 0.0, total / parts
    nxt = step
    for key, weight in sample:
        if seen >= nxt and (not bounds or key > bounds[-1]):
            bounds.append(key)
            while nxt <= seen:
                nxt += step
        seen += weight
    return bounds[:parts - 1]


def narrow(docs: DataFrame) -> DataFrame:
    """The columns the shards are decided on, written once so that the row tag is fixed."""
    text = F.col("text").cast("string")
    return scale.stage(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.encode(text, "UTF-8"), F.lit(b""))).cast("long").alias("text_crc32"),
        F.xxhash64(F.coalesce(text, F.lit(""))).alias("_hash"),
        F.monotonically_increasing_id().alias("_tag"))
        .withColumn("_crc", F.col("text_crc32"))
        .withColumn("_id", F.coalesce("doc_id", F.lit(-(1 << 63)))), "shard-keys")


def assign(docs: DataFrame, shards: int = SHARDS, fanout: int = FANOUT, oversample: int = OVERSAMPLE,
           leaf_bytes: int = LEAF_BYTES, seed: int = SEED) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` for every row of ``docs`` (law ``bytes``)."""
    keys = narrow(docs)
    key = _key()
    total = keys.agg(F.sum("size")).first()[0] or 0
    out_cols = ["doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), F.col("shard").cast("int").alias("shard"),
                F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard")]
    if total == 0:
        return keys.withColumn("shard", F.lit(0)).withColumn("slot", F.lit(0)).select(*out_cols)

    def shard_of(prefix: int) -> int:
        return min(shards - 1, prefix * shards // total)

    # (lo, hi, bytes before, bytes, rows, parts): ranges still to be cut; lo/hi None for the open ends.
    pending = [(None, None, 0, total, None, shards * fanout)]
    done: list[tuple] = []  # (lo, hi, bytes before, shard or None for exact ranges)
    rng = random.Random(seed)
    level = 0
    while pending:
        level += 1
        # 1. size-weighted samples of every pending range, at most ``oversample`` keys a sub-range expected
        chance = F.lit(0.0)
        for i, (lo, hi, _, nbytes, _, parts) in enumerate(pending):
            chance = F.when(_inside(key, lo, hi), F.least(F.lit(1.0), F.col("size") * (parts * oversample / nbytes))
                            ).otherwise(chance) if i else F.least(F.lit(1.0), F.col("size") * (parts * oversample / nbytes))
        which = F.lit(0)
        for i, (lo, hi, *_rest) in enumerate(pending):
            if i:
                which = F.when(_inside(key, lo, hi), F.lit(i)).otherwise(which)
        within = F.lit(False)
        for lo, hi, *_rest in pending:
            within = within | _inside(key, lo, hi)
        rows = keys.filter(within)
        picked = (rows.withColumn("_p", chance)
                  .filter(F.rand(rng.randrange(1 << 30)) < F.col("_p"))
                  .select(which.alias("_r"), "_crc", "_hash", "_id", "_tag",
                          (F.col("size") / F.col("_p")).alias("_w"))
                  .collect())
        samples: dict[int, list] = {}
        for r in picked:
            samples.setdefault(r["_r"], []).append(((r["_crc"], r["_hash"], r["_id"], r["_tag"]), r["_w"]))
        # 2. sub-ranges by weighted quantiles, and their exact totals
        cuts = {i: _quantiles(sorted(samples.get(i, [])), pending[i][5]) for i in range(len(pending))}
        sub = F.lit(0)
        for i, (lo, hi, *_rest) in enumerate(pending):
            sub = F.when(_inside(key, lo, hi), _bucket(key, cuts[i])).otherwise(sub) if i else _bucket(key, cuts[i])
        totals = {(r["_r"], r["_s"]): (r["_b"], r["_n"]) for r in
                  rows.groupBy(which.alias("_r"), sub.alias("_s"))
                  .agg(F.sum("size").alias("_b"), F.count(F.lit(1)).alias("_n")).collect()}
        # 3. place whole sub-ranges, keep cutting those that hold a shard boundary
        nxt = []
        for i, (lo, hi, before, _, _, _) in enumerate(pending):
            edges = [lo, *cuts[i], hi]
            for s in range(len(edges) - 1):
                nbytes, nrows = totals.get((i, s), (0, 0))
                if nrows == 0:
                    continue
                first, last = shard_of(before), shard_of(before + nbytes - 1)
                if first == last:
                    done.append((edges[s], edges[s + 1], before, first))
                elif nbytes <= leaf_bytes or nrows <= 1 or level >= 64:
                    done.append((edges[s], edges[s + 1], before, None))
                else:
                    nxt.append((edges[s], edges[s + 1], before, nbytes, nrows, fanout))
                before += nbytes
        pending = nxt

    # 4. every document finds its range; exact ranges add the running sum of sizes
    done.sort(key=lambda d: (d[0] is not None, d[0] or ()))
    starts = [d[0] for d in done[1:]]
    assert starts == sorted(starts)
    at = _bucket(key, starts)
    fixed = F.array(*[F.lit(-1 if d[3] is None else d[3]) for d in done])
    base = F.array(*[F.lit(d[2]) for d in done])
    placed = keys.withColumn("_range", at).withColumn("_fixed", F.element_at(fixed, F.col("_range") + 1))
    exact = Window.partitionBy("_range").orderBy("_crc", "_hash", "_id", "_tag").rowsBetween(
        Window.unboundedPreceding, -1)
    prefix = F.element_at(base, F.col("_range") + 1) + F.coalesce(F.sum("size").over(exact), F.lit(0))
    loose = (placed.filter(F.col("_fixed") < 0)
             .withColumn("_prefix", prefix)
             .withColumn("shard", F.expr(f"least({shards - 1}, (_prefix * {shards}) div {total})"))
             .drop("_prefix"))
    whole = placed.filter(F.col("_fixed") >= 0).withColumn("shard", F.col("_fixed"))
    shard = scale.stage(whole.unionByName(loose).drop("_fixed", "_range")
                        .withColumn("_part", F.shiftright("_tag", 33)), "shards")
    # slots: counts per (shard, partition of the narrow table) give each run's first slot
    counts = shard.groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.withColumn("_first", F.coalesce(F.sum("_n").over(
        Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    numbered = shard.withColumn("_k", F.row_number().over(
        Window.partitionBy("shard", "_part").orderBy("_crc", "_hash", "_id", "_tag")))
    return (numbered.join(offsets.select("shard", "_part", "_first"), ["shard", "_part"])
            .withColumn("slot", F.col("_first") + F.col("_k") - 1)
            .select(*out_cols))

