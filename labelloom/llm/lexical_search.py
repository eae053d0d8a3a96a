"""Ranked lexical search by per-term geometric blocking with exact block-maximum bounds.

Scoring (integer BM25 form). Terms are the maximal runs of characters that are not ASCII punctuation, blanks
or control characters (``[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+``), with only A-Z lower-cased. N counts the
documents with a term, L all their terms, n one document's terms, df the documents holding a term, tf its
occurrences in a document. ``w = floor(1000 ln((2N + 2) / (2 df + 1)))``; a document's
``m = 25 + (75 n N) div L``; its impact for a term ``(10^9 tf) div (1000 tf + 8 m)``; an item's score of a
document sums ``w * impact`` over the item's terms, repeats included.

Search without scoring every (item, document) pair:

1. postings of the terms any item holds carry their exact impact;
2. documents are clustered by similarity: ordered by their heaviest query term (largest w), then by its
   impact, and cut into blocks of ``block`` consecutive documents; every block stores the coordinatewise
   maximum of its documents' impacts (one summary row per block and term);
3. an item's bound on a block sums ``mult * w * max impact`` over its terms: no document of the block can
   score more;
4. round one scores the documents of each item's best-bounded block exactly; the tenth best score found
   (1 when fewer than ten score above 0) is the item's threshold;
5. round two scores exactly the documents of every block whose bound reaches the threshold. A block is
   skipped only when its exact bound is below it, so the top ten (ties by ascending doc_id) are exact.

Defined cases: a null or empty text has no term; a document without terms never ranks; an item without
terms gets no rows; a document is its id and text: repeated rows (equal id and text) are one document; null
ids rank last among equal scores; an empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelloom import scale

# The term pattern's separators (ASCII non-alphanumerics) and the scoring constants.
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOP = 10
BLOCK = 64
# Documents whose counted terms leave a counting task together, so that its memory stays small.
COUNTED_ROWS = 256


def terms(text: Column) -> Column:
    """The terms of a text in order, repeats kept; none for null."""
    parts = F.split(F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER), SEPARATORS)
    return F.filter(parts, lambda t: F.length(t) > 0)


def _counter(vocab: frozenset[bytes] | None) -> Callable:
    """Per row the number of its terms and the counts of those in ``vocab`` (None: all). Separators and capitals
    are ASCII, so a text is cut as UTF-8 bytes."""
    cut = bytes(c if c > 0x7F or chr(c).isalnum() else 0x20 for c in range(256))
    table = cut.translate(bytes.maketrans(UPPER.encode(), LOWER.encode()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, COUNTED_ROWS):
                batch = whole.slice(at, COUNTED_ROWS)
                found, tf, ends, n = [], [], [0], []
                for text in batch.column(3).to_pylist():
                    parts = text.translate(table).split()
                    counts = Counter(parts if vocab is None else filter(vocab.__contains__, parts))
                    n.append(len(parts))
                    found.extend(counts.keys())
                    tf.extend(counts.values())
                    ends.append(len(found))
                opened = pa.StructArray.from_arrays(
                    [pa.array(found, pa.binary()).cast(pa.string()), pa.array(tf, pa.int64())], ["term", "tf"])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:3], pa.array(n, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), opened)],
                    ["_d", "_h", "doc_id", "_n", "_terms"])
    return run


def counted(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(_d, _h, doc_id, _n, _terms)``: every document once, with the counts of its terms in ``vocab``.

    A document is identified by ``_d`` (its id, null as the smallest long) and ``_h`` (hash of id and text). Terms
    are counted inside the row; no occurrence is shuffled. A ``vocab`` too large for a task is joined by
    :func:`postings` instead.
    """
    doc_id, text = F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.coalesce(doc_id, F.lit(-(1 << 63))).alias("_d"), F.xxhash64(doc_id, text).alias("_h"),
                       doc_id.alias("doc_id"), text.cast("binary").alias("_text"))
    known = frozenset(r["term"].encode() for r in vocab.collect()) if scale.fits(vocab) else None
    made = rows.mapInArrow(_counter(known), "_d bigint, _h bigint, doc_id bigint, _n bigint, "
                                            "_terms array<struct<term:string,tf:bigint>>")
    return scale.stage(made.dropDuplicates(["_d", "_h"]), "search-docs")


def postings(docs: DataFrame, vocab: DataFrame) -> DataFrame:
    """``(_d, _h, doc_id, term, tf, impact, w)`` for the terms of ``vocab``; statistics over all documents."""
    vocab = scale.pin(vocab)
    rows = counted(docs, vocab)
    stats = rows.agg(F.count(F.when(F.col("_n") > 0, 1)).alias("N"), F.sum("_n").alias("L")).first()
    big_n, big_l = stats["N"], stats["L"] or 1
    tf = rows.select("_d", "_h", "doc_id", "_n", F.inline("_terms"))
    if not scale.fits(vocab):
        tf = scale.attach(tf, vocab, ["term"], "left_semi")
    weights = scale.pin(tf.groupBy("term").agg(F.count(F.lit(1)).alias("df")).select(
        "term", F.floor(1000 * F.log((2.0 * big_n + 2) / (2.0 * F.col("df") + 1))).cast("long").alias("w")))
    m = F.expr(f"25 + CAST((CAST(75 AS DECIMAL(38,0)) * _n * {big_n}) div {big_l} AS BIGINT)")
    post = (tf.withColumn("_m", m).withColumn("impact", F.expr("(1000000000 * tf) div (1000 * tf + 8 * _m)"))
            .select("_d", "_h", "doc_id", "term", "tf", "impact"))
    return scale.attach(post, weights, ["term"], "inner")


def search(docs: DataFrame, items: DataFrame, top: int = TOP, block: int = BLOCK) -> DataFrame:
    """``item_id, rank, doc_id, score``: each item's ``top`` best documents with score above 0."""
    query = (items.select(F.col("item_id"), F.explode(terms(F.col("text"))).alias("term"))
             .groupBy("item_id", "term").agg(F.count(F.lit(1)).alias("mult")))
    query = scale.stage(query, "search-items")
    # 1. postings of query terms with their weights, gathered per document again
    hits = postings(docs, query.select("term").distinct())
    gathered = hits.groupBy("_d", "_h", "doc_id").agg(
        F.collect_list(F.struct("term", "w", "impact")).alias("_hits"), F.max(F.struct("w", "term", "impact")).alias("_lead"))
    # 2. blocks of similar documents: ordered by the heaviest query term, cut every ``block`` documents
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_lead.w").desc(), F.col("_lead.term"), F.col("_lead.impact").desc(), F.col("_d"),
             F.col("_h")]
    ordered = (gathered.repartitionByRange(parts, *order).sortWithinPartitions(*order)
               .withColumn("_mid", F.monotonically_increasing_id()))
    blocks = scale.stage(ordered.select(
        "_d", "_h", "doc_id", "_hits", (F.shiftleft(F.shiftright("_mid", 33), 31)
                                        + F.floor(F.col("_mid").bitwiseAND(F.lit((1 << 33) - 1)) / block)).cast("long")
        .alias("_block")), "search-blocks")
    placed = blocks.select("_d", "_h", "doc_id", "_block", F.inline("_hits"))
    summary = placed.groupBy("_block", "term", "w").agg(F.max("impact").alias("_max"))
    # 3. bounds of (item, block)
    bounds = scale.stage(scale.attach(summary, query, ["term"], "inner")
                         .groupBy("item_id", "_block").agg(F.sum(F.col("mult") * F.col("w") * F.col("_max"))
                                                           .alias("_bound")), "search-bounds")

    def exact(pairs: DataFrame) -> DataFrame:
        # A document's hits are opened beside the items that want it, so its score is summed where it is read.
        asked = scale.attach(blocks, scale.stage(pairs, "search-pairs"), ["_block"], "inner")
        scored = (scale.attach(asked.select("item_id", "_d", "_h", "doc_id", F.inline("_hits")), query,
                               ["item_id", "term"], "inner")
                  .groupBy("item_id", "_d", "_h", "doc_id")
                  .agg(F.sum(F.col("mult") * F.col("w") * F.col("impact")).alias("score")))
        return scored.filter(F.col("score") > 0)

    def best(scored: DataFrame) -> DataFrame:
        rank = Window.partitionBy("item_id").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                                                     F.col("_h"))
        return scored.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top)

    # 4. round one: the best-bounded block of each item gives a threshold
    first = bounds.groupBy("item_id").agg(F.max_by("_block", "_bound").alias("_block"))
    found = best(exact(first))
    threshold = (found.groupBy("item_id").agg(F.count(F.lit(1)).alias("_k"), F.min("score").alias("_low"))
                 .select("item_id", F.when(F.col("_k") >= top, F.col("_low")).otherwise(F.lit(1)).alias("_theta")))
    # 5. round two: every block whose bound reaches the threshold
    wanted = (bounds.join(threshold, "item_id", "left")
              .filter(F.col("_bound") >= F.coalesce(F.col("_theta"), F.lit(1))).select("item_id", "_block"))
    return (best(exact(wanted))
            .select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", F.col("score").cast("long")))


def brute_force(docs: list[tuple], items: list[tuple], top: int = TOP) -> list[tuple]:
    """The same ranking in plain Python, for small fixtures: ``(item_id, rank, doc_id, score)``."""
    import math
    import re
    split = re.compile(SEPARATORS)
    low = str.maketrans(UPPER, LOWER)

    def cut(text):
        return [t for t in split.split((text or "").translate(low)) if t]

    toks = [(d, cut(t)) for d, t in dict.fromkeys(docs)]
    big_n = sum(1 for _, t in toks if t)
    big_l = sum(len(t) for _, t in toks)
    df: dict[str, int] = {}
    for _, t in toks:
        for term in set(t):
            df[term] = df.get(term, 0) + 1
    out = []
    for item_id, text in items:
        q = cut(text)
        scored = []
        for row, (d, t) in enumerate(toks):
            if not t:
                continue
            m = 25 + (75 * len(t) * big_n) // big_l
            s = 0
            for term in q:
                tf = t.count(term)
                if tf:
                    s += math.floor(1000 * math.log((2.0 * big_n + 2) / (2.0 * df[term] + 1))) * (
                        (10 ** 9 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scored.append((-s, d is None, d if d is not None else 0, row, d, s))
        scored.sort()
        out += [(item_id, r + 1, x[4], x[5]) for r, x in enumerate(scored[:top])]
    return out


def sql() -> str:
    """DuckDB SQL of the same ranking (documents identified by doc_id)."""
    split = "regexp_split_to_array(translate(coalesce({0}, ''), '" + UPPER + "', '" + LOWER + "'), '" + \
        SEPARATORS + "')"
    return f"""
WITH dt AS (SELECT doc_id, t AS term FROM (SELECT doc_id, unnest({split.format('text')}) AS t FROM documents)
            WHERE t <> ''),
ds AS (SELECT doc_id, count(*) AS n FROM dt GROUP BY doc_id),
g AS (SELECT count(*) AS nn, sum(n) AS ll FROM ds),
tf AS (SELECT doc_id, term, count(*) AS tf FROM dt GROUP BY doc_id, term),
wt AS (SELECT term, CAST(floor(1000 * ln((2.0 * g.nn + 2) / (2.0 * count(*) + 1))) AS BIGINT) AS w
       FROM tf, g GROUP BY term, g.nn),
it AS (SELECT item_id, t AS term FROM (SELECT item_id, unnest({split.format('text')}) AS t FROM benchmark)
       WHERE t <> ''),
sc AS (SELECT it.item_id, tf.doc_id,
              sum(wt.w * ((1000000000 * tf.tf) // (1000 * tf.tf + 8 * (25 + (CAST(75 AS HUGEINT) * ds.n * g.nn) // g.ll))))
              AS score
       FROM it JOIN tf ON it.term = tf.term JOIN wt ON wt.term = it.term JOIN ds ON ds.doc_id = tf.doc_id, g
       GROUP BY it.item_id, tf.doc_id),
r AS (SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rk
      FROM sc WHERE score > 0)
SELECT item_id, CAST(rk AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM r WHERE rk <= {TOP}
"""
