"""TF-IDF over word, character and list n-grams, kept as a long table.

The matrix is one row per (document, branch, term). Counting happens inside the document's row;
document frequency and weights are aggregates and joins.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import partial
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from labelloom import scale
from labelloom.functions import text as T

if TYPE_CHECKING:
    from labelloom.operators.blocks import Blocks, Scaled

# A term is frequent when it makes up at least 1/HOT_TERMS of all (document, term) pairs; there can
# be no more such terms, so they may be broadcast.
HOT_TERMS = 20_000
# Documents, and their words or list items, that are counted together, so that a task's memory stays small.
COUNTED_ROWS = 64
COUNTED_ITEMS = 50_000
# Terms per shuffle partition that are hashed for a join instead of sorted, some 25 MB.
HASHED_ROWS = 250_000
# Lengths are broadcast up to this many (and the bytes of any broadcast); the counts then stay where they are.
LENGTHS = 2_000_000
COUNTED = "array<struct<term:string,tf:bigint>>"


@dataclass(frozen=True)
class Branch:
    """One feature family: a source column, how to cut it into terms, and the n-gram range."""

    name: str
    column: str
    kind: str
    ngrams: tuple[int, int] = (1, 1)
    stop_words: tuple[str, ...] = ()

    def terms(self) -> Column:
        source = F.col(self.column)
        if self.kind == "words":
            return T.word_ngrams(T.words(source, self.stop_words), *self.ngrams)
        if self.kind == "chars":
            return T.char_ngrams(source, *self.ngrams)
        if self.kind == "list":
            return T.word_ngrams(T.split_list(source), *self.ngrams)
        raise ValueError(f"unknown branch kind: {self.kind}")

    def items(self) -> Column:
        """The words or list items that the terms are runs of, or character runs of."""
        if self.kind == "chars":
            return T.char_words(F.col(self.column))
        return Branch(self.name, self.column, self.kind, (1, 1), self.stop_words).terms()

    def runs(self, only: frozenset[str] | None = None) -> Callable[[pa.Array, np.ndarray], Runs]:
        """What makes terms of some documents' items, as ``terms`` does; ``only`` those, where given."""
        return partial(_char_runs if self.kind == "chars" else _item_runs, *self.ngrams, only)


# For every term that occurs: its document and its place among the names, then the names.
Runs = tuple[np.ndarray, np.ndarray, pa.Array]


def _numbered(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of every value among the distinct ones, and these."""
    coded = values.dictionary_encode()
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary


def _among(names: pa.Array, only: frozenset[str]) -> np.ndarray:
    return pc.is_in(names, pa.array(list(only), pa.string())).to_numpy(zero_copy_only=False)


def _char_runs(low: int, high: int, only: frozenset[str] | None, items: pa.Array, doc: np.ndarray) -> Runs:
    """Runs of characters inside words with a blank on both sides; a word below ``low`` gives itself.

    All words stand in one text. A run's key has one digit for each character and grows by one with every length.
    """
    text = f" {pc.binary_join(_lists(np.array([0, len(items)]), items), '  ')[0].as_py()} "
    sizes = pc.utf8_length(items).to_numpy().astype(np.int64) + 2
    ends = np.cumsum(sizes)
    starts, until, doc = ends - sizes, np.repeat(ends, sizes), np.repeat(doc, sizes)
    digits, letters = _numbered(pa.array(np.frombuffer(text.encode("utf-32-le"), "<u4")))
    at, base, largest = np.arange(len(until)), len(letters), 1
    key = np.zeros(len(at), np.int64)
    docs, places, found, total = [], [], [], 0
    for n in range(1, high + 1):
        inside = at + n <= until[at]
        at, key = at[inside], key[inside]
        if largest * base >= 1 << 62:
            key, distinct = _numbered(pa.array(key))
            largest = len(distinct)
        key, largest = key * base + digits[at + n - 1], largest * base
        where = slice(None) if n >= low else np.searchsorted(at, starts[sizes == n])
        place, distinct = _numbered(pa.array(key[where]))
        first = np.zeros(len(distinct), np.int64)
        first[place[::-1]] = at[where][::-1]
        names, of = pa.array([text[i:i + n] for i in first.tolist()], pa.string()), doc[at[where]]
        if only is not None:
            wanted = _among(names, only)[place]
            of, place = of[wanted], place[wanted]
        docs.append(of)
        places.append(place + total)
        found.append(names)
        total += len(names)
    return np.concatenate(docs), np.concatenate(places), pa.concat_arrays(found)


def _item_runs(low: int, high: int, only: frozenset[str] | None, items: pa.Array, doc: np.ndarray) -> Runs:
    """Runs of neighbouring items: one of ``n`` is one of ``n - 1`` and the item after it."""
    codes, words = _numbered(items)
    place, names, docs, places, found = codes, words, [], [], []
    for n in range(1, high + 1):
        starts = np.flatnonzero(doc[:len(doc) - n + 1] == doc[n - 1:]) if n <= len(doc) else np.zeros(0, np.int64)
        if n > 1:
            at, pairs = _numbered(pa.array(place[starts] * len(words) + codes[starts + n - 1]))
            before, after = np.divmod(pairs.to_numpy(), max(1, len(words)))
            names = pc.binary_join_element_wise(names.take(pa.array(before)), words.take(pa.array(after)), " ")
            place = np.zeros(len(doc), np.int64)
            place[starts] = at
        if n >= low:
            docs.append(doc[starts])
            places.append(place[starts] + sum(map(len, found)))
            found.append(names)
    # Items with blanks may read like a longer run.
    same, names = _numbered(pa.concat_arrays(found))
    doc, place = np.concatenate(docs), same[np.concatenate(places)]
    if only is not None:
        wanted = _among(names, only)[place]
        doc, place = doc[wanted], place[wanted]
    return doc, place, names


def _sizes(lists: pa.Array) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)


def _small_batches(batches: Iterator[pa.RecordBatch], kept: int) -> Iterator[pa.RecordBatch]:
    """Some rows at a time: few, and with few items in the columns after the first ``kept`` unless it is one."""
    for batch in batches:
        start = held = 0
        for at, size in enumerate(sum((_sizes(c) for c in batch.columns[kept:]), np.zeros(batch.num_rows, np.int64)).tolist()):
            if at > start and (at - start == COUNTED_ROWS or held + size > COUNTED_ITEMS):
                yield batch.slice(start, at - start)
                start, held = at, 0
            held += size
        if batch.num_rows:
            yield batch.slice(start)


def _found(runs: Callable, lists: pa.Array) -> Runs:
    items = lists.flatten().cast(pa.string())
    if not len(items):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), items
    return runs(items, np.repeat(np.arange(len(lists)), _sizes(lists)))


def _distinct(runs: Callable, lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """The distinct terms of every document by place, how often each occurs, where a document ends; the names."""
    doc, place, names = _found(runs, lists)
    width = max(1, len(names))
    pairs = np.sort(doc * width + place)
    at = np.flatnonzero(np.concatenate([np.ones(min(1, len(pairs)), bool), pairs[1:] != pairs[:-1]]))
    tf, pairs = np.diff(np.append(at, len(pairs))), pairs[at]
    return pairs % width, tf, np.searchsorted(pairs, np.arange(len(lists) + 1) * width), names


def _lists(ends: np.ndarray, values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def _counting(branches: Sequence[Branch], kept: int) -> Callable:
    """Per row and branch its counted terms; a document is counted inside its row."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [b.runs() for b in branches]
        for batch in _small_batches(batches, kept):
            for place, branch in enumerate(branches):
                terms, tf, ends, names = _distinct(runs[place], batch.column(kept + place))
                opened = pa.StructArray.from_arrays([names.take(pa.array(terms)), pa.array(tf, pa.int64())],
                                                    ["term", "tf"])
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:kept], pa.array([branch.name] * batch.num_rows, pa.string()),
                     _lists(ends, opened)], [*batch.schema.names[:kept], "branch", "terms"])
    return count


def _sizing(branches: Sequence[Branch], kept: int) -> Callable:
    """Per row and branch the number of distinct terms."""
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = [b.runs() for b in branches]
        for batch in _small_batches(batches, kept):
            for place, branch in enumerate(branches):
                ends = _distinct(runs[place], batch.column(kept + place))[2]
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:kept], pa.array([branch.name] * batch.num_rows, pa.string()),
                     pa.array(np.diff(ends), pa.int64())], [*batch.schema.names[:kept], "branch", "n_terms"])
    return measure


def kept_terms(branch: Branch, terms: Iterable[str]) -> Column:
    """The document's terms that are among ``terms``, each as often as it occurs, found inside its row."""
    only = frozenset(terms)

    def keep(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        runs = branch.runs(only)
        for column in columns:
            done = [pa.array([], pa.list_(pa.string()))]
            for batch in _small_batches(iter([pa.RecordBatch.from_arrays([column], ["items"])]), 0):
                doc, place, names = _found(runs, batch.column(0))
                order = np.argsort(doc, kind="stable")
                ends = np.searchsorted(doc[order], np.arange(batch.num_rows + 1))
                done.append(_lists(ends, names.take(pa.array(place[order]))))
            yield pa.concat_arrays(done)

    # The types are given by hand: annotations are text in this module, and Spark reads the signature.
    keep.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(keep, "array<string>")(branch.items())


def _itemised(docs: DataFrame, branches: Sequence[Branch], keep: Sequence[str]) -> DataFrame:
    return docs.select(*keep, *[b.items().alias(f"_items_{i}") for i, b in enumerate(branches)])


def _schema(itemised: DataFrame, kept: int, *more: tuple[str, str]) -> ST.StructType:
    out = ST.StructType([ST.StructField(f.name, f.dataType) for f in itemised.schema.fields[:kept]])
    for name, kind in more:
        out = out.add(name, ST.DataType.fromDDL(kind))
    return out


def doc_terms(docs: DataFrame, branches: Sequence[Branch], keep: Sequence[str]) -> DataFrame:
    """``(*keep, branch, terms)`` with the counted terms as an array; all branches in one scan."""
    rows, kept = _itemised(docs, branches, keep), len(keep)
    return rows.mapInArrow(_counting(branches, kept),
                           _schema(rows, kept, ("branch", "string"), ("terms", COUNTED)))


def _own(counted: DataFrame | Blocks, idf: DataFrame) -> bool:
    """Whether these are packed counts that know the frequencies of ``idf`` already."""
    return not isinstance(counted, DataFrame) and counted.idf is idf


def term_counts(counted: DataFrame | Blocks) -> DataFrame:
    """Open the counted arrays: ``(*keep, branch, term, tf)``."""
    counted = counted if isinstance(counted, DataFrame) else counted.opened()
    return counted.select(*[c for c in counted.columns if c != "terms"], F.inline("terms"))


def vocabulary(pairs: DataFrame) -> DataFrame:
    """Document frequency and total count per ``(branch, term)``."""
    return pairs.groupBy("branch", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total_tf"))


def inverse_frequency(vocab: DataFrame, docs: DataFrame) -> DataFrame:
    """Smoothed idf ``ln((1 + n) / (1 + df)) + 1`` with ``n`` the number of documents."""
    n = docs.agg(F.count(F.lit(1))).scalar()
    return vocab.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


def with_idf(pairs: DataFrame | Blocks, idf: DataFrame) -> DataFrame:
    """Attach each pair's table row; pairs with an unseen term are left out. Packed counts, whose own table ``idf``
    must be, get the frequencies of their terms.

    ``idf`` should be a stored table (it is read more than once). A small one is broadcast. A
    large one is joined in two parts: the most frequent terms, bounded in number, by broadcast
    and without moving a pair; the others by shuffle, where no term is frequent any more.
    """
    if not isinstance(pairs, DataFrame):
        return pairs.answered("_terms", *pairs.keep, answers=["_totals"])
    # The term first: a sort compares the first eight bytes of its first key, and a branch tells nothing.
    on = ["term", "branch"]
    if scale.fits(idf):
        return pairs.join(F.broadcast(idf), on)
    limit = idf.agg(F.sum("df") / HOT_TERMS).scalar()
    frequent = F.broadcast(idf.filter(F.col("df") >= limit))
    common = pairs.join(frequent, on)
    rest = idf.filter(F.col("df") < limit)
    parts = int(idf.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if idf.count() <= HASHED_ROWS * parts:
        rest = rest.hint("shuffle_hash")
    rare = pairs.join(frequent.select(*on), on, "left_anti").join(rest, on)
    return common.unionByName(rare)


def _norms(valued: DataFrame, key: str) -> DataFrame:
    value = F.col("tf") * F.col("idf")
    return valued.groupBy(key, "branch").agg(F.sqrt(F.sum(value * value)).alias("norm"))


def _with_norms(rows: DataFrame, norms: DataFrame, key: str, how: str = "inner") -> DataFrame:
    return rows.join(F.broadcast(norms) if scale.fits(norms, LENGTHS) else norms, [key, "branch"], how)


def lengths(counted: DataFrame | Blocks, idf: DataFrame, key: str = "Id") -> DataFrame:
    """``(key, branch, norm)``: the length of ``tf * idf`` per document and branch, one number each."""
    if _own(counted, idf):
        return counted.lengths(key)
    return _norms(with_idf(term_counts(counted).select(key, "branch", "term", "tf"), idf), key)


def scaled(counted: DataFrame | Blocks, idf: DataFrame, key: str = "Id", norms: DataFrame | None = None
           ) -> DataFrame | Scaled:
    """The pairs of counted documents with ``u = tf / norm``. Only the unopened rows meet the lengths,
    which are stored, as they are read whenever the pairs are; ``norms`` may hand over stored ones. Rows without
    a key have no length: their ``u`` is null, but they count for a term's frequency. Packed counts stay packed."""
    if _own(counted, idf):
        return counted.scaled(key, norms)
    counted = counted if isinstance(counted, DataFrame) else counted.opened()
    norms = scale.stage(lengths(counted, idf, key), "lengths") if norms is None else norms
    with_norm = _with_norms(counted, norms, key, "left")
    return term_counts(with_norm).withColumn("u", F.col("tf") / F.col("norm")).drop("norm")


def weights(counted: DataFrame | Blocks, idf: DataFrame, key: str = "Id") -> DataFrame:
    """``tf * idf`` scaled to length one per document and branch, before any selection.

    ``counted`` should be a stored table of counted arrays; it is read twice. The pairs meet the idf table
    once and are stored with it, for their lengths and for their weights. Packed counts are opened with their weights.
    """
    if _own(counted, idf):
        return counted.weighted(with_idf(counted, idf), key)
    valued = with_idf(term_counts(counted), idf)
    if not scale.fits(idf):
        valued = scale.stage(valued, "valued")
    found = _with_norms(valued, scale.stage(_norms(valued, key), "lengths"), key)
    return found.withColumn("w", F.col("tf") / F.col("norm") * F.col("idf")).drop("norm")


def feature_counts(pairs: DataFrame, key: str = "Id") -> DataFrame:
    """One row per branch: number of features, of documents with any, and of stored entries."""
    per_term = pairs.groupBy("branch", "term").agg(F.count(F.lit(1)).alias("df"))
    sizes = per_term.groupBy("branch").agg(
        F.count(F.lit(1)).alias("n_features"), F.sum("df").alias("n_entries"))
    rows = pairs.select("branch", key).distinct().groupBy("branch").agg(
        F.count(F.lit(1)).alias("n_rows"))
    return sizes.join(rows, "branch")


def branch_counts(docs: DataFrame, branches: Sequence[Branch], key: str = "Id") -> DataFrame:
    """``feature_counts`` of a table's branches without opening its pairs.

    Entries and documents follow from the number of distinct terms per row; only distinct terms are
    shuffled. Character runs never cross a word, so theirs are the runs of the distinct words. The branches'
    columns are stored first: each branch reads its own, and a join that made the table runs once.
    """
    docs = scale.stage(docs.select(key, *dict.fromkeys(b.column for b in branches)), "sources")
    rows = _itemised(docs, branches, [key])
    sized = rows.mapInArrow(_sizing(branches, 1), _schema(rows, 1, ("branch", "string"), ("n_terms", "bigint")))
    per_key = (sized.filter("n_terms > 0").groupBy("branch", key).agg(F.sum("n_terms").alias("n_entries")))
    entries = per_key.groupBy("branch").agg(F.sum("n_entries").alias("n_entries"),
                                            F.count(F.lit(1)).alias("n_rows"))
    features = None
    for b in branches:
        source = b.items() if b.kind == "chars" else b.terms()
        found = docs.select(F.explode(F.array_distinct(source)).alias("term")).distinct()
        if b.kind == "chars":
            found = found.select(F.explode(F.array_distinct(T.word_runs(F.col("term"), *b.ngrams))).alias("term")
                                 ).distinct()
        size = found.agg(F.lit(b.name).alias("branch"), F.count(F.lit(1)).alias("n_features"))
        features = size if features is None else features.unionByName(size)
    return features.join(entries, "branch").select("branch", "n_features", "n_entries", "n_rows")
