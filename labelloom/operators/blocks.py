"""Counted terms of many documents in one row, so that no (document, term) pair travels as a row of its own.

A block holds some documents of one branch: their kept columns, the sorted distinct terms, and per document the
places and counts of its terms among these, all as compressed bytes. The sorted terms of all blocks are cut at the
same border terms; the slices between two borders form a bucket. A bucket counts its terms and answers every block
with the frequencies of its slice and the numbers of its terms in the bucket. From then on a block knows the idf of
its terms: lengths and weights are found inside it, and sums per term are sent to the bucket by number, without text.
"""

from __future__ import annotations

import struct
import zlib
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from labelloom import scale
from labelloom.operators import features as FT

# A block ends with the documents that bring it to as many pairs, or their terms to as many bytes.
BLOCK_PAIRS = 1_000_000
BLOCK_BYTES = 64 << 20
# Terms of all blocks that a bucket holds, about: at most, and at least where there are few.
BUCKET_TERMS, BUCKET_LEAST = 1_000_000, 20_000
# Every so manieth term of a block is seen when the borders are chosen.
SAMPLED = 1 << 12
# Bytes at the start of a term that are compared with the term before it.
SHARED = 64
# Pairs that are opened in one go.
OPENED = 1 << 16
# Rows are large: without these the writer would look at its memory after a hundred of them.
ROOMY = {"parquet.block.size": 32 << 20, "parquet.block.size.row.check.min": 1, "parquet.page.size.row.check.min": 1}
_ZSTD = pa.Codec("zstd", compression_level=3)


# --- numbers and terms as bytes -----------------------------------------------------------------------

def squeeze(values: np.ndarray) -> bytes:
    """Doubles or numbers from 0 up: in the narrowest type, the bytes of one weight together, compressed."""
    if values.dtype != np.float64:
        values = values.astype(np.min_scalar_type(int(values.max())) if len(values) else np.uint8)
    planes = values.view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return struct.pack("<cq", values.dtype.char.encode(), len(values)) + _ZSTD.compress(planes.tobytes(), asbytes=True)


def expand(blob: bytes) -> np.ndarray:
    kind, n = struct.unpack_from("<cq", blob)
    kind = np.dtype(kind.decode())
    planes = _ZSTD.decompress(memoryview(blob)[9:], n * kind.itemsize, asbytes=True) if n else b""
    found = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(kind.itemsize, n).T).view(kind).reshape(n)
    return found if kind == np.float64 else found.astype(np.int64)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of ``sizes`` bytes from each of ``starts`` on."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(starts - before, sizes) + np.arange(int(sizes.sum()))


def squeeze_terms(terms: pa.Array) -> bytes:
    """Sorted terms: what each shares with the one before it is a number, the rest of it stands in one text."""
    ends = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    text = np.frombuffer(terms.buffers()[2] or b"", np.uint8)
    starts, sizes = ends[:-1], np.diff(ends)
    shared, alike = np.zeros(len(terms), np.int64), np.arange(1, len(terms))
    for depth in range(SHARED):
        alike = alike[np.minimum(sizes[alike], sizes[alike - 1]) > depth]
        alike = alike[text[starts[alike] + depth] == text[starts[alike - 1] + depth]]
        if not len(alike):
            break
        shared[alike] += 1
    rest = text[_spread(starts + shared, sizes - shared)].tobytes()
    packed = squeeze(shared), squeeze(sizes - shared)
    return struct.pack("<qqq", *map(len, (*packed, rest))) + b"".join(packed) + _ZSTD.compress(rest, asbytes=True)


def expand_terms(blob: bytes) -> pa.Array:
    first, second, length = struct.unpack_from("<qqq", blob)
    blob = memoryview(blob)[24:]
    shared, rest = expand(blob[:first]), expand(blob[first:first + second])
    ends = np.concatenate([[0], np.cumsum(shared + rest)]).astype(np.int32)
    starts, text = ends[:-1].astype(np.int64), np.empty(int(ends[-1]), np.uint8)
    if length:
        text[_spread(starts + shared, rest)] = np.frombuffer(_ZSTD.decompress(blob[first + second:], length), np.uint8)
    place, deep = np.arange(len(shared)), np.arange(len(shared))
    for depth in range(int(shared.max(initial=0))):
        # Who shares more than this has the byte of the last term before that does not.
        own = np.maximum.accumulate(np.where(shared <= depth, place, 0))
        deep = deep[shared[deep] > depth]
        text[starts[deep] + depth] = text[starts[own[deep]] + depth]
    return pa.StringArray.from_buffers(len(shared), pa.py_buffer(ends), pa.py_buffer(text))


def _steps(values: np.ndarray, starts: np.ndarray | int = 0) -> np.ndarray:
    """Differences of numbers that rise from each of ``starts`` on, where the number itself stands."""
    out = np.diff(values, prepend=0)
    out[starts] = values[starts]
    return out


def _sorted_names(names: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """The place of every value among the sorted distinct ones, and these."""
    codes, distinct = FT._numbered(names)
    order = pc.sort_indices(distinct)
    place = np.empty(len(distinct), np.int64)
    place[order.to_numpy()] = np.arange(len(distinct))
    return place[codes], distinct.take(order)


# --- from documents to blocks -------------------------------------------------------------------------

PACKED = (("_block", "bigint"), ("branch", "string"), ("_n_terms", "bigint"), ("_sample", "array<string>"),
          ("_ends", "binary"), ("_places", "binary"), ("_tfs", "binary"), ("_terms", "binary"))


def _block(number: int, branch: str, held: list) -> pa.RecordBatch:
    place, names = _sorted_names(pa.concat_arrays([names for *_, names in held]))
    before = np.cumsum([0, *[len(names) for *_, names in held]])
    place = place[np.concatenate([terms + at for (_, terms, _, _, _), at in zip(held, before)])]
    tf, sizes = np.concatenate([h[2] for h in held]), np.concatenate([np.diff(h[3]) for h in held])
    order = np.argsort(np.repeat(np.arange(len(sizes)), sizes) * max(1, len(names)) + place, kind="stable")
    place, tf = place[order], tf[order]
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    sample = names[zlib.crc32(f"{branch} {number}".encode()) % SAMPLED::SAMPLED]
    whole = lambda values: FT._lists(np.array([0, len(values)]), values)
    kept = [whole(pa.concat_arrays([h[0][i] for h in held])) for i in range(len(held[0][0]))]
    packed = [squeeze(sizes), squeeze(_steps(place, starts)), squeeze(tf), squeeze_terms(names)]
    return pa.RecordBatch.from_arrays(
        [pa.array([number], pa.int64()), pa.array([branch]), pa.array([len(names)], pa.int64()), whole(sample),
         *[pa.array([p], pa.binary()) for p in packed], *kept],
        [*[n for n, _ in PACKED], *[f"_kept_{i}" for i in range(len(kept))]])


def _packing(branches: Sequence[FT.Branch], kept: int) -> Callable:
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 33
        runs = [b.runs() for b in branches]
        held, pairs, size = [[] for _ in branches], [0] * len(branches), [0] * len(branches)
        for batch in FT._small_batches(batches, kept):
            # A copy: a slice would hold the whole batch with its texts.
            rows = [c.take(pa.array(np.arange(batch.num_rows))) for c in batch.columns[:kept]]
            for i, branch in enumerate(branches):
                terms, tf, ends, names = FT._distinct(runs[i], batch.column(kept + i))
                held[i].append((rows, terms, tf, ends, names))
                pairs[i] += len(terms)
                size[i] += names.nbytes
                if pairs[i] >= BLOCK_PAIRS or size[i] >= BLOCK_BYTES:
                    yield _block(number, branch.name, held[i])
                    held[i], pairs[i], size[i], number = [], 0, 0, number + 1
        for i, branch in enumerate(branches):
            if held[i]:
                yield _block(number, branch.name, held[i])
                number += 1
    return pack


class _Opened:
    """The pairs of a packed row: documents, places among its terms, counts."""

    def __init__(self, row: dict):
        self.sizes, steps, self.tf = expand(row["_ends"]), expand(row["_places"]), expand(row["_tfs"])
        self.doc = np.repeat(np.arange(len(self.sizes)), self.sizes)
        sums, starts = np.cumsum(steps), (np.cumsum(self.sizes) - self.sizes)[self.sizes > 0]
        self.place = sums - np.repeat((sums - steps)[starts], self.sizes[self.sizes > 0])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, dict]]:
    """Row by row: the row itself and its bytes and numbers by name."""
    for batch in batches:
        plain = [i for i, f in enumerate(batch.schema) if not pa.types.is_list(f.type)]
        for at in range(batch.num_rows):
            row = batch.slice(at, 1)
            yield row, {batch.schema.names[i]: row.column(i)[0].as_py() for i in plain}


# --- from blocks to buckets and back --------------------------------------------------------------------

def _slicing(borders: dict[str, tuple[int, list[bytes]]]) -> Callable:
    """The terms of a block between two borders, with their frequencies in the block."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, row in _rows(batches):
            first, cuts = borders[row["branch"]]
            terms, pairs = expand_terms(row["_terms"]), _Opened(row)
            n = len(terms)
            df = np.bincount(pairs.place, minlength=n)
            total = np.bincount(pairs.place, weights=pairs.tf, minlength=n).astype(np.int64)
            found = [bisect_left(range(n), c, key=lambda i: terms[i].as_buffer().to_pybytes()) for c in cuts]
            spans = [(b, lo, hi) for b, (lo, hi) in enumerate(zip([0, *found], [*found, n]), first) if lo < hi]
            yield pa.RecordBatch.from_arrays(
                [pa.array([b for b, _, _ in spans], pa.int32()),
                 pa.array([row["_block"]] * len(spans), pa.int64()), pa.array([row["branch"]] * len(spans), pa.string()),
                 pa.array([squeeze_terms(terms.slice(lo, hi - lo)) for _, lo, hi in spans], pa.binary()),
                 pa.array([squeeze(df[lo:hi]) for _, lo, hi in spans], pa.binary()),
                 pa.array([squeeze(total[lo:hi]) for _, lo, hi in spans], pa.binary())],
                ["_bucket", "_block", "branch", "_terms", "_dfs", "_totals"])
    return cut


MET = "_bucket int, _block bigint, branch string, _terms binary, _dfs binary, _totals binary, _numbers binary"


def _frequencies(bucket: pa.Table) -> pa.Table:
    """The terms of a bucket with their frequencies, and for every slice of a block those of its terms."""
    slices = [expand_terms(t) for t in bucket.column("_terms").to_pylist()]
    ends = np.cumsum([len(s) for s in slices])
    number, names = _sorted_names(pa.concat_arrays(slices))
    sums = [np.bincount(number, weights=np.concatenate([expand(b) for b in bucket.column(c).to_pylist()]),
                        minlength=len(names)).astype(np.int64) for c in ("_dfs", "_totals")]
    parts = np.split(number, ends[:-1])
    same = lambda c: [*[v.as_py() for v in bucket.column(c)[:1]], *bucket.column(c).to_pylist()]
    return pa.table({
        "_bucket": pa.array(same("_bucket"), pa.int32()),
        "_block": pa.array([None, *bucket.column("_block").to_pylist()], pa.int64()),
        "branch": pa.array(same("branch"), pa.string()),
        "_terms": pa.array([squeeze_terms(names), *[None] * len(parts)], pa.binary()),
        "_dfs": pa.array([squeeze(sums[0]), *[squeeze(sums[0][p]) for p in parts]], pa.binary()),
        "_totals": pa.array([squeeze(sums[1]), *[squeeze(sums[1][p]) for p in parts]], pa.binary()),
        "_numbers": pa.array([None, *[squeeze(_steps(p)) for p in parts]], pa.binary())})


def _idf(n: int, df: np.ndarray) -> np.ndarray:
    return np.log((1 + n) / (1 + df)) + 1


class _Weighed(_Opened):
    """The pairs of a block that met its answers: ``idf``, and ``u``, the count over the document's length."""

    def __init__(self, row: pa.RecordBatch, plain: dict, n: int):
        super().__init__(plain)
        answers = sorted(row.column("_answers")[0].as_py(), key=lambda a: a["_bucket"])
        self.buckets = [a["_bucket"] for a in answers]
        self.numbers = [np.cumsum(expand(a["_numbers"])) for a in answers if "_numbers" in a]
        self.df = np.concatenate([expand(a["_dfs"]) for a in answers])
        self.total = [expand(a["_totals"]) for a in answers if "_totals" in a]
        self.ends = np.cumsum([len(x) for x in self.numbers])
        self.idf = _idf(n, self.df)
        self.square = np.bincount(self.doc, weights=(self.tf * self.idf[self.place]) ** 2, minlength=len(self.sizes))

    def lengths(self, row: pa.RecordBatch, key: str) -> np.ndarray:
        """Per document its length; NaN without a key. Lengths that join several rows of a key stand in the row."""
        if "_norms" in row.schema.names:
            norm = row.column("_norms").flatten().to_numpy(zero_copy_only=False).astype(np.float64)
        else:
            norm = np.sqrt(self.square)
        known = row.column(key).flatten().is_valid().to_numpy(zero_copy_only=False)
        return np.where(known, norm, np.nan)


class Blocks:
    """The counted terms of a training set with their frequencies; ``idf`` is the table of its terms.

    ``FT.weights``, ``FT.lengths`` and ``FT.scaled`` take it in place of counted rows; ``opened`` gives these.
    """

    def __init__(self, docs: DataFrame, branches: Sequence[FT.Branch], keep: Sequence[str]):
        itemised, kept = FT._itemised(docs, branches, keep), len(keep)
        fields = itemised.schema.fields[:kept]
        schema = ST.StructType([ST.StructField(n, ST.DataType.fromDDL(t)) for n, t in PACKED])
        for i, f in enumerate(fields):
            schema = schema.add(f"_kept_{i}", ST.ArrayType(f.dataType))
        packed = itemised.mapInArrow(_packing(branches, kept), schema)
        rows = scale.stage(packed, "blocks", ROOMY)
        self.keep, self.fields = [f.name for f in fields], fields
        self.rows = rows.select(*[n for n, _ in PACKED], *[F.col(f"_kept_{i}").alias(f.name) for i, f in enumerate(fields)])
        self.n = docs.count()
        self.met = scale.stage(self._slices().groupBy("_bucket").applyInArrow(_frequencies, MET), "met", ROOMY)
        self.idf = self._table()

    def _slices(self) -> DataFrame:
        spark = self.rows.sparkSession
        total = self.rows.agg(F.sum("_n_terms")).first()[0] or 0
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        size = min(BUCKET_TERMS, max(BUCKET_LEAST, total // (4 * parts)))
        seen: dict[str, list[bytes]] = {}
        for r in self.rows.select("branch", F.explode("_sample").alias("term")).toLocalIterator():
            seen.setdefault(r["branch"], []).append(r["term"].encode())
        borders, first = {}, 0
        for r in self.rows.select("branch").distinct().collect():
            cuts = sorted(set(sorted(seen.get(r["branch"], []))[::max(1, size // SAMPLED)][1:]))
            borders[r["branch"]] = (first, cuts)
            first += len(cuts) + 1
        return self.rows.select("_block", "branch", "_ends", "_places", "_tfs", "_terms").mapInArrow(
            _slicing(borders), "_bucket int, _block bigint, branch string, _terms binary, _dfs binary, _totals binary")

    def _table(self) -> DataFrame:
        n = self.n

        def open_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for _, row in _rows(batches):
                terms, df, total = expand_terms(row["_terms"]), expand(row["_dfs"]), expand(row["_totals"])
                for at in range(0, len(terms), OPENED):
                    some = terms.slice(at, OPENED)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([row["branch"]] * len(some), pa.string()), some, pa.array(df[at:at + OPENED]),
                         pa.array(total[at:at + OPENED])], ["branch", "term", "df", "total_tf"])

        table = self.met.filter("_block IS NULL").select("branch", "_terms", "_dfs", "_totals").mapInArrow(
            open_table, "branch string, term string, df bigint, total_tf bigint")
        return table.withColumn("idf", F.log((1 + F.lit(n)) / (1 + F.col("df"))) + 1)

    def opened(self) -> DataFrame:
        """``(*keep, branch, terms)`` as ``FT.doc_terms`` gives it."""
        def open_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, plain in _rows(batches):
                terms, pairs = expand_terms(plain["_terms"]), _Opened(plain)
                ends = np.concatenate([[0], np.cumsum(pairs.sizes)])
                kept = [row.column(name).flatten() for name in keep]
                for lo, hi in _cuts(ends):
                    a, b = ends[lo], ends[hi]
                    found = pa.StructArray.from_arrays([terms.take(pa.array(pairs.place[a:b])), pa.array(pairs.tf[a:b])],
                                                       ["term", "tf"])
                    yield pa.RecordBatch.from_arrays(
                        [*[k.slice(lo, hi - lo) for k in kept], pa.array([plain["branch"]] * (hi - lo), pa.string()),
                         FT._lists(ends[lo:hi + 1] - a, found)], [*keep, "branch", "terms"])

        keep = self.keep
        schema = ST.StructType([*self.fields]).add("branch", "string").add("terms", ST.DataType.fromDDL(FT.COUNTED))
        return self.rows.select("branch", "_ends", "_places", "_tfs", "_terms", *keep).mapInArrow(open_rows, schema)

    def answered(self, *columns: str, answers: Sequence[str] = ()) -> DataFrame:
        """The blocks with the answers to their slices."""
        found = self.met.filter("_block IS NOT NULL").select(
            "_block", F.struct("_bucket", "_dfs", *answers).alias("_answer"))
        return self.rows.select("_block", "branch", "_ends", "_places", "_tfs", *columns).join(
            found.groupBy("_block").agg(F.collect_list("_answer").alias("_answers")), "_block")

    def normed(self, met: DataFrame, norms: DataFrame | None, key: str) -> DataFrame:
        """``answered`` rows with the lengths of their documents, where these are handed over."""
        if norms is None:
            return met
        docs = self.rows.select("_block", "branch", F.posexplode(key).alias("_at", key))
        per_block = FT._with_norms(docs, norms, key, "left").groupBy("_block").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_at", "norm"))), lambda x: x["norm"]).alias("_norms"))
        return met.join(per_block, "_block")

    def repeats(self, key: str) -> bool:
        """Whether a key stands in several rows: their lengths are then found together, outside the blocks."""
        keys = self.rows.select("branch", F.explode(key).alias(key)).filter(F.col(key).isNotNull())
        return bool(keys.groupBy("branch", key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1").take(1))

    def _key_field(self, key: str) -> ST.StructField:
        return next(f for f in self.fields if f.name == key)

    def lengths(self, key: str) -> DataFrame:
        n = self.n

        def squares(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, plain in _rows(batches):
                pairs = _Weighed(row, plain, n)
                some = np.flatnonzero(pairs.sizes)
                yield pa.RecordBatch.from_arrays(
                    [row.column(key).flatten().take(pa.array(some)), pa.array([plain["branch"]] * len(some), pa.string()),
                     pa.array(pairs.square[some])], [key, "branch", "square"])

        schema = ST.StructType([self._key_field(key)]).add("branch", "string").add("square", "double")
        return self.answered(key).mapInArrow(squares, schema).groupBy(key, "branch").agg(
            F.sqrt(F.sum("square")).alias("norm"))

    def own_norms(self, key: str, norms: DataFrame | None = None) -> DataFrame | None:
        """Lengths that blocks cannot find by themselves: none where every key has one row."""
        if not self.repeats(key):
            return None
        return scale.stage(self.lengths(key), "lengths") if norms is None else norms

    def weighted(self, met: DataFrame, key: str) -> DataFrame:
        """``FT.weights`` of the blocks that met their answers."""
        found = self.pairs(self.normed(met, self.own_norms(key), key), key, full=True, known=True)
        return found.withColumn("w", F.col("u") * F.col("idf")).drop("u")

    def scaled(self, key: str, norms: DataFrame | None = None) -> Scaled:
        return Scaled(self, key, norms)

    def pairs(self, met: DataFrame, key: str, full: bool, known: bool) -> DataFrame:
        """Opened pairs of ``answered`` rows: ``(key, branch, term, *keep, tf, df, idf, u)``, with ``total_tf`` if
        ``full``; if ``known`` those with a length only, else ``u`` is null for the others."""
        n, rest = self.n, [f for f in self.fields if f.name != key]
        counts = ["tf", "df", "total_tf"] if full else ["tf", "df"]
        schema = ST.StructType([self._key_field(key)]).add("branch", "string").add("term", "string")
        for f in rest:
            schema = schema.add(f.name, f.dataType)
        for c in counts:
            schema = schema.add(c, ST.LongType())
        schema = schema.add("idf", "double").add("u", "double")
        names = schema.names

        def open_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, plain in _rows(batches):
                terms, pairs = expand_terms(plain["_terms"]), _Weighed(row, plain, n)
                norm, total = pairs.lengths(row, key), np.concatenate(pairs.total) if full else None
                columns = [row.column(f).flatten() for f in (key, *[f.name for f in rest])]
                chosen = np.flatnonzero(~np.isnan(norm[pairs.doc])) if known else np.arange(len(pairs.doc))
                for at in range(0, len(chosen), OPENED):
                    some = chosen[at:at + OPENED]
                    doc, place, tf = pairs.doc[some], pairs.place[some], pairs.tf[some]
                    u, docs = tf / norm[doc], pa.array(doc)
                    taken = [c.take(docs) for c in columns]
                    yield pa.RecordBatch.from_arrays(
                        [taken[0], pa.array([plain["branch"]], pa.string()).take(pa.array(np.zeros(len(some), np.int64))),
                         terms.take(pa.array(place)), *taken[1:], pa.array(tf), pa.array(pairs.df[place]),
                         *([pa.array(total[place])] if full else []), pa.array(pairs.idf[place]),
                         pa.array(u, mask=np.isnan(u))], names)

        return met.mapInArrow(open_pairs, schema)


def _cuts(ends: np.ndarray) -> list[tuple[int, int]]:
    """Runs of documents with about ``OPENED`` pairs."""
    at = np.unique(np.concatenate([[0], np.searchsorted(ends, np.arange(OPENED, ends[-1], OPENED)), [len(ends) - 1]]))
    return list(zip(at[:-1].tolist(), at[1:].tolist()))


class Scaled:
    """``tf / length`` of all pairs of ``blocks``, as ``FT.scaled`` gives them, still packed."""

    def __init__(self, blocks: Blocks, key: str, norms: DataFrame | None = None):
        self.blocks, self.key, self.norms = blocks, key, blocks.own_norms(key, norms)

    def rows(self) -> DataFrame:
        met = self.blocks.normed(self.blocks.answered("_terms", *self.blocks.keep), self.norms, self.key)
        return self.blocks.pairs(met, self.key, full=False, known=False)

    def class_sums(self, label: str, classes: Sequence) -> DataFrame:
        """``(branch, term, df, u, us)``: per term the sum of ``u``, and per class that or null where none is."""
        n, key = self.blocks.n, self.key
        values = pa.array(list(classes))

        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for row, plain in _rows(batches):
                pairs = _Weighed(row, plain, n)
                of = row.column(label).flatten()
                code = pc.fill_null(pc.index_in(of, values.cast(of.type)), len(values)).to_numpy().astype(np.int64)
                u = pairs.tf / pairs.lengths(row, key)[pairs.doc]
                cell, u = (pairs.place * (len(values) + 1) + code[pairs.doc])[~np.isnan(u)], u[~np.isnan(u)]
                order = np.argsort(cell, kind="stable")
                cell, u = cell[order], u[order]
                at = np.flatnonzero(np.diff(cell, prepend=-1))
                place, kind = np.divmod(cell[at], len(values) + 1)
                u = np.add.reduceat(u, at) if len(at) else u
                number = np.concatenate(pairs.numbers)[place]
                cuts = np.searchsorted(place, [0, *pairs.ends])
                spans = [(b, lo, hi) for b, lo, hi in zip(pairs.buckets, cuts[:-1], cuts[1:]) if lo < hi]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _, _ in spans], pa.int32()),
                     *[pa.array([squeeze(f(lo, hi)) for _, lo, hi in spans], pa.binary()) for f in (
                         lambda lo, hi: _steps(number[lo:hi]), lambda lo, hi: kind[lo:hi], lambda lo, hi: u[lo:hi])]],
                    ["_bucket", "_numbers", "_kinds", "_us"])

        def meet(bucket: pa.Table) -> pa.Table:
            known = bucket.filter(pc.is_valid(bucket.column("_terms")))
            sent = bucket.filter(pc.is_null(bucket.column("_terms")))
            names, df = expand_terms(known.column("_terms")[0].as_py()), expand(known.column("_dfs")[0].as_py())
            number = np.concatenate([np.zeros(0, np.int64),
                                     *[np.cumsum(expand(b)) for b in sent.column("_numbers").to_pylist()]])
            kind, u = (np.concatenate([np.zeros(0, t), *[expand(b) for b in sent.column(c).to_pylist()]])
                       for c, t in (("_kinds", np.int64), ("_us", np.float64)))
            seen = np.flatnonzero(np.bincount(number, minlength=len(names)))
            add = lambda at, x: np.bincount(at, weights=x, minlength=len(names)).astype(np.float64)
            own = []
            for c in range(len(values)):
                of = kind == c
                some = np.bincount(number[of], minlength=len(names))[seen] > 0
                own.append(pa.array(add(number[of], u[of])[seen], mask=~some))
            return pa.table({
                "branch": pa.array([known.column("branch")[0].as_py()] * len(seen), pa.string()),
                "term": names.take(pa.array(seen)), "df": pa.array(df[seen]),
                "u": pa.array(add(number, u)[seen]),
                **{f"_u{c}": o for c, o in enumerate(own)}})

        met = self.blocks.normed(self.blocks.answered(key, label, answers=["_numbers"]), self.norms, key)
        sent = met.mapInArrow(sums, "_bucket int, _numbers binary, _kinds binary, _us binary")
        empty = F.lit(None).cast("binary")
        table = self.blocks.met.filter("_block IS NULL").select("_bucket", "branch", "_terms", "_dfs")
        both = table.select("*", *[empty.alias(c) for c in ("_numbers", "_kinds", "_us")]).unionByName(
            sent, allowMissingColumns=True)
        return both.groupBy("_bucket").applyInArrow(
            meet, "branch string, term string, df bigint, u double" + "".join(f", _u{c} double" for c in range(len(values))))
