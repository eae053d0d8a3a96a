"""Packing of documents into training sequences, neighbours chosen by a sharded BM25 index.

Documents are tokenised once and written with their token ids. A shard takes documents that lie together
in the order of their lexical key (the smallest hash among the eight terms with the highest ids, which the
vocabulary learned last and are its rarest, so that documents about the same things meet) up to a bounded number of tokens; the number of shards grows with the corpus. Each shard
builds an inverted index of its own documents, with corpus-wide document frequencies and mean length. The
longest unused document is the seed: its full windows are cut off, its rest opens a window, and its unused
neighbours by falling BM25 score fill the window greedily; the last of them is cut, and its rest opens the
next window. Documents that share no term with the seed follow in the order of their keys when none else
is left. So every window of a shard is full but its last; that is padded to 4096, or to nothing where its
length is a power of two.

Every id lies in exactly one piece. Groups of copies and frequent terms need no care: shards are cut by
size, and posting lists are those of one shard.

Defined cases: a null or empty text has one id, the end id; repeated rows are packed once each; ties are
broken by key and row number; an empty table gives no piece. Extra columns are ignored.
"""

from __future__ import annotations

import os
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.llm.inputs import pieces, text_or_empty

WINDOW, END = 4096, 2
SHARD_TOKENS = 600_000
K1, B = 1.2, 0.75
ENCODED = 2048  # texts encoded together
CACHE = 300_000  # parts of texts whose ids a worker remembers
MERGED = 50_000  # words that go through the merges together
VOCABULARY = "word_bpe_49k.json"


def tokenizer_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


# Words of these letters lower-case one to one, need no other normalisation and are one unit of the vocabulary;
# so are the ASCII marks after them, but for the apostrophe, which may open an ending.
PLAIN = r"^(?P<word>[A-Za-zÀ-ÖØ-öø-ÿ]+)(?P<after>[!-&(-/:-@\[-`{-~]*)$"


def byte_letters() -> dict[int, str]:
    """How a byte-level vocabulary writes bytes: visible Latin-1 characters as they are, the others in order
    from code point 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    return {b: chr(b) for b in seen} | {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in seen)}


def _listed(values: pa.Array) -> list:
    return values.to_numpy(zero_copy_only=False).tolist()


class Encoder:
    """Token ids of texts. The vocabulary's rules never join characters across a blank or a line break,
    so the ids of a text are those of its blank-separated parts; common parts are encoded once. Plain words
    go to the tokenizer's merges directly and together, one a line, without the passes that would leave them
    as they are; the last id of a word tells where it ends."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        from tokenizers import Tokenizer, pre_tokenizers
        self.tokenizer = Tokenizer.from_file(path)
        self.kind = "<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4"
        self.merges = Tokenizer(self.tokenizer.model)
        self.merges.pre_tokenizer = pre_tokenizers.CharDelimiterSplit("\n")
        vocabulary = self.merges.get_vocab()
        self.closing = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closing[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.known: dict[str, bytes] = {}
        self.marks: dict[str, bytes] = {}
        self.letters = byte_letters()

    def _written(self, ids: list[int]) -> bytes:
        return np.array(ids, self.kind).tobytes()

    def _slow(self, parts: list[str]) -> list[bytes]:
        return [self._written(e.ids) for e in self.tokenizer.encode_batch_fast(parts, add_special_tokens=False)]

    def _merged(self, words: list[str]) -> list[bytes]:
        """The ids of lower-case plain words."""
        out, letters = [], self.letters
        for at in range(0, len(words), MERGED):
            some = words[at:at + MERGED]
            lines = "\n".join(some)
            if not lines.isascii():
                lines = "\n".join([w if w.isascii() else "".join(map(letters.__getitem__, w.encode())) for w in some])
            ids = np.array(array("I", self.merges.encode_batch_fast([lines], add_special_tokens=False)[0].ids))
            ends = ((np.flatnonzero(self.closing[ids]) + 1) * np.dtype(self.kind).itemsize).tolist()
            if len(ends) != len(some):
                raise ValueError("the vocabulary does not mark the ends of words")
            written = ids.astype(self.kind).tobytes()
            out += [written[i:j] for i, j in zip([0, *ends], ends)]
        return out

    def _learn(self, fresh: list[str]) -> None:
        known, marks = self.known, self.marks
        source = pa.array(fresh, pa.string())
        cut = pc.extract_regex(source, PLAIN)
        plain = cut.is_valid()
        rest = _listed(source.filter(pc.invert(plain)))
        known.update(zip(rest, self._slow(rest)))
        cut = cut.filter(plain)
        words = pc.utf8_lower(pc.struct_field(cut, "word")).dictionary_encode()
        after = pc.struct_field(cut, "after").dictionary_encode()
        kinds = _listed(after.dictionary)
        new = [a for a in kinds if a and a not in marks]
        if new:
            marks.update(zip(new, self._slow(new)))
        merged, ends = self._merged(_listed(words.dictionary)), [marks[a] if a else b"" for a in kinds]
        known.update(zip(_listed(source.filter(plain)), [
            merged[w] + ends[a] for w, a in zip(_listed(words.indices), _listed(after.indices))]))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """Arrow cuts the batch into parts and numbers them; only its distinct parts are looked up."""
        known = self.known
        if len(known) > CACHE:
            known.clear()
            self.marks.clear()
        parts = pc.split_pattern(pc.replace_substring(pa.array(texts, pa.large_string()), "\n", " "), " ")
        coded = parts.flatten().dictionary_encode()
        words = _listed(coded.dictionary)
        written = list(map(known.get, words))
        if None in written:
            self._learn([p for p, ids in zip(words, written) if ids is None])
            written = [known[p] if ids is None else ids for p, ids in zip(words, written)]
        sizes = np.fromiter(map(len, written), np.int64, len(written)) // np.dtype(self.kind).itemsize
        of = coded.indices.to_numpy()
        lengths = sizes[of]
        ends = np.cumsum(lengths)
        starts = (np.cumsum(sizes) - sizes)[of]
        # A part's ids follow each other, so a place counts on from where its part starts.
        places = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        ids = np.frombuffer(b"".join(written), self.kind)[places]
        return np.split(ids, np.append(0, ends)[parts.offsets.to_numpy()[1:-1]]) if texts else []


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """One encoder for each worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def distinct(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct ids in order and their counts."""
    ordered = np.sort(ids)  # equal ids need no order, and the default sort is several times faster
    at = np.flatnonzero(np.append(True, ordered[1:] != ordered[:-1]))
    return ordered[at], np.diff(np.append(at, len(ordered)))


def _terms(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``distinct`` of many documents that are not empty by one sort: (document, id, count), ordered by both."""
    sizes = np.fromiter(map(len, docs), np.int64, len(docs))
    ids = np.concatenate(docs)
    # A pair takes four bytes where documents are few and ids are of two.
    bits, kind = (16, np.uint32) if ids.dtype.itemsize <= 2 and len(docs) <= 1 << 16 else (32, np.uint64)
    pairs, counts = distinct(np.repeat(np.arange(len(docs), dtype=kind) << kind(bits), sizes) | ids.astype(kind, copy=False))
    return (pairs >> kind(bits)).astype(np.int64), (pairs & kind((1 << bits) - 1)).astype(np.int64), counts


def lexical_keys(doc: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """The key of every document, from its distinct ids in order: the smallest hash among its eight highest ids."""
    starts = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
    sizes = np.diff(np.append(starts, len(doc)))
    rare = np.repeat(starts + sizes, sizes) - np.arange(len(doc)) <= 8
    hashed = ids[rare].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(1)
    firsts = np.cumsum(np.minimum(sizes, 8)) - np.minimum(sizes, 8)
    return np.minimum.reduceat(hashed, firsts).astype(np.int64)


def tokenised(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (little-endian, ``width`` bytes each, with the end id), ``n``, ``key``; no row moves.

    After its documents, each task has one row with ``seen`` instead: in how many of them each id occurs."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), text_or_empty(text).alias("text"))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros(0, np.int64)
        for frame in pieces(frames, ENCODED):
            code = encoder(path)
            ids = [np.append(i, np.array(END, code.kind)) for i in code.encode(list(frame["text"]))]
            if not ids:
                continue
            doc, term, _ = _terms(ids)
            found = np.bincount(term)
            seen = np.pad(seen, (0, max(0, len(found) - len(seen))))
            seen[:len(found)] += found
            yield pd.DataFrame({"doc_id": frame["doc_id"], "ids": [i.tobytes() for i in ids],
                                "width": [i.itemsize for i in ids], "n": [len(i) for i in ids],
                                "key": lexical_keys(doc, term), "seen": None})
        if len(seen):
            yield pd.DataFrame({"doc_id": [None], "ids": [None], "width": [None], "n": [None], "key": [None],
                                "seen": [seen.astype("<i8").tobytes()]}, dtype=object)

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, ids binary, width int, n bigint, key bigint, seen binary")


def _ids(frame: pd.DataFrame) -> list[np.ndarray]:
    return [np.frombuffer(i, f"<u{w}") for i, w in zip(frame["ids"], frame["width"])]


def _frequencies(seen: DataFrame) -> np.ndarray:
    """Document frequency of every id, from what the tokenising tasks have counted."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for counts in frame["seen"]:
                counts = np.frombuffer(counts, "<i8")
                at = np.flatnonzero(counts)
                yield pd.DataFrame({"id": at, "df": counts[at]})

    rows = seen.select("seen").mapInPandas(run, "id bigint, df bigint")
    found = rows.groupBy("id").agg(F.sum("df").alias("df")).toPandas()
    out = np.zeros(int(found["id"].max()) + 1 if len(found) else 1, np.int64)
    out[found["id"].to_numpy(np.int64)] = found["df"]
    return out


class Index:
    """An inverted index over the documents of one shard with BM25 weights."""

    def __init__(self, docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float):
        doc, term, count = _terms(docs)
        self.terms = np.split(term, np.flatnonzero(doc[1:] != doc[:-1]) + 1)
        length = np.array([len(i) for i in docs], float)
        idf = np.log1p((n_docs - df[term] + 0.5) / (df[term] + 0.5))
        weight = idf * count * (K1 + 1) / (count + K1 * (1 - B + B * length[doc] / mean))
        # Ids of two bytes are ordered by counting.
        order = np.argsort(term.astype(np.uint16) if term.max() < 1 << 16 else term, kind="stable")
        self.doc, self.weight, term = doc[order], weight[order], term[order]
        self.start = np.searchsorted(term, np.arange(int(term[-1]) + 2)).tolist()

    def scores(self, d: int, size: int) -> np.ndarray:
        """BM25 score of every document of the shard for the distinct terms of document ``d``."""
        start = self.start
        spans = [slice(start[t], start[t + 1]) for t in self.terms[d].tolist()]
        return np.bincount(np.concatenate([self.doc[s] for s in spans]),
                           np.concatenate([self.weight[s] for s in spans]), size)


def pack_shard(docs: list[np.ndarray], df: np.ndarray, n_docs: int, mean: float) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) of every piece of a shard."""
    index = Index(docs, df, n_docs, mean)
    unused = np.ones(len(docs), bool)
    by_length = sorted(range(len(docs)), key=lambda d: (-len(docs[d]), d))
    pieces_, sequence, filled, at = [], 0, 0, 0

    def put(d: int) -> None:
        nonlocal sequence, filled
        start, n = 0, len(docs[d])
        while start < n:
            take = min(n - start, WINDOW - filled)
            pieces_.append((d, start, take, sequence, filled))
            start, filled = start + take, filled + take
            if filled == WINDOW:
                sequence, filled = sequence + 1, 0
        unused[d] = False

    last = None
    while at < len(by_length):
        seed = by_length[at]
        if not unused[seed]:
            at += 1
            continue
        if filled == 0 or last is None:
            put(seed)
            last = seed
            if filled == 0:
                continue
        # The document whose ids opened the window asks for neighbours until it is full.
        opened = sequence
        scores = np.where(unused, index.scores(last, len(docs)), -1.0)
        for d in np.argsort(-scores, kind="stable"):
            if not unused[d]:
                break
            put(int(d))
            last = int(d)
            if sequence != opened:
                break
    return pieces_


def _packer(df: np.ndarray, n_docs: int, mean: float, columns: list[str]):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        # One partition is one shard, bounded by the number of shards that was asked for.
        from pyspark import TaskContext
        parts = [f for f in frames if len(f)]
        if not parts:
            return
        shard = pd.concat(parts, ignore_index=True).sort_values(["key", "row"], kind="stable", ignore_index=True)
        docs = _ids(shard)
        first = TaskContext.get().partitionId() << 32
        rows = pack_shard(docs, df, n_docs, mean)
        at = [r[0] for r in rows]
        yield pd.DataFrame({
            "doc_id": shard["doc_id"].to_numpy()[at], "start": [r[1] for r in rows], "length": [r[2] for r in rows],
            "ids_crc32": [zlib.crc32(docs[d][s:s + n].astype("<u4").tobytes()) for d, s, n, _, _ in rows],
            "doc_tokens": shard["n"].to_numpy()[at], "sequence_id": [first + r[3] for r in rows],
            "offset": [r[4] for r in rows]})[columns]

    return run


def pack(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text",
         shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """One row per piece: ``doc_id``, ``start``, ``length``, ``ids_crc32``, ``doc_tokens``,
    ``sequence_id``, ``offset``."""
    made = tokenised(docs, path or tokenizer_path(), doc_id, text)
    kind = made.schema["doc_id"].dataType.simpleString()
    stored = scale.stage(made.withColumn("row", F.monotonically_increasing_id()), "tokens")
    n_docs, tokens = stored.agg(F.count("n"), F.coalesce(F.sum("n"), F.lit(0))).first()
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    schema = f"doc_id {kind}, " + ", ".join(f"`{c}` bigint" for c in names[1:])
    if not n_docs:
        return docs.sparkSession.createDataFrame([], schema)
    df = _frequencies(stored.filter("seen is not null"))
    stored = stored.filter("n is not null").drop("seen")
    shards = max(1, -(-tokens // shard_tokens))
    return stored.repartitionByRange(shards, "key", "row").mapInPandas(_packer(df, n_docs, tokens / n_docs, names), schema)
