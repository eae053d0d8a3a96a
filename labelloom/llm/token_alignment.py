"""Cross-tokenizer alignment: how the tokens of two vocabularies cover the same bytes, counted corpus-wide.

Per document (its text without special tokens; their strings are plain text):

* A: ``" " + text`` by the byte-level BPE ``byte_bpe_50k.json``; a token's bytes are its vocabulary entry
  decoded by the byte-level table (ids computed from the same vocabulary's merge ranks by tiktoken, three
  times faster; a test holds them equal to the ``tokenizers`` ids);
* B: ``text`` by ``piece_bpe_32k.model`` (which adds the leading space); a piece's bytes are its UTF-8 with
  U+2581 as a space, ``<0xHH>`` the byte HH.

If either side's joined bytes differ from ``" " + text`` (or the text is null or empty) the document has no
tokens and all counts are 0. Byte offsets where an A and a B token both end cut the document into groups; a
link is a pair of an A and a B token occurrence whose byte ranges overlap. Walking the union of both sides'
end offsets gives every link once: each elementary byte segment lies in one A and one B token.

Counting (the corpus-wide part) is Spark's external shuffle: every document emits its distinct
``(A id, B id)`` pairs once, the pairs are hash-partitioned into compressed sorted runs that are merged and
counted by key (map-side partial counts first, so a pair every document holds is one row per task); the
highest count of each A id comes from a second aggregate over A ids; both stream back to the documents' link
occurrences by a join that is broadcast when counted small and salted for hot pairs otherwise.

Output per document: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``; ``n_best``
counts links whose pair count is the corpus-wide highest of their A id (ties included), ``count_sum`` sums the
pair counts over links, ``groups_sha256`` hashes ``a1,a2|b1;a3|b2,b3`` ('' without tokens).

Defined cases: null or empty texts and texts either side cannot reproduce give zeros and ''; repeated rows
are separate documents (each counts for a pair); null ids stay null; very long texts are encoded whole; an
empty table gives no rows; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale

A_FILE = "byte_bpe_50k.json"
# The same vocabulary as merge ranks, read by a faster encoder; tests hold both to equal ids.
A_RANKS = "byte_bpe_50k.tiktoken"
B_FILE = "piece_bpe_32k.model"
SPACE = "▁"

OUT = pa.schema([("doc_id", pa.int64()), ("_row", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                 ("n_groups", pa.int64()), ("groups_sha256", pa.string()),
                 ("_pairs", pa.list_(pa.int64())), ("_occ", pa.list_(pa.int64()))])
SCHEMA = ("doc_id long, _row long, n_a long, n_b long, n_groups long, groups_sha256 string, "
          "_pairs array<long>, _occ array<long>")


def _byte_level_table() -> dict[str, int]:
    """The byte-level BPE alphabet: printable Latin-1 bytes stand for themselves, the rest for 256 + n."""
    keep = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1),
            *range(ord("®"), ord("ÿ") + 1)]
    table, extra = {chr(b): b for b in keep}, 0
    for b in range(256):
        if b not in keep:
            table[chr(256 + extra)] = b
            extra += 1
    return table


class _Sides:
    """Both tokenizers and the bytes of every id, loaded once per Python worker."""

    _loaded: _Sides | None = None

    def __init__(self, folder: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on every core already
        import public_tokenizers
        import sentencepiece
        from tokenizers import Tokenizer
        path = (lambda n: os.path.join(folder, n)) if folder else public_tokenizers.path
        self.a = Tokenizer.from_file(path(A_FILE))
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=path(B_FILE))
        import base64
        import tiktoken
        with open(path(A_RANKS), "rb") as ranks:
            merges = {base64.b64decode(t): int(r) for t, r in map(bytes.split, ranks)}
        self.fast_a = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=merges,
                                        special_tokens={})
        table = _byte_level_table()
        size_a = self.a.get_vocab_size(with_added_tokens=True)
        self.a_bytes = []
        for i in range(size_a):
            token = self.a.id_to_token(i) or ""
            self.a_bytes.append(bytes(table[c] for c in token) if all(c in table for c in token) else b"")
        self.b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            if self.b.is_byte(i):
                self.b_bytes.append(bytes([int(piece[3:5], 16)]))
            elif self.b.is_control(i) or self.b.is_unknown(i):
                self.b_bytes.append(b"")
            else:
                self.b_bytes.append(piece.replace(SPACE, " ").encode("utf-8"))
        self.a_len = np.array([len(x) for x in self.a_bytes], dtype=np.int64)
        self.b_len = np.array([len(x) for x in self.b_bytes], dtype=np.int64)
        self.a_flat = np.frombuffer(b"".join(self.a_bytes), np.uint8)
        self.b_flat = np.frombuffer(b"".join(self.b_bytes), np.uint8)
        self.a_off = np.cumsum(self.a_len) - self.a_len
        self.b_off = np.cumsum(self.b_len) - self.b_len

    @classmethod
    def get(cls, folder: str | None) -> _Sides:
        if cls._loaded is None:
            cls._loaded = cls(folder)
        return cls._loaded


def _spells(ids: np.ndarray, lengths: np.ndarray, offsets: np.ndarray, flat: np.ndarray, want: np.ndarray) -> bool:
    """Whether the tokens' bytes, joined, are ``want``: one gather from the table of all tokens' bytes."""
    sizes = lengths[ids]
    if int(sizes.sum()) != len(want):
        return False
    starts = np.cumsum(sizes) - sizes
    at = np.repeat(offsets[ids] - starts, sizes) + np.arange(len(want))
    return bool(np.array_equal(flat[at], want))


def _groups_text(a: np.ndarray, b: np.ndarray, ga: np.ndarray, gb: np.ndarray) -> bytes:
    """``a1,a2|b1;a3|b2,b3`` as bytes, built by array operations: each id's digits and the sign after it."""
    sep_a = np.where(np.append(ga[1:] == ga[:-1], False), ord(","), ord("|"))
    sep_b = np.where(np.append(gb[1:] == gb[:-1], False), ord(","), ord(";"))
    order = np.lexsort((np.concatenate([np.arange(len(a)), np.arange(len(b))]),
                        np.concatenate([np.zeros(len(a), np.int8), np.ones(len(b), np.int8)]),
                        np.concatenate([ga, gb])))
    values = np.concatenate([a, b])[order]
    seps = np.concatenate([sep_a, sep_b])[order]
    width = max(1, len(str(int(values.max())))) if len(values) else 1
    powers = 10 ** np.arange(width - 1, -1, -1, dtype=np.int64)
    digits = (values[:, None] // powers) % 10 + ord("0")
    shown = np.arange(width)[None, :] >= (width - np.maximum(1, np.floor(np.log10(np.maximum(values, 1))).astype(
        np.int64) + 1))[:, None]
    table = np.concatenate([digits, seps[:, None]], axis=1).astype(np.uint8)
    mask = np.concatenate([shown, np.ones((len(values), 1), bool)], axis=1)
    return table[mask].tobytes()[:-1]


def align_one(sides: _Sides, text: str | None, ids_a: list[int] | None = None, ids_b: list[int] | None = None):
    """``(n_a, n_b, n_groups, groups_text, pair_keys, occurrences)`` of one text; zeros when it has no tokens."""
    if not text:
        return 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    target = (" " + text).encode("utf-8")
    a = np.asarray(ids_a if ids_a is not None else sides.a.encode(" " + text, add_special_tokens=False).ids,
                   dtype=np.int64)
    b = np.asarray(ids_b if ids_b is not None else sides.b.encode(text), dtype=np.int64)
    want = np.frombuffer(target, np.uint8)
    if (len(a) == 0 or len(b) == 0 or not _spells(a, sides.a_len, sides.a_off, sides.a_flat, want)
            or not _spells(b, sides.b_len, sides.b_off, sides.b_flat, want)):
        return 0, 0, 0, b"", np.zeros(0, np.int64), np.zeros(0, np.int64)
    a_end, b_end = np.cumsum(sides.a_len[a]), np.cumsum(sides.b_len[b])
    # groups: cut where both sides end
    common = np.intersect1d(a_end, b_end)
    ga, gb = np.searchsorted(common, a_end), np.searchsorted(common, b_end)
    groups = _groups_text(a, b, ga, gb)
    # links: every elementary segment between consecutive ends lies in one A and one B token
    ends = np.union1d(a_end, b_end)
    keys = (a[np.searchsorted(a_end, ends)] << 32) | b[np.searchsorted(b_end, ends)]
    pairs, occ = np.unique(keys, return_counts=True)
    return len(a), len(b), len(common), groups, pairs, occ.astype(np.int64)


def _encode(batches: Iterator[pa.RecordBatch], folder: str | None) -> Iterator[pa.RecordBatch]:
    sides = _Sides.get(folder)
    for batch in batches:
        ids, rows, texts = batch.column("doc_id"), batch.column("_row"), batch.column("text").to_pylist()
        good = [i for i, t in enumerate(texts) if t]
        enc_a = sides.fast_a.encode_ordinary_batch([" " + texts[i] for i in good], num_threads=1) if good else []
        enc_b = sides.b.encode([texts[i] for i in good]) if good else []
        found = {i: (ea, eb) for i, ea, eb in zip(good, enc_a, enc_b)}
        cols = {k: [] for k in ("n_a", "n_b", "n_groups", "groups_sha256", "_pairs", "_occ")}
        for i, text in enumerate(texts):
            n_a, n_b, n_g, groups, pairs, occ = align_one(sides, text, *found.get(i, (None, None)))
            cols["n_a"].append(n_a)
            cols["n_b"].append(n_b)
            cols["n_groups"].append(n_g)
            cols["groups_sha256"].append(hashlib.sha256(groups).hexdigest() if n_a else "")
            cols["_pairs"].append(pairs)
            cols["_occ"].append(occ)
        yield pa.RecordBatch.from_arrays(
            [ids.cast(pa.int64()), rows, *[pa.array(cols[k], type=OUT.field(k).type)
                                           for k in ("n_a", "n_b", "n_groups", "groups_sha256", "_pairs", "_occ")]],
            schema=OUT)


def align(docs: DataFrame, folder: str | None = None, batch_rows: int = 256) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256`` per row of ``docs``."""
    spark = docs.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(batch_rows))
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
                         F.monotonically_increasing_id().alias("_row"))
    encoded = scale.stage(source.mapInArrow(lambda it: _encode(it, folder), SCHEMA), "alignment")
    links = encoded.select("_row", F.explode(F.arrays_zip("_pairs", "_occ")).alias("_p")).select(
        "_row", F.col("_p._pairs").alias("pair"), F.col("_p._occ").alias("occ"))
    # corpus-wide: documents per pair, then each A id's highest count
    counts = links.groupBy("pair").agg(F.count(F.lit(1)).alias("docs"))
    best = counts.groupBy(F.shiftright("pair", 32).alias("_a")).agg(F.max("docs").alias("_top"))
    counted = scale.stage(counts.join(best, F.shiftright(counts["pair"], 32) == best["_a"])
                          .select("pair", "docs", (F.col("docs") == F.col("_top")).alias("_best")), "pair-counts")
    # contributions back to the documents
    per_doc = (scale.attach(links, counted, ["pair"], "inner")
               .groupBy("_row").agg(F.sum("occ").alias("n_links"),
                                    F.sum(F.when(F.col("_best"), F.col("occ")).otherwise(0)).alias("n_best"),
                                    F.sum(F.col("occ") * F.col("docs")).alias("count_sum")))
    zero = F.lit(0).cast("long")
    return (encoded.drop("_pairs", "_occ").join(per_doc, "_row", "left")
            .select("doc_id", "n_a", "n_b", "n_groups",
                    *[F.coalesce(F.col(c), zero).cast("long").alias(c) for c in ("n_links", "n_best", "count_sum")],
                    "groups_sha256"))
