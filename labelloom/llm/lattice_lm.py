"""Language model over a subword lattice: the probability of a text is the sum over all its segmentations.

The pieces are those of an existing vocabulary (``piece_bpe_32k.model``). Its scores are merge ranks, not
probabilities, so they only give the first segmentation of the training words; from there on the pieces'
weights are counts in the training texts (one half added to each), improved by ``ROUNDS`` of expectation
maximisation over all segmentations. A forward recursion in log space adds up the segmentations of a word;
no piece reaches across words, so a text's log probability is the sum over its words, plus that of the end
piece. Characters outside the vocabulary are spelled by its byte pieces.

Words are runs of characters other than blank, tab and line ends, A-Z lower-cased. Counts of all distinct
words are gathered from all documents (they grow with the corpus) and stay a table: each distinct word is
segmented once. Words that make up at least 1/``FREQUENT`` of all tokens go to every task (so there can be
``FREQUENT`` of them at most); the rest of a document's words join the table by shuffle, where no word is
frequent any more.

Defined cases: null and empty texts are the end piece alone; a null id is neither held out nor learned from;
repeated rows count and appear repeatedly; with no training text every piece weighs the same and counts are
zero; an empty table gives no rows. Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom import scale
from labelloom.llm.inputs import crc_mod, pieces

VOCABULARY = "piece_bpe_32k.model"
FREQUENT = 1 << 19
ROUNDS = 1
START = "▁"  # opens a word in the vocabulary
FLUSH = 400_000


def vocabulary_path() -> str:
    import public_tokenizers
    return public_tokenizers.path(VOCABULARY)


def words(text: bytes | None) -> list[bytes]:
    """ASCII white space splits; bytes.lower changes A-Z only."""
    return text.lower().split() if text else []


class Pieces:
    """The usable pieces of a vocabulary: not across words, no special ones but bytes and the end."""

    def __init__(self, path: str):
        import sentencepiece
        self.path, self.model = path, sentencepiece.SentencePieceProcessor(model_file=path)
        self.size, self.end = self.model.get_piece_size(), self.model.eos_id()
        self.bytes = [self.model.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.ids = {}
        for i in range(self.size):
            piece = self.model.id_to_piece(i)
            if not (self.model.is_control(i) or self.model.is_unknown(i) or self.model.is_byte(i)) and START not in piece[1:]:
                self.ids[piece] = i
        self.longest = max(map(len, self.ids), default=1)
        self.usable = np.zeros(self.size, bool)
        self.usable[[*self.ids.values(), *self.bytes, self.end]] = True


_loaded: dict[str, Pieces] = {}


def loaded(path: str) -> Pieces:
    """One vocabulary for each worker process."""
    if path not in _loaded:
        _loaded[path] = Pieces(path)
    return _loaded[path]


class Lattice:
    """Piece weights (natural logarithms) and the recursions over segmentations."""

    def __init__(self, path: str, weights: np.ndarray):
        own = loaded(path)
        self.own, self.weights = own, weights
        self.log = {p: float(weights[i]) for p, i in own.ids.items()}
        self.byte = [float(weights[i]) for i in own.bytes]

    def _spelled(self, c: str) -> float | None:
        """A character that is no piece is spelled by bytes."""
        return None if c in self.log else sum(self.byte[b] for b in c.encode("utf-8", "replace"))

    def forward(self, text: str) -> list[float]:
        """Log probability of all segmentations of every prefix."""
        out, get, longest = [0.0], self.log.get, self.own.longest
        for j in range(1, len(text) + 1):
            terms = []
            for i in range(max(0, j - longest), j):
                p = get(text[i:j])
                if p is not None:
                    terms.append(out[i] + p)
            spelled = self._spelled(text[j - 1])
            if spelled is not None:
                terms.append(out[j - 1] + spelled)
            top = max(terms)
            out.append(top if len(terms) == 1 else top + math.log(sum(math.exp(t - top) for t in terms)))
        return out

    def word(self, word: bytes) -> float:
        return self.forward(START + word.decode("utf-8", "replace"))[-1]

    def _alike(self, texts: list[str]) -> Iterator[tuple[list[int], np.ndarray | None]]:
        """Groups of texts of one length with the piece ids of all their parts: [text, first, end], -1 for none.

        Long texts, and those with a character that is spelled, come one by one without ids.
        """
        by_length: dict[int, list[int]] = {}
        for at, text in enumerate(texts):
            plain = len(text) <= 32 and all(c in self.log for c in set(text))
            by_length.setdefault(len(text) if plain else -1 - at, []).append(at)
        get, longest = self.own.ids.get, self.own.longest
        for n, rows in by_length.items():
            if n < 0:
                yield rows, None
                continue
            own = [texts[at] for at in rows]
            ids = np.full((len(own), n, n + 1), -1, np.int32)
            for i in range(n):
                for j in range(i + 1, min(n, i + longest) + 1):
                    ids[:, i, j] = [get(t[i:j], -1) for t in own]
            yield rows, ids

    def _sums(self, parts: np.ndarray) -> np.ndarray:
        top = parts.max(1)
        return top + np.log(np.exp(parts - top[:, None]).sum(1))

    def _ahead(self, logs: np.ndarray) -> np.ndarray:
        """The forward recursion of texts of one length, [text, end]."""
        m, n = logs.shape[:2]
        out = np.zeros((m, n + 1))
        for j in range(1, n + 1):
            low = max(0, j - self.own.longest)
            out[:, j] = self._sums(out[:, low:j] + logs[:, low:j, j])
        return out

    def _logs(self, ids: np.ndarray) -> np.ndarray:
        return np.append(self.weights, -np.inf)[ids]

    def all_words(self, words: list[bytes]) -> np.ndarray:
        """``word`` of many words."""
        texts = [START + w.decode("utf-8", "replace") for w in words]
        out = np.zeros(len(texts))
        for rows, ids in self._alike(texts):
            out[rows] = self.forward(texts[rows[0]])[-1] if ids is None else self._ahead(self._logs(ids))[:, -1]
        return out

    def expect_all(self, words: list[bytes], weights: np.ndarray, into: np.ndarray) -> None:
        """``expect`` of many words."""
        texts = [START + w.decode("utf-8", "replace") for w in words]
        for rows, ids in self._alike(texts):
            if ids is None:
                self.expect(words[rows[0]], float(weights[rows[0]]), into)
                continue
            logs = self._logs(ids)
            ahead, n = self._ahead(logs), ids.shape[1]
            back = np.zeros((len(rows), n + 1))
            for i in range(n - 1, -1, -1):
                high = min(n, i + self.own.longest) + 1
                back[:, i] = self._sums(logs[:, i, i + 1:high] + back[:, i + 1:high])
            share = np.exp(ahead[:, :n, None] + logs + back[:, None, :] - ahead[:, -1][:, None, None])
            share *= weights[rows][:, None, None]
            known = ids >= 0
            into += np.bincount(ids[known], share[known], len(into))

    def expect(self, word: bytes, weight: float, into: np.ndarray) -> None:
        """Add the expected number of every piece in a word, times ``weight``."""
        text = START + word.decode("utf-8", "replace")
        ahead, n = self.forward(text), len(text)
        back = [0.0] * (n + 1)
        total, get, ids = ahead[-1], self.log.get, self.own.ids
        for i in range(n - 1, -1, -1):
            terms = []
            for j in range(i + 1, min(n, i + self.own.longest) + 1):
                p = get(text[i:j])
                if p is not None:
                    terms.append(p + back[j])
                    into[ids[text[i:j]]] += weight * math.exp(ahead[i] + p + back[j] - total)
            spelled = self._spelled(text[i])
            if spelled is not None:
                terms.append(spelled + back[i + 1])
                share = weight * math.exp(ahead[i] + spelled + back[i + 1] - total)
                for b in text[i].encode("utf-8", "replace"):
                    into[self.own.bytes[b]] += share
            top = max(terms)
            back[i] = top + math.log(sum(math.exp(t - top) for t in terms))


def logarithms(path: str, counts: np.ndarray, ends: int) -> np.ndarray:
    """Log weights of the pieces from their counts; unusable ones weigh nothing."""
    own = loaded(path)
    full = counts.astype(np.float64) + 0.5
    full[own.end] = ends + 0.5
    full[~own.usable] = 0
    with np.errstate(divide="ignore"):
        return np.log(full / full.sum())


def _count_rows(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    learned, other = Counter(), Counter()

    def out() -> pd.DataFrame:
        every = [*learned, *(w for w in other if w not in learned)]
        made = pd.DataFrame({"word": every, "c": [learned.get(w, 0) for w in every],
                             "other": [other.get(w, 0) for w in every]})
        learned.clear(), other.clear()
        return made

    for frame in pieces(frames, 256):
        for text, train in zip(frame["text"], frame["train"]):
            (learned if train else other).update(words(text))
        if len(learned) + len(other) > FLUSH:
            yield out()
    yield out()


def _summed(parts: DataFrame, size: int) -> np.ndarray:
    """Sums of (id, n) rows as one array of the vocabulary's size."""
    found = parts.groupBy("id").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(size)
    out[found["id"].to_numpy(np.int64)] = found["n"]
    return out


def piece_weights(counts: DataFrame, ends: int, path: str, rounds: int = ROUNDS) -> np.ndarray:
    """Fit the pieces on ``(word, c)``."""
    size = loaded(path).size

    def first(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, seen = loaded(path), np.zeros(size)
        for frame in pieces(frames, 8192):
            texts = [w.decode("utf-8", "replace") for w in frame["word"]]
            coded = own.model.encode(texts, num_threads=1)
            c = np.repeat(frame["c"].to_numpy(float), [len(ids) for ids in coded])
            np.add.at(seen, np.array([i for ids in coded for i in ids], np.int64), c)
        yield pd.DataFrame({"id": np.flatnonzero(seen), "n": seen[seen > 0]})

    learned = counts.filter("c > 0").select("word", "c")
    weights = logarithms(path, _summed(learned.mapInPandas(first, "id bigint, n double"), size), ends)
    for _ in range(rounds):
        def again(frames: Iterator[pd.DataFrame], weights=weights) -> Iterator[pd.DataFrame]:
            lattice, seen = Lattice(path, weights), np.zeros(size)
            for frame in pieces(frames, 4096):
                lattice.expect_all(list(frame["word"]), frame["c"].to_numpy(float), seen)
            yield pd.DataFrame({"id": np.flatnonzero(seen), "n": seen[seen > 0]})

        weights = logarithms(path, _summed(learned.mapInPandas(again, "id bigint, n double"), size), ends)
    return weights


def score(docs: DataFrame, path: str | None = None, doc_id: str = "doc_id", text: str = "text",
          rounds: int = ROUNDS) -> DataFrame:
    """One row per document: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score`` (word counts alone), ``score`` (log10 of the lattice probability)."""
    path = path or vocabulary_path()
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").cast("binary").alias("text"))
    rows = rows.withColumn("held_out", F.coalesce(crc_mod("doc_id", 5) == 1, F.lit(False)))
    rows = rows.withColumn("train", ~F.col("held_out") & F.col("doc_id").isNotNull())
    made = rows.select("text", "train").mapInPandas(_count_rows, "word binary, c bigint, other bigint")
    counts = scale.stage(made.groupBy("word").agg(F.sum("c").alias("c"), F.sum("other").alias("other")), "words")
    ends = rows.filter("train").count()
    distinct, total = counts.agg(F.count(F.when(F.col("c") > 0, True)), F.coalesce(F.sum("c"), F.lit(0))).first()
    tokens, kinds = total + ends, distinct + (ends > 0)
    bottom = math.log10(tokens + 0.5 * (kinds + 1))
    weights = piece_weights(counts, ends, path, rounds)
    end_base, end_score = math.log10(ends + 0.5) - bottom, float(weights[loaded(path).end])

    every = F.col("c") + F.col("other")
    share = counts.agg(F.coalesce(F.sum(every), F.lit(0))).first()[0] / FREQUENT
    usual = [(bytes(r["word"]), r["c"]) for r in counts.filter(every >= share).select("word", "c").collect()]
    rank = {w: i for i, (w, _) in enumerate(usual)}
    lattice = Lattice(path, weights)
    known = np.array([c > 0 for _, c in usual] or [False])
    base = np.array([math.log10(c + 0.5) - bottom for _, c in usual] or [0.0])
    logs = lattice.all_words([w for w, _ in usual] or [b""])

    def split(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, 256):
            out = []
            for t in frame["text"]:
                own = words(t)
                at = [rank.get(w, -1) for w in own]
                rest = Counter(w for w, i in zip(own, at) if i < 0)
                at = np.array(at, np.int64)
                at = at[at >= 0]
                out.append((len(own) + 1, int(known[at].sum()) + (ends > 0), float(base[at].sum()) + end_base,
                            float(logs[at].sum()) + end_score, list(rest), list(rest.values())))
            made = pd.DataFrame(out, columns=["n_tokens", "n_known", "base", "lattice", "words", "times"])
            made.insert(0, "held_out", frame["held_out"].to_numpy())
            made.insert(0, "doc_id", frame["doc_id"].to_numpy())
            yield made

    kind = rows.schema["doc_id"].dataType.simpleString()
    parts = rows.select("doc_id", "held_out", "text").mapInPandas(
        split, f"doc_id {kind}, held_out boolean, n_tokens bigint, n_known bigint, base double, lattice double, "
               "words array<binary>, times array<bigint>")
    parts = scale.stage(parts.withColumn("row", F.monotonically_increasing_id()), "parts")

    def rare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        lattice = Lattice(path, weights)
        for frame in pieces(frames, 4096):
            frame = frame[np.array([w not in rank for w in frame["word"]], bool)]
            if not len(frame):
                continue
            yield pd.DataFrame({"word": frame["word"], "known": (frame["c"] > 0).astype(int),
                                "base": np.log10(frame["c"].to_numpy(float) + 0.5) - bottom,
                                "lattice": lattice.all_words(list(frame["word"]))})

    table = counts.select("word", "c").mapInPandas(rare, "word binary, known bigint, base double, lattice double")
    asked = parts.select("row", F.explode(F.arrays_zip("words", "times")).alias("w")).select(
        "row", F.col("w.words").alias("word"), F.col("w.times").alias("times"))
    more = asked.join(table, "word").select(
        "row", (F.col("known") * F.col("times")).alias("n_known"), (F.col("base") * F.col("times")).alias("base"),
        (F.col("lattice") * F.col("times")).alias("lattice"))
    sums = more.groupBy("row").agg(*[F.sum(c).alias(f"more_{c}") for c in ("n_known", "base", "lattice")])
    whole = parts.drop("words", "times").join(sums, "row", "left")

    def both(c: str):
        return F.col(c) + F.coalesce(F.col(f"more_{c}"), F.lit(0))

    return whole.select(
        "doc_id", "held_out", "n_tokens", both("n_known").cast("bigint").alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"), both("base").alias("base_score"),
        (both("lattice") / math.log(10)).alias("score"))
