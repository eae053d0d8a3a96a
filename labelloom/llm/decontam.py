"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Texts and items are lower-cased and split into words. Seeds are the items' runs of three words that are
rare: the product of the words' frequencies in the corpus (add-one, counted over all documents) is below
``RARE``. So a passage does not stop being a seed because it was copied often, and runs of everyday words
are none. Where a document holds seeds of an item, the words around them on the same diagonals are aligned
with the whole item by Smith-Waterman (match 2, mismatch -1, gap -1). The score is divided by that of a
full match; the item is leaked where it reaches ``LEAK``.

Short items (fewer than three words) have their whole text as seed and must occur in full. The items are
held by every task when they are counted small in rows and bytes; a larger benchmark goes through in parts
of that size, each part reading the documents once. So neither the number of documents nor that of the
items grows what a task holds.

Defined cases: null or empty texts hold nothing; null or wordless items leak nowhere; repeated items each
have their own rows; repeated documents give repeated rows; of equally good places the first is reported.
Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelloom.llm.inputs import pieces

WORD = re.compile(r"\w+")
SEED, RARE, LEAK = 3, 1e-7, 0.6
MATCH, MISMATCH, GAP = 2, -1, -1
ITEM_ROWS, ITEM_BYTES = 20_000, 16 << 20


def words(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if isinstance(text, str) else []


def align(item: list, part: list) -> tuple[int, int, int]:
    """Smith-Waterman: (best score, first and end word of the aligned part)."""
    if not item or not part:
        return 0, 0, 0
    coded = {w: i for i, w in enumerate(dict.fromkeys([*item, *part]))}
    a, b = np.array([coded[w] for w in item]), np.array([coded[w] for w in part])
    # Along anti-diagonals every cell depends on the two before only.
    n, m = len(a), len(b)
    rows = np.arange(n)
    before, before2 = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
    from1, from2 = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)  # where the alignment began in b
    best = (0, 0, 0)
    for d in range(n + m - 1):
        cols = d - rows
        inside = (cols >= 0) & (cols < m)
        here = np.clip(cols, 0, m - 1)
        step = np.where(a == b[here], MATCH, MISMATCH)
        options = np.stack([before2[:-1] + step, before[:-1] + GAP, before[1:] + GAP])
        begins = np.stack([np.where(before2[:-1] > 0, from2[:-1], here), from1[:-1], from1[1:]])
        pick = options.argmax(0)
        score = np.where(inside, np.maximum(options[pick, rows], 0), 0)
        begin = begins[pick, rows]
        at = score.argmax()
        if score[at] > best[0]:
            best = (int(score[at]), int(begin[at]), int(cols[at]) + 1)
        before2, from2 = before, from1
        before, from1 = np.concatenate([[0], score]), np.concatenate([[0], begin])
    return best


class Items:
    """The seeds of some items, ready to be found in documents."""

    def __init__(self, items: list[tuple], counts: dict[str, int], total: int):
        self.ids = [i for i, _ in items]
        self.words = [words(t) for _, t in items]
        self.number = {w: k for k, w in enumerate(sorted({w for ws in self.words for w in ws}), 1)}
        self.base = len(self.number) + 1
        share = {w: (counts.get(w, 0) + 1) / (total + 1) for w in self.number}
        seeds: dict[int, list[tuple[int, int]]] = defaultdict(list)
        self.short: dict[int, list[int]] = defaultdict(list)
        for k, ws in enumerate(self.words):
            if 0 < len(ws) < SEED:
                self.short[self.number[ws[0]]].append(k)
            runs = [(np.prod([share[w] for w in ws[p:p + SEED]]), p) for p in range(len(ws) - SEED + 1)]
            # An item of everyday words only keeps its rarest tenth, so that it can be found.
            bound = max(RARE, sorted(r for r, _ in runs)[len(runs) // 10]) if runs else RARE
            for rate, p in runs:
                if rate <= bound:
                    seeds[self._key([self.number[w] for w in ws[p:p + SEED]])].append((k, p))
        self.keys = np.array(sorted(seeds), np.int64)
        self.places = [seeds[k] for k in self.keys.tolist()]

    def _key(self, coded) -> int:
        key = 0
        for c in coded:
            key = key * self.base + c
        return key

    def leaks(self, text: list[str]) -> list[tuple]:
        """(item id, score, first word, end word) of every item leaked into a text."""
        get = self.number.get
        coded = np.array([get(w, 0) for w in text], np.int64)
        found = []
        if len(coded) >= SEED and len(self.keys):
            run = coded[:-2] * self.base ** 2 + coded[1:-1] * self.base + coded[2:]
            run[(coded[:-2] == 0) | (coded[1:-1] == 0) | (coded[2:] == 0)] = -1
            at = np.flatnonzero(run >= 0)
            spot = np.searchsorted(self.keys, run[at])
            spot[spot == len(self.keys)] = 0
            hit = self.keys[spot] == run[at]
            starts: dict[int, list[int]] = defaultdict(list)
            for p, s in zip(at[hit].tolist(), spot[hit].tolist()):
                for k, q in self.places[s]:
                    starts[k].append(p - q)
            for k, begins in starts.items():
                found += self._aligned(k, begins, text)
        if self.short:
            for p in np.flatnonzero(np.isin(coded, list(self.short))).tolist():
                for k in self.short[coded[p]]:
                    if text[p:p + len(self.words[k])] == self.words[k]:
                        found.append((k, 1.0, p, p + len(self.words[k])))
        best: dict[int, tuple] = {}
        for k, score, start, end in found:
            if k not in best or (-score, start) < (-best[k][1], best[k][2]):
                best[k] = (k, score, start, end)
        return [(self.ids[k], *rest) for k, *rest in best.values()]

    def _aligned(self, k: int, begins: list[int], text: list[str]) -> list[tuple]:
        """Align an item around its seeds: nearby diagonals share one window."""
        item = self.words[k]
        slack = max(5, len(item) // 2)
        out, begins = [], sorted(set(begins))
        first = begins[0]
        for here, following in zip(begins, [*begins[1:], None]):
            if following is None or following - here > slack:
                low, high = max(0, first - slack), here + len(item) + slack
                part = text[low:high]
                # Too few shared words cannot reach the threshold.
                if sum((Counter(item) & Counter(part)).values()) >= LEAK * len(item):
                    score, start, end = align(item, part)
                    score /= MATCH * len(item)
                    if score >= LEAK:
                        out.append((k, score, low + start, low + end))
                first = following
        return out


def _word_counts(docs: DataFrame, vocabulary: frozenset[str]) -> tuple[dict[str, int], int]:
    """Counts of the items' words, and of all words, over all documents."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen, total = Counter(), 0
        for frame in frames:
            for t in frame["text"]:
                ws = words(t)
                total += len(ws)
                seen.update(w for w in ws if w in vocabulary)
        yield pd.DataFrame({"word": [*seen, None], "n": [*seen.values(), total]})

    rows = docs.mapInPandas(run, "word string, n bigint").groupBy("word").agg(F.sum("n")).collect()
    counts = {r[0]: r[1] for r in rows}
    return counts, counts.pop(None, 0) or 0


def _parts(items: DataFrame) -> Iterator[list[tuple]]:
    """The items in lists of bounded size."""
    part, size = [], 0
    for row in items.toLocalIterator():
        part.append((row[0], row[1]))
        size += len(row[1].encode())
        if len(part) >= ITEM_ROWS or size >= ITEM_BYTES:
            yield part
            part, size = [], 0
    if part:
        yield part


def leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text",
          item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item leaked into it: ``doc_id``, ``item_id``, ``score`` (0.6 to 1), and
    ``first_word``, ``end_word`` of the best place."""
    texts = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    asked = items.select(F.col(item_id).alias("item_id"), F.col(item_text).cast("string").alias("text"))
    kinds = (texts.schema["doc_id"].dataType.simpleString(), asked.schema["item_id"].dataType.simpleString())
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, score double, first_word bigint, end_word bigint"
    out = None
    for part in _parts(asked.filter("text is not null")):
        made = texts.mapInPandas(_finder(_fitted(texts, part), schema), schema)
        out = made if out is None else out.union(made)
    return texts.sparkSession.createDataFrame([], schema) if out is None else out


def _fitted(texts: DataFrame, part: list[tuple]) -> Items:
    vocabulary = frozenset(w for _, t in part for w in words(t))
    return Items(part, *_word_counts(texts.select("text"), vocabulary))


def _finder(items: Items, schema: str):
    columns = [c.split()[0] for c in schema.split(", ")]

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, 512):
            rows = [(d, *leak) for d, t in zip(frame["doc_id"], frame["text"]) if isinstance(t, str)
                    for leak in items.leaks(words(t))]
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    return run


def drop_leaking(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Pipeline stage: documents into which an item is leaked go; all others stay, with all columns."""
    asked = items.select("item_id", F.col("text").cast("string").alias("text"))
    for part in _parts(asked.filter("text is not null")):
        fitted = _fitted(docs.select(F.col("text").cast("string").alias("text")), part)

        def run(frames: Iterator[pd.DataFrame], fitted=fitted) -> Iterator[pd.DataFrame]:
            for frame in pieces(frames, 512):
                clean = np.array([not (isinstance(t, str) and fitted.leaks(words(t))) for t in frame["text"]], bool)
                if clean.any():
                    yield frame[clean]

        docs = docs.mapInPandas(run, docs.schema)
    return docs
