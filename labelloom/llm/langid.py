"""Language identification with a string kernel.

The kernel of two texts is the number of character n-grams (lengths 1 to 3, lower-cased) that both hold,
divided by the geometric mean of their own numbers. Only n-grams of the landmark texts count: all others
have a zero product with every landmark. Nyström features are ``K(x, L) K(L, L)^(-1/2)``; one ridge
regression per language, on targets 0 and 1, gives the scores. For scoring, both factors are one matrix,
so a batch of texts costs two matrix products.

Fitting is bounded: at most ``train_rows`` labelled texts, the same number for each language, drawn by a
hash of the row, reach the driver; ``landmarks`` of them are the landmarks. Prediction reads every
character of every text and moves no rows.

Defined cases: a null text or one without a letter gets ``und`` and score 0; so does every text when
nothing can be learned (no labelled rows). A null id is neither held out nor learned from. Repeated rows
are predicted alike. Extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from labelloom.llm.inputs import crc_mod, pieces

UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Grams:
    """Numbers the n-grams of the landmarks; number 0 stands for all others."""
    symbols: np.ndarray  # code point -> symbol, 0: not in the alphabet
    base: int
    numbers: tuple[np.ndarray, ...]  # for n = 1, 2, 3: n-gram key -> number
    size: int

    @classmethod
    def of(cls, texts: list[str], alphabet: int) -> Grams:
        points = np.concatenate([_points(t) for t in texts] or [np.zeros(0, np.uint32)])
        values, counts = np.unique(points, return_counts=True)
        kept = values[np.lexsort((values, -counts))][:alphabet]
        symbols = np.zeros(0x110000, np.uint8 if alphabet < 256 else np.uint16)
        symbols[kept] = np.arange(1, len(kept) + 1)
        base, size, numbers = len(kept) + 1, 1, []
        for n in (1, 2, 3):
            seen = np.zeros(base ** n, bool)
            for text in texts:
                seen[_keys(symbols[_points(text)], base, n)] = True
            number = np.zeros(base ** n, np.int32)
            number[seen] = np.arange(size, size + seen.sum())
            size += int(seen.sum())
            numbers.append(number)
        return cls(symbols, base, tuple(numbers), size)

    def presence(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.size), np.float32)
        for row, text in zip(out, texts):
            coded = self.symbols[_points(text)]
            for n, number in enumerate(self.numbers, 1):
                row[number[_keys(coded, self.base, n)]] = 1
            row[0] = 0
        return out


def _points(text: str) -> np.ndarray:
    return np.frombuffer(text.lower().encode("utf-32-le"), np.uint32)


def _keys(coded: np.ndarray, base: int, n: int) -> np.ndarray:
    if len(coded) < n:
        return np.zeros(0, np.int32)
    key = coded[: len(coded) - n + 1].astype(np.int32)
    for k in range(1, n):
        key *= base
        key += coded[k: len(coded) - n + 1 + k]
    return key


@dataclass
class Model:
    languages: list[str]
    grams: Grams | None = None
    landmarks: np.ndarray | None = None  # n-gram x landmark, scaled
    weights: np.ndarray | None = None  # landmark x language

    def kernel(self, texts: list[str]) -> np.ndarray:
        seen = self.grams.presence(texts)
        return (seen @ self.landmarks) / np.sqrt(np.maximum(seen.sum(1, keepdims=True), 1))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        known = [i for i, t in enumerate(texts) if t is not None and LETTER.search(t)]
        labels, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if self.grams is None or not known:
            return labels, scores
        found = self.kernel([texts[i] for i in known]) @ self.weights
        best = found.argmax(1)
        for at, i in enumerate(known):
            labels[i] = self.languages[best[at]]
        scores[known] = np.clip(found.max(1), 0, 1)
        return labels, scores


def learn(texts: list[str], languages: list[str], landmarks: int = 128, ridge: float = 0.1,
          alphabet: int = 160) -> Model:
    """Fit on texts in memory; the landmarks are taken in turn from each language."""
    names = sorted(set(languages))
    if not names:
        return Model([])
    turn: dict[str, int] = {}
    order = []
    for i, lang in enumerate(languages):
        order.append((turn.setdefault(lang, 0), lang, i))
        turn[lang] += 1
    chosen = [texts[i] for _, _, i in sorted(order)[:landmarks]]
    model = Model(names, Grams.of(chosen, alphabet))
    seen = model.grams.presence(chosen)
    model.landmarks = (seen / np.sqrt(np.maximum(seen.sum(1, keepdims=True), 1))).T.copy()
    values, vectors = np.linalg.eigh(model.kernel(chosen).astype(np.float64))
    usable = values > 1e-6 * max(values.max(), 1e-6)
    whiten = vectors[:, usable] / np.sqrt(values[usable])
    features = np.concatenate([model.kernel(texts[i:i + 256]) for i in range(0, len(texts), 256)]) @ whiten
    # Every language weighs the same, however often it is labelled.
    weight = np.array([1 / turn[lang] for lang in languages])[:, None] * len(languages) / len(names)
    target = np.array([[lang == name for name in names] for lang in languages], float)
    normal = (features * weight).T @ features + ridge * np.eye(features.shape[1])
    model.weights = (whiten @ np.linalg.solve(normal, (features * weight).T @ target)).astype(np.float32)
    return model


def fit(labelled: DataFrame, text: str = "text", lang: str = "lang", train_rows: int = 1600,
        landmarks: int = 128, max_languages: int = 400) -> Model:
    """Fit on a bounded, evenly split sample of the labelled rows (see the module)."""
    rows = (labelled.select(F.col(text).cast("string").alias("text"), F.col(lang).cast("string").alias("lang"))
            .filter("text is not null and lang is not null")
            .withColumn("h", F.xxhash64("text", "lang")))
    counts = {r[0]: r[1] for r in rows.groupBy("lang").count()
              .orderBy(F.desc("count"), "lang").limit(max_languages).collect()}
    if not counts:
        return Model([])
    each = max(2, train_rows // len(counts))
    # A hash share of about twice the wanted rows first, so that ranking moves only few rows.
    share = F.create_map(*[F.lit(x) for k, n in counts.items()
                           for x in (k, min(1.0, (2 * each + 20) / n))])
    near = rows.filter(F.pmod("h", F.lit(1_000_000)) < share[F.col("lang")] * 1_000_000)
    rank = F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))
    sample = near.withColumn("r", rank).filter(F.col("r") <= each).orderBy("lang", "r").collect()
    return learn([r["text"] for r in sample], [r["lang"] for r in sample], landmarks)


def predict(docs: DataFrame, model: Model, text: str = "text", batch: int = 256) -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``score`` appended; no row moves."""
    clash = {"lang_pred", "score"} & set(docs.columns)
    docs = docs.drop(*clash)
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, batch):
            texts = [t if isinstance(t, str) else None for t in frame[text]]
            labels, scores = model.predict(texts)
            yield frame.assign(lang_pred=labels, score=scores.astype(float))

    return docs.mapInPandas(run, f"{schema}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Contract rows: learn where crc32(doc_id) mod 4 is not 2, predict all."""
    held = F.coalesce(crc_mod("doc_id", 4) == 2, F.lit(False))
    model = fit(docs.filter(crc_mod("doc_id", 4) != 2))
    rows = docs.select("doc_id", held.alias("held_out"), F.col("text").cast("string").alias("text"))
    # The text goes to the worker but need not come back.
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in pieces(frames, 256):
            labels, scores = model.predict([t if isinstance(t, str) else None for t in frame["text"]])
            yield frame[["doc_id", "held_out"]].assign(lang_pred=labels, score=scores.astype(float))

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame) -> DataFrame:
    """Pipeline stage: documents in which no language can be recognised go; columns stay."""
    labelled = docs.filter(crc_mod("doc_id", 4) != 2)
    return predict(docs, fit(labelled)).filter(F.col("lang_pred") != UNKNOWN).select(*docs.columns)
