"""Language identification by sparse multinomial logistic regression.

Features are hashed character n-grams (1 to 3) of the lower-cased whole text,
weighted by their share of the text and by inverse document frequency over all
documents that may be learned from. The weights come from follow-the-regularised
leader with an elastic net on a bounded, hashed sample of labelled rows, and a
temperature fitted on a part of the sample kept out of training turns scores
into probabilities.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lawloom.llm.encode import text_blocks
from lawloom.llm.scratch import released

BITS = 15
SIZE = 1 << BITS
SCALE = 20.0
OTHER = re.compile(r"[\W\d_]+")
UNKNOWN = "und"


def grams(text: str) -> np.ndarray:
    """Hashed 1- to 3-grams of the letters of ``text``, other characters being one space; empty without a letter."""
    letters = OTHER.sub(" ", text.lower())
    if not letters.strip():
        return np.empty(0, np.int64)
    c = np.frombuffer(f" {letters} ".encode("utf-32-le"), np.uint32)
    a = c * np.uint32(0x9E3779B1)
    b = a[:-1] ^ (c[1:] * np.uint32(0x85EBCA77)) ^ np.uint32(0x1B873593)
    d = b[:-1] * np.uint32(5) ^ (c[2:] * np.uint32(0xC2B2AE3D)) ^ np.uint32(0x27D4EB2F)
    x = np.concatenate([a, b, d])
    x = (x ^ (x >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    return (x >> np.uint32(32 - BITS)).astype(np.int64)


def has_letter(text: str | None) -> bool:
    return bool(text) and any(ch.isalpha() for ch in text)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """In how many texts each hashed n-gram occurs, and the number of texts; one row of ``SIZE`` counts a task, summed by n-gram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, seen = np.zeros(SIZE + 1, np.int64), np.zeros(SIZE, bool)
        for b in batches:
            for x in b.column("text"):
                g = grams(x.as_py() or "")
                seen[g] = True
                at = np.flatnonzero(seen)
                df[at] += 1
                seen[at] = False
                df[SIZE] += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(df[at])], names=["g", "n"])

    out = np.zeros(SIZE + 1, np.int64)
    for g, n in docs.select("text").mapInArrow(released(run), "g long, n long").groupBy("g").agg(F.sum("n").alias("n")).collect():
        out[g] = n
    return out[:SIZE], int(out[SIZE])


def tfidf(text: str, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    g = grams(text)
    at, n = np.unique(g, return_counts=True)
    return at, SCALE * n / max(1, len(g)) * idf[at]


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, classes: int, epochs: int = 4, alpha: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.02, seed: int = 10) -> np.ndarray:
    """Weights (SIZE + 1 by classes, the last row the intercept) by FTRL-proximal; weights whose sum stays within ``l1`` are 0."""
    z, n = np.zeros((SIZE + 1, classes)), np.zeros((SIZE + 1, classes))

    def weights(at: np.ndarray) -> np.ndarray:
        zz = z[at]
        return np.where(abs(zz) <= l1, 0.0, -(zz - np.sign(zz) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    rng = np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            at, x = np.append(rows[i][0], SIZE), np.append(rows[i][1], 1.0)
            w = weights(at)
            s = x @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[labels[i]] -= 1
            g = x[:, None] * p
            sigma = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - sigma * w
            n[at] += g * g
    return weights(np.arange(SIZE + 1))


def fit_temperature(scores: np.ndarray, labels: np.ndarray) -> float:
    """The temperature of least log loss, by golden section on its logarithm."""

    def loss(t: float) -> float:
        s = scores / np.exp(t)
        s = s - s.max(axis=1, keepdims=True)
        return float(np.mean(np.log(np.exp(s).sum(axis=1)) - s[np.arange(len(s)), labels]))

    a, b, r = -4.0, 4.0, (5**0.5 - 1) / 2
    while b - a > 1e-3:
        c, d = b - r * (b - a), a + r * (b - a)
        a, b = (a, d) if loss(c) < loss(d) else (c, b)
    return float(np.exp((a + b) / 2))


class LanguageModel:
    """Scores of whole texts; ``predict`` gives (language, probability)."""

    def __init__(self, names: list[str], idf: np.ndarray, weights: np.ndarray, temperature: float):
        self.names, self.temperature = names, temperature
        self.table, self.intercept = (weights[:SIZE] * idf[:, None] * SCALE).astype(np.float64), weights[SIZE]

    def predict(self, text: str | None) -> tuple[str, float]:
        if not self.names or not has_letter(text):
            return UNKNOWN, 0.0
        g = grams(text)
        if len(g) > SIZE:  # a row of the table for each n-gram of a very long text would not be bounded
            total = np.bincount(g, minlength=SIZE) @ self.table
        else:
            total = np.add.reduce(np.take(self.table, g, axis=0), axis=0)
        s = self.intercept + total / max(1, len(g))
        p = np.exp((s - s.max()) / self.temperature)
        i = int(p.argmax())
        return self.names[i], float(p[i] / p.sum())


def learnable(docs: DataFrame) -> DataFrame:
    """Rows that may be learned from: the CRC-32 of doc_id as text, modulo 4, is not 2 (nor is doc_id null)."""
    return docs.where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)


def sampled_features(labelled: DataFrame, idf: np.ndarray, most: int) -> list[tuple[str, int, np.ndarray, np.ndarray]]:
    """(lang, hash, n-grams, weights) of at most ``most`` different rows of each language.

    A row with a letter is in the sample if its hash lies below its language's threshold, which follows from the
    number of different hashes: no sort, no task with all rows of a language, and copies of a row count once,
    so a language of a few rows, however often they repeat, is in the sample with all of them. Only
    n-gram weights (at most ``SIZE`` a row) leave the executors, whatever the texts' length.
    """
    span = 1 << 62
    mark = F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 2)
    marked = labelled.where(F.col("text").rlike(r"\p{L}")).select("lang", "text", mark.alias("h"))
    counts = marked.groupBy("lang").agg(F.count_distinct("h").alias("n")).collect()  # a row a language, as the model's weights have a column for each
    limits = labelled.sparkSession.createDataFrame([(r.lang, min(span, span * most // r.n)) for r in counts], "lang string, below long")
    near = marked.join(F.broadcast(limits), "lang").where("h < below")
    once = near.groupBy("lang", "h").agg(F.first("text").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in text_blocks(b):
                texts = part.column("text").to_pylist()
                keep = [i for i, x in enumerate(texts) if has_letter(x)]
                got = [tfidf(texts[i], idf) for i in keep]
                cols = [part.column("lang").take(pa.array(keep, pa.int64())), part.column("h").take(pa.array(keep, pa.int64())), pa.array([g[0].astype(np.int32) for g in got], pa.list_(pa.int32())), pa.array([g[1] for g in got], pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(cols, names=["lang", "h", "at", "x"])

    rows: dict[str, list] = {}
    for r in once.mapInArrow(released(run), "lang string, h long, at array<int>, x array<double>").toLocalIterator():
        rows.setdefault(r.lang, []).append((r.lang, r.h, np.array(r["at"], np.int64), np.array(r["x"], np.float64)))
    return [x for name in sorted(rows) for x in sorted(rows[name], key=lambda x: x[1])[:most]]


def fit_language_model(docs: DataFrame, sample_per_language: int = 600) -> LanguageModel:
    """Fit on at most ``sample_per_language`` labelled rows for each value of lang, drawn by a hash; document frequencies are over all learnable rows.

    A fifth of the sample fits the temperature only. Rows without a lang or a letter are not learned from;
    without any labelled row every text is ``und``. Other columns are not read.
    """
    use = learnable(docs.select("doc_id", "text", "lang"))
    df, n = document_frequencies(use)
    idf = np.log((1 + n) / (1 + df)) + 1
    sample = sampled_features(use.where("lang is not null and text is not null"), idf, sample_per_language)
    names = sorted({r[0] for r in sample})
    if not names:
        return LanguageModel([], idf, np.zeros((SIZE + 1, 1)), 1.0)
    rows, labels = [(r[2], r[3]) for r in sample], np.array([names.index(r[0]) for r in sample])
    kept = np.arange(len(rows)) % 5 == 4
    train = np.flatnonzero(~kept)
    weights = train_ftrl([rows[i] for i in train], labels[train], len(names))
    scores = np.array([weights[SIZE] + x @ weights[at] for (at, x), k in zip(rows, kept, strict=True) if k])
    temperature = fit_temperature(scores, labels[kept]) if kept.any() else 1.0
    return LanguageModel(names, idf, weights, temperature)


def predict_languages(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """(doc_id, lang_pred, score) of every whole text.

    Null texts and those without a letter are ``und`` with score 0. Only the text decides. Repeated rows
    each come back; other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = [model.predict(x.as_py()) for x in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(pa.int64()), pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.float64())], names=["doc_id", "lang_pred", "score"])

    return docs.select("doc_id", "text").mapInArrow(released(run), "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: LanguageModel, least: float = 0.5) -> DataFrame:
    """Rows of ``docs`` whose language is known with at least this probability, with all their columns.

    Null texts and texts without a letter go. Repeated rows stay or go together; an empty table stays empty.
    """
    at, schema = docs.columns.index("text"), docs.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = []
            for x in b.column(at):
                name, score = model.predict(x.as_py())
                keep.append(name != UNKNOWN and score >= least)
            yield b.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(released(run), schema)
