"""Quality classifier: similarity-weighted voting of nearest neighbours in a
latent-semantic space.

1. Terms of a text: hashed words, word shapes (``Xx``, ``x***``, ...),
   pairs of neighbouring shapes, and repeats of earlier words.  Their
   document frequencies are counted over all documents.
2. A bounded sample of labelled documents (``train_rows``, drawn by hash of
   doc_id) gives a tf-idf matrix; its leading singular directions span the
   latent space, and its projected rows are the labelled vectors.  Both are
   a few MB whatever the corpus holds, and are broadcast.
3. Every document is projected, its exact cosine with every labelled vector
   is computed in blocks (documents x vectors), and its ``k`` nearest vote
   with their similarity as weight.

Defined results: a null or empty text has no vector and gets the share of
label 1 in the sample; without any labelled row the score is 0.5; every row
of the input gets a row; an empty table gives an empty one.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table
from .common import bounded_batches, documents, give_back, let_go, unused, whole_text

WORDS, SHAPES, PAIRS, REPEATS = 1024, 128, 512, 3
TERMS = WORDS + SHAPES + PAIRS + REPEATS
_MEMO_WORDS, _MEMO_LENGTH = 120_000, 64      # words kept, and the longest of them in characters


def _hash(s: str) -> int:
    import zlib

    return zlib.crc32(s.encode("utf-8", "surrogatepass"))


def _shape(word: str) -> str:
    """Letters by case, digits and marks, runs shortened: ``Xx``, ``x***``, ``X!!``."""
    def case(m: re.Match) -> str:
        t = m.group()
        return "x" if t.islower() else "X" if t.isupper() and len(t) > 1 else "Xx"
    return re.sub(r"\d+", "9", re.sub(r"[^\W\d_]+", case, word))


class Terms:
    """Term counts of texts; a bounded table per worker from word to its two term numbers."""

    def __init__(self):
        self.memo: dict[str, int] = {}

    def _codes(self, words: list[str]) -> np.ndarray:
        memo = self.memo
        new = set(words).difference(memo)
        for w in new:
            memo[w] = _hash(w) % WORDS + WORDS * (_hash(_shape(w)) % SHAPES)
        out = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
        for w in new:
            if len(w) > _MEMO_LENGTH:
                del memo[w]
        return out

    def counts(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """(term numbers, counts) of one text."""
        words = text.split()
        if not words:
            return np.empty(0, np.int64), np.empty(0)
        if len(self.memo) > _MEMO_WORDS:
            self.memo.clear()
        code = self._codes(words)
        word, shape = code % WORDS, code // WORDS
        pair = (shape[:-1] * 31 + shape[1:] * 17) % PAIRS
        base = WORDS + SHAPES + PAIRS
        n = len(words)
        repeats = np.array([np.count_nonzero(code[1:] == code[:-1]),
                            np.count_nonzero(code[2:] == code[:-2]),
                            max(0, n - 3 * len(set(words)))], float)
        terms, counts = np.unique(np.concatenate([word, WORDS + shape, WORDS + SHAPES + pair]), return_counts=True)
        own = np.flatnonzero(repeats)
        return np.concatenate([terms, base + own]), np.concatenate([counts, repeats[own]])


@dataclass
class Model:
    """What the vote needs: weights of terms, latent directions, labelled vectors."""

    idf: np.ndarray
    directions: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    k: int
    prior: float

    def project(self, matrix: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.log1p(matrix) * self.idf) @ self.directions)

    def score(self, matrix: np.ndarray) -> np.ndarray:
        """Score of every row of a term-count matrix."""
        out = np.full(len(matrix), self.prior)
        if not len(self.labels):
            return out
        known = np.flatnonzero(matrix.any(axis=1))
        for at in np.array_split(known, max(1, len(known) // 256)):
            if not len(at):
                continue
            sim = self.project(matrix[at]) @ self.vectors.T
            k = min(self.k, sim.shape[1])
            near = np.argpartition(-sim, k - 1, axis=1)[:, :k]
            weight = np.maximum(np.take_along_axis(sim, near, 1), 0) ** 4 + 1e-9
            out[at] = (weight * self.labels[near]).sum(1) / weight.sum(1)
        return np.clip(out, 0.0, 1.0)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return (x / np.where(norm == 0, 1, norm)).astype(np.float32)


def _frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """Documents holding each term, over all documents, and their number."""
    def per_task(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        terms, df, n = Terms(), np.zeros(TERMS, np.int64), 0
        for b in batches:
            for t in b["text"]:
                df[terms.counts(t)[0]] += 1
            n += len(b)
        give_back()
        if n:                        # TERMS + 1 rows a task
            yield pd.DataFrame({"term": np.arange(TERMS + 1), "n": np.append(df, n)})

    rows = (docs.select(whole_text().alias("text")).mapInPandas(per_task, "term long, n long")
            .groupBy("term").agg(F.sum("n").alias("n")).toPandas())
    out = np.zeros(TERMS + 1)
    out[rows["term"]] = rows["n"]
    return out[:-1], int(out[-1])


def _training_rows(docs: DataFrame, labels: DataFrame, train_rows: int) -> pd.DataFrame:
    """Label and term counts of at most ``train_rows`` labelled documents, chosen by hash of doc_id."""
    def to_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        let_go()
        terms = Terms()
        for b in batches:
            found = [terms.counts(t) for t in b["text"]]
            yield pd.DataFrame({"doc_id": b["doc_id"], "label": b["label"], "terms": [t for t, _ in found],
                                "counts": [c for _, c in found]})

    drawn = labels.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    rows = docs.select("doc_id", whole_text().alias("text")).join(drawn, "doc_id").select("doc_id", "text", "label")
    return (rows.mapInPandas(to_terms, "doc_id long, label double, terms array<long>, counts array<double>")
            .toPandas().drop_duplicates("doc_id").sort_values("doc_id"))


def _dense(found: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(found), TERMS), np.float32)
    for i, (t, c) in enumerate(found):
        out[i, np.asarray(t, np.int64)] = c
    return out


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = 6000, rank: int = 64, k: int = 15) -> Model:
    """Learn from ``labels`` (doc_id, label 0 or 1); ``docs`` (doc_id, text) gives the texts and all frequencies."""
    bounded_batches(docs.sparkSession)
    df, n = _frequencies(docs)
    idf = (np.log((1 + n) / (1 + df)) + 1).astype(np.float32)
    rows = _training_rows(docs, labels, train_rows)
    y = rows["label"].to_numpy(float)
    prior = float(y.mean()) if len(y) else 0.5
    matrix = _dense(list(zip(rows["terms"], rows["counts"])))
    weighted = _unit(np.log1p(matrix) * idf) if len(matrix) else matrix
    _, vec = np.linalg.eigh(weighted.T @ weighted if len(weighted) else np.eye(TERMS, dtype=np.float32))
    model = Model(idf, np.ascontiguousarray(vec[:, ::-1][:, :rank], np.float32), np.empty((0, rank), np.float32), y, k, prior)
    if len(matrix):
        model.vectors = model.project(matrix)
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.7,
          names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """``docs`` with a score (0 to 1) and a prediction (1 if score >= threshold) after its columns."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def vote(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        let_go()
        terms, m = Terms(), shared.value
        for texts in batches:
            texts = texts.tolist()
            parts = [m.score(_dense([terms.counts(t) for t in texts[i:i + 256]])) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate([np.empty(0), *parts]))
        give_back()

    out = docs.withColumn(names[0], vote(whole_text()))
    return out.withColumn(names[1], (F.col(names[0]) >= threshold).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """``docs`` (all columns) without the documents that the classifier rejects."""
    names = unused(docs, "score", "predicted")
    return score(docs, model, threshold, tuple(names)).where(F.col(names[1]) == 1).drop(*names)


def held_out(doc_id: Column) -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def quality_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(doc_id, label) of the labelled rows that may be learned from; repeated ids count once, with the lower label."""
    return (read_table(spark, sf_dir, "labels", ["doc_id", "quality"])
            .where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
            .groupBy("doc_id").agg(F.min("quality").cast("double").alias("label")))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registered query: quality score of every whole document."""
    docs = documents(spark, sf_dir)
    model = fit(docs, quality_labels(spark, sf_dir))
    return score(docs, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")
