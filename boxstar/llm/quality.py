"""Quality classifier from weak labels (operator 4).

1. Overlapping heuristic labellers vote good, bad or abstain on every document.
2. Expectation-maximisation over the counts of vote patterns (3 ** labellers at
   most) estimates the share of good documents and, for each labeller, how it
   votes on good and on bad ones. No gold label is used.
3. The posterior labels train a linear scorer on hashed features (byte
   trigrams and bucketed statistics), in every task on all of its documents;
   the tasks' weights are averaged.
4. The scorer's probability decides: below ``THRESHOLD`` a document is rejected.

Documents whose labellers all abstain teach nothing and are scored like any
other. Defined results: a NULL or empty text is rejected with score 0; repeated
rows give repeated result rows; an empty table gives an empty result; further
columns of the input pass through ``keep_good`` unchanged.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boxstar.llm.averaging import train_averaged
from boxstar.llm.common import prepare

THRESHOLD = 0.5
DIMENSIONS = 4096
ROUNDS = 200
STEP = 0.5
PASSES = 6  # over each batch of documents

#: Labellers that vote bad from a bound on, and else abstain: (statistic, bound).
BAD_FROM = {
    "adjacent_repeats": ("repeats", 0.15),
    "few_distinct_words": ("sameness", 0.75),
    "pair_copies": ("same_pairs", 0.5),
    "shouting": ("capitals", 0.4),
    "exclaiming": ("exclaims", 0.15),
    "symbol_heavy": ("symbols", 0.12),
    "table_like": ("cells", 0.015),
    "loose_symbols": ("loose", 0.1),
    "doubled_symbols": ("doubled", 0.1),
    "odd_word_length": ("odd_length", 1.0),
}
#: Labellers that vote good where all bounds hold, and else abstain.
GOOD_UP_TO = {
    "plain": {"symbols": 0.06, "capitals": 0.12, "repeats": 0.04, "loose": 0.02, "doubled": 0.01},
    "varied": {"sameness": 0.5, "same_lines": 0.2, "same_pairs": 0.2},
}
LABELLERS = (*BAD_FROM, *GOOD_UP_TO)


def statistics(text: str) -> dict[str, float] | None:
    """Statistics of a text, all growing with badness; None where it has no word."""
    words = text.split()
    n = len(words)
    if not n:
        return None
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    upper, lower = int(counts[65:91].sum()), int(counts[97:123].sum())
    digits = int(counts[48:58].sum())
    spaces = int(counts[[9, 10, 11, 12, 13, 32]].sum())
    plain = int(counts[:128].sum())
    lines = [x for x in text.split("\n") if x]
    mean = (len(text) - spaces) / n
    loose = doubled = 0
    distinct = Counter(words)
    for w, k in distinct.items():
        if not w[-1].isalnum():
            if len(w) > 1 and w[-1] == w[-2]:
                doubled += k
            if not any(map(str.isalnum, w)):
                loose += k
    return {
        "repeats": sum(map(eq, words, islice(words, 1, None))) / max(1, n - 1),
        "sameness": 1 - len(distinct) / n if n >= 20 else 0.0,
        "capitals": upper / max(1, upper + lower),
        "exclaims": int(counts[33]) / n,
        "symbols": (plain - upper - lower - digits - spaces) / (plain + 20),  # a few signs in a tiny text are no sign
        "cells": int(counts[[9, 59, 124]].sum()) / max(1, plain),  # tab, semicolon, bar
        "same_lines": 1 - len(set(lines)) / len(lines) if len(lines) >= 3 else 0.0,
        "odd_length": 1.0 if mean < 1.5 or mean > 25 else 0.0,
        "same_pairs": 1 - len(set(zip(words, islice(words, 1, None)))) / (n - 1) if n >= 20 else 0.0,
        "loose": loose / n,
        "doubled": doubled / n,
    }


def votes(stats: dict[str, float] | None) -> tuple[int, ...] | None:
    """Each labeller's vote: 1 good, -1 bad, 0 abstains."""
    if stats is None:
        return None
    bad = [-1 if stats[s] >= bound else 0 for s, bound in BAD_FROM.values()]
    good = [1 if all(stats[s] <= bound for s, bound in bounds.items()) else 0 for bounds in GOOD_UP_TO.values()]
    return (*bad, *good)


@dataclass
class LabelModel:
    """Share of good documents, and per labeller P(vote | good), P(vote | bad)
    for the votes -1, 0, 1."""

    good: float
    given: np.ndarray  # labeller x class (good, bad) x vote

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """P(good | votes) for rows of votes."""
        logs = np.log(self.given)
        at = patterns.astype(np.int64) + 1
        each = np.arange(patterns.shape[1])
        good = np.log(self.good) + logs[each, 0, at].sum(axis=1)
        bad = np.log(1 - self.good) + logs[each, 1, at].sum(axis=1)
        return 1.0 / (1.0 + np.exp(np.clip(bad - good, -500, 500)))

    def accuracies(self) -> np.ndarray:
        """Per labeller: P(right | it votes)."""
        right = self.good * self.given[:, 0, 2] + (1 - self.good) * self.given[:, 1, 0]
        wrong = self.good * self.given[:, 0, 0] + (1 - self.good) * self.given[:, 1, 2]
        return right / (right + wrong)


def fit_labels(patterns: np.ndarray, counts: np.ndarray, rounds: int = ROUNDS) -> LabelModel:
    """Expectation-maximisation over vote patterns and their counts.

    Starts from labellers that are mostly right when they vote. A small prior in
    that sense keeps the two classes from changing places and stands in for
    labellers that never vote.
    """
    n = patterns.shape[1]
    start = np.array([[0.03, 0.57, 0.4], [0.4, 0.57, 0.03]])
    model = LabelModel(0.8, np.repeat(start[None], n, axis=0))
    prior = 5.0 * start
    for _ in range(rounds):
        p = model.posterior(patterns)
        weights = np.stack([p * counts, (1 - p) * counts])
        given = np.empty((n, 2, 3))
        for vote in (-1, 0, 1):
            given[:, :, vote + 1] = (weights @ (patterns == vote)).T
        given += prior
        good = (weights[0].sum() + 8.0) / (counts.sum() + 10.0)
        new = LabelModel(float(good), given / given.sum(axis=2, keepdims=True))
        settled = abs(new.good - model.good) < 1e-9 and np.abs(new.given - model.given).max() < 1e-9
        model = new
        if settled:
            break
    return model


def features(text: str, stats: dict[str, float], dimensions: int = DIMENSIONS) -> np.ndarray:
    """Hashed features of unit length: damped byte-trigram counts and, in the
    first part of the space, one feature for each statistic's tenth."""
    b = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8).astype(np.uint32)
    x = np.zeros(dimensions, dtype=np.float32)
    if len(b) >= 3:
        code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
        slot = ((code * np.uint32(2654435761)) >> np.uint32(12)) % np.uint32(dimensions)
        x = np.log1p(np.bincount(slot, minlength=dimensions)).astype(np.float32)
        x /= np.float32(np.linalg.norm(x))
    for k, value in enumerate(stats.values()):
        x[(k * 11 + min(10, int(value * 10))) * 37 % dimensions] += 1.0
    return x


def _votes_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [votes(statistics(t.as_py() or "")) for t in batch.column(0)]
        codes = [None if v is None else "".join("-0+"[x + 1] for x in v) for v in found]
        yield pa.RecordBatch.from_arrays([pa.array(codes, pa.string())], names=["votes"])


def label_model(docs: DataFrame) -> LabelModel:
    """Votes of all documents, counted by pattern, and the model fitted to them."""
    prepare(docs.sparkSession)
    counted = docs.select("text").mapInArrow(_votes_rows, "votes string").where("votes IS NOT NULL").groupBy("votes").count()
    rows = counted.collect()  # 3 ** labellers patterns at most
    patterns = np.array([["-0+".index(c) - 1 for c in r["votes"]] for r in rows], dtype=np.int64).reshape(-1, len(LABELLERS))
    return fit_labels(patterns, np.array([r["count"] for r in rows], dtype=float))


def _learn(model: LabelModel):
    def work(batches: Iterator[pa.RecordBatch], params: np.ndarray) -> tuple[float, np.ndarray]:
        done = 0
        square = np.full(len(params), 1e-3, dtype=np.float32)
        for batch in batches:
            xs, ys = [], []
            for t in batch.column(0):
                text = t.as_py() or ""
                stats = statistics(text)
                v = votes(stats)
                if v is not None and any(v):
                    xs.append(features(text, stats))
                    ys.append(v)
            if not xs:
                continue
            x = np.stack(xs)
            y = model.posterior(np.array(ys)).astype(np.float32)
            for _ in range(PASSES):
                for i in range(0, len(x), 64):
                    part, want = x[i : i + 64], y[i : i + 64]
                    p = 1.0 / (1.0 + np.exp(-(part @ params[:-1] + params[-1])))
                    off = (p - want) / len(part)
                    grad = np.append(off @ part, off.sum()).astype(np.float32)
                    square += grad * grad
                    params -= STEP * grad / np.sqrt(square)
            done += len(x)
        return float(done), params

    return work


def train_scorer(docs: DataFrame, model: LabelModel) -> np.ndarray:
    """Weights of the hashed linear scorer, the intercept last."""
    prepare(docs.sparkSession)
    return train_averaged(docs.select("text"), np.zeros(DIMENSIONS + 1, dtype=np.float32), _learn(model))


def score_text(text: str | None, weights: np.ndarray) -> float:
    """P(good) by the scorer; 0 for a text without words."""
    stats = statistics(text or "")
    if stats is None:
        return 0.0
    return float(1.0 / (1.0 + np.exp(-(float(features(text, stats) @ weights[:-1]) + float(weights[-1])))))


def classify(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Per row: doc_id, score, weak_label (posterior of the label model), keep."""
    model = label_model(docs)
    weights = train_scorer(docs, model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).to_pylist()
            score = np.array([score_text(t, weights) for t in texts])
            found = [votes(statistics(t or "")) for t in texts]
            weak = [None if v is None else float(model.posterior(np.array([v]))[0]) for v in found]
            cols = [batch.column(0), pa.array(score), pa.array(weak, pa.float64()), pa.array(score >= threshold)]
            yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "score", "weak_label", "keep"])

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("text"))
    return narrow.mapInArrow(run, "doc_id long, score double, weak_label double, keep boolean")


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows that the scorer keeps, with all their columns."""
    weights = train_scorer(docs, label_model(docs))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = [score_text(t.as_py(), weights) >= threshold for t in batch.column(at)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
