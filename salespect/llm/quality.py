"""Quality from weak labels: overlapping heuristics, expectation-maximisation, a hashed linear scorer.

Every heuristic calls a text good, bad or abstains. Votes are counted by
pattern over all texts, at most 3 ** heuristics rows, and expectation-
maximisation estimates how often each heuristic is right from how they agree.
The posteriors it gives train a linear scorer on hashed word shapes, on at most
`sample` texts taken by hash; the scorer then marks every text, also where all
heuristics abstain.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.llm.batches import texts as text_runs
from salespect.llm.batches import tidy

SAMPLE = 10_000
FEATURES = 2048
CUTOFF = 0.5
PRIOR_GOOD = 0.8
GENERATION = 100_000  # words in each of the two generations whose shapes are kept
LONGEST_KEPT = 64
HEURISTICS = ("symbols", "endings", "capitals", "repeats", "top_word", "length", "bars")
_PLAIN_END = frozenset(".,;:?!'\")]}»”’…-")
_LETTERS = re.compile(r"[^\W\d_]+")
_SHAPES = ((re.compile(r"[A-Z]+"), "A"), (re.compile(r"[^\W\d_A-Z]+"), "a"), (re.compile(r"\d+"), "0"), (re.compile(r"(.)\1+"), r"\1+"))


def _vote(value: float, good: float, bad: float) -> int:
    """1 up to good, -1 from bad, 0 between."""
    return 1 if value <= good else -1 if value >= bad else 0


def votes(text: str | None) -> list[int]:
    """One vote per heuristic; an empty text is bad by its length and has no other vote."""
    words = (text or "").split()
    if not words:
        return [-1 if name == "length" else 0 for name in HEURISTICS]
    letters = sum(map(len, _LETTERS.findall(text)))
    size = sum(map(len, words))
    count = len(words)
    capitals = sum(1 for w in words if len(w) > 2 and w.isupper())
    odd = sum(1 for w in words if not w[-1].isalnum() and (w[-1] not in _PLAIN_END or w[-2:] == w[-1] * 2))
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    return [
        _vote(1 - letters / size, 0.10, 0.22),
        _vote(odd / count, 0.05, 0.30),
        _vote(capitals / count, 0.10, 0.50),
        _vote(again / count, 0.05, 0.30),
        _vote(Counter(words).most_common(1)[0][1] / count, 0.15, 0.40) if count >= 20 else 0,
        0,
        _vote(words.count("|") / count, 0.02, 0.20),
    ]


def _shape(word: str) -> str:
    for pattern, short in _SHAPES:
        word = pattern.sub(short, word)
    return word[:8] + word[-8:] if len(word) > 16 else word


class Shapes:
    """Hashed shapes of words, their pairs and repetitions, as shares of a text's words."""

    def __init__(self) -> None:
        self.young: dict[str, str] = {}
        self.old: dict[str, str] = {}

    def shape(self, word: str) -> str:
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word) or _shape(word)
            if len(word) <= LONGEST_KEPT:
                if len(self.young) >= GENERATION:
                    self.old, self.young = self.young, {}
                self.young[word] = found
        return found

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        words = (text or "").split()
        shapes = [*map(self.shape, words)]
        counts = Counter(shapes)
        counts.update(zip(shapes, shapes[1:], strict=False))
        total = max(1, len(words))
        again = sum(a == b for a, b in zip(words, words[1:], strict=False))
        cells = Counter({_cell("always"): float(total), _cell("again"): 4.0 * again, _cell(f"few {min(5, len(words))}"): float(total)})
        for shape, n in counts.items():
            cells[_cell(shape)] += n
        return np.fromiter(cells.keys(), np.int64, len(cells)), np.fromiter(cells.values(), float, len(cells)) / total


def _cell(shape) -> int:
    return zlib.crc32(repr(shape).encode()) % FEATURES


#: What is believed beforehand of the votes -1, 0, 1: bad texts are of many kinds, good ones are seldom condemned.
_WEIGHT = 3  # the belief counts as so many times the data
_BELIEF = np.array([[0.20, 0.10, 0.70], [0.0002, 0.10, 0.8998]])


class Estimate(NamedTuple):
    """Share of good texts, and per heuristic and class (bad, good) the chances of the votes -1, 0 and 1."""

    good: float
    chances: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        logs = np.log(self.chances)
        per_class = [sum(logs[k, c][patterns[:, k] + 1] for k in range(patterns.shape[1])) for c in (0, 1)]
        odds = np.log(self.good) - np.log1p(-self.good) + per_class[1] - per_class[0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def estimate(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100) -> Estimate:
    """Expectation-maximisation over vote patterns; begins from the majority of votes, so that 1 means good."""
    width = patterns.shape[1]
    posterior = np.where((patterns < 0).any(axis=1), 0.1, 0.9)
    model = Estimate(PRIOR_GOOD, np.full((width, 2, 3), 1 / 3))
    for _ in range(rounds):
        weight = np.stack((counts * (1 - posterior), counts * posterior))
        chances = np.zeros((width, 2, 3))
        for k in range(width):
            for c in (0, 1):
                seen = np.bincount(patterns[:, k] + 1, weights=weight[c], minlength=3)
                chances[k, c] = seen + _WEIGHT * (seen.sum() + 1) * _BELIEF[c]
        chances /= chances.sum(axis=2, keepdims=True)
        good = (weight[1].sum() + PRIOR_GOOD) / (counts.sum() + 1)
        model = Estimate(float(np.clip(good, 1e-3, 1 - 1e-3)), chances)
        posterior, before = model.posterior(patterns), posterior
        if np.abs(posterior - before).max(initial=0) < 1e-9:
            break
    return model


def fit_scorer(rows: list[tuple[np.ndarray, np.ndarray]], target: np.ndarray, rounds: int = 400, penalty: float = 1e-4) -> np.ndarray:
    """Logistic regression on soft targets by accelerated gradient steps."""
    at = np.repeat(np.arange(len(rows)), [len(i) for i, _ in rows])
    cell = np.concatenate([i for i, _ in rows]) if rows else np.zeros(0, np.int64)
    value = np.concatenate([v for _, v in rows]) if rows else np.zeros(0)
    bad, good = max(1.0, (1 - target).sum()), max(1.0, target.sum())
    share = np.where(target < 0.5, len(target) / (2 * bad), len(target) / (2 * good))  # both classes weigh the same
    weights, ahead = np.zeros(FEATURES), np.zeros(FEATURES)
    for step in range(rounds if len(rows) else 0):
        margin = np.bincount(at, weights=value * ahead[cell], minlength=len(rows))
        error = 1 / (1 + np.exp(-np.clip(margin, -50, 50))) - target
        error *= share
        gradient = np.bincount(cell, weights=value * error[at], minlength=FEATURES) / len(rows) + penalty * ahead
        moved = ahead - 0.5 * gradient
        ahead = moved + step / (step + 3) * (moved - weights)
        weights = moved
    return weights


class Model(NamedTuple):
    votes: Estimate
    weights: np.ndarray


@tidy
def _patterns(batches):
    counted: Counter = Counter()
    for batch in batches:
        for texts in text_runs(batch.column(0)):
            counted.update(bytes(v + 1 for v in votes(text)) for text in texts)
    yield pa.RecordBatch.from_arrays([pa.array(list(counted), pa.binary()), pa.array(list(counted.values()), pa.int64())], ["pattern", "n"])


@tidy
def _featured(frames):
    shapes = Shapes()
    for frame in frames:
        found = [shapes.features(text) for text in frame["text"]]
        yield pd.DataFrame({"pattern": [bytes(v + 1 for v in votes(t)) for t in frame["text"]], "cells": [i for i, _ in found], "shares": [v for _, v in found]})


def _to_votes(patterns) -> np.ndarray:
    return np.array([list(p) for p in patterns], np.int64).reshape(-1, len(HEURISTICS)) - 1


def train(docs: DataFrame, sample: int = SAMPLE, text_col: str = "text") -> Model:
    """Heuristic accuracies from all rows, scorer weights from at most `sample` different texts."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    found = texts.mapInArrow(_patterns, "pattern binary, n long").groupBy("pattern").agg(F.sum("n").alias("n")).collect()
    patterns, counts = _to_votes(r["pattern"] for r in found), np.array([r["n"] for r in found], float)
    model = estimate(patterns, counts)
    mark = F.xxhash64(F.coalesce("text", F.lit("")))
    last = texts.select(mark.alias("mark")).distinct().orderBy("mark").limit(sample).agg(F.max("mark")).first()[0]
    if last is None:
        return Model(model, np.zeros(FEATURES))
    chosen = texts.withColumn("mark", mark).where(F.col("mark") <= last).dropDuplicates(["mark"]).select("text")
    rows = chosen.mapInPandas(_featured, "pattern binary, cells array<long>, shares array<double>").collect()
    target = model.posterior(_to_votes(r["pattern"] for r in rows))
    return Model(model, fit_scorer([(np.array(r["cells"], np.int64), np.array(r["shares"])) for r in rows], target))


def _score(shapes: Shapes, weights: np.ndarray, text: str | None) -> float:
    if not (text or "").strip():
        return 0.0
    cells, shares = shapes.features(text)
    return float(1 / (1 + np.exp(-np.clip(weights[cells] @ shares, -50, 50))))


@tidy
def _scored(batches, model: Model):
    shapes = Shapes()
    for batch in batches:
        cast = np.array([votes(t) for part in text_runs(batch.column(1)) for t in part], np.int64).reshape(-1, len(HEURISTICS))
        scores = [_score(shapes, model.weights, t) for part in text_runs(batch.column(1)) for t in part]
        counts = [pa.array((cast > 0).sum(axis=1)), pa.array((cast < 0).sum(axis=1))]
        columns = [batch.column(0), pa.array(model.votes.posterior(cast)), pa.array(scores, pa.float64()), *counts]
        yield pa.RecordBatch.from_arrays(columns, ["id", "weak_good", "score", "good_votes", "bad_votes"])


def score_quality(docs: DataFrame, model: Model, cutoff: float = CUTOFF, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of docs: (id, score, keep, weak_good, good_votes, bad_votes).

    Null, empty and blank texts score 0 and are not kept. Null and repeated
    ids keep their rows; an empty table gives an empty result.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(partial(_scored, model=model), "id long, weak_good double, score double, good_votes long, bad_votes long")
    return out.select(F.col("id").alias(id_col), "score", (F.col("score") >= cutoff).alias("keep"), "weak_good", "good_votes", "bad_votes")


@tidy
def _kept(batches, model: Model, cutoff: float, text_col: str):
    shapes = Shapes()
    for batch in batches:
        keep = [_score(shapes, model.weights, text) >= cutoff for part in text_runs(batch.column(text_col)) for text in part]
        yield batch.filter(pa.array(keep, pa.bool_()))


def keep_good(docs: DataFrame, model: Model, cutoff: float = CUTOFF, text_col: str = "text") -> DataFrame:
    """The rows of docs, with their columns of whatever names, that score the cutoff or more.

    Null, empty and blank texts go; null and repeated ids and repeated rows are
    judged by their text like any other. An empty table gives an empty result.
    """
    return docs.mapInArrow(partial(_kept, model=model, cutoff=cutoff, text_col=text_col), docs.schema)
