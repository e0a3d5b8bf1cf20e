"""Toxicity by compression distance against two zstandard dictionaries.

Training counts, over all labelled rows, in how many different toxic and
ordinary texts each word stands. The toxic dictionary holds the words that are
far commoner in toxic texts, the ordinary one the commonest of ordinary texts;
both have a fixed greatest size. A window is one word with its borders. Every
byte of it is spelled in sixteen, so that a match, whose cost is fixed, pays by its
length even in a window this short. The advantage of a window is how much less
it takes with the toxic dictionary than with the ordinary one, as a share of
its length. Windows that the toxic dictionary does not cover but for a letter
count as none. The threshold on the advantage, and the score for 0, 1, 2 ... windows above
it, are calibrated on all training rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from functools import partial
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import staged
from salespect.llm.batches import texts as text_runs
from salespect.llm.batches import STAGED_ROWS, tidy

TOXIC_WORDS = 500
ORDINARY_WORDS = 1000
LEAST_ODDS = 4.0
LEAST_TEXTS = 3
LEAST_SHARE = 0.005
THRESHOLDS = (0.1, 0.2, 0.3, 0.4, 0.5, 0.6)
MOST_HITS = 4
COVERED = 22  # bytes of a window that one match covers: more than that match, less than it and a letter
TRAINING_ROWS = 500_000  # most labelled rows a model is fitted on, taken by a hash of their ids
CACHE_ENTRIES = 300_000
_WORD = re.compile(r"[^\W\d_]+")


def spelled(word: str) -> bytes:
    """Eight bytes per byte of the word and its borders, a hash of the window up to it."""
    data = f" {word} ".encode()
    return b"".join([hashlib.md5(data[:end]).digest()[:8] for end in range(1, len(data) + 1)])


class Model(NamedTuple):
    toxic: tuple[str, ...]
    ordinary: tuple[str, ...]
    threshold: float
    scores: tuple[float, ...]


class Windows:
    """Advantages of windows under a pair of dictionaries, each distinct word compressed once."""

    def __init__(self, toxic: tuple[str, ...], ordinary: tuple[str, ...]) -> None:
        self.by_toxic, self.by_ordinary = self._compressor(toxic), self._compressor(ordinary)
        self.cache: dict[str, float] = {}

    @staticmethod
    def _compressor(content: tuple[str, ...]):
        dictionary = zstandard.ZstdCompressionDict(b"".join(map(spelled, content)) or bytes(8), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        dictionary.precompute_compress(level=3)
        return zstandard.ZstdCompressor(level=3, dict_data=dictionary, write_content_size=False, write_dict_id=False)

    def advantage(self, word: str) -> float:
        found = self.cache.get(word)
        if found is None:
            if len(self.cache) >= CACHE_ENTRIES:
                self.cache.clear()
            window = spelled(word)
            toxic = len(self.by_toxic.compress(window))
            found = 0.0 if toxic > COVERED else (len(self.by_ordinary.compress(window)) - toxic) / len(window)
            self.cache[word] = found
        return found

    def advantages(self, text: str | None) -> list[float]:
        return [a for a in map(self.advantage, _WORD.findall((text or "").lower())) if a > 0]


@tidy
def _words(batches):
    """Each labelled text as its different words and how often each is in it."""
    for batch in batches:
        first = 0
        for part in text_runs(batch.column(1)):
            counts = [Counter(_WORD.findall(text.lower())) for text in part]
            words, times = pa.array([list(c) for c in counts], pa.list_(pa.string())), pa.array([list(c.values()) for c in counts], pa.list_(pa.int32()))
            columns = [batch.column(0).slice(first, len(part)), batch.column(2).slice(first, len(part)), words, times]
            yield pa.RecordBatch.from_arrays(columns, ["digest", "label", "words", "times"])
            first += len(part)


@tidy
def _hits(frames, toxic, ordinary):
    windows = Windows(toxic, ordinary)
    for frame in frames:
        counted = np.zeros((len(THRESHOLDS), MOST_HITS + 1, 2), np.int64)
        for words, times, label, copies in zip(frame["words"], frame["times"], frame["label"], frame["copies"], strict=True):
            found = np.array([windows.advantage(word) for word in words])
            for k, threshold in enumerate(THRESHOLDS):
                counted[k, min(MOST_HITS, int(times[found >= threshold].sum())), label] += copies
        k, hits, label = np.nonzero(counted)
        yield pd.DataFrame({"k": k, "hits": hits, "label": label, "n": counted[k, hits, label]})


def _calibrated(counts: np.ndarray) -> tuple[float, tuple[float, ...]]:
    """counts (threshold, hits, label): the threshold of least log loss, and rising scores per hits."""
    best, chosen = np.inf, (THRESHOLDS[-1], (0.0,) * (MOST_HITS + 1))
    base = counts[0].sum(axis=0)
    prior = (base[1] + 0.5) / (base.sum() + 1)
    for k, threshold in enumerate(THRESHOLDS):
        ordinary, toxic = counts[k].T
        scores = np.maximum.accumulate((toxic + prior) / (toxic + ordinary + 1))
        loss = -(toxic * np.log(scores) + ordinary * np.log(1 - scores)).sum()
        if loss < best - 1e-9:
            best, chosen = loss, (threshold, tuple(float(x) for x in scores))
    return chosen


def training_rows(docs: DataFrame, labels: DataFrame, most: int = TRAINING_ROWS) -> DataFrame:
    """Labelled texts outside the held-out third, as (text, label); rows without a label or with other labels are left out.

    At most `most` labels are used, so their ids and labels, 16 bytes each, can
    be broadcast and no text is shuffled.
    """
    label = labels.where("toxic in (0, 1)").select(F.col("doc_id").alias("__doc"), F.col("toxic").cast("int").alias("label"))
    label = label.where(~held_out("__doc")).orderBy(F.xxhash64("__doc"), "__doc", "label").limit(most)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text")).where(F.col("text").isNotNull())
    return rows.join(F.broadcast(label), rows["doc_id"] == label["__doc"]).select("text", "label")


def held_out(id_col: str):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def train(rows: DataFrame) -> Model:
    """rows (text, label 0 or 1). With no toxic rows the model scores every text the same, low."""
    keyed = rows.select(F.unhex(F.md5("text")).alias("digest"), "text", "label")
    worded = keyed.mapInArrow(_words, "digest binary, label int, words array<string>, times array<int>")
    # Copies of a text are one witness. Words cross the shuffle once, texts never.
    once = worded.groupBy("digest", "label").agg(F.first("words").alias("words"), F.first("times").alias("times"), F.count("*").alias("copies"))
    once = staged(once.select("label", "words", "times", "copies"), "toxic-texts", STAGED_ROWS)
    counts = once.select(F.explode("words").alias("word"), "label").groupBy("word").agg(F.sum("label").alias("t"), F.sum(F.expr("1 - label")).alias("o"))
    counts = staged(counts, "toxic-words")
    total = once.agg(F.sum("label").alias("t"), F.sum(F.expr("1 - label")).alias("o")).first()
    toxic_texts, ordinary_texts = total["t"] or 0, total["o"] or 0
    odds = F.log((F.col("t") + 0.5) / (toxic_texts + 1)) - F.log((F.col("o") + 0.5) / (ordinary_texts + 1))
    least = max(LEAST_TEXTS, LEAST_SHARE * toxic_texts)
    counts = counts.withColumn("odds", odds)
    told = counts.where((F.col("t") >= least) & (F.col("odds") >= LEAST_ODDS)).orderBy(F.desc("t"), "word").limit(TOXIC_WORDS)
    plain = counts.where((F.col("o") > 0) & (F.col("odds") < 1)).orderBy(F.desc("o"), "word").limit(ORDINARY_WORDS)
    kinds = told.selectExpr("word", "true as toxic").unionByName(plain.selectExpr("word", "false as toxic")).collect()
    toxic = tuple(sorted(r["word"] for r in kinds if r["toxic"]))
    ordinary = tuple(sorted(r["word"] for r in kinds if not r["toxic"]))
    found = once.mapInPandas(partial(_hits, toxic=toxic, ordinary=ordinary), "k int, hits int, label int, n long")
    table = np.zeros((len(THRESHOLDS), MOST_HITS + 1, 2), np.int64)
    for r in found.groupBy("k", "hits", "label").agg(F.sum("n").alias("n")).collect():  # at most 60 rows
        table[r["k"], r["hits"], r["label"]] = r["n"]
    return Model(toxic, ordinary, *_calibrated(table))


@tidy
def _scored(batches, model: Model):
    windows = Windows(model.toxic, model.ordinary)
    for batch in batches:
        hits = [sum(a >= model.threshold for a in windows.advantages(text)) for part in text_runs(batch.column(2)) for text in part]
        scores = [model.scores[min(MOST_HITS, n)] for n in hits]
        columns = [batch.column(0), batch.column(1), pa.array(hits, pa.int64()), pa.array(scores, pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "windows", "score"])


def score_toxicity(docs: DataFrame, model: Model, cutoff: float = 0.7) -> DataFrame:
    """One row per row of docs: (doc_id, held_out, score, predicted, windows), windows being those above the threshold.

    Null and empty texts have no windows; null ids count as not held out and
    keep their rows; other columns are ignored.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out("doc_id").alias("held_out"), F.col("text").cast("string").alias("text"))
    out = rows.mapInArrow(partial(_scored, model=model), "doc_id long, held_out boolean, windows long, score double")
    return out.select("doc_id", "held_out", "score", (F.col("score") >= cutoff).cast("int").alias("predicted"), "windows")


@tidy
def _kept(batches, model: Model, cutoff: float):
    windows = Windows(model.toxic, model.ordinary)
    for batch in batches:
        hits = [sum(a >= model.threshold for a in windows.advantages(text)) for part in text_runs(batch.column("text")) for text in part]
        yield batch.filter(pa.array([model.scores[min(MOST_HITS, n)] < cutoff for n in hits], pa.bool_()))


def drop_toxic(docs: DataFrame, model: Model, cutoff: float = 0.7) -> DataFrame:
    """The rows of docs, with their columns, that score below the cutoff."""
    return docs.mapInArrow(partial(_kept, model=model, cutoff=cutoff), docs.schema)
