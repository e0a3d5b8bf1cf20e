"""Language of web pages by Bayesian fusion of text, declared language, address and host.

Text likelihoods come from byte trigrams hashed into a table of fixed size, one
row per language, counted over all labelled texts. Every page first gets its
posterior from text alone. Those are summed by declared language, by address
suffix and by host; each level is smoothed by the one above it (everything,
suffix, host), less the page's own share. The product of text likelihood,
declaration likelihood and host prior decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.llm.html_text import main_text

CELLS = 1 << 13
STRENGTH = 5.0  # texts a level of the host hierarchy counts as
DECLARED_STRENGTH = 2.0
MOST_EVIDENCE = 400  # trigrams are not independent: a longer text counts as so many
_HTML_LANG = r"(?i)<html\b[^>]*?\slang\s*=\s*[\"']?([a-z]{2,3})\b"


def _trigrams(text: str) -> np.ndarray:
    data = np.frombuffer(re.sub(r"[\W\d_]+", " ", f" {text} ".lower()).encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64)
    code = (data[:-2] << np.uint32(16) | data[1:-1] << np.uint32(8) | data[2:]) * np.uint32(2654435761)
    return (code >> np.uint32(32 - 13)).astype(np.int64)


def _counted(batches):
    tables: dict[str, np.ndarray] = {}
    rows: dict[str, int] = {}
    for batch in batches:
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            table = tables.setdefault(lang, np.zeros(CELLS, np.int64))
            table += np.bincount(_trigrams(text), minlength=CELLS)
            rows[lang] = rows.get(lang, 0) + 1
    columns = [pa.array(list(tables), pa.string()), pa.array([rows[k] for k in tables], pa.int64()), pa.array([t.tobytes() for t in tables.values()], pa.binary())]
    yield pa.RecordBatch.from_arrays(columns, ["lang", "n", "cells"])


def _summed(key: tuple, frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    total, n = np.zeros(CELLS, np.int64), 0
    for frame in frames:
        n += int(frame["n"].sum())
        for cells in frame["cells"]:
            total += np.frombuffer(cells, np.int64)
    yield pd.DataFrame({"lang": [key[0]], "n": [n], "cells": [total.tobytes()]})


def train(docs: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and the log chances of trigram cells, from all rows with a text and a language; both empty without any."""
    rows = docs.select(F.col("text").cast("string").alias("text"), F.lower(F.trim(F.col("lang").cast("string"))).alias("lang")).where("text is not null and lang <> ''")
    parts = rows.mapInArrow(_counted, "lang string, n long, cells binary")
    found = sorted(parts.groupBy("lang").applyInPandas(_summed, "lang string, n long, cells binary").collect(), key=lambda r: r["lang"])  # one row per language
    counts = np.array([np.frombuffer(r["cells"], np.int64) for r in found], float).reshape(-1, CELLS) + 0.5
    return [r["lang"] for r in found], np.log(counts / counts.sum(axis=1, keepdims=True))


def _evidence(batches, logs: np.ndarray):
    for batch in batches:
        out = []
        for page in batch.column(1).to_pylist():
            cells = _trigrams(main_text(page))
            logp = logs[:, cells].sum(axis=1) * (min(1.0, MOST_EVIDENCE / len(cells)) if len(cells) else 0.0)
            out.append(logp - logp.max())
        flat = np.concatenate(out) if out else np.zeros(0)
        offsets = np.arange(len(out) + 1, dtype=np.int32) * len(logs)
        keys = [batch.column(k) for k in (0, 2, 3, 4, 5)]
        yield pa.RecordBatch.from_arrays([*keys, pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))], ["page_id", "url", "declared", "host", "suffix", "logp"])


def identify(pages: DataFrame, languages: list[str], logs: np.ndarray) -> DataFrame:
    """One row per row of pages: (page_id, url, lang, probability, declared, host).

    Pages without text rest on declaration and host; with neither, on the
    languages' shares over all pages. Ties go to the first language in
    alphabetical order. Null ids, urls and repeated rows stay. Without any
    language all lang are null.
    """
    from salespect.functions.staging import staged

    url, page = F.col("url").cast("string"), F.col("html").cast("string")
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1))
    declared = F.lower(F.regexp_extract(F.coalesce(page, F.lit("")), _HTML_LANG, 1))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.coalesce(page, F.lit("")).alias("html"), url.alias("url"), declared.alias("declared"), host.alias("host"))
    rows = rows.withColumn("suffix", F.substring_index("host", ".", -1))
    if not languages:
        return rows.selectExpr("page_id", "url", "cast(null as string) as lang", "cast(null as double) as probability", "declared", "host")
    width = len(languages)
    schema = "page_id long, url string, declared string, host string, suffix string, logp array<double>"
    found = staged(rows.select("page_id", "html", "url", "declared", "host", "suffix").mapInArrow(partial(_evidence, logs=logs), schema), "language-evidence")

    total = F.aggregate(F.transform("logp", F.exp), F.lit(0.0), lambda a, b: a + b)
    own = found.withColumn("own", F.transform("logp", lambda x: F.exp(x) / total))
    def sums(key: str, name: str) -> DataFrame:
        each = [F.sum(F.col("own")[k]) for k in range(width)]
        return own.groupBy(key).agg(F.array(*each).alias(name))

    every = own.agg(*(F.sum(F.col("own")[k]).alias(f"s{k}") for k in range(width))).first()  # one number per language
    mass = np.array([every[k] or 0.0 for k in range(width)]) + 0.5
    base = F.array(*(F.lit(float(x)) for x in mass / mass.sum()))
    size = F.array(*(F.lit(float(x)) for x in mass))
    # A host or suffix that is hot is one summed row here; the joins' large side is split at run time where it is skewed.
    joined = own.join(sums("declared", "by_declared"), "declared").join(sums("suffix", "by_suffix"), "suffix").join(sums("host", "by_host"), "host")

    def less(name: str, prior, strength: float):
        left = F.zip_with(name, "own", lambda s, o: F.greatest(s - o, F.lit(0.0)))
        weight = F.aggregate(left, F.lit(0.0), lambda a, b: a + b) + strength
        return F.zip_with(left, prior, lambda s, p: (s + strength * p) / weight)

    joined = joined.withColumn("prior", less("by_suffix", base, STRENGTH))
    joined = joined.withColumn("prior", F.when(F.col("host") == "", base).otherwise(less("by_host", F.col("prior"), STRENGTH)))
    # P(declared | language): pages of the language that declare it so, smoothed by how common the declaration is.
    own_declared = F.zip_with("by_declared", "own", lambda s, o: F.greatest(s - o, F.lit(0.0)))
    share = F.aggregate("by_declared", F.lit(0.0), lambda a, b: a + b) / float(mass.sum())
    said = F.zip_with(own_declared, size, lambda s, n: (s + DECLARED_STRENGTH * share) / (n + DECLARED_STRENGTH))
    joined = joined.withColumn("said", F.when(F.col("declared") == "", F.array_repeat(F.lit(1.0), width)).otherwise(said))
    fused = F.zip_with(F.zip_with("logp", "prior", lambda a, b: a + F.log(b)), "said", lambda a, b: a + F.log(b))
    joined = joined.withColumn("fused", fused)
    most = F.array_max("fused")
    names = F.array(*map(F.lit, languages))
    lang = F.element_at(names, F.array_position("fused", most).cast("int"))
    weight = F.aggregate(F.transform("fused", lambda x: F.exp(x - most)), F.lit(0.0), lambda a, b: a + b)
    return joined.select("page_id", "url", lang.alias("lang"), (1 / weight).alias("probability"), "declared", "host")
