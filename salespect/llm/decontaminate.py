"""Benchmark decontamination by greedy string tiling.

Benchmark items are taken in blocks of bounded size, each broadcast in turn, so
the number of passes grows with the benchmark and never the broadcast. A pass
joins the shared seeds: runs of MIN_MATCH words that a text and an item have in
common. For every (text, item) pair that shares one, running Karp-Rabin greedy
string tiling marks the longest common runs of words first, repeatedly, each
word of either side at most once. The share of the item's words that end up
marked is its coverage, whatever the order of the passages in the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.llm.batches import tidy
from salespect.llm.words import Alphabet, Runs, free_name, grams, words

MIN_MATCH = 5
COVERAGE = 0.6
BLOCK_BYTES = 8 << 20
#: ASCII characters that are neither letters nor digits part words here.
SEPARATORS = bytes(c for c in range(128) if not chr(c).isalnum())


def _open_runs(free: np.ndarray, size: int) -> np.ndarray:
    """Starts of the runs of size words that are all unmarked."""
    total = np.concatenate(([0], np.cumsum(free)))
    return np.flatnonzero(total[size:] - total[:-size] == size) if len(free) >= size else np.zeros(0, np.int64)


class _Pair:
    """A text and an item with the words that are marked so far; run hashes come from prefix sums made once."""

    def __init__(self, text: np.ndarray, item: np.ndarray) -> None:
        self.text, self.item = text, item
        self.text_runs, self.item_runs = Runs(text), Runs(item)
        self.free_text, self.free_item = np.ones(len(text), bool), np.ones(len(item), bool)

    def matches(self, size: int) -> Iterator[tuple[int, int]]:
        """Starts (text, item) of equal unmarked runs of size words, by equal running hashes, then by their words."""
        mine, theirs = _open_runs(self.free_text, size), _open_runs(self.free_item, size)
        if not len(mine) or not len(theirs):
            return
        left, right = self.text_runs.of(mine, size), self.item_runs.of(theirs, size)
        order = np.argsort(left, kind="stable")
        left = left[order]
        low, high = np.searchsorted(left, right), np.searchsorted(left, right, "right")
        for k in np.flatnonzero(low < high):
            b = int(theirs[k])
            for a in mine[order[low[k] : high[k]]].tolist():
                if np.array_equal(self.text[a : a + size], self.item[b : b + size]):
                    yield a, b


def tiling(text: np.ndarray, item: np.ndarray, shortest: int) -> int:
    """How many words of item greedy string tiling marks, with matches of at least shortest words, longest first."""
    if not len(text) or not len(item):
        return 0
    pair = _Pair(text, item)
    marked, size = 0, min(len(text), len(item))
    while True:
        # The largest size with a match: a longer common run contains every shorter one.
        low, high = shortest - 1, size
        while low < high:
            middle = (low + high + 1) // 2
            if next(pair.matches(middle), None) is None:
                high = middle - 1
            else:
                low = middle
        size = low
        if size < max(1, shortest):
            return marked
        for a, b in list(pair.matches(size)):
            if pair.free_text[a : a + size].all() and pair.free_item[b : b + size].all():
                pair.free_text[a : a + size] = pair.free_item[b : b + size] = False
                marked += size


def _item_words(texts: list[str | None], alphabet: Alphabet) -> list[np.ndarray]:
    return [p.hashes[a:b] for p in words(pa.array(texts, pa.string()), alphabet) for a, b in zip(p.first[:-1], p.first[1:], strict=True)]


@tidy
def _leaks(batches, block, shortest: int, coverage: float):
    alphabet = Alphabet(SEPARATORS)
    ids, texts = block.value
    items = _item_words(texts, alphabet)
    least = [min(shortest, len(x)) for x in items]
    by_size: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for size in {n for n in least if n}:
        found = [(grams(x, size), k) for k, x in enumerate(items) if least[k] == size]
        seed = np.concatenate([g for g, _ in found])
        owner = np.concatenate([np.full(len(g), k) for g, k in found])
        order = np.argsort(seed, kind="stable")
        by_size[size] = seed[order], owner[order]
    for batch in batches:
        rows = []
        for part in words(batch.column(1), alphabet):
            for size, (seed, owner) in by_size.items():
                mine = grams(part.hashes, size)  # runs over two texts fall out below
                low = np.searchsorted(seed, mine)
                hit = np.flatnonzero(seed[np.minimum(low, len(seed) - 1)] == mine)
                text_of = np.searchsorted(part.first, hit, "right") - 1
                inside = hit + size <= part.first[text_of + 1]
                pairs = set()
                for at, row in zip(hit[inside], text_of[inside], strict=True):
                    last = np.searchsorted(seed, mine[at], "right")
                    pairs.update((int(row), int(k)) for k in owner[low[at] : last])
                for row, k in sorted(pairs):
                    marked = tiling(part.hashes[part.first[row] : part.first[row + 1]], items[k], least[k])
                    if marked >= coverage * len(items[k]):
                        rows.append((part.rows.start + row, k, marked, len(items[k])))
        at = pa.array([r[0] for r in rows], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(at), batch.column(2).take(at), pa.array([ids[r[1]] for r in rows], pa.int64()), *(pa.array([r[n] for r in rows], pa.int64()) for n in (2, 3))],
            ["id", "row_key", "item_id", "marked", "item_words"],
        )


def _blocks(benchmark: DataFrame, item_col: str, text_col: str, limit: int) -> Iterator[tuple[list, list]]:
    """Items in runs of at most limit bytes (one item if it is longer), fetched one partition at a time."""
    ids, texts, held = [], [], 0
    for row in benchmark.select(F.col(item_col).cast("long"), F.col(text_col).cast("string")).where(F.col(text_col).isNotNull()).toLocalIterator():
        size = len(row[1].encode())
        if texts and held + size > limit:
            yield ids, texts
            ids, texts, held = [], [], 0
        ids.append(row[0])
        texts.append(row[1])
        held += size
    if texts:
        yield ids, texts


def benchmark_leaks(
    docs: DataFrame, benchmark: DataFrame, shortest: int = MIN_MATCH, coverage: float = COVERAGE, block_bytes: int = BLOCK_BYTES,
    id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
) -> DataFrame:
    """One row per (document row, item) whose coverage is reached: (id, item_id, marked, item_words, row_key).

    row_key is a hash of id and text, equal for repeated rows. Items shorter
    than shortest words must occur whole. Null and empty texts and items leak
    nothing; an empty table on either side gives an empty result.
    """
    spark = docs.sparkSession
    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"), row_key(id_col, text_col).alias("row_key")).where("text is not null")
    schema = "id long, row_key string, item_id long, marked long, item_words long"
    shared = [spark.sparkContext.broadcast(block) for block in _blocks(benchmark, item_col, item_text_col, block_bytes)]
    parts = [rows.mapInArrow(partial(_leaks, block=block, shortest=shortest, coverage=coverage), schema) for block in shared]
    none = spark.range(0).select(*(F.lit(None).cast(kind).alias(name) for name, kind in map(str.split, schema.split(", "))))
    return reduce(DataFrame.unionByName, parts or [none]).select(F.col("id").alias(id_col), "item_id", "marked", "item_words", "row_key")


def row_key(id_col: str = "doc_id", text_col: str = "text"):
    return F.md5(F.concat_ws("\x1f", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.col(text_col).cast("string")))


def clean_documents(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The rows of docs, with their columns of whatever names, that no item covers; null ids and texts stay."""
    leaks = benchmark_leaks(docs, benchmark, id_col=id_col, text_col=text_col, **options)
    key = free_name(docs, "row_key")
    return docs.withColumn(key, row_key(id_col, text_col)).join(leaks.select(F.col("row_key").alias(key)).distinct(), key, "left_anti").select(docs.columns)
