"""Packing of token sequences into fixed windows by non-negative least squares over length combinations.

1. Every document is encoded and cut into windows of full length and one rest.
2. The histogram of piece lengths, at most `window` numbers however large the
   corpus, goes to the driver. Columns are the shallow combinations of one, two
   or three lengths that fill a window. Repeat counts that reproduce the
   histogram are found by non-negative least squares and rounded down to what
   the histogram holds; what is left is packed greedily, longest first, as
   whole runs of equal combinations.
3. The plan says, for each length, which copies go to which sequence and
   offset. A piece finds its place by its rank among pieces of its length;
   ranks are sums of counts per task, so no length is gathered in one task.
"""

from __future__ import annotations

import zlib
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salespect.functions.staging import staged
from salespect.llm.batches import STAGED_ROWS, tidy
from salespect.llm.tokens import Encoder, balanced

PARTNERS = 64  # the most frequent lengths tried as the middle one of three
ROUNDS = 300
BLOCK = 512  # pieces of one length and part that meet in a task


class Plan(NamedTuple):
    """Runs: copies rank .. rank + count of a length go to sequences sequence, sequence + 1, ... at one offset."""

    length: np.ndarray
    rank: np.ndarray
    sequence: np.ndarray
    offset: np.ndarray


def combinations(histogram: np.ndarray, partners: int = PARTNERS) -> np.ndarray:
    """Rows of three lengths (0: none), descending, that fill the window exactly and occur in the histogram."""
    window = len(histogram) - 1
    have = np.flatnonzero(histogram)
    here = np.append(histogram > 0, False)
    two = have[(have < window) & here[window - np.minimum(have, window)]]
    rows = [np.stack((two, window - two, 0 * two), 1)]
    common = have[np.argsort(-histogram[have], kind="stable")[:partners]]
    for middle in common:
        third = window - middle - have
        fit = have[(third > 0) & here[np.maximum(third, 0)]]
        rows.append(np.stack((fit, np.full(len(fit), middle), window - middle - fit), 1))
    if here[window]:
        rows.append(np.array([[window, 0, 0]]))
    return np.unique(-np.sort(-np.concatenate(rows), axis=1), axis=0).astype(np.int64).reshape(-1, 3)


def repeat_counts(columns: np.ndarray, histogram: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares by multiplicative steps: x * (A'h) / (A'Ax); x stays non-negative, the error falls."""
    target = histogram.astype(float)
    target[0] = 0
    used = columns > 0
    wanted = (target[columns] * used).sum(axis=1)
    counts = np.full(len(columns), max(1.0, target.sum() / max(1, len(columns)) / 3))
    for _ in range(rounds):
        made = np.bincount(columns.ravel(), weights=np.repeat(counts, 3), minlength=len(target))
        made[0] = 0
        counts *= wanted / np.maximum((made[columns] * used).sum(axis=1), 1e-12)
    return counts


def pack_histogram(histogram: np.ndarray) -> tuple[Plan, list[tuple[tuple[int, ...], int]]]:
    """Places for every piece of the histogram (index: length), and the (combination, repeats) of the sequences."""
    window = len(histogram) - 1
    left = histogram.astype(np.int64).copy()
    left[0] = 0
    chosen: list[tuple[tuple[int, ...], int]] = []
    columns = combinations(left)
    counts = repeat_counts(columns, left) if len(columns) else np.zeros(0)
    for at in np.argsort(-counts, kind="stable"):
        lengths, often = np.unique(columns[at][columns[at] > 0], return_counts=True)
        repeats = int(min(int(counts[at] + 0.5), (left[lengths] // often).min()))
        if repeats > 0:
            left[lengths] -= often * repeats
            chosen.append((tuple(int(x) for x in columns[at] if x), repeats))
    while left.any():  # each turn uses up one length at least
        room, lengths = window, []
        rest = left.copy()
        while room and (fits := np.flatnonzero(rest[1 : room + 1])).size:
            longest = int(fits[-1]) + 1
            copies = min(int(rest[longest]), room // longest)
            lengths += [longest] * copies
            rest[longest] -= copies
            room -= copies * longest
        kinds, often = np.unique(lengths, return_counts=True)
        repeats = int((left[kinds] // often).min())
        left[kinds] -= often * repeats
        chosen.append((tuple(lengths), repeats))
    next_rank = np.zeros(window + 1, np.int64)
    runs, sequence = [], 0
    for lengths, repeats in chosen:
        offset = 0
        for length in lengths:
            runs.append((length, int(next_rank[length]), sequence, offset))
            next_rank[length] += repeats
            offset += length
        sequence += repeats
    runs.sort()
    return Plan(*(np.array(x, np.int64) for x in zip(*runs, strict=True))) if runs else Plan(*np.zeros((4, 0), np.int64)), chosen


@tidy
def _pieces(batches, path: str, end_id: int, window: int):
    from pyspark import TaskContext

    encoder, part = Encoder(path), TaskContext.get().partitionId()
    ending = np.array([end_id], "<u4").tobytes()
    ranks = np.zeros(window + 1, np.int64)
    for batch in batches:
        for first, texts in balanced(batch.column(1)):
            flat = [ids + ending for ids in encoder.encode(texts)]
            sizes = np.array([len(x) // 4 for x in flat], np.int64)
            count = -(-sizes // window)
            row = np.repeat(np.arange(len(flat)), count)
            start = (np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)) * window
            length = np.minimum(window, sizes[row] - start)
            order = np.argsort(length, kind="stable")
            kinds, at, often = np.unique(length[order], return_index=True, return_counts=True)
            rank = np.empty(len(row), np.int64)
            rank[order] = np.arange(len(row)) - np.repeat(at, often) + np.repeat(ranks[kinds], often)
            ranks[kinds] += often
            ids = pa.array(np.frombuffer(b"".join(flat), "<u4").astype(np.int32))
            offsets = pa.array(np.append(0, np.cumsum(length)).astype(np.int32))
            names = batch.column(0)[first : first + len(flat)].take(pa.array(row))
            yield pa.RecordBatch.from_arrays(
                [names, pa.array(start), pa.array(length.astype(np.int32)), pa.array(sizes[row]), pa.array(np.full(len(row), part, np.int32)), pa.array(rank), pa.ListArray.from_arrays(offsets, ids)],
                ["id", "start", "length", "doc_tokens", "part", "rank", "ids"],
            )


def _digests(ids: pa.ListArray) -> pa.Array:
    offsets, values = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
    return pa.array([zlib.crc32(values[a:b].tobytes()) for a, b in zip(offsets[:-1], offsets[1:], strict=True)], pa.int64())


@tidy
def _placed(batches, plan, digests: bool):
    runs: Plan = plan.value
    keys = np.empty(len(runs.length), [("length", "<i8"), ("rank", "<i8")])
    keys["length"], keys["rank"] = runs.length, runs.rank
    first = np.searchsorted(runs.length, np.arange(runs.length.max(initial=0) + 2))
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        rank = batch.column("rank").to_numpy(zero_copy_only=False) + batch.column("base").to_numpy(zero_copy_only=False)
        at = np.zeros(len(length), np.int64)
        for kind in np.unique(length):
            mine, low, high = length == kind, first[kind], first[kind + 1]
            at[mine] = low + np.searchsorted(runs.rank[low:high], rank[mine], "right") - 1
        sequence = runs.sequence[at] + rank - runs.rank[at]
        kept = [batch.column(name) for name in ("id", "start", "length", "doc_tokens")]
        ids = batch.column("ids")
        content = _digests(ids) if digests else ids
        yield pa.RecordBatch.from_arrays([*kept, content, pa.array(sequence), pa.array(runs.offset[at])], ["id", "start", "length", "doc_tokens", "ids_crc32" if digests else "ids", "sequence_id", "offset"])


def pack(docs: DataFrame, tokenizer: str, end_id: int, window: int = 2048, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """One row per piece: (id, start, length, doc_tokens, ids, sequence_id, offset); with digests, the crc32 of the ids instead of them.

    A document is its ids and end_id; a null text has the end id alone. Every
    id of a document lies in one piece; pieces of a sequence follow each other
    without gaps. Null and repeated ids keep their rows; an empty table gives
    no pieces; other columns are ignored.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = "id long, start long, length int, doc_tokens long, part int, rank long, ids array<int>"
    pieces = staged(rows.mapInArrow(partial(_pieces, path=tokenizer, end_id=end_id, window=window), schema), "pieces", STAGED_ROWS)
    per_part = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    bases = per_part.selectExpr("length", "part", "n", "sum(n) over (partition by length order by part) - n as base")
    bases = bases.selectExpr("length", "part", "base", f"explode(sequence(0L, (n - 1) div {BLOCK})) as block")
    histogram = np.zeros(window + 1, np.int64)
    for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect():  # at most `window` rows
        histogram[row["length"]] = row["n"]
    plan = spark.sparkContext.broadcast(pack_histogram(histogram)[0])
    ranked = pieces.withColumn("block", F.expr(f"rank div {BLOCK}")).join(bases, ["length", "part", "block"])
    content = "ids_crc32 long" if digests else "ids array<int>"
    out = f"id long, start long, length int, doc_tokens long, {content}, sequence_id long, offset long"
    return ranked.mapInArrow(partial(_placed, plan=plan, digests=digests), out).withColumnRenamed("id", id_col)


def piece_digests(packed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Packed pieces with digests, in the order and types of the contract."""
    return packed.select(id_col, "start", F.col("length").cast("long").alias("length"), "doc_tokens", "sequence_id", "offset", "ids_crc32")
