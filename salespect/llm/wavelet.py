"""Token ids stored as one wavelet matrix per shard.

A shard holds whole documents in ascending order of their ids, about
SHARD_TOKENS tokens. Its file is the cell `data` of a Parquet row: a header,
then one bit plane per id bit, highest first, compressed together. Rank
directories are rebuilt on reading. Rows of Parquet are used as the container
so that writing is atomic and works on any store Spark can reach.

File: magic "WVM1", bits (u8), tokens (u64), documents (u64), the zero count
of each plane (u64 each), the compressed size (u64), zstandard data of the
planes (packed bits, most significant first), then ids of the documents (i64;
the smallest value marks null) and their lengths (u64).
"""

from __future__ import annotations

import struct
from collections.abc import Iterator
from functools import cached_property, partial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from salespect.functions.staging import staging_path
from salespect.llm.tokens import balanced, lasting_encoder

SHARD_TOKENS = 1 << 20
BLOCK = 512
STEP = 1 << 16
_MAGIC = b"WVM1"
_NULL = -(1 << 63)


def _moves(one: np.ndarray, zeros: int) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """A level's stable partition in blocks that fit caches: where from, where to, and the places in the first slice."""
    to = [0, zeros]
    for at in range(0, len(one), STEP):
        here = slice(at, at + STEP)
        for bit, mask in enumerate((~one[here], one[here])):
            places = np.flatnonzero(mask)
            yield here, slice(to[bit], to[bit] + len(places)), places
            to[bit] += len(places)


class WaveletMatrix:
    """Access, rank, select and counting over a sequence of ids, from bit planes."""

    def __init__(self, planes: np.ndarray, zeros: np.ndarray, size: int) -> None:
        self.planes, self.zeros, self.size, self.bits = planes, zeros.astype(np.int64), size, len(planes)

    @cached_property
    def _before(self) -> np.ndarray:
        """Rank directory: ones of each plane before each block. Writing and reading whole sequences need none."""
        blocks = self.size // BLOCK + 1
        out = np.zeros((self.bits, blocks + 1), np.int64)
        for level in range(self.bits):
            ones = np.add.reduceat(np.append(self.planes[level], 0).astype(np.int64), np.minimum(np.arange(blocks) * BLOCK, self.size))
            out[level, 1:] = np.cumsum(ones)
        return out

    @classmethod
    def build(cls, ids: np.ndarray) -> WaveletMatrix:
        ids = np.asarray(ids, np.uint32)
        bits = max(1, int(ids.max()).bit_length()) if len(ids) else 1
        planes, zeros = np.zeros((bits, len(ids)), np.uint8), np.zeros(bits, np.int64)
        ids = ids.astype(np.uint16 if bits <= 16 else np.uint32)
        back = np.empty_like(ids)
        for level in range(bits):
            one = np.not_equal(ids & ids.dtype.type(1 << (bits - 1 - level)), 0, out=planes[level].view(bool))
            zeros[level] = len(ids) - np.count_nonzero(one)
            for here, there, places in _moves(one, int(zeros[level])):
                ids[here].take(places, out=back[there], mode="clip")
            ids, back = back, ids
        return cls(planes, zeros, len(planes[0]))

    def _rank1(self, level: int, at: int) -> int:
        block = at // BLOCK
        return int(self._before[level, block] + self.planes[level, block * BLOCK : at].sum(dtype=np.int64))

    def access(self, at: int) -> int:
        value = 0
        for level in range(self.bits):
            bit, ones = int(self.planes[level, at]), self._rank1(level, at)
            value = value * 2 + bit
            at = int(self.zeros[level]) + ones if bit else at - ones
        return value

    def _node(self, value: int, end: int) -> tuple[int, int]:
        start = 0
        for level in range(self.bits):
            a, b = self._rank1(level, start), self._rank1(level, end)
            if value >> (self.bits - 1 - level) & 1:
                start, end = int(self.zeros[level]) + a, int(self.zeros[level]) + b
            else:
                start, end = start - a, end - b
        return start, end

    def rank(self, value: int, end: int) -> int:
        """How often value stands before position end."""
        if value >> self.bits:
            return 0
        a, b = self._node(value, end)
        return b - a

    def count(self, value: int) -> int:
        return self.rank(value, self.size)

    def select(self, value: int, nth: int) -> int:
        """Position of the nth (from 0) occurrence of value; -1 if there are fewer."""
        if value >> self.bits:
            return -1
        start, end = self._node(value, self.size)
        if nth < 0 or start + nth >= end:
            return -1
        at = start + nth
        for level in reversed(range(self.bits)):
            one = value >> (self.bits - 1 - level) & 1
            rank = at - int(self.zeros[level]) if one else at
            before = self._before[level]
            counts = before if one else np.minimum(np.arange(len(before)) * BLOCK, self.size) - before
            block = int(np.searchsorted(counts, rank, "right")) - 1
            inside = np.flatnonzero(self.planes[level, block * BLOCK : (block + 1) * BLOCK] == one)
            at = block * BLOCK + int(inside[rank - int(counts[block])])
        return at

    def all(self) -> np.ndarray:
        """The whole sequence: each level's stable partition undone, from the lowest plane up."""
        out = np.zeros(self.size, np.uint16 if self.bits <= 16 else np.uint32)
        back = np.empty_like(out)
        for level in reversed(range(self.bits)):
            one = self.planes[level].view(bool)
            zeros = int(self.zeros[level])
            out[zeros:] |= out.dtype.type(1 << (self.bits - 1 - level))
            for here, there, places in _moves(one, zeros):
                back[here][places] = out[there]
            out, back = back, out
        return out.astype(np.uint32)

    def dump(self) -> bytes:
        planes = zstandard.ZstdCompressor(level=3).compress(np.packbits(self.planes, axis=1).tobytes())
        return struct.pack(f"<B Q {self.bits}Q Q", self.bits, self.size, *map(int, self.zeros), len(planes)) + planes

    @classmethod
    def load(cls, data: bytes) -> tuple[WaveletMatrix, int]:
        """The matrix and the number of bytes it takes."""
        bits, size = struct.unpack_from("<B Q", data)
        *zeros, length = struct.unpack_from(f"<{bits}Q Q", data, 9)
        at = 9 + 8 * bits + 8
        raw = zstandard.ZstdDecompressor().decompress(data[at : at + length], max_output_size=bits * (-(-size // 8)))
        planes = np.frombuffer(raw, np.uint8).reshape(bits, -(-size // 8))
        planes = np.unpackbits(planes, axis=1, count=size) if size else np.zeros((bits, 0), np.uint8)
        return cls(planes, np.array(zeros), size), at + length


def dump_shard(ids: np.ndarray, docs: list[int | None], lengths: list[int]) -> bytes:
    names = np.array([_NULL if d is None else d for d in docs], "<i8")
    return _MAGIC + struct.pack("<Q", len(docs)) + WaveletMatrix.build(ids).dump() + names.tobytes() + np.array(lengths, "<u8").tobytes()


def load_shard(data: bytes) -> tuple[WaveletMatrix, np.ndarray, np.ndarray]:
    """The matrix, the ids of its documents and their lengths."""
    if data[:4] != _MAGIC:
        raise ValueError("not a token shard")
    (count,) = struct.unpack_from("<Q", data, 4)
    matrix, used = WaveletMatrix.load(data[12:])
    at = 12 + used
    return matrix, np.frombuffer(data, "<i8", count, at), np.frombuffer(data, "<u8", count, at + 8 * count).astype(np.int64)


def _shards(batches, path: str, end_id: int, shard_tokens: int):
    from pyspark import TaskContext

    encoder, part, number = lasting_encoder(path), TaskContext.get().partitionId(), 0
    ending = np.array([end_id], "<u4").tobytes()
    names, pieces, lengths, held = [], [], [], 0

    def shard():
        ids = np.frombuffer(b"".join(pieces), "<u4")
        row = {"part": part, "shard": number, "n_docs": len(names), "n_tokens": len(ids), "data": dump_shard(ids, names, lengths)}
        return pa.RecordBatch.from_pylist([row], _SHARD_SCHEMA)

    for batch in batches:
        for first, texts in balanced(batch.column(1)):
            rows = batch.column(0)[first : first + len(texts)].to_pylist()
            for name, ids in zip(rows, encoder.encode(texts), strict=True):
                names.append(name)
                pieces.append(ids + ending)
                lengths.append(len(pieces[-1]) // 4)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield shard()
                    names, pieces, lengths, held, number = [], [], [], 0, number + 1
    if names:
        yield shard()


_SHARD_SCHEMA = pa.schema([("part", pa.int32()), ("shard", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("data", pa.binary())])


def write_tokens(
    docs: DataFrame, path: str, tokenizer: str, end_id: int, shard_tokens: int = SHARD_TOKENS, id_col: str = "doc_id", text_col: str = "text"
) -> None:
    """Encode every text, end it with end_id, and write the shards below path in ascending order of ids.

    Null texts are empty (the end id alone); null ids come first; rows of one
    id are ordered by their text's hash. A document is never split, so a
    shard's memory is bounded by the longer of shard_tokens and its longest text.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text.alias("text"))
    order = rows.select("id", "text", F.xxhash64("text").alias("h")).repartitionByRange("id", "h").sortWithinPartitions("id", "h").select("id", "text")
    schema = "part int, shard int, n_docs long, n_tokens long, data binary"
    order.mapInArrow(partial(_shards, path=tokenizer, end_id=end_id, shard_tokens=shard_tokens), schema).write.parquet(path)


def _documents(batches):
    import zlib

    for batch in batches:
        for row in batch.to_pylist():
            matrix, names, lengths = load_shard(row["data"])
            ids = matrix.all().astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends, strict=True)]
            count = len(names)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, mask=names == _NULL), pa.array(np.full(count, row["part"], np.int32)), pa.array(np.full(count, row["shard"], np.int32)), pa.array(starts), pa.array(lengths), pa.array(sums, pa.int64())],
                ["id", "part", "shard", "inner", "n_tokens", "ids_crc32"],
            )


def read_documents(spark: SparkSession, path: str, id_col: str = "doc_id") -> DataFrame:
    """Per document, from the files alone: (id, start, n_tokens, ids_crc32, part, shard); start counts the ids of all earlier documents."""
    shards = spark.read.parquet(path)
    # Two steps, so that the running sums meet one row per shard of a part, then one row per part.
    inside = shards.selectExpr("part", "shard", "n_tokens", "sum(n_tokens) over (partition by part order by shard) - n_tokens as before")
    parts = {r["part"]: r["n"] for r in shards.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect()}  # one row per written part
    total, rows = 0, []
    for part in sorted(parts):
        rows.append((part, total))
        total += parts[part]
    offsets = spark.createDataFrame(rows, "part int, base long")
    bases = inside.join(F.broadcast(offsets), "part").selectExpr("part", "shard", "base + before as base")
    found = shards.select("part", "shard", "data").mapInArrow(_documents, "id long, part int, shard int, inner long, n_tokens long, ids_crc32 long")
    # One row of three numbers per shard of a million tokens: a ten-thousandth of the documents or less.
    return found.join(bases, ["part", "shard"]).select(F.col("id").alias(id_col), (F.col("base") + F.col("inner")).alias("start"), "n_tokens", "ids_crc32", "part", "shard")


def wavelet_round_trip(docs: DataFrame, tokenizer: str, end_id: int, **options) -> DataFrame:
    """Write the shards in the shared folder and return what read_documents finds in them."""
    spark = docs.sparkSession
    path = staging_path(spark, "token-shards")
    write_tokens(docs, path, tokenizer, end_id, **options)
    return read_documents(spark, path)
