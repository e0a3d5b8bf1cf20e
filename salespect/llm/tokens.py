"""Token ids of whole texts by a tokenizer file, with texts cut where the tokenizer cuts anyway.

A byte-level tokenizer without normalizer first cuts a text into words, numbers,
signs and white space, and merges only within those. Texts of well-known
characters are cut in the same way here, many at once by classes of their bytes,
and each distinct piece is merged once by the library's model and kept. Other texts are cut only before a blank or
line feed that follows a character which is no white space in any view, into
stretches of some kilobytes that are encoded and not kept. A tokenizer that cuts
otherwise gets whole texts.

What is kept is bounded by bytes and ages in two generations: when the young
one is full it becomes the old one, whose pieces return as they are met.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

GENERATION_BYTES = 48 << 20
LASTING_BYTES = 96 << 20  # the same of an encoder that serves many tasks
ENTRY_BYTES = 220  # of a kept piece besides its characters and ids
LONGEST_KEPT = 128
BATCH_BYTES = 2 << 20
STRETCH = 16 << 10

# Characters whose class (letter, number, space, sign) is the same in all versions of Unicode.
_KNOWN = re.compile("[\t\n\r -~\u00a0-\u024f\u2010-\u2027\u20ac]*")
_LETTER = "A-Za-z\u00aa\u00b5\u00ba\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
_NUMBER = "0-9\u00b2\u00b3\u00b9\u00bc-\u00be"
_SPACE, _LETTERS, _NUMBERS, _SIGNS = range(4)
# Class of each character up to the last known one.
_CLASS = np.full(0x20AD, _SIGNS, np.uint8)
for _kind, _said in ((_SPACE, "\\s"), (_LETTERS, _LETTER), (_NUMBERS, _NUMBER)):
    _CLASS[[c for c in range(len(_CLASS)) if re.match(f"[{_said}]", chr(c))]] = _kind
_BYTE_CLASS = _CLASS[:256].tobytes()
# Byte-level vocabularies write a byte that is no visible character as the next one from 256 on.
_VISIBLE = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SHOWN = np.arange(256, dtype="<u4")
_SHOWN[[b for b in range(256) if b not in _VISIBLE]] = 256 + np.arange(256 - len(_VISIBLE))
_SHOWN[0] = ord(" ")  # between pieces; no known text has a zero byte, and a blank is written otherwise
_PACK = struct.Struct("<I")
_SURE = "[!-~\u00a1-\u024f]"  # no white space, whoever asks
_BOUNDARY = re.compile(f"(?<={_SURE})(?=[ \n])")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes; special strings in a text as the library takes them."""

    def __init__(self, path: str, generation_bytes: int | None = None) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        with open(path, encoding="utf-8") as file:
            said = json.load(file)
        cuts = said.get("pre_tokenizer") or {}
        self.cuts = cuts.get("type") == "ByteLevel" and cuts.get("use_regex") and not cuts.get("add_prefix_space") and not said.get("normalizer") and not said.get("post_processor")
        self.model = self.tokenizer.model
        special = [re.escape(t["content"]) for t in said.get("added_tokens", ())]
        self.special = re.compile("|".join(special)) if special else None
        self.kept: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}
        self.held = 0
        self.limit = GENERATION_BYTES if generation_bytes is None else generation_bytes

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _stretches(self, text: str) -> bytes:
        """A text that is not cut into pieces, encoded in stretches that end at safe boundaries."""
        out, start = [], 0
        while len(text) - start > 2 * STRETCH and (cut := _BOUNDARY.search(text, start + STRETCH)):
            out.append(self._plain(text[start : cut.start()]))
            start = cut.start()
        return b"".join((*out, self._plain(text[start:])))

    def _learn(self, pieces: list[bytes]) -> list[bytes]:
        """A piece is merged by the library's model, without cutting it again."""
        out = list(map(self.old.get, pieces))
        new = [n for n, known in enumerate(out) if known is None]
        shown = _SHOWN[np.frombuffer(b"\0".join([pieces[n] for n in new]), np.uint8)].tobytes().decode("utf-32-le").split(" ")
        merge, pack = self.model.tokenize, _PACK.pack
        for n, word in zip(new, shown):
            tokens = merge(word)
            out[n] = pack(tokens[0].id) if len(tokens) == 1 else b"".join([pack(token.id) for token in tokens])
        self.kept.update(zip(pieces, out))
        self.held += sum(map(len, pieces)) + sum(map(len, out)) + ENTRY_BYTES * len(pieces)
        for piece in [piece for piece in pieces if len(piece) > LONGEST_KEPT]:
            self.held -= len(piece) + len(self.kept.pop(piece)) + ENTRY_BYTES
        return out

    def _merged(self, texts: list[bytes]) -> list[bytes]:
        """Ids of texts of known characters: each distinct piece is looked up once."""
        sizes = np.array([len(text) for text in texts], np.int64)
        ends = np.cumsum(sizes)
        data = np.frombuffer(b"".join(texts), np.uint8)
        starts = cuts(data, ends - sizes)
        offsets = pa.py_buffer(np.append(starts, len(data)).astype(np.int32))
        pieces = pa.Array.from_buffers(pa.binary(), len(starts), [None, offsets, pa.py_buffer(data)]).dictionary_encode()
        used = pieces.dictionary.to_numpy(zero_copy_only=False).tolist()
        ids = list(map(self.kept.get, used))
        new = [n for n, known in enumerate(ids) if known is None]
        for n, learnt in zip(new, self._learn([used[n] for n in new]), strict=True):
            ids[n] = learnt
        count = np.fromiter(map(len, ids), np.int32, len(ids)) // 4
        which = pieces.indices.to_numpy().astype(np.intp)
        often = count[which]
        last = np.cumsum(often, dtype=np.int64)
        at = np.repeat((np.cumsum(count) - count)[which] - (last - often), often)
        at += np.arange(len(at))
        flat = np.frombuffer(b"".join(ids), "<u4")[at].tobytes()
        until = 4 * np.append(0, last)[np.searchsorted(starts, ends)]
        return [flat[x:y] for x, y in zip([0, *until[:-1]], until, strict=True)]

    def encode(self, texts: list[str]) -> list[bytes]:
        plain = [bool(self.cuts and not (self.special and self.special.search(text)) and _KNOWN.fullmatch(text)) for text in texts]
        merged = iter(self._merged([text.encode() for text, cut in zip(texts, plain, strict=True) if cut]) if any(plain) else ())
        out = [next(merged) if cut else self._stretches(text) if self.cuts else self._plain(text) for text, cut in zip(texts, plain, strict=True)]
        if self.held > self.limit:
            self.old, self.kept, self.held = self.kept, {}, 0
        return out


def lasting_encoder(path: str) -> Encoder:
    """The encoder of a file that the tasks of one worker share, with the pieces it knows; a changed file gets a new one."""
    told = os.stat(path)
    return _encoder(path, told.st_mtime_ns, told.st_size)


@lru_cache(maxsize=1)
def _encoder(path: str, changed: int, size: int) -> Encoder:
    return Encoder(path, LASTING_BYTES)


def _classes(data: np.ndarray) -> np.ndarray:
    """Class of the character that each byte belongs to, in UTF-8 of known characters."""
    out = np.frombuffer(bytearray(data.tobytes().translate(_BYTE_CLASS)), np.uint8)
    lead = np.flatnonzero(data >= 0xC0)
    two, three = lead[data[lead] < 0xE0], lead[data[lead] >= 0xE0]
    low = data & 0x3F
    out[two] = out[two + 1] = _CLASS[(data[two] & 0x1F).astype(np.int32) << 6 | low[two + 1]]
    out[three] = out[three + 1] = out[three + 2] = _CLASS[(data[three] & 0x0F).astype(np.int32) << 12 | low[three + 1].astype(np.int32) << 6 | low[three + 2]]
    return out


def cuts(data: np.ndarray, texts: np.ndarray) -> np.ndarray:
    """Where pieces begin in texts of known characters, whose first bytes are given; the tokenizer's own pattern is

    's|'t|'re|'ve|'m|'ll|'d| ?[letters]+| ?[numbers]+| ?[signs]+|\\s+(?!\\S)|\\s+
    """
    size = len(data)
    kind = _classes(data)
    edge = np.zeros(size + 4, bool)  # a text begins, or all end
    edge[texts] = True
    edge[size:] = True
    mark = edge[:size].copy()
    mark[1:] |= kind[1:] != kind[:-1]
    run = np.flatnonzero(mark)
    # The last of some white space before another character: a blank joins it, any other is a piece.
    after = run[(run > 0) & ~edge[run]]
    after = after[kind[after - 1] == _SPACE]
    mark[after] = data[after - 1] != 0x20
    mark[after - np.where(data[after - 1] < 0x80, 1, 2)] = True
    # An apostrophe that begins a piece takes its ending along.
    quote = np.flatnonzero(data == 0x27)
    quote = quote[mark[quote]]
    tail = np.append(data, np.zeros(3, np.uint8))
    first, second = tail[quote + 1], tail[quote + 2]
    one = np.isin(first, list(b"stmd"))
    both = ((second == ord("e")) & ((first == ord("r")) | (first == ord("v")))) | ((first == ord("l")) & (second == ord("l")))
    taken = np.where(edge[quote + 1], 0, np.where(one, 1, np.where(both & ~edge[quote + 2], 2, 0)))
    quote, taken = quote[taken > 0], taken[taken > 0]
    mark[quote + 1] = False
    mark = np.append(mark, np.zeros(1, bool))
    mark[quote + 1 + taken] = True
    return np.flatnonzero(mark[:size])


def balanced(column: pa.Array, limit: int = BATCH_BYTES) -> Iterator[tuple[int, list[str]]]:
    """Runs of rows of about limit bytes (one row if it is longer), as (first row, texts); null is empty."""
    column = column.fill_null("") if column.null_count else column
    sizes = np.diff(np.frombuffer(column.cast(pa.large_string()).buffers()[1], np.int64, len(column) + 1, column.offset * 8)) if len(column) else []
    first, held = 0, 0
    for row, size in enumerate(sizes):
        if held and held + size > limit:
            yield first, column[first:row].to_pylist()
            first, held = row, 0
        held += int(size)
    if first < len(column):
        yield first, column[first:].to_pylist()
