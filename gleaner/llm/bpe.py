"""Byte-level BPE encoding and decoding with a sentencepiece model written straight from a rank file.

The rank file (base64 bytes and rank per line) is turned into the bytes of a sentencepiece BPE model, without any
training: each token is one piece in which every byte is one printable character, its score is the negative rank,
and the normaliser is the identity without dummy prefix or white-space handling. Merging the pair with the best
score is then merging the pair with the lowest rank, leftmost first. A text is cut into pre-tokens by the given
pattern; each is looked up whole first and else merged by the model on its own. Decoding maps ids back to bytes.

Defined results: a null text is empty and has no ids; repeated rows are encoded alike; special-token strings inside
a text are ordinary text; an empty table gives no row; other columns stay as they are. The vocabulary has to hold all
256 single bytes. Rows are worked on where they are, batch by batch; what a task holds is the model, one batch and
a table of at most ``CACHE`` pre-tokens that only saves repeated work.
"""

from __future__ import annotations

import base64
import itertools
import re
import struct
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from gleaner.llm.common import map_batches

CACHE = 100_000
UNKNOWN = "<unk>"


def load_ranks(path: str) -> list[bytes]:
    """The tokens of a rank file in the order of their ranks, which must be 0, 1, 2, ..."""
    ranks = {}
    for line in Path(path).read_bytes().splitlines():
        if line:
            token, rank = line.split()
            ranks[int(rank)] = base64.b64decode(token)
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError("ranks are not consecutive")
    tokens = [ranks[i] for i in range(len(ranks))]
    if missing := set(range(256)) - {t[0] for t in tokens if len(t) == 1}:
        raise ValueError(f"no token for the bytes {sorted(missing)}")
    return tokens


def byte_characters() -> list[str]:
    """A printable character for each byte: visible Latin-1 bytes stand for themselves, others lie from U+0100 on."""
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


def _field(number: int, wire: int) -> bytes:
    return bytes([number << 3 | wire])


def _varint(value: int) -> bytes:
    out = bytearray()
    while value > 127:
        out.append(value & 127 | 128)
        value >>= 7
    return bytes([*out, value])


def _block(number: int, content: bytes) -> bytes:
    return _field(number, 2) + _varint(len(content)) + content


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece ModelProto: pieces with ids equal to ranks, then the unknown piece that BPE models need."""
    letters = byte_characters()
    model = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(letters[b] for b in token).encode()
        model += _block(1, _block(1, piece) + _field(2, 5) + struct.pack("<f", -float(rank)))
    unknown = _block(1, UNKNOWN.encode()) + _field(2, 5) + struct.pack("<f", 0.0) + _field(3, 0) + _varint(2)
    model += _block(1, unknown)
    # Trainer spec: BPE, vocabulary size, unknown id; no begin, end or padding piece.
    none = _varint((1 << 64) - 1)
    trainer = (
        _field(3, 0) + _varint(2) + _field(4, 0) + _varint(len(tokens) + 1)
        + _varint(40 << 3) + _varint(len(tokens)) + _varint(41 << 3) + none + _varint(42 << 3) + none + _varint(43 << 3) + none
    )
    # Normaliser spec: identity; no dummy prefix, no removal or escaping of white space.
    normaliser = _block(1, b"identity") + _field(3, 0) + b"\0" + _field(4, 0) + b"\0" + _field(5, 0) + b"\0"
    return bytes(model + _block(2, trainer) + _block(3, normaliser))


def explicit(pattern: str, below: int) -> str:
    """The pattern for texts with code points under ``below`` only, with classes spelled out as ranges.

    The ``re`` module finds matches of such a pattern much faster than ``regex`` finds those of the given one. The
    members of each class are taken from ``regex``, so both cut alike.
    """
    every = "".join(map(chr, range(below))) if below <= 0xD800 else "".join(map(chr, [*range(0xD800), *range(0xE000, below)]))

    def ranges(name: str) -> str:
        return "".join(f"\\U{ord(run[0]):08X}-\\U{ord(run[-1]):08X}" for run in regex.findall(f"{name}+", every))

    known = {name: ranges(name) for name in ("\\p{L}", "\\p{N}", "\\s")}
    out = ""
    for token in re.findall(r"\\p\{\w\}|\\.|.", pattern, re.DOTALL):
        inside = out.rfind("[") > out.rfind("]")
        if token == "\\S":
            out += f"[^{known[chr(92) + 's']}]"
        elif token in known:
            out += known[token] if inside else f"[{known[token]}]"
        else:
            out += token
    return out


class Finder:
    """Cuts texts by a pattern, with the fastest equivalent pattern for the characters of each text."""

    def __init__(self, pattern: str):
        self.ascii = re.compile(explicit(pattern, 0x80)).findall
        self.plane = re.compile(explicit(pattern, 0x10000)).findall
        self.every = regex.compile(pattern).findall

    def __call__(self, text: str) -> list[str]:
        if text.isascii():
            return self.ascii(text)
        return self.plane(text) if len(text.encode("utf-16-le")) == 2 * len(text) else self.every(text)


class Codec:
    """Encoder and decoder of one rank list; texts and ids are handled as Arrow arrays of a batch."""

    def __init__(self, tokens: list[bytes], model: bytes, pattern: str):
        import sentencepiece

        self.bytes = pa.array(tokens, pa.binary())
        self.whole = {token: rank for rank, token in enumerate(tokens)}
        self.letters = dict(enumerate(byte_characters()))
        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        self.find = Finder(pattern)
        self.cache: dict[str, list[int]] = {}

    def lists(self, pre_tokens: list[str]) -> list[list[int]]:
        """The ids of each of the pre-tokens, which differ from each other."""
        cache = self.cache
        if len(cache) > CACHE:
            cache.clear()
        rest = []
        for p in pre_tokens:
            if p not in cache:
                rank = self.whole.get(p.encode())
                if rank is None:
                    rest.append(p)
                else:
                    cache[p] = [rank]
        # Latin-1 makes each byte a character of its own, which the table then turns into its printable one.
        mapped = [p.encode().decode("latin-1").translate(self.letters) for p in rest]
        if rest:
            cache.update(zip(rest, self.pieces.encode(mapped, out_type=int, num_threads=1), strict=True))
        return [cache[p] for p in pre_tokens]

    def encode(self, texts: pa.Array) -> pa.ListArray:
        """Each different pre-token of the batch is encoded once; the ids are then dealt out to its places."""
        found = [self.find(t or "") for t in texts.to_pylist()]
        flat = pa.array(list(itertools.chain.from_iterable(found)), pa.string()).dictionary_encode()
        lists = pa.array(self.lists(flat.dictionary.to_pylist()), pa.list_(pa.int32()))
        ids = lists.take(flat.indices)
        ends = np.cumsum([0, *map(len, found)])
        at = ids.offsets.to_numpy()
        return pa.ListArray.from_arrays(pa.array(at[ends] - at[0], pa.int32()), ids.flatten())

    def decode(self, ids: pa.ListArray) -> pa.BinaryArray:
        """The bytes of all ids of the batch lie in a row; each text is a stretch of them. No ids: no bytes."""
        ends = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy())])
        parts = self.bytes.take(pc.list_flatten(ids))
        if not len(parts):
            return pa.array([b""] * len(ids), pa.binary())
        _, offsets, body = parts.buffers()
        at = np.frombuffer(offsets, np.int32)[parts.offset + ends]
        return pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, pa.py_buffer(at), body])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (array of int) for each whole text."""
    return _mapped(docs, path, pattern, [IDS], [], lambda codec, part: [codec.encode(part.column(text))])


def decode(encoded: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``encoded`` with ``decoded`` (the bytes that the ids stand for)."""
    return _mapped(encoded, path, ".", [DECODED], [], lambda codec, part: [codec.decode(part.column(ids))])


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` and ``decoded`` in place of the text: encoded and decoded in one pass."""
    def convert(codec: Codec, part: pa.RecordBatch) -> list[pa.Array]:
        ids = codec.encode(part.column(text))
        return [ids, codec.decode(ids)]

    return _mapped(docs, path, pattern, [IDS, DECODED], [text], convert)


IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))
DECODED = T.StructField("decoded", T.BinaryType())


def _mapped(rows: DataFrame, path: str, pattern: str, new: list, without: list[str], convert: Callable) -> DataFrame:
    rows = rows.drop(*(f.name for f in new))
    kept = [f for f in rows.schema.fields if f.name not in without]
    names = [f.name for f in [*kept, *new]]
    tokens = load_ranks(path)
    # The model grows with the vocabulary file only; executors need not have the file.
    shared = rows.sparkSession.sparkContext.broadcast((tokens, serialise(tokens), pattern))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(*shared.value)
        for batch in batches:
            for part in slices(batch):
                old = [part.column(f.name) for f in kept]
                yield pa.RecordBatch.from_arrays([*old, *convert(codec, part)], names)

    return map_batches(rows, run, T.StructType([*kept, *new]))


def slices(batch: pa.RecordBatch, rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that lists of Python objects stay small."""
    for start in range(0, batch.num_rows, rows):
        yield batch.slice(start, rows)
