"""Packing along a space-filling curve.

A document's token counts are hashed into a vector, the vector is projected to a few
dimensions, and its place on a Hilbert curve through them is its sort key: documents
that use the same words lie close together. The documents are range-sorted by that key,
and each range is cut into sequences in order. Every sequence is full but those that
hold the end of a range; these are cut at powers of two, so that nothing is padded.
"""

import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Remembered, materialised, mix

LENGTH = 2048
SEPARATOR = 1
BUCKETS = 256
DIMENSIONS = 4
BITS = 10
PIECE = ("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "curve_key")
# Letters that composition leaves alone in any version of Unicode, white
# space, and the tokenizer's pre-tokens among these and other printable ASCII.
LETTERS = "a-zß-öø-ſ"
BLANKS = r" \t\n\r\x0b\x0c"
PLAIN = re.compile(f"[{BLANKS}!-~À-ÖØ-öø-ſ]*").fullmatch
PRE_TOKENS = re.compile(f"[{LETTERS}]+|[0-9]|'(?:s|t|re|ve|m|ll|d)|[^{BLANKS}0-9{LETTERS}]+").findall
WORDS = re.compile(f"[^{BLANKS}]+").findall


class WordIds:
    """Token ids of texts under a lower-casing word BPE file of the tokenizers library.

    No token crosses white space or pre-tokens, so a text's ids are those of its
    pre-tokens in a row, and each distinct one is encoded once. Texts of plain letters
    are cut into pre-tokens here. Any other text is cut at white space, and its words
    that have other letters or may hold a special token go through the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = "H" if self.tokenizer.get_vocab_size() <= 1 << 16 else "I"
        self.letters = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.tokenize = self.tokenizer.model.tokenize
        self.runs = Remembered(self.run, 400_000)
        self.words = Remembered(self.word, 50_000)

    def run(self, pre_token: str) -> bytes:
        if not pre_token.isascii():
            pre_token = self.letters(pre_token)[0][0]
        return array(self.kind, [token.id for token in self.tokenize(pre_token)]).tobytes()

    def word(self, word: str) -> bytes:
        if PLAIN(word) and "<|" not in word:
            return b"".join(self.runs.all(PRE_TOKENS(word.lower())))
        return array(self.kind, self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def text(self, text: str | None) -> np.ndarray:
        text = text or ""
        if PLAIN(text) and "<|" not in text:
            parts = self.runs.all(PRE_TOKENS(text.lower()))
        else:
            parts = self.words.all(WORDS(text))
        return np.frombuffer(b"".join(parts), self.kind)


@lru_cache(maxsize=2)
def _words(path: str) -> WordIds:
    return WordIds(path)


def hilbert(points: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of integer coordinates below 2 ** bits."""
    axes = [column.copy() for column in points.T.astype(np.int64)]
    for level in range(bits - 1, 0, -1):
        half, low = 1 << level, (1 << level) - 1
        for axis in axes:
            upper = (axis & half) != 0
            swap = np.where(upper, 0, (axes[0] ^ axis) & low)
            axes[0] ^= np.where(upper, low, swap)
            axis ^= swap
    for before, axis in zip(axes, axes[1:]):
        axis ^= before
    flip = np.zeros_like(axes[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((axes[-1] >> level) & 1, (1 << level) - 1, 0)
    key = np.zeros_like(axes[0])
    for level in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << 1) | (((axis ^ flip) >> level) & 1)
    return key


@lru_cache(maxsize=1)
def _projection() -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each id below 2 ** 17, and the directions to project the buckets on."""
    turns = mix(np.arange(BUCKETS * DIMENSIONS), seed=1) >> np.uint64(63)
    bucket = mix(np.arange(1 << 17)) % np.uint64(BUCKETS)
    return bucket.astype(np.int64), np.where(turns, 1.0, -1.0).reshape(BUCKETS, DIMENSIONS)


def curve_key(ids: list[np.ndarray]) -> np.ndarray:
    """Hilbert key of each document, from its token ids."""
    bucket, directions = _projection()
    vectors = np.zeros((len(ids), BUCKETS))
    for row, own in zip(vectors, ids):
        row[:] = np.bincount(bucket.take(own, mode="wrap"), minlength=BUCKETS)
    vectors = np.sqrt(vectors)
    vectors /= np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12)
    vectors -= np.where(vectors.any(axis=1, keepdims=True), BUCKETS**-0.5, 0)
    spread = 1 / (1 + np.exp(-2 * (vectors @ directions)))
    return hilbert(np.minimum((spread * (1 << BITS)).astype(np.int64), (1 << BITS) - 1), BITS)


def _tokenise(path: str, separator: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _words(path)
    end = np.array([separator], words.kind)
    for batch in batches:
        for part in (batch.slice(at, 256) for at in range(0, batch.num_rows, 256)):
            ids = [words.text(text) for text in part.column(1).to_pylist()]
            raw = [np.concatenate([own, end]).tobytes() for own in ids]
            columns = [part.column(0), pa.array(curve_key(ids)), pa.array(raw, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "curve_key", "ids"])


def tail_lengths(n: int, length: int) -> list[int]:
    """Lengths of the sequences for ``n`` tokens: full ones, then powers of two."""
    rest = n % length
    return [length] * (n // length) + [1 << bit for bit in range(rest.bit_length() - 1, -1, -1) if rest >> bit & 1]


def _pack(kind: str, length: int, with_ids: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts a sorted range. Pieces of its last, unfinished sequence wait for the end."""
    sequence, filled, waiting = TaskContext.get().partitionId() << 36, 0, []

    def rows(pieces: list[tuple]) -> pa.RecordBatch:
        *numbers, ids = zip(*pieces)
        arrays = [pa.array(column, pa.int64()) for column in numbers]
        names = list(PIECE)
        checks = [zlib.crc32(own.astype("<u4").tobytes()) for own in ids]
        arrays.insert(names.index("ids_crc32"), pa.array(checks, pa.int64()))
        if with_ids:
            names.append("ids")
            arrays.append(pa.array([own.astype("i4") for own in ids], pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays(arrays, names)

    for batch in batches:
        done = []
        for doc, key, raw in zip(*(batch.column(name).to_pylist() for name in ("doc_id", "curve_key", "ids"))):
            ids, start = np.frombuffer(raw, kind), 0
            while start < len(ids):
                stop = min(len(ids), start + length - filled)
                waiting.append((doc, start, stop - start, len(ids), sequence, filled, key, ids[start:stop]))
                filled, start = filled + stop - start, stop
                if filled == length:
                    done += waiting
                    waiting, filled, sequence = [], 0, sequence + 1
        if done:
            yield rows(done)
    tail, room, at = [], tail_lengths(filled, length), 0
    for doc, start, _, total, _, _, key, ids in waiting:
        while len(ids):
            take = min(len(ids), room[0] - at)
            tail.append((doc, start, take, total, sequence, at, key, ids[:take]))
            ids, start, at = ids[take:], start + take, at + take
            if at == room[0]:
                room, at, sequence = room[1:], 0, sequence + 1
    if tail:
        yield rows(tail)


def pack(
    docs: DataFrame,
    path: str,
    length: int = LENGTH,
    separator: int = SEPARATOR,
    with_ids: bool = True,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Sequences of at most ``length`` tokens (a power of two), a row for each piece.

    ``path`` names a word BPE file of the tokenizers library; ``separator`` ends each
    document. A piece has ``doc_id``, ``start`` and ``length`` in its document, a
    checksum ``ids_crc32`` of its ids as little-endian 32-bit numbers, ``doc_tokens``,
    ``sequence_id``, ``offset`` in its sequence, ``curve_key`` and, if asked for, ``ids``.

    Null and empty texts are a separator only. Repeated rows, repeated or null ids are
    separate documents; documents with one key are ordered by id. An empty table gives
    an empty one. Other columns of ``docs`` aren't read, so their names can't clash.

    The tokens are written once and range-shuffled once. A hot source is no key here,
    and copies share a curve key but are split by id. Identifiers of sequences are
    unique, not consecutive.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, curve_key long, ids binary"
    encoded = materialised(rows.mapInArrow(partial(_tokenise, path, separator), schema), "packing")
    order = ["curve_key", "doc_id"]
    ranges = encoded.repartitionByRange(*order).sortWithinPartitions(*order, "ids")
    result = ", ".join(f"{name} long" for name in PIECE) + (", ids array<int>" if with_ids else "")
    return ranges.mapInArrow(partial(_pack, _words(path).kind, length, with_ids), result)
