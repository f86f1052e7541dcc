"""Alignment of the tokens of two tokenizers over the same bytes.

Both tokenizers cut a text's bytes into tokens. Where tokens of both end at the same
byte the text is cut into groups, and two tokens are linked if their bytes overlap. The
ends are two sorted lists: each end of the shorter one is looked for in the longer one by
galloping, in steps that double from the place of the one before and a binary search in
the last step. Ends found in both slice the groups, and the ranks of two ends in a row
are the range of tokens that the one between them overlaps.

Neither tokenizer joins what a single space parts from the word before it, so a text is
cut into units there; each distinct unit is encoded and aligned once while a task
remembers it, and a text's alignment is that of its units, one after another. How many
documents link a pair of ids is counted once for each document and chunk of documents,
summed by pair, and sent back to the chunks that asked: what travels is a row for each
pair and chunk, not for each token, and a frequent pair is no hot key.
"""

import hashlib
import json
import re
from bisect import bisect_left
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised
from .tokens import SPACE, Distinct, PieceTable

#: Bytes of text after which a chunk ends with the document.
CHUNK_BYTES = 8 << 20
#: Distinct units that a task remembers, twice.
REMEMBERED = 120_000
#: Before a single space between characters that no tokenizer's white space includes.
_INK = "[^\\s\x1c-\x1f\x85]"
CLEAN_CUT = re.compile(f"(?<={_INK})(?= {_INK})")
SIZE = (1 << 31) - 1
#: A unit that such spaces are on both sides of, also when others stand before and after it.
PLAIN = re.compile(f" {_INK}(?:.*{_INK})?", re.DOTALL)
#: Distinct units that are encoded and aligned in a row.
TOGETHER = 512

CHUNK = (
    "chunk long, doc_id array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, "
    "groups_sha256 array<string>, stops array<long>, places binary, times binary, pairs array<long>, counts array<long>"
)
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def gallop(short: list[int], long: list[int]) -> list[int]:
    """For each of ``short``, how many of ``long`` are smaller; both are sorted."""
    ranks, low, size = [], 0, len(long)
    for value in short:
        if low < size and long[low] < value:
            low += 1
            step, high = 1, low
            while high < size and long[high] < value:
                low, high, step = high + 1, high + step, step * 2
            if low < high:
                low = bisect_left(long, value, low, min(high, size))
        ranks.append(low)
    return ranks


def overlaps(ends_a: list[int], ends_b: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Groups and links of two lists of token ends that close with the same byte.

    A group is how many tokens of A and of B were used up at its end; a link is the places
    of two tokens that overlap, by the place in the shorter list.
    """
    flip = len(ends_a) > len(ends_b)
    short, long = (ends_b, ends_a) if flip else (ends_a, ends_b)
    ranks, places = np.array(gallop(short, long), np.int64), np.arange(len(short))
    common = np.array(long, np.int64)[ranks] == np.array(short, np.int64)
    first = np.append(0, ranks + common)[:-1]
    each = ranks - first + 1
    others = np.arange(each.sum()) + np.repeat(first - np.cumsum(each) + each, each)
    group, link = (places[common] + 1, ranks[common] + 1), (np.repeat(places, each), others)
    return (*group[::-1], *link[::-1]) if flip else (*group, *link)


def align(ends_a: list[int], ends_b: list[int]) -> tuple[list[tuple[int, int]], list[tuple[int, int]]]:
    """Groups and links as pairs."""
    group_a, group_b, link_a, link_b = (own.tolist() for own in overlaps(ends_a, ends_b))
    return list(zip(group_a, group_b)), list(zip(link_a, link_b))


def byte_level_bytes() -> dict[str, int]:
    """The byte of each letter of byte-level vocabularies.

    Fixed values of that format: printable Latin-1 characters stand for themselves, the
    other bytes in order for the characters from 256 on.
    """
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [byte for byte in range(256) if byte not in printable]
    return {chr(byte): byte for byte in printable} | {chr(256 + n): byte for n, byte in enumerate(rest)}


class Aligner:
    """Aligns texts by a byte-level ``.json`` of the tokenizers library and a ``.model``."""

    def __init__(self, path_a: str, path_b: str):
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True  # their strings in a text are text
        letters = byte_level_bytes()
        special = self.a.get_added_tokens_decoder()
        size = 1 + max(self.a.get_vocab(with_added_tokens=True).values())
        self.bytes_a = [b""] * size
        for token, number in self.a.get_vocab(with_added_tokens=True).items():
            plain = number not in special and all(letter in letters for letter in token)
            self.bytes_a[number] = bytes(map(letters.__getitem__, token)) if plain else token.encode()
        with open(path_a, encoding="utf-8") as file:
            cut = json.load(file).get("pre_tokenizer") or {}
        self.b = PieceTable(path_b)
        self.bytes_b = []
        for number in range(self.b.processor.get_piece_size()):
            piece = self.b.processor.id_to_piece(number)
            raw = bytes([int(piece[3:5], 16)]) if self.b.processor.is_byte(number) else piece.replace(SPACE, " ").encode()
            self.bytes_b.append(raw)
        self.units = self.b.cuts and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
        self.units = self.units and self.a.normalizer is None
        # Ids as text, with what may follow them: inside a side of a group (A, B), and after it (A, B).
        self.shown = np.array(
            [f"{number}{sign}" for signs in (",,", "|;") for own, sign in zip((self.bytes_a, self.bytes_b), signs) for number in range(len(own))],
            object,
        )
        self.lengths_a, self.lengths_b = (np.array([len(one) for one in own]) for own in (self.bytes_a, self.bytes_b))
        self.known = Distinct(self.records, REMEMBERED)

    def encode(self, texts: list[str]) -> Iterator[tuple[str, list[int], list[int]]]:
        """Ids of both tokenizers for each text, which starts with the space before it."""
        of_a = self.a.encode_batch_fast(texts, add_special_tokens=False)
        # A model whose words can't be cut adds the space by itself.
        of_b = self.b.all_ids(texts if self.b.prefix else [text[1:] for text in texts])
        return zip(texts, (one.ids for one in of_a), of_b)

    def records(self, units: list[str]) -> list[tuple | None]:
        """For each unit: tokens of A and B as one number, packed id pairs of its links, its groups as text, each with a `;`.

        Units that a clean space would part from each other are aligned many in a row,
        and their records are cut out where they end.
        """
        plain = [unit for unit in units if PLAIN.fullmatch(unit)] if self.units else []
        blocks = [plain[at : at + TOGETHER] for at in range(0, len(plain), TOGETHER)]
        found = {}
        for block, (text, a, b) in zip(blocks, self.encode(["".join(block) for block in blocks])):
            found.update(zip(block, self.cut(block, text.encode(), a, b) or ()))
        others = [unit for unit in units if unit not in found]
        for unit, a, b in self.encode(others):
            (found[unit],) = self.cut([unit], unit.encode(), a, b) or [None]
        return [found[unit] for unit in units]

    def cut(self, units: list[str], raw: bytes, a: list[int], b: list[int]) -> list[tuple] | None:
        """Records of ``units``, whose bytes are ``raw``; None if the tokens don't spell them."""
        spelled = (b"".join([own[number] for number in ids]) for own, ids in ((self.bytes_a, a), (self.bytes_b, b)))
        if any(one != raw for one in spelled):
            return None
        ids_a, ids_b = np.array(a, np.int64), np.array(b, np.int64)
        ends_a, ends_b = np.cumsum(self.lengths_a[ids_a]), np.cumsum(self.lengths_b[ids_b])
        group_a, group_b, link_a, link_b = overlaps(ends_a.tolist(), ends_b.tolist())
        stops = np.cumsum([len(unit.encode()) for unit in units])
        stop_a, stop_b = (np.searchsorted(ends, stops) + 1 for ends in (ends_a, ends_b))
        codes, stop_link = (ids_a[link_a] << 32 | ids_b[link_b]).tobytes(), 8 * np.searchsorted(link_a, stop_a)
        # The ids of a group's A stand before those of its B, and both behind the groups before.
        size_a, size_b = np.diff(group_a, prepend=0), np.diff(group_b, prepend=0)
        own_a, own_b = ids_a.copy(), ids_b + len(self.bytes_a)
        own_a[group_a - 1] += len(self.shown) // 2
        own_b[group_b - 1] += len(self.shown) // 2
        order = np.empty(len(a) + len(b), np.int64)
        order[np.arange(len(a)) + np.repeat(group_b - size_b, size_a)] = own_a
        order[np.arange(len(b)) + np.repeat(group_a, size_b)] = own_b
        shown, stop_shown = self.shown[order].tolist(), (stop_a + stop_b).tolist()
        sizes = np.diff(stop_a, prepend=0) | np.diff(stop_b, prepend=0) << 31
        records, l0, s0 = [], 0, 0
        for size, l1, s1 in zip(sizes.tolist(), stop_link.tolist(), stop_shown):
            records.append((size, codes[l0:l1], "".join(shown[s0:s1])))
            l0, s0 = l1, s1
        return records

    def split(self, text: str | None) -> list[str]:
        """The units of a text, each with the space before it."""
        if not text:
            return []
        if not self.units:
            return [" " + text]
        parts = text.split(" ")
        if "" not in parts and list(map(str.strip, parts)) == parts:
            return [" " + part for part in parts]  # every space is clean
        return CLEAN_CUT.split(" " + text)

    def align_all(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, np.ndarray, str]]:
        """For each text: tokens of A, of B, groups, id pairs of its links, groups as text."""
        split = [self.split(text) for text in texts]
        known = self.known.table(chain.from_iterable(split))
        for units in split:
            own = [known[unit] for unit in units]
            if not own or None in own:
                yield 0, 0, 0, np.zeros(0, np.int64), ""
                continue
            sizes = sum([one[0] for one in own])  # neither part overflows: a text has less than 2 GB
            codes, shown = b"".join([one[1] for one in own]), "".join([one[2] for one in own])
            yield sizes & SIZE, sizes >> 31, shown.count("|"), np.frombuffer(codes, np.int64), shown[:-1]


@lru_cache(maxsize=2)
def _aligner(path_a: str, path_b: str) -> Aligner:
    return Aligner(path_a, path_b)


class _Chunk:
    """Documents of one task until they are many bytes, and the distinct id pairs of each."""

    def __init__(self):
        self.bytes, self.rows, self.pairs, self.times, self.stop = 0, [], [], [], 0

    def add(self, doc_id: int | None, size: int, aligned: tuple) -> None:
        n_a, n_b, n_groups, codes, shown = aligned
        pairs, times = np.unique(codes, return_counts=True)
        self.stop += len(pairs)
        sha = hashlib.sha256(shown.encode()).hexdigest() if n_a else ""
        self.rows.append((doc_id, n_a, n_b, n_groups, len(codes), sha, self.stop))
        self.pairs.append(pairs)
        self.times.append(times.astype(np.uint32))
        self.bytes += size

    def batch(self, number: int) -> pa.RecordBatch:
        pairs, places, counts = np.unique(np.concatenate(self.pairs), return_inverse=True, return_counts=True)
        columns = [[number], *([list(column)] for column in zip(*self.rows))]
        columns += [[places.astype(np.uint32).tobytes()], [np.concatenate(self.times).tobytes()], [pairs], [counts]]
        kinds = [pa.int64(), *[pa.list_(pa.int64())] * 5, pa.list_(pa.string()), pa.list_(pa.int64())]
        kinds += [pa.binary(), pa.binary(), pa.list_(pa.int64()), pa.list_(pa.int64())]
        names = [part.split()[0] for part in CHUNK.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)


def _chunks(path_a: str, path_b: str, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner, chunk = _aligner(path_a, path_b), _Chunk()
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            ids, texts = (batch.column(i).slice(at, 256).to_pylist() for i in (0, 1))
            for doc_id, text, aligned in zip(ids, texts, aligner.align_all(texts)):
                chunk.add(doc_id, len(text or ""), aligned)
                if chunk.bytes >= limit:
                    yield chunk.batch(number)
                    number, chunk = number + 1, _Chunk()
    if chunk.rows:
        yield chunk.batch(number)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in range(batch.num_rows):
            part = batch.slice(row, 1)
            one = {name: part.column(i) for i, name in enumerate(part.schema.names)}
            places = np.frombuffer(one["places"][0].as_py(), np.uint32)
            times = np.frombuffer(one["times"][0].as_py(), np.uint32).astype(np.int64)
            stops = one["stops"].flatten().to_numpy()
            known = one["known"].flatten()
            count, best = known.field("count").to_numpy(), known.field("best").to_numpy(zero_copy_only=False)

            def by_document(values: np.ndarray) -> pa.Array:
                totals = np.concatenate([[0], np.cumsum(values)])[np.concatenate([[0], stops])]
                return pa.array(np.diff(totals), pa.int64())

            sums = [by_document(times * best[places]), by_document(times * count[places])]
            columns = [one[name].flatten() for name in NAMES[:5]] + sums + [one["groups_sha256"].flatten()]
            yield pa.RecordBatch.from_arrays(columns, NAMES)


def pair_counts(chunks: DataFrame) -> DataFrame:
    """(pair, a, b, count, best): documents that hold the two ids linked, and whether that
    is the highest count of the id of A."""
    each = chunks.select(F.explode(F.arrays_zip("pairs", "counts")).alias("one"))
    counts = each.groupBy(F.col("one.pairs").alias("pair")).agg(F.sum("one.counts").alias("count"))
    counts = counts.withColumns({"a": F.shiftright("pair", 32), "b": F.col("pair").bitwiseAND(0xFFFFFFFF)})
    counts = materialised(counts, "alignment-counts")
    most = counts.groupBy("a").agg(F.max("count").alias("most"))  # a row for each id of the vocabulary
    return counts.join(most, "a").select("pair", "a", "b", "count", (F.col("count") == F.col("most")).alias("best"))


def align_documents(
    docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES
) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row.

    A encodes a space and the text, B the text, to which it adds the space; no special
    tokens are added, and their strings in a text are text. ``n_groups`` counts the bytes
    where tokens of both end, ``n_links`` the pairs of tokens that overlap. A pair of ids
    counts in each document that holds it linked; ``count_sum`` sums the counts of a
    document's links, ``n_best`` counts the links whose count is the highest of their id
    of A, ties included. ``groups_sha256`` is of the groups' ids, ``a1,a2|b1;a3|b2,b3``.

    Null and empty texts, and texts whose tokens of A or B don't spell the space and the
    text, have no tokens: zeros and an empty string. Repeated rows and ids are documents
    of their own, a null id is carried along. An empty table gives an empty one. Other
    columns aren't read, so their names can't clash.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    chunks = materialised(rows.mapInArrow(partial(_chunks, path_a, path_b, chunk_bytes), CHUNK), "alignment-chunks")
    known = pair_counts(chunks)
    asked = chunks.select("chunk", F.posexplode("pairs").alias("place", "pair"))
    answers = asked.join(known.select("pair", "count", "best"), "pair")
    # A chunk's distinct pairs: bounded by its bytes.
    one = F.struct("place", "count", "best")
    answers = answers.groupBy(F.col("chunk").alias("of")).agg(F.sort_array(F.collect_list(one)).alias("known"))
    whole = chunks.drop("pairs", "counts").join(answers, F.col("chunk") == F.col("of"), "left").drop("of")
    schema = ", ".join(f"{name} {'string' if name == 'groups_sha256' else 'long'}" for name in NAMES)
    return whole.mapInArrow(_sums, schema)


def _groups(path_a: str, path_b: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    aligner = _aligner(path_a, path_b)
    kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            texts = batch.column(1).slice(at, 256).to_pylist()
            rows = []
            for *_, shown in aligner.align_all(texts):
                sides = (group.split("|") for group in shown.split(";")) if shown else ()
                rows.append([dict(zip("ab", (list(map(int, side.split(","))) for side in two))) for two in sides])
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, 256), pa.array(rows, kind)], ["doc_id", "groups"])


def token_groups(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, groups): the ids of both tokenizers between two common ends, in order.

    Odd rows are as for ``align_documents``: without tokens there are no groups.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, groups array<struct<a: array<int>, b: array<int>>>"
    return rows.mapInArrow(partial(_groups, path_a, path_b), schema)
