"""Near members of signature groups, found by odd sketches.

An odd sketch of a set is a row of bits: bit ``h mod width`` is flipped for the hash
``h`` of each member. Two sketches differ in no more bits than the sets differ in
members, so a pair whose sketches differ in more than similar sets may differ is
apart for certain. The filter loses no link, whatever brought the sets together: a
phrase that many texts hold makes large groups of sets, and hardly any near pairs.

Groups of equal members are looked at once. A large group is dealt into blocks, and
every two blocks meet in a group of their own, so no task gets more than two blocks.
Sketches take a fifth to two fifths of a byte for each shingle; whole sets move only
for members that are left.
"""

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialised, mix

#: Bits of a sketch: a power of two, at least so many for each member, within these bounds.
BITS_PER_MEMBER, LEAST_BITS, MOST_BITS = 1.5, 64, 1 << 17
#: About so many members of a signature are in one block.
BLOCK = 1024
#: Rows that a task compares at once, and 64-bit words of sketches.
ROWS, WORDS = 4096, 1 << 21


def odd_sketch(shingles: np.ndarray) -> bytes:
    """The sketch of a set of hashed shingles."""
    bits = LEAST_BITS
    while bits < BITS_PER_MEMBER * len(shingles) and bits < MOST_BITS:
        bits *= 2
    times = np.bincount((mix(shingles, 11) & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((times & 1).astype(np.uint8), bitorder="little").tobytes()


class Sketches:
    """Sketches of several widths, compared at the width of the narrower one."""

    def __init__(self, raw: list[bytes]):
        self.width = np.array([len(one) // 8 for one in raw], np.int64)
        self.place = np.zeros(len(raw), np.int64)
        self.table: dict[tuple[int, int], np.ndarray] = {}
        for width in np.unique(self.width).tolist():
            rows = np.flatnonzero(self.width == width)
            self.place[rows] = np.arange(len(rows))
            self.table[width, width] = np.frombuffer(b"".join(raw[i] for i in rows), np.uint64).reshape(-1, width)

    def folded(self, width: int, to: int) -> np.ndarray:
        """The sketches of ``width``, with which narrower ones of ``to`` are compared."""
        if (width, to) not in self.table:
            wide = self.folded(width, 2 * to)
            self.table[width, to] = wide[:, :to] ^ wide[:, to:]
        return self.table[width, to]

    def distances(self, one: np.ndarray, other: np.ndarray) -> np.ndarray:
        """For each pair of rows, the least number of members that the sets differ in."""
        found = np.zeros(len(one), np.int64)
        low, wide = np.minimum(self.width[one], self.width[other]), np.maximum(self.width[one], self.width[other])
        flip = self.width[one] > self.width[other]
        narrow_row, wide_row = np.where(flip, other, one), np.where(flip, one, other)
        for key in np.unique(low * (1 << 32) + wide).tolist():
            to, width = key >> 32, key & 0xFFFFFFFF
            pairs = np.flatnonzero((low == to) & (wide == width))
            narrow, broad = self.folded(to, to), self.folded(width, to)
            step = max(WORDS // to, 1)
            for at in range(0, len(pairs), step):
                some = pairs[at : at + step]
                bits = narrow[self.place[narrow_row[some]]] ^ broad[self.place[wide_row[some]]]
                found[some] = np.bitwise_count(bits).sum(axis=1, dtype=np.int64)
        return found


def near_rows(
    threshold: tuple[int, int], group: np.ndarray, half: np.ndarray, size: np.ndarray, sketches: Sketches
) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows (i < j) of a group that may be similar; rows come by group and size.

    Where ``half`` isn't negative, only rows of different halves are compared.
    """
    part, whole = threshold
    found = []
    one, lag = np.arange(len(group)), 1
    while True:
        one = one[one + lag < len(group)]
        other = one + lag
        # Sizes only grow within a group: who is too small for this lag is for all others.
        meets = (group[one] == group[other]) & (whole * size[one] >= part * size[other])
        one, other = one[meets], other[meets]
        if not len(one):
            break
        apart = (half[one] < 0) | (half[one] != half[other])
        a, b = one[apart], other[apart]
        room = (size[a] + size[b]) * (whole - part) // (whole + part)
        near = sketches.distances(a, b) <= room
        found.append((a[near], b[near]))
        lag += 1
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(ends) for ends in zip(*found))


def spanning(rows: int, one: np.ndarray, other: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (row, an earlier row) that connect what the pairs of rows connect.

    A row leads to the first it reaches, and to the first it is near to.
    """
    own = np.arange(rows)
    near = own.copy()
    np.minimum.at(near, other, one)
    least = near.copy()
    while True:
        before = least.copy()
        np.minimum.at(least, one, before[other])
        np.minimum.at(least, other, before[one])
        least = least[least]
        if (least == before).all():
            break
    far, extra = np.flatnonzero(least < own), np.flatnonzero((near < own) & (near != least))
    return np.concatenate([far, extra]), np.concatenate([least[far], near[extra]])


def _near(threshold: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def edges(table: pa.Table) -> pa.RecordBatch:
        signature, low, high, half, size, node = (table.column(i).to_numpy() for i in range(6))
        new = (signature[1:] != signature[:-1]) | (low[1:] != low[:-1]) | (high[1:] != high[:-1])
        group = np.concatenate([[0], np.cumsum(new)])
        half = np.where(low == high, -1, half)
        pairs = near_rows(threshold, group, half, size, Sketches(table.column(6).to_pylist()))
        # A node is a row in each of its groups; only rows of one group are connected here.
        row, first = spanning(len(node), *pairs)
        return pa.RecordBatch.from_arrays([pa.array(node[row]), pa.array(node[first])], ["node", "first"])

    kept: list[pa.Table] = []
    rows = 0
    for batch in batches:
        kept.append(pa.Table.from_batches([batch]))
        rows += batch.num_rows
        if rows < ROWS:
            continue
        table = pa.concat_tables(kept)
        keys = [table.column(i).to_numpy() for i in range(3)]
        last = np.flatnonzero(np.logical_or.reduce([key != key[-1] for key in keys]))
        cut = int(last[-1]) + 1 if len(last) else 0
        kept, rows = [table.slice(cut)], table.num_rows - cut
        if cut:
            yield edges(table.slice(0, cut).combine_chunks())
    if rows:
        yield edges(pa.concat_tables(kept).combine_chunks())


def near_members(shared: DataFrame, nodes: DataFrame, threshold: tuple[int, int], label: str) -> DataFrame:
    """Edges (node, first) that connect all pairs of nodes that may be similar.

    ``shared`` holds distinct rows (signature, node) of signatures that several nodes
    have, ``nodes`` has a row (node, size, sketch) for each of them. Whoever shares a
    signature is compared, but for pairs that sizes or sketches show to be apart.
    """
    lists = shared.groupBy("signature").agg(
        F.count("*").alias("members"),
        F.bit_xor(F.xxhash64("node")).alias("one"),
        F.bit_xor(F.xxhash64("node", F.lit(1))).alias("other"),
    )
    once = lists.groupBy("members", "one", "other").agg(F.min("signature").alias("signature"))
    once = materialised(once.select("signature", F.ceil(F.col("members") / BLOCK).cast("int").alias("blocks")), f"{label}-once")
    rows = shared.join(once, "signature").withColumn("half", F.pmod(F.xxhash64("node", F.lit(2)), "blocks").cast("int"))
    rows = rows.withColumn("meets", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "signature", F.least("half", "meets").alias("low"), F.greatest("half", "meets").alias("high"), "half", "node"
    )
    key = ["signature", "low", "high"]
    rows = rows.join(nodes, "node").select(*key, "half", "size", "node", "sketch")
    dealt = rows.repartition(*key).sortWithinPartitions(*key, "size", "node")
    return dealt.mapInArrow(partial(_near, threshold), "node long, first long")
