"""Exact Jaccard self-join of word shingles by universe partition.

Two sets that are similar enough differ in few shingles, at most ``distance`` of them.
Hashing deals the universe of shingles into segments. If two sets differ in no more than
``distance`` places, then by the pigeonhole principle some segment is the same in both,
or differs by a single shingle where it is indexed with its one-deletion neighbourhood:
a plain segment can absorb no difference, a neighbourhood absorbs one. A band of set
sizes has one ``Scheme``: how many segments, and which of them get neighbourhoods, is
the choice of the lowest cost that still covers the largest distance in the band.

Sets that share a signature are candidates, unless their sizes or odd sketches show that
they differ in too many shingles. Equal sets are one node from the start. What the
candidates connect is a family. Each member is first verified on whole sets against one
other, and linked ones are contracted. Families that are still in several parts are then
verified whole, in blocks of bounded size: two blocks are one matrix product, and what
leaves it is a spanning forest of the links. So no link between different sets is lost,
copies and near copies cost their number, and pairs are never listed.
"""

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from math import comb, exp

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import KeyFilter, Remembered, discard, materialised, mix, release
from .sketches import near_members, odd_sketch

SHINGLE = 3
THRESHOLD = (90, 100)
#: Ratio of the largest to the smallest size in a band.
BAND = 1.25
#: Signatures of fewer shingles are weak: unrelated sets share them by chance.
STRONG = 3
#: Where the threshold leaves a segment fewer shingles than this, two are strong already:
#: with three, large sets could never spare their weak signatures.
DENSE = 6
#: Cost of a weak segment, in signatures.
WEAK_COST = 1000.0
#: Bound on the share of sets that must also use their weak signatures.
RARE = 1e-4
MOST_NEIGHBOURHOODS = 12
#: A block of a family has about so many shingles and members at the most.
BLOCK_SHINGLES, BLOCK_MEMBERS = 1 << 18, 512
#: Shingles in the dense part of a block's matrix.
SLICE = 4096


@dataclass(frozen=True)
class Scheme:
    """``segments`` of the universe; the last ``neighbourhoods`` of them are indexed with
    their one-deletions. ``slack`` of the differences they absorb aren't needed."""

    band: int
    segments: int
    neighbourhoods: int
    slack: int


def _below(size: float, segments: int, count: int) -> float:
    """Chance that a segment gets fewer than ``count`` of ``size`` shingles."""
    n, p = round(size), 1 / segments
    return sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(min(count, n + 1)))


def _spare(segments: int, weak: float) -> int:
    """So many segments or more are weak in hardly any set."""
    mean, spare, term = segments * weak, 0, exp(-segments * weak)
    rest = 1 - term
    while rest > RARE and spare < segments:
        spare += 1
        term *= mean / spare
        rest -= term
    return spare


class Schemes:
    """The schemes of a similarity threshold, and the bands a set takes part in."""

    def __init__(self, threshold: tuple[int, int] = THRESHOLD):
        self.part, self.whole = threshold
        self.uppers = [1]
        room = (self.whole + self.part) / (2 * max(self.whole - self.part, 1))
        self.strong = STRONG if room >= DENSE else STRONG - 1

    def upper(self, band: int) -> int:
        """Largest size in the band."""
        while len(self.uppers) <= band:
            last = self.uppers[-1]
            self.uppers.append(max(last + 1, int(last * BAND)))
        return self.uppers[band]

    def bands(self, size: int) -> list[int]:
        """The set's own band, and the next if a set of that band may be similar to it."""
        band = 0
        while self.upper(band) < size:
            band += 1
        return [band, band + 1] if size * self.whole // self.part > self.upper(band) else [band]

    def distance(self, total: int) -> int:
        """Most differences of two similar sets with ``total`` shingles together."""
        return total * (self.whole - self.part) // (self.whole + self.part)

    @lru_cache(maxsize=None)
    def scheme(self, band: int) -> Scheme:
        """The cheapest allocation that covers the band's largest distance.

        Every difference uses up one plain segment or half a neighbourhood, so segments
        and neighbourhoods together must outnumber the differences. They outnumber them
        by ``slack`` more, so that sets can leave out that many weak segments.
        """
        upper = self.upper(band)
        lower = (self.upper(band - 1) if band else 0) + 1
        size, needed = (lower + upper) / 2 if self.strong == STRONG else lower, self.distance(2 * upper) + 1
        options = []
        for neighbourhoods in range(min(needed, MOST_NEIGHBOURHOODS) + 1):
            slack = 0
            while slack <= needed // 2 + 8:
                segments = max(1, needed + slack - neighbourhoods, neighbourhoods)
                weak = _below(size, segments, self.strong)
                spare = _spare(segments, weak)
                unmet = 0 if spare <= slack else segments * weak
                cost = segments + neighbourhoods * size / segments + WEAK_COST * unmet
                options.append((cost, Scheme(band, segments, neighbourhoods, segments + neighbourhoods - needed)))
                if spare <= slack:
                    break
                slack += 1 if needed < 64 else spare - slack
        return min(options, key=lambda option: option[0])[1]

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """64-bit signatures of a set of hashed shingles, for all its bands."""
        return np.unique(np.concatenate(self.by_band(shingles)))

    def by_band(self, shingles: np.ndarray) -> list[np.ndarray]:
        """The signatures for the set's own band, and those for the next if it takes part.

        Two sets of one band meet in it, so of those that share a signature one at least
        has the signature's band for its own.

        A signature hashes scheme, segment and the sum of its shingles' hashes, so a
        deletion is a subtraction. Weak signatures are left out if what is left still
        outnumbers the differences. That loses no pair: if one of two similar sets can
        do without its weak signatures, then the two share a strong one.
        """
        found = []
        for band in self.bands(len(shingles)):
            scheme = self.scheme(band)
            place = (mix(shingles, 3) % np.uint64(scheme.segments)).astype(np.int64)
            order = np.argsort(place, kind="stable")
            place, value = place[order], mix(shingles[order], 4)
            count = np.bincount(place, minlength=scheme.segments)
            sums = np.zeros(scheme.segments, np.uint64)
            filled = np.flatnonzero(count)
            starts = np.cumsum(count) - count
            sums[filled] = np.add.reduceat(value, starts[filled])
            first = scheme.segments - scheme.neighbourhoods
            dropped = int((count[:first] < self.strong).sum() + 2 * (count[first:] <= self.strong).sum())
            least = self.strong if dropped <= scheme.slack else 0
            segment = np.arange(scheme.segments)
            keep = count >= least
            plain = self._hash(scheme, segment[keep], sums[keep])
            inside = (place >= first) & (count[place] - 1 >= least)
            deleted = self._hash(scheme, place[inside], sums[place[inside]] - value[inside])
            found.append(np.unique(np.concatenate([plain, deleted])))
        return found

    @staticmethod
    def _hash(scheme: Scheme, segment: np.ndarray, sums: np.ndarray) -> np.ndarray:
        return mix(sums ^ mix(segment + (scheme.band << 40), 5), 6)


def _word(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shingle_set(text: str | None, words: Remembered, shingle: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text, so many words each, A-Z in lower case."""
    own = (text or "").encode().lower().split()  # white space of bytes: \\x20 and \\x09-\\x0D
    if not own:
        return np.zeros(0, np.uint64)
    hashes = np.fromiter(words.all(own), np.uint64, len(own))
    width = min(shingle, len(own))
    total = mix(np.full(len(own) - width + 1, width), 7)
    for k in range(width):
        total = mix(total ^ hashes[k : len(own) - width + 1 + k], 8)
    return np.unique(total)


def fingerprint(shingles: np.ndarray) -> int:
    """Hash of a set, as a signed 64-bit number; 0 for the empty one."""
    return int(mix(shingles, 9).sum(dtype=np.uint64).view(np.int64)) if len(shingles) else 0


def _index(signer: Callable, shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size, fingerprint, sketch and signatures of each document, the last two once for each set."""
    signatures, words, seen = signer(), Remembered(_word), set()
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            sizes, prints, sketches, found = [], [], [], []
            for text in part.column(2).to_pylist():
                shingles = shingle_set(text, words, shingle)
                sizes.append(len(shingles))
                prints.append(fingerprint(shingles))
                new = len(shingles) and prints[-1] not in seen
                sketches.append(odd_sketch(shingles) if new else None)
                found.append(signatures(shingles).view(np.int64) if new else None)
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(prints[-1])
            columns = [part.column(0), part.column(1), pa.array(sizes, pa.int64()), pa.array(prints, pa.int64())]
            columns += [pa.array(sketches, pa.binary()), pa.array(found, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n_shingles", "node", "sketch", "found"])


def _sets(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sets of the nodes' texts; a text that has another set under the same id is left out."""
    words = Remembered(_word)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            nodes, texts = (batch.column(i).slice(at, 256).to_pylist() for i in (0, 1))
            sets = [(node, shingle_set(text, words, shingle)) for node, text in zip(nodes, texts)]
            sets = [(node, own.tobytes()) for node, own in sets if fingerprint(own) == node]
            columns = [pa.array([node for node, _ in sets], pa.int64()), pa.array([own for _, own in sets], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["node", "shingles"])


def _verify(threshold: tuple[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    part, whole = threshold
    for batch in batches:
        keep = []
        for row, (one, other) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
            a, b = np.frombuffer(one, np.uint64), np.frombuffer(other, np.uint64)
            both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
            if whole * both >= part * (len(a) + len(b) - both):
                keep.append(row)
        yield pa.RecordBatch.from_arrays(batch.columns[:2], ["a", "b"]).take(pa.array(keep, pa.int64()))


def similar_pairs(pairs: DataFrame, sets: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Those of ``pairs`` (a, b) of nodes whose sets are similar."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("shingles").alias("other"))
    both = pairs.join(one, "a").join(other, "b").select("a", "b", "one", "other")
    return both.mapInArrow(partial(_verify, threshold), "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all pairs of sets."""
    row = np.repeat(np.arange(len(sets)), [len(own) for own in sets])
    _, column, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    # Only shingles that two sets have matter, and a slice of them at a time is dense.
    number = np.cumsum(times > 1) - 1
    shared = times[column] > 1
    row, column = row[shared], number[column[shared]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    found = np.zeros((len(sets), len(sets)), np.float32)
    for start in range(0, int(column[-1]) + 1 if len(column) else 0, SLICE):
        own = slice(*np.searchsorted(column, (start, start + SLICE)))
        dense = np.zeros((len(sets), SLICE), np.float32)
        dense[row[own], column[own] - start] = 1
        found += dense @ dense.T
    return found.astype(np.int64)


def _blocks(threshold: tuple[int, int], key: tuple, table: pa.Table) -> pa.Table:
    """For two blocks of a family: (node, a smaller node that links lead to)."""
    part, whole = threshold
    nodes = np.array(table.column("node").to_pylist())
    order = np.argsort(nodes)
    raw = table.column("shingles").to_pylist()
    sets = [np.frombuffer(raw[i], np.uint64) for i in order]
    nodes, size = nodes[order], np.array([len(own) for own in sets])
    both = overlaps(sets)
    linked = whole * both >= part * (size[:, None] + size[None, :] - both)
    least = np.arange(len(nodes))
    while True:
        near = np.where(linked, least[None, :], len(nodes)).min(axis=1)
        near = np.minimum(least, near)
        near = near[near]
        if (near == least).all():
            break
        least = near
    moved = least < np.arange(len(nodes))
    return pa.table({"a": pa.array(nodes[moved], pa.int64()), "b": pa.array(nodes[least[moved]], pa.int64())})


def apart_in_families(members: DataFrame, sets: DataFrame, threshold: tuple[int, int] = THRESHOLD) -> DataFrame:
    """Links (a, b) among ``members`` (node, size, family, root), but within a root.

    A family is dealt into blocks of bounded size: a large root has blocks of its own, the
    others share theirs. Every two blocks that may hold a link between two roots meet in a
    group of their own. Sums by family and root are combined before they are shuffled.
    """
    weight = F.col("size") + BLOCK_SHINGLES // BLOCK_MEMBERS
    weights = materialised(members.groupBy("family", "root").agg(F.sum(weight).alias("weight")), "jaccard-weights")
    large = F.col("weight") >= BLOCK_SHINGLES
    rest = weights.where(~large).groupBy("family").agg(F.sum("weight").alias("rest"))
    room = F.when(large, F.col("weight")).otherwise(F.col("rest")) / BLOCK_SHINGLES
    plan = weights.join(rest, "family", "left").select("family", "root", large.alias("large"), F.ceil(room).alias("blocks"))
    number = F.pmod(F.xxhash64(F.when(F.col("large"), F.col("node")).otherwise(F.col("root"))), "blocks")
    block = F.xxhash64(F.when(F.col("large"), F.col("root")), number)
    dealt = members.join(plan, ["family", "root"]).withColumn("block", block)
    dealt = materialised(dealt.select("family", "root", "size", "node", "block"), "jaccard-blocks")
    ends = dealt.groupBy("family", "block").agg(
        *(f(name).alias(f"{f.__name__}_{name}") for f in (F.min, F.max) for name in ("root", "size"))
    )
    ends = materialised(ends, "jaccard-ends")
    one = ends.select("family", *(F.col(name).alias(f"{name}_1") for name in ends.columns[1:]))
    other = ends.select("family", *(F.col(name).alias(f"{name}_2") for name in ends.columns[1:]))
    part, whole = threshold
    one_root = "min_root_1 = max_root_2 and max_root_1 = min_root_2"
    sizes = f"{part} * min_size_1 <= {whole} * max_size_2 and {part} * min_size_2 <= {whole} * max_size_1"
    pairs = one.join(other, "family").where(f"block_1 <= block_2 and not ({one_root}) and {sizes}")
    pairs = pairs.select("family", "block_1", "block_2", F.explode(F.array_distinct(F.array("block_1", "block_2"))).alias("block"))
    met = pairs.join(dealt.select("family", "block", "node"), ["family", "block"]).join(sets, "node")
    groups = met.select("family", "block_1", "block_2", "node", "shingles").groupBy("family", "block_1", "block_2")
    return groups.applyInArrow(lambda key, table: _blocks(threshold, key, table), "a long, b long")


def components(links: DataFrame, label: str) -> DataFrame:
    """(node, root) for the nodes of ``links`` (a, b); the root is the smallest node reached.

    Each round a node takes the smallest root among its neighbours and then that of
    its root, so that chains shorten by half or more. Nothing is collected but a count.
    """
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    both = materialised(both.where("a <> b").distinct(), f"{label}-links")
    roots = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("least"))
    roots = materialised(roots.select("node", F.least("node", "least").alias("root")), f"{label}-roots")
    while True:
        of = roots.select(F.col("node").alias("b"), F.col("root").alias("least"))
        near = both.join(of, "b").groupBy(F.col("a").alias("node")).agg(F.min("least").alias("least"))
        step = roots.join(near, "node").select("node", "root", F.least("root", "least").alias("next"))
        up = roots.select(F.col("node").alias("next"), F.col("root").alias("above"))
        step = step.join(up, "next").select("node", "root", F.least("next", "above").alias("next"))
        step = materialised(step, f"{label}-roots")
        changed = step.where("root <> next").limit(1).count()
        roots = step.select("node", F.col("next").alias("root"))
        if not changed:
            return roots


def jaccard_components(
    docs: DataFrame,
    threshold: tuple[int, int] = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of ``docs``.

    Words are cut at ASCII white space, A-Z in lower case; a set holds the distinct
    shingles of ``shingle`` words, or the whole sequence of fewer words. Two documents link
    if intersection and union of their sets are at least as ``threshold``, (part, whole).
    ``component_id`` is the smallest id that links lead to, the document's own included.

    Null texts and texts without words have no shingles, link with nothing and are
    their own component. Repeated rows and repeated ids are separate documents. A row
    with a null id links like any other, but names no component: that has a null id if
    all its rows do. An empty table gives an empty one. Other columns aren't read, so
    their names can't clash. Sets are compared by 64-bit hashes of their shingles.
    """
    return keyed_components(docs, threshold, doc_id, text, shingle).drop("key", "root")


def keyed_components(
    docs: DataFrame,
    threshold: tuple[int, int] = THRESHOLD,
    doc_id: str = "doc_id",
    text: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """``jaccard_components`` with ``key``, the hash of a row's text, and ``root``.

    All rows of a component have one root, and no other component has it, also where ids
    are null or repeated.
    """
    return components_by(partial(_signer, threshold), docs, threshold, doc_id, text, shingle, "jaccard")


def _signer(threshold: tuple[int, int]) -> Callable[[np.ndarray], np.ndarray]:
    return Schemes(threshold).signatures


def components_by(
    signer: Callable[[], Callable[[np.ndarray], np.ndarray]],
    docs: DataFrame,
    threshold: tuple[int, int],
    doc_id: str,
    text: str,
    shingle: int,
    label: str,
) -> DataFrame:
    """``keyed_components`` with candidates that share a signature of any kind.

    ``signer()`` is called once in a task and gives the function from a set of hashed
    shingles to its signatures.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    rows = rows.withColumn("key", F.xxhash64("text"))
    schema = "doc_id long, key long, n_shingles long, node long, sketch binary, found array<long>"
    full = materialised(rows.select("doc_id", "key", "text").mapInArrow(partial(_index, signer, shingle), schema), label)
    indexed = materialised(full.select("doc_id", "key", "n_shingles", "node"), f"{label}-documents")
    spread = full.where("found is not null").select(F.explode("found").alias("signature"), "node")
    shared = shared_signatures(spread, label)
    sketched = full.where("sketch is not null").select("node", F.col("n_shingles").alias("size"), "sketch")
    wanted = shared.select("node").distinct()
    nodes = materialised(sketched.join(wanted, "node").dropDuplicates(["node"]), f"{label}-nodes")
    discard(full)
    release(docs.sparkSession)
    roots = linked(indexed, rows, shared, nodes, threshold, shingle, label)
    return name_components(indexed, roots, label)


def shared_signatures(spread: DataFrame, label: str) -> DataFrame:
    """Distinct rows (signature, node) of the signatures that several nodes have."""
    spread = spread.repartition("signature")
    ends = spread.groupBy("signature").agg(F.min("node").alias("least"), F.max("node").alias("most"))
    several = ends.where("least < most").select("signature")
    return materialised(spread.join(several, "signature").distinct(), f"{label}-shared")


def linked(
    indexed: DataFrame,
    rows: DataFrame,
    shared: DataFrame,
    nodes: DataFrame,
    threshold: tuple[int, int],
    shingle: int,
    label: str,
) -> DataFrame:
    """(node, root) of the nodes that have links: verified ones, between all that share a signature.

    ``indexed`` (doc_id, key, node) and ``rows`` (doc_id, key, text) are the documents,
    ``shared`` the members of signatures, ``nodes`` (node, size, sketch) theirs.
    """
    near = near_members(shared, nodes, threshold, label)
    stars = materialised(near.groupBy("node", "first").agg(F.count("*").alias("times")), f"{label}-stars")

    # The sets of nodes that are near to others: of one text for each.
    wanted = stars.select("node").union(stars.select("first")).distinct()
    one = F.min(F.struct("key", "doc_id")).alias("one")
    chosen = indexed.join(wanted, "node").groupBy("node").agg(one).select("node", "one.*")
    chosen = materialised(chosen.withColumnRenamed("doc_id", "id"), f"{label}-chosen")
    # Most texts are no one's: a filter of fixed size keeps them out of the shuffle.
    near_rows = rows.where(KeyFilter(chosen, "key").passes(F.col("key")))
    same = (near_rows.key == chosen.key) & near_rows.doc_id.eqNullSafe(chosen.id)
    texts = near_rows.join(chosen, same).select("node", "text")
    texts = texts.groupBy("node").agg(F.first("text").alias("text"))
    sets = materialised(texts.mapInArrow(partial(_sets, shingle), "node long, shingles binary"), f"{label}-sets")

    # A family is what candidates connect. Its members lead to the one they meet most often.
    families = components(stars.select(F.col("first").alias("a"), F.col("node").alias("b")), f"{label}-families")
    often = F.max_by("first", F.struct("times", -F.col("first"))).alias("a")
    leading = stars.groupBy(F.col("node").alias("b")).agg(often).select("a", "b")

    # Round one: each member against the one it is near to in most signatures.
    links = materialised(similar_pairs(leading, sets, threshold), f"{label}-links")
    roots = components(links, f"{label}-first")

    # Round two: what is still apart in a family, each with all others.
    sizes = sets.select("node", (F.octet_length("shingles") / 8).cast("long").alias("size"))
    members = families.select("node", F.col("root").alias("family")).join(sizes, "node").join(roots, "node", "left")
    members = members.select("node", "size", "family", F.coalesce("root", "node").alias("root"))
    members = materialised(members, f"{label}-members")
    divided = members.groupBy("family").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    divided = materialised(divided.where("low < high").select("family"), f"{label}-divided")
    more = apart_in_families(members.join(divided, "family"), sets, threshold)
    merged = materialised(links.union(more), f"{label}-links")
    return components(merged, f"{label}-all")


def name_components(indexed: DataFrame, roots: DataFrame, label: str) -> DataFrame:
    """(doc_id, key, n_shingles, component_id, root) of the documents ``indexed``, from the roots of their nodes."""
    classes = indexed.groupBy("node").agg(F.min("doc_id").alias("least"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    classes = materialised(classes, f"{label}-classes")
    lowest = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = materialised(classes.join(lowest, "root").select("node", "root", "component_id"), f"{label}-named")
    own = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return indexed.join(named, "node").select("doc_id", "key", "n_shingles", own.alias("component_id"), "root")
