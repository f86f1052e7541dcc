"""Exact top-k by inner product, pruned with multi-resolution segment statistics.

A vector is cut into segments; a segment keeps its mean and its deviation, the norm of
what is left without the mean. For two vectors the squared distance of a segment is at
least (length times) the squared difference of the means plus that of the deviations
(Cauchy-Schwarz), and so is the distance of the whole vectors the sum over segments.
With the norms known, a lower bound of the distance is an upper bound of the inner
product. Fewer, longer segments cost less and bound less: candidates go through the
levels from coarse to fine, and only survivors get exact scores.

The stated queries meet all rows in cells of a grid, a block of queries and a block of
rows each. A cell's work is bounded by the block sizes, its first bounds give it a
threshold, and it hands on its ``k`` best for each query.
"""

from functools import partial
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialised

QUERY_BLOCK, ROW_BLOCK = 8192, 4096
#: Queries whose bounds against a block of rows are in memory at a time.
TILE = 256
LEVELS = (2, 8, 16)


def statistics(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of each segment, scaled so that their products bound scores.

    The product of two rows is at least the inner product of the vectors: a segment adds
    length * mean * mean + deviation * deviation. In a distance the same numbers are
    (norm + norm - distance) / 2.
    """
    edges = np.linspace(0, vectors.shape[1], min(segments, vectors.shape[1]) + 1).astype(int)
    out = []
    for start, stop in zip(edges, edges[1:]):
        part = vectors[:, start:stop]
        mean = part.mean(axis=1)
        deviation = np.sqrt(np.maximum((part * part).sum(axis=1) - (stop - start) * mean * mean, 0))
        out += [mean * np.sqrt(stop - start), deviation]
    return np.stack(out, axis=1) if out else np.zeros((len(vectors), 0))


def _products(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of integer vectors: every query with every row."""
    largest = max(np.abs(queries).max(initial=0), np.abs(rows).max(initial=0))
    if float(largest) ** 2 * rows.shape[1] < 2**53:
        return (queries.astype(float) @ rows.astype(float).T).astype(np.int64)
    return queries @ rows.T


def search(
    query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, rows: np.ndarray, k: int
) -> list[tuple[int, np.ndarray, np.ndarray]]:
    """(query's position, ids, scores) of each query's ``k`` best rows but its own."""
    wide = [statistics(rows.astype(float), level) for level in LEVELS]
    found = []
    for start in range(0, len(queries), TILE):
        tile = queries[start : start + TILE]
        narrow = [statistics(tile.astype(float), level) for level in LEVELS]
        alive = query_ids[start : start + TILE, None] != ids[None, :]
        places = np.arange(len(rows))
        if len(rows) > k + 1:
            bound = np.where(alive, narrow[0] @ wide[0].T, -np.inf)
            first = np.argpartition(-bound, k - 1, axis=1)[:, :k]
            enough = np.take_along_axis(alive, first, axis=1).all(axis=1)
            score = np.einsum("qd,qkd->qk", tile, rows[first]).min(axis=1)
            # Rounding errs by far less than this.
            slack = 1e-9 * (1 + np.abs(bound[np.isfinite(bound)]).max(initial=0))
            least = np.where(enough, score - slack, -np.inf)[:, None]
            alive &= bound >= least
            for own, other in zip(narrow[1:], wide[1:]):
                left = alive.any(axis=0)
                places, alive = places[left], alive[:, left]
                alive &= own @ other[places].T >= least
        left = alive.any(axis=0)
        places, alive = places[left], alive[:, left]
        exact = _products(tile, rows[places])
        for i, (score, own) in enumerate(zip(exact, alive)):
            own = np.flatnonzero(own)
            score = score[own]
            if len(own) > k:
                own = own[score >= np.partition(score, len(own) - k)[len(own) - k]]
                score = exact[i, own]
            best = places[own]
            order = np.lexsort((ids[best], -score))[:k]
            found.append((start + i, ids[best[order]], score[order]))
    return found


def _cell(k: int, queries: pa.Table, rows: pa.Table) -> pa.Table:
    if not queries.num_rows or not rows.num_rows:
        return _FOUND.empty_table()

    def read(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        return table.column("vec_id").to_numpy(), flat.reshape(table.num_rows, -1).astype(np.int64)

    (query_ids, wanted), (ids, vectors) = read(queries), read(rows)
    numbers = queries.column("number").to_numpy()
    found = search(query_ids, wanted, ids, vectors, k)
    times = [len(best) for _, best, _ in found]
    position = np.repeat([i for i, _, _ in found], times).astype(np.int64)
    columns = [numbers[position], query_ids[position]]
    columns += [np.concatenate([part[i] for part in found]) for i in (1, 2)]
    return pa.table([pa.array(column, pa.int64()) for column in columns], _FOUND)


_FOUND = pa.schema([(name, pa.int64()) for name in ("number", "query_id", "vec_id", "score")])


def quantised(vectors: DataFrame, scale: float, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v): floor(scale * x) of every component; rows that can't take part are dropped."""
    x = F.col(embedding)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    usable = F.col(vec_id).isNotNull() & x.isNotNull() & (F.size(x) > 0) & finite
    v = F.transform(x, lambda e: F.floor(F.lit(scale) * e.cast("double")).cast("long"))
    return vectors.where(usable).select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v"))


def top_k(
    vectors: DataFrame,
    k: int = 20,
    every: int = 20,
    scale: float = 64.0,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products for each query.

    Queries are the rows whose id is divisible by ``every``; candidates are all rows with
    another id. Components are floor(``scale`` * x). Equal scores go to the smaller id;
    fewer candidates give fewer rows. Scores must fit in 64 bits.

    Rows with a null id, a null or empty vector, or a null or non-finite component take
    no part. A repeated row is one more candidate, and one more query with ranks of its
    own. Vectors of different lengths are compared within their length only. An empty
    table gives an empty one. Other columns aren't read, so their names can't clash.

    Rows are dealt evenly, whatever their values, so copies of one vector are no hot key.
    """
    rows = quantised(vectors, scale, vec_id, embedding)
    rows = rows.withColumns({"number": F.monotonically_increasing_id(), "width": F.size("v")})
    rows = materialised(rows, "topk")
    is_query = F.col("vec_id") % every == 0
    total = rows.agg(F.count("*").alias("rows"), F.count_if(is_query).alias("queries")).first()
    row_blocks, query_blocks = ceil(total["rows"] / ROW_BLOCK), ceil(total["queries"] / QUERY_BLOCK)
    if not query_blocks:
        row_blocks = query_blocks = 1

    def dealt(blocks: int):
        return F.pmod(F.xxhash64("number"), F.lit(blocks))

    def every_block(blocks: int):
        return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))

    cell = ["width", "row_block", "query_block"]
    queries = rows.where(is_query).withColumns(
        {"query_block": dealt(query_blocks).cast("int"), "row_block": every_block(row_blocks)}
    )
    wide = rows.withColumns({"row_block": dealt(row_blocks).cast("int"), "query_block": every_block(query_blocks)})
    found = queries.groupBy(*cell).cogroup(wide.groupBy(*cell))
    found = found.applyInArrow(partial(_cell, k), "number long, query_id long, vec_id long, score long")
    best = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
