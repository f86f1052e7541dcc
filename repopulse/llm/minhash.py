"""Near duplicates by min-max hashing.

Each permutation of the shingles' hashes gives two values of a set, its minimum and its
maximum. Either is equal for two sets with the probability of their Jaccard similarity,
so half as many permutations make a signature of a given length, and since minimum and
maximum of one permutation aren't independent draws but drawn without replacement, the
share of equal values varies a little less around the similarity than with a permutation
for each value.

Values are banded: ``rows`` minima, or ``rows`` maxima, of different permutations make a
band, so that two sets of similarity s share a band with probability s ** rows. Sets
that share a band are candidates. Whole sets decide.
"""

from collections.abc import Callable
from functools import partial

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix
from .ngram_join import components_by

THRESHOLD = (80, 100)
SHINGLE = 4
#: At the threshold a pair shares none of the bands with probability 0.5904 ** 32 = 5e-8.
BANDS, ROWS = 32, 4
SEED = 12
#: Shingles hashed at once, under all permutations.
SLICE = 4096


class MinMax:
    """Min-max signatures; half of the ``bands`` hold minima, half maxima."""

    def __init__(self, bands: int = BANDS, rows: int = ROWS, seed: int = SEED):
        if bands % 2:
            raise ValueError("bands come in pairs, of minima and of maxima")
        self.bands, self.rows = bands, rows
        numbers = mix(np.arange(bands * rows), seed)
        # An odd factor and an addend permute the 64-bit numbers.
        half = bands * rows // 2
        self.factor, self.addend = (numbers[:half] | np.uint64(1))[:, None], numbers[half:][:, None]

    def values(self, shingles: np.ndarray) -> np.ndarray:
        """Two rows, the minima and the maxima under each permutation, of a set with members."""
        low = np.full(len(self.factor), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.factor), np.uint64)
        for at in range(0, len(shingles), SLICE):
            moved = shingles[None, at : at + SLICE] * self.factor + self.addend
            low, high = np.minimum(low, moved.min(axis=1)), np.maximum(high, moved.max(axis=1))
        return np.stack([low, high])

    def signatures(self, shingles: np.ndarray) -> np.ndarray:
        """A 64-bit signature for each band."""
        values = self.values(shingles).reshape(self.bands, self.rows)
        found = mix(np.arange(self.bands), 13)
        for row in range(self.rows):
            found = mix(found ^ values[:, row], 14)
        return found

    @staticmethod
    def similarity(one: np.ndarray, other: np.ndarray) -> float:
        """Unbiased estimate of the Jaccard similarity from the ``values`` of two sets."""
        return float((one == other).mean())


def _signer(bands: int, rows: int, seed: int) -> Callable[[np.ndarray], np.ndarray]:
    return MinMax(bands, rows, seed).signatures


def near_duplicates(
    docs: DataFrame,
    threshold: tuple[int, int] = THRESHOLD,
    shingle: int = SHINGLE,
    bands: int = BANDS,
    rows: int = ROWS,
    seed: int = SEED,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of ``docs``.

    Words are cut at ASCII white space, A-Z in lower case; a set holds the distinct
    shingles of ``shingle`` words, or the whole sequence of fewer words. Documents link if
    intersection and union of their sets are at least as ``threshold``, (part, whole);
    ``component_id`` is the smallest id that links lead to, and ``kept`` marks it.

    Links are verified on whole sets, so none is wrong. A link at the threshold is missed
    with probability (1 - threshold ** rows) ** bands, closer ones with less. Nothing is
    capped: a band that many sets share is compared in blocks.

    Null texts and texts without words link with nothing and are kept. Repeated rows and
    repeated ids are separate documents, so a repeated smallest id is kept as often as it
    occurs. Rows with a null id link like others; a component without any id has a null
    one, and its rows are kept. An empty table gives an empty one. Other columns aren't
    read, so their names can't clash.
    """
    found = components_by(partial(_signer, bands, rows, seed), docs, threshold, doc_id, text, shingle, "minhash")
    return found.drop("key", "root").withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
