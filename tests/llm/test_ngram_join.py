from itertools import combinations

import numpy as np
import pytest

from repopulse.llm import ngram_join
from repopulse.llm.common import Remembered
from repopulse.llm.ngram_join import Schemes, shingle_set
from repopulse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def plain_set(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(zip(words, words[1:], words[2:])) if len(words) > 2 else frozenset([tuple(words)])


def plain_components(rows):
    """{id: (set size, smallest id that links lead to)}, all pairs compared."""
    sets = {doc_id: plain_set(text) for doc_id, text in rows}
    above = {doc_id: doc_id for doc_id in sets}

    def root(doc_id):
        while above[doc_id] != doc_id:
            doc_id = above[doc_id]
        return doc_id

    by_size = sorted((doc_id for doc_id in sets if sets[doc_id]), key=lambda doc_id: len(sets[doc_id]))
    for place, one in enumerate(by_size):
        for other in by_size[place + 1 :]:
            a, b = sets[one], sets[other]
            if 90 * len(b) > 100 * len(a):
                break
            both = len(a & b)
            if 100 * both >= 90 * (len(a) + len(b) - both):
                low, high = sorted((root(one), root(other)))
                above[high] = low
    return {doc_id: (len(sets[doc_id]), root(doc_id)) for doc_id in sets}


def found(df):
    return {row.doc_id: (row.n_shingles, row.component_id) for row in df.collect()}


def test_the_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    assert found(QUERIES["op6_ngram_jaccard_join"](spark, FOLDER)) == plain_components([tuple(d) for d in docs])


def changed(rng, words, changes):
    words = list(words)
    for _ in range(changes):
        words[rng.integers(len(words))] = f"new{rng.integers(10**9)}"
    return " ".join(words)


@pytest.mark.parametrize("members", [(1 << 18, 512), (400, 4)])
def test_families_of_near_copies(spark, monkeypatch, members):
    """Many near copies, some too far from each other; with blocks of any size."""
    monkeypatch.setattr(ngram_join, "BLOCK_SHINGLES", members[0])
    monkeypatch.setattr(ngram_join, "BLOCK_MEMBERS", members[1])
    rng = np.random.default_rng(11)
    rows = []
    for size, copies, most in ((40, 60, 3), (120, 60, 8), (400, 40, 16), (12, 20, 1)):
        base = [f"w{rng.integers(5000)}" for _ in range(size)]
        rows += [changed(rng, base, int(rng.integers(0, most + 1))) for _ in range(copies)]
    rows += ["the same phrase again " * 30] * 5 + [" ".join(f"u{n}" for n in range(k)) for k in range(12)]
    rows = list(enumerate(rows))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    result = found(ngram_join.jaccard_components(docs))
    assert result == plain_components(rows)
    assert len({component for _, component in result.values()}) > 30


def test_similar_sets_share_a_signature():
    """For random sets of every size: whatever differs within the threshold, none is lost."""
    schemes, rng = Schemes(), np.random.default_rng(2)
    for size in [*range(1, 130), *rng.integers(130, 4000, 60)]:
        for _ in range(6):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            room = schemes.distance(2 * len(a))
            less, more = rng.integers(0, room + 1, 2)
            less = min(less, len(a) - 1)
            b = np.delete(a, rng.choice(len(a), less, replace=False))
            b = np.unique(np.concatenate([b, rng.integers(0, 2**63, more).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 90 * (len(a) + len(b) - both):
                assert len(np.intersect1d(schemes.signatures(a), schemes.signatures(b))), (size, less, more)


def test_every_scheme_covers_its_distance():
    schemes = Schemes()
    for band in range(45):
        scheme = schemes.scheme(band)
        assert scheme.segments + scheme.neighbourhoods - scheme.slack > schemes.distance(2 * schemes.upper(band))
        assert 0 <= scheme.neighbourhoods <= scheme.segments


def test_overlaps():
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 90))).astype(np.uint64) for _ in range(40)]
    both = ngram_join.overlaps(sets)
    for i, j in combinations(range(40), 2):
        assert both[i, j] == len(np.intersect1d(sets[i], sets[j]))


def test_words_and_shingles():
    words = Remembered(ngram_join._word)
    size = lambda text: len(shingle_set(text, words))
    assert [size(t) for t in (None, "", " \n", "a", "a b", "a b c", "a b c d", "a a a a a")] == [0, 0, 0, 1, 1, 1, 2, 1]
    same = lambda a, b: (shingle_set(a, words) == shingle_set(b, words)).all()
    assert same("A b\x0bC", "a  B\tc") and not same("Ä b c", "ä b c") and not same("a\xa0b c d", "a b c d")


def test_odd_rows(spark):
    long = " ".join(f"w{n}" for n in range(60_000))
    rows = [
        (5, long, "x"), (3, long.replace("w7 ", "v7 "), "x"), (9, long, "x"), (None, "a b c d", "x"), (4, "A B C D", "x"),
        (None, "only null", "x"), (7, None, "x"), (8, "", "x"), (7, "other text here", "x"), (7, "a b c d", "x"),
        (1, "other text here", "x"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, node string")
    found_rows = ngram_join.jaccard_components(docs).collect()
    assert sorted((row.doc_id or -1, row.n_shingles, row.component_id or -1) for row in found_rows) == sorted([
        (5, 59_998, 3), (3, 59_998, 3), (9, 59_998, 3), (-1, 2, 4), (4, 2, 4), (-1, 1, -1), (7, 0, 7), (8, 0, 8),
        (7, 1, 1), (7, 2, 4), (1, 1, 1),
    ])
    assert ngram_join.jaccard_components(docs.where("false")).count() == 0
