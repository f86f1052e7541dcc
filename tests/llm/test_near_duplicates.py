"""The pipeline's near-duplicate stage against all pairs of five-word sets at 0.8."""

import numpy as np

import corpus_pipeline
from repopulse.llm import ngram_join
from repopulse.llm.ngram_join import Schemes

SCHEMA = "doc_id long, text string"


def five_word_set(text):
    words = text.encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_roots(texts):
    """Smallest place that links lead to, for each text; all pairs compared."""
    sets, root = [five_word_set(text) for text in texts], list(range(len(texts)))
    for one in range(len(texts)):
        for other in range(one):
            both = len(sets[one] & sets[other])
            if both and 100 * both >= 80 * len(sets[one] | sets[other]):
                low, high = sorted((root[one], root[other]))
                root = [low if r == high else r for r in root]
    return root


def kept(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA).repartition(4)
    return [row.doc_id for row in corpus_pipeline.near_duplicates(spark, docs, "").collect()]


def test_two_separate_words_changed(spark):
    """Five-word Jaccard 86/106, three-word Jaccard 92/104: a near copy, but not of op6's kind."""
    words = [f"w{n}" for n in range(100)]
    near = [*words[:30], "x", *words[31:60], "y", *words[61:]]
    far = [*words[:20], "a", *words[21:40], "b", *words[41:70], "c", *words[71:]]  # 81/111
    assert len(kept(spark, [" ".join(words), " ".join(near)])) == 1
    assert len(kept(spark, [" ".join(words), " ".join(far)])) == 2


def test_the_stage_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    texts = []
    for size, copies, most in ((30, 30, 3), (100, 40, 5), (300, 30, 14), (1500, 8, 60), (8, 10, 1), (4, 3, 0)):
        base = [f"w{n}" for n in rng.integers(0, 4000, size)]
        for _ in range(copies):
            words = list(base)
            for at in rng.integers(0, size, rng.integers(0, most + 1)):
                words[at] = f"new{rng.integers(10**9)}"
            texts.append(" ".join(words))
    roots, left = plain_roots(texts), kept(spark, texts)
    assert sorted(roots[i] for i in left) == sorted(set(roots))
    assert len(left) > 30


def test_sets_at_the_bound_share_a_strong_signature():
    schemes, rng = Schemes((80, 100)), np.random.default_rng(6)
    for size in [*range(1, 90, 3), *rng.integers(90, 5000, 40)]:
        for _ in range(4):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            room = schemes.distance(2 * len(a))
            less, more = min(rng.integers(0, room + 1), len(a) - 1), rng.integers(0, room + 1)
            b = np.delete(a, rng.choice(len(a), less, replace=False))
            b = np.unique(np.concatenate([b, rng.integers(0, 2**63, more).astype(np.uint64)]))
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                assert len(np.intersect1d(schemes.signatures(a), schemes.signatures(b))), (size, less, more)


def test_large_unrelated_sets_share_no_signature():
    """Weak signatures, as those of empty segments, would make one family of all large sets."""
    schemes, rng = Schemes((80, 100)), np.random.default_rng(7)
    for size in (400, 2000, 8000):
        a, b = (np.unique(rng.integers(0, 2**63, size).astype(np.uint64)) for _ in range(2))
        for found in schemes.by_band(b):
            assert not len(np.intersect1d(schemes.by_band(a)[0], found))


def test_op6_keeps_its_contract():
    assert (ngram_join.SHINGLE, ngram_join.THRESHOLD) == (3, (90, 100))
    assert Schemes().strong == ngram_join.STRONG
