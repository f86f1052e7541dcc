import math
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from repopulse.llm import pitman_yor as lm
from repopulse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def tokens(text):
    return (text or "").encode().lower().split() + [lm.END]


@pytest.fixture(scope="module")
def scored(spark):
    return QUERIES["op10_lm_scoring"](spark, FOLDER).toPandas()


def test_base_score_against_a_loop(spark, scored):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    words = {doc.doc_id: tokens(doc.text) for doc in docs}
    held_out = {doc_id: zlib.crc32(str(doc_id).encode()) % 10 == 0 for doc_id in words}
    counts = Counter(word for doc_id, own in words.items() if not held_out[doc_id] for word in own)
    total = sum(counts.values())
    assert len(scored) == len(docs)
    for row in scored.itertuples():
        own = words[row.doc_id]
        base = sum(math.log10((counts[word] + 0.1) / (total + 0.1 * (len(counts) + 1))) for word in own)
        assert (row.held_out, row.n_tokens, row.train_tokens) == (held_out[row.doc_id], len(own), total)
        assert row.n_known == sum(counts[word] > 0 for word in own)
        assert row.base_score == pytest.approx(base, rel=1e-9)


def plain_bigram(docs):
    """Held-out perplexity of absolute discounting over the word before, and its tokens."""
    learn = [tokens(doc.text) for doc in docs if zlib.crc32(str(doc.doc_id).encode()) % 10]
    held = [tokens(doc.text) for doc in docs if zlib.crc32(str(doc.doc_id).encode()) % 10 == 0]
    pairs = Counter(pair for own in learn for pair in zip([None, *own], own))
    contexts, kinds, continued = Counter(), Counter(), Counter()
    for (before, word), n in pairs.items():
        contexts[before] += n
        kinds[before] += 1
        continued[word] += 1

    def discount(counts):
        one, two = (sum(n == k for n in counts) for k in (1, 2))
        return one / (one + 2 * two)

    d, d0, total, size = discount(pairs.values()), discount(continued.values()), continued.total(), len(continued)
    bits = count = 0
    for own in held:
        for before, word in zip([None, *own], own):
            root = (max(continued[word] - d0, 0) + d0 * size / (size + 1)) / total
            n = contexts[before]
            bits -= math.log10((max(pairs[before, word] - d, 0) + d * kinds[before] * root) / n if n else root)
            count += 1
    return 10 ** (bits / count), count


def test_held_out_perplexity_next_to_a_plain_bigram(spark, scored):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").collect()
    plain, count = plain_bigram(docs)
    unseen = scored[scored.held_out]
    assert unseen.n_tokens.sum() == count
    assert 10 ** (-unseen.score.sum() / count) < 1.1 * plain
    assert 10 ** (-unseen.score.sum() / count) < 0.6 * 10 ** (-unseen.base_score.sum() / count)
    assert (scored.score < 0).all()


def run_here(docs, shards, chunk_bytes):
    """``score_documents`` without Spark: rows of documents (doc_id, text, learn)."""
    chunks, chunk = [], lm.Chunk(0)
    for doc in docs:
        chunk.add(*doc)
        if chunk.bytes >= chunk_bytes:
            chunks.append(chunk)
            chunk = lm.Chunk(chunk.number + 1)
    chunks += [chunk] if chunk.ids else []
    packed = [(own.number, *own.packed(shards)) for own in chunks]
    fields = {"chunk": "long", **lm._REQUEST_FIELDS}
    rows = [{"chunk": number, **request} for number, _, requests in packed for request in requests]
    answers = []
    for s in sorted({row["shard"] for row in rows}):
        answers += lm._sample(shards, lm._table([row for row in rows if row["shard"] == s], fields)).to_pylist()
    sums = np.sum([row["totals"] for row in answers if row["totals"] is not None], axis=0)
    totals = lm.Totals(sums[0], sums[1], sums[2 : 2 + lm.SAMPLES], sums[2 + lm.SAMPLES :])
    replies = [{**row, "counts": None} for row in answers if row["chunk"] is not None]
    for s in sorted({row["shard"] for row in rows}):
        own = [row for row in answers if row["shard"] == s]
        replies += [{**row, "scores": None} for row in lm._reply(lm._table(own, lm._ANSWER_FIELDS)).to_pylist()]
    found, fields = {}, {**lm._REPLY_FIELDS, "first_pair": "long", "scores": "binary"}
    for number, documents, _ in packed:
        own = lm._table([row for row in replies if row["chunk"] == number], fields)
        table = lm._table([{"chunk": number, **documents}], {"chunk": "long", **lm._DOCUMENT_FIELDS})
        for row in lm._score(totals, table, own).to_pylist():
            found[row["doc_id"]] = row
    return found


TEXTS = ["a b c a b", "a a c", "b c d e", "", "the a of the b", None, "e e e e e", "a b c d e a b", "z y x", "unseen b unseen"]


@pytest.mark.parametrize("shards, chunk_bytes", [(1, 1000), (4, 12), (3, 1)])
def test_scores_against_a_plain_version_with_fixed_seatings(monkeypatch, shards, chunk_bytes):
    """Half of a cell's customers at tables of their own, in a sample more or less."""
    d, d0 = 0.6, 0.3

    def fixed(self, burn_in, samples, seed):
        self.discount, self.root_discount = d, d0
        self.t = np.array([np.maximum(self.n - (self.n + s) // 2, np.minimum(self.n, 1)) for s in range(samples)])
        at_root = np.array([np.bincount(self.word, t, self.words) for t in self.t])
        self.tau = np.minimum(at_root, 1 + np.arange(samples)[:, None]).astype(np.int64)

    monkeypatch.setattr(lm.Shard, "sample", fixed)
    docs = [(n, text, n < 8) for n, text in enumerate(TEXTS)]
    found = run_here(docs, shards, chunk_bytes)

    n = Counter()
    for _, text, learn in docs:
        own = tokens(text)
        n.update(zip([None, *own], own) if learn else ())
    words = {word for _, word in n}
    for doc_id, text, learn in docs:
        own, expected = tokens(text), 0
        for before, word in zip([None, *own], own):
            chance = 0
            for s in range(lm.SAMPLES):
                t = {pair: max(times - (times + s) // 2, 1) for pair, times in n.items()}
                at_root = Counter()
                for (_, other), tables in t.items():
                    at_root[other] += tables
                tau = {other: min(tables, 1 + s) for other, tables in at_root.items()}
                new = (1 + d0 * sum(tau.values())) / (len(words) + 1)
                root = (at_root[word] - d0 * tau.get(word, 0) + new) / (1 + sum(at_root.values()))
                tables = sum(t[pair] for pair in t if pair[0] == before)
                customers = sum(times for pair, times in n.items() if pair[0] == before)
                seated = n[before, word] - d * t.get((before, word), 0)
                chance += (seated + (1 + d * tables) * root) / (1 + customers) / lm.SAMPLES
            expected += math.log10(chance)
        assert found[doc_id]["score"] == pytest.approx(expected, rel=1e-5)
        assert found[doc_id]["held_out"] == (not learn) and found[doc_id]["n_tokens"] == len(own)
        assert found[doc_id]["n_known"] == sum(word in words for word in own)


def test_probabilities_add_up_to_one():
    """Over the known words and one unknown, after every context, seats sampled."""
    rng = np.random.default_rng(3)
    cells = np.unique(rng.integers(0, 40, 300) * 100 + rng.integers(0, 25, 300))
    word, context = cells // 100, cells % 100
    shard = lm.Shard.count(word, context, rng.geometric(0.5, len(cells)), 40, 1.0)
    shard.sample(2, lm.SAMPLES, 1)
    totals = shard.totals()
    known = np.unique(word)
    sums = lm.Totals(totals[0], totals[1], totals[2 : 2 + lm.SAMPLES], totals[2 + lm.SAMPLES :])
    root = sums.root(np.hstack([shard.at_root(), np.zeros((lm.SAMPLES, 1))]))
    assert np.allclose(root[:, [*known, 40]].sum(axis=1), 1)
    seated = dict(zip(zip(word, context), shard.seated()))
    customers = np.bincount(context, shard.n, 26)
    masses = np.array([np.bincount(context, t, 26) for t in shard.t]) * shard.discount
    for of in range(26):
        own = np.array([*known, 40])
        at = np.array([seated.get((w, of), 0.0) for w in own])
        chances = lm.probabilities(at, own, np.full(len(own), of), root, customers, masses)
        assert chances.sum() == pytest.approx(1) and (chances > 0).all()


def test_seating_follows_the_restaurant():
    """Mean number of tables against its expectation, customer by customer and in groups."""
    rng = np.random.default_rng(6)
    n, discount, new = 40, 0.4, 1.5
    tables = lm.seat(np.full(20_000, n), discount, np.full(20_000, new), 0.0, rng)
    chances = np.zeros(n + 1)
    chances[1] = 1.0
    t = np.arange(n + 1)
    for m in range(1, n):
        opens = new / (new + m - discount * t)
        chances = chances * (1 - opens) + np.concatenate([[0], (chances * opens)[:-1]])
    assert tables.mean() == pytest.approx((chances * t).sum(), rel=0.03)
    assert (lm.seat(np.array([0, 1, 2]), 0.5, np.ones(3), 0.1, rng) <= [0, 1, 2]).all()
    many = lm.seat(np.array([10**9]), 0.5, np.ones(1), 0.01, rng)
    assert 1 <= many[0] < 10**6


def test_codes_survive_squeezing():
    codes = np.array([0, 1, 255, 256, 70_000, 2**32 - 1], "<u4")
    assert (lm._unsqueeze(lm._squeeze(codes), "<u4") == codes).all()
    assert (lm._unsqueeze_rising(lm._squeeze_rising(np.array([0, 3, 3, 2**63]))) == [0, 3, 3, 2**63]).all()
    assert len(lm._unsqueeze(lm._squeeze(np.zeros(0, "<f4")), "<f4")) == 0


def test_chunks_and_shards_change_only_the_sampling(spark, monkeypatch, scored):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text")
    learn = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 != 0
    monkeypatch.setattr(lm, "CHUNK_BYTES", 200_000)
    monkeypatch.setattr(lm, "SHARD_BYTES", 400_000)
    again = lm.score_documents(docs.repartition(2), learn).toPandas()
    both = scored.merge(again, on="doc_id", suffixes=("", "_again"))
    assert np.allclose(both.base_score, both.base_score_again)
    assert both.score_again.sum() == pytest.approx(both.score.sum(), rel=0.005)
    assert np.allclose(both.score, both.score_again, rtol=0.1)


def test_odd_rows(spark):
    rows = [(1, "A b", "x"), (1, "a B", "x"), (None, "new words", "x"), (2, None, "x"), (3, "w " * 200_000, "x"), (4, "a\xa0b", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = lm.score_documents(docs, F.col("doc_id") < 3).collect()
    assert len(found) == 6
    same = [row for row in found if row.doc_id == 1]
    assert same[0].score == same[1].score and not same[0].held_out
    by_id = {row.doc_id: row for row in found}
    # A null condition is held out; two words are new, the end is known.
    assert by_id[None].held_out and by_id[None].n_known == 1 and by_id[2].n_tokens == 1
    assert by_id[3].n_tokens == 200_001 and by_id[4].n_tokens == 2
    assert all(row.score < 0 for row in found)
    assert lm.score_documents(docs.where("false"), F.lit(True)).count() == 0
    unlearned = lm.score_documents(docs, F.lit(False)).collect()
    assert all(row.n_known == 0 and row.train_tokens == 0 and row.score <= 0 for row in unlearned)


def test_a_chunk_keeps_its_documents_in_few_bytes():
    """Its tokens, once; not the distinct pairs of each document and of the chunk."""
    rng = np.random.default_rng(3)
    chunk = lm.Chunk(0)
    for n in range(200):
        chunk.add(n, " ".join(f"w{int(x)}" for x in rng.pareto(0.7, 500) * 10), n % 10 > 0)
    documents, _ = chunk.packed(8)
    words = sum(map(len, chunk.words))
    assert sum(len(own) for own in documents.values() if isinstance(own, bytes)) < 2.5 * words
    frequent = lm._unsqueeze(documents["frequent"], "<u4")[lm._unsqueeze(documents["tokens"], "<u4")]
    assert len(frequent) == words and len(set(frequent.tolist())) == len(chunk.keys) - 1  # all but the start
