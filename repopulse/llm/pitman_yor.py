"""Hierarchical Pitman-Yor language model over the words of a corpus.

A word is drawn in the restaurant of its context, the word before it or the start of the
text. All contexts share one parent: a table there is a customer of the root, whose base
is uniform over the known words and one unknown. Every word that something follows is a
context, so a larger corpus has more of them. Seatings are sampled by Gibbs sweeps, and
the predictive probabilities of several samples are averaged.

All cells (context, word) of a word, and its tables at the root, are in the shard that
the word's hash names; a shard is about a bounded part of the corpus, so there are more
of them for more text. Documents are read in chunks. A chunk sends each shard its words
and its distinct pairs with their counts, packed, so that a frequent pair is one entry
for each chunk and no key is hot. A shard counts, sweeps and answers in one task. Of the
other shards it would need totals: the tables of a context, the customers of the root.
Since words are dealt by a hash, its own cells are a random sample of a context's, and
what is elsewhere is estimated from them while seats are sampled. Probabilities are then
computed with the exact totals, which shards send to the shard of the context.
"""

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from repopulse.session import shared_folder

from .common import release

#: Bytes of text after which a chunk ends with the document, and for which there is a shard.
CHUNK_BYTES, SHARD_BYTES = 16 << 20, 12 << 20
END = b"\n"  # no word has white space
BURN_IN, SAMPLES = 3, 3
STRENGTH = 1.0
PSEUDO_COUNT = 0.1
#: Contexts are told apart by so many bits of their hash, words by all 64.
CONTEXT_BITS = 40
CONTEXT = np.uint64((1 << CONTEXT_BITS) - 1)
START = np.uint64(xxhash.xxh3_64_intdigest(b" "))  # a context, no word


def word_key(word: bytes) -> int:
    return xxhash.xxh3_64_intdigest(word)


def shard_of(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys & CONTEXT) % np.uint64(shards)).astype(np.int64)


def pairs_of(words: np.ndarray, lengths: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of a word and the one before it, as one number, and the place of each token's."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[np.cumsum(lengths) - lengths] = start
    return np.unique(words << 32 | before, return_inverse=True)


class Chunk:
    """Documents of one task: their words numbered, their pairs (word, word before) counted."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.codes: dict[bytes, int] = {b" ": 0, END: 1}
        self.keys: list[int] = [int(START), word_key(END)]
        self.ids: list[int | None] = []
        self.learn: list[bool] = []
        self.words: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: str | None, learn: bool) -> None:
        words = (text or "").encode().lower().split()  # white space of bytes: \\x20 and \\x09-\\x0D
        codes = self.codes
        for word in set(words).difference(codes):
            codes[word] = len(self.keys)
            self.keys.append(word_key(word))
        own = np.fromiter(map(codes.__getitem__, words), np.uint32, len(words))
        self.words.append(np.append(own, np.uint32(1)))
        self.ids.append(doc_id)
        self.learn.append(learn)
        self.bytes += len(text or "")

    def packed(self, shards: int) -> tuple[dict, list[dict]]:
        """The documents, and a request for each shard that has words of the chunk.

        Words are renumbered by shard and key, so a shard's words, and the pairs of them,
        are a range of the chunk's: answers go back to where the request began.
        """
        keys = np.array(self.keys, np.uint64)
        shard = shard_of(keys, shards)
        order = np.lexsort((keys, shard))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        keys, shard = keys[order], shard[order]
        lengths = np.array([len(own) for own in self.words])
        words = rank[np.concatenate(self.words)]
        pairs, places = pairs_of(words, lengths, rank[0])
        learned = np.repeat(np.array(self.learn, bool), lengths)
        counts = np.bincount(places[learned], minlength=len(pairs))
        word, context = pairs >> 32, keys[pairs & 0xFFFFFFFF] & CONTEXT
        each = np.bincount(word, minlength=len(keys))
        word_ends = np.searchsorted(shard, np.arange(shards + 1))
        pair_ends = np.append(0, np.cumsum(each))[word_ends]
        requests = []
        for s in np.flatnonzero(np.diff(word_ends)).tolist():
            w, p = slice(word_ends[s], word_ends[s + 1]), slice(pair_ends[s], pair_ends[s + 1])
            requests.append(
                {
                    "shard": s, "first_word": int(w.start), "first_pair": int(p.start),
                    "keys": _squeeze_rising(keys[w]), "each": _squeeze(each[w].astype("<u4")),
                    "contexts": _squeeze(context[p]), "counts": _squeeze(counts[p].astype("<u4")),
                }
            )
        # The tokens themselves, frequent words as small numbers; pairs are found again from them.
        frequent = np.argsort(-np.bincount(words, minlength=len(keys)), kind="stable")
        small = np.empty(len(frequent), "<u4")
        small[frequent] = np.arange(len(frequent))
        documents = {
            "doc_id": self.ids, "learn": self.learn, "lengths": lengths, "first": int(rank[0]),
            "tokens": _squeeze(small[words]), "frequent": _squeeze(frequent.astype("<u4")),
        }
        return documents, requests


_DOCUMENT_FIELDS = {
    "doc_id": "array<long>", "learn": "array<boolean>", "lengths": "array<long>", "first": "long", "tokens": "binary",
    "frequent": "binary",
}
_REQUEST_FIELDS = {
    "shard": "int", "first_word": "long", "first_pair": "long", "keys": "binary", "each": "binary",
    "contexts": "binary", "counts": "binary",
}
_KINDS = {
    "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "boolean": pa.bool_(), "array<long>": pa.list_(pa.int64()),
    "array<boolean>": pa.list_(pa.bool_()), "array<double>": pa.list_(pa.float64()), "string": pa.string(), "double": pa.float64(),
}


def _schema(fields: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in fields.items())


def _table(rows: list[dict], fields: dict[str, str]) -> pa.Table:
    columns = [pa.array([row.get(name) for row in rows], _KINDS[kind]) for name, kind in fields.items()]
    return pa.table(columns, list(fields))


_CHUNK_FIELDS = {"chunk": "long", **_REQUEST_FIELDS, **_DOCUMENT_FIELDS}


def _chunks(shards: int, limit: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row for the documents of each chunk, and one for each of its requests."""
    chunk = Chunk(TaskContext.get().partitionId() << 24)

    def rows() -> Iterator[pa.RecordBatch]:
        documents, requests = chunk.packed(shards)
        yield from _table([{"chunk": chunk.number, **documents}], _CHUNK_FIELDS).to_batches()
        for at in range(0, len(requests), 256):
            part = [{"chunk": chunk.number, **request} for request in requests[at : at + 256]]
            yield from _table(part, _CHUNK_FIELDS).to_batches()

    for batch in batches:
        for at in range(0, batch.num_rows, 128):
            for row in zip(*(batch.column(i).slice(at, 128).to_pylist() for i in range(3))):
                chunk.add(*row)
                if chunk.bytes >= limit:
                    yield from rows()
                    chunk = Chunk(chunk.number + 1)
    if chunk.ids:
        yield from rows()


def _squeeze(numbers: np.ndarray) -> bytes:
    """First bytes of all numbers, then second bytes and so on, compressed."""
    size = numbers.dtype.itemsize
    return zlib.compress(np.ascontiguousarray(numbers).view("u1").reshape(-1, size).T.tobytes(), 1)


def _unsqueeze(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(zlib.decompress(raw), "u1").reshape(size, -1).T.copy().view(kind).ravel()


def _squeeze_rising(numbers: np.ndarray) -> bytes:
    return _squeeze(np.diff(numbers.astype("<u8"), prepend=np.uint64(0)))


def _unsqueeze_rising(raw: bytes) -> np.ndarray:
    return np.cumsum(_unsqueeze(raw, "<u8"), dtype=np.uint64)


def discount_of(counts: np.ndarray) -> float:
    """From how many are one and how many are two, as for absolute discounting."""
    one, two = int((counts == 1).sum()), int((counts == 2).sum())
    return min(max(one / (one + 2 * two) if one else 0.5, 0.05), 0.95)


def seat(n: np.ndarray, discount: float, new: np.ndarray, step: np.ndarray | float, rng) -> np.ndarray:
    """Tables that ``n`` customers of one dish take, seated one after another.

    With m seated at t tables the next opens one with odds ``new + step * t`` to
    m - discount * t. From the 32nd on, customers come in groups of a sixteenth of those
    seated and see the tables that were there before the group.
    """
    t, m = np.minimum(n, 1).astype(float), np.minimum(n, 1).astype(float)
    left = np.flatnonzero(n > 1)
    step = np.broadcast_to(step, n.shape)
    while len(left):
        group = np.minimum(np.maximum(1, m[left] // 16), n[left] - m[left])
        odds = new[left] + step[left] * t[left]
        opened = rng.binomial(group.astype(np.int64), odds / (odds + np.maximum(m[left] - discount * t[left], 1e-9)))
        t[left] += opened
        m[left] += group
        left = left[m[left] < n[left]]
    return t.astype(np.int64)


@dataclass
class Shard:
    """Cells of the words of one shard: ``word`` and ``context`` numbers, ``n`` customers.

    ``t`` and ``tau`` are tables of the cells and of the words at the root, in a row for
    each sample. ``share`` of all shards is this one.
    """

    word: np.ndarray
    context: np.ndarray
    n: np.ndarray
    words: int
    share: float
    discount: float
    root_discount: float
    t: np.ndarray
    tau: np.ndarray

    @classmethod
    def count(cls, word: np.ndarray, context: np.ndarray, n: np.ndarray, words: int, share: float) -> "Shard":
        """Unseated cells with ``n`` customers each."""
        nothing = np.zeros((0, 0), np.int64)
        root = discount_of(np.bincount(word, minlength=words))
        return cls(word, context, n, words, share, discount_of(n), root, nothing, nothing)

    def sample(self, burn_in: int, samples: int, seed: int) -> None:
        """Gibbs sweeps: every customer of every cell, and of the root, is seated anew.

        The tables of a context elsewhere, and the totals of the root, are those here over
        the share of this shard.
        """
        rng = np.random.default_rng([seed, len(self.n)])
        contexts = int(self.context.max()) + 1 if len(self.n) else 0
        t = np.minimum(self.n, 1)
        at_root = np.bincount(self.word, t, self.words)
        tau = np.minimum(at_root, 1).astype(np.int64)
        scale, kept, kept_root = 1 / self.share, [], []
        base = 1 / (scale * max((at_root > 0).sum(), 1) + 1)
        for turn in range(burn_in + samples):
            here = np.bincount(self.context, t, contexts)
            elsewhere = scale * (here[self.context] - t)
            others = at_root[self.word] - t
            total, tables = scale * at_root.sum(), scale * tau.sum()
            seated = np.maximum(others - self.root_discount * np.minimum(tau[self.word], others), 0)
            parent = (seated + (STRENGTH + self.root_discount * tables) * base) / (STRENGTH + total)
            new = (STRENGTH + self.discount * elsewhere) * parent
            t = seat(self.n, self.discount, new, self.discount * parent, rng)
            at_root = np.bincount(self.word, t, self.words).astype(np.int64)
            new = (STRENGTH + self.root_discount * np.maximum(scale * tau.sum() - tau, 0)) * base
            tau = seat(at_root, self.root_discount, new, self.root_discount * base, rng)
            if turn >= burn_in:
                kept.append(t)
                kept_root.append(tau)
        self.t = np.array(kept).reshape(samples, len(self.n))
        self.tau = np.array(kept_root).reshape(samples, self.words)

    def seated(self) -> np.ndarray:
        """Customers less discounts of each cell, on average over the samples."""
        return self.n - self.discount * self.t.mean(axis=0) if len(self.n) else np.zeros(0)

    def at_root(self) -> np.ndarray:
        """Customers less discounts of each word at the root, a row for each sample."""
        tables = np.array([np.bincount(self.word, t, self.words) for t in self.t]).reshape(len(self.t), self.words)
        return tables - self.root_discount * self.tau

    def totals(self) -> np.ndarray:
        """This shard's known words and tokens, and for each sample the root's customers and discounts."""
        known = (np.bincount(self.word, minlength=self.words) > 0).sum()
        return np.concatenate([[known, self.n.sum()], self.t.sum(axis=1), self.root_discount * self.tau.sum(axis=1)])


_ANSWER_FIELDS = {
    "shard": "int", "chunk": "long", "first_word": "long", "first_pair": "long", "scores": "binary", "asked": "binary",
    "counts": "binary", "root": "binary", "contexts": "binary", "customers": "binary", "masses": "binary",
    "totals": "array<double>",
}


def _sample(shards: int, requests: pa.Table) -> pa.Table:
    """One shard: what its words and its chunks get, and what it has of each context.

    Rows are answers (with ``chunk``), the shard's words (with ``totals``) and its part of
    the contexts, which goes to the shard of each context.
    """
    rows = requests.to_pylist()
    keys = [_unsqueeze_rising(row["keys"]) for row in rows]
    words, places = np.unique(np.concatenate(keys), return_inverse=True)
    ends = np.cumsum([len(own) for own in keys])
    asked = np.split(places, ends[:-1])
    each = [_unsqueeze(row["each"], "<u4") for row in rows]
    contexts = np.concatenate([_unsqueeze(row["contexts"], "<u8") for row in rows])
    counts = np.concatenate([_unsqueeze(row["counts"], "<u4") for row in rows]).astype(np.int64)
    word = np.concatenate([np.repeat(own, times) for own, times in zip(asked, each)])
    known, context = np.unique(contexts, return_inverse=True)
    cells, place = np.unique(word << np.int64(CONTEXT_BITS) | context, return_inverse=True)
    n = np.bincount(place, counts, len(cells)).astype(np.int64)
    some = n > 0
    cell_word, cell_context = (cells >> CONTEXT_BITS)[some], (cells & ((1 << CONTEXT_BITS) - 1))[some]
    shard = Shard.count(cell_word, cell_context, n[some], len(words), 1 / shards)
    number = rows[0]["shard"]
    shard.sample(BURN_IN, SAMPLES, number)
    seated = np.zeros(len(cells))
    seated[some] = shard.seated()
    out, at = [], 0
    for row, own in zip(rows, asked):
        size = int(_unsqueeze(row["each"], "<u4").sum())
        answer = {name: row[name] for name in ("chunk", "first_word", "first_pair")}
        scores = _squeeze(seated[place[at : at + size]].astype("<f4"))
        out.append({"shard": number, **answer, "scores": scores, "asked": _squeeze(own.astype("<u4"))})
        at += size
    word_counts = np.bincount(cell_word, shard.n, len(words)).astype("<u4")
    out.append(
        {
            "shard": number, "asked": _squeeze_rising(words), "counts": _squeeze(word_counts),
            "root": _squeeze(shard.at_root().astype("<f4").ravel()), "totals": shard.totals(),
        }
    )
    customers = np.bincount(cell_context, shard.n, len(known)).astype("<u4")
    masses = np.array([np.bincount(cell_context, t, len(known)) for t in shard.t]) * shard.discount
    target = shard_of(known, shards)
    order = np.lexsort((known, target))
    order = order[customers[order] > 0]
    stops = np.searchsorted(target[order], np.arange(shards + 1))
    for s in np.flatnonzero(np.diff(stops)).tolist():
        own = order[stops[s] : stops[s + 1]]
        part = {"contexts": _squeeze_rising(known[own]), "customers": _squeeze(customers[own])}
        out.append({"shard": s, **part, "masses": _squeeze(masses[:, own].astype("<f4").ravel())})
    return _table(out, _ANSWER_FIELDS)


_SAMPLED_FIELDS = _ANSWER_FIELDS | _DOCUMENT_FIELDS


def _sample_or_pass(shards: int, rows: pa.Table) -> pa.Table:
    """The answers of a shard, or the documents of a chunk as they came."""
    if rows["shard"][0].is_valid:
        return _table(_sample(shards, rows).to_pylist(), _SAMPLED_FIELDS)
    return _table(rows.to_pylist(), _SAMPLED_FIELDS)


_REPLY_FIELDS = {
    "chunk": "long", "first_word": "long", "counts": "binary", "root": "binary", "customers": "binary", "masses": "binary",
}


def _reply(answers: pa.Table) -> pa.Table:
    """What chunks get of one shard's words: counts, root, and totals as contexts."""
    rows = answers.to_pylist()
    own = next(row for row in rows if row["totals"] is not None)
    words = _unsqueeze_rising(own["asked"])
    counts = _unsqueeze(own["counts"], "<u4")
    root = _unsqueeze(own["root"], "<f4").reshape(SAMPLES, -1)
    order = np.argsort(words & CONTEXT, kind="stable")
    rising = (words & CONTEXT)[order]
    customers, masses = np.zeros(len(words), np.int64), np.zeros((SAMPLES, len(words)))
    for row in rows:
        if row["customers"] is not None:
            # Every context is a word of some chunk, or the start, and so has a row here.
            at = order[np.searchsorted(rising, _unsqueeze_rising(row["contexts"]))]
            customers[at] += _unsqueeze(row["customers"], "<u4")
            masses[:, at] += _unsqueeze(row["masses"], "<f4").reshape(SAMPLES, -1)
    out = []
    for row in rows:
        if row["chunk"] is not None:
            asked = _unsqueeze(row["asked"], "<u4")
            reply = {name: row[name] for name in ("chunk", "first_word")}
            reply |= {"counts": _squeeze(counts[asked]), "root": _squeeze(root[:, asked].ravel())}
            reply |= {"customers": _squeeze(customers[asked].astype("<u4")), "masses": _squeeze(masses[:, asked].astype("<f4").ravel())}
            out.append(reply)
    return _table(out, _REPLY_FIELDS)


@dataclass
class Totals:
    """Sums over all shards; for each sample the root's customers and discounts."""

    vocabulary: float
    tokens: float
    customers: np.ndarray
    discounts: np.ndarray

    @classmethod
    def of(cls, answers: DataFrame) -> "Totals":
        """From as many numbers as there are shards times samples, summed before they are fetched."""
        sums = answers.select(F.posexplode("totals").alias("i", "x")).groupBy("i").agg(F.sum("x").alias("x")).collect()
        flat = np.zeros(2 + 2 * SAMPLES)
        for row in sums:
            flat[row["i"]] = row["x"]
        return cls(flat[0], flat[1], flat[2 : 2 + SAMPLES], flat[2 + SAMPLES :])

    def root(self, seated: np.ndarray) -> np.ndarray:
        """Probabilities at the root, from customers less discounts, a row for each sample."""
        new = (STRENGTH + self.discounts) / (self.vocabulary + 1)
        return (seated + new[:, None]) / (STRENGTH + self.customers)[:, None]


def probabilities(
    seated: np.ndarray, word: np.ndarray, context: np.ndarray, root: np.ndarray, customers: np.ndarray, masses: np.ndarray
) -> np.ndarray:
    """Predictive probabilities of pairs, averaged over samples.

    ``seated`` are a pair's mean customers less discounts; ``root`` has a row of
    probabilities of words and ``masses`` one of discounts of contexts for each sample.
    """
    new = ((STRENGTH + masses[:, context]) * root[:, word]).mean(axis=0)
    return (seated + new) / (STRENGTH + customers[context])


_SCORE_FIELDS = {
    "doc_id": "long", "held_out": "boolean", "n_tokens": "long", "n_known": "long", "train_tokens": "long",
    "base_score": "double", "score": "double",
}


def _score(totals: Totals, documents: pa.Table, replies: pa.Table) -> pa.Table:
    """Scores of a chunk's documents."""
    row = documents.to_pylist()[0]
    frequent, lengths = _unsqueeze(row["frequent"], "<u4").astype(np.int64), np.array(row["lengths"])
    distinct, place = pairs_of(frequent[_unsqueeze(row["tokens"], "<u4")], lengths, row["first"])
    size, pairs = len(frequent), len(distinct)
    word, before = distinct >> 32, distinct & 0xFFFFFFFF
    counts, customers = np.zeros(size, np.int64), np.zeros(size, np.int64)
    root, masses, seated = np.zeros((SAMPLES, size)), np.zeros((SAMPLES, size)), np.zeros(pairs)
    for reply in replies.to_pylist():
        if reply["scores"] is not None:
            scores = _unsqueeze(reply["scores"], "<f4")
            seated[reply["first_pair"] : reply["first_pair"] + len(scores)] = scores
            continue
        own = _unsqueeze(reply["counts"], "<u4")
        at = slice(reply["first_word"], reply["first_word"] + len(own))
        counts[at], customers[at] = own, _unsqueeze(reply["customers"], "<u4")
        root[:, at] = _unsqueeze(reply["root"], "<f4").reshape(SAMPLES, -1)
        masses[:, at] = _unsqueeze(reply["masses"], "<f4").reshape(SAMPLES, -1)
    score = np.log10(probabilities(seated, word, before, totals.root(root), customers, masses))
    base = np.log10((counts + PSEUDO_COUNT) / (totals.tokens + PSEUDO_COUNT * (totals.vocabulary + 1)))[word]
    starts = np.cumsum(lengths) - lengths
    known = (counts[word] > 0).astype(np.int64)
    known, base, score = (np.add.reduceat(values[place], starts) for values in (known, base, score))
    out = {
        "doc_id": row["doc_id"], "held_out": [not learned for learned in row["learn"]], "n_tokens": lengths,
        "n_known": known, "train_tokens": np.full(len(lengths), int(totals.tokens)), "base_score": base, "score": score,
    }
    return pa.table([pa.array(out[name], _KINDS[kind]) for name, kind in _SCORE_FIELDS.items()], list(_SCORE_FIELDS))


def score_documents(docs: DataFrame, learn_from: Column, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """log10 probability of every text under a model of the rows where ``learn_from``.

    Returns ``doc_id``, ``held_out`` (not learned from), ``n_tokens`` (words and an end),
    ``n_known`` (seen in training), ``train_tokens``, ``base_score`` (words drawn alone,
    counts raised by 0.1, one unknown word) and ``score``. Words are cut at ASCII white
    space, A-Z in lower case, and known by a 64-bit hash, contexts by 40 bits of it. The
    perplexity of documents is ``10 ** (-sum(score) / sum(n_tokens))``.

    Null and empty texts are an end only. Repeated rows and ids are separate documents;
    null ids are carried along, a null condition counts as false. An empty table gives
    an empty one. Without rows to learn from every word is unknown. Other columns of
    ``docs`` aren't read, so their names can't clash.

    There is a shard for each ``SHARD_BYTES`` of text; a chunk and a shard are one task's.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(text).cast("string").alias("text"),
        F.coalesce(learn_from, F.lit(False)).alias("learn"),
    )
    size = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    shards = max(1, -(-size // SHARD_BYTES))
    spark, path = docs.sparkSession, shared_folder(docs.sparkSession, "lm-shards")
    chunks = rows.mapInArrow(partial(_chunks, shards, CHUNK_BYTES), _schema(_CHUNK_FIELDS))
    # Requests meet at their shard; documents, which no text is read for again, pass alone.
    alone = F.when(F.col("shard").isNull(), F.col("chunk"))
    sampled = chunks.groupBy("shard", alone).applyInArrow(lambda table: _sample_or_pass(shards, table), _schema(_SAMPLED_FIELDS))
    kind = F.when(F.col("lengths").isNull(), "answers").otherwise("documents").alias("kind")
    sampled.select("*", kind).write.option("compression", "zstd").partitionBy("kind").parquet(path)
    sampled = spark.read.schema(f"{_schema(_SAMPLED_FIELDS)}, kind string").parquet(path)
    answers = sampled.where("kind = 'answers'").select(*_ANSWER_FIELDS)
    totals = Totals.of(answers)
    release(spark)  # the requests: Spark holds a shuffle until another job has run
    scores = answers.where("chunk is not null").select("chunk", "first_pair", "scores")
    replies = answers.drop("scores", "first_pair").groupBy("shard").applyInArrow(_reply, _schema(_REPLY_FIELDS))
    replies = replies.unionByName(scores, allowMissingColumns=True)
    texts = sampled.where("kind = 'documents'").select("chunk", *_DOCUMENT_FIELDS)
    both = texts.groupBy("chunk").cogroup(replies.groupBy("chunk"))
    return both.applyInArrow(lambda one, other: _score(totals, one, other), _schema(_SCORE_FIELDS))
