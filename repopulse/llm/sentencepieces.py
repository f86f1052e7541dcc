"""SentencePiece encoding and decoding on the tokenizers library.

The model's protobuf is parsed and rebuilt as a tokenizer: its normaliser, the mark for
spaces, the scores (as they are for unigram models, as the order of merges for BPE) and
byte fallback. Batches are encoded and decoded in threads, as many as a task has cores,
and every text's ids are verified against the SentencePiece library.
"""

import os
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache, partial
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import SPACE, Distinct, PieceTable

#: Texts are encoded in slices of about so many characters.
SLICE = 1 << 20
#: Distinct words that are encoded as one text.
TOGETHER = 256


def _model(path: str):
    from sentencepiece import sentencepiece_model_pb2

    model = sentencepiece_model_pb2.ModelProto()
    with open(path, "rb") as file:
        model.ParseFromString(file.read())
    return model


def merges(pieces: dict[str, int], scores: list[float]) -> list[tuple[str, str]]:
    """Pairs of pieces that make a piece, those of the highest score first."""
    found = []
    for piece, number in pieces.items():
        for cut in range(1, len(piece)):
            left, right = pieces.get(piece[:cut]), pieces.get(piece[cut:])
            if left is not None and right is not None:
                found.append((-scores[number], left, right, piece[:cut], piece[cut:]))
    return [(left, right) for *_, left, right in sorted(found)]


def rebuild(path: str):
    """The ``tokenizers.Tokenizer`` of a SentencePiece model of type BPE or unigram."""
    from tokenizers import Regex, Tokenizer, decoders, models, normalizers

    model = _model(path)
    trainer, rules, kinds = model.trainer_spec, model.normalizer_spec, model.SentencePiece
    if trainer.treat_whitespace_as_suffix or not rules.escape_whitespaces:
        raise ValueError("only models that mark spaces at the start of a word are supported")
    # Control pieces and bytes are never found in a text, they only have ids.
    plain = {p.piece: i for i, p in enumerate(model.pieces) if p.type in (kinds.NORMAL, kinds.USER_DEFINED)}
    everything = {p.piece: i for i, p in enumerate(model.pieces)}
    scores = [p.score for p in model.pieces]
    unknown = next((p.piece for p in model.pieces if p.type == kinds.UNKNOWN), None)
    if trainer.model_type == trainer.BPE:
        own = models.BPE(
            everything, merges(plain, scores), unk_token=unknown, fuse_unk=True, byte_fallback=trainer.byte_fallback
        )
    elif trainer.model_type == trainer.UNIGRAM:
        least = min(scores) - 10
        vocabulary = [(p.piece, p.score if p.type != kinds.CONTROL else least) for p in model.pieces]
        own = models.Unigram(vocabulary, everything[unknown], trainer.byte_fallback)
    else:
        raise ValueError("only BPE and unigram models are supported")
    tokenizer = Tokenizer(own)
    steps = []
    if rules.precompiled_charsmap:
        steps.append(normalizers.Precompiled(rules.precompiled_charsmap))
    if rules.remove_extra_whitespaces:
        steps += [normalizers.Strip(), normalizers.Replace(Regex(" {2,}"), " ")]
    if rules.add_dummy_prefix:
        steps.append(normalizers.Prepend(SPACE))
    tokenizer.normalizer = normalizers.Sequence([*steps, normalizers.Replace(" ", SPACE)])
    steps = [decoders.Replace(SPACE, " "), decoders.ByteFallback(), decoders.Fuse()]
    if rules.add_dummy_prefix:
        steps.append(decoders.Strip(" ", 1, 0))
    tokenizer.decoder = decoders.Sequence(steps)
    return tokenizer


class Codec:
    """Encodes and decodes batches of texts with the rebuilt tokenizer.

    If pieces can't cross the boundary between words, distinct words are encoded once
    and a text's ids are put together from theirs; other models encode whole texts.
    """

    def __init__(self, path: str, threads: int):
        import sentencepiece
        from tokenizers import decoders, normalizers, pre_tokenizers

        # Read by the thread pool when it starts, which is at this process's first batch.
        os.environ["RAYON_NUM_THREADS"] = str(threads)
        os.environ["TOKENIZERS_PARALLELISM"] = "true" if threads > 1 else "false"
        self.threads, self.tokenizer = threads, rebuild(path)
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        self.table = PieceTable(path)
        if self.table.cuts:
            self.words = rebuild(path)
            # Words with the space before them, one by one or many in a row.
            self.words.normalizer = normalizers.Replace(" ", SPACE)
            self.words.pre_tokenizer = pre_tokenizers.Split(SPACE, "merged_with_next")
            self.words.decoder = decoders.Sequence([decoders.ByteFallback(), decoders.Fuse()])
            self.single = rebuild(path)
            self.single.normalizer = self.words.normalizer
            pieces = map(self.library.id_to_piece, range(self.library.get_piece_size()))
            self.starts = np.array([piece.startswith(SPACE) for piece in pieces])
            self.distinct = Distinct(self.records)

    def records(self, words: list[str]) -> list[bytes | tuple[bytes, str]]:
        """Packed ids of each word, and what they decode to if that is another word.

        Words with one space, before them, are encoded and decoded many at a time: pieces
        that start with the space mark tell them apart.
        """
        plain = [word for word in words if word[0] == " " and word.count(" ") == 1 and SPACE not in word]
        joined = ["".join(plain[at : at + TOGETHER]) for at in range(0, len(plain), TOGETHER)]
        rows = [one.ids for one in self.words.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.fromiter(chain.from_iterable(rows), "<u4")
        cuts = np.flatnonzero(self.starts[ids])
        back = [text.replace(SPACE, " ") for text in self.words.decode_batch(rows, skip_special_tokens=False)]
        found = {}
        if len(cuts) == len(plain) and back == joined:
            raw, stops = ids.tobytes(), [*(4 * cuts[1:]).tolist(), 4 * len(ids)]
            found = {word: raw[4 * at : stop] for word, at, stop in zip(plain, cuts.tolist(), stops)}
        others = [word for word in words if word not in found]
        rows = [one.ids for one in self.single.encode_batch_fast(others, add_special_tokens=False)]
        back = self.words.decode_batch(rows, skip_special_tokens=False)
        for word, own, text in zip(others, rows, back):
            packed, spelled = array("I", own).tobytes(), text.replace(SPACE, " ")
            found[word] = packed if spelled == word else (packed, spelled)
        return [found[word] for word in words]

    def known_words(self, texts: list[str]) -> list[tuple[list[str], list[bytes | tuple[bytes, str]]]]:
        """The words of each text and their records, each distinct word looked up once."""
        split = [self.table.split(text) for text in texts]
        known = self.distinct.table(chain.from_iterable(split))
        return [(words, list(map(known.__getitem__, words))) for words in split]

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        if self.table.cuts:
            return [np.frombuffer(_packed(own), "<u4") for _, own in self.known_words(texts)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        # The library gives no ids for no text; the prefix would.
        return [np.array(one.ids if text else [], "<u4") for one, text in zip(found, texts)]

    def round_trip(self, texts: list[str]) -> tuple[list[np.ndarray], list[str]]:
        """The ids of each text, and what they decode to: the words' own, one after another."""
        if not self.table.cuts:
            ids = self.encode(texts)
            return ids, self.decode([own.tolist() for own in ids])
        ids, back = [], []
        for text, (words, own) in zip(texts, self.known_words(texts)):
            ids.append(np.frombuffer(_packed(own), "<u4"))
            if tuple not in map(type, own):  # every word decodes to itself, and the words are the text
                back.append(text)
                continue
            spelled = [word if type(one) is bytes else one[1] for word, one in zip(words, own)]
            back.append("".join(spelled).removeprefix(self.table.prefix))
        return ids, back

    def parity(self, texts: list[str], ids: list[np.ndarray]) -> list[bool]:
        """Whether the library gives the same ids for each whole text."""
        theirs = self.library.encode(texts, num_threads=self.threads)
        return [own.tobytes() == array("I", other).tobytes() for own, other in zip(ids, theirs)]

    def decode(self, ids: list) -> list[str]:
        return self.tokenizer.decode_batch([list(own) for own in ids], skip_special_tokens=False)


def _packed(records: list[bytes | tuple[bytes, str]]) -> bytes:
    try:
        return b"".join(records)
    except TypeError:
        return b"".join([one if type(one) is bytes else one[0] for one in records])


@lru_cache(maxsize=2)
def _codec(path: str, threads: int) -> Codec:
    return Codec(path, threads)


def _slices(texts: list[str]) -> Iterator[tuple[int, int]]:
    start = total = 0
    for i, text in enumerate(texts):
        total += len(text)
        if total >= SLICE:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def _encode(path: str, threads: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = _codec(path, threads)
    for batch in batches:
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for start, stop in _slices(texts):
            ids = codec.encode(texts[start:stop])
            columns = [batch.column(0).slice(start, stop - start), pa.array(ids, pa.list_(pa.int32()))]
            columns.append(pa.array(codec.parity(texts[start:stop], ids)))
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids", "parity"])


def encode(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, ids, parity): a text's ids, and whether the SentencePiece library agrees.

    ``path`` names the model on every executor. No begin or end is added, and strings
    of control pieces in a text are text. Null and empty texts have no ids. Rows are
    encoded alone: repeated rows, ties and null keys need no rule, an empty table gives
    an empty one, nothing is shuffled. Other columns aren't read.
    """
    threads = int(docs.sparkSession.conf.get("spark.task.cpus", "1"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(partial(_encode, path, threads), "doc_id long, ids array<int>, parity boolean")


def _decode(path: str, threads: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = _codec(path, threads)
    for batch in batches:
        texts = codec.decode([own or [] for own in batch.column(1).to_pylist()])
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])


def decode(encoded: DataFrame, path: str, doc_id: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(doc_id, text) of a table of ids; null and empty lists give an empty text."""
    threads = int(encoded.sparkSession.conf.get("spark.task.cpus", "1"))
    rows = encoded.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(ids).cast("array<int>").alias("ids"))
    return rows.mapInArrow(partial(_decode, path, threads), "doc_id long, text string")


def _round_trip(path: str, threads: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    codec = _codec(path, threads)
    for batch in batches:
        texts = [text or "" for text in batch.column(1).to_pylist()]
        for start, stop in _slices(texts):
            part = texts[start:stop]
            ids, back = codec.round_trip(part)
            columns = [
                batch.column(0).slice(start, stop - start),
                pa.array([len(own) for own in ids], pa.int64()),
                pa.array([zlib.crc32(own.tobytes()) for own in ids], pa.int64()),
                pa.array(codec.parity(part, ids)),
                pa.array([own == other for own, other in zip(part, back)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_ids", "ids_crc32", "parity", "round_trip"])


def verify(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, n_ids, ids_crc32, parity, round_trip): encoding and decoding in one pass.

    ``ids_crc32`` is of little-endian 32-bit ids; ``round_trip`` says that decoding gives
    the text back, which holds for models with byte fallback and an identity normaliser
    but for texts that hold the space mark itself. Odd rows are as for ``encode``.
    """
    threads = int(docs.sparkSession.conf.get("spark.task.cpus", "1"))
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_ids long, ids_crc32 long, parity boolean, round_trip boolean"
    return rows.mapInArrow(partial(_round_trip, path, threads), schema)
