"""Token counts without token ids.

Pieces never cross the boundary between two pre-tokens, so a text's token count is the
sum over its pre-tokens. Each distinct pre-token is counted once, the counts are joined
to the pre-token frequencies of each document, and summed. The join is a lookup inside
the task that holds the document: nothing is shuffled, a hot source or word is no key
that rows meet at, and memory is bounded by the table of remembered pre-tokens.
"""

import re
from collections import Counter
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache
from itertools import chain

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SPACE = "▁"


class PieceTable:
    """Distinct pre-tokens of a SentencePiece model and their pieces.

    ``split(text)`` cuts where no piece can cross: before a run of spaces. That holds
    for BPE models whose normaliser is the identity and whose pieces have the space
    mark only at their start; for any other model a text is one pre-token.
    """

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trainer, rules = model.trainer_spec, model.normalizer_spec
        own = model.SentencePiece.USER_DEFINED
        self.cuts = (
            trainer.model_type == trainer.BPE
            and not trainer.treat_whitespace_as_suffix
            and not rules.precompiled_charsmap
            and rules.escape_whitespaces
            and not rules.remove_extra_whitespaces
            and not any(SPACE in p.piece.lstrip(SPACE) or p.type == own for p in model.pieces)
        )
        self.prefix = " " if self.cuts and rules.add_dummy_prefix else ""
        if self.cuts:
            rules.add_dummy_prefix = False
        self.processor = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
        self.find = re.compile(f"[ {SPACE}]*[^ {SPACE}]+|[ {SPACE}]+").findall

    def split(self, text: str) -> list[str]:
        if not text:
            return []
        if self.prefix and SPACE not in text:
            parts = text.split(" ")
            if "" not in parts:
                return [" " + part for part in parts]  # as the expression does, in less time
        return self.find(self.prefix + text) if self.cuts else [text]

    def all_ids(self, pre_tokens: list[str]) -> list[list[int]]:
        return self.processor.encode(pre_tokens, num_threads=1)

    def counts(self, pre_tokens: list[str]) -> list[int]:
        return list(map(len, self.all_ids(pre_tokens)))


class JsonTable:
    """The same for a file of the tokenizers library.

    Its own normaliser and pre-tokeniser make the pre-tokens. A text that holds the
    string of an added token is one pre-token, encoded by the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]

    def split(self, text: str) -> list[tuple[str, bool]]:
        cut = self.tokenizer.pre_tokenizer
        if not text:
            return []
        if cut is None or any(token in text for token in self.added):
            return [(text, True)]
        if self.tokenizer.normalizer is not None:
            text = self.tokenizer.normalizer.normalize_str(text)
        return [(piece, False) for piece, _ in cut.pre_tokenize_str(text)]

    def count(self, pre_token: tuple[str, bool]) -> int:
        text, whole = pre_token
        if whole:
            return len(self.tokenizer.encode(text, add_special_tokens=False).ids)
        return len(self.tokenizer.model.tokenize(text))

    def counts(self, pre_tokens: list[tuple[str, bool]]) -> list[int]:
        return list(map(self.count, pre_tokens))


class Distinct:
    """Values of pre-tokens, each computed once while it is remembered.

    ``values`` gets a list of pre-tokens. At most ``size`` of them are remembered, and
    as many again that were asked for before the last ``size`` new ones.
    """

    def __init__(self, values: Callable[[list], list], size: int = 250_000):
        self.values, self.size, self.young, self.old = values, size, {}, {}

    def table(self, pre_tokens: Iterable) -> dict:
        """Values of all ``pre_tokens`` and maybe of others."""
        wanted = set(pre_tokens)
        if len(self.young) > self.size:
            self.young, self.old = {}, self.young
        missing = wanted.difference(self.young)
        known = [one for one in missing if one in self.old]
        self.young.update((one, self.old[one]) for one in known)
        missing = list(missing.difference(known))
        self.young.update(zip(missing, self.values(missing)))
        return self.young


@lru_cache(maxsize=4)
def _table(path: str) -> tuple[Callable, Distinct]:
    table = JsonTable(path) if path.endswith(".json") else PieceTable(path)
    return table.split, Distinct(table.counts)


def token_count(path: str) -> Callable[[Column | str], Column]:
    """A column function: tokens of a text; 0 for null."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        split, distinct = _table(path)
        for texts in batches:
            totals = []
            for at in range(0, len(texts), 256):
                frequencies = [Counter(split(text or "")) for text in texts.iloc[at : at + 256]]
                counts = distinct.table(chain.from_iterable(frequencies))
                totals += [sum(counts[one] * times for one, times in own.items()) for own in frequencies]
            yield pd.Series(totals, dtype="int64")

    return count


def count_tokens(docs: DataFrame, path: str, limit: int = 4096, text: str = "text") -> DataFrame:
    """``docs`` with ``n_bytes``, ``n_tokens`` and ``over_limit`` (more than ``limit``).

    ``path`` names a SentencePiece ``.model`` or a tokenizers ``.json`` file that every
    executor has. Counts equal the library's for the whole text, without begin, end or
    added special tokens. Null text counts as empty. Rows aren't grouped, so repeated
    rows, ties and null keys need no rule; an empty table gives an empty one. Columns of
    ``docs`` that have the new names are replaced.
    """
    size = F.coalesce(F.octet_length(text).cast("long"), F.lit(0).cast("long"))
    out = docs.withColumns({"n_bytes": size, "n_tokens": token_count(path)(F.col(text))})
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
