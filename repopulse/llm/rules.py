"""Quality rules by tokeniser fertility.

A public vocabulary breaks ordinary prose of a language into pieces of a steady length
and variety. Text that it breaks otherwise is suspect: capitals and symbols cost more
pieces per character, foreign bytes fall back to byte pieces, repeated words use few
pieces. Each document is measured once, and its measures must lie in the bands of its
language, or of its script where the language has none. Bands are fixed limits of a
vocabulary, so a verdict depends on the document alone: neither on how many others are
like it nor on how many of them are junk. Nothing is shuffled.
"""

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, fields
from functools import lru_cache
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import free_name
from .tokens import Distinct, PieceTable

WORDS = re.compile(r"[^\x20\x09-\x0D]+").findall
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEATED = 50  # percent of the words
#: Entropy in bits that prose of n tokens reaches is about TOP * log2(n) / (log2(n) + BEND);
#: evenness is entropy over that, so texts of any length share a band.
TOP, BEND = 9.15, 3.75


@dataclass(frozen=True)
class Band:
    """Limits of one language or script: characters per token, evenness, most bytes."""

    low_chars: float
    high_chars: float
    low_evenness: float
    high_evenness: float
    most_bytes: float


#: Bands for the 32,000 pieces of the public BPE model with byte fallback. Of languages:
#: 0.92 to 1.2 of the usual characters per token. Of scripts: what any prose in them keeps.
LANGUAGES = {
    "en": Band(2.42, 3.16, 0.94, 1.15, 0.06),
    "de": Band(2.41, 3.15, 0.94, 1.15, 0.06),
    "fr": Band(2.17, 2.83, 0.93, 1.15, 0.06),
    "es": Band(2.11, 2.76, 0.94, 1.15, 0.06),
}
SCRIPTS = {
    "latin": Band(1.7, 5.5, 0.92, 1.25, 0.1),
    "greek": Band(0.8, 4.0, 0.75, 1.3, 0.1),
    "cyrillic": Band(1.2, 4.0, 0.85, 1.3, 0.1),
}
OTHER = Band(0.4, 6.0, 0.7, 1.4, 0.35)
#: Unicode blocks where a script's letters start, and the end of the last: fixed values.
BLOCKS = [
    (0x41, "latin"), (0x370, "greek"), (0x400, "cyrillic"), (0x530, "armenian"), (0x590, "hebrew"), (0x600, "arabic"),
    (0x900, "indic"), (0xE00, "thai"), (0x1000, "other"), (0x1E00, "latin"), (0x1F00, "greek"), (0x2000, None),
    (0x3040, "kana"), (0x3100, "han"), (0xAC00, "hangul"), (0xD800, None), (0xF900, "han"), (0xFB00, "other"),
]
BASE = {"n_words": "long", "word_chars": "long", "n_symbols": "long", "n_dup_lines": "long", "n_repeat_words": "long"}
FERTILITY = {
    "n_tokens": "long", "chars_per_token": "double", "byte_share": "double", "entropy": "double", "evenness": "double",
    "script": "string",
}
STARTS, NAMES = np.array([start for start, _ in BLOCKS]), sorted({name for _, name in BLOCKS if name})
NUMBERS = np.array([len(NAMES), *(NAMES.index(name) if name else len(NAMES) for _, name in BLOCKS)])
IS_LETTER = re.compile("[^\\W\\d_]")


def script_of(text: str) -> str:
    """The script most letters of a text are of; of equally many the first by name."""
    if text.isascii():
        return "latin" if IS_LETTER.search(text) else "other"
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    points = points[(points >= 0x80) | ((points | 0x20) - 0x61 < 26)]
    times = np.bincount(NUMBERS[np.searchsorted(STARTS, points, side="right")], minlength=len(NAMES) + 1)[:-1]
    return NAMES[int(times.argmax())] if times.any() else "other"


def base_measures(text: str) -> tuple[int, int, int, int, int]:
    """Values of ``BASE`` for one text."""
    words = WORDS(text)
    symbols = sum(map(text.count, SYMBOLS))
    lines = text.split("\n")
    repeated_lines = 0
    if len(set(lines)) < len(lines):
        times = Counter(lines)
        repeated_lines = sum(n - 1 for line, n in times.items() if n > 1 and WORDS(line))
    windows = list(zip(words, words[1:], words[2:]))
    repeated_words = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        twice = np.fromiter((times[window] > 1 for window in windows), bool, len(windows))
        covered = np.zeros(len(words), bool)
        for shift in range(3):
            covered[shift : shift + len(windows)] |= twice
        repeated_words = int(covered.sum())
    return len(words), sum(map(len, words)), symbols, repeated_lines, repeated_words


class Fertility:
    """Values of ``FERTILITY`` for texts, each distinct pre-token encoded once."""

    def __init__(self, path: str):
        self.table = PieceTable(path)
        size = self.table.processor.get_piece_size()
        self.size = size
        self.kind = np.uint16 if size <= 1 << 16 else np.uint32
        self.is_byte = np.array([self.table.processor.is_byte(i) for i in range(size)])
        self.pieces = Distinct(self.encode)

    def encode(self, pre_tokens: list[str]) -> list[bytes]:
        return [np.array(ids, self.kind).tobytes() for ids in self.table.all_ids(pre_tokens)]

    def measure(self, texts: list[str]) -> list[tuple[int, float, float, float, float, str]]:
        split = [self.table.split(text) for text in texts]
        pieces = self.pieces.table(chain.from_iterable(split))
        return [self.one(text, b"".join(map(pieces.__getitem__, own))) for text, own in zip(texts, split)]

    def one(self, text: str, raw: bytes) -> tuple[int, float, float, float, float, str]:
        ids = np.frombuffer(raw, self.kind)
        n = len(ids)
        if not n:
            return 0, 0.0, 0.0, 0.0, 0.0, script_of(text)
        counts = np.bincount(ids)
        counts = counts[counts > 0]
        bits = float(np.log2(n))
        entropy = bits - float((counts * np.log2(counts)).sum()) / n
        evenness = entropy * (bits + BEND) / (TOP * bits) if n > 1 else 0.0
        return n, len(text) / n, float(self.is_byte[ids].mean()), entropy, evenness, script_of(text)


@lru_cache(maxsize=2)
def _fertility(path: str) -> Fertility:
    return Fertility(path)


def measures(path: str):
    """A column function: a struct of the values of ``BASE`` and ``FERTILITY``."""
    names = {**BASE, **FERTILITY}

    @F.pandas_udf(", ".join(f"{name} {kind}" for name, kind in names.items()))
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        fertility = _fertility(path)
        for texts in batches:
            texts = [text or "" for text in texts]
            rows = []
            for at in range(0, len(texts), 256):
                part = texts[at : at + 256]
                rows += [base_measures(t) + own for t, own in zip(part, fertility.measure(part))]
            yield pd.DataFrame(rows, columns=list(names))

    return measure


def _limits(bands: dict[str, Band]) -> Column:
    """A map from a language's or script's name to its band."""
    if not bands:
        return F.lit(None).cast(f"map<string, {BAND}>")
    entries = [(F.lit(name), _band(band)) for name, band in bands.items()]
    return F.create_map(*(part for entry in entries for part in entry))


def _band(band: Band) -> Column:
    return F.struct(*(F.lit(float(getattr(band, field.name))).alias(field.name) for field in fields(Band)))


BAND = f"struct<{', '.join(f'{field.name}: double' for field in fields(Band))}>"


def judge_quality(
    docs: DataFrame,
    path: str,
    carry: list[str] | None = None,
    text: str = "text",
    lang: str = "lang",
    languages: dict[str, Band] = LANGUAGES,
    scripts: dict[str, Band] = SCRIPTS,
    other: Band = OTHER,
) -> DataFrame:
    """``docs`` (its columns ``carry``, or all) with measures, ``base_failed`` and ``kept``.

    ``path`` names a SentencePiece model, for which the bands hold. A document fails the
    base rules if it has fewer than ``MIN_WORDS`` words or more than ``MAX_REPEATED``
    percent of them in repeated three-word windows. It is kept if it doesn't, and if its
    characters per token, the evenness of its pieces and its share of byte pieces lie
    within its band: that of its language in ``languages``, else that of the script of
    most of its letters in ``scripts``, else ``other``. A null language has none.

    Null and empty texts have no words and fail; texts are measured whole at any length.
    Rows are judged alone: repeated rows are judged alike, null keys are carried along, a
    single document of a language is judged like a million; an empty table gives an empty
    one. Columns of ``docs`` that have the names of new ones are replaced; any others stay,
    whatever they are called.
    """
    names = [*BASE, *FERTILITY, "base_failed", "kept"]
    carry = [name for name in (docs.columns if carry is None else carry) if name not in names]
    own, measure = free_name(docs, "own_lang"), free_name(docs, "measure")
    # Evaluated once, whatever is selected or filtered above.
    found = measures(path).asNondeterministic()(F.col(text)).alias(measure)
    measured = docs.select(*(F.col(f"`{name}`") for name in carry), F.col(lang).alias(own), found)
    value = {name: F.col(f"{measure}.{name}") for name in (*BASE, *FERTILITY)}
    words = value["n_words"]
    failed = (words < MIN_WORDS) | (100 * value["n_repeat_words"] > MAX_REPEATED * words)
    by_lang, by_script = F.try_element_at(_limits(languages), own), F.try_element_at(_limits(scripts), value["script"])
    band = F.coalesce(by_lang, by_script, _band(other))
    inside = (
        value["chars_per_token"].between(band["low_chars"], band["high_chars"])
        & value["evenness"].between(band["low_evenness"], band["high_evenness"])
        & (value["byte_share"] <= band["most_bytes"])
    )
    judged = [*(column.alias(name) for name, column in value.items()), failed.alias("base_failed"), (~failed & inside).alias("kept")]
    return measured.select(*(F.col(f"`{name}`") for name in carry), *judged)
