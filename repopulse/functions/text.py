"""Text expressions used before encoding."""

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


# Bytes of texts that are counted at once.
_BYTES_AT_ONCE = 1 << 20


def missing_if_empty(column: str) -> Column:
    """NULL for the empty text, which readers treat as missing."""
    return F.nullif(F.col(column), F.lit(""))


def letter_counts(column: str | Column) -> Column:
    """How often each of a-z occurs, ignoring case, as 26 floats.

    Built-in functions need a replacement pass over the text per letter; counting the
    bytes of an Arrow batch is one pass, and 20 times faster on long texts.
    """

    at_once = _BYTES_AT_ONCE

    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def count(texts):
        import numpy as np
        import pyarrow as pa

        octets = texts.cast(pa.large_binary())
        ends = np.frombuffer(octets.buffers()[1], dtype="int64")[octets.offset :][: len(texts) + 1]
        data = np.frombuffer(octets.buffers()[2] or b"", dtype="uint8")
        counts = np.zeros((len(texts), 26), dtype="int64")
        # The numbers beside the text's bytes take 20 times their room, so there are few at a time.
        for start in range(ends[0], ends[-1], at_once):
            stop = min(start + at_once, ends[-1])
            first, last = np.searchsorted(ends, start, "right") - 1, np.searchsorted(ends, stop, "left")
            part = data[start:stop]
            letter = (part | 32) - ord("a")  # lower case; other bytes land beyond z
            letter[part < ord("A")] = 255
            rows = np.repeat(np.arange(last - first), np.diff(np.clip(ends[first : last + 1], start, stop)))
            wanted = letter < 26
            found = np.bincount(rows[wanted] * 26 + letter[wanted], minlength=(last - first) * 26)
            counts[first:last] += found.reshape(-1, 26)
        offsets = pa.array(np.arange(0, counts.size + 1, 26, dtype="int32"))
        return pa.ListArray.from_arrays(offsets, pa.array(counts.ravel().astype("float32")), mask=texts.is_null())

    return count(column)


def windows(column: str | Column, size: int, overlap: int) -> Column:
    """Windows of ``size`` characters that share ``overlap``; the last one ends the text.

    The last window is the first one that reaches the end of the text, so no window lies
    wholly inside its predecessor. ``substring`` would walk from the start of the text for
    every window; a slice in an Arrow batch doesn't.
    """

    @F.arrow_udf(T.ArrayType(T.StringType()))
    def cut(texts):
        import pyarrow as pa

        step, found = size - overlap, []
        for text in texts.to_pylist():
            last = max(len(text or "") - overlap, 1)
            found.append(None if text is None else [text[at : at + size] for at in range(0, last, step)])
        return pa.array(found, pa.list_(pa.string()))

    return cut(column)
