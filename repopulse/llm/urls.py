"""URL filter over a sorted array of digests.

A rule is a host and a start of a path. All rules' keys (``host/path``) are hashed to
64 bits with xxhash and sorted; the array, the keys and their verdicts make one file
that Spark hands to every executor, where it is memory-mapped. A URL is probed with
every suffix of its host joined to every start of its path that has the length of some
rule's path; all probes of a batch take part in one binary search, and an equal digest
counts only if the stored key is equal.
"""

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark import SparkFiles
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import shared_file

ALLOW, BLOCK = "allow", "block"
LOWER = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def digest_file(rules: list[tuple[str, str, str]]) -> bytes:
    """The filter's file. ``rules`` are (verdict, host, path); a path starts with ``/``.

    If a rule occurs twice, ``block`` wins. Layout: the length of a JSON header, the
    header padded to 8 bytes, sorted digests, ends of the keys, verdicts, keys.
    """
    verdicts: dict[bytes, int] = {}
    for verdict, host, path in rules:
        if verdict not in (ALLOW, BLOCK) or not host or not path.startswith("/"):
            raise ValueError(f"not a rule: {verdict} {host}{path}")
        key = (host.translate(str.maketrans(*LOWER)) + path).encode()
        verdicts[key] = max(verdicts.get(key, 0), int(verdict == BLOCK))
    digests = np.array([xxhash.xxh64_intdigest(key) for key in verdicts], "<u8")
    order = np.argsort(digests, kind="stable")
    given = list(verdicts)
    keys = [given[i] for i in order]
    paths = sorted({len(key) - key.index(b"/") for key in keys})
    header = json.dumps({"rules": len(keys), "paths": paths}).encode()
    header += b" " * (-len(header) % 8)
    ends = np.cumsum([len(key) for key in keys], dtype="<i8")
    blocks = np.array([verdicts[key] for key in keys], "<i8")
    parts = [np.array([len(header)], "<i8"), header, digests[order], ends, blocks, b"".join(keys)]
    return b"".join(part if isinstance(part, bytes) else part.tobytes() for part in parts)


class DigestArray:
    """The file, memory-mapped: the pages that are probed are all that is read."""

    def __init__(self, path: str):
        raw = np.memmap(path, np.uint8, "r")
        size = int(raw[:8].view("<i8")[0])
        header = json.loads(raw[8 : 8 + size].tobytes())
        n, at = header["rules"], 8 + size
        self.paths = header["paths"]
        self.digests = raw[at : at + 8 * n].view("<u8")
        self.ends = raw[at + 8 * n : at + 16 * n].view("<i8")
        self.blocks = raw[at + 16 * n : at + 24 * n].view("<i8")
        self.keys = raw[at + 24 * n :]

    def key(self, i: int) -> bytes:
        start = int(self.ends[i - 1]) if i else 0
        return self.keys[start : int(self.ends[i])].tobytes()

    def probes(self, host: str, path: str) -> list[bytes]:
        """Keys of the rules that could fit, longest first; of equal ones the longer host."""
        suffixes, rest = [host], host
        while "." in rest:
            rest = rest.partition(".")[2]
            suffixes.append(rest)
        raw = path.encode()
        starts = [raw[:n] for n in self.paths if n <= len(raw)]
        found = [(suffix.encode(), start) for suffix in suffixes if suffix for start in starts]
        found.sort(key=lambda pair: (-len(pair[0]) - len(pair[1]), -len(pair[0])))
        return [suffix + start for suffix, start in found]

    def lookup(self, probes: list[bytes]) -> np.ndarray:
        """Index of each probe's rule, -1 without one."""
        wanted = np.array([xxhash.xxh64_intdigest(probe) for probe in probes], "<u8")
        first = np.searchsorted(self.digests, wanted)
        last = np.searchsorted(self.digests, wanted, side="right")
        found = np.full(len(probes), -1)
        for i in np.flatnonzero(first < last):
            same = (j for j in range(first[i], last[i]) if self.key(j) == probes[i])
            found[i] = next(same, -1)
        return found


@lru_cache(maxsize=4)
def _mapped(name: str) -> DigestArray:
    return DigestArray(SparkFiles.get(name))


def _judge(name: str, batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
    array = _mapped(name)
    for hosts, paths in batches:
        per_url = [array.probes(host, path) for host, path in zip(hosts, paths)]
        flat = array.lookup([probe for probes in per_url for probe in probes])
        rules, verdicts, at = [], [], 0
        for probes in per_url:
            own = flat[at : at + len(probes)]
            at += len(probes)
            hit = next((i for i in own if i >= 0), None)
            rules.append(None if hit is None else array.key(hit).decode())
            verdicts.append(None if hit is None else BLOCK if array.blocks[hit] else ALLOW)
        yield pd.DataFrame({"rule": pd.Series(rules, dtype=object), "verdict": pd.Series(verdicts, dtype=object)})


def _share(spark: SparkSession, content: bytes) -> str:
    """Gives the file to every executor, also to later ones, under the name returned."""
    path = shared_file(spark, content, "digests", ".bin")
    spark.sparkContext.addFile(path)
    return path.rpartition("/")[2]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower-case ASCII and path; both empty for null or without ``://``."""
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), *LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def judge_urls(
    pages: DataFrame, rules: list[tuple[str, str, str]], default: str = ALLOW, url: str = "url"
) -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` and ``verdict``.

    A rule fits its host and every subdomain, if the path starts with the rule's path.
    The longest rule that fits wins, of equally long ones that with the longer host.
    ``rule`` is null and ``verdict`` is ``default`` where none fits; so it is for null
    urls and urls without ``://``. Rows are judged alone: repeated rows, null keys and an
    empty table need no rule. Columns of ``pages`` that have the new names are replaced.

    The filter's size is that of the rules, which the caller holds: 24 bytes and the key
    for each. It is written to the shared folder once and fetched once per executor.
    """
    name = _share(pages.sparkSession, digest_file(rules))

    @F.pandas_udf("rule string, verdict string")
    def verdict(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        return _judge(name, batches)

    host, path = host_and_path(F.col(url))
    out = pages.drop("rule", "verdict").withColumns({"host": host, "path": path})
    out = out.withColumn("__judged", verdict("host", "path"))
    return out.withColumns(
        {"rule": F.col("__judged.rule"), "verdict": F.coalesce("__judged.verdict", F.lit(default))}
    ).drop("__judged")
