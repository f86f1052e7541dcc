import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from repopulse.llm import alignment
from repopulse.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"
BYTES = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def plain_tokens():
    """A function from a text to the (id, bytes) of both tokenizers, whole texts at a time."""
    a, b = Tokenizer.from_file(BYTES), sentencepiece.SentencePieceProcessor(model_file=PIECES)
    a.encode_special_tokens = True
    letters = {}
    plain = [n for n in range(256) if 33 <= n <= 126 or 161 <= n <= 172 or n >= 174]
    for n in plain:
        letters[chr(n)] = n
    for k, n in enumerate(n for n in range(256) if n not in plain):
        letters[chr(256 + k)] = n

    def tokens(text):
        of_a = [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = []
        for i in b.encode(text):
            piece = b.id_to_piece(i)
            of_b.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
        whole = (" " + text).encode()
        return (of_a, of_b) if all(b"".join(x for _, x in own) == whole for own in (of_a, of_b)) else ([], [])

    return tokens


def spans(tokens):
    out, at = [], 0
    for number, raw in tokens:
        out.append((at, at + len(raw), number))
        at += len(raw)
    return out


def plain(docs):
    """Rows of the query, each byte of each text looked at."""
    tokens, rows, counts = plain_tokens(), [], Counter()
    for doc_id, text in docs:
        of_a, of_b = (spans(own) for own in (tokens(text) if text else ([], [])))
        at_a, at_b = ([n for n, (start, stop, _) in enumerate(own) for _ in range(start, stop)] for own in (of_a, of_b))
        links = [(of_a[i][2], of_b[j][2]) for i, j in sorted(set(zip(at_a, at_b)))]
        common = sorted({stop for _, stop, _ in of_a} & {stop for _, stop, _ in of_b})
        groups = defaultdict(lambda: ([], []))
        for side, own in enumerate((of_a, of_b)):
            for _, stop, number in own:
                groups[common[bisect_left(common, stop)]][side].append(str(number))
        shown = ["|".join(",".join(side) for side in groups[stop]) for stop in common]
        sha = hashlib.sha256(";".join(shown).encode()).hexdigest() if of_a else ""
        counts.update(set(links))
        rows.append((doc_id, len(of_a), len(of_b), len(common), links, sha))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return sorted(
        (
            (doc_id, n_a, n_b, groups, len(links), sum(counts[x] == most[x[0]] for x in links), sum(counts[x] for x in links), sha)
            for doc_id, n_a, n_b, groups, links, sha in rows
        ),
        key=str,
    )


ODD = [
    None, "", " ", "  ", "\n", "a", " a", "a ", "a  b", "a   b c", "tab\there", "new\n\nline \n x", "don't we'll I'm",
    "<|endoftext|> and <s> </s> <unk> <0x41>", "mark ▁ here", "▁", "ünïcödé naïve", "日本語のテキスト です", "👩‍👩‍👧 family 🎉🎉",
    "a b   c", "x \x1c y", "a\x85 b", "1234567 89 0.5", "!!! ... ??", "é combining", "​zero width", "A" * 300,
    "word " * 40, "\x00 null", "٣٤ عربى", " leading and trailing  ", "a 　b", "ﬁ ligature ½",
]


def test_the_query_against_a_plain_version(spark):
    docs = [tuple(d) for d in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op11_cross_tokenizer_alignment"](spark, FOLDER)
    assert found.columns == alignment.NAMES
    assert {kind for name, kind in found.dtypes if name != "groups_sha256"} == {"bigint"}
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs)


def test_odd_texts(spark):
    rng = random.Random(3)
    letters = "ab \n\t,.'é日▁ 1  \x1c"
    texts = ODD + ["".join(rng.choices(letters, k=rng.randrange(1, 40))) for _ in range(400)]
    docs = [(None if n % 50 == 7 else n // 2, text) for n, text in enumerate(texts)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, chunk int").repartition(3)
    # Chunks of a few texts, so that pairs come together from many.
    found = alignment.align_documents(df, BYTES, PIECES, chunk_bytes=60)
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs)
    assert alignment.align_documents(df.where("false"), BYTES, PIECES).count() == 0


def test_very_long_text(spark):
    docs = [(1, "long words of many kinds, " * 10_000), (2, "x" * 20_000)]
    found = alignment.align_documents(spark.createDataFrame(docs, "doc_id long, text string"), BYTES, PIECES)
    assert sorted(map(tuple, found.collect()), key=str) == plain(docs)


def test_groups(spark):
    docs = spark.createDataFrame([(1, "unbelievable things"), (2, None)], "doc_id long, text string")
    rows = {row.doc_id: row.groups for row in alignment.token_groups(docs, BYTES, PIECES).collect()}
    of_a, of_b = plain_tokens()("unbelievable things")
    assert [i for group in rows[1] for i in group.a] == [i for i, _ in of_a]
    assert [i for group in rows[1] for i in group.b] == [i for i, _ in of_b]
    assert rows[2] == []


def test_gallop():
    rng = random.Random(5)
    for _ in range(300):
        long = sorted(rng.sample(range(400), rng.randrange(1, 200)))
        short = sorted(rng.sample(range(400), rng.randrange(1, 60)))
        assert alignment.gallop(short, long) == [sum(x < value for x in long) for value in short]


@pytest.mark.parametrize("sizes", [(1, 1), (1, 9), (9, 1), (5, 5), (12, 4)])
def test_align(sizes):
    """Links are the overlaps and groups the common ends, whichever list is shorter."""
    rng = random.Random(6)
    for _ in range(50):
        a, b = ([*sorted(rng.sample(range(1, 30), n - 1)), 30] for n in sizes)
        groups, links = alignment.align(a, b)
        ranges = [list(zip([0, *own], own)) for own in (a, b)]
        overlap = [(i, j) for i, (s, e) in enumerate(ranges[0]) for j, (t, f) in enumerate(ranges[1]) if s < f and t < e]
        assert sorted(links) == overlap
        assert groups == [(a.index(end) + 1, b.index(end) + 1) for end in a if end in b]


def test_a_block_of_units_needs_no_step_for_each_group(monkeypatch):
    """Groups are found and written in arrays: a block of units calls ``overlaps`` once."""
    calls = []
    whole = alignment.overlaps
    monkeypatch.setattr(alignment, "overlaps", lambda *ends: calls.append(1) or whole(*ends))
    aligner = alignment.Aligner(BYTES, PIECES)
    texts = [" ".join(f"word{n} x{n * m}y" for n in range(100)) for m in (1, 2)]
    together = list(aligner.align_all(texts))
    assert len(calls) == 1
    alone = [next(alignment.Aligner(BYTES, PIECES).align_all([text])) for text in texts]
    for one, other in zip(together, alone):
        n_a, n_b, n_groups, codes, shown = one
        groups = [[side.split(",") for side in group.split("|")] for group in shown.split(";")]
        assert n_a == sum(len(a) for a, _ in groups) and n_b == sum(len(b) for _, b in groups) and n_groups == len(groups)
        assert one[:3] == other[:3] and shown == other[4] and codes.tolist() == other[3].tolist()
