from collections import Counter
from hashlib import sha256

import numpy as np
import pytest
import sentencepiece
from tokenizers import Tokenizer

from shardleaf.llm import alignment
from shardleaf.llm.alignment import align_tokens, byte_level, piece_level
from shardleaf.llm.queries import QUERIES, TOKENIZERS, table

A, B = f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def plain_tokens():
    """(ids, bytes) of both vocabularies by their own libraries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    letters = {}
    code = 256
    for byte in range(256):
        if 33 <= byte <= 126 or 161 <= byte <= 172 or byte >= 174:
            letters[chr(byte)] = byte
        else:
            letters[chr(code)] = byte
            code += 1
    b = sentencepiece.SentencePieceProcessor(model_file=B)

    def piece(i):
        name = b.id_to_piece(i)
        if len(name) == 6 and name.startswith("<0x") and name.endswith(">"):
            return bytes([int(name[3:5], 16)])
        return name.replace("▁", " ").encode()

    def tokens(text):
        one = a.encode(" " + text, add_special_tokens=False)
        two = b.encode(text)
        return [(i, bytes(letters[c] for c in a.id_to_token(i))) for i in one.ids], [(i, piece(i)) for i in two]

    return tokens


def plain(rows, tokens):
    """The contract by comparing every token with every token of its text."""
    docs, counts = [], Counter()
    for id_, text in rows:
        a, b = tokens(text) if text else ([], [])
        want = b" " + (text or "").encode()
        if not text or any(b"".join(x for _, x in side) != want for side in (a, b)):
            docs.append((id_, [], [], [], []))
            continue
        spans = []
        for side in (a, b):
            at, out = 0, []
            for i, x in side:
                out.append((i, at, at + len(x)))
                at += len(x)
            spans.append(out)
        links = [(i, j) for i, s, e in spans[0] for j, t, f in spans[1] if s < f and t < e]
        shared = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
        groups = [tuple([i for i, s, e in side if lo <= s and e <= hi] for side in spans) for lo, hi in zip([0, *shared], shared)]
        docs.append((id_, spans[0], spans[1], groups, links))
        counts.update(links)
    most = {}
    for (_, j), n in counts.items():
        most[j] = max(n, most.get(j, 0))
    out = []
    for id_, a, b, groups, links in docs:
        text = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        out.append((
            id_, len(a), len(b), len(groups), len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links),
            sha256(text.encode()).hexdigest() if a else "",
        ))
    return sorted(out, key=repr)


def ours(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=repr)


def test_query_equals_brute_force(spark, sf, plain_tokens):
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    short = [(i, t) for i, t in rows if not t or len(t) < 4000]
    docs = spark.createDataFrame(short, "doc_id long, text string")
    assert ours(align_tokens(docs, A, B)) == plain(short, plain_tokens)
    got = ours(QUERIES["op11_alignment"](spark, sf))
    assert len(got) == len(rows) and sum(r[1] > 0 for r in got) > len(rows) * 0.9


CASES = [
    (1, None), (2, ""), (3, " "), (4, "  a  b"), (5, "one two three"), (5, "one two three"), (None, "one two four"), (6, "<|endoftext|> <s> </s> <unk> <0x41>"),
    (7, "▁ a"), (8, "日本語 テキスト 漢字"), (9, "emoji 😀😀 ok ﬁ é é"), (10, "tab\tand\n\nlines \n x"), (11, "trailing   "), (12, "\n"), (13, "a" * 3000),
    (14, "NUL \x00 x"), (15, "ends 's 'll I'M don't"), (16, "١٢٣ 12345 1,000.50"), (17, "supercalifragilistic " * 20), (18, "​　wide space"),
]


def test_cases(spark, plain_tokens):
    docs = spark.createDataFrame([(i, t, 7, "x") for i, t in CASES], "doc_id long, text string, n_a int, block string")
    got = ours(align_tokens(docs, A, B))
    assert got == plain(CASES, plain_tokens)
    assert {r[0]: r[1:] for r in got}[1] == (0, 0, 0, 0, 0, 0, "")


def test_small_parts(monkeypatch):
    """A block is the same row whether its texts are encoded together or one by one, up to the numbers of windows."""
    aligner = alignment.Aligner(byte_level(open(A, "rb").read()), piece_level(open(B, "rb").read()))
    texts = [t.encode() if t is not None else None for _, t in CASES]
    whole = alignment._row(alignment._Block(aligner), texts)
    monkeypatch.setattr(alignment, "PART_BYTES", 1)
    parts = alignment._row(alignment._Block(aligner), texts)
    assert all((whole[c] == parts[c]).all() for c in ("n_a", "n_b", "n_groups", "n_links", "pairs", "totals")) and whole["digests"] == parts["digests"]


@pytest.mark.parametrize("n", [0, 1, 70_000])
def test_packed_numbers(n):
    numbers = np.arange(n) * 61_003 % (1 << 32)
    assert (alignment._unpack(alignment._pack(numbers)) == numbers).all()


def test_over_partitions(spark, plain_tokens):
    """Pairs of several blocks are counted together."""
    docs = spark.createDataFrame(CASES, "doc_id long, text string").repartition(7)
    assert ours(align_tokens(docs, A, B)) == plain(CASES, plain_tokens)


def test_not_utf8_other_ids_and_empty(spark):
    bad = spark.sql("SELECT 'x' AS doc_id, CAST(X'FF41' AS STRING) AS text UNION ALL SELECT NULL, 'fine'")
    got = ours(align_tokens(bad, A, B))
    assert [r for r in got if r[0] == "x"] == [("x", 0, 0, 0, 0, 0, 0, "")]
    assert [r[1] > 0 for r in got if r[0] is None] == [True]
    assert align_tokens(spark.createDataFrame([], "doc_id long, text string"), A, B).count() == 0


def test_long_text(spark, plain_tokens):
    text = " ".join(f"w{i * i % 1009}" for i in range(60_000))
    got = ours(align_tokens(spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string"), A, B))
    a, b = plain_tokens(text)
    assert [r[1:3] for r in got] == [(len(a), len(b))] * 2 and got[0][1:] == got[1][1:]


def test_byte_ranks_equal_merges():
    """Ids found by ranks are those that the library finds by merges, also for unusual words."""
    import random

    draw = random.Random(3)
    lib = Tokenizer.from_file(A)
    lib.encode_special_tokens = True
    ours_ = byte_level(open(A, "rb").read())
    letters = [*"abcdefghijklmnopqrstuvwxyzABCXYZ", " ", " ", "'", "é", "漢", "😀", "\n", "　"]
    texts = ["".join(draw.choice(letters) for _ in range(draw.randint(1, 80))) for _ in range(3000)]
    texts += ["".join(lib.decode([draw.randrange(50_000)]) for _ in range(9)) for _ in range(3000)]
    for text in texts:
        assert lib.encode(" " + text, add_special_tokens=False).ids == ours_.encode(text)


def test_other_vocabulary_is_refused():
    with pytest.raises(ValueError):
        byte_level(open(f"{TOKENIZERS}/word_bpe_49k.json", "rb").read())
