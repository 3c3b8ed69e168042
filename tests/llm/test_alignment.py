"""Token alignment against a plain loop over both libraries' own tokens."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from duelmetrics.llm import alignment, queries

SF_DIR = "/root/testdata/sf0.001"


def byte_of():
    """The printable stand-ins of byte-level BPE."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {**{chr(b): b for b in own}, **{chr(256 + n): b for n, b in enumerate(rest)}}


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True  # the contract's plain text
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model")), byte_of()


def tokens(libraries, text):
    a, b, table = libraries
    if not text:
        return [], []
    ids = a.encode(" " + text, add_special_tokens=False).ids
    left = [(i, bytes(table[c] for c in a.id_to_token(i))) for i in ids]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    body = (" " + text).encode()
    if b"".join(t for _, t in left) != body or b"".join(t for _, t in right) != body:
        return [], []
    return left, right


def plain(libraries, rows):
    parsed, count = [], Counter()
    for doc, text in rows:
        left, right = tokens(libraries, text)
        groups, links = [], []
        i = j = at_a = at_b = 0
        own_a, own_b = [], []
        while i < len(left):
            if at_a <= at_b:
                own_a.append(left[i][0])
                at_a += len(left[i][1])
                i += 1
            else:
                own_b.append(right[j][0])
                at_b += len(right[j][1])
                j += 1
            while at_a > at_b:
                own_b.append(right[j][0])
                at_b += len(right[j][1])
                j += 1
            if at_a == at_b:
                links.append((own_a[-1], own_b[-1]))
                groups.append(",".join(map(str, own_a)) + "|" + ",".join(map(str, own_b)))
                own_a, own_b = [], []
        count.update(links)
        parsed.append((doc, len(left), len(right), groups, links))
    high = Counter()
    for (_, b), n in count.items():
        high[b] = max(high[b], n)
    return [(doc, na, nb, len(g), len(ls), sum(count[x] == high[x[1]] for x in ls), sum(count[x] for x in ls),
             hashlib.sha256(";".join(g).encode()).hexdigest() if na else "") for doc, na, nb, g, ls in parsed], count, high, parsed


ODD = [(1, None), (2, ""), (3, " "), (4, "a  b <|endoftext|> </s><unk><0x41> x▁y"), (5, "Straße — naïve 漢字 \U0001f600‍\U0001f525"),
       (6, "\r\n\t \x00\x01"), (None, "the end of the end"), (7, "the end of the end"), (7, "the end of the end"), (8, "long words " * 30_000),
       (9, "a" * 50_000), (10, "<|endoftext|>"), (11, "plain words, and more of the plain words"), (12, "́ 　﻿")]
NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def got(df):
    assert df.columns[:8] == NAMES
    return sorted((tuple(r)[:8] for r in df.collect()), key=repr)


@pytest.mark.parametrize("limits", [{}, {"block_rows": 3}, {"slice_chars": 1}], ids=str)
def test_odd_rows(spark, libraries, limits):
    docs = spark.createDataFrame(ODD, "doc_id long, text string").withColumn("n_a", F.lit("x")).withColumn("block", F.lit(1)).repartition(3)
    want, count, high, parsed = plain(libraries, ODD)
    assert got(alignment.alignment(docs, **limits)) == sorted(want, key=repr)
    assert sum(n for *_, n in [w[:2] for w in want]) > 0 and [w for w in want if w[0] == 4][0][1] == 0
    pairs = {(r.a_id, r.b_id): (r.links, r.best) for r in alignment.pair_counts(docs).collect()}
    assert pairs == {x: (n, n == high[x[1]]) for x, n in count.items()}
    groups = alignment.token_groups(docs).collect()
    assert sorted(((r.doc_id, r.groups) for r in groups), key=repr) == sorted(((d, ";".join(g)) for d, _, _, g, _ in parsed), key=repr)


def test_whole_table(spark, libraries):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    assert got(queries.op13_token_alignment(spark, SF_DIR)) == sorted(plain(libraries, rows)[0], key=repr)


def test_empty_table(spark):
    assert got(alignment.alignment(spark.createDataFrame([], "doc_id long, text string"))) == []


def test_every_character_has_the_same_ids(libraries):
    """The rank file's library splits words at the same characters as the JSON file's."""
    coder = alignment.pair(*alignment.default_paths()).encode_a
    for lo in range(0, 0x110000, 0x400):
        text = "".join(f"a{chr(c)}b {chr(c)}{chr(c)} " for c in range(lo, lo + 0x400) if not 0xD800 <= c < 0xE000)
        if text:
            assert coder(text).tolist() == libraries[0].encode(text, add_special_tokens=False).ids, hex(lo)


def test_pointer_jumping_equals_a_walk():
    rng = np.random.default_rng(5)
    for _ in range(200):
        n = int(rng.integers(1, 60))
        a, b = (np.unique(np.append(rng.integers(1, n + 1, rng.integers(0, n + 1)), n)) for _ in range(2))
        common = sorted(set(a) & set(b))
        label = alignment.terminals(a, b)
        want = [np.searchsorted(a, common[np.searchsorted(common, e)]) for e in [*a, *b]]
        assert label.tolist() == want
    # One chain through all tokens.
    a, b = np.append(np.arange(1, 4001, 2), 4001), np.append(np.arange(2, 4001, 2), 4001)
    assert set(alignment.terminals(a, b)[:1].tolist()) == {0 if 1 in b else len(a) - 1}
