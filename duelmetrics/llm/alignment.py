"""Alignment of two tokenizers' tokens by pointer jumping, and corpus-wide counts of aligned pairs.

The tokens of both sides are intervals over the bytes of a text. Each token points to the
overlapping token that ends farthest right (itself, if none ends later; of two that end together
the first side's). Replacing every pointer by its target's pointer doubles the distance covered,
so after about log2 of the longest chain all tokens of a component point to its terminal token,
which labels the group. All texts of a block are worked on as one run of bytes.

A block is a bounded part of a partition, worked on in slices. It keeps each different pair once,
with the number of its links, and its documents name pairs by their place in that list; so
counting and looking up counts move one row per block and pair instead of one per link.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: The ranks of byte_bpe_50k.json: the same vocabulary for a faster library, with the same ids.
RANKS, PIECES = "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Characters of a slice, and characters and rows of a block, about; they bound what a task holds (or one longer text does).
LIMITS = {"slice_chars": 1 << 19, "block_chars": 1 << 23, "block_rows": 4096}

_loaded: dict = {}
_NONE = np.zeros(0, np.int64)


class Pair:
    """Both tokenizers with the bytes, the byte lengths and the decimal names of their ids."""

    def __init__(self, ranks_path: str, pieces_path: str) -> None:
        import public_tokenizers
        import sentencepiece
        import tiktoken

        with open(ranks_path, "rb") as lines:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
        coder = tiktoken.Encoding(ranks_path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.encode_a = coder.encode_to_numpy
        self.bytes_a = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.bytes_a[rank] = token
        model = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
        self.encode_b = lambda texts: model.encode(texts, num_threads=1)
        self.bytes_b = [bytes([int(model.id_to_piece(i)[3:-1], 16)]) if model.is_byte(i)
                        else model.id_to_piece(i).replace("▁", " ").encode() for i in range(model.get_piece_size())]
        self.objects_b = np.array(self.bytes_b, object)
        self.lengths_a, self.lengths_b = (np.array(list(map(len, side)), np.int64) for side in (self.bytes_a, self.bytes_b))
        # A name ends with the mark that follows it: inside a side, after side a, after side b.
        names = [f"{i}{mark}" for side, last in ((self.bytes_a, "|"), (self.bytes_b, ";")) for mark in (",", last) for i in range(len(side))]
        self.names = np.array(names, object)


def pair(ranks_path: str, pieces_path: str) -> Pair:
    """The tokenizers, loaded once per Python worker."""
    key = ranks_path, pieces_path
    if key not in _loaded:
        _loaded[key] = Pair(*key)
    return _loaded[key]


def default_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(RANKS), public_tokenizers.path(PIECES)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For the tokens of both sides, a's first, the number of their component's terminal token.

    ``ends`` rise strictly; both sides cover the same bytes without gaps.
    """
    n = len(ends_a)
    over_a = np.searchsorted(ends_b, ends_a)  # the token of b that holds the last byte
    over_b = np.searchsorted(ends_a, ends_b)
    to = np.concatenate([np.where(ends_b[over_a] > ends_a, n + over_a, np.arange(n)), over_b]) if n else np.zeros(0, np.int64)
    while True:
        further = to[to]
        if np.array_equal(further, to):
            return to
        to = further


def _slice(tokens: Pair, texts: list[str | None], strings: bool) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """Results per text, and the slice's pairs (a << 32 | b) with their numbers of links."""
    rows = [{"n_a": 0, "n_b": 0, "n_groups": 0, "n_links": 0, "groups": "", "places": _NONE, "times": _NONE} for _ in texts]
    found = [k for k, t in enumerate(texts) if t]
    a_ids, b_ids, kept = [], [], []
    for k, b in zip(found, tokens.encode_b([texts[k] for k in found])):
        body, b = " " + texts[k], np.array(b, np.int64)
        a, body = tokens.encode_a(body).astype(np.int64), body.encode()
        # Side a splits the bytes and loses none; the lengths would show it.
        if tokens.lengths_a[a].sum() == len(body) == tokens.lengths_b[b].sum() and b"".join(tokens.objects_b[b]) == body:
            a_ids.append(a)
            b_ids.append(b)
            kept.append(k)
    if not kept:
        return rows, np.zeros(0, np.int64), np.zeros(0, np.int64)
    before_a, before_b = (np.cumsum([0, *map(len, side)]) for side in (a_ids, b_ids))
    a, b = np.concatenate(a_ids), np.concatenate(b_ids)
    ends_a, ends_b = np.cumsum(tokens.lengths_a[a]), np.cumsum(tokens.lengths_b[b])
    to = terminals(ends_a, ends_b)

    # Terminal tokens are of side a, and the token of b that ends with each is its link.
    last = to[:len(a)] == np.arange(len(a))
    group = (np.cumsum(last) - 1)[to]
    last_b = np.searchsorted(ends_b, ends_a[last])
    codes = a[last] << 32 | b[last_b]
    ends_group = np.searchsorted(np.flatnonzero(last), before_a)  # groups before each text

    # Groups in order, each with its tokens of a, then those of b.
    mark_b = np.zeros(len(b), bool)
    mark_b[last_b] = True
    in_a, in_b = np.bincount(group[:len(a)]), np.bincount(group[len(a):])
    place_a = np.arange(len(a)) + (np.cumsum(in_b) - in_b)[group[:len(a)]]
    place_b = np.arange(len(b)) + np.cumsum(in_a)[group[len(a):]]
    size_a, size_b = len(tokens.bytes_a), len(tokens.bytes_b)
    order = np.empty(len(a) + len(b), np.int64)
    order[place_a] = a + size_a * last
    order[place_b] = 2 * size_a + b + size_b * mark_b
    named = tokens.names[order]

    pairs, place = np.unique(codes, return_inverse=True)
    text = np.repeat(np.arange(len(kept)), np.diff(ends_group))
    own, times = np.unique(text * len(pairs) + place, return_counts=True)
    cuts = np.searchsorted(own, np.arange(len(kept) + 1) * len(pairs))
    own %= len(pairs)
    for n, k in enumerate(kept):
        joined = "".join(named[before_a[n] + before_b[n]:before_a[n + 1] + before_b[n + 1]])[:-1]
        groups = int(ends_group[n + 1] - ends_group[n])
        rows[k] = {"n_a": len(a_ids[n]), "n_b": len(b_ids[n]), "n_groups": groups, "n_links": groups,
                   "groups": joined if strings else hashlib.sha256(joined.encode()).hexdigest(),
                   "places": own[cuts[n]:cuts[n + 1]], "times": times[cuts[n]:cuts[n + 1]]}
    return rows, pairs, np.bincount(place)


def _slices(batches: Iterator[pa.RecordBatch], chars: int, rows: int) -> Iterator[tuple[list, list[str | None], int]]:
    """(ids, texts, characters) of bounded slices."""
    ids, texts, size = [], [], 0
    for batch in batches:
        for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
            text = value.as_py()
            ids.append(doc)
            texts.append(text)
            size += len(text or "")
            if size >= chars or len(ids) >= rows:
                yield ids, texts, size
                ids, texts, size = [], [], 0
    if ids:
        yield ids, texts, size


def _blocks(tokens: Pair, batches: Iterator[pa.RecordBatch], strings: bool, limits: dict) -> Iterator[tuple[list[dict], np.ndarray, np.ndarray]]:
    """Results per row, and the pairs with their numbers of links, of bounded blocks."""
    done: list[tuple] = []
    size = count = 0
    for ids, texts, more in _slices(batches, limits["slice_chars"], limits["block_rows"]):
        rows, pairs, links = _slice(tokens, texts, strings)
        done.append(([{"doc_id": i, **r} for i, r in zip(ids, rows)], pairs, links))
        size, count = size + more, count + len(ids)
        if size >= limits["block_chars"] or count >= limits["block_rows"]:
            yield _merged(done)
            done, size, count = [], 0, 0
    if done:
        yield _merged(done)


def _merged(done: list[tuple]) -> tuple[list[dict], np.ndarray, np.ndarray]:
    """The slices of a block with one list of pairs; places become those of that list."""
    pairs, at = np.unique(np.concatenate([p for _, p, _ in done]), return_inverse=True)
    links = np.bincount(at, np.concatenate([n for *_, n in done]), len(pairs)).astype(np.int64)
    out, first = [], 0
    for rows, own, _ in done:
        here = at[first:first + len(own)]
        first += len(own)
        out += [{**r, "places": here[r["places"]].astype("<i4").tobytes(), "times": r["times"].astype("<i4").tobytes()} for r in rows]
    return out, pairs, links


_DOCS = pa.schema([("is_doc", pa.bool_()), ("block", pa.int64()), ("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()),
                   ("n_groups", pa.int64()), ("n_links", pa.int64()), ("groups", pa.string()), ("places", pa.binary()),
                   ("times", pa.binary()), ("pairs", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int64()))])
_SCHEMA = ("is_doc boolean, block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups string, "
           "places binary, times binary, pairs array<long>, sizes array<long>")


def _aligned(docs: DataFrame, doc_id: str, text: str, paths: tuple[str, str] | None, strings: bool, **limits) -> DataFrame:
    paths, limits = paths or default_paths(), {**LIMITS, **limits}

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, first = pair(*paths), TaskContext.get().partitionId() << 32
        for n, (rows, pairs, sizes) in enumerate(_blocks(tokens, batches, strings, limits)):
            yield pa.RecordBatch.from_pylist([{"is_doc": True, "block": first + n, **r} for r in rows], _DOCS)
            # In parts, as one list per block could grow with a very long text.
            for lo in range(0, len(pairs), 65536):
                yield pa.RecordBatch.from_pylist([{"is_doc": False, "block": first + n, "n_a": lo, "pairs": pairs[lo:lo + 65536],
                                                   "sizes": sizes[lo:lo + 65536]}], _DOCS)

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(align, _SCHEMA)


def token_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, groups) with the groups as ``a1,a2|b1;a3|b2,b3``, ids of both tokenizers.

    ``paths`` are the rank file of a and the model of b. A null or empty text, or one whose tokens
    don't give back its bytes after a space, has no tokens: zeros and an empty string.
    """
    return _aligned(docs, doc_id, text, paths, True).where("is_doc").select("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups")


def _known(staged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The pairs of each block, and those of all with their links and whether b has none with more."""
    listed = staged.where("NOT is_doc").select("block", "n_a", F.posexplode(F.arrays_zip("pairs", "sizes")).alias("nth", "p"))
    listed = listed.select("block", (F.col("n_a") + F.col("nth")).alias("place"), F.col("p.pairs").alias("pair"), F.col("p.sizes").alias("links"))
    totals = stage(listed.groupBy("pair").agg(F.sum("links").alias("total")), "pair-totals").withColumn("b_id", F.col("pair").bitwiseAND(0xFFFFFFFF))
    most = totals.groupBy("b_id").agg(F.max("total").alias("most"))
    known = totals.join(most, "b_id").select("pair", F.shiftright("pair", 32).alias("a_id"), "b_id", "total", (F.col("total") == F.col("most")).alias("best"))
    return listed, known


def pair_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None) -> DataFrame:
    """(a_id, b_id, links, best): how often two ids end together corpus-wide; best if no other a has more with b."""
    known = _known(stage(_aligned(docs, doc_id, text, paths, False), "alignment"))[1]
    return known.select("a_id", "b_id", F.col("total").alias("links"), "best")


def alignment(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", paths: tuple[str, str] | None = None, **limits) -> DataFrame:
    """Per row: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256.

    A link is a pair of tokens that end together; its count is the number of links of its two
    ids corpus-wide. n_best counts the links whose count is the highest of their b id,
    count_sum adds the counts. Rows without tokens (see ``token_groups``) have zeros and an empty
    digest. Repeated rows are counted as often as they come, other columns are ignored, an
    empty table gives an empty result. ``limits`` are those of LIMITS.
    """
    staged = stage(_aligned(docs, doc_id, text, paths, False, **limits), "alignment")
    listed, known = _known(staged)
    counted = listed.join(known.select("pair", "total", "best"), "pair").select(F.col("block").alias("in_block"), "place", "total", "best")
    rows = staged.where("is_doc").select("block", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "places", "times")
    out = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def look_up(rows: pd.DataFrame, counted: pd.DataFrame) -> pd.DataFrame:
        total, best = np.zeros(len(counted), np.int64), np.zeros(len(counted), np.int64)
        total[counted.place], best[counted.place] = counted.total, counted.best
        n_best, count_sum = [], []
        for places, times in zip(rows.places, rows.times):
            at, times = np.frombuffer(places, "<i4"), np.frombuffer(times, "<i4").astype(np.int64)
            n_best.append(int(times @ best[at]))
            count_sum.append(int(times @ total[at]))
        rows = rows.rename(columns={"groups": "groups_sha256"})
        return rows.assign(n_best=np.array(n_best, np.int64), count_sum=np.array(count_sum, np.int64))[out]

    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    return rows.groupBy("block").cogroup(counted.groupBy("in_block")).applyInPandas(look_up, schema)
