"""Packing of tokenized documents into sequences by bounded-space online best fit.

Two passes. The first runs the tokenizer next to the data and keeps only lengths and checksums.
The second deals the pieces to groups of about ``group_pieces`` and packs each group as they
come: a piece goes to the open sequence that it fills best; if none has room it opens a new
one, and of more than ``open_bins`` open ones the fullest is closed.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage

TOKENIZER = "byte_bpe_50k.json"
_encoders: dict = {}


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def _ranks(model: dict) -> dict[bytes, int] | None:
    """The vocabulary by bytes, if its ids are ranks: single bytes first, then a merge after the other."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte = {chr(b): b for b in own} | {chr(256 + n): b for n, b in enumerate(sorted(set(range(256)) - set(own)))}
    vocab = model["vocab"]
    merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    if any(vocab.get(a + b) != 256 + n for n, (a, b) in enumerate(merges)) or any(vocab.get(c, 256) > 255 for c in byte):
        return None
    return {bytes(byte[c] for c in token): i for token, i in vocab.items() if i < 256 + len(merges)}


def encoder(path: str) -> Callable[[str], np.ndarray]:
    """Text to the ids that ``tokenizers`` gives with the file's own settings and no special tokens added.

    Their strings inside a text are their ids, as by that library's default. A byte-level file whose ids are
    ranks goes through a library that is several times as fast and gives the same ids; any other
    goes through ``tokenizers``. Loaded once per Python worker.
    """
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = not any(t[k] for t in spec["added_tokens"] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        step = spec["pre_tokenizer"] or {}
        level = step.get("type") == "ByteLevel" and step.get("use_regex", True) and not step.get("add_prefix_space")
        ranks = _ranks(spec["model"]) if plain and level and not spec["normalizer"] and spec["model"]["type"] == "BPE" else None
        if ranks:
            import public_tokenizers
            import tiktoken

            fast = tiktoken.Encoding(path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)
            _encoders[path] = lambda text: fast.encode_to_numpy(text, allowed_special="all").astype("<u4")
        else:
            from tokenizers import Tokenizer

            whole = Tokenizer.from_file(path)
            _encoders[path] = lambda text: np.array(whole.encode(text, add_special_tokens=False).ids, "<u4")
    return _encoders[path]


def pieces(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", tokenizer: str | None = None,
           capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) of every document.

    A document is its ids and ``end_id``; a null or empty text is ``end_id`` alone. Only longer
    ones are cut, into pieces of ``capacity`` ids; what is left over makes the first piece. Other
    columns are ignored; repeated rows are packed as often as they come.
    """
    path = tokenizer or default_tokenizer()
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            rows: list[tuple] = []
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = np.append(encode(value.as_py() or ""), np.array([end_id], "<u4"))
                n, ids = len(ids), ids.tobytes()
                begin, k = 0, 0
                stop = n % capacity or capacity
                while begin < n:
                    rows.append((doc, k, begin, stop - begin, zlib.crc32(ids[4 * begin:4 * stop])))
                    begin, stop, k = stop, stop + capacity, k + 1
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                names=["doc_id", "piece", "start", "length", "ids_crc32"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text")).mapInArrow(cut, schema)


class OpenBins:
    """A fixed number of open sequences; a bitset tells which amounts of free space occur."""

    def __init__(self, capacity: int, limit: int) -> None:
        self.capacity, self.limit = capacity, limit
        self.bits = 0
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.open = 0
        self.next_id = 0

    def _take(self, free: int) -> int:
        bins = self.by_free[free]
        out = bins.pop()
        if not bins:
            self.bits &= ~(1 << free)
        return out

    def place(self, length: int) -> tuple[int, int]:
        """(sequence, offset) for a piece: the open sequence with the least space that is enough."""
        fit = self.bits >> length
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            chosen = self._take(free)
        else:
            free, chosen = self.capacity, self.next_id
            self.next_id += 1
            self.open += 1
        left = free - length
        if left:
            self.by_free[left].append(chosen)
            self.bits |= 1 << left
            if self.open > self.limit:
                self._take((self.bits & -self.bits).bit_length() - 1)
                self.open -= 1
        else:
            self.open -= 1
        return chosen, self.capacity - free


def pack(cut: DataFrame, capacity: int = 2048, open_bins: int = 2048, group_pieces: int = 200_000) -> DataFrame:
    """The pieces with sequence_id and offset.

    Pieces meet in groups of about ``group_pieces`` dealt by a hash, so the number of tasks
    follows the input and at most ``open_bins`` sequences a group stay partly filled. Full pieces
    are sequences of their own and aren't kept open. The order inside a group is by a hash too,
    which makes the result the same on every run.
    """
    spark = cut.sparkSession
    cut = stage(cut, "pieces")
    groups = max(1, -(-cut.where(F.col("length") < capacity).count() // group_pieces))
    mixed = F.xxhash64("doc_id", "piece", "ids_crc32")
    dealt = cut.withColumn("__order", mixed).withColumn("__group", F.pmod(F.xxhash64("__order"), F.lit(groups)).cast("int"))
    names = cut.columns

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, bins = None, OpenBins(capacity, open_bins)
        for batch in batches:
            sequences, offsets = [], []
            for g, length in zip(batch.column("__group").to_pylist(), batch.column("length").to_pylist()):
                if g != group:
                    group, bins = g, OpenBins(capacity, open_bins)
                number, offset = bins.place(length)
                sequences.append((g << 36) + number)
                offsets.append(offset)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cut.schema) + ", sequence_id long, offset long"
    spread = max(groups, int(spark.conf.get("spark.sql.shuffle.partitions")))
    return dealt.repartition(spread, "__group").sortWithinPartitions("__group", "__order", *names).mapInArrow(fill, schema)


def pack_documents(docs: DataFrame, **options) -> DataFrame:
    """Pieces of all documents with the sequence and offset that each one gets.

    ``options``: doc_id, text, tokenizer, capacity, end_id, open_bins, group_pieces. An empty
    table gives an empty result with the same columns.
    """
    later = {k: options.pop(k) for k in ("open_bins", "group_pieces") if k in options}
    capacity = options.get("capacity", 2048)
    return pack(pieces(docs, **options), capacity=capacity, **later)
