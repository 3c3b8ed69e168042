"""Benchmark passages in documents, up to edits.

1. The random walk of Chakraborty, Goldenberg and Koucky embeds words so that edits become differences of
   outputs: at step j it gives out its current word and moves on if bit j of that word's hash says
   so. After an edit the walks of two texts soon meet again.
2. An item has windows of about three quarters of its words, begun at each word that leaves room for
   one. A few of the outputs of a window's walk, at sampled steps, make a key; each of several walks has its
   own. How many outputs and walks is computed for the item's length: simulated passages with all
   the edits allowed have to be found with RECALL. Items too short for an edit take the whole walk.
3. The walks are made from every word of every document, next to the data. The first two sampled outputs
   tell nearly all positions that no item can begin at; only the others walk on. Positions with a
   key that an item may have go on, as one row for each run of them with the text around it.
4. Keys of runs and of items meet in an equality join, and pairs of run and item are confirmed by
   the exact edit distance, in words, between the item and the run's closest part.

Both filters of the third step have a bounded size. Nothing that grows with documents or items is
broadcast.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import buffers

#: Share of an item's words that may be edited, and of such passages with all these edits that have to be found.
EDITS = 0.2
RECALL = 0.999
#: Words of a window: one of these between the two shares of the item's words.
WINDOWS = (5, 6, 7, 8, 10, 12, 14, 17, 20, 24)
LEAST_WINDOW, WINDOW = 0.5, 0.75
#: Outputs that make a key, and numbers of walks to choose from; a key of more outputs is taken if FEW walks do.
SAMPLES = (3, 4, 5, 6)
WALKS = (4, 6, 8, 12, 16, 24, 32, 48)
FEW = 12
#: Simulated passages for each way to place the edits.
TRIALS = 700
#: Steps a whole walk has for each word of a short item.
STEPS = 4
#: Bits of a filter for each key, and the most it may have: 32 MB.
KEY_BITS, MOST_BITS = 64, 28
PROBES = 3

#: Longer items have ever more windows, so they are looked for like those of so many words.
LONG = 50

_BYTES = buffers.spaced("letters")
_U = np.uint64


class Shape(NamedTuple):
    """How items of a length are looked for: words of a window, outputs of a key, walks. A short item is its own window."""

    window: int
    samples: int
    walks: int

    @property
    def reach(self) -> int:
        """Words from the first to the last that a key takes, at least: more than four, but for the shortest items."""
        return min(self.window // 2, max(4, self.window // 3))

    @property
    def code(self) -> int:
        return self.window * 16 + self.samples


def whole_key(words: np.ndarray, size: int) -> np.ndarray:
    """The key of the ``size`` words that begin at each word: all that a walk over them gives out."""
    n = len(words)
    padded = np.append(words, np.zeros(size + 1, np.uint64))
    here = np.arange(n)
    factors = buffers.stream(7919 * size, STEPS * size)
    key = np.full(n, buffers.stream(size * 100, 1)[0], np.uint64)
    step = np.zeros(n, np.int64)
    for j in range(STEPS * size):
        out = padded[here + np.minimum(step, size)]
        out[step >= size] = 0
        key += out * factors[j]
        step += (out >> _U(j % 64) & _U(1)).view(np.int64)
    return buffers.mix(key)


@lru_cache(maxsize=None)
def _odds(number: int) -> np.ndarray:
    return buffers.stream(53 + number, 64)


class Walk:
    """One walk from every word of texts that are parted by a 0, which no walk passes.

    At step j it moves on if the highest bit of the word's hash times the j-th factor is set.
    """

    def __init__(self, words: np.ndarray, number: int) -> None:
        self.words, self.number = words, number
        first, self.step = number % 2, 2 + number % 3
        here = np.arange(len(words))
        for j in range(self.step):
            if j == first:
                self.first, begin = here, words if j == 0 else words[here]
            moves = (words * _odds(number)[j]).view(np.int64) < 0
            here = here + (moves if j == 0 else moves[here])
        second = words[here]
        a, b, c = _odds(number)[-3:]
        self.prefix = begin * a + second * b + c
        self.within = second != 0  # as the walk only moves on, so is the first output
        self.here = here

    def keys(self, at: np.ndarray, shapes: list[Shape], apart: bool = False) -> Iterator[tuple[Shape, np.ndarray, np.ndarray]]:
        """(shape, those of ``at`` whose walk stays inside its text, their keys).

        With ``apart`` only keys of different words that reach far enough: items have no others, so that a common turn
        of a few words is nobody's key.
        """
        wanted = {shape: sampled_steps(shape.window, shape.samples, self.number) for shape in shapes}
        needed = sorted({step for steps in wanted.values() for step in steps})
        here, outputs, places, step = self.here[at], {}, {}, self.step
        for until in needed:
            while step < until:
                here = here + ((self.words[here] * _odds(self.number)[step]).view(np.int64) < 0)
                step += 1
            outputs[until], places[until] = self.words[here], here
        for shape, steps in wanted.items():
            key = self.prefix[at] + _U(shape.code)
            for out, factor in zip(steps, buffers.stream(71 + self.number, len(steps))):
                key = key + outputs[out] * factor
            inside = outputs[steps[-1]] != 0
            if apart:
                reached = [self.first[at], self.here[at], *(places[step] for step in steps)]
                inside &= np.all([a < b for a, b in zip(reached, reached[1:])], axis=0) & (reached[-1] - reached[0] >= shape.reach)
            yield shape, at[inside], buffers.mix(key[inside])


@lru_cache(maxsize=None)
def sampled_steps(window: int, samples: int, walk: int) -> tuple[int, ...]:
    """The steps, after the first two, whose outputs a key takes: drawn from those that cover most of the window."""
    steps = np.arange(5, max(5 + samples, 3 * window // 2))
    return tuple(sorted(np.random.default_rng([window, samples, walk]).choice(steps, samples - 2, replace=False).tolist()))


def _edited(rng: np.random.Generator, item: np.ndarray, count: int, placing: str) -> list[int]:
    size = len(item)
    places = {"middle": range(size // 2 - count // 2, size // 2 - count // 2 + count), "spread": [(2 * n + 1) * size // (2 * count) for n in range(count)],
              "random": rng.choice(size, count, replace=False)}[placing]
    out = item.tolist()
    for at in sorted(places, reverse=True):
        new = int(rng.integers(1, 2 ** 62))
        out[at:at + 1] = [[new], [out[at], new], []][rng.integers(3)]
    return out


@lru_cache(maxsize=None)
def _simulated(words: int, edits: float) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """By placing of the edits: items of ``words`` different words, and texts that hold them with all edits allowed."""
    rng, out = np.random.default_rng(words), {}
    for placing in ("middle", "spread", "random"):
        items, texts = [], []
        for _ in range(TRIALS):
            item = rng.integers(1, 2 ** 62, words)
            around = rng.integers(1, 2 ** 62, 16).tolist()
            items += [*item.tolist(), 0]
            texts += [*around[:8], *_edited(rng, item, int(edits * words), placing), *around[8:], 0]
        out[placing] = np.array(items, np.uint64), np.array(texts, np.uint64)
    return out


def _found(shape: Shape, words: int, edits: float) -> list[np.ndarray]:
    """For each placing of the edits the first walk that finds each simulated passage, ``shape.walks`` if none does."""
    out = []
    for items, texts in _simulated(words, edits).values():
        first = np.full(TRIALS, shape.walks)
        text_of = np.cumsum(texts == 0) - (texts == 0)
        starts = np.arange(len(items))[np.arange(len(items)) % (words + 1) <= words - shape.window]
        for number in range(shape.walks):
            (_, own, a), = Walk(items, number).keys(starts, [shape], apart=True)
            (_, at, b), = Walk(texts, number).keys(np.arange(len(texts)), [shape])
            trial = lambda n: n.astype(np.uint64) * _U(0x9E3779B97F4A7C15)
            hit = np.unique(text_of[at][np.isin(b ^ trial(text_of[at]), a ^ trial(own // (words + 1)))])
            first[hit] = np.minimum(first[hit], number)
            if first.max() < shape.walks:
                break
        out.append(first)
    return out


@lru_cache(maxsize=None)
def _planned(words: int, edits: float, recall: float) -> Shape:
    windows = [w for w in reversed(WINDOWS) if LEAST_WINDOW * words <= w <= max(WINDOWS[0], int(WINDOW * words))] or [WINDOWS[-1]]

    def least(samples: int, most: int) -> Shape | None:
        firsts = {w: _found(Shape(w, samples, most), words, edits) for w in windows}
        for walks, window in ((n, w) for n in WALKS if n <= most for w in windows):
            if min((first < walks).mean() for first in firsts[window]) >= recall:
                # The next number up, as so few trials can't tell a recall from a slightly lower one.
                return Shape(window, samples, WALKS[min(WALKS.index(walks) + 1, len(WALKS) - 1)])
        return None

    best = None
    for samples in SAMPLES:
        more = least(samples, FEW)
        if not more:
            break
        best = more
    return best or least(SAMPLES[0], WALKS[-1]) or Shape(windows[-1], SAMPLES[0], WALKS[-1])


def shape_of(words: int, edits: float = EDITS, recall: float = RECALL) -> Shape:
    """How an item of so many words is looked for; all walks there are where no number of them reaches the recall.

    Of the lengths that allow as many edits the shortest is hardest.
    """
    if int(edits * words) == 0 or words < WINDOWS[0]:
        return Shape(words, 0, 1)
    hardest = next(n for n in range(1, words + 1) if int(edits * n) == int(edits * min(words, LONG)) and n >= WINDOWS[0])
    return _planned(hardest, edits, recall)


def _parted(words: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words with a 0 after each text, first place of each text)."""
    places = doc + np.arange(len(doc))
    out = np.zeros(len(words) + len(doc) - 1, np.uint64)
    row = np.repeat(np.arange(len(doc) - 1), np.diff(doc))
    out[np.arange(len(words)) + row] = words
    return out, places


def _batch(words: np.ndarray, doc: np.ndarray, shapes: list[Shape], known=None, begun=None, apart: bool = False):
    """(shape, places among words parted by 0, keys, prefixes) of the windows that ``known`` and ``begun`` let through; ``apart`` as in Walk.keys."""
    parted, _ = _parted(words, doc)
    for shape in [s for s in shapes if not s.samples]:
        key = whole_key(parted, shape.window)
        at = np.arange(len(parted))
        # A window must not reach beyond its text.
        ends = np.cumsum(parted == 0)
        at = at[:max(0, len(at) - shape.window + 1)]
        at = at[(parted[at] != 0) & (ends[at + shape.window - 1] == ends[at])]
        if known is not None:
            at = at[known(key[at])]
        yield shape, at, key[at], key[at]
    walked = [s for s in shapes if s.samples]
    for number in range(max((s.walks for s in walked), default=0)):
        walk = Walk(parted, number)
        at = np.flatnonzero(walk.within) if begun is None else begun(walk.prefix)
        at = at[walk.within[at]]
        if not len(at):
            continue
        for shape, own, key in walk.keys(at, [s for s in walked if s.walks > number], apart):
            if known is not None:
                hit = known(key)
                own, key = own[hit], key[hit]
            yield shape, own, key, walk.prefix[own]


def item_keys(items: DataFrame, edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """(item, words, window, samples, walks, key, prefix) for every window and walk of every item (item, text)."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, off in buffers.slices(batch.column(0)):
                yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.minimum(np.diff(buffers.word_hashes(data, off, _BYTES)[2]), LONG)), pa.int32())], names=["words"])

    # Planned here, once, for the lengths there are: LONG at most.
    lengths = [r.words for r in items.select("text").mapInArrow(count, "words int").distinct().collect()]
    planned = {n: shape_of(n, edits, recall) for n in lengths if n}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in buffers.slices(batch.column(1)):
                words, _, doc = buffers.word_hashes(data, off, _BYTES)
                counts = np.diff(doc)
                shapes = [planned.get(min(c, LONG)) for c in counts.tolist()]
                _, places = _parted(words, doc)
                for shape, at, key, prefix in _batch(words, doc, sorted({s for s in shapes if s}), apart=True):
                    row = np.searchsorted(places, at, side="right") - 1
                    room = at - places[row] <= counts[row] - shape.window
                    own = room & np.array([s == shape for s in shapes])[row]
                    keep = np.unique(np.stack([row[own], key[own].view(np.int64), prefix[own].view(np.int64)]), axis=1)
                    n = keep.shape[1]
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0)[lo:hi].take(pa.array(keep[0])), pa.array(counts[keep[0]], pa.int32()),
                         *(pa.array(np.full(n, x, np.int32)) for x in shape), pa.array(keep[1]), pa.array(keep[2])],
                        names=["item", "words", "window", "samples", "walks", "key", "prefix"])

    return items.select("item", "text").mapInArrow(run, "item string, words int, window int, samples int, walks int, key long, prefix long")


def _filter(keys: DataFrame, column: str) -> np.ndarray:
    """Packed bits that tell of any number whether it may be in ``column``; 32 MB at most, whatever there are."""
    count = max(1, keys.agg(F.approx_count_distinct(column)).first()[0])
    bits = min(MOST_BITS, max(16, (KEY_BITS * count - 1).bit_length()))
    slots = [F.expr(f"shiftrightunsigned({column}, {shift}) & {(1 << bits) - 1}") for shift in _shifts(bits)]
    rows = keys.select(F.explode(F.array(*slots)).alias("slot")).distinct()
    parts = rows.groupBy(F.shiftright("slot", 13).alias("part")).agg(F.collect_set(F.col("slot").bitwiseAND(8191).cast("short")).alias("low"))
    table = np.zeros(1 << (bits - 3), np.uint8)
    for part in parts.toLocalIterator():
        slot = (part.part << 13) + np.array(part.low, np.int64)
        np.bitwise_or.at(table, slot >> 3, np.left_shift(1, slot & 7).astype(np.uint8))
    return table


def _shifts(bits: int) -> list[int]:
    """Where a number's slots begin: at its highest bits, the best of a sum of products."""
    return [max(0, 64 - bits * (n + 1)) for n in range(PROBES)]


def _may_hold(table: np.ndarray):
    """Numbers to the places of those that may be in the filter's column."""
    bits = (len(table) * 8 - 1).bit_length()
    mask = _U((1 << bits) - 1)
    # A small filter is looked up by bytes, which is faster.
    flags = np.unpackbits(table, bitorder="little").view(bool) if bits <= 24 else None

    def places(keys: np.ndarray) -> np.ndarray:
        at = None
        for shift in _shifts(bits):
            own = keys if at is None else keys[at]
            slot = own >> _U(shift)
            if shift + bits < 64:
                slot &= mask
            hit = flags[slot] if flags is not None else (table[slot >> _U(3)] >> (slot & _U(7)).astype(np.uint8) & 1).view(bool)
            at = np.flatnonzero(hit) if at is None else at[hit]
        return at

    return places


def runs(docs: DataFrame, longest: dict[Shape, int], known: np.ndarray, begun: np.ndarray) -> DataFrame:
    """(place, row_key, run, first, snippet, shape, keys): runs of positions that may begin a window of an item.

    ``longest`` gives the words of the longest item of each shape. A snippet reaches that many
    words beyond the run on both sides, twice, and no passage is in two runs; first is the number of its first word in the document.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((known, begun))
    schema = "place long, row_key string, run int, first int, shape int, snippet string, keys array<long>"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = [_may_hold(table) for table in shared.value]
        for batch in batches:
            rows: list[tuple] = []
            for lo, hi, data, off in buffers.slices(batch.column(2)):
                words, at, doc = buffers.word_hashes(data, off, _BYTES)
                places = doc + np.arange(len(doc))
                hits: dict[int, list] = {}
                for shape, pos, key, _ in _batch(words, doc, list(longest), *tests):
                    hits.setdefault(shape.code, []).append((pos, key))
                for shape, most in {s.code: max(n for t, n in longest.items() if t.code == s.code) for s in longest}.items():
                    pos, key = (np.concatenate(x) for x in zip(*hits.get(shape, [(np.zeros(0, np.int64), np.zeros(0, np.uint64))])))
                    if not len(pos):
                        continue
                    order = np.argsort(pos, kind="stable")
                    pos, key = pos[order], key[order]
                    row = np.searchsorted(places, pos, side="right") - 1
                    pos = pos - row
                    cuts = np.flatnonzero((np.diff(pos) > 2 * most) | (np.diff(row) > 0)) + 1
                    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(pos)]):
                        k = int(row[a])
                        w0 = max(int(doc[k]), int(pos[a]) - 2 * most)
                        w1 = min(int(doc[k + 1]), int(pos[b - 1]) + 2 * most)
                        begin, end = int(at[w0]), int(at[w1]) if w1 < doc[k + 1] else int(off[k + 1])
                        rows.append((lo + k, a, w0 - int(doc[k]), shape, data[begin:end].tobytes().decode("utf-8", "replace"),
                                     np.unique(key[a:b].view(np.int64)).tolist()))
            cols = list(zip(*rows)) or [()] * 6
            take = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take),
                 *(pa.array(c, t) for c, t in zip(cols[1:], (pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.list_(pa.int64()))))],
                names=["place", "row_key", "run", "first", "shape", "snippet", "keys"])

    return docs.mapInArrow(scan, schema)


def closest_part(item: list, text: list) -> tuple[int, int]:
    """(edits, end) of the part of ``text`` that is closest to ``item``; of equally close ones the first to end.

    One column of the edit distance table is held in two numbers of as many bits as the item has words.
    """
    size = len(item)
    masks: dict = {}
    for k, w in enumerate(item):
        masks[w] = masks.get(w, 0) | 1 << k
    full, top = (1 << size) - 1, 1 << (size - 1)
    up, down, edits = full, 0, size
    best, end = size, 0
    for j, w in enumerate(text):
        match = masks.get(w, 0)
        same = (((match & up) + up) ^ up) | match | down
        more, less = down | ~(same | up) & full, up & same
        if more & top:
            edits += 1
        elif less & top:
            edits -= 1
        # The first row stays 0: a part may begin anywhere.
        more, less = more << 1 & full, less << 1 & full
        vertical = match | down
        up, down = (less | ~(vertical | more) & full) & full, more & vertical
        if edits < best:
            best, end = edits, j + 1
    return best, end


def _item(item_id: str, text: Column) -> Column:
    """What an item is told apart by: its id, or its text if that is null."""
    number = F.col(item_id).cast("long").cast("string")
    return F.coalesce(number, F.concat(F.lit("text "), F.md5(text)))


def matches(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
            item_text: str = "text", edits: float = EDITS, recall: float = RECALL) -> DataFrame:
    """(place, row_key, doc_id, item_id, distance, item_words, first, last): confirmed passages, one for each document and item.

    Texts are lower-cased in A-Z and split at everything that is no letter, digit or other
    character beyond ASCII. A document holds an item if a part of it is at most
    ``edits * item words`` word edits away; distance is the least, first and last number the
    words of that part. Items without words are in no document; null and empty texts hold
    nothing. An item without an id counts by its text, and its rows have a null item_id. Rows that repeat an
    id and a text give one row. No documents or items give no rows.
    """
    spark = docs.sparkSession
    words_of = F.coalesce(F.col(item_text).cast("string"), F.lit(""))
    items = benchmark.select(_item(item_id, words_of).alias("item"), words_of.alias("text"))
    keys = stage(item_keys(items, edits, recall), "item-keys")
    shapes = keys.groupBy("window", "samples", "walks").agg(F.max("words").alias("longest")).collect()  # a row per shape
    longest = {Shape(r.window, r.samples, r.walks): r.longest for r in shapes}
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = docs.select(F.col(doc_id).cast("long").alias("__id"), body.alias("body")) \
        .select(F.coalesce("__id", F.xxhash64(F.md5("body"))).alias("place"), F.concat(F.md5("body"), F.when(F.col("__id").isNull(), "-").otherwise("")).alias("row_key"), "body")
    schema = "place long, row_key string, doc_id long, item_id long, distance int, item_words int, first int, last int"
    if not longest:
        return spark.createDataFrame([], schema)
    hits = stage(runs(rows, dict(sorted(longest.items())), _filter(keys, "key"), _filter(keys, "prefix")), "runs")
    named = ["place", "row_key", "shape", "run", "first"]
    pairs = hits.select(*named, F.explode("keys").alias("key")).join(keys.select("key", "item").distinct(), "key").select(*named, "item").distinct()
    texts = items.groupBy("item").agg(F.collect_set("text").alias("texts"))
    both = pairs.join(hits.select(*named, "snippet").dropDuplicates(named), named).join(texts, "item")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = lambda t: bytes(_BYTES[np.frombuffer(t.encode(), np.uint8)]).split(b"\0")
        for batch in batches:
            found: list[tuple] = []
            for n, (first, snippet, texts) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("first", "snippet", "texts")))):
                words = [w for w in split(snippet) if w]
                there = Counter(words)
                for t in texts:
                    item = [w for w in split(t) if w]
                    # An edit takes away one word of the item at most.
                    if not item or sum(min(c, there[w]) for w, c in Counter(item).items()) < len(item) - int(edits * len(item)):
                        continue
                    distance, end = closest_part(item, words)
                    if distance <= edits * len(item):
                        _, size = closest_part(item[::-1], words[:end][::-1])
                        found.append((n, distance, len(item), first + end - size, first + end))
            cols = list(zip(*found)) or [()] * 5
            take = pa.array(cols[0], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(take) for c in ("place", "row_key", "item")), *(pa.array(c, pa.int32()) for c in cols[1:])],
                                             names=["place", "row_key", "item", "distance", "item_words", "first", "last"])

    sure = both.select("place", "row_key", "item", "first", "snippet", "texts") \
        .mapInArrow(confirm, "place long, row_key string, item string, distance int, item_words int, first int, last int")
    best = F.min(F.struct("distance", "first", "last", "item_words")).alias("best")
    return sure.groupBy("place", "row_key", "item").agg(best).select(
        "place", "row_key", F.when(~F.col("row_key").endswith("-"), F.col("place")).alias("doc_id"),
        F.when(~F.col("item").startswith("text "), F.col("item").cast("long")).alias("item_id"), "best.distance", "best.item_words", "best.first", "best.last")


def _place(doc_id: str, text: str) -> list[Column]:
    key = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    number = F.col(doc_id).cast("long")
    return [F.coalesce(number, F.xxhash64(key)).alias("__place"), F.concat(key, F.when(number.isNull(), "-").otherwise("")).alias("__key")]


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``docs`` without the documents that hold an item of ``benchmark``; columns and all other rows stay."""
    held = matches(docs, benchmark, doc_id, text, **options).select(F.col("place").alias("__place"), F.col("row_key").alias("__key")).distinct()
    return docs.select("*", *_place(doc_id, text)).join(held, ["__place", "__key"], "left_anti").select(docs.columns)
