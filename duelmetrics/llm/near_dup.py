"""Near-duplicate documents: an LSH forest of MinHash signatures, links confirmed on whole sets.

1. Each text becomes its set of word shingles, a MinHash signature and a 128-bit digest of the
   set, next to the data. Documents with equal sets form a class; from here on a class is one
   node, so thousands of copies cost as much as one document.
2. The forest: ``trees`` sorted orders of the nodes, each by the signature read from another place
   on. Nodes that share a prefix of ``depth`` values are a region of that order. Where a region
   holds more than ``region_rows`` nodes (or as much text) its prefix gets longer, there only, until it fits.
3. The neighbours of a node in a region's order have the longest common prefix with it. Of its WINDOW
   neighbours before it, those whose signatures agree enough are candidates, the ``nearest`` best at most;
   a pair is confirmed on the two full shingle sets, and the links give components.
4. The second pass sees to what a larger region may have hidden. In each region the nodes that agree
   enough with one of another component meet once more, with their texts, and all their
   intersections are counted exactly, as a product of incidence matrices. Only links that join
   components leave the task, fewer than there are nodes, however many pairs were compared.
5. Cutting a crowded region parts texts that are linked, so its nodes also meet, in that pass, by
   prefix filtering: of two linked sets, in any one order of all shingles, the first few of each
   have one in common. The rare ones come first, so what a crowd shares is hardly ever among them.
   This finds every linked pair of these nodes, whatever the size of the crowd.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import buffers
from .graph import components

HASHES = 96
WORDS = 5
DEPTH = 3
REGION_ROWS = 4096
#: Shingles that count as one more row of a region, so that a region is bounded in text as well.
ROW_SHINGLES = 2000
WINDOW = 8
NEAREST = 3
#: Shingles are counted by so many bits of their hash, to tell rare ones from common ones. Any order is right, a better one is faster.
COUNT_BITS = 20
#: Share of pairs at the very threshold that share no region, and of those whose sketches agree too little.
LOST = 2e-5

_WORD_BYTES = buffers.spaced("words")
_multipliers = buffers.stream(37, HASHES)


def trees_for(percent: int, depth: int = DEPTH) -> int:
    """Trees such that all but LOST of the pairs at ``percent`` share a prefix of ``depth`` values in one."""
    missed = math.log1p(-min(percent / 100, 0.999) ** depth)
    return max(1, min(HASHES, math.ceil(math.log(LOST) / missed)))


def agreement_for(percent: int) -> float:
    """The share of equal places that the sketches of all but LOST of the pairs at ``percent`` reach."""
    s, below = percent / 100, 0.0
    for k in range(HASHES + 1):
        below += math.comb(HASHES, k) * s ** k * (1 - s) ** (HASHES - k)
        if below > LOST:
            return k / HASHES
    return 1.0


def _signatures(sets: list[np.ndarray], hashes: int) -> np.ndarray:
    """The upper 32 bits of the least value of each hash, big-endian; one row per non-empty set."""
    every = np.concatenate(sets)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), hashes), ">u4")
    hashed = np.empty_like(every)
    for k in range(hashes):
        np.multiply(every, _multipliers[k], out=hashed)
        out[:, k] = np.minimum.reduceat(hashed, begins) >> np.uint64(32)
    return out


def _digests(sets: list[np.ndarray]) -> np.ndarray:
    """Two 64-bit sums over each set and its size, as 20 bytes."""
    every = np.concatenate(sets)
    sizes = np.array([*map(len, sets)], np.uint64)
    begins = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), 5), ">u4")
    for k, seed in enumerate((0x2545F4914F6CDD1D, 0x9E3779B97F4A7C15)):
        both = np.add.reduceat(buffers.mix(every + np.uint64(seed)), begins)
        out[:, 2 * k] = both >> np.uint64(32)
        out[:, 2 * k + 1] = both & np.uint64(0xFFFFFFFF)
    out[:, 4] = sizes
    return out


def signatures(docs: DataFrame, doc_id: str, text: str, words: int, hashes: int) -> DataFrame:
    """(doc_id, row_key, n_shingles, node, signature, sketch), the last three null without words.

    A sketch is the lowest byte of each value of the signature.
    """
    schema = "doc_id long, row_key string, n_shingles long, node binary, signature binary, sketch binary"

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, off in buffers.slices(batch.column(2)):
                hashed, _, doc = buffers.word_hashes(data, off, _WORD_BYTES)
                sets = buffers.shingles(hashed, doc, words)
                full = [s for s in sets if len(s)]
                nodes: list = [None] * len(sets)
                signs: list = [None] * len(sets)
                sketches: list = [None] * len(sets)
                if full:
                    rows = iter(zip(_digests(full), _signatures(full, hashes)))
                    for k, s in enumerate(sets):
                        if len(s):
                            node, sign_ = next(rows)
                            nodes[k], signs[k], sketches[k] = node.tobytes(), sign_.tobytes(), sign_.tobytes()[3::4]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array([*map(len, sets)], pa.int64()),
                     *(pa.array(x, pa.binary()) for x in (nodes, signs, sketches))],
                    names=["doc_id", "row_key", "n_shingles", "node", "signature", "sketch"])

    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.md5(body).alias("row_key"), body.alias("text")) \
        .mapInArrow(sign, schema)


def _prefix(values: int, trees: int) -> F.Column:
    """Hash of the first ``values`` values of a tree's order; the order goes round the signature."""
    size = 4 * values
    at = F.col("tree") * F.lit(4 * (HASHES // trees)) + 1
    end = F.length("signature")
    left = F.greatest(F.lit(0), at - 1 + size - end)
    return F.xxhash64("tree", F.expr(f"substring(signature, tree * {4 * (HASHES // trees)} + 1, {size})"),
                      F.substring(F.col("signature"), F.lit(1), left))


def regions(nodes: DataFrame, trees: int, depth: int = DEPTH, region_rows: int = REGION_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """(region, tree, node, rows): nodes that share a region's prefix, two at least in each; and (node) of those in regions that were cut.

    rows is the number of the region's nodes, null where it isn't known. A region of more than two nodes that weighs
    more than ``region_rows`` (a node's weight is 1, and more for a large set) is cut by three more values at a time.
    The smallest nodes of the parts that it falls into meet in a region of their own, so that no
    part loses touch. Nodes whose whole signatures agree can't be told apart by any prefix; such
    a region is dealt into parts by a hash, and every part holds its smallest node too.
    """
    signed = nodes.select("node", "signature", "weight")
    rows = signed.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1)))).withColumn("parent", F.lit(None).cast("long"))
    found, cut = [], None
    while True:
        keyed = rows.select("tree", "parent", "node", "weight", _prefix(depth, trees).alias("region"))
        if found:
            leaders = keyed.groupBy("parent", "region").agg(F.min(F.struct("node", "tree", "weight")).alias("n"))
            found.append(_dealt(leaders.select(F.xxhash64("parent", "parent").alias("region"), "n.*"), region_rows))
        sizes = keyed.groupBy("region").agg(F.count(F.lit(1)).alias("rows"), F.sum("weight").alias("weights")).where("rows > 1")
        keyed = stage(keyed.join(sizes, "region"), "regions")
        crowd = (F.col("weights") > region_rows) & (F.col("rows") > 2)
        found.append(keyed.where(~crowd).select(*_PLACE))
        crowded = keyed.where(crowd)
        if crowded.isEmpty():
            break
        if cut is None:
            cut = crowded.select("node").distinct()
        if depth >= HASHES:
            found.append(_dealt(crowded.select("region", "node", "tree", "weight"), region_rows))
            break
        rows = crowded.select("node", "tree", F.col("region").alias("parent")).join(signed, "node")
        depth = min(depth + 3, HASHES)
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out, cut


_PLACE = ["region", "tree", "node", "rows"]


def _dealt(rows: DataFrame, region_rows: int) -> DataFrame:
    """(region, tree, node, rows) with each region dealt by a hash into parts of about half of ``region_rows``, its smallest node in all."""
    sums = rows.groupBy("region").agg(F.min("node").alias("least"), F.sum("weight").alias("weights"))
    part = F.xxhash64("region", F.pmod(F.xxhash64("node"), F.ceil(2 * F.col("weights") / region_rows)))
    parts = rows.join(sums, "region").where("node <> least").withColumn("region", part)
    every = parts.select("region", "tree", "node").union(parts.select("region", "tree", F.col("least").alias("node")).distinct())
    return every.withColumn("rows", F.lit(None).cast("long"))


def _counts(bodies: DataFrame, words: int) -> np.ndarray:
    """How many of the texts have a shingle, by the last bits of its hash."""
    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << COUNT_BITS, np.int64)
        for batch in batches:
            for s in _sets(batch.column(0).to_pylist(), words):
                np.add.at(table, _slot(s), 1)
        at = np.flatnonzero(table)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(table[at])], names=["slot", "rows"])

    out = np.zeros(1 << COUNT_BITS, np.int64)
    for r in bodies.select("text").mapInArrow(tally, "slot long, rows long").groupBy("slot").agg(F.sum("rows").alias("rows")).toLocalIterator():
        out[r.slot] = r.rows
    return out


def _slot(shingle: np.ndarray) -> np.ndarray:
    return (buffers.mix(shingle) >> np.uint64(64 - COUNT_BITS)).astype(np.int64)


def rare_shingles(bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """(region, node, first): the rarest shingles of each text (node, text), as regions.

    Linked sets have at least ``percent`` of the larger one in common, and 2 * percent / (100 +
    percent) of the smaller one. So, in one order of all shingles, a shingle is among those that
    the larger may spare and one more, and among those that the smaller may and one more; first
    tells the latter.
    """
    shared = bodies.sparkSession.sparkContext.broadcast(_counts(bodies, words))

    def rarest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = _sets(batch.column(1).to_pylist(), words)
            chosen, nth = [], []
            for s in sets:
                spare = len(s) - -(-percent * len(s) // 100) + 1
                chosen.append(s[np.lexsort((s, shared.value[_slot(s)]))[:spare]])
                nth.append(np.arange(spare) < len(s) - -(-2 * percent * len(s) // (100 + percent)) + 1)
            who = pa.array(np.repeat(np.arange(len(sets)), [*map(len, chosen)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(chosen).view(np.int64) if sets else [], pa.int64()), batch.column(0).take(who),
                 pa.array(np.concatenate(nth) if sets else [], pa.bool_())], names=["region", "node", "first"])

    return bodies.select("node", "text").mapInArrow(rarest, "region long, node binary, first boolean")


def open_regions(rows: DataFrame, region_rows: int) -> DataFrame:
    """(region, node): where nodes of different roots meet, of (region, node, first, root, weight), if one of them is a first.

    A region that weighs more than ``region_rows`` is dealt into parts, and any two parts that can
    hold such a pair meet. The parts of the heaviest root don't meet each other.
    """
    by_root = rows.groupBy("region", "root").agg(F.sum("weight").alias("rows"), F.count_if("first").alias("firsts"))
    sums = by_root.groupBy("region").agg(F.sum("rows").alias("rows"), F.sum("firsts").alias("firsts"), F.count(F.lit(1)).alias("roots"),
                                         F.max(F.struct("rows", "root"))["root"].alias("main"))
    held = stage(rows.join(sums.where("roots > 1 AND firsts > 0"), "region"), "rare")
    kind = F.when(F.col("root") == F.col("main"), 2).otherwise(0) + F.when(F.col("first"), 0).otherwise(1)
    large = held.where(F.col("rows") > region_rows).select("region", "node", "weight", kind.alias("kind"))
    sizes = large.groupBy("region", "kind").agg(F.ceil(2 * F.sum("weight") / region_rows).alias("parts"))
    dealt = large.join(sizes, ["region", "kind"]).select("region", "node", "kind", F.pmod(F.xxhash64("node"), "parts").alias("part"))
    sides = sizes.select("region", "kind", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"))
    one = sides.where("kind < 2").select("region", F.col("kind").alias("kind_1"), F.col("part").alias("part_1"))
    two = sides.select("region", F.col("kind").alias("kind_2"), F.col("part").alias("part_2"))
    # Firsts that aren't of the main root meet all others, once; the rest of these roots meet the firsts of the main one.
    meet = one.join(two, "region").where("kind_1 = 0 AND (kind_2 > 0 OR part_1 <= part_2) OR kind_1 = 1 AND kind_2 = 2") \
        .withColumn("both", F.xxhash64("region", "kind_1", "part_1", "kind_2", "part_2"))
    ends = meet.select("region", "both", F.col("kind_1").alias("kind"), F.col("part_1").alias("part")) \
        .union(meet.select("region", "both", "kind_2", "part_2")).distinct()
    parted = dealt.join(ends, ["region", "kind", "part"]).select(F.col("both").alias("region"), "node")
    return held.where(F.col("rows") <= region_rows).select("region", "node").union(parted)


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[list]:
    """Runs of rows with an equal first column, as lists of the other columns."""
    key, held = None, [[] for _ in range(columns)]
    for batch in batches:
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        cols = [batch.column(k).to_pylist() for k in range(1, columns + 1)]
        cuts = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else []
        for lo, hi in zip(cuts, [*cuts[1:], len(keys)]):
            if keys[lo] != key:
                if len(held[0]) > 1:
                    yield held
                key, held = keys[lo], [[] for _ in range(columns)]
            for h, c in zip(held, cols):
                h += c[lo:hi]
    if len(held[0]) > 1:
        yield held


def _order(trees: int) -> F.Column:
    """The sketch as the tree's order reads it."""
    at = F.col("tree") * F.lit(HASHES // trees)
    return F.concat(F.substring(F.col("sketch"), at + 1, F.lit(HASHES)), F.substring(F.col("sketch"), F.lit(1), at))


def nearest_pairs(found: DataFrame, trees: int, agreement: float, nearest: int) -> DataFrame:
    """(a, b), a < b: candidates among the neighbours in each region's order, of (region, tree, node, sketch).

    The rows of a region come sorted as their tree reads the signatures, so those before a node with the longest
    common prefix are next to it. Of WINDOW such neighbours the ``nearest`` that agree most are taken, if they agree
    in a share of ``agreement`` at least. Regions of ``nearest`` + 1 nodes or fewer give all their candidates.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, bytes]] = set()
        for nodes, sketches in _groups(batches, 2):
            low = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
            agree = np.full((len(nodes), WINDOW), -1)
            for back in range(1, min(WINDOW, len(nodes) - 1) + 1):
                agree[back:, back - 1] = (low[back:] == low[:-back]).sum(axis=1)
            best = np.argsort(-agree, axis=1, kind="stable")[:, :nearest]
            rows, nth = np.nonzero(np.take_along_axis(agree, best, axis=1) >= agreement * low.shape[1])
            for k, j in zip(rows.tolist(), (rows - best[rows, nth] - 1).tolist()):
                if nodes[j] != nodes[k]:
                    seen.add((min(nodes[k], nodes[j]), max(nodes[k], nodes[j])))
            if len(seen) >= 50_000:
                yield _rows(seen, ("a", "b"))
        yield _rows(seen, ("a", "b"))

    ordered = found.select("region", "node", "sketch", _order(trees).alias("order"), "tree").repartition("region") \
        .sortWithinPartitions("region", "order", "node")
    return ordered.select("region", "node", "sketch").mapInArrow(scan, "a binary, b binary").distinct()


def unsettled(found: DataFrame, agreement: float) -> DataFrame:
    """(region, node): nodes of (region, node, sketch, root) with a candidate of another root in their region."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, bytes]] = set()
        for nodes, sketches, roots, regions_ in _groups(batches, 4):
            numbers = {r: n for n, r in enumerate(dict.fromkeys(roots))}
            if len(numbers) > 1:
                root = np.array([numbers[r] for r in roots])
                for k, agree in enumerate(_agreements(sketches)):
                    if ((agree >= agreement * len(sketches[0])) & (root != root[k])).any():
                        seen.add((regions_[k], nodes[k]))
            if len(seen) >= 50_000:
                yield _rows(seen, ("region", "node"))
        yield _rows(seen, ("region", "node"))

    return _by_region(found.select("region", "node", "sketch", "root", F.col("region").alias("again"))) \
        .mapInArrow(scan, "region long, node binary")


def _by_region(rows: DataFrame) -> DataFrame:
    return rows.repartition("region").sortWithinPartitions("region", "node")


def _rows(seen: set[tuple], names: tuple[str, str]) -> pa.RecordBatch:
    ends = list(zip(*seen)) or [(), ()]
    seen.clear()
    return pa.RecordBatch.from_arrays([pa.array(e, pa.int64() if n == "region" else pa.binary()) for e, n in zip(ends, names)], names=list(names))


def _agreements(sketches: list[bytes]) -> Iterator[np.ndarray]:
    """For each sketch the number of equal places with every one."""
    low = np.frombuffer(b"".join(sketches), np.uint8).reshape(len(sketches), -1)
    for row in low:
        yield (low == row).sum(axis=1)


def _sets(texts: list[str], words: int) -> list[np.ndarray]:
    sets: list[np.ndarray] = []
    for _, _, data, off in buffers.slices(pa.array(texts, pa.large_string())):
        hashed, _, doc = buffers.word_hashes(data, off, _WORD_BYTES)
        sets += buffers.shingles(hashed, doc, words)
    return sets


def _joining(nodes: list[bytes], roots: list[bytes], sets: list[np.ndarray], percent: int) -> Iterator[tuple[bytes, bytes]]:
    """Links between nodes of different roots, as many as it takes to join all roots that links join."""
    sizes = np.array([len(s) for s in sets])
    doc = np.repeat(np.arange(len(sets)), sizes)
    _, column = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(column, kind="stable")
    column, doc = column[order], doc[order]
    number = {r: n for n, r in enumerate(dict.fromkeys(roots))}
    root = np.array([number[r] for r in roots])
    # Nodes of the most frequent root needn't be compared with each other.
    rows = np.flatnonzero(root != np.bincount(root).argmax())
    both = np.zeros((len(rows), len(sets)), np.float32)
    for first in range(0, int(column[-1]) + 1, 2048):
        lo, hi = np.searchsorted(column, [first, first + 2048])
        part = np.zeros((len(sets), 2048), np.float32)
        part[doc[lo:hi], column[lo:hi] - first] = 1
        both += part[rows] @ part.T
    linked = 100 * both >= percent * (sizes[rows][:, None] + sizes[None, :] - both)
    above = np.arange(len(number))

    def top(n: int) -> int:
        while above[n] != n:
            n = above[n]
        return n

    for k, j in zip(*np.nonzero(linked)):
        x, y = top(root[rows[k]]), top(root[j])
        if x != y:
            above[max(x, y)] = min(x, y)
            yield nodes[rows[k]], nodes[j]


def joining_links(rows: DataFrame, words: int, percent: int) -> DataFrame:
    """(a, b): links between different roots within each region of (region, node, root, text)."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, bytes]] = set()
        for nodes, roots, texts in _groups(batches, 3):
            seen.update((min(p), max(p)) for p in _joining(nodes, roots, _sets(texts, words), percent))
        yield _rows(seen, ("a", "b"))

    return _by_region(rows.select("region", "node", "root", "text")).mapInArrow(scan, "a binary, b binary").distinct()


def confirmed(pairs: DataFrame, bodies: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs with 100 * intersection >= percent * union, on the shingle sets of both texts."""

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = np.zeros(batch.num_rows, bool)
            ends = buffers.texts(batch.column(2))[1] + buffers.texts(batch.column(3))[1]
            lo = 0
            while lo < batch.num_rows:
                hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + buffers.SLICE, side="right")) - 1)
                sides = []
                for column in (batch.column(2), batch.column(3)):
                    raw, off = buffers.texts(column[lo:hi])
                    hashed, _, doc = buffers.word_hashes(raw[off[0]:off[-1]], off - off[0], _WORD_BYTES)
                    sides.append(buffers.shingles(hashed, doc, words))
                for k, (x, y) in enumerate(zip(*sides), lo):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep[k] = 100 * both >= percent * (len(x) + len(y) - both)
                lo = hi
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    first = bodies.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    second = bodies.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    return pairs.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b") \
        .mapInArrow(check, "a binary, b binary")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = 85,
                    trees: int | None = None, depth: int = DEPTH, region_rows: int = REGION_ROWS, nearest: int = NEAREST,
                    agreement: float | None = None) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Texts are lower-cased in A-Z and split at space and \\t to \\r. The set of a text is its
    distinct runs of ``words`` words, or its whole sequence if it has fewer. Texts are linked if
    100 * intersection >= percent * union. component_id is the smallest doc_id that links reach,
    kept tells the row that has it.

    Null, empty and blank texts have n_shingles 0 and are linked with nothing. Repeated rows get
    the same answer. A null doc_id never is the smallest; a component of null ids alone has a
    null component_id and keeps its rows. Other columns are ignored. No rows give no rows.
    ``trees`` and ``agreement`` follow from ``percent`` unless given.
    """
    judged = _judged(docs, doc_id, text, words, percent, trees, depth, region_rows, nearest, agreement)
    return judged.select("doc_id", "n_shingles", "component_id", "kept")


def _places(doc_id: str, text: str) -> list:
    """What names a row: its doc_id, or a hash of its text where that is null; and a digest of its text."""
    key = F.md5(F.coalesce(F.col(text).cast("string"), F.lit("")))
    return [F.coalesce(F.col(doc_id).cast("long"), F.xxhash64(key)).alias("__place"), key.alias("__key")]


def _judged(docs: DataFrame, doc_id: str, text: str, words: int, percent: int, trees: int | None, depth: int,
            region_rows: int, nearest: int, agreement: float | None) -> DataFrame:
    trees = trees_for(percent, depth) if trees is None else trees
    agreement = agreement_for(percent) if agreement is None else agreement
    signed = signatures(docs, doc_id, text, words, HASHES)
    signed = stage(signed.withColumn("place", F.coalesce("doc_id", F.xxhash64("row_key"))), "signatures")
    classes = signed.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least_id"), F.min(F.struct("place", "row_key")).alias("rep"),
        F.max("signature").alias("signature"), F.max("sketch").alias("sketch"),
        (1 + F.floor(F.max("n_shingles") / ROW_SHINGLES)).alias("weight"))
    classes = stage(classes, "classes")
    places, cut = regions(classes, trees, depth, region_rows)
    found = places.join(classes.select("node", "sketch"), "node")
    near = stage(nearest_pairs(found, trees, agreement, nearest), "pairs")
    # The others have given all their candidates. Here whoever has one at all needs its text in the second pass.
    larger = stage(found.where((F.col("rows") > nearest + 1) | F.col("rows").isNull()).select("region", "node", "sketch"), "larger")
    wanted = near.select(F.col("a").alias("node")).union(near.select("b")) \
        .union(unsettled(larger.withColumn("root", F.col("node")), agreement).select("node"))
    wanted = (wanted if cut is None else wanted.union(cut)).distinct()
    wanted = wanted.join(classes.select("node", F.col("rep.place").alias("__place"), F.col("rep.row_key").alias("__key")), "node")
    body = F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")
    bodies = docs.select(*_places(doc_id, text), body).join(wanted, ["__place", "__key"])
    bodies = stage(bodies.dropDuplicates(["node"]).select("node", "text"), "bodies")
    links = stage(confirmed(near, bodies, words, percent), "links")
    root = components(links, "a", "b")

    own = F.coalesce("root", "node").alias("root")
    labelled = larger.join(root, "node", "left").select("region", "node", "sketch", own)
    if cut is not None:
        rare = rare_shingles(bodies.join(cut, "node"), words, percent).join(classes.select("node", "weight"), "node") \
            .join(root, "node", "left").select("region", "node", "first", "weight", own)
        rare = stage(open_regions(rare, region_rows), "open")
        labelled = labelled.union(rare.join(classes.select("node", "sketch"), "node").join(root, "node", "left").select("region", "node", "sketch", own))
    rest = unsettled(labelled, agreement).join(bodies, "node").join(root, "node", "left").select("region", "node", own, "text")
    root = components(links.union(joining_links(rest, words, percent)), "a", "b")

    named = classes.select("node", "least_id").join(root, "node", "left").select("node", "least_id", own)
    least = named.groupBy("root").agg(F.min("least_id").alias("component_id"))
    named = named.join(least, "root").select("node", "component_id")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return signed.select("doc_id", "place", "row_key", "n_shingles", "node").join(named, "node", "left") \
        .withColumn("component_id", component).withColumn("kept", F.col("doc_id").eqNullSafe(component))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS,
                         percent: int = 85, trees: int | None = None, depth: int = DEPTH, region_rows: int = REGION_ROWS,
                         nearest: int = NEAREST, agreement: float | None = None) -> DataFrame:
    """``docs`` with one document of each component: the one whose doc_id names it.

    Documents without words are all kept. Of rows that repeat both doc_id and text one stays.
    Rows with a null doc_id stay only where their component has no other id.
    """
    judged = _judged(docs, doc_id, text, words, percent, trees, depth, region_rows, nearest, agreement)
    kept = judged.where("kept").select(F.col("place").alias("__place"), F.col("row_key").alias("__key")).distinct()
    rows = docs.select("*", *_places(doc_id, text)).join(kept, ["__place", "__key"], "left_semi")
    return rows.dropDuplicates(["__place", "__key"]).select(docs.columns)
