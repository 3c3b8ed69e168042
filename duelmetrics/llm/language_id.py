"""Language identification by cross-parsing entropy.

Per language, a suffix automaton accepts every string that occurs in a bounded sample of its
labelled text. A new text is parsed greedily into the longest phrases that the automaton knows;
the number of phrases, times the bits that name a place in the sample, over the length of the
text estimates the cross entropy. The language that needs fewest wins. The sample travels to the
tasks as a string; each Python worker builds the automata once.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window
from pyspark.sql import functions as F

UNKNOWN = "und"
#: Bounds of the sample: documents of a language, characters of one (a span of a longer one), and characters in all.
SAMPLE_DOCS = 64
SAMPLE_DOC_CHARS = 20_000
SAMPLE_CHARS = 40_000
#: Phrases end at multiples of so many characters, so that long texts are parsed in parallel.
BLOCK = 2048
#: Columns of the table of moves: the gap, unknown letters and the most frequent letters. Moves by other letters are looked up.
DENSE = 64
_SLICE_CHARS = 3_000_000
#: A letter, or a character that Java's tables may not have yet.
_LETTER = r"[\p{L}\p{Cn}]"

_parsers: dict[tuple, "Parser"] = {}
_letters: np.ndarray | None = None


def _letter_table() -> np.ndarray:
    """For each code point its lower-case letter, or 0 if it is none."""
    global _letters
    if _letters is None:
        _letters = np.zeros(0x110000, np.uint32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                _letters[c] = ord(low) if len(low) == 1 else c
    return _letters


def _folded(text: str) -> np.ndarray:
    """Lower-case letters as code points; each run of other characters is one 0, none leads."""
    code = _letter_table()[np.frombuffer(text.encode("utf-32-le", "replace"), "<u4")]
    keep = code != 0
    keep[1:] |= code[:-1] != 0
    return code[keep]


def sample_texts(labelled: DataFrame, text: str, label: str) -> list[tuple[str, str]]:
    """At most SAMPLE_DOCS texts per label, chosen by a hash of the text, as (label, text).

    Texts without a letter aren't chosen. Of a text of more than SAMPLE_DOC_CHARS characters the
    sample has a span that begins at a place given by the hash, or at the first letter if that
    span has none. So each label with any letter has a sample.
    """
    body = F.col(text).cast("string")
    rows = labelled.select(F.col(label).cast("string").alias("label"), F.xxhash64(body).alias("h"), body.alias("text")) \
        .where(F.col("label").isNotNull() & F.col("text").rlike(_LETTER))
    order = Window.partitionBy("label").orderBy("h")
    # Copies of a text would fill the sample, so equal hashes count once.
    chosen = rows.groupBy("label", "h").count().withColumn("k", F.row_number().over(order)).where(F.col("k") <= SAMPLE_DOCS)
    # Bounded: SAMPLE_DOCS rows a label.
    held = rows.join(F.broadcast(chosen.select("label", "h")), ["label", "h"])
    span = F.substring("text", F.pmod("h", F.length("text") - SAMPLE_DOC_CHARS + 1).cast("int") + 1, F.lit(SAMPLE_DOC_CHARS))
    first = F.substring(F.regexp_replace("text", rf"^(?s:.*?)(?={_LETTER})", ""), 1, SAMPLE_DOC_CHARS)
    held = held.withColumn("text", F.when(F.length("text") <= SAMPLE_DOC_CHARS, F.col("text")).when(span.rlike(_LETTER), span).otherwise(first))
    got = held.groupBy("label", "h").agg(F.min("text").alias("text"))
    return [(r.label, r.text) for r in sorted(got.collect(), key=lambda r: (r.label, r.h))]


class Parser:
    """Automata of all languages as one transition table."""

    def __init__(self, samples: tuple[tuple[str, str], ...]) -> None:
        by_label: dict[str, list[np.ndarray]] = {}
        for label, text in samples:
            by_label.setdefault(label, []).append(np.append(_folded(text), np.uint32(0)))
        strings = {k: np.concatenate(v)[:SAMPLE_CHARS] for k, v in sorted(by_label.items())}
        strings = {k: s for k, s in strings.items() if s.any()}
        self.labels = list(strings)
        seen = Counter()
        for s in strings.values():
            seen.update(s.tolist())
        alphabet = sorted((c for c in seen if c), key=lambda c: (-seen[c], c))
        self.width = len(alphabet) + 2
        self.dense = min(DENSE, self.width)
        self.classes = np.ones(0x110000, np.int32)  # 1: a letter that no sample has
        self.classes[0] = 0
        self.classes[alphabet] = np.arange(2, self.width)
        self.starts, self.bits, tables, far, restarts, base = [], [], [], [], [], 0
        for s in strings.values():
            table, *rest = self._table(self.classes[s].tolist(), base)
            far.append(rest[:2])
            restarts.append(rest[2])
            self.starts.append(base + len(table) - 1)
            self.bits.append(math.log2(max(2, len(s))))
            tables.append(table)
            base += len(table)
        self.table = np.concatenate(tables).ravel() if tables else np.zeros(0, np.int32)
        # Moves by letters beyond the table, by state * width + letter; languages have ascending states.
        self.far_keys, self.far_moves = (np.concatenate(x) for x in zip(*far)) if far else (np.zeros(0, np.int64),) * 2
        self.far_restarts = np.array(restarts).T if restarts else np.zeros((0, 0), np.int32)

    def _table(self, string: list[int], base: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """next state * 2 + 1 if a new phrase begins, for each state and character.

        Of the characters from ``dense`` on: keys and values of the moves within a phrase, and the value that begins one.

        The last state is that before a text and after a letter that the sample lacks, which is a phrase of its own.
        """
        moves: list[dict[int, int]] = [{}]
        link, size, last = [-1], [0], 0
        for c in string:
            new, p = len(moves), last
            moves.append({})
            link.append(0)
            size.append(size[last] + 1)
            while p >= 0 and c not in moves[p]:
                moves[p][c] = new
                p = link[p]
            if p >= 0:
                q = moves[p][c]
                if size[p] + 1 == size[q]:
                    link[new] = q
                else:
                    twin = len(moves)
                    moves.append(dict(moves[q]))
                    link.append(link[q])
                    size.append(size[p] + 1)
                    while p >= 0 and moves[p].get(c) == q:
                        moves[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new
        restart = np.full(self.width, base + len(moves), np.int32)
        for c, q in moves[0].items():
            restart[c] = base + q
        restart = restart * 2 + 1
        table = np.tile(restart[:self.dense], (len(moves) + 1, 1))
        states = np.repeat(np.arange(len(moves)), [len(m) for m in moves])
        chars = np.fromiter((c for m in moves for c in m), np.int64, len(states))
        values = 2 * (base + np.fromiter((q for m in moves for q in m.values()), np.int64, len(states)))
        near = chars < self.dense
        table[states[near], chars[near]] = values[near]
        keys = ((base + states) * self.width + chars)[~near]
        order = np.argsort(keys)
        return table, keys[order], values[~near][order], restart[self.dense:]

    def _far(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        """The moves of rows of states, one per language, by a letter each that the table lacks."""
        keys = state * self.width + letter[:, None]
        at = np.minimum(np.searchsorted(self.far_keys, keys), len(self.far_keys) - 1)
        return np.where(self.far_keys[at] == keys, self.far_moves[at], self.far_restarts[letter - self.dense])

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bits a character per text and language, letters and gaps of each text)."""
        sizes = np.array([len(t) for t in texts])
        code = _letter_table()[np.frombuffer("".join(texts).encode("utf-32-le", "replace"), "<u4")]
        doc = np.repeat(np.arange(len(texts)), sizes)
        keep = code != 0
        keep[1:] |= (code[:-1] != 0) & (doc[1:] == doc[:-1])
        code, doc = self.classes[code[keep]], doc[keep]
        length = np.bincount(doc, minlength=len(texts))
        starts = np.cumsum(length) - length
        blocks = -(-length // BLOCK)
        lane_doc = np.repeat(np.arange(len(texts)), blocks)
        nth = np.arange(len(lane_doc)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        lane_start = starts[lane_doc] + nth * BLOCK
        lane_size = np.minimum(BLOCK, length[lane_doc] - nth * BLOCK)
        order = np.argsort(-lane_size, kind="stable")
        lane_doc, lane_start, lane_size = lane_doc[order], lane_start[order], lane_size[order]
        langs, lanes = len(self.labels), len(lane_doc)
        phrases = np.zeros((lanes, langs), np.int32)
        state = np.tile(np.array(self.starts, np.int64), (lanes, 1))
        active = np.searchsorted(-lane_size, -np.arange(1, (lane_size[0] if lanes else 0) + 1), side="right")
        any_far = bool((code >= self.dense).any())
        for j, n in enumerate(active.tolist()):
            letter = code[lane_start[:n] + j]
            at = state[:n] * self.dense + np.minimum(letter, self.dense - 1)[:, None]
            move = self.table[at]
            if any_far:
                far = np.flatnonzero(letter >= self.dense)
                if len(far):
                    move[far] = self._far(state[far], letter[far])
            phrases[:n] += move & 1
            state[:n] = move >> 1
        total = np.zeros((len(texts), langs))
        np.add.at(total, lane_doc, phrases)
        return total * np.array(self.bits) / np.maximum(length, 1)[:, None], length


def _parser(samples: tuple[tuple[str, str], ...]) -> Parser:
    if samples not in _parsers:
        _parsers.clear()
        _parsers[samples] = Parser(samples)
    return _parsers[samples]


def identify(docs: DataFrame, samples: list[tuple[str, str]], text: str = "text") -> DataFrame:
    """``docs`` without ``text``, with lang_pred and score; rows and other columns stay as they are.

    A text that is null or has no letter gets ``und`` with score 0, as does every text if there
    is no sample. Otherwise the score is the winner's share of 2 ** -(bits of the first 64
    characters' worth), between 0 and 1; of languages with equal entropy the first by name wins.
    Columns named lang_pred or score are replaced.
    """
    samples = tuple(samples)
    others = [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    schema = docs.select(others).schema.add("lang_pred", "string").add("score", "double")

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parser = _parser(samples)
        for batch in batches:
            rows = [t or "" for t in batch.column(0).to_pylist()]
            labels: list[str] = []
            scores: list[float] = []
            lo = 0
            while lo < len(rows):
                hi, held = lo + 1, len(rows[lo])
                while hi < len(rows) and held + len(rows[hi]) <= _SLICE_CHARS:
                    held += len(rows[hi])
                    hi += 1
                if parser.labels:
                    bits, length = parser.entropies(rows[lo:hi])
                    best = bits.argmin(axis=1)
                    gap = (bits - bits.min(axis=1, keepdims=True)) * np.minimum(length, 64)[:, None]
                    share = 1 / np.exp2(-gap).sum(axis=1)
                    has = length > 0
                    labels += [parser.labels[b] if h else UNKNOWN for b, h in zip(best, has)]
                    scores += np.where(has, share, 0.0).tolist()
                else:
                    labels += [UNKNOWN] * (hi - lo)
                    scores += [0.0] * (hi - lo)
                lo = hi
            yield pa.RecordBatch.from_arrays([*batch.columns[1:], pa.array(labels, pa.string()), pa.array(scores, pa.float64())],
                                             names=[*others, "lang_pred", "score"])

    return docs.select(F.col(text).cast("string").alias("__text"), *others).mapInArrow(judge, schema)
