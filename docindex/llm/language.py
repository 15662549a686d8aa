"""Language identification by cross-parsing.

For each language a suffix automaton holds all substrings of a sample of its labelled
text. A text is cut, from left to right, into the longest phrases that the automaton
knows; a language's entropy is its number of phrases times the bits that name a place
in its sample, per character. The language with the least entropy wins.

Texts are lower-cased; everything that is no ASCII letter and no byte of a longer
character is one blank. Whole texts are parsed, in blocks of ``BLOCK`` bytes side by side; a
phrase ends with its block. The sample is bounded by ``SAMPLE_ROWS`` rows per language
and ``SAMPLE_BYTES`` in all.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; so is every
text when nothing was learned. Equal entropies go to the first language by name. Null
languages teach nothing; a null id neither teaches nor is held out. Repeated rows score
alike. Only ``doc_id, text`` and, for learning, ``lang`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from docindex.llm.common import bucket, ship, slices

#: Labelled rows per language that are looked at, and bytes kept of all languages together.
SAMPLE_ROWS = 40
SAMPLE_BYTES = 160_000
LEAST_BYTES = 2_000
FOLDS, HELD_OUT = 4, 2
UNKNOWN = "und"
BLOCK = 256
BATCH_TEXT = 2 << 20

PREDICTED = "doc_id long, held_out boolean, lang_pred string, score double"

# Classes of bytes: 0 ends a block, 1 is a blank, letters and bytes of longer characters follow.
PAD, BLANK = 0, 1
CLASS = np.ones(256, np.uint8)
CLASS[ord("a") : ord("z") + 1] = np.arange(2, 28)
CLASS[ord("A") : ord("Z") + 1] = np.arange(2, 28)
CLASS[128:] = np.arange(28, 156)
CLASSES = 156


def classes(data: np.ndarray) -> np.ndarray:
    """Classes of bytes; runs of blanks are one."""
    found = CLASS[data]
    blank = found == BLANK
    blank[1:] &= found[:-1] == BLANK
    if len(blank):
        blank[0] = False
    return found[~blank]


def automaton(symbols: np.ndarray) -> np.ndarray:
    """Transitions (state, class) of the suffix automaton.

    A known step is its target; a step that begins a phrase, as all from the first
    state do, is the complement of the state after it.
    """
    links, longest, steps = [-1], [0], [{}]
    last = 0
    for c in symbols.tolist():
        state = len(links)
        links.append(0)
        longest.append(longest[last] + 1)
        steps.append({})
        p = last
        while p >= 0 and c not in steps[p]:
            steps[p][c] = state
            p = links[p]
        if p >= 0:
            q = steps[p][c]
            if longest[p] + 1 == longest[q]:
                links[state] = q
            else:
                twin = len(links)
                links.append(links[q])
                longest.append(longest[p] + 1)
                steps.append(dict(steps[q]))
                while p >= 0 and steps[p].get(c) == q:
                    steps[p][c] = twin
                    p = links[p]
                links[q] = links[state] = twin
        last = state
    start = np.zeros(CLASSES, np.int32)
    for c, target in steps[0].items():
        start[c] = target
    table = np.repeat(~start[None, :], len(steps), axis=0)
    for state, known in enumerate(steps):
        if known and state:
            table[state, list(known)] = list(known.values())
    table[:, PAD] = 0
    return table


class Parser:
    """All languages' automata, over the classes that occur in any sample."""

    def __init__(self, samples: tuple[tuple[str, bytes], ...]) -> None:
        self.names = [name for name, _ in samples]
        texts = [classes(np.frombuffer(data, np.uint8)) for _, data in samples]
        used = np.unique(np.concatenate([np.array([PAD, BLANK], np.uint8), *texts]))
        self.short = np.full(CLASSES, len(used), np.uint8)
        self.short[used] = np.arange(len(used))
        # The last column is for classes that no sample has: a phrase of its own.
        self.tables = [self._narrow(automaton(t), used) for t in texts]
        self.width = len(used) + 1
        self.bits = np.array([np.log2(max(len(t), 2)) for t in texts])

    @staticmethod
    def _narrow(table: np.ndarray, used: np.ndarray) -> np.ndarray:
        return np.concatenate([table[:, used], np.full((len(table), 1), -1, np.int32)], axis=1)

    def phrases(self, grid: np.ndarray) -> np.ndarray:
        """Phrases (language, block) of blocks that are the columns of ``grid``."""
        counts = np.zeros((len(self.tables), grid.shape[1]), np.int64)
        steps = grid.astype(np.int32)
        for k, table in enumerate(self.tables):
            flat, state = table.ravel(), np.zeros(grid.shape[1], np.int32)
            begun = np.zeros(grid.shape[1], np.int32)
            for row in steps:
                to = flat[state * self.width + row]
                over = to >> 31
                begun -= over
                state = to ^ over
            counts[k] = begun
        return counts

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Bits per symbol (text, language), and which texts have a letter."""
        parts = [classes(np.frombuffer(t.lower().encode(), np.uint8)) for t in texts]
        lengths = np.array([len(p) for p in parts], np.int64)
        blocks = -(-lengths // BLOCK)
        wide = np.zeros(int(blocks.sum()) * BLOCK, np.uint8)
        begins = (np.cumsum(blocks) - blocks) * BLOCK
        for part, begin in zip(parts, begins.tolist()):
            wide[begin : begin + len(part)] = part
        grid = np.ascontiguousarray(self.short[wide].reshape(-1, BLOCK).T)
        owner = np.repeat(np.arange(len(texts)), blocks)
        counts = np.array([np.bincount(owner, c, len(texts)) for c in self.phrases(grid)])
        plain = np.array([bool(((p >= 2) & (p < 28)).any()) or any(c.isalpha() for c in t) for p, t in zip(parts, texts)], bool)
        return (counts * self.bits[:, None] / np.maximum(lengths, 1)).T, plain

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        bits, letters = self.entropies([t or "" for t in texts])
        if not len(texts):
            return [], np.empty(0)
        best = np.argmin(bits, axis=1)
        odds = np.exp2(bits.min(axis=1, keepdims=True) - bits)
        return (
            [self.names[b] if ok else UNKNOWN for b, ok in zip(best.tolist(), letters.tolist())],
            np.where(letters, 1 / odds.sum(axis=1), 0.0),
        )


@lru_cache(maxsize=2)
def parser(samples: tuple[tuple[str, bytes], ...]) -> Parser:
    return Parser(samples)


def learned(docs: DataFrame) -> tuple[tuple[str, bytes], ...]:
    """A bounded sample of each language's labelled text outside the held-out fold."""
    doc_id = F.col("doc_id").cast("long")
    rows = docs.select(doc_id.alias("doc_id"), "lang", "text").where(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (bucket(F.col("doc_id"), FOLDS) != HELD_OUT)
    )
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    # Ranks are cut in every task before the shuffle, so a frequent language stays small; texts follow by id.
    chosen = rows.select("doc_id", "lang").withColumn("place", place).where(F.col("place") <= SAMPLE_ROWS)
    sample = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).orderBy("lang", "place", "text")
    texts: dict[str, list[bytes]] = {}
    for row in sample.select("lang", "text").toArrow().to_pylist():
        texts.setdefault(row["lang"], []).append(row["text"].lower().encode())
    most = max(LEAST_BYTES, SAMPLE_BYTES // max(len(texts), 1))
    return tuple((lang, b" ".join(parts)[:most]) for lang, parts in sorted(texts.items()))


def _predictions(samples):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_TEXT):
            texts = batch.column("text").to_pylist()
            names, score = parser(samples).predict(texts) if samples else ([UNKNOWN] * len(texts), np.zeros(len(texts)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(names, pa.string()), pa.array(score)],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def predict(docs: DataFrame, samples: tuple[tuple[str, bytes], ...]) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score."""
    ship(docs.sparkSession)
    doc_id = F.col("doc_id").cast("long")
    held_out = F.coalesce(bucket(doc_id, FOLDS) == HELD_OUT, F.lit(False))
    return docs.select(doc_id.alias("doc_id"), held_out.alias("held_out"), "text").mapInArrow(_predictions(samples), PREDICTED)


def languages(docs: DataFrame) -> DataFrame:
    return predict(docs, learned(docs))
