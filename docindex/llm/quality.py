"""Quality classifier: supervised subword embeddings.

A word (a run without white space) is the average of the learned vectors of its hashed
self and its hashed character n-grams; a document is the average of its words, and of
one mark for every word that repeats the word before it (the word pair "w w", whatever
w is). A softmax over the document vector gives the score. The model is trained by
stochastic gradient descent in numpy on a sample of labelled rows that ``SAMPLE_ROWS``
bounds; scoring reads whole texts, one word's share of the logit being computed once.

Defined cases: a null or empty text scores as the model's intercept; null labels teach
nothing; of several labels of one id the highest counts; without labels, or with one
label only, every score is the share of label 1 (0.5 without any). A null id is not
held out. Repeated rows score alike. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docindex.llm.common import MEMORY_BYTES, Codes, bucket, held, id_and_text, mixed, ship, slices

#: Labelled rows that are learned from, and the longest text among them.
SAMPLE_ROWS = 4_000
SAMPLE_CHARS = 20_000
FOLDS, HELD_OUT = 5, 0
THRESHOLD = 0.3

BUCKETS = 1 << 16
GRAMS = (3, 4)
DIMENSIONS = 12
EPOCHS, BATCH, RATE = 4, 32, 0.5
BATCH_TEXT = 8 << 20

SCORED = "doc_id long, held_out boolean, score double, predicted int"


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all words one after the other, and how many each word has.

    >>> rows, counts = features(["ab", "abcd"])
    >>> counts.tolist()   # the word; <ab, ab>, <ab>   /   the word; four 3-grams, three 4-grams
    [4, 8]
    """
    lengths = np.fromiter(map(len, words), np.int64, len(words)) + 2
    points = np.frombuffer("".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    starts = np.cumsum(lengths) - lengths
    word = np.repeat(np.arange(len(words)), lengths)
    place = np.arange(len(points)) - starts[word]
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max(initial=1)), 0x9E3779B97F4A7C15, np.uint64))
        whole = np.add.reduceat(mixed(points + np.uint64(1)) * powers[place], starts) if len(words) else np.empty(0, np.uint64)
        hashes, owners = [mixed(whole)], [np.arange(len(words))]
        for n in GRAMS:
            at = np.flatnonzero(place + n <= lengths[word])
            h = np.full(len(at), n, np.uint64)
            for k in range(n):
                h = mixed(h * np.uint64(0x100000001B3) + points[at + k])
            hashes.append(h)
            owners.append(word[at])
    owners, hashes = np.concatenate(owners), np.concatenate(hashes)
    by = np.argsort(owners, kind="stable")
    return (hashes[by] % np.uint64(BUCKETS)).astype(np.int64), np.bincount(owners, minlength=len(words))


class Words:
    """Codes of words, and per text the codes and the number of repetitions."""

    def __init__(self) -> None:
        self.codes = Codes()

    def read(self, texts: Iterable[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        codes: list[int] = []
        counts: list[int] = []
        code = self.codes.__getitem__
        for text in texts:
            before = len(codes)
            codes += map(code, text.split())
            counts.append(len(codes) - before)
        flat, counts = np.array(codes, np.int64), np.array(counts, np.int64)
        owner = np.repeat(np.arange(len(counts)), counts)
        again = np.flatnonzero((flat[1:] == flat[:-1]) & (owner[1:] == owner[:-1])) if len(flat) else np.empty(0, np.int64)
        return flat, counts, np.bincount(owner[again + 1] if len(again) else again, minlength=len(counts))


@dataclass(frozen=True)
class Model:
    """``weights`` is each bucket's share of the logit of label 1; the last one is the mark's."""

    weights: bytes
    intercept: float

    def vector(self) -> np.ndarray:
        return np.frombuffer(self.weights, np.float32)


def trained(texts: list[str], labels: np.ndarray, seed: int = 7) -> Model:
    """Gradient descent over documents in random order."""
    share = float(np.mean(labels)) if len(labels) else 0.5
    if len(np.unique(labels)) < 2:
        limit = np.clip(share, 1e-6, 1 - 1e-6)
        return Model(np.zeros(BUCKETS + 1, np.float32).tobytes(), float(np.log(limit / (1 - limit))))
    words = Words()
    flat, counts, again = words.read(texts)
    rows, grams = features(words.codes.fresh())
    share_of = 1.0 / np.repeat(grams, grams)
    first = np.cumsum(grams) - grams
    starts = np.cumsum(counts) - counts
    bags = []
    for d in range(len(texts)):
        codes, times = np.unique(flat[starts[d] : starts[d] + counts[d]], return_counts=True)
        at = np.repeat(first[codes] - (np.cumsum(grams[codes]) - grams[codes]), grams[codes]) + np.arange(grams[codes].sum())
        total = counts[d] + again[d]
        weight = np.repeat(times, grams[codes]) * share_of[at] / max(total, 1)
        ids = np.append(rows[at], BUCKETS)
        weight = np.append(weight, again[d] / max(total, 1))
        order, place = np.unique(ids, return_inverse=True)
        bags.append((order, np.bincount(place, weight).astype(np.float32)))
    random = np.random.default_rng(seed)
    table = random.uniform(-1, 1, (BUCKETS + 1, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    out = np.zeros((DIMENSIONS, 2), np.float32)
    base = np.log(np.array([1 - share, share], np.float32))
    target = np.eye(2, dtype=np.float32)[labels.astype(int)]
    steps = EPOCHS * -(-len(bags) // BATCH)
    done = 0
    for _ in range(EPOCHS):
        order = random.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            rate = RATE * (1 - done / steps)
            done += 1
            ids = np.concatenate([bags[i][0] for i in some])
            weight = np.concatenate([bags[i][1] for i in some])[:, None]
            sizes = np.array([len(bags[i][0]) for i in some])
            hidden = np.add.reduceat(table[ids] * weight, np.cumsum(sizes) - sizes)
            logits = hidden @ out + base
            odds = np.exp(logits - logits.max(1, keepdims=True))
            error = odds / odds.sum(1, keepdims=True) - target[some]
            back = error @ out.T
            out -= rate * hidden.T @ error
            base -= rate * error.mean(0)
            np.add.at(table, ids, -rate * BATCH * np.repeat(back, sizes, axis=0) * weight)
    difference = out[:, 1] - out[:, 0]
    return Model((table @ difference).astype(np.float32).tobytes(), float(base[1] - base[0]))


class Scorer:
    def __init__(self, model: Model) -> None:
        self.model, self.weights = model, model.vector().astype(np.float64)
        self.forget()

    def forget(self) -> None:
        self.words, self.share, self.size = Words(), np.empty(0), 0

    def score(self, texts: list[str]) -> np.ndarray:
        if self.size > MEMORY_BYTES:
            self.forget()
        flat, counts, again = self.words.read(texts)
        new = self.words.codes.fresh()
        if new:
            rows, grams = features(new)
            shares = np.add.reduceat(self.weights[rows], np.cumsum(grams) - grams) / grams
            self.share = np.concatenate([self.share, shares])
            self.size += sum(map(len, new)) + 160 * len(new)
        total = np.concatenate([[0.0], np.cumsum(self.share[flat])])
        ends = np.cumsum(counts)
        logit = total[ends] - total[ends - counts] + again * self.weights[BUCKETS]
        logit = logit / np.maximum(counts + again, 1) + self.model.intercept
        return 1 / (1 + np.exp(-np.clip(logit, -50, 50)))


def scorer(model: Model) -> Scorer:
    return held(("quality", model), lambda: Scorer(model))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from a sample of the labelled rows outside the held-out fold, in an order given by a hash."""
    chosen = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
        .where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (bucket(F.col("doc_id"), FOLDS) != HELD_OUT))
        .groupBy("doc_id").agg(F.max("quality").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_ROWS)
    )
    # At most SAMPLE_ROWS pairs of numbers.
    rows = (
        id_and_text(docs).where(F.char_length("text") <= SAMPLE_CHARS).join(F.broadcast(chosen), "doc_id")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(SAMPLE_ROWS).toArrow()
    )
    return trained(rows.column("text").to_pylist(), np.array(rows.column("quality").to_pylist(), np.int64))


def _scores(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_TEXT):
            score = scorer(model.value).score(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= THRESHOLD).astype(np.int32))],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    return run


def score(docs: DataFrame, model: Model) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)  # BUCKETS numbers
    held_out = F.coalesce(bucket(F.col("doc_id"), FOLDS) == HELD_OUT, F.lit(False))
    return id_and_text(docs).select("doc_id", "text", held_out.alias("held_out")).mapInArrow(_scores(sent), SCORED)


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))


def without_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, with all their columns, in one pass."""
    model = fit(docs, labels)
    spark = ship(docs.sparkSession)
    sent = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_TEXT):
            texts = [t or "" for t in batch.column("text").to_pylist()]
            yield batch.filter(pa.array(scorer(sent.value).score(texts) >= THRESHOLD))

    return docs.mapInArrow(run, docs.schema)
