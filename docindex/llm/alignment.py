"""Alignment of two tokenizers' tokens, and how often their ids meet in the corpus.

Every batch of texts is encoded by both tokenizers, each distinct chunk once. In Arrow, the id lists are flattened
beside their parent indices, segmented cumulative sums of the tokens' bytes give every
token's end, and an Acero full outer hash join on the document-end keys of both sides
lists all borders of a document. Between two neighbouring borders lies exactly one
overlap of a token of each side, so after filling backwards each row is one link, and the
rows that come from both sides are the ends of groups. ``Table.group_by`` counts, batch
by batch, how many documents hold an id pair linked; Spark sums these partial counts.

The corpus-wide counts return to the documents in two ways that give the same sums. The
``FREQUENT`` most frequent pairs, found by a histogram of the counts, are broadcast and
summed inside the tasks, so a pair that nearly all documents hold is never shuffled; every
other pair is rarer than those and joins by its key. An id's highest count is broadcast
inside the counts' table: there is one for each id of the vocabulary.

Defined cases: a null or empty text, or one whose joined token bytes differ from a space
and the text on either side, has no tokens: zeros and an empty ``groups_sha256``. Null and
repeated ids are documents like any other. An empty table gives no rows. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from docindex.llm.common import Known, held, id_and_text, ship, slices, sums, text_bytes
from docindex.llm.token_files import LINE, UNEVEN
from docindex.workspace import materialise

BATCH_TEXT = 2 << 20
#: Pairs whose counts are sent to every task, at most; 16 bytes each.
FREQUENT = 1 << 18
#: Bytes of chunks and their ids that a side remembers.
MEMORY = 96 << 20
CALL = 4000
SPACE = "▁"

FIGURES = ("n_a", "n_b", "n_groups", "n_links")
# The lists hold a document's linked pairs and how often; the partial counts of a batch stand on its first row.
ALIGNED = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<long>, times array<int>, "
    "counted array<long>, documents array<long>"
)
SUMMED = "row long, n_best long, count_sum long, rest array<long>, rest_times array<int>"


def default_tokenizers() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary writes bytes.

    Printable bytes stand for themselves; the others, in order, for the code points from 256 on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in printable]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(others)}


class Side:
    """One tokenizer: the ids of texts, and every id's bytes.

    No token spans a space that stands between two other characters, or such a line break,
    so the chunks between those are encoded once and remembered.
    """

    def __init__(self, values: list[bytes]) -> None:
        self.lengths = pa.array([len(v) for v in values], pa.int64())
        self.bytes = pa.array(values, pa.large_binary())
        self.memory = Known(np.int32, self._chunks, MEMORY)

    def whole(self, texts: list[str]) -> list[list[int]]:
        """Ids of a space and each text."""
        raise NotImplementedError

    def _chunks(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks behind a space, or behind a line break where the key says so."""
        raise NotImplementedError

    def encode(self, texts: pa.Array, even: np.ndarray, chunks: pa.DictionaryArray, counts: np.ndarray) -> pa.ListArray:
        """Ids of a space and each text; ``even`` texts come as ``counts`` chunks each, empty ones have none."""
        ids, lengths = self.memory.take(chunks)
        size = np.zeros(len(texts), np.int64)
        size[even] = sums(lengths, counts)
        odd = np.flatnonzero(~even & (pc.binary_length(texts).to_numpy() > 0))
        if len(odd):
            found = [np.array(x, np.int32) for x in self.whole(texts.take(pa.array(odd)).to_pylist())]
            size[odd] = [len(x) for x in found]
            owner = np.repeat(np.arange(len(texts)), size)
            flat = np.empty(len(owner), np.int32)
            flat[even[owner]], flat[~even[owner]] = ids, np.concatenate(found)
            ids = flat
        borders = np.concatenate([[0], np.cumsum(size)]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(borders), pa.array(ids))

    def joined(self, ids: pa.Array) -> np.ndarray:
        return text_bytes(self.bytes.take(ids))[0]


class Spaced(Side):
    """A byte-level tokenizer, given a space before the text."""

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.parting = Tokenizer.from_file(vocabulary), Tokenizer.from_file(vocabulary)
        self.tokenizer.encode_special_tokens = True
        added = self.tokenizer.get_added_tokens_decoder()
        letter = byte_letters()
        ids = {i: t for t, i in self.tokenizer.get_vocab(with_added_tokens=True).items()}
        values = [added[i].content.encode() if i in added else bytes(letter[c] for c in ids.get(i, "")) for i in range(max(ids) + 1)]
        # A special token takes no space beside it, so it can part many chunks in one call.
        self.part = next(((i, t.content) for i, t in added.items() if t.special and not (t.lstrip or t.rstrip or t.single_word)), None)
        super().__init__(values)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)]

    def _chunks(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        texts = ["\n" + k[1:] if k[:1] == LINE else " " + k for k in keys]
        if self.part is None or any(self.part[1] in k for k in keys):
            found = [np.array(x.ids, np.int32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            return np.concatenate(found), np.array([len(x) for x in found], np.int64)
        ids, lengths = [], []
        for at in range(0, len(texts), CALL):
            text = self.part[1].join(texts[at : at + CALL]) + self.part[1]
            some = np.array(self.parting.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int32)
            stops = np.flatnonzero(some == self.part[0])
            lengths.append(np.diff(stops, prepend=-1) - 1)
            ids.append(np.delete(some, stops))
        return np.concatenate(ids), np.concatenate(lengths)


class Pieced(Side):
    """A piece model, which puts the space before the text itself."""

    def __init__(self, model: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = p = SentencePieceProcessor(model_file=model)
        names = [p.id_to_piece(i) for i in range(p.get_piece_size())]
        super().__init__([
            bytes([int(s[3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else s.replace(SPACE, " ").encode() for i, s in enumerate(names)
        ])
        # The space before a line break is a piece of its own if no piece holds a line break.
        self.lines = not any("\n" in s for s in names)

    def whole(self, texts: list[str]) -> list[list[int]]:
        return self.model.encode(texts, num_threads=1)

    def _chunks(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        line = np.array([k[:1] == LINE for k in keys])
        found = self.model.encode(["\n" + k[1:] if b else k for k, b in zip(keys, line)], num_threads=1)
        lengths = np.array([len(x) for x in found], np.int64)
        ids = np.array([i for x in found for i in x], np.int32)
        first = np.cumsum(lengths) - lengths
        return np.delete(ids, first[line]), lengths - line


def chunked(texts: pa.Array, lines: bool) -> tuple[np.ndarray, pa.DictionaryArray, np.ndarray]:
    """Which texts fall into chunks, their coded chunks, and how many each has."""
    even = ~pc.match_substring_regex(texts, f"{UNEVEN}|{SPACE}").to_numpy(zero_copy_only=False) & (pc.binary_length(texts).to_numpy() > 0)
    if not lines:
        even &= ~pc.match_substring(texts, "\n").to_numpy(zero_copy_only=False)
    lists = pc.split_pattern(pc.replace_substring(texts.filter(pa.array(even)), "\n", f" {LINE}"), " ")
    return even, lists.flatten().dictionary_encode(), pc.list_value_length(lists).to_numpy().astype(np.int64)


def sides(vocabulary: str, model: str) -> tuple[Spaced, Pieced]:
    return held(("alignment", vocabulary, model), lambda: (Spaced(vocabulary), Pieced(model)))


def ends_of(ids: pa.ListArray, side: Side) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Flat ids, each one's document, and each one's end in its document."""
    flat, parents = pc.list_flatten(ids), pc.list_parent_indices(ids).to_numpy()
    lengths = side.lengths.take(flat).to_numpy()
    total = np.cumsum(lengths)
    counts = np.bincount(parents, minlength=len(ids)) if len(parents) else np.zeros(len(ids), np.int64)
    first = np.cumsum(counts) - counts
    before = np.where(first > 0, total[np.minimum(first, len(total)) - 1], 0) if len(total) else first
    return flat, parents, total - before[parents]


def whole(ids: pa.ListArray, side: Side, data: np.ndarray, borders: np.ndarray) -> np.ndarray:
    """Whether each document's tokens join to a space and its text."""
    flat = pc.list_flatten(ids)
    counts = pc.list_value_length(ids).to_numpy()
    made, wanted = sums(side.lengths.take(flat).to_numpy(), counts), np.diff(borders) + 1
    same = made == wanted
    raw, at, spaced = side.joined(flat).tobytes(), np.cumsum(made) - made, data.tobytes()
    for d in np.flatnonzero(same).tolist():
        a, b = int(at[d]), int(borders[d])
        n = int(wanted[d]) - 1
        same[d] = raw[a : a + 1] == b" " and raw[a + 1 : a + 1 + n] == spaced[b : b + n]
    return same


def linked(a: tuple, b: tuple) -> pa.Table:
    """One row per link, in text order: key, document, a, b (places of tokens), both (a group ends here)."""
    base = None
    tables = []
    for name, (flat, parents, ends) in (("a", a), ("b", b)):
        if base is None:  # the documents one after the other; both sides are equally long
            longest = np.zeros(parents[-1] + 1, np.int64)
            longest[parents] = ends  # the last one stays
            base = np.cumsum(longest) - longest
        tables.append(pa.table({"key": pa.array(base[parents] + ends), name: pa.array(np.arange(len(flat)))}))
    every = tables[0].join(tables[1], keys="key", join_type="full outer", use_threads=False)
    every = every.take(pa.array(np.argsort(every.column("key").to_numpy(), kind="stable")))
    both = pc.and_(pc.is_valid(every.column("a")), pc.is_valid(every.column("b")))
    at, bt = (pc.fill_null_backward(every.column(c).combine_chunks()) for c in "ab")
    document = pa.array(a[1]).take(at)
    return pa.table({"document": document, "a": at, "b": bt, "both": both})


def group_texts(n: int, a: tuple, b: tuple, links: pa.Table) -> list[bytes]:
    """Per document its groups as text: ids of a, a bar, ids of b, groups apart by semicolons."""
    both = links.column("both").to_numpy()
    last_a, last_b = (links.column(c).to_numpy()[both] for c in "ab")
    g = len(last_a)
    group_a = np.searchsorted(last_a, np.arange(len(a[0])))
    group_b = np.searchsorted(last_b, np.arange(len(b[0])))
    count_a, count_b = np.bincount(group_a, minlength=g), np.bincount(group_b, minlength=g)
    size = count_a + count_b
    place_a = np.arange(len(a[0])) + (np.cumsum(count_b) - count_b)[group_a]
    place_b = np.arange(len(b[0])) + np.cumsum(count_a)[group_b]
    ids = np.empty(int(size.sum()), np.int64)
    ids[place_a], ids[place_b] = a[0].to_numpy(zero_copy_only=False), b[0].to_numpy(zero_copy_only=False)
    mark = np.full(len(ids), ",", "U1")
    mark[place_a[last_a]] = "|"
    mark[place_b[last_b]] = ";"
    document = np.empty(len(ids), np.int64)
    document[place_a], document[place_b] = a[1], b[1]
    counts = np.bincount(document, minlength=n)
    stops = np.cumsum(counts)
    mark[stops[counts > 0] - 1] = ""
    words = pc.binary_join_element_wise(pa.array(ids).cast(pa.string()), pa.array(mark.tolist(), pa.string()), "")
    lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], stops]).astype(np.int32)), words)
    return [t.encode() for t in pc.binary_join(lists, "").to_pylist()]


def counted_pairs(pairs: pa.Table) -> pa.Table:
    """Distinct pairs of each document with how often they are linked: document, pair, times."""
    return pairs.group_by(["document", "pair"], use_threads=False).aggregate([([], "count_all")]).rename_columns(["document", "pair", "times"])


def _lists(n: int, document: np.ndarray, values: pa.Array) -> pa.ListArray:
    borders = np.searchsorted(document, np.arange(n + 1))
    return pa.ListArray.from_arrays(pa.array(borders.astype(np.int32)), values)


def align(texts: pa.Array, vocabulary: str, model: str) -> dict[str, pa.Array]:
    """The columns of ``ALIGNED`` but the id."""
    n = len(texts)
    data, borders = text_bytes(texts)
    pair_of_sides = sides(vocabulary, model)
    chunks = chunked(texts, pair_of_sides[1].lines)
    ids = [s.encode(texts, *chunks) for s in pair_of_sides]
    sound = np.diff(borders) > 0
    for side, x in zip(pair_of_sides, ids):
        sound &= whole(x, side, data, borders)
    out = {c: np.zeros(n, np.int64) for c in FIGURES}
    digests = [""] * n
    kept = np.flatnonzero(sound)
    if len(kept):
        a, b = (ends_of(x.take(pa.array(kept)), s) for x, s in zip(ids, pair_of_sides))
        links = linked(a, b)
        document = links.column("document").to_numpy()
        for name, owner in (("n_a", a[1]), ("n_b", b[1]), ("n_links", document), ("n_groups", document[links.column("both").to_numpy()])):
            out[name][kept] = np.bincount(owner, minlength=len(kept))
        for d, text in zip(kept.tolist(), group_texts(len(kept), a, b, links)):
            digests[d] = hashlib.sha256(text).hexdigest()
        pair = (a[0].take(links.column("a")).cast(pa.int64()).to_numpy() << 32) | b[0].take(links.column("b")).cast(pa.int64()).to_numpy()
        each = counted_pairs(pa.table({"document": pa.array(kept[document]), "pair": pa.array(pair)}))
    else:
        each = pa.table({"document": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})
    owner = each.column("document").to_numpy()
    each = each.take(pa.array(np.argsort(owner, kind="stable")))
    owner = each.column("document").to_numpy()
    partial = each.group_by("pair", use_threads=False).aggregate([([], "count_all")])
    first = np.zeros(n + 1, np.int32)
    first[1:] = partial.num_rows
    columns = {c: pa.array(out[c]) for c in FIGURES} | {"groups_sha256": pa.array(digests, pa.string())}
    return columns | {
        "pairs": _lists(n, owner, each.column("pair").combine_chunks()), "times": _lists(n, owner, each.column("times").combine_chunks().cast(pa.int32())),
        "counted": pa.ListArray.from_arrays(pa.array(first), partial.column("pair").combine_chunks()),
        "documents": pa.ListArray.from_arrays(pa.array(first), partial.column("count_all").combine_chunks()),
    }


def _aligned(vocabulary: str, model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_TEXT):
            columns = align(batch.column("text"), vocabulary, model)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns.values()], names=["doc_id", *columns])

    return run


def aligned(docs: DataFrame, vocabulary: str | None = None, model: str | None = None) -> DataFrame:
    """Every document once encoded and aligned, as a written table; ``row`` tells equal rows apart."""
    a, b = default_tokenizers()
    ship(docs.sparkSession)
    rows = id_and_text(docs).mapInArrow(_aligned(vocabulary or a, model or b), ALIGNED)
    return materialise(rows.withColumn("row", F.monotonically_increasing_id()), "aligned")


def pair_counts(rows: DataFrame) -> DataFrame:
    """In how many documents each id pair is linked, and whether that is its A id's highest: pair, n, best."""
    partial = rows.where(F.size("counted") > 0).select(F.explode(F.arrays_zip("counted", "documents")).alias("p"))
    counts = materialise(partial.groupBy(F.col("p.counted").alias("pair")).agg(F.sum("p.documents").alias("n")), "pair-counts")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    return materialise(counts.join(highest, a == F.col("a")).select("pair", "n", (F.col("n") == F.col("most")).alias("best")), "pair-best")


def frequent_from(counts: DataFrame, most: int) -> int:
    """The least count such that no more than ``most`` pairs reach it, from histograms of counts.

    Each round counts pairs by the next digits of their count, so no round has more than a few hundred rows.
    """
    high = counts.agg(F.max("n")).first()[0] or 0
    low, width, above = 0, 1, 0
    while width * 256 <= high:
        width *= 256
    while width:
        bins = F.expr(f"(n - {low}) div {width}")
        found = sorted(counts.where((F.col("n") >= low) & (F.col("n") < low + 256 * width)).groupBy(bins.alias("bin")).count().collect(), reverse=True)
        for b, n in found:
            if above + n > most:
                low += b * width
                break
            above += n
        else:
            return low  # all of them fit
        width //= 256
    return low + 1


def _weighed(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs, counts, best = sent.value
        for batch in batches:
            lists, times = batch.column("pairs"), batch.column("times")
            flat, often = lists.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
            size = pc.fill_null(pc.list_value_length(lists), 0).to_numpy().astype(np.int64)
            at = np.searchsorted(pairs, flat)
            at[at == len(pairs)] = 0
            known = pairs[at] == flat if len(pairs) else np.zeros(len(flat), bool)
            weight, is_best = (np.where(known, x[at], 0) if len(pairs) else np.zeros(len(flat), np.int64) for x in (counts, best))
            borders = np.concatenate([[0], np.cumsum(sums(~known, size))]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"), pa.array(sums(often * is_best, size)), pa.array(sums(often * weight, size)),
                    pa.ListArray.from_arrays(pa.array(borders), pa.array(flat[~known])),
                    pa.ListArray.from_arrays(pa.array(borders), pa.array(often[~known].astype(np.int32))),
                ],
                names=["row", "n_best", "count_sum", "rest", "rest_times"],
            )

    return run


def link_sums(rows: DataFrame, counts: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """Per row with links: n_best, count_sum."""
    spark = rows.sparkSession
    least = frequent_from(counts, frequent)
    known = counts.where(F.col("n") >= least).toArrow().sort_by("pair")  # ``frequent`` rows at most
    sent = spark.sparkContext.broadcast((known.column("pair").to_numpy(), known.column("n").to_numpy(), known.column("best").to_numpy().astype(np.int64)))
    weighed = materialise(rows.where("n_links > 0").select("row", "pairs", "times").mapInArrow(_weighed(sent), SUMMED), "weighed")
    rest = weighed.where(F.size("rest") > 0).select("row", F.explode(F.arrays_zip("rest", "rest_times")).alias("p"))
    rest = rest.select("row", F.col("p.rest").alias("pair"), F.col("p.rest_times").alias("times")).join(counts.where(F.col("n") < least), "pair")
    rest = rest.select("row", F.when(F.col("best"), F.col("times")).otherwise(0).cast("long").alias("n_best"), (F.col("times") * F.col("n")).alias("count_sum"))
    both = weighed.select("row", "n_best", "count_sum").unionByName(rest)
    return both.groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))


def alignment(docs: DataFrame, vocabulary: str | None = None, model: str | None = None, frequent: int = FREQUENT) -> DataFrame:
    """Per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = aligned(docs, vocabulary, model)
    found = link_sums(rows, pair_counts(rows), frequent)
    zero = F.lit(0).cast("long")
    return rows.select("row", "doc_id", *FIGURES, "groups_sha256").join(found, "row", "left").select(
        "doc_id", *FIGURES, F.coalesce("n_best", zero).alias("n_best"), F.coalesce("count_sum", zero).alias("count_sum"), "groups_sha256",
    )
