"""Near-duplicate groups by order MinHash.

A text's shingles are its runs of five words, each labelled with how often the same
run stood before it. Each of ``SKETCHES`` hash functions picks the ``PICKED`` labelled
shingles with the least hashes and keeps them in text order; two texts get the same
sketch with a probability that falls with their edit distance. Texts with a common
sketch are candidates.

A candidate pair is verified by alignment: the longest chain of labelled shingles that
stand in both texts in the same order, inside the band of offsets that the threshold
leaves possible. Its length over the number of shingles in either text has to reach
``SIMILARITY``.

Equal word sequences are one node from the start. Every node is compared with leaders of the
buckets of equal sketches that it is in: that joins large groups at a cost in proportion to their
nodes, and goes on while it links many. Then all that is open is settled once: of the candidates of
different groups those are tested that share one of their rarest shingles, as similar texts must.
So copies cost little, and so does a crowd of texts below the threshold that share a template,
whose rare shingles are each text's own.
A link is missed only if the two texts share no sketch (1 pair in 100,000 at the very threshold).

Defined cases: a null text is empty; texts without words are one group; fewer than five
words are one shingle. Of a group the row with the smallest id, then the smallest hash
of its text, stays; null ids come last. Rows with equal id and text are one document
for a filter. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from docindex.llm.common import MEMORY_BYTES, Codes, first_rows, held, id_and_text, mixed, rows_of, ship, slices, text_bytes, text_hash
from docindex.workspace import materialise

SHINGLE = 5
SIMILARITY = 0.8
SKETCHES, PICKED = 16, 3
#: Leaders of a bucket in the first round, which links most, and in each later one.
LEADERS = (1, 8)
#: Share of the nodes that a round of leaders links anew, at least, to be followed by another.
JOINS = 0.5
#: Blocks of nodes whose pairs are verified together, at least, and the bytes of shingles in one.
BLOCKS, BLOCK_BYTES = 32, 4 << 20
BATCH_TEXT = 4 << 20
WORD = re.compile(r"\w+")

SKETCHED = "doc_id long, text_print long, node binary, shingles long, sketches array<long>"
VERIFIED = "a binary, b binary"


class Hasher:
    """64-bit hashes of lower-cased words, remembered."""

    def __init__(self) -> None:
        self.codes, self.hashes, self.size = Codes(), np.empty(0, np.uint64), 0

    def words(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The words' hashes one after the other, and each text's number of words."""
        import xxhash

        if self.size > MEMORY_BYTES:
            self.codes, self.hashes, self.size = Codes(), np.empty(0, np.uint64), 0
        codes: list[int] = []
        counts: list[int] = []
        code = self.codes.__getitem__
        for text in texts:
            before = len(codes)
            codes += map(code, WORD.findall(text.lower()))
            counts.append(len(codes) - before)
        new = self.codes.fresh()
        self.size += sum(map(len, new)) + 160 * len(new)
        digest = xxhash.xxh3_64_intdigest
        self.hashes = np.concatenate([self.hashes, np.fromiter((digest(w) for w in new), np.uint64, len(new))])
        return self.hashes[np.array(codes, np.int64)], np.array(counts, np.int64)


def hasher() -> Hasher:
    return held(("near words",), Hasher)


def labelled(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Labelled shingles of all texts one after the other, and each text's number of them.

    >>> s, n = labelled(np.array([1, 1, 1, 1, 1, 1, 2], np.uint64), np.array([6, 0, 1]))
    >>> n.tolist(), len(set(s.tolist()))
    ([2, 0, 1], 3)
    """
    numbers = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    owner = np.repeat(np.arange(len(counts)), numbers)
    begins, firsts = np.cumsum(counts) - counts, np.cumsum(numbers) - numbers
    at = np.arange(len(owner)) - firsts[owner] + begins[owner]
    ends = (begins + counts)[owner]
    with np.errstate(over="ignore"):
        runs = np.zeros(len(owner), np.uint64)
        for k in range(SHINGLE):
            there = at + k < ends
            word = words[np.minimum(at + k, len(words) - 1)] if len(words) else runs
            runs = np.where(there, mixed(runs * np.uint64(0x9E3779B97F4A7C15) + word), runs)
        order = np.lexsort((runs, owner))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (runs[order][1:] != runs[order][:-1]) | (owner[order][1:] != owner[order][:-1])
        place = np.arange(len(order))
        label = np.empty(len(order), np.uint64)
        label[order] = place - np.maximum.accumulate(np.where(fresh, place, 0))
        return mixed(runs + label * np.uint64(0xD6E8FEB86659FD93)), numbers


def sketches(shingles: np.ndarray, numbers: np.ndarray) -> np.ndarray:
    """Order MinHash sketches (text, function) of texts that have shingles each."""
    starts = np.cumsum(numbers) - numbers
    place = np.arange(len(shingles))
    most = np.uint64(0xFFFFFFFFFFFFFFFF)
    out = np.zeros((len(numbers), SKETCHES), np.uint64)
    with np.errstate(over="ignore"):
        for j in range(SKETCHES):
            hashes = mixed(shingles ^ mixed(np.full(1, j + 1, np.uint64)))
            spots = np.full((len(numbers), PICKED), len(shingles))
            for k in range(PICKED):
                least = np.minimum.reduceat(hashes, starts)
                found = np.flatnonzero(hashes == np.repeat(least, numbers))
                found = found[hashes[found] < most]
                owner = np.searchsorted(starts, found, side="right") - 1
                spots[owner, k] = place[found]
                hashes[found] = most
            spots.sort(axis=1)
            key = np.full(len(numbers), j, np.uint64)
            padded = np.append(shingles, np.uint64(0))
            for k in range(PICKED):
                key = mixed(key * np.uint64(31) + padded[spots[:, k]])
            out[:, j] = key
    return out


def _sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import xxhash

    for batch in slices(batches, "text", BATCH_TEXT):
        words, counts = hasher().words(batch.column("text").to_pylist())
        raw, borders = words.tobytes(), np.concatenate([[0], 8 * np.cumsum(counts)]).tolist()
        nodes = [xxhash.xxh3_128_digest(raw[a:b]) for a, b in zip(borders, borders[1:])]
        shingles, numbers = labelled(words, counts)
        some = numbers > 0
        found: list = [[]] * len(counts)
        if some.any():
            rows = iter(sketches(shingles, numbers[some]).view(np.int64).tolist())
            found = [next(rows) if s else [] for s in some]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"), batch.column("text_print"), pa.array(nodes, pa.binary()), pa.array(numbers),
                pa.array(found, pa.list_(pa.int64())),
            ],
            names=["doc_id", "text_print", "node", "shingles", "sketches"],
        )


def chain(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest chain of labelled shingles in both texts in the same order, inside the band.

    >>> chain(np.array([1, 2, 3, 4, 5]), np.array([1, 2, 9, 3, 5, 4]))
    4
    """
    _, at, bt = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    band = max(len(a), len(b)) - needed(len(a), len(b))
    order = np.argsort(at)
    at, bt = at[order], bt[order]
    bt = bt[np.abs(at - bt) <= band]
    if np.all(bt[1:] > bt[:-1]):
        return len(bt)
    tails: list[int] = []
    for x in bt.tolist():
        k = bisect_left(tails, x)
        tails[k : k + 1] = [x]
    return len(tails)


def needed(a: int, b: int) -> int:
    """Least number of common shingles for the similarity."""
    return int(np.ceil(SIMILARITY * (a + b) / (1 + SIMILARITY) - 1e-9))


def common(a: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Numbers of labelled shingles that a text shares with each of others, none of them empty.

    >>> common(np.array([5, 1, 3]), [np.array([3, 4]), np.array([7]), np.array([1, 5])]).tolist()
    [1, 0, 2]
    """
    a, lengths = np.sort(a), np.array([len(x) for x in others])
    flat = np.concatenate(others)
    same = a[np.minimum(np.searchsorted(a, flat), len(a) - 1)] == flat
    return np.add.reduceat(same, np.cumsum(lengths) - lengths, dtype=np.int64)


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    least = needed(len(a), len(b))
    return min(len(a), len(b)) >= least and chain(a, b) >= least


def _shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The labelled shingles of texts, in text order, as bytes."""
    for batch in slices(batches, "text", BATCH_TEXT):
        shingles, numbers = labelled(*hasher().words(batch.column("text").to_pylist()))
        raw, borders = shingles.tobytes(), np.concatenate([[0], 8 * np.cumsum(numbers)]).tolist()
        yield pa.RecordBatch.from_arrays(
            [batch.column("node"), pa.array([raw[x:y] for x, y in zip(borders, borders[1:])], pa.binary())], names=["node", "form"]
        )


def _linked(forms: dict[bytes, np.ndarray], a: bytes, others: list[bytes]) -> list[bytes]:
    """Those of others that are similar to a."""
    most = common(forms[a], [forms[b] for b in others])
    enough = [b for b, n in zip(others, most.tolist()) if n >= needed(len(forms[a]), len(forms[b]))]
    return [b for b in enough if similar(forms[a], forms[b])]


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of cells one after the other, each with its forms before its pairs: the similar pairs."""
    cell, forms = None, {}
    for batch in batches:
        found: list[tuple[bytes, bytes]] = []
        a_now, others = None, []
        for c, a, b, form in zip(*(batch.column(x).to_pylist() for x in ("cell", "a", "b", "form"))):
            if a != a_now or c != cell or b is None:
                found += [(a_now, x) for x in _linked(forms, a_now, others)] if others else []
                a_now, others = a, []
            if c != cell:
                cell, forms = c, {}
            if b is None:
                forms[a] = np.frombuffer(form, np.uint64)
            else:
                others.append(b)
        found += [(a_now, x) for x in _linked(forms, a_now, others)] if others else []
        a, b = zip(*found) if found else ((), ())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], names=["a", "b"])


def _pairs(buckets: DataFrame, groups: DataFrame | None, turn: int) -> DataFrame:
    """Pairs (a, b), a < b, of each bucket's nodes with its leaders; of different groups where groups are known."""
    nodes = buckets.withColumn("group", F.col("node")) if groups is None else buckets.join(groups, "node")
    member = F.struct("node", "group", "shingles")
    # First the node with most neighbours, as the text that others are copies of; then any.
    order = F.when(F.lit(turn == 0), -F.col("met")).otherwise(F.lit(0))
    tops = [
        F.min(F.struct(order.alias("order"), F.xxhash64("node", F.lit(turn * 64 + k)).alias("any"), member.alias("leader")))
        for k in range(LEADERS[min(turn, 1)])
    ]
    leaders = (
        nodes.groupBy("key").agg(F.array_distinct(F.array(*[t["leader"] for t in tops])).alias("tops"), F.min("group").alias("low"), F.max("group").alias("high"))
        .where("low != high").select("key", F.explode("tops").alias("leader"))
    )
    least, most = F.least("shingles", "leader.shingles"), F.greatest("shingles", "leader.shingles")
    return (
        nodes.join(leaders, "key").where((F.col("group") != F.col("leader.group")) & (least >= SIMILARITY * most))
        .select(F.least("node", "leader.node").alias("a"), F.greatest("node", "leader.node").alias("b")).distinct()
    )


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each labelled shingle of a numbered node."""
    for batch in batches:
        forms = batch.column("form")
        counts = pc.divide(pc.binary_length(forms).cast(pa.int64()), 8).to_numpy()
        data, _ = text_bytes(forms)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(batch.column("number").to_numpy(), counts)), pa.array(data.view(np.int64))], names=["number", "shingle"]
        )


def _rare(nodes: DataFrame, forms: DataFrame) -> DataFrame:
    """The shingles of each node by which every text that is similar to it can be met: number, shingle, at (its place in the order), short.

    In one order of all shingles, by the number of nodes that hold them, the rarest of two similar texts meet. The shorter of
    two has at least needed(n, n) of its n shingles in common, the longer one 0.8 n, so it is enough to look at the others and
    one more: few for a text that meets longer ones (``short``), more for one that meets shorter ones. A shingle of one node alone meets nothing.
    """
    each = forms.join(nodes.select("node", "number"), "node").select("number", "form").mapInArrow(_exploded, "number long, shingle long")
    several = each.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    shared = each.join(several, "shingle").groupBy("number").agg(F.array_sort(F.collect_list(F.struct("n", "shingle"))).alias("shared"))
    ranked = shared.join(nodes.select("number", F.col("shingles").alias("size")), "number")
    size = F.col("size")
    own = size - F.size("shared")  # those of one node alone come first in the order
    longest = size - F.ceil(size * F.lit(SIMILARITY) - F.lit(1e-9)) + 1
    shortest = size - F.ceil(size * F.lit(2 * SIMILARITY / (1 + SIMILARITY)) - F.lit(1e-9)) + 1
    room = F.greatest(longest - own, F.lit(0)).cast("int")
    rows = ranked.select("number", shortest.alias("room"), own.alias("own"), F.posexplode(F.slice("shared", F.lit(1), room)).alias("at", "s"))
    at = (F.col("own") + F.col("at")).cast("int")
    return rows.select("number", F.col("s.shingle").alias("shingle"), at.alias("at"), (at < F.col("room")).alias("short"))


def _all_pairs(members: DataFrame, forms: DataFrame, groups: DataFrame | None) -> DataFrame:
    """All pairs (a, b), a < b, of different groups with a common sketch that can be similar.

    Nodes whose buckets hold one group only have no such pair. The others meet through their rare shingles. The group that
    holds most nodes of a shingle does not meet itself there, so a large group costs its size only; nor does
    a crowd of texts below the threshold, whose rare shingles are each text's own.
    """
    nodes = members.withColumn("group", F.col("node")) if groups is None else members.join(groups, "node")
    mixed_keys = nodes.select(F.explode("keys").alias("key"), "group").groupBy("key").agg(F.min("group").alias("low"), F.max("group").alias("high"))
    open_nodes = nodes.select("node", F.explode("keys").alias("key")).join(mixed_keys.where("low != high").select("key"), "key", "left_semi")
    nodes = materialise(nodes.join(open_nodes.select("node").distinct(), "node", "left_semi").select("node", "group", "shingles", "keys", F.monotonically_increasing_id().alias("number")), "near-open")
    rare = materialise(_rare(nodes, forms), "near-rare").join(nodes, "number")
    held = rare.groupBy("shingle", "group").agg(F.count("*").alias("n"))
    most = held.groupBy("shingle").agg(F.max_by("group", "n").alias("most"), F.count("*").alias("groups")).where("groups > 1").select("shingle", "most")
    rare = materialise(rare.join(most, "shingle").withColumn("major", F.col("group") == F.col("most")).drop("most"), "near-meeting")
    columns = ("node", "group", "shingles", "keys", "major", "at")
    a, b = (rare.where(short).select("shingle", *[F.col(c).alias(f"{side}_{c}") for c in columns]) for side, short in (("a", "short"), ("b", "true")))
    shorter = F.struct("a_shingles", "a_node") < F.struct("b_shingles", "b_node")
    fits = shorter & (F.col("a_group") != F.col("b_group")) & (F.col("a_shingles") >= SIMILARITY * F.col("b_shingles")) & F.arrays_overlap("a_keys", "b_keys")
    # What two texts have in common from the place on where they meet first has to be enough.
    rest = F.least(F.col("a_shingles") - F.col("a_at"), F.col("b_shingles") - F.col("b_at"))
    fits &= rest >= (F.col("a_shingles") + F.col("b_shingles")) * F.lit(SIMILARITY / (1 + SIMILARITY)) - F.lit(1e-9)
    met = a.where("not a_major").join(b, "shingle").where(fits).select("a_node", "b_node")
    met = met.unionByName(a.where("a_major").join(b.where("not b_major"), "shingle").where(fits).select("a_node", "b_node"))
    return met.select(F.least("a_node", "b_node").alias("a"), F.greatest("a_node", "b_node").alias("b")).distinct()


def _verify(pairs: DataFrame, forms: DataFrame, blocks: int) -> DataFrame:
    """Similar pairs. Nodes are dealt over blocks; two blocks make a cell, which gets each text once."""
    a, b = (F.pmod(F.xxhash64(c), F.lit(blocks)) for c in "ab")
    celled = pairs.select((F.least(a, b) * blocks + F.greatest(a, b)).alias("cell"), "a", "b")
    node = F.explode(F.array("a", "b")).alias("node")
    texts = celled.select("cell", node).distinct().join(forms, "node").select("cell", F.col("node").alias("a"), F.lit(None).cast("binary").alias("b"), "form")
    rows = texts.unionByName(celled.withColumn("form", F.lit(None).cast("binary")))
    parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return rows.repartition(parts, "cell").sortWithinPartitions("cell", F.col("b").isNotNull(), "a").mapInArrow(_verified, VERIFIED)


def components(links: DataFrame) -> DataFrame:
    """The smallest node that each linked node is connected to: node, group.

    Every step takes the least group among the neighbours and then the group of
    that group, so chains shorten geometrically. A hot node gets one row per task.
    """
    both = materialise(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-links")
    groups = both.groupBy(F.col("a").alias("node")).agg(F.min(F.least("a", "b")).alias("group"))
    while True:
        groups = materialise(groups, "near-groups")
        near = both.join(groups, F.col("b") == F.col("node")).groupBy("a").agg(F.min("group").alias("near"))
        lower = groups.join(near, F.col("a") == F.col("node")).select("node", F.least("group", "near").alias("low"), "group")
        lower = materialise(lower, "near-step")
        if lower.where("low != group").isEmpty():
            return groups
        heads = lower.select(F.col("node").alias("head"), F.col("low").alias("top"))
        groups = lower.join(heads, F.col("low") == F.col("head")).select("node", F.least("low", "top").alias("group"))


def near_groups(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, text_print, class_id, class_size, kept."""
    ship(docs.sparkSession)
    texts = id_and_text(docs).withColumn("text_print", text_hash())
    rows = materialise(texts.select("doc_id", "text_print", "text").mapInArrow(_sketched, SKETCHED), "near-sketches")
    nodes = materialise(
        rows.where("shingles > 0").groupBy("node")
        .agg(F.min(F.struct("doc_id", "text_print")).alias("of"), F.first("shingles").alias("shingles"), F.first("sketches").alias("sketches")),
        "near-nodes",
    )
    shared = materialise(nodes.select(F.explode("sketches").alias("key")).groupBy("key").agg(F.count("*").alias("n")).where("n > 1"), "near-shared")
    met = nodes.select("node", F.explode("sketches").alias("key")).join(shared, "key")
    met = met.groupBy("node").agg(F.sum("n").alias("met"), F.sort_array(F.collect_set("key")).alias("keys"))
    # A node's keys come back in one row per node, at most SKETCHES of them.
    members = materialise(met.join(nodes, "node").select("node", "shingles", "met", "keys"), "near-members")
    buckets = members.select(F.explode("keys").alias("key"), "node", "shingles", "met")
    known = members.select("node")
    of = nodes.join(known, "node", "left_semi").select("node", F.col("of.doc_id").alias("id"), F.col("of.text_print").alias("print"))
    named = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("text_print") == F.col("print"))
    forms = materialise(texts.join(of, named).select("node", "text").mapInArrow(_shingled, "node binary, form binary"), "near-forms")
    size = forms.agg(F.sum(F.octet_length("form"))).first()[0] or 0
    blocks = max(BLOCKS, size // BLOCK_BYTES + 1)
    nodes_met = members.count()
    turn, tried, groups, joins = 0, None, None, float("inf")
    while True:
        # Leaders go on while a round joins groups at a share of the nodes; then all that are open are tested, and none is left.
        last = turn > 0 and joins <= JOINS * nodes_met
        pairs = _all_pairs(members, forms, groups) if last else _pairs(buckets, groups, turn)
        if tried is not None and not last:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = materialise(pairs, "near-pairs")
        found = materialise(_verify(pairs, forms, blocks), "near-found")
        if found.isEmpty():
            if last:
                break
            turn, joins = turn + 1, 0
            continue
        joins = found.count()
        tried = pairs if tried is None else tried.unionByName(pairs)
        # New links join groups; only the groups they touch are worked on.
        if groups is None:
            joined, before = components(found.distinct()), known.select("node", F.col("node").alias("group"))
        else:
            a, b = (groups.select(F.col("node").alias(c), F.col("group").alias(f"{c}_group")) for c in "ab")
            links = found.join(a, "a").join(b, "b").select(F.col("a_group").alias("a"), F.col("b_group").alias("b")).distinct()
            joined, before = components(links), groups
        joined = joined.select(F.col("node").alias("old"), F.col("group").alias("new"))
        groups = materialise(
            before.join(joined, F.col("group") == F.col("old"), "left").select("node", F.coalesce("new", "group").alias("group")), "near-known"
        )
        if last:
            break
        turn += 1
    if groups is None:
        groups = known.select("node", F.col("node").alias("group"))
    member = rows.join(groups, "node", "left").select("doc_id", "text_print", F.coalesce("group", "node").alias("group"))
    first = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", "text_print")
    heads = member.groupBy("group").agg(F.min(first).alias("head"), F.count("*").alias("class_size"))
    return member.join(heads, "group").select(
        "doc_id", "text_print", F.col("head.doc_id").alias("class_id"), "class_size",
        (F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("text_print") == F.col("head.text_print"))).alias("kept"),
    )


def near_classes(docs: DataFrame) -> DataFrame:
    """Per document: doc_id, class_id (the document of its group that stays), class_size."""
    return near_groups(docs).select("doc_id", "class_id", "class_size")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; one row per id and text."""
    groups = materialise(near_groups(docs), "near-result")
    kept = groups.where("kept").groupBy("doc_id", "text_print").agg(F.count("*").alias("n"))
    several = materialise(kept.where("n > 1"), "near-repeated")
    lone = rows_of(docs, kept.where("n = 1"))
    return lone if several.isEmpty() else lone.unionByName(first_rows(rows_of(docs, several)))
