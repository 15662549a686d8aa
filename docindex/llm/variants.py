"""Spelling variants of words by an index of variable-length grams.

Words stand between two marks, one at each end. The gram dictionary is pruned by
frequency: a gram of ``SHORTEST`` characters is always there, and a gram is lengthened by
one character, up to ``LONGEST``, only if more than ``limit`` places of the words hold it;
``limit`` is raised until the lengthened grams number ``GRAMS`` at most. A word is
decomposed into the longest dictionary gram at each of its places.

An edit can affect the grams that span its place, and those before it that a dictionary
gram could lengthen across it: grams that end at the edit and are not lengthened in the
dictionary are safe. So every place of every word has its own bound of affected grams, at
most ``LONGEST``, and everything else has to be equal in both words: grams before the edit
at equal places from the start, grams after it at equal places from the end. Both words
find the same set from their common ends alone. The lists of these grams are merged under
one key of the edit's place, so that two words meet only if they share all grams that the
edit leaves, and never through one frequent gram. A word of L characters has L keys for
its own replaced or deleted characters and L + 1 for characters inserted into it.

Words that meet are verified: equal before the edit's place and behind it. Of several
places that give the same insertion the last one counts, so each near pair is found once.

Defined cases: a null text has no words; a null id counts as an empty text in the check
sum. Words of any length are whole. Ties of forms go to the smallest word. Repeated rows
count each time. An empty table gives no rows. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from docindex.llm.common import id_and_text, mixed, ship, slices
from docindex.workspace import materialise

LETTERS = r"A-Za-zÀ-ÿ"
LEAST_LENGTH, LEAST_COUNT = 7, 2
#: One in so many runs loses a character.
LOSES = 31
#: A form is at least so many times as frequent.
TIMES = 10
SHORTEST, LONGEST = 2, 4
#: Lengthened grams of the dictionary, at most, and places that one has at least.
GRAMS, LIMIT = 20_000, 8
FRONT, BACK = "\x02", "\x03"
BATCH_TEXT = 1 << 20

KEYED = "word string, n long, place int, own boolean, key long"


def words(docs: DataFrame) -> DataFrame:
    """Words and their occurrences: word, n."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    runs = id_and_text(docs).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all("text", F.lit(f"[{LETTERS}]{{{LEAST_LENGTH},}}"), F.lit(0))).alias("run"),
    ).select("id", F.translate("run", upper, lower).alias("run"))
    checked = runs.select("run", F.crc32(F.concat("id", F.lit(":"), "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.char_length("run")).cast("int")
    shorter = F.concat(F.substring(F.col("run"), F.lit(1), at), F.substring(F.col("run"), at + 2, F.char_length("run")))
    word = F.when(F.col("h") % LOSES == 0, shorter).otherwise(F.col("run"))
    counts = checked.select(word.alias("word")).where(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return materialise(counts.where(F.col("n") >= LEAST_COUNT), "words")


# -- dictionary ----------------------------------------------------------------

def lengthened(counts: DataFrame, grams: int = GRAMS) -> list[str]:
    """Grams that the dictionary lengthens, ``grams`` at most: those with more places than the limit."""
    marked = counts.select(F.concat(F.lit(FRONT), "word", F.lit(BACK)).alias("m"))
    every = [
        F.transform(F.sequence(F.lit(1), F.char_length("m") - (q - 1)), lambda i, q=q: F.substring(F.col("m"), i, F.lit(q)))
        for q in range(SHORTEST, LONGEST)
    ]
    places = marked.select(F.explode(F.flatten(F.array(*every))).alias("gram")).groupBy("gram").agg(F.count("*").alias("n"))
    places = materialise(places.where(F.col("n") > LIMIT), "grams")
    # The limit rises by halves until few enough are left; the histogram has a row for each half step.
    step = F.floor(F.log(1.5, "n")).cast("int")
    total, least = 0, None
    for row in places.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        total += row["count"]
        if total > grams:
            break
        least = row["step"]
    return [] if least is None else [r["gram"] for r in places.where(step >= least).select("gram").collect()]


class Dictionary:
    """Which grams are lengthened, as codes of their characters."""

    def __init__(self, grams: list[str]) -> None:
        self.codes = {
            q: np.unique(np.array([_code([ord(c) for c in g]) for g in grams if len(g) == q], np.uint64)) for q in range(SHORTEST, LONGEST)
        }

    def lengthens(self, points: np.ndarray, q: int) -> np.ndarray:
        """Whether the dictionary lengthens the gram of ``q`` characters that begins at each place."""
        out = np.zeros(len(points), bool)
        known = self.codes[q]
        if len(known) and len(points) >= q:
            code = _code([points[k : len(points) - q + 1 + k] for k in range(q)])
            at = np.searchsorted(known, code)
            at[at == len(known)] = 0
            out[: len(code)] = known[at] == code
        return out


def _code(characters: list):
    """Characters of one gram as a number; every character has 21 bits, and grams that are looked up have three at most."""
    code = np.uint64(0)
    for c in characters:
        code = (code << np.uint64(21)) | np.asarray(c, np.uint64)
    return code


# -- keys ----------------------------------------------------------------------

def decomposed(points: np.ndarray, room: np.ndarray, dictionary: Dictionary) -> tuple[np.ndarray, dict[int, np.ndarray]]:
    """Length of the longest dictionary gram at each place (0 without room for one), and which grams there are lengthened.

    ``room`` is the number of characters from a place to its word's end.
    """
    more = {q: dictionary.lengthens(points, q) for q in range(SHORTEST, LONGEST)}
    length = np.where(room >= SHORTEST, SHORTEST, 0)
    for q in range(SHORTEST, LONGEST):
        length[(length == q) & more[q] & (room > q)] = q + 1
    return length, more


def _totals(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(values, dtype=np.uint64)])


def merged_keys(points: np.ndarray, lengths: np.ndarray, dictionary: Dictionary) -> tuple[np.ndarray, ...]:
    """Keys of marked words one after the other: word, place, whether the word's own character is edited, key; and every place's bound.

    A place is that of an edited character, counted without the mark; for an insertion, of the one after it.
    """
    begins = np.cumsum(lengths) - lengths
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(points)) - begins[owner]
    room = lengths[owner] - place
    gram, more = decomposed(points, room, dictionary)
    with np.errstate(over="ignore"):
        code = np.zeros(len(points), np.uint64)
        padded = np.concatenate([points.astype(np.uint64), np.zeros(LONGEST, np.uint64)])
        for k in range(LONGEST):
            code = np.where(k < gram, mixed(code * np.uint64(0x9E3779B97F4A7C15) + padded[k : len(points) + k] + np.uint64(1)), code)
        there = gram > 0
        from_start = np.where(there, mixed(code + mixed(place.astype(np.uint64) + np.uint64(0x51ED))), np.uint64(0))
        from_end = np.where(there, mixed(code ^ mixed(room.astype(np.uint64) + np.uint64(0xA5A5))), np.uint64(0))
        ahead, behind = _totals(from_start), _totals(from_end)
        spots = np.flatnonzero(place > 0)
        first = begins[owner[spots]]
        # Grams whose longest possible reach ends before the edit, and then those that the dictionary cannot carry across it.
        sure = np.maximum(spots - LONGEST + 1, first)
        before = ahead[sure] - ahead[first]
        bound = np.zeros(len(spots), np.int64)
        for back in range(1, LONGEST):
            at = spots - back
            inside = at >= first
            safe = inside & ~more[back][at] if back >= SHORTEST else np.zeros(len(spots), bool)
            before = before + np.where(safe, from_start[at], np.uint64(0))
            bound += inside & ~safe
        stop = first + lengths[owner[spots]]
        after_own, after = behind[stop] - behind[np.minimum(spots + 1, stop)], behind[stop] - behind[spots]
        size = lengths[owner[spots]].astype(np.uint64)

        def key(n: np.ndarray, tail: np.ndarray) -> np.ndarray:
            return mixed(mixed(before + mixed(tail)) + mixed(n * np.uint64(1 << 32) + place[spots].astype(np.uint64)))

        is_letter = place[spots] < lengths[owner[spots]] - 1
        bound += is_letter & (gram[spots] > 0)
        keys = np.concatenate([key(size, after_own)[is_letter], key(size + np.uint64(1), after)])
    at = np.concatenate([spots[is_letter], spots])
    own = np.arange(len(at)) < int(is_letter.sum())
    return owner[at], place[at], own, keys, bound


def _keyed(grams: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = Dictionary(grams)
        for batch in slices(batches, "word", BATCH_TEXT):
            texts = [FRONT + w + BACK for w in batch.column("word").to_pylist()]
            points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32).astype(np.int64)
            owner, place, own, keys, _ = merged_keys(points, np.array([len(t) for t in texts], np.int64), dictionary)
            at = pa.array(owner)
            yield pa.RecordBatch.from_arrays(
                [batch.column("word").take(at), batch.column("n").take(at), pa.array(place.astype(np.int32)), pa.array(own), pa.array(keys.view(np.int64))],
                names=["word", "n", "place", "own", "key"],
            )

    return run


# -- pairs and forms -----------------------------------------------------------

def _is_edit(a: Column, b: Column, place: Column, inserted: Column) -> Column:
    """Whether replacing, or for a longer ``a`` deleting, its character at ``place`` gives ``b``."""
    rest = F.when(inserted, place).otherwise(place + 1)
    end = F.lit(1 << 30)
    same = (F.substring(a, F.lit(1), place - 1) == F.substring(b, F.lit(1), place - 1)) & (F.substring(a, place + 1, end) == F.substring(b, rest, end))
    return same & (F.substring(a, place, F.lit(1)) != F.substring(b, place, F.lit(1)))


def near_pairs(counts: DataFrame, grams: int = GRAMS) -> DataFrame:
    """Each pair of words one edit apart, once: a, a_n, b, b_n."""
    ship(counts.sparkSession)
    keyed = counts.mapInArrow(_keyed(lengthened(counts, grams)), KEYED)
    a = keyed.where("own").select("key", F.col("word").alias("a"), F.col("n").alias("a_n"), F.col("place").alias("a_place"))
    b = keyed.select("key", F.col("word").alias("b"), F.col("n").alias("b_n"), F.col("place").alias("b_place"), "own")
    fits = (F.col("a_place") == F.col("b_place")) & (~F.col("own") | (F.col("a") < F.col("b")))
    met = a.join(b, "key").where(fits & _is_edit(F.col("a"), F.col("b"), F.col("a_place"), ~F.col("own")))
    return met.select("a", "a_n", "b", "b_n")


def roots(forms: DataFrame) -> DataFrame:
    """The last form of every word that has one: word, root. Each step doubles the length of the chains followed."""
    now = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = now.select(F.col("word").alias("at"), F.col("root").alias("next"))
        now = materialise(now.join(ahead, F.col("root") == F.col("at"), "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(docs: DataFrame, grams: int = GRAMS) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n."""
    counts = words(docs)
    pairs = near_pairs(counts, grams)
    both = pairs.select(F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")),
    )).alias("p")).select("p.*")
    nearest = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "near")).alias("best"))
    joined = counts.join(nearest, "word", "left")
    much = -F.col("best.order") >= TIMES * F.col("n")
    rows = materialise(
        joined.select(
            "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            F.when(much, F.col("best.near")).alias("form"), F.when(much, -F.col("best.order")).alias("form_n"),
        ),
        "forms",
    )
    last = roots(rows.where("form is not null"))
    return rows.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
