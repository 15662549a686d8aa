"""SentencePiece encoding and decoding by suffix-array matching.

Texts fall apart into units at spaces, which no piece crosses. A batch's distinct
unseen units are concatenated and their suffixes sorted; every piece finds its
occurrences as one range of that array by binary search. The occurrences are edges
from a start to an end. Sorted by end, they are relaxed from left to right in all
units at once: an edge extends the best path to its start if the two pieces can
stand side by side after merging by rank, which holds for exactly one edge per end.

Two pieces can stand side by side if no merge across their border comes first. At
each moment the border lies between a part on the right edge of the left piece's
merge tree and a part on the left edge of the right one's; a piece made of both
parts prevents the pair if its rank comes before both parts' next merges (on a tie
the merge further left goes first).

Decoding joins the pieces' bytes and drops the space put in front.

Defined cases: a null or empty text has no ids; characters without a piece become
byte pieces; a literal U+2581 is a space, as in the model. Units of any length are
encoded whole. Null and repeated ids are rows like any other. Only ``doc_id`` and
``text`` are read.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from docindex.llm.common import Known, Ragged, held, id_and_text, ship, slices, sums

SPACE = "▁"
UNIT = re.compile(f"{SPACE}+[^{SPACE}]*")
BATCH_TEXT = 8 << 20
#: Bytes of units and their ids that are remembered, and characters that are matched at a time.
MEMORY = 128 << 20
MATCHED = 1 << 17
#: Units from this length on are relaxed one character after the other; shorter ones side by side.
LONG = 512

ENCODED = "doc_id long, n_tokens long, ids array<int>"
DIGEST = "doc_id long, n_tokens long, ids_crc32 long, n_bytes long, decoded_sha256 string, exact boolean"

NEVER = np.int64(1) << 40


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """The model's pieces, their merge trees, and which pairs can stand side by side."""

    def __init__(self, model: str) -> None:
        from sentencepiece import SentencePieceProcessor

        p = SentencePieceProcessor(model_file=model)
        n = p.get_piece_size()
        self.names = [p.id_to_piece(i) for i in range(n)]
        plain = [i for i in range(n) if not (p.is_byte(i) or p.is_control(i) or p.is_unknown(i))]
        self.byte_ids = np.array([p.piece_to_id(f"<0x{b:02X}>") for b in range(256)])
        letters = sorted({c for i in plain for c in self.names[i]})
        self.letters = np.array([ord(c) for c in letters])
        # Characters without a piece of their own still are parts of merges.
        ids = {self.names[i]: i for i in plain}
        extra = [c for c in letters if c not in ids]
        self.atoms = {n + 1 + k: c for k, c in enumerate(extra)}
        ids |= {c: i for i, c in self.atoms.items()}
        self.unknown = n
        self.size = n + 1 + len(extra)
        self.text = {i: s for s, i in ids.items()}
        order = sorted((i for i in plain if len(self.names[i]) > 1), key=lambda i: -p.get_score(i))
        self.rank = np.full(self.size, -1, np.int64)
        self.rank[order] = np.arange(len(order))
        self._trees(ids, order)
        self._table(p, n)
        self.known = np.empty(0, np.int64)
        self.fits = np.empty(0, bool)
        self.single: dict[int, bool] = {}

    def _trees(self, ids: dict[str, int], order: list[int]) -> None:
        """Last merges by rank, the edges of the trees, and every pair that makes a piece."""
        self.left, self.right = np.full(self.size, -1), np.full(self.size, -1)
        pairs, made = [], []
        self.usable = set(ids.values())
        for i in order:
            s = self.text[i]
            for k in range(1, len(s)):
                a, b = ids.get(s[:k]), ids.get(s[k:])
                if a is not None and b is not None:
                    pairs.append(a * self.size + b)
                    made.append(self.rank[i])
        by = np.argsort(pairs)
        self.pairs, self.made = np.array(pairs, np.int64)[by], np.array(made, np.int64)[by]
        for i in order:
            parts = self._merged([ids[c] for c in self.text[i]], ids, i)
            if len(parts) != 2 or max(self.rank[x] for x in parts) > self.rank[i]:
                self.usable.discard(i)  # merging never makes it
            else:
                self.left[i], self.right[i] = parts

    def _merged(self, parts: list[int], ids: dict[str, int], last: int) -> list[int]:
        """Merge by rank until only ``last`` would be left to make."""
        while len(parts) > 2:
            joined = [ids.get(self.text[a] + self.text[b]) for a, b in zip(parts, parts[1:])]
            best = min((self.rank[j], k) for k, j in enumerate(joined) if j is not None)[1] if any(j is not None for j in joined) else -1
            if best < 0 or joined[best] == last:
                break
            parts = parts[:best] + [joined[best]] + parts[best + 2 :]
        return parts

    def _table(self, p, n: int) -> None:
        values = [bytes([int(self.names[i][3:5], 16)]) if p.is_byte(i) else b"" if p.is_control(i) else self.names[i].replace(SPACE, " ").encode() for i in range(n)]
        self.bytes = Ragged(np.uint8)
        self.bytes.extend(np.frombuffer(b"".join(values), np.uint8), np.array([len(v) for v in values]))

    def _clash(self, a: np.ndarray, b: np.ndarray, a_next: np.ndarray, b_next: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.pairs, key := a * self.size + b)
        at[at == len(self.pairs)] = 0
        rank = np.where(self.pairs[at] == key, self.made[at], NEVER)
        return (rank < a_next) & (rank <= b_next) & (rank < NEVER)

    def _judge(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        fits = np.ones(len(left), bool)
        a, a_next, rows = left, np.full(len(left), NEVER), np.arange(len(left))
        while len(rows):
            b, b_next, inner = right[rows], np.full(len(rows), NEVER), np.arange(len(rows))
            while len(inner):
                clash = self._clash(a[inner], b, a_next[inner], b_next)
                fits[rows[inner[clash]]] = False
                go = self.left[b] >= 0
                b, b_next, inner = self.left[b[go]], self.rank[b[go]], inner[go]
            go = (self.right[a] >= 0) & fits[rows]
            a, a_next, rows = self.right[a[go]], self.rank[a[go]], rows[go]
        return fits

    def one_by_one(self, left: int, right: int) -> bool:
        """``side_by_side`` of one pair."""
        key = left * self.size + right
        found = self.single.get(key)
        if found is None:
            if len(self.single) > 500_000:
                self.single.clear()
            found = self.single[key] = bool(self._judge(np.array([left]), np.array([right]))[0])
        return found

    def side_by_side(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Whether merging keeps each pair apart; judged once per pair."""
        pairs, place = np.unique(left.astype(np.int64) * self.size + right, return_inverse=True)
        at = np.searchsorted(self.known, pairs)
        seen = at < len(self.known)
        seen[seen] = self.known[at[seen]] == pairs[seen]
        fits = np.zeros(len(pairs), bool)
        fits[seen] = self.fits[at[seen]]
        new = pairs[~seen]
        if len(new):
            fits[~seen] = judged = self._judge(new // self.size, new % self.size)
            self.known = np.insert(self.known, at[~seen], new)
            self.fits = np.insert(self.fits, at[~seen], judged)
        return fits[place]


class Matcher:
    """Ids of many units at once."""

    def __init__(self, pieces: Pieces) -> None:
        self.pieces = pieces
        usable = [i for i in sorted(pieces.usable)]
        self.longest = max(len(pieces.text[i]) for i in usable)
        self.width = -(-self.longest // 4) * 4
        self.ids = np.array(usable)
        self.lengths = np.array([len(pieces.text[i]) for i in usable])
        code = {c: k + 1 for k, c in enumerate(map(chr, pieces.letters))}
        grid = np.zeros((len(usable), self.width), ">u2")
        for row, i in enumerate(usable):
            grid[row, : self.lengths[row]] = [code[c] for c in pieces.text[i]]
        self.low = self._keys(grid).copy()
        grid[np.arange(self.width) >= self.lengths[:, None]] = 0xFFFF
        self.high = self._keys(grid)

    def _keys(self, grid: np.ndarray) -> np.ndarray:
        return np.ascontiguousarray(grid).view(f"S{2 * self.width}").ravel()

    def suffixes(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Suffix array by the longest piece's length, and its sorted keys."""
        padded = np.concatenate([codes, np.zeros(self.width, np.uint16)]).astype(">u2")
        grid = np.lib.stride_tricks.sliding_window_view(padded, self.width)[: len(codes)]
        keys = self._keys(grid)
        words = keys.view(">u8").reshape(len(codes), -1).astype(np.uint64)
        order = np.lexsort(words.T[::-1])
        return order, keys[order]

    def letters(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Code points of a text and their numbers among the letters of pieces, 0 for others."""
        p = self.pieces
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.int64)
        at = np.searchsorted(p.letters, points)
        at[at == len(p.letters)] = 0
        return points, np.where(p.letters[at] == points, at + 1, 0).astype(np.uint16)

    def edges(self, codes: np.ndarray, border: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Start, end and piece of every occurrence of a usable piece, and of each character that no piece has."""
        order, keys = self.suffixes(codes)
        first = np.searchsorted(keys, self.low, side="left")
        last = np.searchsorted(keys, self.high, side="right")
        count = last - first
        ends = np.cumsum(count)
        place = np.repeat(first - (ends - count), count) + np.arange(ends[-1])
        starts = order[place]
        stops = starts + np.repeat(self.lengths, count)
        lone = np.flatnonzero((codes == 0) & ~border)
        made = np.concatenate([np.repeat(self.ids, count), np.full(len(lone), self.pieces.unknown)])
        return np.concatenate([starts, lone]), np.concatenate([stops, lone + 1]), made

    def match(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All units' ids one after the other, and how many each has; a long unit comes alone."""
        if len(units) == 1 and len(units[0]) >= LONG:
            return self._long(units[0])
        lengths = np.fromiter(map(len, units), np.int64, len(units))
        points, codes = self.letters("\0".join(units) + "\0")
        begins = np.cumsum(lengths + 1) - lengths - 1
        border = np.zeros(len(points), bool)
        border[begins + lengths] = True
        codes[border] = 0
        return self._flat(points, border, begins, lengths, *self._relax(len(points), begins, lengths, *self.edges(codes, border)))

    def _long(self, unit: str) -> tuple[np.ndarray, np.ndarray]:
        """One unit of any length, matched in stretches that overlap by the longest piece.

        Its edges are relaxed in the order of their starts: when a start's turn comes, all edges that end there have had theirs.
        """
        points, codes = self.letters(unit)
        n = len(unit)
        best, came = np.full(n + 1, -1, np.int32), np.full(n + 1, -1, np.int32)
        fit, known, size = self.pieces.one_by_one, self.pieces.single, self.pieces.size
        for a in range(0, n, MATCHED):
            b, stop = min(a + MATCHED, n), min(a + MATCHED + self.longest, n)
            starts, stops, made = self.edges(codes[a:stop], np.zeros(stop - a, bool))
            own = starts < b - a
            by = np.argsort(starts[own], kind="stable")
            low, high = a, min(n, b + self.longest)
            ends, from_ = best[low : high + 1].tolist(), came[low : high + 1].tolist()
            for s, e, t in zip(starts[own][by].tolist(), stops[own][by].tolist(), made[own][by].tolist()):
                before = ends[s]
                if s + a == 0:
                    ok = True
                elif before < 0:
                    continue
                else:
                    ok = known.get(before * size + t)
                    if ok is None:
                        ok = fit(before, t)
                if ok:
                    ends[e], from_[e] = t, s + a
            best[low : high + 1], came[low : high + 1] = ends, from_
        border = np.zeros(n + 1, bool)
        return self._flat(np.append(points, 0), border, np.zeros(1, np.int64), np.array([n]), best, came)

    def _relax(self, n, begins, lengths, starts, stops, made):
        """The last piece and its start for every end that a path reaches."""
        unit = np.repeat(begins, lengths + 1)
        ahead = stops - unit[starts]
        by = np.argsort(ahead, kind="stable")
        starts, stops, made, ahead = starts[by], stops[by], made[by], ahead[by]
        best, came = np.full(n, -1), np.full(n, -1)
        cuts = np.flatnonzero(np.diff(ahead, prepend=-1, append=-1))
        opening = starts == unit[starts]
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            s, e, t = starts[a:b], stops[a:b], made[a:b]
            ok = opening[a:b].copy()
            inner = np.flatnonzero(~ok & (best[s] >= 0))
            if len(inner):
                ok[inner] = self.pieces.side_by_side(best[s[inner]], t[inner])
            best[e[ok]], came[e[ok]] = t[ok], s[ok]
        return best, came

    def _flat(self, points, border, begins, lengths, best, came):
        # Walk back from the ends of all units together.
        active = np.flatnonzero(lengths > 0)
        at = (begins + lengths)[active]
        ends, owner = [], []
        while len(active):
            ends.append(at)
            owner.append(active)
            at = came[at]
            go = at > begins[active]
            at, active = at[go], active[go]
        ends, owner = np.concatenate(ends or [begins[:0]]), np.concatenate(owner or [begins[:0]])
        by = np.argsort(ends, kind="stable")
        ends, owner = ends[by], owner[by]
        ids = best[ends]
        p = self.pieces
        strange = np.flatnonzero((ids == p.unknown) | (ids > p.unknown))
        if not len(strange):
            return ids, np.bincount(owner, minlength=len(begins))
        # Characters without a piece are spelt in bytes.
        spelt = [p.byte_ids[list(chr(points[ends[i] - 1]).encode())] for i in strange.tolist()]
        times = np.ones(len(ids), np.int64)
        times[strange] = [len(x) for x in spelt]
        ids, owner = np.repeat(ids, times), np.repeat(owner, times)
        stops = np.cumsum(times)
        for i, x in zip(strange.tolist(), spelt):
            ids[stops[i] - len(x) : stops[i]] = x
        return ids, np.bincount(owner, minlength=len(begins))


class Coder:
    """Encodes and decodes whole texts with a memory for units that come again."""

    def __init__(self, model: str) -> None:
        self.pieces = Pieces(model)
        self.matcher = Matcher(self.pieces)
        self.memory = Known(np.int32, self._units, MEMORY)

    def _units(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of units that are new, as many at a time as make ``MATCHED`` characters."""
        units = [k if k[:1] == SPACE else SPACE + k for k in keys]
        found, some, size = [], [], 0
        place: list[int] = []
        order: list[int] = []

        def match() -> None:
            if some:
                found.append(self.matcher.match(some))
                order.extend(place)

        for i, unit in enumerate(units):
            if len(unit) >= LONG:
                found.append(self.matcher.match([unit]))
                order.append(i)
                continue
            some.append(unit)
            place.append(i)
            size += len(unit) + 1
            if size >= MATCHED:
                match()
                some, place, size = [], [], 0
        match()
        ids, lengths = (np.concatenate(x) for x in zip(*found))
        if order == sorted(order):
            return ids, lengths
        rows = Ragged(np.int32)
        rows.extend(ids, lengths)
        return rows.take(np.argsort(order))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and each text's number of ids."""
        spaced = pc.replace_substring(texts, SPACE, " ")
        some = np.flatnonzero(pc.binary_length(spaced).to_numpy() > 0)
        uneven = pc.match_substring_regex(spaced, "  |^ | $").to_numpy(zero_copy_only=False)
        even = some[~uneven[some]]
        lists = pc.split_pattern(spaced.take(pa.array(even)), " ")
        strings, sizes = [lists.flatten()], np.zeros(len(texts), np.int64)
        sizes[even] = pc.list_value_length(lists).to_numpy()
        odd = some[uneven[some]]
        if len(odd):
            units = [UNIT.findall(SPACE + t.replace(" ", SPACE)) for t in spaced.take(pa.array(odd)).to_pylist()]
            strings.append(pa.array([u for x in units for u in x], pa.string()))
            sizes[odd] = [len(x) for x in units]
        ids, lengths = self.memory.take(pa.concat_arrays(strings).dictionary_encode())
        counts = np.zeros(len(texts), np.int64)
        place = np.concatenate([even, odd])
        counts[place] = sums(lengths, sizes[place])
        if not len(odd):
            return ids, counts
        rows = Ragged(np.int32)
        rows.extend(ids, counts[place])
        where = np.zeros(len(texts), np.int64)
        where[place] = np.arange(len(place))
        return rows.take(where[some])[0], counts

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        data, lengths = self.pieces.bytes.take(ids)
        borders = np.concatenate([[0], np.cumsum(sums(lengths, counts))]).tolist()
        raw = data.tobytes()
        return [raw[a + 1 : b] if raw[a : a + 1] == b" " and a < b else raw[a:b] for a, b in zip(borders, borders[1:])]


def coder(model: str) -> Coder:
    return held(("pieces", model), lambda: Coder(model))


def _encoded(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_TEXT):
            ids, counts = coder(model).encode(batch.column("text"))
            borders = np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(counts), pa.ListArray.from_arrays(pa.array(borders), pa.array(ids.astype(np.int32)))],
                names=["doc_id", "n_tokens", "ids"],
            )

    return run


def _digests(model: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_TEXT):
            texts = batch.column("text").to_pylist()
            ids, counts = coder(model).encode(batch.column("text"))
            decoded = coder(model).decode(ids, counts)
            raw, borders = ids.astype("<u4").tobytes(), np.concatenate([[0], 4 * np.cumsum(counts)]).tolist()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(counts),
                    pa.array([zlib.crc32(raw[a:b]) for a, b in zip(borders, borders[1:])], pa.int64()),
                    pa.array([len(d) for d in decoded], pa.int64()), pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                    pa.array([d == t.replace(SPACE, " ").encode() for d, t in zip(decoded, texts)]),
                ],
                names=["doc_id", "n_tokens", "ids_crc32", "n_bytes", "decoded_sha256", "exact"],
            )

    return run


def encode(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Per document: doc_id, n_tokens, ids."""
    ship(docs.sparkSession)
    return id_and_text(docs).mapInArrow(_encoded(model or default_model()), ENCODED)


def decode(encoded: DataFrame, model: str | None = None) -> DataFrame:
    """Per row of ``doc_id, ids``: doc_id, text. Bytes that are no UTF-8 become U+FFFD."""
    path = model or default_model()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [np.array(x or [], np.int64) for x in batch.column("ids").to_pylist()]
            flat = np.concatenate(rows) if rows else np.empty(0, np.int64)
            texts = coder(path).decode(flat, np.array([len(r) for r in rows], np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array([t.decode(errors="replace") for t in texts], pa.string())], names=["doc_id", "text"]
            )

    ship(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, text string")


def round_trip(docs: DataFrame, model: str | None = None) -> DataFrame:
    """Encode and decode: doc_id, n_tokens, ids_crc32, n_bytes, decoded_sha256, exact (the decoded text is the text)."""
    ship(docs.sparkSession)
    return id_and_text(docs).mapInArrow(_digests(model or default_model()), DIGEST)
