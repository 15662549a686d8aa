"""Token ids in files of independent zstandard frames with a trailing seek table.

A file holds one frame per document, in ascending id order, then a skippable frame
with the seek table: per document its id, number of tokens, compressed size and the
crc32 of its decompressed bytes. The last bytes name the format. Any zstandard
reader decodes the file as the ids of all its documents; a reader that wants some
documents reads the table and decompresses their frames only.

Texts are moved once, by ranges of the id; each task encodes its range and Spark's
own writer commits the files, so that a lost executor leaves no half-written file,
on any file system that Spark writes to. File sizes are bounded by ``FILE_BYTES``
or one document.

Defined cases: a null or empty text gives the end id alone; a null id comes first and
is kept as null; repeated ids follow each other in order of their texts; an empty table gives
no documents. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from docindex.llm.common import Known, held, id_and_text, ship, slices, sums
from docindex.workspace import materialise, work_dir

END_ID = 0
FILE_BYTES = 32 << 20
BATCH_TEXT = 8 << 20
#: Bytes of chunks and their ids that an encoder remembers.
MEMORY = 192 << 20

# A skippable frame's first number, and how our files end.
SKIPPABLE = 0x184D2A5E
ENDING = "TOKFRAM1"
ENTRY = np.dtype([("doc_id", "<i8"), ("null", "<u4"), ("tokens", "<u4"), ("size", "<u4"), ("crc32", "<u4")])
TAIL = struct.Struct("<I")

#: Chunks of one call of the library.
CALL = 4000
# What keys begin with: a text's first chunk, which has no space in front; a chunk after a line break.
FIRST, LINE = "\1", "\0"
# White space beside a space or line break, where splitting there would differ from the library's own pattern.
WHITE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
UNEVEN = rf"[ \n]{WHITE}|{WHITE}[ \n]|^[ \n]|[ \n]$|[\x00\x01]"

ROW = "path string, doc_id long, place long, n_tokens long, ids_crc32 long"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """The library's ids of whole texts, with a memory for chunks that come again.

    The byte-level pattern starts a new piece at each single space or line break between
    two other characters, so the chunks between those are encoded on their own.
    """

    def __init__(self, vocabulary: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        added = self.tokenizer.get_added_tokens_decoder()
        # Texts that hold an added token are encoded whole; one that takes no space beside it parts many chunks in one call.
        self.uneven = "|".join([UNEVEN, *(re.escape(t.content) for t in added.values())])
        plain = [(i, t.content) for i, t in added.items() if not (t.lstrip or t.rstrip or t.single_word)]
        self.part = plain[0] if plain else None
        self.memory = Known(np.uint32, self._chunks, MEMORY)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after the other, and each text's number of ids."""
        size = pc.binary_length(texts).to_numpy()
        uneven = pc.match_substring_regex(texts, self.uneven).to_numpy(zero_copy_only=False) & (size > 0)
        even = np.flatnonzero(~uneven & (size > 0))
        marked = pc.binary_join_element_wise(FIRST, pc.replace_substring(texts.take(pa.array(even)), "\n", f" {LINE}"), "")
        lists = pc.split_pattern(marked, " ")
        ids, lengths = self.memory.take(lists.flatten().dictionary_encode())
        counts = np.zeros(len(texts), np.int64)
        counts[even] = sums(lengths, pc.list_value_length(lists).to_numpy().astype(np.int64))
        if not uneven.any():
            return ids, counts
        others, n = self._whole(texts.filter(pa.array(uneven)).to_pylist())
        counts[uneven] = n
        owner = np.repeat(np.arange(len(texts)), counts)
        out = np.empty(len(owner), np.uint32)
        out[uneven[owner]], out[~uneven[owner]] = others, ids
        return out, counts

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [np.array(x.ids, np.uint32) for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
        return np.concatenate(found or [np.empty(0, np.uint32)]), np.array([len(x) for x in found], np.int64)

    def _chunks(self, keys: list[str]) -> tuple[np.ndarray, np.ndarray]:
        chunks = [k[1:] if k[:1] == FIRST else "\n" + k[1:] if k[:1] == LINE else " " + k for k in keys]
        if self.part is None:
            return self._whole(chunks)
        ids, lengths = [], []
        for at in range(0, len(chunks), CALL):
            text = self.part[1].join(chunks[at : at + CALL]) + self.part[1]
            some = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint32)
            stops = np.flatnonzero(some == self.part[0])
            lengths.append(np.diff(stops, prepend=-1) - 1)
            ids.append(np.delete(some, stops))
        return np.concatenate(ids), np.concatenate(lengths)


def encoder(vocabulary: str) -> Encoder:
    return held(("token files", vocabulary), lambda: Encoder(vocabulary))


def frames(ids: np.ndarray, counts: np.ndarray) -> Iterator[tuple[bytes, int, int]]:
    """Per document its frame, number of tokens with the end id, and crc32."""
    press = zstandard.ZstdCompressor(level=1, write_checksum=True, write_content_size=True)
    end = np.array([END_ID], "<u4").tobytes()
    raw, start = ids.astype("<u4").tobytes(), 0
    for n in counts.tolist():
        data = raw[start : start + 4 * n] + end
        start += 4 * n
        yield press.compress(data), n + 1, zlib.crc32(data)


def sealed(parts: list[bytes], entries: list[tuple]) -> bytes:
    """A file's bytes up to its ending, which the writer adds."""
    table = np.array(entries, ENTRY).tobytes() + TAIL.pack(len(entries))
    head = struct.pack("<II", SKIPPABLE, len(table) + len(ENDING))
    return b"".join(parts) + head + table


def seek_table(data: bytes) -> np.ndarray:
    ending = ENDING.encode()
    if not data.endswith(ending):
        raise ValueError("not a file of token frames")
    stop = len(data) - len(ending)
    (n,) = TAIL.unpack_from(data, stop - TAIL.size)
    return np.frombuffer(data, ENTRY, n, stop - TAIL.size - n * ENTRY.itemsize)


def documents_of(data: bytes, wanted: set[int] | None = None) -> Iterator[tuple[int, int | None, np.ndarray, int]]:
    """(place, id, token ids, crc32) of the wanted documents; only their frames are decompressed."""
    table = seek_table(data)
    starts = np.cumsum(table["size"], dtype=np.int64) - table["size"]
    for place, (entry, start) in enumerate(zip(table, starts)):
        doc_id = None if entry["null"] else int(entry["doc_id"])
        if wanted is not None and doc_id not in wanted:
            continue
        raw = zstandard.ZstdDecompressor().decompress(data[start : start + int(entry["size"])])
        if zlib.crc32(raw) != entry["crc32"] or len(raw) != 4 * int(entry["tokens"]):
            raise ValueError(f"frame of document {doc_id} is damaged")
        yield place, doc_id, np.frombuffer(raw, "<u4"), int(entry["crc32"])


def _files(vocabulary: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts: list[bytes] = []
        entries: list[tuple] = []
        held = 0
        for batch in slices(batches, "text", BATCH_TEXT):
            ids, counts = encoder(vocabulary).encode(batch.column("text"))
            for doc_id, (frame, tokens, crc) in zip(batch.column("doc_id").to_pylist(), frames(ids, counts)):
                parts.append(frame)
                entries.append((doc_id or 0, doc_id is None, tokens, len(frame), crc))
                held += len(frame)
                if held >= FILE_BYTES:
                    yield pa.RecordBatch.from_arrays([pa.array([sealed(parts, entries)], pa.binary())], names=["value"])
                    parts, entries, held = [], [], 0
        if entries:
            yield pa.RecordBatch.from_arrays([pa.array([sealed(parts, entries)], pa.binary())], names=["value"])

    return run


def write_tokens(docs: DataFrame, folder: str, vocabulary: str | None = None) -> None:
    """Write the documents' token ids, in ascending id order over all files."""
    ship(docs.sparkSession)
    (
        id_and_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
        .mapInArrow(_files(vocabulary or default_vocabulary()), "value binary")
        .select(F.col("value").cast("string").alias("value"))
        .write.option("lineSep", ENDING).option("compression", "none").option("maxRecordsPerFile", 1).text(folder)
    )


def _rows(wanted: set[int] | None, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, data in zip(batch.column("path").to_pylist(), batch.column("content")):
                places, ids, tokens, crcs = zip(*documents_of(data.as_py(), wanted)) if data.is_valid else ((),) * 4
                columns = {
                    "path": pa.array([path] * len(places), pa.string()), "doc_id": pa.array(ids, pa.int64()),
                    "place": pa.array(places, pa.int64()), "n_tokens": pa.array([len(t) for t in tokens], pa.int64()),
                    "ids_crc32": pa.array([zlib.crc32(t.tobytes()) for t in tokens], pa.int64()),
                }
                if with_ids:
                    columns["ids"] = pa.array([t.tolist() for t in tokens], pa.list_(pa.int64()))
                yield pa.RecordBatch.from_pydict(columns)

    return run


def _stored(spark: SparkSession, folder: str) -> DataFrame:
    return ship(spark).read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path", "content")


def file_order(path: str) -> list[Column]:
    """Spark's numbers of the task and of the task's file, from a file's name; as text, part-100000 stands before part-99999."""
    return [F.regexp_extract(path, r"/part-(\d+)-[^/]*-c(\d+)[^/]*$", k).cast("long") for k in (1, 2)] + [F.col(path)]


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """Per document: doc_id, start among all ids, n_tokens, ids_crc32; every frame is decompressed and checked."""
    rows = materialise(_stored(spark, folder).mapInArrow(_rows(None, False), ROW), "token-rows")
    # One row per file, in the order of task and file number; each document adds what its file holds before it.
    files = rows.groupBy("path").agg(F.sum("n_tokens").alias("held"))
    before = Window.orderBy(*file_order("path")).rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("path", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    within = Window.partitionBy("path").orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(files, "path").select(
        "doc_id", (F.col("base") + F.coalesce(F.sum("n_tokens").over(within), F.lit(0))).cast("long").alias("start"),
        "n_tokens", "ids_crc32",
    )


def read_documents(spark: SparkSession, folder: str, doc_ids: Iterable[int]) -> DataFrame:
    """The token ids of some documents: doc_id, ids. Other frames stay compressed."""
    return _stored(spark, folder).mapInArrow(_rows(set(doc_ids), True), ROW + ", ids array<long>").select("doc_id", "ids")


def token_index(docs: DataFrame, vocabulary: str | None = None) -> DataFrame:
    """Write the documents below the shared folder and read the files back."""
    spark = docs.sparkSession
    folder = work_dir(spark, "tokens")
    write_tokens(docs, folder, vocabulary)
    return read_index(spark, folder)
