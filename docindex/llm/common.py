"""What the operators of this package share: shipping, batches, text bytes."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

PACKAGE = __name__.split(".")[0]
#: Rows of one Arrow batch; texts may be long, so few rows make a batch.
BATCH_ROWS = "2000"
BATCH_BYTES = str(16 << 20)
_shipped: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Make the package importable on the executors and bound the Arrow batches.

    The archive is served by the driver, so executors need no copy of the
    repository and no shared folder.
    """
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        top = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
        archive = os.path.join(tempfile.mkdtemp(prefix="ship-"), f"{PACKAGE}.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for folder, _, names in os.walk(os.path.join(top, PACKAGE)):
                for name in names:
                    if name.endswith(".py"):
                        path = os.path.join(folder, name)
                        out.write(path, os.path.relpath(path, top))
        context.addPyFile(archive)
        _shipped.add(context.applicationId)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return spark


def id_and_text(docs: DataFrame) -> DataFrame:
    """The two columns that count; a null text is empty. Other columns may have any name."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def unused(df: DataFrame, n: int) -> list[str]:
    """Column names that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    return [name for name in (f"_{k}" for k in range(len(taken) + n)) if name not in taken][:n]


def text_hash() -> Column:
    """Tells rows of one id apart; a null text is empty."""
    return F.xxhash64(F.coalesce("text", F.lit("")))


def rows_of(docs: DataFrame, chosen: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs`` whose id and text stand in ``chosen`` (doc_id, text_print), or the others."""
    a, b = unused(docs, 2)
    side = chosen.select(F.col("doc_id").alias(a), F.col("text_print").alias(b))
    return docs.join(side, F.col("doc_id").cast("long").eqNullSafe(F.col(a)) & (text_hash() == F.col(b)), how)


def first_rows(docs: DataFrame) -> DataFrame:
    """One row for each id and text."""
    (a,) = unused(docs, 1)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return docs.groupBy("doc_id", text_hash().alias(a)).agg(F.first(row).alias("row")).select("row.*")


def bucket(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text, modulo ``parts``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column, and the n + 1 borders of its rows.

    >>> data, borders = text_bytes(pa.array(["ab", "", "c"]))
    >>> bytes(data), borders.tolist()
    (b'abc', [0, 2, 2, 3])
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    borders = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column):
        borders = np.zeros(1, np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    return data[borders[0] : borders[-1]], borders - borders[0]


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Batches cut so that a text column holds about ``most`` bytes, one row at least."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, borders = text_bytes(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = max(start + 1, int(np.searchsorted(borders, borders[start] + most, side="right")) - 1)
            yield batch.slice(start, stop - start)
            start = stop


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that scatters close values."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


#: Bytes of strings and values that a worker remembers of what it has worked out.
MEMORY_BYTES = 64 << 20
_slot: list = []


def held(key: tuple, make: Callable):
    """What ``make`` gives, kept in this process until it is asked for under another key.

    Workers are used again by later stages, so what an earlier one remembers goes first.
    """
    if not _slot or _slot[0] != key:
        _slot.clear()
        _slot[:] = [key, make()]
    return _slot[1]


class Codes(dict):
    """Numbers strings in order of their first appearance and remembers the new ones."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, key: str) -> int:
        code = self[key] = len(self)
        self.new.append(key)
        return code

    def fresh(self) -> list[str]:
        new, self.new = self.new, []
        return new


class Ragged:
    """Rows of different lengths in one growing array, fetched many at a time."""

    def __init__(self, kind: type) -> None:
        self.values, self.borders, self.rows = np.empty(0, kind), np.zeros(1, np.int64), 0

    def extend(self, values: np.ndarray, lengths: np.ndarray) -> None:
        """Room doubles, so that many small additions copy each value a few times only."""
        used, rows = int(self.borders[self.rows]), self.rows + len(lengths)
        self.values = self._grown(self.values, used + len(values))
        self.values[used : used + len(values)] = values
        self.borders = self._grown(self.borders, rows + 1)
        self.borders[self.rows + 1 : rows + 1] = used + np.cumsum(lengths, dtype=np.int64)
        self.rows = rows

    @staticmethod
    def _grown(array: np.ndarray, n: int) -> np.ndarray:
        if n <= len(array):
            return array
        out = np.zeros(max(n, 2 * len(array)), array.dtype)
        out[: len(array)] = array
        return out

    def size(self) -> int:
        return self.values.nbytes + self.borders.nbytes

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows' values one after the other, and the rows' lengths.

        >>> r = Ragged(int); r.extend(np.array([7, 8, 9]), np.array([2, 0, 1]))
        >>> [x.tolist() for x in r.take(np.array([2, 0, 1]))]
        [[9, 7, 8], [1, 2, 0]]
        """
        starts = self.borders[rows]
        lengths = self.borders[rows + 1] - starts
        ends = np.cumsum(lengths)
        place = np.repeat(starts - (ends - lengths), lengths) + np.arange(ends[-1] if len(ends) else 0)
        return self.values[place], lengths


class Known:
    """Values of strings that come again, worked out once while they fit into ``most`` bytes.

    A batch's strings are told apart by Arrow's dictionary; only distinct ones are Python objects.
    """

    def __init__(self, kind: type, learn: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int | None = None) -> None:
        self.kind, self.learn, self.most = kind, learn, most or MEMORY_BYTES
        self.forget()

    def forget(self) -> None:
        self.rows: dict[str, int] = {}
        self.values, self.text = Ragged(self.kind), 0

    def size(self) -> int:
        return self.text + 150 * len(self.rows) + self.values.size()

    def take(self, coded: pa.DictionaryArray) -> tuple[np.ndarray, np.ndarray]:
        """The strings' values one after the other, and each one's number of values."""
        if self.size() > self.most:
            self.forget()
        keys = coded.dictionary.to_pylist()
        rows = np.array([self.rows.get(k, -1) for k in keys], np.int64)
        new = np.flatnonzero(rows < 0)
        if len(new):
            names = [keys[i] for i in new.tolist()]
            rows[new] = np.arange(len(self.rows), len(self.rows) + len(names))
            self.rows.update(zip(names, rows[new].tolist()))
            self.text += sum(map(len, names))
            self.values.extend(*self.learn(names))
        return self.values.take(rows[coded.indices.to_numpy()])


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of ``values``; a run may be empty."""
    total = np.concatenate([np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]
