"""What an index root holds, answered from its commit log and documents."""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from docindex.functions.records import members
from docindex.locator import ALL_INDICES, Locator
from docindex.mapping import merged
from docindex.sources import log
from docindex.sources.log import Part, Segment

REJECTED = "rejected"
BITMAPS = T.StructType([
    T.StructField("_index", T.StringType()), T.StructField("_type", T.StringType()), T.StructField("_try", T.StringType()),
    T.StructField("_bucket", T.LongType()), T.StructField("_bits", T.BinaryType()),
])


def glob_paths(spark: SparkSession, pattern: str) -> list[str]:
    """Paths matching a pattern, through the file system the path belongs to."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().toString() for s in (fs.globStatus(path) or [])]


def segments(spark: SparkSession, root: str, locator: Locator | str = "es://_all", state: log.State | None = None) -> dict[Segment, Part]:
    """Committed parts in the locator's scope, by the log alone."""
    loc = Locator.of(locator)
    parts = (state or log.state(spark, root)).parts
    return {s: p for s, p in parts.items() if loc.covers(s.index, s.type)}


def _either(names: tuple[str, ...]) -> str:
    """A path pattern for some names; for all where a name needs more than a pattern can say."""
    if not names or names == (ALL_INDICES,) or not all(re.fullmatch(r"[\w.\-]+\*?", n) for n in names):
        return "*"
    return "{" + ",".join(names) + "}"


def list_indices(spark: SparkSession, root: str) -> list[str]:
    """Sorted names of the indices that hold documents."""
    return sorted({s.index for s in segments(spark, root) if s.kind != REJECTED})


def document_counts(spark: SparkSession, root: str, locator: Locator | str = "es://_all") -> DataFrame:
    """Current documents of each index, (_index, docs): the log's figures less what its bitmaps take out. No document is read."""
    state = log.state(spark, root)
    counts: dict[str, int] = {}
    found = {s: p for s, p in segments(spark, root, locator, state).items() if s.kind != REJECTED}
    for s, part in found.items():
        counts[s.index] = counts.get(s.index, 0) + part.records
    held = spark.createDataFrame(sorted(counts.items()), "_index string, docs long")
    bits = deleted_rows(spark, root, state, {p.place for p in found.values()})
    if bits is None:
        return held
    gone = bits.groupBy("_index").agg(F.sum(F.bitmap_count("_bits")).alias("gone"))
    return held.join(gone, "_index", "left").select("_index", (F.col("docs") - F.coalesce("gone", F.lit(0))).alias("docs"))


def deleted_rows(spark: SparkSession, root: str, state: log.State, wanted: set[tuple]) -> DataFrame | None:
    """Deletion bitmaps of some places, one row for each bucket of sequence numbers; None without any."""
    paths = sorted({d.path for d in state.deletions if any(p in wanted for p, _ in d.rows)})
    if not paths:
        return None
    bits = spark.read.schema(BITMAPS).parquet(*[f"{root}/{p}" for p in paths])
    by_target: dict[tuple[str, str], set[str]] = {}
    for index, doc_type, attempt in wanted:
        by_target.setdefault((index, doc_type), set()).add(attempt)
    here = reduce(lambda x, y: x | y, [
        (F.col("_index") == i) & (F.col("_type") == t) & F.col("_try").isin(sorted(some)) for (i, t), some in by_target.items()
    ])
    return bits.where(here).groupBy(*BITMAPS.names[:-1]).agg(F.bitmap_or_agg("_bits").alias("_bits"))


def list_types(spark: SparkSession, root: str, index: str) -> list[str]:
    """Sorted document types of one index."""
    return sorted({s.type for s in segments(spark, root) if s.index == index and s.kind != REJECTED})


# -- mappings ----------------------------------------------------------------

def dump_mapping(spark: SparkSession, mapping: dict, path: str) -> None:
    """A mapping as a one-line JSON file."""
    line = spark.range(0, 1, 1, 1).select(F.lit(json.dumps(mapping)).alias("value"))
    line.write.mode("overwrite").text(path)


def load_mapping(spark: SparkSession, path: str) -> dict:
    return json.loads(spark.read.text(path).first()["value"])


def put_mapping(spark: SparkSession, root: str, index: str, doc_type: str, mapping: dict) -> None:
    """Store a target's mapping as its next version; what another writer stores meanwhile is merged into it."""
    folder, place = log.Folder(spark, root), f"_mappings/{index}/{doc_type}"
    names = folder.names(place)
    while True:
        number = 1 + (int(names[-1].partition(".")[0]) if names else 0)
        text = json.dumps({"index": index, "type": doc_type, "mapping": mapping})
        if folder.create(f"{place}/{number:09d}.json", text):
            return
        names = folder.names(place)
        mapping = merged(json.loads(folder.read(f"{place}/{names[-1]}"))["mapping"], mapping)


def get_mappings(spark: SparkSession, root: str, locator: Locator | str = "es://_all") -> dict[tuple[str, str], dict]:
    """The newest mappings in scope by (index, type), in one read of their small files."""
    loc = Locator.of(locator)
    newest: dict[str, str] = {}
    for path in sorted(glob_paths(spark, f"{root}/_mappings/{_either(loc.indices)}/{_either(loc.types)}/*.json")):
        newest[path.rpartition("/")[0]] = path
    if not newest:
        return {}
    named = [json.loads(r["value"]) for r in spark.read.text(sorted(newest.values())).collect()]
    return {(m["index"], m["type"]): m["mapping"] for m in named if loc.covers(m["index"], m["type"])}


def get_mapping(spark: SparkSession, root: str, index: str, doc_type: str) -> dict | None:
    return get_mappings(spark, root, Locator((index,), (doc_type,))).get((index, doc_type))


def observed_mapping(docs: DataFrame, source: str = "_source") -> DataFrame:
    """Field and type of every member seen in the documents: (field, type)."""
    pairs = docs.select(F.explode(members(F.col(source))).alias("field", "value"))
    return pairs.groupBy("field").agg(F.schema_of_variant_agg("value").alias("type"))


def document_fields(docs: DataFrame, source: str = "_source", only: list[str] | None = None) -> DataFrame:
    """Distinct member names of the documents, optionally only the given ones."""
    names = docs.select(F.explode(F.json_object_keys(source)).alias("field"))
    if only is not None:
        names = names.where(F.col("field").isin(only))
    return names.distinct()


def names_frame(spark: SparkSession, names: list[str], column: str) -> DataFrame:
    return spark.createDataFrame([(n,) for n in names], f"{column} string")
