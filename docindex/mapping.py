"""Mappings (a type's schema document) and the typed view of a document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Mapping type names and the column types they stand for.
MAPPED_TYPES = {
    "string": T.StringType(),
    "integer": T.IntegerType(),
    "long": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "date": T.TimestampType(),
}


def properties(mapping: dict) -> dict:
    return mapping.get("properties", mapping)


def mapping_to_struct(mapping: dict) -> T.StructType:
    """Columns of the typed view; analysis and storage flags become metadata."""
    fields = []
    for name, spec in properties(mapping).items():
        if "properties" in spec:
            dtype: T.DataType = mapping_to_struct(spec)
        else:
            dtype = MAPPED_TYPES[spec.get("type", "string")]
        if spec.get("multi"):
            dtype = T.ArrayType(dtype)
        index = spec.get("index", "analyzed")
        metadata = {
            "analyzed": index == "analyzed",
            "indexed": index not in ("no", False),
            "stored": spec.get("store") in ("yes", True),
        }
        fields.append(T.StructField(name, dtype, True, metadata))
    return T.StructType(fields)


def struct_to_mapping(schema: T.StructType) -> dict:
    """The mapping of a declared schema; a field without a mapped type stays out."""
    props = {}
    for f in schema.fields:
        spec = _spec(f.dataType)
        if spec is None:
            continue
        if f.metadata.get("analyzed") is False:
            spec["index"] = "not_analyzed" if f.metadata.get("indexed", True) else "no"
        if f.metadata.get("stored"):
            spec["store"] = "yes"
        props[f.name] = spec
    return {"dynamic": False, "properties": props}


def _spec(dtype: T.DataType) -> dict | None:
    if isinstance(dtype, T.StructType):
        return {"properties": struct_to_mapping(dtype)["properties"]}
    if isinstance(dtype, T.ArrayType):
        inner = _spec(dtype.elementType)
        return None if inner is None or inner.get("multi") else {**inner, "multi": True}
    if isinstance(dtype, T.TimestampNTZType | T.DateType):
        return {"type": "date"}
    if isinstance(dtype, T.ShortType | T.ByteType):
        return {"type": "integer"}
    return next(({"type": n} for n, t in MAPPED_TYPES.items() if t == dtype), None)


def merged(old: dict | None, new: dict) -> dict:
    """An index's mapping after more fields came in; a field keeps its type."""
    if old is None:
        return new
    fields = dict(properties(old))
    for name, spec in properties(new).items():
        known = fields.setdefault(name, spec)
        if mapping_to_struct({name: known}) != mapping_to_struct({name: spec}):
            raise ValueError(f"field {name!r} is mapped as {known}, not {spec}")
    return {**old, **new, "properties": fields}


def routing_path(mapping: dict) -> str | None:
    return mapping.get("_routing", {}).get("path")


def typed_columns(source: Column, mapping: dict) -> list[Column]:
    """Mapped fields read out of a JSON document.

    Values are read as text first, so that ``"5"`` fills an integer field just
    as ``5`` does; what does not fit the mapped type becomes null.
    """
    struct = mapping_to_struct(mapping)
    as_text = T.StructType([
        T.StructField(f.name, f.dataType if _nested(f.dataType) else T.StringType()) for f in struct.fields
    ])
    parsed = F.from_json(source, as_text)
    return [_coerce(parsed[f.name], f.dataType).alias(f.name, metadata=f.metadata) for f in struct.fields]


def typed_view(df: DataFrame, mapping: dict, source: str = "_source") -> DataFrame:
    """The mapped fields next to the raw document; unmapped members stay only in the text."""
    return df.select("*", *typed_columns(F.col(source), mapping))


def _nested(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.StructType | T.ArrayType)


def _coerce(text: Column, dtype: T.DataType) -> Column:
    if _nested(dtype) or isinstance(dtype, T.StringType):
        return text
    if isinstance(dtype, T.TimestampType):
        millis = F.timestamp_millis(text.try_cast("bigint"))
        return F.when(text.rlike("^-?[0-9]+$"), millis).otherwise(text.try_cast("timestamp"))
    return text.try_cast(dtype)
