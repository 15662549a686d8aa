"""Shaping of records and JSON documents, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

# Text form of time values inside a document: full precision, ISO-8601.
JSON_OPTIONS = {
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


# -- record to document ------------------------------------------------------

def text_document(columns: list[str]) -> Column:
    """Every field as a JSON string under its name; null fields are left out."""
    return F.to_json(F.struct(*[F.col(_q(c)).cast("string").alias(c) for c in columns]))


def typed_document(schema: T.StructType) -> Column:
    """Every field with its own JSON type; nulls and empty lists are left out."""
    fields = [compact(F.col(_q(f.name)), f.dataType).alias(f.name) for f in schema.fields]
    return F.to_json(F.struct(*fields), JSON_OPTIONS)


def compact(value: Column, dtype: T.DataType) -> Column:
    """Leave out nulls in lists and maps, and empty lists, at every depth.

    Null members of a struct need no work: ``to_json`` omits them.
    """
    if isinstance(dtype, T.ArrayType):
        items = F.array_compact(value)
        if _has_collections(dtype.elementType):
            items = F.array_compact(F.transform(items, lambda x: compact(x, dtype.elementType)))
        return F.when(F.size(items) > 0, items)
    if isinstance(dtype, T.MapType):
        entries = value
        if _has_collections(dtype.valueType):
            entries = F.transform_values(entries, lambda _, v: compact(v, dtype.valueType))
        return F.map_filter(entries, lambda _, v: v.isNotNull())
    if isinstance(dtype, T.StructType) and _has_collections(dtype):
        members = [compact(value[f.name], f.dataType).alias(f.name) for f in dtype.fields]
        return F.when(value.isNotNull(), F.struct(*members))
    return value


def _has_collections(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.StructType):
        return any(_has_collections(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.ArrayType | T.MapType)


def retyped(text: Column, schema: T.StructType | str) -> Column:
    """A JSON document read with a declared schema and written back compacted;
    null where the text is no document."""
    struct = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    parsed = F.from_json(text, struct)
    return F.when(is_document(members(text)), F.to_json(compact(parsed, struct), JSON_OPTIONS))


# Stand-ins for escaped backslashes and quotes, and the JSON escapes of the stand-ins themselves.
BACKSLASH, QUOTE = "\uf8f0", "\uf8f1"
# A text in quotes is a token that no replacement looks into.
TOKEN = '"[^"]*+"'


def compacted(text: Column) -> Column:
    """The same for documents of unknown shape: null members, nulls in lists and
    empty lists are left out. Everything else keeps its text, numbers of any size too.

    Null where the text is no JSON object, or one in which a key occurs twice.
    """
    plain = F.replace(F.replace(text, F.lit(BACKSLASH), F.lit("\\uf8f0")), F.lit(QUOTE), F.lit("\\uf8f1"))
    plain = F.replace(F.replace(plain, F.lit("\\\\"), F.lit(BACKSLASH)), F.lit('\\"'), F.lit(QUOTE))
    tight = _without(plain, r"\s++")
    kept = _without(tight, rf'{TOKEN}:null(?:,|(?=\}}))', r"(?<=[\[,])null(?:,|(?=\]))")
    kept = _without(kept, r",(?=[\]}])")
    # A list of empty lists is empty after them: as many rounds as brackets open in a row.
    rounds = F.coalesce(F.array_max(F.transform(F.regexp_extract_all(kept, F.lit(r"(\[+)")), F.length)), F.lit(0))
    kept = F.when(rounds == 0, kept).otherwise(F.aggregate(F.sequence(F.lit(1), F.greatest(rounds, F.lit(1))), kept, lambda t, _: _without_empty_lists(t)))
    kept = F.replace(F.replace(kept, F.lit(QUOTE), F.lit('\\"')), F.lit(BACKSLASH), F.lit("\\\\"))
    return F.when(is_document(members(text)) & _strict(tight), kept)


def _without(text: Column, *patterns: str) -> Column:
    """The text without the matches that stand outside its quoted texts."""
    return F.regexp_replace(text, "|".join([*patterns, f"({TOKEN})"]), "$1")


def _without_empty_lists(text: Column) -> Column:
    emptied = _without(text, rf'{TOKEN}:\[\](?:,|(?=\}}))', r"(?<=[\[,])\[\](?:,|(?=\]))")
    return _without(emptied, r",(?=[\]}])")


def _strict(tight: Column) -> Column:
    """One object and nothing after it, without the liberties that the parser allows."""
    bare = F.regexp_replace(tight, TOKEN, "")

    def number(sign: str) -> Column:
        return F.length(bare) - F.length(F.replace(bare, F.lit(sign), F.lit("")))

    closed = ~bare.rlike(r"\}[^,\]}]") & bare.endswith("}")
    return bare.rlike(r"^[\[\]{},:0-9eE+.\-truefalsn]*+$") & closed & (number("{") == number("}")) & (number("[") == number("]"))


# -- reading documents -------------------------------------------------------

def members(text: Column) -> Column:
    """The document's members as a map; null when the text is no JSON object."""
    return F.from_json(text, "map<string,variant>")


def is_document(fields: Column) -> Column:
    """True where ``members`` came from a JSON object in which no key occurs twice."""
    keys = F.map_keys(fields)
    return F.coalesce(F.size(F.array_distinct(keys)) == F.size(keys), F.lit(False))


def member_or(fields: Column, name: str, default: Column) -> Column:
    """A member as text, ``default`` when absent; a present null is the text ``null``."""
    value = F.coalesce(F.element_at(fields, F.lit(name)).cast("string"), F.lit("null"))
    return F.when(F.map_contains_key(fields, name), value).otherwise(default)


def drop_keys(text: Column, *names: str) -> Column:
    """The document without the named members."""
    return F.to_json(F.map_filter(members(text), lambda k, _: ~k.isin(*names)))


def field_of(text: Column, name: str) -> Column:
    """One member of a document as text, null when absent."""
    return F.get_json_object(text, f"$['{name}']")


# -- small column helpers ----------------------------------------------------

def script_key(*columns: str, sep: str = "|") -> Column:
    """Fields joined into one key; a missing field shows as ``null``."""
    parts = [F.coalesce(F.col(_q(c)).cast("string"), F.lit("null")) for c in columns]
    return F.concat_ws(sep, *parts)


def epoch_seconds_to_ms(seconds: Column) -> Column:
    return seconds * F.lit(1000).cast("bigint")


def fragment(text: Column, length: int = 50) -> Column:
    """The leading characters, as shown in reports."""
    return F.substring(text, 1, length)


def rename(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Project to the given columns under new names."""
    return df.select(*[F.col(_q(old)).alias(new) for old, new in names.items()])


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
