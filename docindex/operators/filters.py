"""Filters as column expressions, and their JSON forms.

Each filter works on columns, so Catalyst pushes it into the scan of the typed
columns. A field is a column name; list columns match on any of their values.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from decimal import Decimal, InvalidOperation
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from docindex.functions.text import has_any_word, has_phrase, has_prefix, query_words, query_words_in_order
from docindex.functions.times import instant, is_time

# A clause of a free-text query: operator, or sign, field and words or phrase.
CLAUSE = re.compile(
    r'\s*(?:(?P<op>AND|OR|NOT|&&|\|\||!)(?=\s|$)'
    r'|(?P<sign>[+\-!])?(?:(?P<field>[^\W\d][\w.]*):)?(?:"(?P<phrase>[^"]*)"|(?P<word>[^\s"]+)))'
)
# Marks of query forms that are not supported; they are refused rather than misread.
UNSUPPORTED = re.compile(r"[()\[\]{}^~?\\/]")


def match_all() -> Column:
    return F.lit(True)


def term(field: str, value, schema: T.StructType | None = None) -> Column:
    """Exact equality."""
    dtype = _field_type(schema, field)
    if isinstance(dtype, T.ArrayType):
        return F.array_contains(F.col(field), _literal(value, dtype.elementType))
    return F.col(field) == _literal(value, dtype)


def terms(field: str, values: list, schema: T.StructType | None = None) -> Column:
    """Membership in a list of values of any length; Spark looks them up in a hash set."""
    dtype = _field_type(schema, field)
    if isinstance(dtype, T.ArrayType):
        return F.arrays_overlap(F.col(field), F.array(*[_literal(v, dtype.elementType) for v in values]))
    return F.col(field).isin(*[_literal(v, dtype) for v in values])


def where_in(df: DataFrame, field: str, values: DataFrame) -> DataFrame:
    """Membership in the first column of a table; Spark broadcasts it only when its size allows."""
    wanted = values.select(F.col(values.columns[0]).alias("_wanted")).distinct()
    return df.join(wanted, F.col(field) == F.col("_wanted"), "left_semi")


def rng(
    field: str, schema: T.StructType | None = None, *, gte=None, gt=None, lte=None, lt=None, from_=None, to=None
) -> Column:
    """Range; ``from_``/``to`` include both ends. Time bounds may carry a zone offset."""
    dtype = _field_type(schema, field)
    col = F.col(field)
    lower = gte if gte is not None else from_
    upper = lte if lte is not None else to
    tests = []
    if lower is not None:
        tests.append(col >= _literal(lower, dtype))
    if gt is not None:
        tests.append(col > _literal(gt, dtype))
    if upper is not None:
        tests.append(col <= _literal(upper, dtype))
    if lt is not None:
        tests.append(col < _literal(lt, dtype))
    return all_of(*tests)


def between(field: str, start, end, schema: T.StructType | None = None) -> Column:
    return rng(field, schema, from_=start, to=end)


def all_of(*filters: Column) -> Column:
    return reduce(lambda a, b: a & b, filters) if filters else match_all()


def none_of(*filters: Column) -> Column:
    """Complement of what the filters match together: a row lacking the field is kept."""
    return ~F.coalesce(all_of(*filters), F.lit(False))


def any_of(*filters: Column) -> Column:
    return reduce(lambda a, b: a | b, filters) if filters else F.lit(False)


def match(field: str | Column, text: str, operator: str = "or") -> Column:
    """Analysed match: any word of ``text`` (or every one) occurs in the field."""
    column, words = F.col(field) if isinstance(field, str) else field, query_words(text)
    if operator.lower() == "and":
        return all_of(*[has_any_word(column, [w]) for w in words]) if words else F.lit(False)
    return has_any_word(column, words)


def query_string(query: str, text_fields: list[Column], field_of: Callable[[str], Column] = F.col) -> Column:
    """Free text over all text fields.

    Words, ``"phrases"`` and ``prefix*`` match any unless marked: ``+`` or ``AND``
    makes a clause required, ``-`` or ``NOT`` forbids it. ``field:`` before a
    clause looks into one field, ``field:*`` asks for its presence. ``*`` and the
    empty query match everything. Other query forms raise.
    """
    query = query.strip()
    if query in ("", "*"):
        return match_all()
    clauses = _clauses(query)
    everywhere = F.concat_ws(" ", *text_fields)
    tests: dict[str, list[Column]] = {"+": [], "-": [], "": []}
    for sign, field, phrase, word in clauses:
        column = field_of(field) if field else everywhere
        test = _clause_test(column, field, phrase, word)
        if test is not None:
            tests[sign].append(test)
    if not any(tests.values()):
        return F.lit(False)
    wanted = tests["+"] or ([any_of(*tests[""])] if tests[""] else [])
    return all_of(*wanted, *[none_of(t) for t in tests["-"]])


def _clauses(query: str) -> list[tuple[str, str | None, str | None, str | None]]:
    """(sign, field, phrase, word) of every clause; the sign is ``+``, ``-`` or empty."""
    found: list[list] = []
    at, joined, negated = 0, False, False
    while at < len(query.rstrip()):
        m = CLAUSE.match(query, at)
        if m is None:
            raise ValueError(f"cannot read {query[at:]!r} in the query {query!r}")
        at = m.end()
        if m["op"]:
            if m["op"] in ("AND", "&&"):
                joined = True
                if found and found[-1][0] == "":
                    found[-1][0] = "+"
            elif m["op"] in ("NOT", "!"):
                negated = True
            continue
        word = m["word"]
        if word is not None and (UNSUPPORTED.search(word) or "*" in word[:-1]):
            raise ValueError(f"unsupported query form {word!r}")
        sign = "-" if negated or m["sign"] in ("-", "!") else "+" if joined or m["sign"] == "+" else ""
        found.append([sign, m["field"], m["phrase"], word])
        joined = negated = False
    return [tuple(c) for c in found]


def _clause_test(column: Column, field: str | None, phrase: str | None, word: str | None) -> Column | None:
    """None for a clause without any word, which asks for nothing."""
    if phrase is not None:
        words = query_words_in_order(phrase)
        return has_phrase(column, words) if words else None
    if word == "*":
        return column.isNotNull() if field else match_all()
    if word.endswith("*"):
        words = query_words(word[:-1])
        return has_prefix(column, words[-1]) if words else None
    words = query_words(word)
    return has_any_word(column, words) if words else None


# -- JSON forms --------------------------------------------------------------

def compile_filter(body: dict, schema: T.StructType, text_fields: list[str] | None = None) -> Column:
    """The column expression of a JSON filter or query."""
    kind, arg = _single(body)

    def inner(part: dict) -> Column:
        return compile_filter(part, schema, text_fields)

    def several(part) -> list[Column]:
        part = part["filters"] if isinstance(part, dict) and "filters" in part else part
        return [inner(p) for p in (part if isinstance(part, list) else [part])]

    if kind == "match_all":
        return match_all()
    if kind in ("constant_score", "not"):
        found = inner(arg.get("filter", arg))
        return none_of(found) if kind == "not" else found
    if kind == "and":
        return all_of(*several(arg))
    if kind == "or":
        return any_of(*several(arg))
    if kind == "bool":
        return _bool_filter({k: several(v) for k, v in arg.items() if k in ("must", "should", "must_not")}, arg)
    if kind == "filtered":
        return all_of(*[inner(arg[k]) for k in ("query", "filter") if arg.get(k)])
    if kind == "query":
        return inner(arg)
    if kind == "query_string":
        field = arg.get("default_field")
        texts = [F.col(field)] if field else _texts(schema, text_fields)
        return query_string(arg["query"], texts, lambda name: _known(schema, name))
    if kind in ("exists", "missing"):
        there = _known(schema, arg["field"]).isNotNull()
        return there if kind == "exists" else ~there
    if kind == "ids":
        return F.col("_id").isin(*[str(v) for v in arg["values"]])
    field, value = _single({k: v for k, v in arg.items() if not k.startswith("_")})
    if kind == "term":
        return term(field, value["value"] if isinstance(value, dict) else value, schema)
    if kind == "terms":
        return terms(field, value, schema)
    if kind == "prefix":
        return _known(schema, field).startswith(str(value["value"] if isinstance(value, dict) else value))
    if kind == "match":
        if isinstance(value, dict):
            unknown = set(value) - {"query", "operator"}
            if unknown:
                raise ValueError(f"unsupported match options {sorted(unknown)}")
            return match(_known(schema, field), value["query"], value.get("operator", "or"))
        return match(_known(schema, field), value)
    if kind == "range":
        bounds = {"from_" if k == "from" else k: v for k, v in value.items()}
        return rng(field, schema, **bounds)
    raise ValueError(f"unsupported filter {kind!r}")


def _bool_filter(parts: dict[str, list[Column]], arg: dict) -> Column:
    """All of ``must``, none of ``must_not``, and of ``should`` at least one where nothing must."""
    unknown = {k for k in arg if not k.startswith("_")} - {"must", "should", "must_not", "minimum_should_match", "boost"}
    if unknown:
        raise ValueError(f"unsupported entries {sorted(unknown)} of a bool filter")
    must, should = parts.get("must", []), parts.get("should", [])
    least = int(arg.get("minimum_should_match", 0 if must or not should else 1))
    tests = list(must)
    if should and least == 1:
        tests.append(any_of(*should))
    elif should and least > 1:
        met = [F.coalesce(t, F.lit(False)).cast("int") for t in should]
        tests.append(reduce(lambda a, b: a + b, met) >= least)
    return all_of(*tests, *[none_of(t) for t in parts.get("must_not", [])])


def _known(schema: T.StructType, field: str) -> Column:
    """A field's column; an unknown name raises."""
    _field_type(schema, field)
    return F.col(field)


def backup_filter(spec: dict, schema: T.StructType) -> Column:
    """A filter by method name: ``{"method": [args]}`` or ``{"method": {field: value}}``."""
    tests = []
    for method, arg in spec.items():
        if method == "all":
            tests.append(match_all())
        elif method == "string":
            tests.append(query_string(arg[0] if isinstance(arg, list) else arg, _texts(schema, None)))
        elif isinstance(arg, dict):
            tests.append(compile_filter({method: arg}, schema))
        else:
            tests.append(compile_filter({method: {arg[0]: arg[1]}}, schema))
    return all_of(*tests)


def _single(body: dict):
    if len(body) != 1:
        raise ValueError(f"expected one entry, got {sorted(body)}")
    return next(iter(body.items()))


def _texts(schema: T.StructType, names: list[str] | None) -> list[Column]:
    if names is None:
        names = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType) and not f.name.startswith("_")]
    return [F.col(n) for n in names]


def _field_type(schema: T.StructType | None, field: str) -> T.DataType | None:
    if schema is None:
        return None
    dtype: T.DataType = schema
    for part in field.split("."):
        if not isinstance(dtype, T.StructType) or part not in dtype.names:
            raise ValueError(f"no field {field!r}")
        dtype = dtype[part].dataType
    return dtype


def _literal(value, dtype: T.DataType | None) -> Column:
    """The value in the field's type, so that no cast stands on the column's side.

    A number that the type cannot hold exactly keeps its own type; a text that
    is no number equals nothing in a number field.
    """
    if dtype is None:
        return F.lit(value)
    if is_time(dtype):
        return instant(value, dtype)
    if isinstance(dtype, T.NumericType) and not isinstance(value, bool):
        number = _number(value)
        if number is None:
            return F.lit(None).cast(dtype)
        return F.lit(number).cast(dtype) if _holds(dtype, number) else _wide(number)
    return F.lit(value).try_cast(dtype)


def _number(value) -> Decimal | None:
    try:
        number = Decimal(str(value))
    except InvalidOperation:
        return None
    return number if number.is_finite() else None


def _wide(number: Decimal) -> Column:
    """A number outside the field's type. It is cast from text, because a bare
    decimal literal beyond a whole-number field makes Spark drop the null test."""
    scale = max(0, -number.as_tuple().exponent)
    if max(number.adjusted() + 1, 0) + scale > 38:
        return F.lit(float(number))
    return F.lit(format(number, "f")).cast(T.DecimalType(38, scale))


# Bits of the whole-number types.
INTEGER_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}


def _holds(dtype: T.NumericType, number: Decimal) -> bool:
    bits = INTEGER_BITS.get(type(dtype))
    if bits is not None:
        return number == number.to_integral_value() and -(2 ** (bits - 1)) <= number < 2 ** (bits - 1)
    if isinstance(dtype, T.DecimalType):
        scaled = number.scaleb(dtype.scale)
        return scaled == scaled.to_integral_value() and abs(scaled) < Decimal(10) ** dtype.precision
    return True
