"""A search request: a query, its hits and its facets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from docindex.operators.facets import facet_request, facet_totals
from docindex.operators.filters import compile_filter
from docindex.operators.ordinals import page, spread_sort
from docindex.operators.selection import Order

DEFAULT_PAGE = 10


@dataclass(frozen=True)
class SearchResult:
    """``matching`` are all documents of the query, ``hits`` the requested page
    (None when the request asks for none), ``facets`` the long facet table. Each is
    planned when it is asked for, so a request itself starts no job."""

    matching: DataFrame
    body: dict
    default_sort: tuple[str, ...]

    @property
    def hits(self) -> DataFrame | None:
        size = self.body.get("size", DEFAULT_PAGE)
        sort = sort_order(self.body.get("sort", list(self.default_sort)))
        return page(self.matching, sort, self.body.get("from", 0), size) if size else None

    @property
    def facets(self) -> DataFrame | None:
        return facet_request(self.matching, self.body["facets"]) if self.body.get("facets") else None

    def facet_totals(self) -> DataFrame:
        """Missing, total and other of the request's terms facets."""
        return facet_totals(self.matching, self.body.get("facets", {}))

    def total(self) -> DataFrame:
        return hits_count(self.matching)


def matching(df: DataFrame, body: dict, text_fields: list[str] | None = None) -> DataFrame:
    """Documents that satisfy a request's query."""
    return df.where(compile_filter(body.get("query", {"match_all": {}}), df.schema, text_fields))


def search(
    df: DataFrame, body: dict, text_fields: list[str] | None = None, default_sort: tuple[str, ...] = ("_id",)
) -> SearchResult:
    """Run a request body (a parsed JSON document) over an index table.

    Nothing is computed until a result is used, so a request with ``size`` 0
    never produces hits.
    """
    return SearchResult(matching(df, body, text_fields), body, default_sort)


def sort_order(sort: list) -> Order:
    """Sort list of a request, field names or ``{field: "desc"}``, as (column, whether it falls)."""
    order = []
    for entry in sort:
        (name, how), = [(entry, "asc")] if isinstance(entry, str) else entry.items()
        how = how.get("order", "asc") if isinstance(how, dict) else how
        order.append((name, how == "desc"))
    return order


def sorted_documents(df: DataFrame, fields: list[str]) -> DataFrame:
    """All documents in the order of several fields."""
    return spread_sort(df, fields)


def hits_count(df: DataFrame) -> DataFrame:
    """Number of hits, one row."""
    return df.agg(F.count("*").alias("hits"))
