"""Search over a document table: match, exact filter, sort, page, highlight."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tillstream.functions.text import highlight, matches


def by_id(documents: DataFrame, id_column: str, value) -> DataFrame:
    """The document with this id."""
    return documents.filter(F.col(id_column) == value)


def search(
    documents: DataFrame,
    text: str,
    query: str,
    only: Column | None = None,
    sort: list[Column] | None = None,
    start: int = 0,
    size: int | None = None,
    mark: str | None = None,
) -> DataFrame:
    """Documents matching any query token and the exact filter; a page of them when `size` is given.

    `mark` names the column for the highlighted text, computed for the page's rows only.
    """
    hits = documents if only is None else documents.filter(only)
    hits = hits.filter(matches(F.col(text), query))
    if sort:
        hits = hits.orderBy(*sort)
    if size is not None:
        hits = hits.offset(start).limit(size)
    return hits.withColumn(mark, highlight(F.col(text), query)) if mark else hits
