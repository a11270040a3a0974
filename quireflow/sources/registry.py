"""Parsers of listings by the name of their source, and the union of what they give."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame

from . import html, json

#: A parser takes pages as rows and gives a listing in the raw schema. New sources are added here.
PARSERS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "dangdang": html.shop_items,
    "douban": html.tag_items,
    "weread": json.page_items,
    "pdc": json.catalogue_items,
}


def listings(pages: dict[str, DataFrame]) -> DataFrame:
    """One listing of the pages of several sources."""
    return reduce(DataFrame.unionByName, [PARSERS[source](rows) for source, rows in pages.items()])
