"""The gate that decides whether a title names a book, and the score of an entry."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import text as T
from . import vocab as V


def reject_reason(title: Column, key: Column | None = None, min_han: float = V.MIN_HAN, max_len: int = V.MAX_TITLE) -> Column:
    """Why a title is no book, the first reason that holds; null keeps it. With ``key``, one-character keys go too."""
    t = T.present(title)
    reason = (
        F.when(t == "", "empty")
        .when(F.length(t) > max_len, "too_long")
        .when(t.rlike(V.ONLY_PUNCT), "punct_only")
        .when(t.rlike(V.BAD_TITLE), "marketing")
        .when(t.rlike(V.any_of(V.NON_BOOK_WORDS)), "non_book")
        .when(T.cjk_ratio(t) < min_han, "not_chinese")
        .when(t.rlike(r"(.)\1{5,}"), "repeated_char")
    )
    return reason if key is None else reason.when(~T.is_strong_key(key), "single_char")


def score(confidence: Column, n_sources: Column, has_author: Column, has_isbn: Column) -> Column:
    total = confidence + F.least(n_sources - 1, F.lit(3)) * 0.08 + F.when(has_author, 0.04).otherwise(0.0) + F.when(has_isbn, 0.04).otherwise(0.0)
    return F.round(F.least(total, F.lit(1.0)), 3)


def priority(source: Column) -> Column:
    """How far a source's metadata is trusted; 0 for others."""
    table = F.create_map(*[F.lit(x) for pair in V.SOURCE_PRIORITY.items() for x in pair])
    return F.coalesce(F.try_element_at(table, source), F.lit(0))
