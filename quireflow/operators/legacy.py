"""The older cleaning rules, for data that was keyed by them."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.vocab import S, WS

# Brackets deleted, punctuation kept, characters deleted at the end, edition words, cutting characters.
BRACKETS = "《》【】[]（）()「」『』"
KEPT = "，。！？、；：·…—–-"
DELETED = "<>/\\|:*?\"'"
EDITIONS = ("修订版", "增订版", "新版", "典藏版", "精装版", "平装版", "图文版", "插图版")
TITLE_CUT = "第卷部册"
AUTHOR_CUT = "著编主译校注点整理疏笺辑"


def nfkc(text: Column) -> Column:
    """Compatibility composition; the engine has no built-in for it, so texts beyond ASCII go to Python in batches."""

    def compose(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: t if t is None or t.isascii() else unicodedata.normalize("NFKC", t))

    return F.pandas_udf(compose, "string")(text)


def clean_text(text: Column, compose: bool = True) -> Column:
    """Ends stripped, white space collapsed, brackets and rare characters deleted, composed."""
    s = F.regexp_replace(T.present(text), f"^{S}+|{S}+$", "")
    s = F.regexp_replace(s, f"{S}+", " ")
    s = F.translate(s, BRACKETS, "")
    s = F.regexp_replace(s, rf"[^\p{{L}}\p{{N}}_{WS}{KEPT.replace('-', '')}\-]", "")
    if compose:
        s = nfkc(s)
    return F.regexp_replace(F.translate(s, DELETED, ""), f"^{S}+|{S}+$", "")


def clean_title(text: Column, compose: bool = True) -> Column:
    """Cut at the first of 第卷部册, edition words deleted."""
    s = F.regexp_replace(clean_text(text, compose), f"{S}*[{TITLE_CUT}][^\n]*$", "")
    return F.regexp_replace(F.regexp_replace(s, rf"{S}*[\[\(]*(?:{'|'.join(EDITIONS)})[\]\)]*{S}*", ""), f"^{S}+|{S}+$", "")


def clean_author(text: Column, compose: bool = True) -> Column:
    """Cut at the first role character."""
    return F.regexp_replace(F.regexp_replace(clean_text(text, compose), f"{S}*[{AUTHOR_CUT}][^\n]*$", ""), f"^{S}+|{S}+$", "")


def book_key(title: Column, author: Column) -> Column:
    return F.md5(F.concat_ws("_", F.lower(F.trim(title)), F.lower(F.trim(author))).cast("binary"))


def clean_books(rows: DataFrame, compose: bool = True) -> DataFrame:
    """``id, title, author, source`` cleaned; rows without title or author go."""
    out = rows.select("id", clean_title(F.col("title"), compose).alias("title"), clean_author(F.col("author"), compose).alias("author"), "source")
    return out.where((F.col("title") != "") & (F.col("author") != ""))


def remove_duplicates(rows: DataFrame) -> DataFrame:
    """The first row (smallest id) of each key of lower-cased title and author; rows without either go."""
    full = rows.where((F.col("title") != "") & (F.col("author") != ""))
    firsts = full.groupBy(book_key(F.col("title"), F.col("author")).alias("key")).agg(F.min(F.struct("id", "title", "author", "source")).alias("r"))
    return firsts.select("r.*", "key")


def clean_and_deduplicate(rows: DataFrame, compose: bool = True) -> DataFrame:
    return remove_duplicates(clean_books(rows, compose))


def new_books(batch: DataFrame, known: DataFrame | None, compose: bool = True) -> DataFrame:
    """What an incremental insert adds: cleaned rows with title and author, the first of each pair that ``known`` lacks."""
    from .ingest import new_rows

    return new_rows(clean_books(batch, compose), known, keys=("title", "author"), title=None)


def join_authors(names: Column) -> Column:
    return F.array_join(names, ", ")


def drop_country(author: Column) -> Column:
    """The author without a leading [country]."""
    return F.regexp_replace(author, rf"^{S}*\[.*?\]{S}*", "")


def without_ids(rows: DataFrame) -> DataFrame:
    """Rows whose title and author are there and no bare Q and digits."""
    bare = lambda c: F.col(c).rlike("^Q[0-9]+$")
    return rows.where(~bare("title") & ~bare("author") & (F.col("title") != "") & (F.col("author") != ""))


def union_distinct(*parts: DataFrame) -> DataFrame:
    """Distinct (title, author) of several results, case folded, ends stripped; the smallest row of each."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    key = [F.lower(F.trim("title")), F.lower(F.trim("author"))]
    return out.groupBy(*[k.alias(f"k{i}") for i, k in enumerate(key)]).agg(F.min(F.struct("title", "author", "source")).alias("r")).select("r.*")
