"""Normalisation of titles, authors, numbers and years, as Column functions and column-adding steps.

Functions of one column nest freely; the composite cleaners refer to each step's result several
times, so they add a column a step and let the optimiser join the projections.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import vocab as V


def present(text: Column) -> Column:
    """The text, missing as empty."""
    return F.coalesce(text, F.lit(""))


def squash(text: Column) -> Column:
    """Full-width letters and digits to ASCII, white space runs to one space, ends stripped."""
    folded = F.translate(present(text), V.FULL_WIDTH + V.SPACES, V.ASCII + " " * len(V.SPACES))
    return F.btrim(F.regexp_replace(folded, f"{V.S}+", " "))


def strip_title_wrap(text: Column) -> Column:
    """At most two layers of wrapping brackets taken off; opening and closing need not match."""
    s = squash(text)
    for _ in range(2):
        s = F.btrim(F.regexp_replace(s, V.WRAP, "$1"))
    return s


def cjk_ratio(text: Column) -> Column:
    """Share of han characters, 0 for the empty text."""
    s = present(text)
    return F.when(F.length(s) > 0, F.regexp_count(s, F.lit(f"[{V.HAN}]")) / F.length(s)).otherwise(F.lit(0.0))


def settled(df: DataFrame, columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` computed at this point of the plan.

    The optimiser moves filters below projections by putting each column's expression in its place. In
    a chain of steps that each use the one before several times, that grows exponentially and computes
    everything twice; filters don't move below a generator.
    """
    rest = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*rest, F.inline(F.array(F.struct(*columns))))


def head_before(text: Column, pattern: str) -> Column:
    """What stands before the first match of a pattern; empty without one. Its length is in code points."""
    return F.regexp_extract(text, rf"(?s)^(.*?)(?:{pattern})", 1)


def editions(text: Column) -> tuple[Column, Column]:
    """(rest, edition words): bracketed ones anywhere, then one at the end, distinct in order."""
    inner = squash(F.regexp_replace(text, V.EDITION_PAREN, " "))
    tail = F.regexp_extract(inner, V.EDITION_TAIL, 1)
    found = F.concat(F.regexp_extract_all(text, F.lit(V.EDITION_PAREN), F.lit(1)), F.when(tail != "", F.array(tail)).otherwise(F.array().cast("array<string>")))
    return F.btrim(F.regexp_replace(inner, V.EDITION_TAIL, "")), F.array_join(F.array_distinct(found), "、")


def volume(text: Column) -> tuple[Column, Column]:
    """(rest, volume): the first volume statement, all its occurrences removed, unless it is the whole text."""
    found = F.regexp_extract(text, f"({V.VOLUME})", 1)
    fits = (found != "") & (F.length(found) <= F.length(text) - 1)
    return F.when(fits, squash(F.replace(text, found, F.lit(" ")))).otherwise(text), F.when(fits, found).otherwise("")


def with_promo_cut(df: DataFrame, col: str) -> DataFrame:
    """``col`` without promotional text, and ``cut``: whether any was found. Eight steps, each on the one before."""
    s, cut = "__s", "__cut"
    bracket = rf"{V.OPEN}(?={V.NOT_CLOSE}{{0,40}}{V.CLOSE}){V.NOT_CLOSE}*?(?:{V.PROMO}|{V.JUNK}|{V.TIE_IN}){V.NOT_CLOSE}*{V.CLOSE}"
    aside = rf"[（(](?=[^（()）]{{12,}}[）)])[^（()）]*?{V.ASIDE}[^（()）]*[）)]"
    df = df.withColumn(s, squash(F.col(col)))
    for k, pattern in enumerate((bracket, aside)):
        hit = F.col(s).rlike(pattern)
        df = df.withColumns({cut: hit if not k else F.col(cut) | hit, s: F.regexp_replace(s, pattern, " ")})

    def truncate(df: DataFrame, pattern: str, strip: str | None) -> DataFrame:
        head = "__head"
        df = df.withColumn(head, head_before(F.col(s), pattern))
        hit = F.length(head) >= 2
        return df.withColumns({cut: F.col(cut) | hit, s: F.when(hit, F.btrim(head, F.lit(strip)) if strip else F.col(head)).otherwise(F.col(s))}).drop(head)

    df = truncate(df, V.GENRE, None)
    # the first marker whose head keeps two characters; heads come from the pieces around the markers
    df = df.withColumns({"__p": F.split(s, V.PROMO, -1), "__m": F.regexp_extract_all(s, F.lit(V.PROMO), F.lit(0))})
    size = lambda a: F.aggregate(a, F.lit(0), lambda acc, x: acc + F.length(x))
    heads = F.transform("__m", lambda m, i: F.btrim(F.substr(s, F.lit(1), size(F.slice("__p", 1, i + 1)) + size(F.slice("__m", 1, i))), F.lit(V.HEAD_STRIP)))
    df = df.withColumn("__h", F.when(F.size("__m") > 0, F.get(F.filter(heads, lambda h: F.length(h) >= 2), F.lit(0))))
    df = df.withColumns({cut: F.col(cut) | F.col("__h").isNotNull(), s: F.coalesce("__h", s)}).drop("__p", "__m", "__h")
    df = truncate(df, V.AUTHOR_BLOCK, V.HEAD_STRIP)
    first, rest = (F.regexp_extract(s, rf"^([^{V.WS}]{{2,14}}) (.+)$", k) for k in (1, 2))
    listed = (F.regexp_count(first, F.lit(f"[{V.HAN}]")) >= 2) & rest.rlike(V.any_of(V.ENDORSEMENTS))
    df = df.withColumns({cut: F.col(cut) | listed, s: F.when(listed, first).otherwise(F.col(s))})
    df = truncate(df, V.PRESS, V.HEAD_STRIP)
    df = truncate(df, V.JUNK, " ")
    return settled(df.withColumns({col: squash(F.col(s)), "cut": F.col(cut)}).drop(s, cut), [col, "cut"])


def with_clean_title(df: DataFrame, raw: str) -> DataFrame:
    """``df`` and ``title, edition, volume, confidence`` of a raw title."""
    t = "__t"
    df = df.withColumn(t, F.regexp_replace(F.regexp_replace(strip_title_wrap(F.col(raw)), V.SERIES, " "), f"{V.S}*[:：]{V.S}*$", ""))
    rest, edition = editions(F.col(t))
    df = df.withColumns({t: rest, "edition": edition})
    rest, vol = volume(F.col(t))
    df = df.withColumns({t: F.regexp_replace(rest, "[—–]{2,}", "—"), "volume": vol})
    df = with_promo_cut(df, t)
    tail = F.btrim(F.regexp_replace(t, rf"{V.S}+(?:{V.any_of(V.TAIL_ROLES)})$", ""), F.lit(V.TITLE_STRIP))
    df = df.withColumn("title", squash(F.regexp_replace(tail, rf"^[—\-–]+{V.S}*", "")))
    low = (F.length("title") == 0) | (F.length("title") > 40) | F.col("title").rlike(f"{V.PROMO}|{V.JUNK}")
    df = df.withColumn("confidence", F.when(low, 0.3).when(F.col("cut"), 0.6).otherwise(1.0)).drop(t, "cut")
    return settled(df, ["title", "edition", "volume", "confidence"])


def title_key(title: Column) -> Column:
    """The key of exact matching: no white space, no punctuation, lower case."""
    return F.lower(F.regexp_replace(squash(title), V.KEY_DROP_CLASS, ""))


def is_strong_key(key: Column) -> Column:
    return F.length(key) >= 2


def clean_author(raw: Column) -> Column:
    """The author's name, empty where it cannot be told."""
    s = squash(raw)
    named = F.btrim(F.regexp_replace(s, V.AUTHOR_ROLE, ""), F.lit(V.AUTHOR_STRIP))
    untagged = F.when(named.rlike(V.AUTHOR_TAG), F.regexp_replace(named, V.AUTHOR_TAG_CUT, "")).otherwise(named)
    return F.when(s == V.ANONYMOUS, s).when(s.isin(*V.NO_AUTHOR) | s.rlike(V.AUTHOR_DATE), "").otherwise(F.btrim(untagged))


def _weighted(digits: Column, n: int, weight) -> Column:
    """Sum of the first n digits, each times its weight."""
    return F.aggregate(F.sequence(F.lit(0), F.lit(n - 1)), F.lit(0), lambda acc, i: acc + weight(i) * F.substr(digits, i + 1, F.lit(1)).cast("int"))


def isbn13(raw: Column) -> Column:
    """A valid ISBN in 13 digits (10 digits are converted), or empty."""
    alternate = lambda i: F.when(i % 2 == 0, 1).otherwise(3)
    check = lambda body: ((10 - _weighted(body, 12, alternate) % 10) % 10).cast("string")
    digits = F.upper(F.regexp_replace(squash(raw), "[^0-9Xx]", ""))
    last = (11 - _weighted(digits, 9, lambda i: 10 - i) % 11) % 11
    ten = F.concat(F.lit("978"), F.substr(digits, F.lit(1), F.lit(9)))
    good_ten = F.substr(digits, F.lit(10), F.lit(1)) == F.when(last == 10, "X").otherwise(last.cast("string"))
    return (
        F.when(digits.rlike("^[0-9]{9}[0-9X]$"), F.when(good_ten, F.concat(ten, check(ten))).otherwise(""))
        .when(digits.rlike("^[0-9]{13}$"), F.when(check(digits) == F.substr(digits, F.lit(13), F.lit(1)), digits).otherwise(""))
        .otherwise("")
    )


def has_tail_noise(text: Column) -> Column:
    return present(text).rlike(f"{V.PROMO}|{V.PRESS}|{V.JUNK}")


def pub_year(raw: Column) -> Column:
    return F.regexp_extract(squash(raw), f"({V.YEAR})", 1)


def decade(year: Column) -> Column:
    return F.concat(F.substring(year, 1, 3), F.lit("0s"))


def grams(key: Column) -> Column:
    """Distinct two-character grams; a shorter key is its own."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.length(key) - 1, F.lit(1))), lambda i: F.substr(key, i, F.lit(2))))


def percent(part: Column, whole: Column) -> Column:
    """One decimal and a percent sign; 0% of nothing."""
    return F.when(whole > 0, F.format_string("%.1f%%", part / whole * 100)).otherwise("0%")


def split_pub(text: Column) -> tuple[Column, Column, Column]:
    """(author, press, year) of a line ``author / … / press / year / price``."""
    strip = lambda p: F.regexp_replace(p, f"^{V.S}+|{V.S}+$", "")
    parts = F.filter(F.transform(F.split(present(text), "/"), strip), lambda p: p != "")
    after = F.slice(parts, 2, F.greatest(F.size(parts), F.lit(1)))
    press = F.coalesce(F.get(F.filter(after, lambda p: p.rlike(f"(?:{V.any_of(V.LISTING_PRESS)})$")), F.lit(0)), F.get(parts, F.lit(1)), F.lit(""))
    years = F.filter(F.transform(F.reverse(after), lambda p: F.regexp_extract(p, rf"((?:19|20){V.D}{{2}})", 1)), lambda y: y != "")
    return F.coalesce(F.get(parts, F.lit(0)), F.lit("")), press, F.coalesce(F.get(years, F.lit(0)), F.lit(""))
