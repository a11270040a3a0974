"""Personal data by candidate gradient boosting, in DataFrame functions only.

Base spans (e-mail, IP address, card, phone) come from patterns with checks. Further generators with
high recall propose spans that may overlap them: social security numbers, bank account numbers,
spelled-out e-mail addresses, phone numbers without a plus, dates of birth. Boosted trees score each
proposal from its format and from the words before it; the ones above a calibrated threshold that
overlap no base span are added. Base spans always stay.

Positions: the pieces between matches (``split``) and the matches (``regexp_extract_all``) give the
start of each match as a running sum of lengths, in code points. Patterns are possessive and
anchored to the start of a run, so that they take linear time and constant stack on any text; they
match the same spans as their plain forms.

The trees are fitted on the driver on ``TRAIN`` labelled lines made by a fixed rule and seed, whose
features the same expressions compute; they run as nested CASE expressions. In half of these lines no word
of the features' lists stands before the candidate, in some a word of the wrong list does, so the trees can't rest on
the lists alone. The threshold comes from ``CALIBRATE`` lines of another rule (``calibration_lines``), with
whole sentences, formats and look-alikes that the first doesn't make, so it is measured on what the trees weren't fitted to.

Edge cases: a null text counts as empty (no spans, the digest of nothing); very long texts are searched whole, in linear
time; added spans that overlap each other all stand, those that overlap a base span go; a candidate that ties with the
threshold is added; rows with null or repeated ids each give a row; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import functools
import json
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BASE = ("email", "ip", "card", "phone")
ADDED = ("ssn", "iban", "mail_words", "local_phone", "birth")
KINDS = BASE + ADDED

PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without these characters has no match; a cheap test before each pattern.
HINTS = {"email": "@", "ip": ".", "card": None, "phone": "+"}
GENERATORS = {
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "mail_words": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{2,64}\x20?[(\[]\x20?at\x20?[)\]]\x20?[A-Za-z0-9-]{2,63}(?:(?:\x20?[(\[]\x20?dot\x20?[)\]]\x20?|\.)[A-Za-z0-9-]{2,24}){1,4}",
    "local_phone": r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9A-Za-z-])",
    "birth": r"(?<![0-9A-Za-z.-])(?:[0-9]{1,2}[./-][0-9]{1,2}[./-](?:19|20)[0-9]{2}|(?:19|20)[0-9]{2}-[0-9]{2}-[0-9]{2})(?![0-9A-Za-z-])",
}
#: Words before a candidate that speak for or against it, as groups of features.
CONTEXT = {
    "c_phone": "phone|tel|call|mobile|fax|cell|whatsapp|reach",
    "c_ssn": "ssn|social|security|tax",
    "c_bank": "iban|bank|account|transfer|deposit",
    "c_birth": "born|birth|dob|birthday",
    "c_mail": "mail|contact|write|reach|address",
    "c_other": "order|invoice|version|isbn|part|ref|no[.]|#|model|item|page|serial|since|on|updated|published|code|sku|build",
}
BEFORE = 28
FEATURES = ("kind", "digits", "length", "spaces", "dashes", "dots", "brackets", "valid", *CONTEXT)
TRAIN, CALIBRATE, ROUNDS, DEPTH, RATE, PRECISION = 3000, 1500, 40, 3, 0.3, 0.97
_BLOCK = 64


def matches(text: Column, pattern: str, hint: str | None) -> tuple[Column, Column]:
    """The matches of a pattern in order, and the pieces around them (one more)."""
    there = F.contains(text, F.lit(hint)) if hint else text.rlike("[0-9]")
    return (
        F.when(there, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")),
        F.when(there, F.split(text, pattern, -1)).otherwise(F.array(text)),
    )


def starts_of(found: Column, pieces: Column) -> Column:
    """The start of each match. Running sums go by blocks, so a text with many matches costs no square."""
    sums = F.transform(found, lambda m, i: F.length(m) + F.length(F.get(pieces, i)))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor((F.size(found) - 1) / _BLOCK).cast("int")),
        lambda b: F.aggregate(F.slice(sums, b * _BLOCK + 1, _BLOCK), F.lit(0), lambda acc, x: acc + x),
    )
    heads = F.aggregate(blocks, F.array(F.lit(0)), lambda acc, x: F.concat(acc, F.array(F.element_at(acc, -1) + x)))
    held = F.transform(F.array(F.struct(sums.alias("sums"), heads.alias("heads"))), lambda h: F.transform(
        found, lambda m, i: F.get(h["heads"], F.floor(i / _BLOCK).cast("int"))
        + F.aggregate(F.slice(h["sums"], (F.floor(i / _BLOCK) * _BLOCK).cast("int") + 1, (i % _BLOCK).cast("int")), F.lit(0), lambda acc, x: acc + x)
        + F.length(F.get(pieces, i)),
    ))
    return F.when(F.size(found) > 0, F.element_at(held, 1)).otherwise(F.array().cast("array<int>"))


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    n = F.length(digits)

    def term(i):
        d = F.substr(digits, n - i, F.lit(1)).cast("int")
        return F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), lambda acc, i: acc + term(i)) % 10 == 0


def base_ok(kind: str, match: Column) -> Column:
    """The check of a base match."""
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        part = lambda p: F.regexp_replace(p, "^0+(?=[0-9])", "")
        return F.forall(F.split(match, "[.]"), lambda p: F.when(F.length(part(p)) <= 3, part(p).cast("int") <= 255).otherwise(F.lit(False)))
    digits = F.regexp_replace(match, "[^0-9]", "")
    if kind == "card":
        return F.when(F.length(digits).between(16, 19), luhn(digits)).otherwise(F.lit(False))
    return F.length(digits).between(8, 15)


def base_columns(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``__text``) and, for each base kind, arrays of its checked starts and ends."""
    for kind in BASE:
        found, pieces = matches(F.col("__text"), PATTERNS[kind], HINTS[kind])
        rows = rows.withColumns({"__m": found, "__p": pieces})
        rows = rows.withColumn("__s", starts_of(F.col("__m"), F.col("__p")))
        good = F.filter(F.transform("__m", lambda m, i: F.when(base_ok(kind, m), F.struct(F.get("__s", i).alias("a"), (F.get("__s", i) + F.length(m)).alias("b")))), lambda x: x.isNotNull())
        rows = rows.withColumn(f"__{kind}", F.when(F.size("__m") > 0, good).otherwise(F.array().cast("array<struct<a:int,b:int>>"))).drop("__m", "__p", "__s")
    return rows


def _mod97(iban: Column) -> Column:
    """Whether an account number has remainder 1 modulo 97, its first four characters moved to the end."""
    plain = F.regexp_replace(iban, " ", "")
    moved = F.concat(F.substr(plain, F.lit(5), F.length(plain)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(acc, c):
        digit = F.ascii(c)
        return F.when(digit < 58, (acc * 10 + digit - 48) % 97).otherwise((acc * 100 + digit - 55) % 97)

    return F.aggregate(F.filter(F.split(moved, ""), lambda c: c != ""), F.lit(0), step) == 1


def features(kind: int, name: str, match: Column, before: Column) -> list[Column]:
    """The features of a candidate as integers, in the order of FEATURES."""
    count = lambda chars: (F.length(match) - F.length(F.regexp_replace(match, chars, ""))).cast("int")
    if name == "iban":
        valid = _mod97(match)
    elif name == "ssn":
        valid = ~match.rlike("^(000|666|9)|-00-|-0000$")
    elif name == "birth":
        valid = ~match.rlike("^(0?[0-9]|[12][0-9]|3[01])[./-](1[3-9]|[2-9][0-9]|00)[./-]")
    elif name == "local_phone":
        valid = match.rlike(r"^\(?[2-9]")
    else:
        valid = F.lit(True)
    context = [F.regexp_like(before, F.lit(f"(?:^|[^a-z])(?:{words})")).cast("int") for words in CONTEXT.values()]
    return [F.lit(kind), count("[0-9]"), F.length(match), count(" "), count("-"), count("[.]"), count(r"[()\[\]]"), valid.cast("int"), *context]


def _candidate(kind: int, name: str):
    def one(m, i):
        piece = F.get("__p", i)
        before = F.lower(F.substr(piece, F.greatest(F.length(piece) - BEFORE + 1, F.lit(1)), F.lit(BEFORE)))
        parts = [x.alias(f) for f, x in zip(FEATURES, features(kind, name, m, before), strict=True)]
        return F.struct(F.get("__s", i).alias("a"), (F.get("__s", i) + F.length(m)).alias("b"), *parts)

    return one


def proposals(rows: DataFrame) -> DataFrame:
    """``rows`` (with ``__text``) and ``__c``: the generators' candidates with their features."""
    columns = []
    for kind, (name, pattern) in enumerate(GENERATORS.items(), start=len(BASE)):
        there = F.col("__text").rlike("[(\\[] ?at ?[)\\]]" if name == "mail_words" else "[0-9]{3}" if name != "birth" else "(?:19|20)[0-9]{2}")
        rows = rows.withColumn("__m", F.when(there, F.regexp_extract_all("__text", F.lit(pattern), F.lit(0))).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn("__p", F.when(F.size("__m") > 0, F.split("__text", pattern, -1)).otherwise(F.array().cast("array<string>")))
        rows = rows.withColumn("__s", starts_of(F.col("__m"), F.col("__p")))

        shape = "array<struct<a:int,b:int," + ",".join(f"{f}:int" for f in FEATURES) + ">>"
        rows = rows.withColumn(f"__c_{name}", F.when(F.size("__m") > 0, F.transform("__m", _candidate(kind, name)).cast(shape)).otherwise(F.array().cast(shape))).drop("__m", "__p", "__s")
        columns.append(f"__c_{name}")
    return rows.withColumn("__c", F.concat(*columns)).drop(*columns)


# ---------------------------------------------------------------- boosted trees


@dataclass(frozen=True)
class Trees:
    """Trees as nested (feature, cut, low, high) or leaf values; a candidate's sum against ``threshold``."""

    start: float
    trees: tuple
    threshold: float

    def column(self, x: Column) -> Column:
        def node(t) -> Column:
            if isinstance(t, float):
                return F.lit(t)
            return F.when(x[FEATURES[t[0]]] <= t[1], node(t[2])).otherwise(node(t[3]))

        return functools.reduce(lambda a, b: a + b, [node(t) for t in self.trees], F.lit(self.start))

    def margins(self, x: np.ndarray) -> np.ndarray:
        """The sums of all rows of a feature matrix."""

        def node(t, rows: np.ndarray, out: np.ndarray) -> None:
            if isinstance(t, float):
                out[rows] += t
            else:
                low = x[rows, t[0]] <= t[1]
                node(t[2], rows[low], out)
                node(t[3], rows[~low], out)

        out = np.full(len(x), self.start)
        for t in self.trees:
            node(t, np.arange(len(x)), out)
        return out


def grow(x: np.ndarray, gradient: np.ndarray, curve: np.ndarray, depth: int):
    """A tree that splits where the second-order gain is largest; leaves are shrunk Newton steps."""
    total, weight = gradient.sum(), curve.sum()
    best = (1e-6, None, None)
    if depth:
        for f in range(x.shape[1]):
            for cut in np.unique(x[:, f])[:-1]:
                low = x[:, f] <= cut
                g, h = gradient[low].sum(), curve[low].sum()
                gain = g * g / (h + 1) + (total - g) ** 2 / (weight - h + 1) - total * total / (weight + 1)
                if gain > best[0]:
                    best = (gain, f, int(cut))
    if best[1] is None:
        return float(round(-RATE * total / (weight + 1), 6))
    low = x[:, best[1]] <= best[2]
    return (best[1], best[2], grow(x[low], gradient[low], curve[low], depth - 1), grow(x[~low], gradient[~low], curve[~low], depth - 1))


def boost(x: np.ndarray, y: np.ndarray, other_x: np.ndarray, other_y: np.ndarray) -> Trees:
    """Logistic boosting on (x, y); the threshold is the least that gives PRECISION on the other rows."""
    start = float(np.log(y.mean() / (1 - y.mean())))
    margin, trees = np.full(len(x), start), []
    for _ in range(ROUNDS):
        p = 1 / (1 + np.exp(-margin))
        tree = grow(x, p - y, p * (1 - p), DEPTH)
        trees.append(tree)
        margin += Trees(0.0, (tree,), 0.0).margins(x)
    held = Trees(start, tuple(trees), 0.0).margins(other_x)
    threshold = min((float(t) for t in np.unique(held) if other_y[held >= t].mean() >= PRECISION and t >= 0), default=float(held.max()))
    return Trees(start, tuple(trees), threshold - 1e-9)


def _makers(rng: np.random.Generator):
    """Random choices, digits and account numbers."""
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    num = lambda k: "".join(str(int(d)) for d in rng.integers(0, 10, k))

    def account(country: str, size: int, good: bool) -> str:
        body = num(size)
        rest = int(body + "".join(str(ord(c) - 55) for c in country) + "00") % 97
        check = f"{98 - rest:02d}" if good else f"{(98 - rest + int(rng.integers(1, 90))) % 97 + 2:02d}"
        plain = country + check + body
        return plain if rng.random() < 0.5 else " ".join(plain[i : i + 4] for i in range(0, len(plain), 4))

    return pick, num, account


def labelled_lines(n: int, seed: int = 11, told: float = 1.0) -> list[tuple[str, int]]:
    """Lines with one candidate each and whether it is personal data, made by rule; the words before it tell in a share ``told``."""
    rng = np.random.default_rng(seed)
    pick, num, account = _makers(rng)
    phone = lambda: pick(["({}) {}-{}", "{}-{}-{}", "{}.{}.{}", "{} {} {}"]).format(str(int(rng.integers(200, 999))), num(3), num(4))
    birth = lambda: pick(["{d:02d}.{m:02d}.{y}", "{m:02d}/{d:02d}/{y}", "{y}-{m:02d}-{d:02d}"]).format(d=int(rng.integers(1, 13)), m=int(rng.integers(1, 13)), y=int(rng.integers(1930, 2024)))
    mail = lambda: f"{pick(['ann', 'joe.doe', 'info', 'x.y'])}{num(2)} {pick(['(at)', '[at]'])} {pick(['mail', 'example', 'home'])}{num(1)} {pick(['(dot)', '[dot]'])} {pick(['com', 'org', 'net'])}"
    social = lambda: f"{int(rng.integers(100, 665))}-{int(rng.integers(10, 99))}-{int(rng.integers(1000, 9999))}"
    good = [(["phone ", "tel: ", "call ", "mobile ", "cell: ", "fax ", "tel no. "], phone), (["ssn ", "ssn: ", "social security ", "tax id ", "tax no. ", "his "], social), (["iban ", "bank ", "account ", "bank no. ", "pay to ", ""], lambda: account("DE", 18, True)), (["born ", "dob: ", "birthday ", "date of birth "], birth), (["mail ", "contact ", "write to ", "", "ask "], mail)]
    bad = [(["order ", "invoice ", "ref ", "serial ", "model ", "item "], phone), (["order ", "part ", "sku ", "serial ", "model "], social), (["code ", "serial ", "", "build ", "item "], lambda: account("DE", 18, False)), (["since ", "updated ", "published ", "on ", "", "page "], birth), (["order ", "part "], lambda: f"000-{num(2)}-{num(4)}")]
    filler = ["thond ", "and ering the ", "que la ", "von der ", "stable ", ""]
    vague = ["with ", "of ", "now ", "thus ", "near the ", "de "]
    out = []
    for k in range(n):
        leads, make = pick(good if k % 2 else bad)
        luck = rng.random()
        # of the others most have no listed word, a tenth one that belongs to something else
        lead = pick(leads) if luck < told else pick(vague) if luck < 1 - (1 - told) / 10 else pick(pick(bad if k % 2 else good)[0])
        out.append((pick(filler) + lead + make() + pick([".", ",", " " + pick(filler)]), k % 2))
    return out


def calibration_lines(n: int, seed: int = 12) -> list[tuple[str, int]]:
    """Lines of another rule than ``labelled_lines``: other sentences, formats and look-alikes."""
    rng = np.random.default_rng(seed)
    pick, num, account = _makers(rng)
    area = lambda: str(int(rng.integers(201, 990)))
    phone = lambda: pick(["({}){}-{}", "{}-{}-{}", "{} {}-{}"]).format(area(), num(3), num(4))
    day = lambda a, b: pick(["{d}.{m}.{y}", "{d}/{m}/{y}", "{y}-{m:02d}-{d:02d}"]).format(d=int(rng.integers(1, 29)), m=int(rng.integers(1, 13)), y=int(rng.integers(a, b)))
    mail = lambda: f"{pick(['maria', 'k.brown', 'sales', 'tom-w'])}{pick(['(at)', ' [at] ', ' (at)'])}{pick(['post', 'inbox', 'firm'])}{pick(['.', '[dot]', ' (dot) '])}{pick(['de', 'fr', 'io'])}"
    social = lambda: f"{int(rng.integers(100, 665)):03d}-{int(rng.integers(10, 99))}-{int(rng.integers(1000, 9999))}"
    good = [
        (["You can always reach me on ", "My new handset has the number ", "Text us under ", "The reception picks up at ", "Please ring "], phone), (["Her social insurance number reads ", "He gave the officer ", "As taxpayer she uses "], social),
        (["Kindly wire the rent to ", "We refund it to ", "Deposits go to "], lambda: account(*pick([("FR", 23), ("GB", 18), ("ES", 20)]), True)), (["She came into the world on ", "The applicant, born on ", "He celebrates his birthday, "], lambda: day(1930, 2010)), (["Drop a note to ", "Questions go to ", "Mails reach her under "], mail),
    ]
    bad = [
        (["The parcel with code ", "Ticket ", "Our catalogue lists it as ", "Quote reference ", "The invoice bears "], phone), (["The spare has the order code ", "Batch ", "Shelf ", "see sheet "], social),
        (["A random string such as ", "The licence plate roll ", "Batch "], lambda: account(*pick([("FR", 23), ("GB", 18)]), False)), (["The museum opened on ", "Last updated ", "The treaty of ", "Minutes of the meeting, ", "valid until "], lambda: day(1950, 2030)),
    ]
    after = [" if you like.", ", as agreed.", ".", " today."]
    out = []
    for k in range(n):
        leads, make = pick(good if k % 2 else bad)
        out.append((pick(["", "Dear all. ", "Note: "]) + pick(leads) + make() + pick(after), k % 2))
    return out


_fitted: list[Trees] = []


def _fitted_rows(spark: SparkSession, lines: list[tuple[str, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Features and labels of the lines' candidates, by the same expressions that texts get."""
    held = [{"t": t, "y": y, "k": k} for k, (t, y) in enumerate(lines)]
    rows = spark.range(1).select(F.explode(F.from_json(F.lit(json.dumps(held)), "array<struct<t:string,y:int,k:int>>")).alias("r")).select(F.col("r.t").alias("__text"), "r.y", "r.k")
    got = proposals(rows).select("k", "y", F.explode("__c").alias("c")).select("k", "y", *[f"c.{f}" for f in FEATURES]).collect()
    data = np.array(sorted(tuple(r) for r in got), float)
    return data[:, 2:], data[:, 1]


def trained(spark: SparkSession) -> Trees:
    """The trees, fitted once in a driver process."""
    if not _fitted:
        _fitted.append(boost(*_fitted_rows(spark, labelled_lines(TRAIN, told=0.5)), *_fitted_rows(spark, calibration_lines(CALIBRATE))))
    return _fitted[0]


def _of_kind(name: str, kind: int) -> Column:
    return F.transform(f"__{name}", lambda s: F.struct(F.lit(kind).alias("k"), s["a"].alias("a"), s["b"].alias("b")))


def find(docs: DataFrame, trees: Trees | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id, kinds, starts, ends`` (arrays by kind, then start; kinds are numbers into KINDS) for every row."""
    trees = trees or trained(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("__id"), F.coalesce(F.col(text_col), F.lit("")).alias("__text"))
    rows = proposals(base_columns(rows))
    base = F.concat(*[_of_kind(k, n) for n, k in enumerate(BASE)])
    rows = rows.withColumn("__base", base)
    apart = lambda c: ~F.exists("__base", lambda s: (s["a"] < c["b"]) & (c["a"] < s["b"]))
    chosen = F.filter("__c", lambda c: (trees.column(c) >= trees.threshold) & apart(c))
    added = F.when(F.size("__c") > 0, F.transform(chosen, lambda c: F.struct(c["kind"].alias("k"), c["a"], c["b"]))).otherwise(F.array().cast("array<struct<k:int,a:int,b:int>>"))
    rows = rows.select("__id", F.concat("__base", added).alias("__all"))
    return rows.select(F.col("__id").alias(id_col), *[F.col("__all")[f].alias(n) for f, n in (("k", "kinds"), ("a", "starts"), ("b", "ends"))])
