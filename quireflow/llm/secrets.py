"""Secret scans: base patterns, plus a character convolutional network over further candidates.

Base findings come from three patterns. Every other token that could be a secret (long runs of key
characters with a digit or mixed case, key blocks, dotted tokens, passwords in addresses) is a
candidate; the network reads the candidate and some text before and after it, in overlapping windows from
its start to its end, and gives a calibrated probability; the largest of its windows is the candidate's.
The threshold is the largest that keeps ``RECALL`` of the secrets in a calibration set. Findings of
the network are added where they overlap no base finding; base findings always stay.

The network is numpy only and trained here, on labelled lines made by a fixed rule and seed
(``labelled_lines``: ``TRAIN`` lines, secrets and look-alikes), once for each process. Calibration and
threshold come from ``calibration_lines``, of another rule that shares no words, key formats or look-alikes with
the first, so they are measured on what the network was not fitted to.

Edge cases: null and empty texts give no finding; rows with null or repeated ids each give a row; an
empty table gives no rows; other columns are not read. Very long texts and candidates are scanned whole, patterns run in time
linear in the text. Findings that tie in their start stand in the order of their kinds; a candidate that
ties with the threshold is a finding.
"""

from __future__ import annotations

import base64
import bisect
import functools
import itertools
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("assign", "access", "hex", "model")
ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # maximal runs, as [0-9a-f]+ of 32 and more
MARKS = (":", "=")

_TOKEN = re.compile(r"[A-Za-z0-9+/_=.~-]{16,}")
_BLOCK = re.compile(r"-----BEGIN [A-Z ]{0,30}PRIVATE KEY-----")
_URL = re.compile(r"(?<=://)[A-Za-z0-9._~-]{1,64}:[A-Za-z0-9._~!$&*+%-]{6,}(?=@)")

#: Characters that a window holds before its start and from it on, of these after the candidate at most, and from
#: one window's start to the next; lines the network is trained and calibrated on.
BEFORE, INSIDE, AFTER, STEP = 20, 44, 8, 22
TRAIN, CALIBRATE, FILTERS, WIDTH, EPOCHS = 4000, 1200, 24, 5, 6
RECALL = 0.97
_V = 98  # printable ASCII, line end, other, and padding


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the base findings, by start and then kind."""
    found = []
    if any(m in text for m in MARKS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    found.sort()
    return found


_DIGIT, _UPPER, _LOW = re.compile("[0-9]"), re.compile("[A-Z]"), re.compile("[a-z]")


def candidates(text: str) -> list[tuple[int, int]]:
    """Spans that may be secrets."""
    found = []
    for m in _TOKEN.finditer(text):
        token = m[0]
        if _DIGIT.search(token) or _UPPER.search(token, m.end() - m.start() > 1 and 1 or 0) and _LOW.search(token):
            found.append((m.start(), m.end()))
    if "-----BEGIN" in text:
        found += [m.span() for m in _BLOCK.finditer(text)]
    if "://" in text:
        found += [m.span() for m in _URL.finditer(text)]
    return sorted(set(found))


_CODES = np.full(0x110000, 96, np.uint8)
_CODES[32:127] = np.arange(95)
_CODES[10] = 95


def window_starts(start: int, end: int) -> range:
    """Starts of the windows over a candidate; any run of ``STEP`` of its characters lies in one, and its end in the last."""
    return range(start, max(start, end + 1 - INSIDE) + STEP, STEP)


def window(text: str, start: int, end: int) -> np.ndarray:
    """What the network reads from a place in a candidate that goes to ``end``: the text before and from it on, padded."""
    out = np.full(BEFORE + INSIDE, 97, np.uint8)
    left = text[max(0, start - BEFORE) : start]
    inside = text[start : min(end + AFTER, start + INSIDE)]
    for piece, at in ((left, BEFORE - len(left)), (inside, BEFORE)):
        if piece:
            out[at : at + len(piece)] = _CODES[np.frombuffer(piece.encode("utf-32-le", "surrogatepass"), np.uint32)]
    return out


def labelled_lines(n: int, seed: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines with the spans of their secrets, made by rule: half hold a secret, half a look-alike."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    syllables = ["the", "an", "ing", "er", "tion", "ou", "re", "ent", "que", "os", "lich", "keit", "ment", "ve", "ar", "os", "st", "ble", "ó", "ü"]
    chars = lambda alphabet, low, high: "".join(pick(alphabet) for _ in range(int(rng.integers(low, high))))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every = upper + lower + digits
    word = lambda k=4: "".join(pick(syllables) for _ in range(int(rng.integers(1, k))))
    prose = lambda: " ".join(word() for _ in range(int(rng.integers(1, 8))))
    b64 = lambda k: base64.b64encode(rng.bytes(k)).decode()
    secrets = [
        lambda: chars(every, 20, 48), lambda: b64(int(rng.integers(18, 40))), lambda: rng.bytes(int(rng.integers(10, 32))).hex(), lambda: rng.bytes(16).hex().upper(),
        lambda: "ghp_" + chars(every, 36, 37), lambda: "sk-" + chars(every, 32, 48), lambda: "xoxb-" + chars(digits, 10, 12) + "-" + chars(every, 20, 24), lambda: "AKIA" + chars(upper + digits, 16, 17),
        lambda: "eyJ" + chars(every, 20, 40) + "." + chars(every, 20, 60) + "." + chars(every + "_-", 20, 43), lambda: "glpat-" + chars(every + "_", 20, 21), lambda: "-----BEGIN RSA PRIVATE KEY-----",
        lambda: chars(every + "_-", 60, 76),
    ]
    # what may stand before a secret, or before no secret, in one run of key characters
    host = lambda: f"//{pick(['www.', 'api.', 'hooks.', ''])}{word()}{word()}.{pick(['com', 'org', 'example.net'])}"
    spoken = lambda: "".join(pick("bcdfghjklmnprstvwy") + pick(["a", "e", "i", "o", "u", "ea", "oo"]) + pick(["", "", "n", "r", "s", "t", "th", "ng", "dge"]) for _ in range(int(rng.integers(1, 4))))
    slug = lambda: "-".join(pick([spoken, word])() for _ in range(int(rng.integers(3, 16))))
    date = lambda: f"{chars(digits, 4, 5)}/{chars(digits, 1, 3)}/{chars(digits, 1, 3)}"
    part = lambda: pick([word, spoken, lambda: word() + "-" + word(), lambda: word().capitalize() + "_" + word(), lambda: chars(digits, 1, 5), lambda: chars(digits, 17, 20), lambda: pick("vTB") + pick(digits), lambda: pick("TB") + chars(upper + digits, 8, 11)])()
    path = lambda low, high: "".join("/" + part() for _ in range(int(rng.integers(low, high))))
    names = lambda: "_".join(word(5).upper() for _ in range(int(rng.integers(3, 9))))
    deep = [lambda: host() + path(1, 6) + "/", lambda: path(3, 8) + "/", lambda: names() + "=", lambda: host() + path(1, 4) + "/" + word() + "="]
    before = ["key = ", "Authorization: Bearer ", "credential: ", "client_secret ", "aws_key ", "export KEY=", "auth ", "pass ", "", "", "signature=", "'"]
    alike = [
        lambda: "".join(word(6).capitalize() for _ in range(4)), lambda: "-".join(word() for _ in range(5)), lambda: chars(digits, 16, 20), lambda: f"{word(5)}{chars(digits, 2, 5)}@mail{pick(digits)}.example.com", lambda: f"{chars(digits, 4, 5)}-{chars(digits, 2, 3)}-{chars(digits, 2, 3)}T{chars(digits, 2, 3)}.{chars(digits, 6, 7)}",
        lambda: "." * int(rng.integers(16, 40)), lambda: "=" * int(rng.integers(16, 40)), lambda: "_".join(word() for _ in range(4)) + pick(digits), lambda: f"/{word()}/{word()}/{word()}-{pick(digits)}.{pick(digits)}", lambda: word(9) + "." + word(9).capitalize(), lambda: "www." + word(5) + word(5) + pick(digits) + ".example.org/" + word(5),
        lambda: (word(6) + word(6)).upper() + "." + word(4).capitalize(), lambda: f"{word()}-{word()}-v{pick(digits)}.{pick(digits)}.{pick(digits)}", lambda: word(8) + chars(digits, 1, 4) + word(8), lambda: (word(7) + word(7)).capitalize() + "-" + word(4).capitalize(),
        lambda: host() + path(1, 10) + pick(["", "/", ".html", ".jpg"]), lambda: path(3, 9), lambda: names() + "=" + word(8) + pick(["", "1", ".Txt"]), lambda: f"{host()}/{spoken()}/{date()}/{slug()}{pick(['', '.html', '/', '-' + chars(digits, 1, 9)])}", lambda: host() + path(1, 4) + "/" + slug() + pick(["", ".html", "-" + chars(digits, 1, 9)]), lambda: host() + path(1, 3) + "/" + "_".join(word().capitalize() for _ in range(6)),
    ]
    out = []
    for k in range(n):
        head, tail = prose() + pick([" ", " ", "\n", "\n", ". "]), pick(["", " ", "\n", "; "]) + prose()
        if k % 2:
            token, lead = pick(secrets)(), pick(before) if rng.random() < 0.7 else pick(deep)()
        else:
            token, lead = pick(alike)(), pick(["", "", "", "see ", "id ", "on ", "file ", "by ", "= "])
        start = len(head) + len(lead)
        out.append((head + lead + token + tail, [(start, start + len(token))] if k % 2 else []))
    return out


def calibration_lines(n: int, seed: int) -> list[tuple[str, list[tuple[int, int]]]]:
    """Lines of another rule than ``labelled_lines``: other words, key formats and look-alikes."""
    rng = np.random.default_rng(seed)
    pick = lambda xs: xs[int(rng.integers(len(xs)))]
    chars = lambda alphabet, k: "".join(pick(alphabet) for _ in range(k))
    upper, lower, digits = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz", "0123456789"
    every, words = upper + lower + digits, "please check that our build server found no problem with last night run before anyone else can merge it into main branch again tomorrow".split()
    prose = lambda: " ".join(pick(words) for _ in range(int(rng.integers(2, 9))))
    secrets = [
        lambda: "AIza" + chars(every + "_-", 35), lambda: "npm_" + chars(every, 36), lambda: "rk_live_" + chars(every, 24), lambda: "SG." + chars(every + "_-", 22) + "." + chars(every + "_-", 43), lambda: "SK" + rng.bytes(16).hex(),
        lambda: chars(every + "+/", 40), lambda: "ya29." + chars(every + "_-", 60), lambda: "dop_v1_" + rng.bytes(32).hex(), lambda: base64.b64encode(rng.bytes(32)).decode(), lambda: "shpat_" + rng.bytes(16).hex(),
    ]
    alike = [
        lambda: "-".join(pick(words) for _ in range(int(rng.integers(4, 9)))), lambda: "".join(pick(words).capitalize() for _ in range(4)), lambda: "_".join(pick(words) for _ in range(4)) + ".py", lambda: f"https://docs.{pick(words)}{pick(words)}.net/{pick(words)}/{pick(words)}.html",
        lambda: f"src/{pick(words)}/{pick(words)}/{pick(words).capitalize()}{pick(words).capitalize()}.java", lambda: f"20{chars('012', 2)}-0{chars('123456789', 1)}-1{chars('0123', 1)}T0{chars(digits, 1)}.3{chars(digits, 1)}.5{chars(digits, 1)}", lambda: f"{pick(words)}-{pick(words)}-{chars(digits, 1)}.{chars(digits, 2)}.{chars(digits, 1)}.tar.gz", lambda: chars(digits, int(rng.integers(16, 19))),
        lambda: "~" * int(rng.integers(16, 50)), lambda: f"{pick(words)}.{pick(words)}{chars(digits, 2)}.{pick(words)}.example", lambda: pick(words).upper() + "_" + pick(words).upper() + "_" + pick(words).upper() + "=" + pick(words),
    ]
    out = []
    for k in range(n):
        head = prose() + pick([" ", ", ", "\n"]) + (pick(["use ", "paste ", "header X-Auth ", "value ", ""]) if k % 2 else pick(["open ", "in ", "as ", ""]))
        token = pick(secrets if k % 2 else alike)()
        out.append((head + token + pick([" ", "\n", ", "]) + prose(), [(len(head), len(head) + len(token))] if k % 2 else []))
    return out


@dataclass(frozen=True)
class Network:
    tables: np.ndarray  # WIDTH x characters x filters
    bias: np.ndarray
    dense: np.ndarray
    offset: float
    slope: float
    shift: float
    threshold: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return _forward(self.tables, self.bias, self.dense, self.offset, x)[0]

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        out = [1 / (1 + np.exp(-np.clip(self.slope * self.logits(x[i : i + 256]) + self.shift, -40, 40))) for i in range(0, len(x), 256)]
        return np.concatenate(out) if out else np.zeros(0)


def _forward(tables, bias, dense, offset, x):
    steps = x.shape[1] - WIDTH + 1
    hidden = bias + sum(tables[k][x[:, k : k + steps]] for k in range(WIDTH))
    np.maximum(hidden, 0, out=hidden)
    at = hidden.argmax(1)
    pooled = np.concatenate([np.take_along_axis(hidden, at[:, None], 1)[:, 0], hidden[:, BEFORE - WIDTH + 1 :].mean(1)], 1)
    return pooled @ dense + offset, hidden, at, pooled


def _windows(lines: list[tuple[str, list[tuple[int, int]]]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of the lines' candidates, whether each is on a secret, and its candidate; those on a small part of a secret are left out."""
    x, y, owner, count = [], [], [], 0
    for text, spans in lines:
        for a, b in candidates(text):
            count += 1
            for at in window_starts(a, b):
                shared = max((min(at + INSIDE, b, e) - max(at, s) for s, e in spans), default=0)
                if shared <= 0 or shared >= min(16, b - a):
                    x.append(window(text, at, b))
                    y.append(shared > 0)
                    owner.append(count)
    return np.array(x), np.array(y, float), np.array(owner)


@functools.cache
def trained(seed: int = 5) -> Network:
    """The network, fitted with Adam on logistic loss, calibrated and given its threshold."""
    x, y, _ = _windows(labelled_lines(TRAIN, seed))
    rng = np.random.default_rng(seed)
    tables = rng.normal(0, 0.15, (WIDTH, _V, FILTERS)).astype(np.float32)
    bias, dense, offset = np.zeros(FILTERS, np.float32), rng.normal(0, 0.2, 2 * FILTERS).astype(np.float32), np.zeros(1, np.float32)
    params = [tables, bias, dense, offset]
    first, second, step = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params], 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for i in range(0, len(x), 64):
            b = order[i : i + 64]
            z, hidden, at, pooled = _forward(tables, bias, dense, offset[0], x[b])
            dz = ((1 / (1 + np.exp(-z)) - y[b]) / len(b)).astype(np.float32)
            dp = dz[:, None] * dense
            dh = np.zeros_like(hidden)
            np.put_along_axis(dh, at[:, None], dp[:, None, :FILTERS], 1)
            dh[:, BEFORE - WIDTH + 1 :] += dp[:, None, FILTERS:] / (hidden.shape[1] - BEFORE + WIDTH - 1)
            dh *= hidden > 0
            flat = dh.reshape(-1, FILTERS)
            dt = np.zeros_like(tables)
            for k in range(WIDTH):
                onehot = np.zeros((len(flat), _V), np.float32)
                onehot[np.arange(len(flat)), x[b][:, k : k + hidden.shape[1]].ravel()] = 1
                dt[k] = onehot.T @ flat
            step += 1
            for p, g, m, v in zip(params, [dt, flat.sum(0), pooled.T @ dz, dz.sum(keepdims=True)], first, second, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= 0.01 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    other_x, other_y, owner = _windows(calibration_lines(CALIBRATE, seed + 1))
    z = _forward(tables, bias, dense, offset[0], other_x)[0].astype(float)
    slope, shift = 1.0, 0.0
    for _ in range(400):  # logistic calibration by gradient steps
        p = 1 / (1 + np.exp(-(slope * z + shift)))
        slope -= 0.05 * float(((p - other_y) * z).mean() + 1e-3 * (slope - 1))
        shift -= 0.05 * float((p - other_y).mean())
    p = 1 / (1 + np.exp(-(slope * z + shift)))
    starts = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))  # a candidate's probability is its best window's
    best, secret = np.maximum.reduceat(p, starts), np.maximum.reduceat(other_y, starts) > 0
    threshold = float(np.quantile(best[secret], 1 - RECALL, method="lower")) - 1e-9
    return Network(tables, bias, dense, float(offset[0]), slope, shift, threshold)


def scan(docs: DataFrame, network: Network | None = None, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """``id, starts, kinds, ends, scores`` (arrays in the order of starts, then kinds) for every row.

    Kinds are numbers into ``KINDS``; the score of a base finding is 1. No shuffle. ``keep`` names
    further columns to carry along, among them ``text`` when it is wanted.
    """
    model = network or trained()

    def work(part: pa.RecordBatch) -> Iterator[dict]:
        texts = common.texts_of(part, "__text")
        found, x, owner = [], [], []
        for i, text in enumerate(texts):
            base = base_spans(text)
            found.append([(s, k, e, 1.0) for s, k, e in base])
            starts, reach = [s for s, _, _ in base], list(itertools.accumulate((e for _, _, e in base), max))
            for a, b in candidates(text):
                before = bisect.bisect_left(starts, b)
                if not before or reach[before - 1] <= a:
                    owner.append((i, a, b, len(x)))
                    x += [window(text, at, b) for at in window_starts(a, b)]
        if x:
            best = np.maximum.reduceat(model.probabilities(np.array(x)), [first for *_, first in owner])
            for (i, a, b, _), p in zip(owner, best, strict=True):
                if p >= model.threshold:
                    found[i].append((a, 3, b, float(p)))
        for f in found:
            f.sort()
        yield {
            **{c: part.column(c) for c in part.schema.names if c != "__text"},
            "starts": [[f[0] for f in r] for r in found], "kinds": [[f[1] for f in r] for r in found], "ends": [[f[2] for f in r] for r in found], "scores": [[f[3] for f in r] for r in found],
        }

    rows = docs.select(F.col(id_col), *[F.col(c) for c in keep], F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("__text").schema) + ", starts array<int>, kinds array<int>, ends array<int>, scores array<double>"
    return common.map_texts(rows, work, schema, "__text")


def redacted(text, starts, ends, mark: str = "[SECRET]"):
    """A column: ``text`` with the spans (sorted by start, perhaps overlapping) replaced by ``mark``."""
    def step(acc, i):
        start, end = F.get(starts, i), F.get(ends, i)
        return F.struct(
            F.when(start >= acc["at"], F.concat(acc["out"], F.substr(text, acc["at"] + 1, start - acc["at"]), F.lit(mark))).otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], end).alias("at"),
        )

    places = F.when(F.size(starts) > 0, F.sequence(F.lit(0), F.size(starts) - 1)).otherwise(F.array().cast("array<int>"))
    done = F.aggregate(places, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda acc: F.concat(acc["out"], F.substr(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(starts) > 0, done).otherwise(text)
