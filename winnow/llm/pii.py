"""Personal data: generous generators, boosted trees, calibrated thresholds.

Generators propose spans, overlapping ones too: the four kinds of the contract
by their exact rules, and looser ones for addresses that are spelt out, numbers
with a separator or without a country code, identity numbers, account numbers
and longer network addresses.  Each candidate gets features of its format
(length, digits, groups, separators, checksum) and its context (what stands
beside it, and the words shortly before it).  Boosted trees, trained here on a
labelled table that is made from templates, give a score; Platt scaling on held-out rows
turns it into a probability, and each kind has the least threshold at which
its held-out precision is TARGET.  Spans of the contract's kinds stay whatever
their score; the method adds the others that pass and overlap none.

Defined results: a null text is empty and has no spans.  Offsets are code
points, end exclusive.  Repeated rows have equal spans; an empty table gives no
rows.  Only doc_id and text are read.
"""

from __future__ import annotations

import hashlib
import random
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common
from winnow.llm import textscan as ts
from winnow.llm.boosting import Boosted

BASE = ["email", "ip", "card", "phone"]
MORE = ["spelt_email", "loose_phone", "identity", "account", "ipv6", "loose_card"]
KINDS = BASE + MORE
TARGET = 0.98
SEED = 11

# The contract's patterns, written so that no text takes more than linear time.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# looser ones
_SPELT = re.compile(
    r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}(?:\x20?(?:\(at\)|\[at\])\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\(dot\)|\[dot\])\x20?[A-Za-z]{2,24}|\x20dot\x20[A-Za-z]{2,24}|\.[A-Za-z]{2,24})"
    r"|\x20at\x20[A-Za-z0-9-]{1,63}(?:\x20dot\x20|\x20?\(dot\)\x20?|\x20?\[dot\]\x20?)[A-Za-z]{2,24})(?![A-Za-z])"
)
_LOOSE_PHONE = re.compile(r"(?<![0-9A-Za-z+.-])\(?[0-9]{2,4}\)?(?:[\x20./-][0-9]{2,5}){2,5}(?![0-9A-Za-z])")
_IDENTITY = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
_ACCOUNT = re.compile(r"\b[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){3,7}(?:\x20?[A-Z0-9]{1,3})?\b")
_IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){2,7}:?(?:[0-9A-Fa-f]{1,4}:){0,5}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")
_SPELT_CUE = re.compile(r"\x20dot\x20|[(\[](?:dot|at)[)\]]")
CUES = {
    "email": re.compile(r"mail|contact|write|reach", re.I), "phone": re.compile(r"phone|tel|call|fax|mobile|cell|whatsapp|dial", re.I),
    "card": re.compile(r"card|visa|master|credit|debit|pay|amex", re.I), "ip": re.compile(r"\bip\b|address|host|server|login", re.I),
    "identity": re.compile(r"ssn|social|identity|passport|tax|insurance", re.I), "account": re.compile(r"iban|account|bank|transfer|bic", re.I),
    "other": re.compile(r"order|invoice|version|isbn|part|page|serial|item|score|date|ratio|chapter|section|total|ref|fig|table|v\.", re.I),
}
_BEFORE = 32


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if k % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of the contract's address pattern: at each @, the run before it and the domain after it."""
    out, last, p = [], 0, text.find("@")
    while p >= 0:
        m = _DOMAIN.match(text, p + 1)
        if m:
            i = p
            while i > last and text[i - 1] in _LOCAL:
                i -= 1
            if i < p:
                out.append((i, m.end()))
                last = m.end()
        p = text.find("@", p + 1)
    return out


def base_spans(text: str, digits: bool = True) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the contract's kinds, by kind, then start."""
    out = [(0, s, e) for s, e in emails(text)] if "@" in text else []
    if digits:
        out += [(1, m.start(), m.end()) for m in _IP.finditer(text) if all(len(x.lstrip("0")) <= 3 and int(x.lstrip("0") or 0) <= 255 for x in m[0].split("."))]
        for m in _CARD.finditer(text):
            if m.end() - m.start() >= 13:
                d = _digits(m[0])
                if 13 <= len(d) <= 19 and luhn(d):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            out += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_digits(m[0])) <= 15]
    return out


def more_candidates(text: str, digits: bool = True) -> list[tuple[int, int, int]]:
    """Spans that the looser generators propose; they may overlap one another.
    Without digits only spelt addresses are possible."""
    out = [(4, m.start(), m.end()) for m in _SPELT.finditer(text)] if _SPELT_CUE.search(text) else []
    if not digits:
        return out
    for k, p in ((5, _LOOSE_PHONE), (6, _IDENTITY), (7, _ACCOUNT), (8, _IPV6)):
        out += [(k, m.start(), m.end()) for m in p.finditer(text)]
    out += [(9, m.start(), m.end()) for m in _CARD.finditer(text) if 13 <= len(_digits(m[0])) <= 19]
    return out


def features(text: str, kind: int, start: int, end: int) -> list[float]:
    s = text[start:end]
    d = _digits(s)
    before, after = text[max(0, start - _BEFORE) : start], text[end : end + 1]
    groups = re.findall(r"[0-9A-Za-z]+", s)
    seps = [c for c in s if not c.isalnum()]
    near = {k: float(bool(p.search(before))) for k, p in CUES.items()}
    year = any(len(g) == 4 and g[:2] in ("19", "20") for g in groups)
    return [
        *(float(kind == k) for k in range(len(KINDS))), len(s), len(d), len(d) / max(1, len(s)), len(groups), max(map(len, groups), default=0), min(map(len, groups), default=0),
        len(set(seps)), float(" " in seps), float("-" in seps), float("." in seps), float("/" in seps), float("(" in seps), float(13 <= len(d) <= 19 and luhn(d)), float(year),
        float(before[-1:].isalnum()), float(after.isalnum()), float(before[-1:] in tuple("$€£#/=") and before != ""), float(after in ("%", "€", "/") and after != ""), *near.values(), len(set(d)),
    ]


# ------------------------------------------------------------ the labelled table


def labelled(n: int = 4000, seed: int = SEED) -> list[tuple[str, bool, int]]:
    """(text, whether its number or address is personal, where it starts), from templates."""
    r = random.Random(seed)
    dig = lambda k: "".join(r.choices("0123456789", k=k))
    word = lambda: "".join(r.choices("aeioubdfgklmnprst", k=r.randint(2, 9)))

    def card(ok: bool) -> str:
        d = "4" + dig(14)
        d += next(c for c in "0123456789" if luhn(d + c) == ok)
        return " ".join(d[i : i + 4] for i in range(0, 16, 4)) if r.random() < 0.5 else d

    sep = lambda: r.choice(" -.")
    personal = [
        lambda: (r.choice(["call me ", "phone: ", "tel. ", "mobile ", "fax ", ""]), f"({dig(3)}) {dig(3)}-{dig(4)}"), lambda: (r.choice(["call ", "tel ", "my cell is "]), (s := sep()).join([dig(3), dig(3), dig(4)])),
        lambda: (r.choice(["ssn ", "social security ", "identity no. "]), f"{dig(3)}-{dig(2)}-{dig(4)}"), lambda: (r.choice(["mail ", "write to ", "contact ", ""]), f"{word()}.{word()}{r.choice([' at ', ' (at) ', ' [at] '])}{word()}{r.choice([' dot ', ' (dot) '])}{r.choice(['com', 'org', 'net'])}"),
        lambda: (r.choice(["iban ", "account ", ""]), f"{r.choice(['DE', 'FR', 'ES'])}{dig(2)} {dig(4)} {dig(4)} {dig(4)} {dig(4)}"), lambda: (r.choice(["from host ", "ip ", "server "]), ":".join("".join(r.choices("0123456789abcdef", k=4)) for _ in range(8))), lambda: (r.choice(["card ", "visa ", "paid by "]), card(True)),
    ]
    other = [
        lambda: (r.choice(["on ", "date ", ""]), f"{dig(2)}/{dig(2)}/20{dig(2)}"), lambda: (r.choice(["on ", "dated ", ""]), f"20{dig(2)}-{dig(2)}-{dig(2)}"), lambda: (r.choice(["isbn ", "part ", "serial "]), f"978-{dig(1)}{dig(1)}-{dig(4)}-{dig(3)}"), lambda: (r.choice(["order ", "invoice ", "ref "]), card(False)),
        lambda: (r.choice(["version ", "v. ", "section "]), f"{dig(2)}.{dig(2)}.{dig(2)}"), lambda: (r.choice(["scores ", "total ", "table "]), " ".join(dig(r.randint(2, 3)) for _ in range(r.randint(3, 5)))), lambda: (r.choice(["", "look "]), f"{word()} at {word()}. {word().title()}"), lambda: (r.choice(["ratio ", "time "]), f"{dig(2)}:{dig(2)}:{dig(2)}"), lambda: (r.choice(["item ", "serial ", "part "]), f"{dig(3)}-{dig(2)}-{dig(4)}"),
        lambda: (r.choice(["model ", "serial "]), f"AB{dig(2)} {dig(4)} {dig(4)} {dig(4)}"),
    ]
    out = []
    for k in range(n):
        ok = k % 2 == 0
        cue, body = r.choice(personal if ok else other)()
        lead = " ".join(word() for _ in range(r.randint(0, 6)))
        head = f"{lead} {cue}".lstrip()
        out.append((f"{head}{body} {' '.join(word() for _ in range(r.randint(0, 5)))}".rstrip(), ok, len(head)))
    return out


def table_of(rows: list[tuple[str, bool, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Features, labels and kinds of all looser candidates in a labelled table."""
    x, y, kinds = [], [], []
    for text, ok, _ in rows:
        for k, s, e in more_candidates(text):
            x.append(features(text, k, s, e))
            y.append(ok)
            kinds.append(k)
    return np.array(x, float), np.array(y, float), np.array(kinds)


class Model:
    """Trees, the scale of their probabilities, and a threshold per kind."""

    def __init__(self) -> None:
        x, y, _ = table_of(labelled())
        self.trees = Boosted().fit(x, y)
        hx, hy, kinds = table_of(labelled(2000, SEED + 1))
        s = self.trees.score(hx)
        self.a, self.b = 1.0, 0.0
        for _ in range(300):  # Platt scaling by gradient steps
            e = 1 / (1 + np.exp(-(self.a * s + self.b))) - hy
            self.a -= 0.05 * float((e * s).mean())
            self.b -= 0.05 * float(e.mean())
        p = self.probability(hx)
        self.threshold = {}
        for k in range(len(BASE), len(KINDS)):
            on = kinds == k
            good = [t for t in np.linspace(0.5, 0.99, 50) if (sel := on & (p >= t)).sum() >= 5 and hy[sel].mean() >= TARGET]
            self.threshold[k] = min(good, default=2.0)

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.a * self.trees.score(x) + self.b)))


@lru_cache(1)
def model() -> Model:
    return Model()


def spans_of(text: str, m: Model, digits: bool = True) -> list[tuple[int, int, int]]:
    """All (kind, start, end), by kind, then start."""
    base = base_spans(text, digits)
    cand = [c for c in more_candidates(text, digits) if not any(c[1] < e and s < c[2] for _, s, e in base)]
    if not cand:
        return base
    p = m.probability(np.array([features(text, *c) for c in cand], float))
    taken: list[tuple[int, int, int]] = []
    for i in np.argsort(-p, kind="stable"):
        k, s, e = cand[i]
        if p[i] >= m.threshold[k] and not any(s < b and a < e for _, a, b in taken):
            taken.append(cand[i])
    return sorted([*base, *taken])


_DIGIT = np.zeros(256, bool)
_DIGIT[0x30:0x3A] = True
_AT = np.zeros(256, bool)
_AT[0x40] = True
_SPELT_AT = re.compile(rb"\x20dot\x20|[(\[](?:dot|at)[)\]]")


def _scan(batches: Iterator[pa.RecordBatch], m: Model) -> Iterator[pa.RecordBatch]:
    nothing = hashlib.sha256(b"").hexdigest()
    for b in batches:
        counts = {k: [] for k in BASE}
        digests, spans = [], []
        for c in ts.chunks(b):
            n_digits, n_at = ts.per_row(_DIGIT[c.data], c.border), ts.per_row(_AT[c.data], c.border)
            for i in range(c.n):
                found = []
                raw = None
                if n_digits[i] < 4 and not n_at[i]:  # only a spelt address is possible
                    raw = c.data[c.border[i] : c.border[i + 1]].tobytes()
                    if not _SPELT_AT.search(raw):
                        raw = None
                else:
                    raw = c.data[c.border[i] : c.border[i + 1]].tobytes()
                if raw is not None:
                    found = spans_of(raw.decode("utf-8", "replace"), m, bool(n_digits[i] >= 4))
                for k, name in enumerate(BASE):
                    counts[name].append(sum(x[0] == k for x in found))
                text = [f"{KINDS[k]}:{s}:{e}" for k, s, e in found]
                base = ",".join(x for x, f in zip(text, found, strict=True) if f[0] < len(BASE))
                digests.append(hashlib.sha256(base.encode()).hexdigest() if base else nothing)
                spans.append(",".join(text))
        if spans:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), **{f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()}, "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string())})


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 and spans (kind:start:end,
    by kind as in KINDS, then start, comma-joined) of every whole text."""
    d = common.pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(model())  # trained once; a few kB
    return d.mapInArrow(lambda it: _scan(it, sent.value), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, {', '.join(f'n_{k} long' for k in BASE)}, base_sha256 string, spans string")
