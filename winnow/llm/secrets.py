"""Secret scans by one combined deterministic automaton.

Every rule is a regular expression over bytes.  All of them together become a
nondeterministic automaton, by subset construction a deterministic one, and by
partition refinement the smallest: two arrays, the class of each byte and the
next state by state and class, and a third with the rules that end in a state.
The automaton looks for all rules at every position at once, so a text is read
once, byte by byte, whatever the number of rules.

The pass runs over many texts side by side: each text is a lane, and a step
advances all lanes by one byte with two array look-ups.  Texts in which no
rule ends, nearly all, are done.  In the others the spans of each rule come
from its own deterministic automaton, leftmost and longest, from the places where the
rule can start; where many of these fail, an automaton of the rule read backwards
tells in one pass at which a match does start, so no text takes more than a few
passes.

Defined results: a null text is empty and has no spans.  Spans are code point
offsets, end exclusive; spans of a kind don't overlap, those of two kinds may.
Repeated rows have equal spans; an empty table gives no rows.  Only doc_id and
text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common
from winnow.llm import textscan as ts

# ------------------------------------------------------------ expressions to automata
# A small syntax: literals, [classes], \x20, ( | ), ?, *, +, {n}, {n,}; (?i: ...) folds A-Z.


class _Parser:
    """Builds the nondeterministic automaton: out[state] = [(set of bytes, state)], eps[state] = [state]."""

    def __init__(self) -> None:
        self.out: list[list[tuple[frozenset, int]]] = []
        self.eps: list[list[int]] = []

    def state(self) -> int:
        self.out.append([])
        self.eps.append([])
        return len(self.out) - 1

    def rule(self, pattern: str) -> tuple[int, int]:
        self.p, self.i, self.fold = pattern, 0, False
        a, b = self.alternatives()
        if self.i != len(self.p):
            raise ValueError(f"can't read {pattern!r} at {self.i}")
        return a, b

    def turn(self) -> None:
        """Every edge the other way round."""
        out, eps = [[] for _ in self.out], [[] for _ in self.eps]
        for s, edges in enumerate(self.out):
            for chars, t in edges:
                out[t].append((chars, s))
        for s, to in enumerate(self.eps):
            for t in to:
                eps[t].append(s)
        self.out, self.eps = out, eps

    def peek(self) -> str:
        return self.p[self.i] if self.i < len(self.p) else ""

    def alternatives(self) -> tuple[int, int]:
        a, b = self.state(), self.state()
        while True:
            x, y = self.sequence()
            self.eps[a].append(x)
            self.eps[y].append(b)
            if self.peek() != "|":
                return a, b
            self.i += 1

    def sequence(self) -> tuple[int, int]:
        a = b = self.state()
        while self.peek() not in ("", "|", ")"):
            begin, was = self.i, self.fold
            x, y = self.atom()
            end = self.i
            low, high = self.count()
            after = self.i
            for k in range(max(low, 1 if high is None or high > 0 else 0)):
                if k:  # one more copy of the same atom
                    self.i, self.fold = begin, was
                    x, y = self.atom()
                    self.i = end
                self.eps[b].append(x)
                if low == 0:
                    self.eps[b].append(y)
                if high is None and k == max(low, 1) - 1:
                    self.eps[y].append(x)
                b = y
            self.i = after
        return a, b

    def count(self) -> tuple[int, int | None]:
        c = self.peek()
        if c in "?*+" and c:
            self.i += 1
            return (0, 1) if c == "?" else (0, None) if c == "*" else (1, None)
        if c == "{":
            end = self.p.index("}", self.i)
            low, comma, _ = self.p[self.i + 1 : end].partition(",")
            self.i = end + 1
            return int(low), None if comma else int(low)
        return 1, 1

    def atom(self) -> tuple[int, int]:
        if self.peek() == "(":
            was = self.fold
            self.i += 1
            if self.p.startswith("?i:", self.i):
                self.fold = True
                self.i += 3
            a, b = self.alternatives()
            self.i += 1
            self.fold = was
            return a, b
        a, b = self.state(), self.state()
        self.out[a].append((frozenset(self.members()), b))
        return a, b

    def one(self) -> int:
        c = self.p[self.i]
        self.i += 1
        if c == "\\":
            c = self.p[self.i]
            self.i += 1
            if c == "x":
                self.i += 2
                return int(self.p[self.i - 2 : self.i], 16)
        return ord(c)

    def members(self) -> set[int]:
        if self.peek() == "[":
            self.i += 1
            got: set[int] = set()
            while self.peek() != "]":
                lo = self.one()
                if self.peek() == "-" and self.p[self.i + 1] != "]":
                    self.i += 1
                    got |= set(range(lo, self.one() + 1))
                else:
                    got.add(lo)
            self.i += 1
        else:
            got = {self.one()}
        if self.fold:
            got |= {x ^ 32 for x in got if chr(x).isascii() and chr(x).isalpha()}
        return got


class Automaton:
    """classes[byte], next[state, class] and accepts[state] (a bit per rule); the start state is 0.

    search: a match may start at any byte, else only at the first; backwards: it
    reads from the end of a match to its start; dead is the state that nothing
    leaves (-1: none).
    """

    def __init__(self, patterns: list[str], search: bool, backwards: bool = False) -> None:
        nfa = _Parser()
        ends, roots = {}, []
        for k, p in enumerate(patterns):
            a, b = nfa.rule(p)
            a, b = (b, a) if backwards else (a, b)
            roots.append(a)
            ends[b] = k
        if backwards:
            nfa.turn()

        def closed(states) -> frozenset:
            todo, got = list(states), set(states)
            while todo:
                for x in nfa.eps[todo.pop()]:
                    if x not in got:
                        got.add(x)
                        todo.append(x)
            return frozenset(got)

        # bytes that no rule tells apart are one class
        sets = list(dict.fromkeys(s for edges in nfa.out for s, _ in edges))
        kinds: dict[tuple, int] = {}
        self.classes = np.zeros(256, np.uint8)
        sample: list[int] = []
        for byte in range(256):
            key = tuple(byte in s for s in sets)
            if key not in kinds:
                kinds[key] = len(kinds)
                sample.append(byte)
            self.classes[byte] = kinds[key]
        root = closed(roots)
        number, order, rows = {root: 0}, [root], []
        for subset in order:
            row = []
            for byte in sample:
                moved = {t for s in subset for chars, t in nfa.out[s] if byte in chars}
                to = closed(moved | set(root)) if search else closed(moved)
                if to not in number:
                    number[to] = len(order)
                    order.append(to)
                row.append(number[to])
            rows.append(row)
        nxt = np.array(rows, np.int32)
        acc = np.array([sum(1 << ends[s] for s in subset if s in ends) for subset in order], np.int64)
        # minimise: split blocks until their members agree on all moves
        _, block = np.unique(acc, return_inverse=True)
        while True:
            _, finer = np.unique(np.column_stack([block, block[nxt]]), axis=0, return_inverse=True)
            finer = finer.ravel()
            if finer.max() == block.max():
                break
            block = finer
        first = np.array([int(np.argmax(block == b)) for b in range(block.max() + 1)])
        rename = np.argsort(np.argsort(np.where(np.arange(len(first)) == block[0], -1, np.arange(len(first)))))
        keep = first[np.argsort(rename)]
        self.next = rename[block[nxt[keep]]].astype(np.int32)
        self.accepts = acc[keep]
        alone = [s for s in range(len(keep)) if not self.accepts[s] and (self.next[s] == s).all()]
        self.dead = alone[0] if alone else -1

    def ends(self, data: np.ndarray, border: np.ndarray) -> np.ndarray:
        """The rules that end somewhere in each row (a bit per rule)."""
        n = np.diff(border)
        out = np.zeros(len(n), np.int64)
        order = np.argsort(-n, kind="stable")
        order = order[n[order] > 0]
        width = self.next.shape[1]
        flat = (self.next.astype(np.int32) * width).ravel()
        marks = np.zeros(len(flat), bool)
        marks[:: width] = self.accepts > 0
        code = self.classes[data].astype(np.int32)
        at, size = border[:-1][order], n[order]
        state = np.zeros(len(order), np.int32)
        step, live = 0, len(order)
        while live:
            stop = int(size[live - 1])  # all lanes that live go on to here
            while step < stop:
                state = flat[state + code[at[:live] + step]]
                hit = marks[state]
                if hit.any():
                    who = np.flatnonzero(hit)
                    out[order[who]] |= self.accepts[state[who] // width]
                step += 1
            live = int(np.searchsorted(-size, -step, "left"))
            state = state[:live]
        return out

    @property
    def table(self) -> tuple[list[list[int]], list[bool]]:
        """next by state and byte, as lists for one text at a time."""
        if not hasattr(self, "_table"):
            self._table = self.next[:, self.classes].tolist(), (self.accepts > 0).tolist()
        return self._table

    def longest(self, raw: bytes, i: int) -> tuple[int, int]:
        """The end of the longest match that starts at i, or -1, and the bytes read."""
        nxt, acc = self.table
        s, end, j = 0, -1, i - 1
        for j in range(i, len(raw)):
            s = nxt[s][raw[j]]
            if s == self.dead:
                break
            if acc[s]:
                end = j + 1
        return end, j - i + 1

    def before(self, raw: bytes) -> np.ndarray:
        """Of an automaton that reads backwards and searches: whether a match starts at each byte, from one pass."""
        nxt, acc = self.table
        out, s = bytearray(len(raw)), 0
        for j in range(len(raw) - 1, -1, -1):
            s = nxt[s][raw[j]]
            out[j] = acc[s]
        return np.frombuffer(out, np.uint8).astype(bool)

    def starts(self) -> np.ndarray:
        """The bytes that a match can start with."""
        return self.next[0, self.classes] != self.dead


#: The kinds of the contract, then those that the method adds.  kind; expression; and what the combined
#: automaton looks for, a shorter expression that every wanted match holds, so that the rules' counters don't multiply.
RULES = [
    ("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]"""),
    ("access", r"AKIA[A-Z0-9]+", r"AKIA[A-Z0-9]"),
    ("hex", r"[0-9a-f]+", r"[0-9a-f]{24}"),
    ("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    ("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\."),
    ("forge", r"(gh[pousr]_[A-Za-z0-9]{36}|glpat-[A-Za-z0-9_-]{20,})", r"(gh[pousr]_[A-Za-z0-9]|glpat-[A-Za-z0-9_-])"),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}", r"xox[abprs]-[A-Za-z0-9-]"),
    ("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]{16,}", r"(?i:bearer)\x20+[A-Za-z0-9._~+/=-]"),
]
KINDS = [r[0] for r in RULES]
#: A rule's starts are tried until so many times the text's bytes are read; then they are looked up.
TRIES = 4
BASE = KINDS[:3]


def _long_enough(kind: str, raw: bytes) -> bool:
    """The contract's drop rule for a base match."""
    if kind == "access":
        return len(raw) >= 20
    if kind == "hex":
        return len(raw) >= 24
    if kind == "assign":
        cut = min(i for i in (raw.find(b":"), raw.find(b"=")) if i >= 0)
        value = raw[cut + 1 :].lstrip(b" ")
        return len(value) - (value[:1] in (b'"', b"'")) >= 6
    return True


@lru_cache(1)
def automata() -> tuple[Automaton, list[Automaton], list[Automaton]]:
    """All rules together; each rule forwards from a start; each rule backwards, to find its starts."""
    return Automaton([r[2] for r in RULES], True), [Automaton([r[1]], False) for r in RULES], [Automaton([r[1]], True, True) for r in RULES]


def spans_of(raw: bytes, hit: int, each: list[Automaton], back: list[Automaton]) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, by start, of the rules that end somewhere in this text.

    Places where a rule may start are tried one by one; once the bytes read so exceed the text's a few times, one pass
    backwards tells where matches do start, so the work is in proportion to the text whatever it holds.
    """
    out = []
    data = np.frombuffer(raw, np.uint8)
    for k, one in enumerate(each):
        if not hit >> k & 1:
            continue
        end = 0
        begin = one.starts()[data]
        if KINDS[k] == "hex":  # a run is one match: only its first byte starts one
            begin[1:] &= ~begin[:-1].copy()
        places, read, sure = np.flatnonzero(begin), 0, False
        at = 0
        while at < len(places):
            i = int(places[at])
            at += 1
            if i < end:
                continue
            if read > TRIES * len(raw) and not sure:
                sure = True
                places, at = np.flatnonzero(back[k].before(raw)), 0
                places = places[places >= max(i, end)]
                continue
            e, n = one.longest(raw, i)
            read += n
            if e > i:
                end = e
                if _long_enough(KINDS[k], raw[i:e]):
                    out.append((i, k, e))
    return sorted(out)


def _scan(batches: Iterator[pa.RecordBatch], search: Automaton, each: list[Automaton], back: list[Automaton]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts = {k: [] for k in BASE}
        digests, spans = [], []
        nothing = hashlib.sha256(b"").hexdigest()
        for c in ts.chunks(b, limit=16 * ts.CHUNK_BYTES):
            hits = search.ends(c.data, c.border)
            for i, hit in enumerate(hits.tolist()):
                found = []
                if hit:
                    raw = c.data[c.border[i] : c.border[i + 1]].tobytes()
                    lead = np.concatenate([[0], np.cumsum((np.frombuffer(raw, np.uint8) & 0xC0) != 0x80)])
                    found = [(k, int(lead[s]), int(lead[e])) for s, k, e in spans_of(raw, hit, each, back)]
                for k, name in enumerate(BASE):
                    counts[name].append(sum(x[0] == k for x in found))
                text = [f"{KINDS[k]}:{s}:{e}" for k, s, e in found]
                base = ",".join(x for x, f in zip(text, found, strict=True) if f[0] < len(BASE))
                digests.append(hashlib.sha256(base.encode()).hexdigest() if base else nothing)
                spans.append(",".join(text))
        if spans:
            yield pa.RecordBatch.from_pydict({"doc_id": b.column("doc_id"), **{f"n_{k}": pa.array(v, pa.int64()) for k, v in counts.items()}, "base_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.string())})


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans (kind:start:end, by
    start, then kind as in RULES, comma-joined) of every whole text."""
    d = common.pick(docs, "doc_id", "text").withColumn("text", F.col("text").cast("string"))
    sent = docs.sparkSession.sparkContext.broadcast(automata())  # built once; some 200 kB
    return d.mapInArrow(lambda it: _scan(it, *sent.value), f"doc_id {d.schema['doc_id'].dataType.simpleString()}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string")
