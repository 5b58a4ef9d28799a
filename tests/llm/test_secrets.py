"""Automata against the regular expressions, spans against the contract."""

import random
import re

import numpy as np
import pytest

from made import DOCUMENTS, rows_of
from winnow.llm import secrets as S

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(t):
    t = t or ""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


@pytest.mark.parametrize("pattern", [r"a(b|cd)*e?", r"[a-c]{2,}x", r"(?i:ab)+[0-9]{3}", r"x?y{2}z"])
def test_automaton_is_the_expression(pattern):
    one = S.Automaton([pattern], False)
    search = S.Automaton([pattern], True)
    back = S.Automaton([pattern], True, True)
    rx = re.compile(pattern)
    r = random.Random(3)
    for _ in range(400):
        t = "".join(r.choices("abcdexyzAB019", k=r.randint(0, 12)))
        ends = [e for e in range(len(t) + 1) if rx.fullmatch(t, 0, e) and e]
        assert one.longest(t.encode(), 0)[0] == (max(ends) if ends else -1)
        hit = search.ends(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))[0]
        starts = [any(rx.fullmatch(t, a, b) for b in range(a + 1, len(t) + 1)) for a in range(len(t))]
        assert bool(hit) == any(starts)
        assert back.before(t.encode()).tolist() == starts


def test_spans(spark, odd_texts, rng):
    parts = list("toke n:=\"'AKIA0af9é_-.") + ["token", "Secret", "AKIA", "PASSWORD", "api_key", "apikey", "abcdef0123456789", "X7" * 9]
    texts = [*odd_texts, *("".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(800)), "token:secret:abcdefgh token: token: abcdefghij"]
    got = {r.doc_id: r for r in S.scan(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    for i, t in enumerate(texts):
        spans = [x.split(":") for x in got[i].spans.split(",") if x]
        mine = sorted((int(a), S.KINDS.index(k), int(b)) for k, a, b in spans if k in S.BASE)
        assert mine == base(t)
        assert (got[i].n_assign, got[i].n_access, got[i].n_hex) == tuple(sum(x[1] == k for x in mine) for k in range(3))


def test_added_kinds(spark):
    texts = ["see ghp_" + "a1B2" * 9 + " ok", "-----BEGIN RSA PRIVATE KEY-----", "Authorization: Bearer abcDEF123456.ghiJKL", "eyJhbGciOiJ9.eyJzdWIiOiIx.c2lnbmF0dXJl", "xoxb-1234567890-abc", "gh p_ no", "bearer of news"]
    got = {r.doc_id: r.spans.split(":")[0] for r in S.scan(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    assert got == {0: "forge", 1: "pem", 2: "bearer", 3: "jwt", 4: "chat", 5: "", 6: ""}


def test_empty_table(spark):
    assert S.scan(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_spans_do_not_depend_on_how_starts_are_found(rng, monkeypatch):
    _, each, back = S.automata()
    parts = ["eyJ", "eyJ", ".", "a", "abcdefgh", "token", "=", ":", " ", "AKIA", "0123456789abcdef", "xoxb-", "bearer ", "-----BEGIN ", "PRIVATE KEY-----", "A"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 80))).encode() for _ in range(400)]
    every = (1 << len(S.KINDS)) - 1
    got = []
    for tries in (4, 0, 10**9):
        monkeypatch.setattr(S, "TRIES", tries)
        got.append([S.spans_of(t, every, each, back) for t in texts])
    assert got[0] == got[1] == got[2] and sum(map(len, got[0])) > 500


@pytest.mark.parametrize("text", ["eyJ" * 300_000 + ".a.", "eyJ" * 100_000 + "." + "eyJ" * 100_000 + ".a." + "eyJ" * 100_000, "xoxb-" * 200_000, "bearer " * 150_000, "-----BEGIN " * 90_000, "ghp_" * 250_000, "token" * 200_000])
def test_long_lines_take_time_in_proportion(text):
    import time

    search, each, back = S.automata()
    for a in (*each, *back):
        a.table  # noqa: B018
    began = time.process_time()
    S.spans_of(text.encode(), (1 << len(S.KINDS)) - 1, each, back)
    assert time.process_time() - began < 8  # tried one by one, hours
