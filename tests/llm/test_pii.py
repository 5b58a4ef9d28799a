"""Contract spans against the plain expressions; the added ones on held-out templates."""

import re

from made import DOCUMENTS, rows_of
from winnow.llm import pii

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def base(t):
    n = lambda s: re.sub("[^0-9]", "", s)
    out = [(0, m.start(), m.end()) for m in EMAIL.finditer(t)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(t) if 13 <= len(n(m[0])) <= 19 and pii.luhn(n(m[0]))]
    return out + [(3, m.start(), m.end()) for m in PHONE.finditer(t) if 9 <= len(n(m[0])) <= 15]


def test_luhn():
    assert pii.luhn("4041894974608795") and not pii.luhn("4041894974608796")


def test_spans(spark, odd_texts, rng):
    parts = list("a.b@@-+ 0123456789().é%") + ["@x.co", "1.2.3.4", "4041894974608795", "+1 (988) 555-2485"]
    texts = [t for t in odd_texts if t is None or len(t) < 1000] + ["".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(1500)]
    got = {r.doc_id: r for r in pii.scan(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    for i, t in enumerate(texts):
        spans = [x.split(":") for x in got[i].spans.split(",") if x]
        assert [(pii.KINDS.index(k), int(a), int(b)) for k, a, b in spans if k in pii.BASE] == base(t or "")


def test_long_runs_take_linear_time(spark):
    import time

    texts = ["a" * 300_000 + "@", "1" * 300_000, "@" * 100_000, "1." * 100_000, "+" * 100_000, "1 " * 100_000]
    began = time.time()
    pii.scan(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()
    assert time.time() - began < 60


def test_held_out_accuracy():
    m = pii.model()
    x, y, kinds = pii.table_of(pii.labelled(1500, 4321))
    p = m.probability(x)
    assert ((p > 0.5) == (y > 0.5)).mean() > 0.97
    for k in m.threshold:
        on = (kinds == k) & (p >= m.threshold[k])
        assert not on.any() or y[on].mean() >= 0.95


def test_empty_table(spark):
    assert pii.scan(spark.createDataFrame([], DOCUMENTS)).collect() == []
