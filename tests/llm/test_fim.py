"""Fill-in-the-middle against plain code, and the round trip."""

import hashlib
import re

from made import DOCUMENTS, prose, rows_of
from winnow.llm import fim

SCHEMA = {"n", "form", "prefix_chars", "middle_chars", "output"}


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text, re.S)
    x = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(k in text for k in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_against_plain_code(spark, rng, odd_texts):
    texts = odd_texts + ["<P>", "a<S>b", "<M", "<<P>>", "<P", "P>", "<", "ab", "a1b2", "1234", "\U0001f600\U0001f600x", "\r\n\r\n", "é" * 50 + "abc" + "東" * 50]
    texts += ["".join(rng.choice("ab<PSM>é \U0001f600\n") for _ in range(rng.randint(1, 40))) for _ in range(300)] + [prose(rng, 80) for _ in range(50)]
    docs = rows_of(texts) + [(None, "no id here", "en", "a", 0), (7, "same id again", "en", "a", 0), (-5, "below zero", "en", "a", 0), (2**60 + 1, "far away", "en", "a", 0)]
    docs += [docs[20]] * 2
    made = fim.transform(spark.createDataFrame(docs, DOCUMENTS))
    got = sorted((str(r.doc_id), r.n, r.form, str(r.prefix_chars), str(r.middle_chars), r.output) for r in made.collect())
    want = sorted((str(d), w[0], w[1], str(w[2]), str(w[3]), w[4]) for d, t, *_ in docs for w in [plain(d, t)])
    assert got == want
    assert {r.form for r in made.select("form").collect()} == {"plain", "psm", "spm"}
    texts_by = {(str(d), hashlib.sha256(plain(d, t)[4].encode()).hexdigest()): hashlib.sha256((t or "").encode()).hexdigest() for d, t, *_ in docs}
    found = fim.digests(made).collect()
    assert len(found) == len(docs)
    for r in found:  # rebuilt from output and form, for every text
        assert texts_by[str(r.doc_id), r.output_sha256] == r.restored_sha256


def test_cuts_follow_units_and_not_letters(spark):
    """A cut never falls inside a run of letters; long runs of one class are found by their numbers alone."""
    docs = rows_of(["word " * 30_000, "x" * 300_000, "," * 300_000])
    for r in fim.transform(spark.createDataFrame(docs, DOCUMENTS)).collect():
        text = docs[r.doc_id][1]
        if r.form != "plain":
            for cut in (r.prefix_chars, r.prefix_chars + r.middle_chars):
                assert cut in (0, len(text)) or not (text[cut - 1].isalpha() and text[cut].isalpha())
        assert r.n == len(re.findall(r"[A-Za-z]+|[^A-Za-z]", text))


def test_empty_table_extra_columns_and_shares(spark):
    assert fim.transform(spark.createDataFrame([], DOCUMENTS)).collect() == []
    d = spark.createDataFrame([(i, "some words, and more", "n", 3) for i in range(2000)], "doc_id string, text string, TEXT string, n int")
    made = fim.transform(d)
    assert set(made.columns) == {"doc_id"} | SCHEMA
    share = {r.form: r["count"] / 2000 for r in made.groupBy("form").count().collect()}
    assert abs(share["plain"] - 0.1) < 0.03 and abs(share["spm"] - 0.18) < 0.03
