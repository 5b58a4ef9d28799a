"""Columns whose names clash, rows that repeat, ids of other kinds: no operator crashes and all read the right column."""

import pytest

from made import prose
from winnow.llm import decontaminate, mixing, perplexity, pii, secrets, urls

TEXT = "password = hunter2hunter2 mail a.b@example.org and " + "some words that stand here again and again " * 4


def clashing(spark, rng):
    rows = [(i, TEXT + prose(rng, 60), "en", "a", 0, "other", "z") for i in range(6)] + [(None, None, None, None, None, None, None)] + [(3, TEXT, "en", "a", 0, "other", "z")] * 2
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, TEXT string, LANG string")


@pytest.mark.parametrize("scan", [secrets.scan, pii.scan])
def test_scans(spark, rng, scan):
    d = clashing(spark, rng)
    got = scan(d).collect()
    plain = scan(d.toDF("doc_id", "text", "lang", "source", "n_chars", "x", "y")).collect()
    assert sorted(map(str, got)) == sorted(map(str, plain)) and len(got) == 9
    assert all(r.spans for r in got if r.doc_id is not None)


def test_perplexity(spark, rng):
    labels = spark.createDataFrame([(i, 1, 0, 5) for i in range(4)], "doc_id long, quality int, toxic int, QUALITY int")
    got = perplexity.classify(clashing(spark, rng), labels).collect()
    assert len(got) == 9 and all(r.perplexity for r in got if r.doc_id is not None)


def test_items_without_id(spark, rng):
    item = prose(rng, 40)
    bench = spark.createDataFrame([(None, item, "x"), (7, None, "x"), (8, prose(rng, 30), "x")], "item_id long, text string, TEXT string")
    docs = spark.createDataFrame([(1, prose(rng, 20) + " " + item, "n"), (2, prose(rng, 50), "n"), (None, item, "n")], "doc_id long, text string, Text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(docs, bench).collect()}
    assert got == {(1, None), (None, None)}


def test_urls(spark):
    rows = [(1, "http://example.net/en/x", "no"), (1, "http://example.net/en/x", "no"), (2, None, "http://example.com/de/"), (3, "http://a.org/" + "long/" * 20_000, "no")]
    got = sorted((r.page_id, r.rule, r.path) for r in urls.judge(spark.createDataFrame(rows, "page_id long, url string, URL string")).collect() if r.page_id < 3)
    assert got == [(1, "example.net/en/", "/en/x")] * 2 + [(2, None, "")]


def test_ids_that_are_text(spark, rng):
    rows = [(f"d{i % 300}", prose(rng, 20), rng.choice("ab")) for i in range(400)] + [(None, "x y", None)]
    d = spark.createDataFrame(rows, "doc_id string, text string, source string")
    first, again = (sorted(map(str, mixing.mix(x).collect())) for x in (d, d.repartition(5)))
    assert first == again and len(first) == 401
