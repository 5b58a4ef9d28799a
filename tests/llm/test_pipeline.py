"""The stages on planted rows, and the whole run on the smallest tables."""

import random

import corpus_pipeline as cp
from made import DOCUMENTS, prose, rows_of


def test_stages(spark, tmp_path):
    rng = random.Random(5)
    clean = [prose(rng, 200) for _ in range(90)]
    item = prose(rng, 40)
    copies = [clean[0], clean[1].replace("a", "a", 1), " ".join("edit" if k == 90 else w for k, w in enumerate(clean[2].split()))]
    leak = f"{prose(rng, 100)} {item} {prose(rng, 60)}"
    junk = prose(rng, 150).upper().replace(" ", "### ")
    docs = spark.createDataFrame(rows_of([*clean, *copies, leak, junk, None, ""]), DOCUMENTS)
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    left = []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        left.append({r.doc_id for r in docs.select("doc_id").collect()})
    assert left[0] == set(range(94))  # junk, null and empty go
    assert left[1] == set(range(90)) | {93}  # one of each group stays
    assert left[2] == set(range(90))  # the leak goes
    assert left[3] <= left[2] and left[4] == left[3]


def test_run(spark):
    out = cp.run(spark, "/root/testdata/sf0.001")
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32", "file"] and out.count() > 0


def test_odd_rows_through_all_stages(spark, tmp_path):
    """Null ids, repeated rows, null and long texts, extra columns whose names the operators use."""
    rng = random.Random(6)
    texts = [prose(rng, 200) for _ in range(40)]
    leak = prose(rng, 40)
    odd = [(None, texts[0], "en", "a"), (None, prose(rng, 90), None, None), (None, f"{prose(rng, 80)} {leak}", "en", "a"), (7, texts[7], "en", "a"), (1 << 60, prose(rng, 30_000), "en", "a"), (41, None, "en", "a"), (42, "", "en", "a")]
    rows = [(i, t, "en", "a") for i, t in enumerate(texts)] + odd
    names = ["_id", "copies", "key", "c0", "kept", "component_id", "size", "part"]
    docs = spark.createDataFrame([(*r, *range(8)) for r in rows], "doc_id long, text string, lang string, source string, " + ", ".join(f"{n} int" for n in names))
    spark.createDataFrame([(1, leak), (2, None), (None, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    ids = []
    for k, (_, stage) in enumerate(cp.STAGES):
        out = stage(spark, docs, str(tmp_path))
        if k < len(cp.STAGES) - 1:
            assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        ids.append(sorted((-1 if r.doc_id is None else r.doc_id) for r in docs.collect()))
    assert ids[0] == sorted([-1, -1, -1, *range(40), 7, 1 << 60])
    assert ids[1] == ids[0]  # rows without id stay, repeated ones stay together
    assert ids[2] == sorted([-1, -1, *range(40), 7, 1 << 60])
    assert set(ids[3]) <= set(ids[2]) and ids[4] == ids[3]


def test_empty_table_through_all_stages(spark, tmp_path):
    docs = spark.createDataFrame([], DOCUMENTS)
    spark.createDataFrame([(1, "some text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for k, (_, stage) in enumerate(cp.STAGES):
        stage(spark, docs, str(tmp_path)).write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        assert docs.count() == 0
