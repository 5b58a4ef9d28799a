"""Round trip through the files against the tokeniser itself."""

import zlib

import numpy as np

from made import DOCUMENTS, rows_of
from winnow.llm import tokens as T


def want(texts):
    from tokenizers import Tokenizer

    tool = Tokenizer.from_file(T.public_tokenizer())
    start, out = 0, {}
    for i, t in enumerate(texts):
        ids = np.array([*tool.encode(t or "", add_special_tokens=False).ids, T.END], "<u4")
        out[i] = (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    return out


def test_round_trip(spark, odd_texts, rng, monkeypatch):
    monkeypatch.setattr(T, "PART_DOCS", 40)
    parts = list("aAbBéÉeE.,'s \n\t12½Σςσİ\u0301\u030aWw<|>-東\u2009") + ["<|endoftext|>", "it's", "The", "end."]
    texts = [*odd_texts, *("".join(rng.choices(parts, k=rng.randint(0, 60))) for _ in range(400))]
    rows = rows_of(texts)
    rng.shuffle(rows)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.tokenised(spark.createDataFrame(rows, DOCUMENTS)).collect()}
    assert got == want(texts)


def test_files(spark, tmp_path):
    folder = f"file://{tmp_path}/out"
    T.write(spark.createDataFrame(rows_of(["a b", "c", "d e f"]), DOCUMENTS), folder)
    doc, off, ids = T.read_part(folder, 0)
    assert list(doc) == [0, 1, 2] and list(off) == [0, 3, 5, 9] and ids.dtype == np.uint16 and len(ids) == 9
    assert list(ids[off[1:].astype(int) - 1]) == [T.END] * 3
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["part-00000.bin", "part-00000.idx"]


def test_repeated_ids_and_empty(spark):
    got = T.tokenised(spark.createDataFrame([(5, "a"), (5, "a"), (5, "b c")], "doc_id long, text string")).collect()
    assert sorted(r.start for r in got) == [0, 2, 4] and {r.doc_id for r in got} == {5}
    assert T.tokenised(spark.createDataFrame([], DOCUMENTS)).collect() == []


def test_words_with_and_without_the_separator_inside(spark):
    texts = ["<|startoftext|>", "a<|startoftext|>b c", "x1 y-2 <|startoftext|>", "Straße, İstanbul. ΣΑΣ, ﬁx. don't. A.B, .,. ,", "é é Å Å.", "a\x1cb a b"]
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in T.tokenised(spark.createDataFrame(rows_of(texts), DOCUMENTS)).collect()}
    assert got == want(texts)


def test_null_ids_come_first_and_extra_columns_are_not_read(spark):
    rows = [(None, "b", 1, "z"), (1 << 60, "a", 2, "z"), (None, "a a", 3, "z"), ((1 << 60) + 1, None, 4, "z"), (-3, "c", 5, "z")]
    got = T.tokenised(spark.createDataFrame(rows, "doc_id long, text string, part int, ids string")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None, None, -3, 1 << 60, (1 << 60) + 1]
    assert [r.start for r in got] == [0, got[0].n_tokens, 5, 7, 9] and all(r.file.endswith(".bin") for r in got)


def test_many_repeated_ids_over_parts(spark, monkeypatch):
    monkeypatch.setattr(T, "PART_DOCS", 4)
    monkeypatch.setattr(T, "KEEP_WORDS", 5)
    rows = [(i // 10 if i < 30 else i, f"w{i} end", "en", "a", 1) for i in range(60)]
    got = T.tokenised(spark.createDataFrame(rows, DOCUMENTS).repartition(5)).orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted(r[0] for r in rows)
    assert [r.start for r in got] == np.concatenate([[0], np.cumsum([r.n_tokens for r in got])[:-1]]).tolist()
