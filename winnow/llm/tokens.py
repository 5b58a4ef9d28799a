"""Token ids in flat binary files.

Format, in one folder: ``part-NNNNN.bin`` holds the ids of consecutive
documents as flat little-endian unsigned integers (16 bits where the vocabulary
allows, else 32), ``part-NNNNN.idx`` a header line in JSON padded to 128 bytes,
then the 64-bit global offset of each document's first id with the end after
the last, and the 64-bit document ids.  Parts follow one another in ascending
doc_id order; both files can be memory-mapped.

The documents are tokenised where they are read, and only their ids are dealt
out by ranges of doc_id.  A task writes each file under a name of its own and
renames it, so a task that is repeated changes nothing.  The sizes of the
parts give their bases by one prefix sum; the offsets are written from them.

Words repeat: Arrow splits a batch and numbers its distinct words, and a task
keeps the ids of the words it has met, so Python meets a word once a batch.
That is exact where the tokeniser treats white space as a border, which is
checked; other tokenisers encode whole texts.

Defined results: a null text is empty, and an empty one has only the end id;
repeated doc_ids follow one another, in order of their ids; documents without
doc_id come first, likewise, and have none in what is read back; a text of any
length is one document of one part; an empty table makes no file.  Only doc_id
and text are read, by these names in this case where the session tells cases
apart; a column whose name differs in case alone is not read.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from winnow.llm import common

END = 2
TOKENIZER = "word_bpe_49k.json"
HEADER = 128
#: Words whose ids a task keeps at most; then it starts anew.
KEEP_WORDS = 1_200_000
_LEAST = -(1 << 63)
PART_DOCS = 4096
#: Most parts of one folder, so that their borders stay small; beyond, parts hold more documents.
MOST_PARTS = 10_000
#: Bytes of text that are split at a time.
SLICE_BYTES = 8 << 20


def public_tokenizer(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


#: Letters whose lower case and composed form are themselves or one letter, alike in every library.
LATIN, LOWER = "^[A-Za-zÀ-ÖØ-öø-ÿ]+$", "^[a-zß-öø-ÿ]+$"


def _fits(words: pa.Array, pattern: str) -> pa.Array:
    return pc.match_substring_regex(words, pattern)


class Words:
    """The ids of words met so far: word number k has ids flat[start[k] : start[k] + size[k]]."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks fill the cores
        self.tool = Tokenizer.from_file(path)
        self.vocab = self.tool.get_vocab_size()
        spec = json.loads(self.tool.to_str())
        norm, pre = json.dumps(spec.get("normalizer")), json.dumps(spec.get("pre_tokenizer"))
        #: White space is dropped before the merges, and no added token holds any: ids of a text are those of its words.
        self.by_word = "Lowercase" in norm and '"invert": true' in pre and "[^\\\\s" in pre and not any(re.search(r"\s", a["content"]) or a["lstrip"] or a["rstrip"] for a in spec["added_tokens"])
        #: A run of letters is merged by itself, and its last id, and no other, ends a word.
        suffix = spec["model"].get("end_of_word_suffix")
        self.letters = self.by_word and bool(suffix) and "ByteLevel" in pre and "[\\\\p{L}]+" in pre
        self.last = np.zeros(self.vocab, bool)
        if self.letters:
            self.last[[i for t, i in self.tool.get_vocab().items() if t.endswith(suffix)]] = True
        #: The library's same merges for LOWER words, which need neither normalising nor any cut but at spaces.
        steps = [{"type": "WhitespaceSplit"}, {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]
        self.plain = Tokenizer.from_str(json.dumps(spec | {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": steps}, "added_tokens": []}))
        #: An added token stands for itself and cuts a text before all else, so it can separate words.
        self.cut = next(((a["content"], a["id"]) for a in spec["added_tokens"] if not a["normalized"] and not a["single_word"]), None)
        self.clear()

    def clear(self) -> None:
        self.flat, self.used = np.zeros(1 << 16, np.uint32), 0
        self.known = pa.array([], pa.string())
        self.start = self.size = np.zeros(0, np.int64)
        # number 0 is the end, by a name that no word has; the empty word is what a split leaves at borders
        self.add(pa.array(["\n", ""]), np.array([END]), np.array([1, 0]))

    def name(self, words: pa.Array, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Words whose ids stand there already; their numbers."""
        n = len(self.known)
        self.known = pa.concat_arrays([self.known, words.cast(pa.string())])
        self.start, self.size = np.concatenate([self.start, start]), np.concatenate([self.size, size])
        return np.arange(n, len(self.known))

    def add(self, words: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """New words with their ids, which stand one after another; their numbers."""
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.name(words, self.used - len(ids) + np.cumsum(sizes) - sizes, sizes)

    def numbers(self, words: pa.Array, learn) -> np.ndarray:
        """Their numbers; those of unknown ones come from learn()."""
        found = pc.index_in(words, value_set=self.known)
        out = pc.fill_null(found, -1).to_numpy(zero_copy_only=False).astype(np.int64)
        if found.null_count:
            out[out < 0] = learn(words.filter(pc.is_null(found)))
        return out

    def gather(self, k: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of these word numbers, and the borders of the words among them."""
        size = self.size[k]
        at = np.concatenate([[0], np.cumsum(size)])
        return self.flat[np.repeat(self.start[k] - at[:-1], size) + np.arange(at[-1])], at

    def learn(self, new: pa.Array) -> np.ndarray:
        """Numbers for distinct new words.  Those of letters, with a full stop or comma after them or not,
        are asked for by the letters, LATIN ones in lower case; all others as they stand."""
        if not self.letters:
            return self.ask(new, None)
        n = len(new)
        mark = pc.if_else(_fits(new, r"[^.,][.,]$"), pc.utf8_slice_codeunits(new, -1), "")
        body = pc.if_else(pc.equal(mark, ""), new, pc.utf8_slice_codeunits(new, 0, stop=-1))
        body = pc.if_else(_fits(body, LATIN), pc.utf8_lower(body), body)
        letters = pc.and_(pc.utf8_is_alpha(body), pc.utf8_is_alpha(pc.utf8_lower(body)))
        mark = pc.if_else(letters, mark, "")
        base = pa.concat_arrays([pc.if_else(letters, body, new), pa.array([".", ","], new.type)]).dictionary_encode()
        k = self.numbers(base.dictionary, self._parts)[base.indices.to_numpy()]
        stop, comma = k[n:]
        out = k[:n].copy()
        marked = pc.not_equal(mark, "")
        # spelt otherwise, but with the same ids
        again = pc.and_(pc.invert(marked), pc.not_equal(body, new))
        at = np.flatnonzero(again.to_numpy(zero_copy_only=False) & letters.to_numpy(zero_copy_only=False))
        out[at] = self.name(new.take(at), self.start[k[at]], self.size[k[at]])
        at = np.flatnonzero(marked.to_numpy(zero_copy_only=False))
        is_stop = pc.equal(mark, ".").to_numpy(zero_copy_only=False)[at]
        ids, border = self.gather(np.stack([k[at], np.where(is_stop, stop, comma)], axis=1).ravel())
        out[at] = self.add(new.take(at), ids, np.diff(border[::2]))
        return out

    def _parts(self, base: pa.Array) -> np.ndarray:
        """Numbers for new words that are of letters alone, or of anything."""
        letters = pc.utf8_is_alpha(base)
        lower = pc.and_(letters, _fits(base, LOWER))
        out = np.zeros(len(base), np.int64)
        for some, tool in ((lower, self.plain), (pc.and_not(letters, lower), self.tool), (pc.invert(letters), None)):
            out[some.to_numpy(zero_copy_only=False)] = self.ask(base.filter(some), tool)
        return out

    def ask(self, words: pa.Array, tool) -> np.ndarray:
        """Have new words encoded, many at a time; their numbers.  With a tool they
        are of letters, told apart by the ids that end one; without, by an added
        token; one by one where a line isn't as assumed."""
        text, cut = (" ", None) if tool is not None else self.cut or ("", None)
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]

        def one_by_one(some: pa.Array) -> None:
            for one in self.tool.encode_batch_fast(some.to_pylist(), add_special_tokens=False):
                ids.append(np.array(one.ids, np.uint32))
                sizes.append(np.array([len(one.ids)]))

        if not text:
            one_by_one(words)
            return self.add(words, np.concatenate(ids), np.concatenate(sizes))
        at = np.append(np.arange(0, len(words), 256), len(words))
        lines = pc.binary_join(pa.ListArray.from_arrays(at.astype(np.int32), words.cast(pa.string())), text).to_pylist()
        for lo, hi, g in zip(at[:-1], at[1:], (tool or self.tool).encode_batch_fast(lines, add_special_tokens=False), strict=True):
            x = np.array(g.ids, np.uint32)
            borders = np.flatnonzero(self.last[x]) + 1 if cut is None else np.append(np.flatnonzero(x == cut), len(x)) + 1
            if len(borders) == hi - lo:
                ids.append(x if cut is None else x[x != cut])
                sizes.append(np.diff(borders, prepend=0) - (cut is not None))
            else:
                one_by_one(words[lo:hi])
        return self.add(words, np.concatenate(ids), np.concatenate(sizes))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of whole texts, END last, one after another, and the borders of the texts."""
        texts = pc.fill_null(texts, "")
        if not self.by_word:
            got = self.tool.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return np.array([x for g in got for x in (*g.ids, END)], np.uint32), np.concatenate([[0], np.cumsum([len(g.ids) + 1 for g in got])])
        if len(self.known) > KEEP_WORDS:
            self.clear()
        lists = pc.ascii_split_whitespace(texts)
        border = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        numbers = self.numbers(coded.dictionary, self.learn)
        # every text's words, then the end
        ends = border[1:] - border[0] + np.arange(len(texts))
        k = np.zeros(len(coded) + len(texts), np.int64)
        is_word = np.ones(len(k), bool)
        is_word[ends] = False
        k[is_word] = numbers[coded.indices.to_numpy()]
        ids, at = self.gather(k)
        return ids, np.concatenate([[0], at[ends + 1]])


@lru_cache(2)
def _words(path: str) -> Words:
    """One for all tasks of a worker process."""
    return Words(path)


def _slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Rows of some ``limit`` bytes of text together; a longer text is by itself."""
    size = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    lo = 0
    while lo < len(size):
        hi = max(lo + 1, int(np.searchsorted(size, (size[lo - 1] if lo else 0) + limit)))
        yield lo, hi
        lo = hi


def _binaries(ids: np.ndarray, border: np.ndarray) -> pa.Array:
    """One binary value for each run of ids, without a copy of each."""
    offsets = border.astype(np.int64) * ids.itemsize
    return pa.Array.from_buffers(pa.large_binary(), len(border) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(ids)]).cast(pa.binary())


def _tokenised(path: str, bounds: np.ndarray, kind: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _words(path)
        for b in batches:
            doc, texts = b.column("doc_id"), b.column("text")
            part = np.searchsorted(bounds, pc.fill_null(doc, _LEAST).to_numpy(), "right").astype(np.int32)
            for lo, hi in _slices(texts):
                ids, border = words.encode(texts[lo:hi])
                yield pa.RecordBatch.from_pydict({"part": pa.array(part[lo:hi]), "doc_id": doc[lo:hi], "ids": _binaries(ids.astype(kind), border)})

    return run


def _open(folder: str):
    """The file system of a folder and the path in it."""
    fs, path = pafs.FileSystem.from_uri(folder)
    return fs, path


def _put(fs, path: str, pieces: Iterator[bytes]) -> None:
    """Write under another name, then rename: all of the file or none."""
    own = f"{path}.{uuid.uuid4().hex}"
    with fs.open_output_stream(own) as f:
        for x in pieces:
            f.write(x)
    fs.move(own, path)


def _map(fs, path: str, kind: str, offset: int = 0, count: int = -1) -> np.ndarray:
    """An array over a part of a file: memory-mapped where the file is local or mounted."""
    if isinstance(fs, pafs.LocalFileSystem):
        n = fs.get_file_info(path).size - offset
        n = min(n, count * np.dtype(kind).itemsize) if count >= 0 else n
        return np.memmap(path, kind, "r", offset, n // np.dtype(kind).itemsize) if n else np.zeros(0, kind)
    with fs.open_input_file(path) as f:
        f.seek(offset)
        return np.frombuffer(f.read(count * np.dtype(kind).itemsize if count >= 0 else None), kind)


def _name(path: str, part: int, what: str) -> str:
    return f"{path}/part-{part:05d}.{what}"


def _write_parts(folder: str) -> Callable:
    """Rows sorted by part, doc_id (nulls first), ids: write the ids of each part as they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = _open(folder)
        part, f, own, docs, sizes, nulls = None, None, "", [], [], 0

        def done() -> pa.RecordBatch:
            f.close()
            fs.move(own, _name(path, part, "bin"))
            size = np.concatenate(sizes)
            return pa.RecordBatch.from_pydict({"part": pa.array([part], pa.int32()), "n_docs": pa.array([len(size)], pa.int64()), "n_null": pa.array([nulls], pa.int64()), "n_bytes": pa.array([int(size.sum())], pa.int64()), "docs": pa.array([np.concatenate(docs).tobytes()], pa.binary()), "sizes": pa.array([size.tobytes()], pa.binary())})

        for b in batches:
            number = b.column("part").to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(number)] if len(number) else [0]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):  # one part each
                if number[lo] != part:
                    if part is not None:
                        yield done()
                    part, docs, sizes, nulls = int(number[lo]), [], [], 0
                    own = f"{_name(path, part, 'bin')}.{uuid.uuid4().hex}"
                    f = fs.open_output_stream(own)
                doc, ids = b.column("doc_id")[lo:hi], b.column("ids")[lo:hi].cast(pa.large_binary())
                _, offsets, data = ids.buffers()
                border = np.frombuffer(offsets, np.int64, len(ids) + 1 + ids.offset)[ids.offset :]
                f.write(data[int(border[0]) : int(border[-1])])
                nulls += doc.null_count
                docs.append(pc.fill_null(doc, 0).to_numpy())
                sizes.append(np.diff(border))
        if part is not None:
            yield done()

    return run


def write(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Tokenise and write all documents; a table of the parts: part, n_docs, base (ids before it), n_tokens."""
    path = tokenizer or public_tokenizer()
    kind = "<u2" if Words(path).vocab <= 1 << 16 else "<u4"
    width = np.dtype(kind).itemsize
    d = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # borders of the parts from doc_id alone: the texts are read once
    n = d.count()
    n_parts = min(max(1, -(-n // PART_DOCS)), MOST_PARTS)
    bounds = np.array(sorted(set(map(int, d.approxQuantile("doc_id", [k / n_parts for k in range(1, n_parts)], min(0.01, 0.1 / n_parts))))) if n_parts > 1 else [], np.int64)
    fs, at = _open(folder)
    fs.create_dir(at, recursive=True)
    ids = d.mapInArrow(_tokenised(path, bounds, kind), "part int, doc_id long, ids binary")
    # the part's number is its partition's: no two parts meet in a task
    rows = ids.repartitionById(len(bounds) + 1, "part").sortWithinPartitions("part", F.col("doc_id").asc_nulls_first(), "ids")
    parts = common.kept(rows.mapInArrow(_write_parts(folder), "part int, n_docs long, n_null long, n_bytes long, docs binary, sizes binary"), "parts")
    base, start = {}, 0
    for r in sorted(parts.select("part", "n_bytes").collect()):  # MOST_PARTS rows at most
        base[r.part] = start
        start += r.n_bytes // width

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, at = _open(folder)
        for b in batches:
            for r in b.to_pylist():
                offsets = np.concatenate([[0], np.cumsum(np.frombuffer(r["sizes"], np.int64) // width)]) + base[r["part"]]
                head = json.dumps({"dtype": kind, "n_docs": r["n_docs"], "n_null": r["n_null"], "base": base[r["part"]]}).encode().ljust(HEADER)
                _put(fs, _name(at, r["part"], "idx"), iter([head, offsets.astype("<u8").tobytes(), r["docs"]]))
                yield pa.RecordBatch.from_pydict({"part": pa.array([r["part"]], pa.int32()), "n_docs": [r["n_docs"]], "base": [base[r["part"]]], "n_tokens": [int(offsets[-1] - offsets[0])]})

    return common.kept(parts.repartition(len(base) or 1, "part").mapInArrow(index, "part int, n_docs long, base long, n_tokens long"), "index")


def read_part(folder: str, part: int) -> tuple[np.ma.MaskedArray, np.ndarray, np.ndarray]:
    """doc ids (masked where a document has none), global offsets (one more), and the mapped ids of one part."""
    fs, at = _open(folder)
    with fs.open_input_file(_name(at, part, "idx")) as f:
        head = json.loads(f.read(HEADER))
    n = head["n_docs"]
    offsets = _map(fs, _name(at, part, "idx"), "<u8", HEADER, n + 1)
    doc = _map(fs, _name(at, part, "idx"), "<i8", HEADER + 8 * (n + 1), n)
    return np.ma.array(doc, mask=np.arange(n) < head["n_null"]), offsets, _map(fs, _name(at, part, "bin"), head["dtype"])


def read(parts: DataFrame, folder: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 and the file of each document, from the files."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part in b.column("part").to_pylist():
                doc, off, ids = read_part(folder, part)
                rel = off.astype(np.int64) - int(off[0])
                crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(rel[:-1], rel[1:], strict=True)]
                file = pa.DictionaryArray.from_arrays(np.zeros(len(doc), np.int32), [_name(folder, part, "bin")]).cast(pa.string())
                yield pa.RecordBatch.from_pydict({"doc_id": pa.array(np.asarray(doc), mask=np.ma.getmaskarray(doc)), "start": off[:-1].astype(np.int64), "n_tokens": np.diff(rel), "ids_crc32": pa.array(crc, pa.int64()), "file": file})

    return parts.select("part").repartition(max(1, parts.count()), "part").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long, file string")


def tokenised(docs: DataFrame, folder: str | None = None, tokenizer: str | None = None) -> DataFrame:
    """Write the files and return what they hold per document; the column file tells where."""
    folder = folder or f"{common.shared_dir(docs.sparkSession)}/winnow-tokens-{uuid.uuid4().hex}"
    return read(write(docs, folder, tokenizer), folder)
