"""Fill-in-the-middle: texts rearranged so that a model learns to fill gaps.

A text's units are its maximal runs of ASCII letters and every other code point.
They are never listed: a text is stored as its maximal runs of the two classes
with the number of units before each, a run of letters counting as one, a run of
others as its length.  A binary search in these numbers finds the run that a cut
falls in, and the code point of the cut follows by arithmetic.  Runs of all
texts of a chunk lie in one array, so one search serves them all.

The cuts and the form come from the SHA-256 of the seed and the doc_id, so
reruns and other partitions give the same.  The markers can't occur in a text
that isn't plain, nor across its borders with them (each begins with ``<`` and
ends with ``>``), so that the text can be rebuilt from the output and the form.

Defined results: a null text is empty, an empty one is plain.  A null doc_id is
drawn as the empty string would be; rows that repeat a doc_id are cut by the
same draws.  A long text is handled whole, in a chunk of its own; an empty table
gives no rows.  Columns are taken by name, exact case first; others, whatever
their names, are left alone.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from winnow.llm import common
from winnow.llm import textscan as ts

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED, PLAIN_PERCENT, SPM_PERCENT = "1", 10, 20

_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True


class Runs:
    """The class runs of all texts of a chunk, rows one after another.

    ``point``: the code point at which a run starts, ``unit``: the units before it, both
    counted through the chunk; ``letters``: its class.  ``points`` and ``units`` have n + 1
    borders of the rows.
    """

    def __init__(self, c: ts.Chunk) -> None:
        lead = np.flatnonzero((c.data & 0xC0) != 0x80)  # the bytes at which code points start
        letter = _LETTER[c.data[lead]]
        self.points = np.searchsorted(lead, c.border)
        new = np.zeros(len(lead) + 1, bool)
        new[1:-1] = letter[1:] != letter[:-1]
        new[self.points] = True
        self.point = np.flatnonzero(new[:-1])
        self.letters = letter[self.point]
        length = np.diff(np.append(self.point, len(lead)))
        self.unit = np.concatenate([[0], np.cumsum(np.where(self.letters, 1, length))])
        self.units = self.unit[np.searchsorted(self.point, self.points)]

    def at(self, cut: np.ndarray) -> np.ndarray:
        """Where, in code points of the chunk, so many of its units end."""
        end = int(self.points[-1])
        if not len(self.point):
            return np.zeros(len(cut), np.int64)
        run = np.searchsorted(self.unit, cut, "right") - 1  # the run that holds the unit after the cut
        last = run >= len(self.point)
        run[last] = 0
        inside = np.where(self.letters[run], 0, cut - self.unit[run])
        return np.where(last, end, self.point[run] + inside)


def _draws(doc_id, seed: str) -> tuple[int, ...]:
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return tuple(int.from_bytes(digest[k : k + 4], "big") for k in range(0, 16, 4))


def transform_chunk(c: ts.Chunk, ids: list, seed: str = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> dict[str, list]:
    """n, form, prefix_chars, middle_chars and output of each row."""
    runs = Runs(c)
    h = np.array([_draws(x, seed) for x in ids], np.int64).reshape(-1, 4)
    n = np.diff(runs.units)
    u = np.sort(np.stack([h[:, 0] % (n + 1), h[:, 1] % (n + 1)]), axis=0)
    # a cut at the end of a row is the start of the next one in the chunk, which is the same code point
    cut = runs.at(u + runs.units[:-1]) - runs.points[:-1]
    raw, out, form = c.data.tobytes(), [], []
    for i in range(c.n):
        t = raw[c.border[i] : c.border[i + 1]].decode()
        if not t or h[i, 2] % 100 >= 100 - plain_percent or PREFIX in t or SUFFIX in t or MIDDLE in t:
            form.append("plain")
            out.append(t)
            continue
        a, b = cut[0, i], cut[1, i]
        spm = h[i, 3] % 100 < spm_percent
        form.append("spm" if spm else "psm")
        out.append(f"{SUFFIX}{t[b:]}{PREFIX}{t[:a]}{MIDDLE}{t[a:b]}" if spm else f"{PREFIX}{t[:a]}{SUFFIX}{t[b:]}{MIDDLE}{t[a:b]}")
    plain = np.array([x == "plain" for x in form], bool)
    return {"n": n, "form": form, "prefix_chars": np.ma.array(cut[0], mask=plain), "middle_chars": np.ma.array(cut[1] - cut[0], mask=plain), "output": out}


def transform(docs: DataFrame, seed: str = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units), form, prefix_chars, middle_chars and output of every document; no shuffle."""
    d = common.pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids = b.column("doc_id")
            for c in ts.chunks(b):
                own = ids.slice(c.first, c.n)
                got = transform_chunk(c, own.to_pylist(), seed, plain_percent, spm_percent)
                cols = {k: pa.array(v.data, pa.int64(), mask=np.ma.getmaskarray(v)) if isinstance(v, np.ma.MaskedArray) else pa.array(v) for k, v in got.items()}
                yield pa.RecordBatch.from_pydict({"doc_id": own, **cols, "form": pa.array(got["form"], pa.string()), "output": pa.array(got["output"], pa.string())})

    kind = d.schema["doc_id"].dataType.simpleString()
    return d.mapInArrow(run, f"doc_id {kind}, n long, form string, prefix_chars long, middle_chars long, output string")


def restored(output: Column, form: Column) -> Column:
    """The text itself, from output and form alone."""
    find = lambda x: F.instr(output, x)
    p, s, m = find(PREFIX), find(SUFFIX), find(MIDDLE)
    cut = lambda start, end: F.substr(output, start + len(PREFIX), end - start - len(PREFIX))
    middle = F.substr(output, m + len(MIDDLE))
    psm = F.concat(cut(p, s), middle, cut(s, m))
    spm = F.concat(cut(p, m), middle, cut(s, p))
    return F.when(form == "plain", output).when(form == "psm", psm).otherwise(spm)


def digests(made: DataFrame) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars, and the SHA-256 of the output and of the text rebuilt from it."""
    sha = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", sha(F.col("output")).alias("output_sha256"), sha(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


ORACLE = r"""
WITH h AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS x FROM documents
), d AS (
  SELECT doc_id, text, regexp_extract_all(text, '[A-Za-z]+|[^A-Za-z]') AS u,
    [('0x' || substr(x, 1, 8))::BIGINT, ('0x' || substr(x, 9, 8))::BIGINT, ('0x' || substr(x, 17, 8))::BIGINT, ('0x' || substr(x, 25, 8))::BIGINT] AS h FROM h
), c AS (
  SELECT doc_id, text, u, len(u) AS n, least(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS a, greatest(h[1] % (len(u) + 1), h[2] % (len(u) + 1)) AS b,
    CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h[3] % 100 >= 90 THEN 'plain' WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d
), s AS (
  SELECT doc_id, text, n, form, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:], '') AS s FROM c
)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(text) AS restored_sha256 FROM s
"""
