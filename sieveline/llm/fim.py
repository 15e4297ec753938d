"""Fill-in-middle: documents cut in prefix, middle and suffix, and put together so that a model learns to fill the middle.

Method: run-length class encoding. A text is stored as its maximal runs of letters and of other characters, with the count of units up to the
end of each run; a run of letters is one unit, every other character is one. A cut after u units lies in the run that a binary search in these
counts finds, and its offset follows from the run's start by arithmetic: no unit is listed, so a text costs its number of runs.

Defined cases: a null text counts as empty, and an empty one stays plain; a null doc_id draws as an empty one; equal rows give equal results;
texts of any length are cut whole, a few hundred at a time; an empty table gives an empty one; the docs' own columns stay, whatever their
names, but for one that has the name of the result, which replaces it.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions.text import named

#: What stands before the prefix, the suffix and the middle.
MARKS = ("<P>", "<S>", "<M>")
PLAIN, PREFIX_FIRST, SUFFIX_FIRST = "plain", "psm", "spm"
#: Percent of documents that stay as they are, and of the others that begin with their suffix.
PLAIN_PERCENT, SUFFIX_FIRST_PERCENT = 10, 20
#: Rows whose code points are in memory at a time.
_ROWS = 256
_RESULT = "struct<n: bigint, form: string, prefix_chars: bigint, middle_chars: bigint, output: string>"


class Runs(NamedTuple):
    """Maximal runs of one class: where each begins, how many characters it has, whether they are letters, and the units up to its end."""

    starts: np.ndarray
    lengths: np.ndarray
    letters: np.ndarray
    units: np.ndarray

    @property
    def n(self) -> int:
        return int(self.units[-1]) if len(self.units) else 0

    def offset(self, u: int) -> int:
        """The number of characters of the first u units."""
        if u <= 0:
            return 0
        k = int(np.searchsorted(self.units, u))
        if self.letters[k]:
            return int(self.starts[k] + self.lengths[k])
        before = int(self.units[k - 1]) if k else 0
        return int(self.starts[k]) + u - before


def runs(text: str) -> Runs:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = ((codes | 32) - np.uint32(97)) < 26
    starts = np.flatnonzero(np.diff(letter, prepend=~letter[:1])) if len(codes) else np.zeros(0, np.int64)
    lengths = np.diff(starts, append=len(codes))
    return Runs(starts, lengths, letter[starts], np.cumsum(np.where(letter[starts], 1, lengths)))


def draws(seed: str, doc_id: Column) -> list[Column]:
    """Four unsigned integers that a document draws: groups of eight digits of the SHA-256 of `seed:doc_id`."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def one(text: str | None, h: tuple[int, int, int, int], plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT) -> tuple:
    """n, form, prefix_chars, middle_chars and output of a text for its draws."""
    text = text or ""
    found = runs(text)
    if not text or any(m in text for m in MARKS) or h[2] % 100 >= 100 - plain_percent:
        return found.n, PLAIN, None, None, text
    a, b = sorted((h[0] % (found.n + 1), h[1] % (found.n + 1)))
    a, b = found.offset(a), found.offset(b)
    p, s, m = MARKS
    if h[3] % 100 < suffix_first_percent:
        return found.n, SUFFIX_FIRST, a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
    return found.n, PREFIX_FIRST, a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"


def transform(docs: DataFrame, seed: str = "1", plain_percent: int = PLAIN_PERCENT, suffix_first_percent: int = SUFFIX_FIRST_PERCENT, name: str = "fim") -> DataFrame:
    """docs and a struct of n (units), form, prefix_chars, middle_chars (code points; null if plain) and output."""
    kind = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def cut(texts: pa.Array, *hs: pa.Array) -> pa.Array:
        parts = []
        for k in range(0, len(texts), _ROWS):
            drawn = zip(*[h.slice(k, _ROWS).to_pylist() for h in hs])
            rows = [one(t, h, plain_percent, suffix_first_percent) for t, h in zip(texts.slice(k, _ROWS).to_pylist(), drawn)]
            parts.append(pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), kind)], fields=list(kind)))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    # Not deterministic, to Catalyst: else a filter on the result would have it made twice.
    made = F.arrow_udf(cut, _RESULT).asNondeterministic()
    return docs.withColumn(name, made(F.col("text").cast("string"), *draws(seed, F.col("doc_id"))))


def restored(output: Column, form: Column) -> Column:
    """The text that an output was made of. A text that holds a mark stays plain, so that the marks in any other are ours."""
    marks = "|".join(rf"\Q{m}\E" for m in MARKS)

    def joined(parts: Column) -> Column:
        first, second, middle = (F.get(parts, F.lit(k)) for k in (1, 2, 3))
        return F.when(form == SUFFIX_FIRST, F.concat(second, middle, first)).otherwise(F.concat(first, middle, second))

    return F.when(form == PLAIN, output).otherwise(named(F.split(output, marks, -1), joined))
