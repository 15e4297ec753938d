"""What several operators share: the shared folder, joins on hot keys, pieces of texts, words and word hashes."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.functions.text import folded, named

#: A word is a run of characters other than blank, tab, line feed, vertical tab, form feed and carriage return.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_CACHE_WORDS = 150_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Only a local session, whose executors are here, gets one of its own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found is None:
        kept = spark.sparkContext._jsc.sc().getCheckpointDir()
        if kept.isDefined():
            return kept.get()
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        found = tempfile.mkdtemp(prefix="sieveline-")
        spark.sparkContext.setCheckpointDir(found)
    return found


def written(df: DataFrame, arrow_rows: int | None = None) -> DataFrame:
    """df, cut from its lineage as a Parquet table in the shared folder.

    With arrow_rows, Python sees that many rows at a time while the table is made; whole texts in large batches take much memory.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark).rstrip('/')}/sieveline-{uuid.uuid4().hex}"
    with small_batches(spark, arrow_rows):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int | None) -> Iterator[None]:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    if rows:
        spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


#: A key is hot if more than one row in HOT has it: there are fewer than HOT such keys, whatever the table's size.
HOT = 1000


def join_by_key(rows: DataFrame, table: DataFrame, key: Sequence[str], n: str, how: str = "inner") -> DataFrame:
    """rows joined with a table that has one row for each key and, in column n, how many of the rows have it; n is left out.

    Rows of hot keys stay where they are and get their few table rows by broadcast, so that no task takes them all.
    """
    key = list(key)
    total = table.agg(F.sum(n)).first()[0] or 0
    hot = table.where(F.col(n) * HOT > total).drop(n) if total >= HOT else table.limit(0)
    plain = table.drop(n)
    if hot.isEmpty():
        return rows.join(plain, key, how)
    spread = rows.join(F.broadcast(hot), key)
    return spread.unionByName(rows.join(F.broadcast(hot.select(*key)), key, "left_anti").join(plain, key, how))


#: Characters of a piece of text; pieces are cut from the few of them that they touch, not from the text's beginning.
PIECE = 4096


def pieces(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))


def cut(of: Column, start: Column, end: Column) -> Column:
    """The characters from start to end (exclusive) of a text in pieces."""
    first = F.floor(start / PIECE).cast("int")
    some = F.slice(of, first + 1, F.floor((end - 1) / PIECE).cast("int") - first + 1)
    return F.when(start < end, F.substring(F.array_join(some, ""), start % PIECE + 1, end - start)).otherwise("")


def with_puts(text: Column, puts: Column) -> Column:
    """A text in which each of the `puts` (start, end, put), by start, stands for what was there; the later of two that overlap is left out."""

    def built(of: Column, xs: Column) -> Column:
        step = lambda at, s: (F.greatest(at, s["end"]), F.when(s["start"] >= at, F.array(cut(of, at, s["start"]), s["put"])).otherwise(F.expr("cast(array() as array<string>)")))
        done = folded(xs, F.lit(0), "string", step)
        return F.concat(F.array_join(done, ""), cut(of, F.array_max(F.transform(xs, lambda s: s["end"])), F.length(text)))

    return F.when(F.size(puts) > 0, named(pieces(text), lambda of: named(puts, lambda xs: built(of, xs)))).otherwise(text)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_ascii(c: Column) -> Column:
    """A-Z in lower case; all other characters as they are."""
    return F.translate(c, _UPPER, _LOWER)


def words_of(text: str | None) -> list[bytes]:
    """The words of a text, A-Z in lower case, as UTF-8; bytes.split() parts at exactly the characters that SPACE lists."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


_MIX = np.uint64(0x9E3779B97F4A7C15)
_HALF = np.uint64(32)


def runs_hash(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of `width` neighbouring word hashes, order included."""
    n = len(hashes) - width + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(width if n > 0 else 0):
        out ^= hashes[j : j + n]
        out *= _MIX
        out ^= out >> _HALF
    return out
