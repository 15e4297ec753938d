"""Repeated passages: every byte that lies in a string of `width` bytes which starts at another place of the corpus too is found and removed.

Method: a sparse suffix array. Suffixes start at tokens that the text itself delimits: a place begins a token if its gram (GRAM bytes) has the
smallest hash of all grams in some window of width - GRAM + 1 neighbouring places. Equal strings of `width` bytes choose equal places, so each such string
holds a gram that its copies hold at the same offset, and about one place in 80 begins a suffix. Places whose gram is alone in the corpus are
dropped; places with the same whole context (what a string of `width` bytes around the gram can reach) are told by its hash, and one of them
stands for all. The contexts that remain are suffixes: Spark samples splitters and range-partitions them by their leading bytes, each
bucket sorts its own by multikey quicksort, neighbours' common prefixes tell which strings occur twice, and strings of groups that touch the
edge of a bucket are compared across the boundaries. The sort is by the bytes after the place and then by those before it, so that a gram which a third
of all documents hold is dealt to many buckets.

Defined cases: a null text counts as empty; texts shorter than `width` keep all; a null doc_id is kept as it is; equal rows are repeats of each
other, so nothing stays of a text that occurs twice if it has `width` bytes; texts of any length are taken whole, one at a time;
an empty table gives an empty one; other columns don't matter, whatever their names. Matches never cross documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sieveline.llm.shared import written

WIDTH = 200
#: Bytes of a gram, a power of two: longer ones make more tokens, shorter ones more chance repeats.
GRAM = 32
#: Suffixes that a task sorts in memory.
BUCKET = 20_000
#: Suffixes that Spark samples for each bucket to find the splitters. Each is some hundred bytes, and the driver gets three times as many: so few do,
#: since a bucket may well be a third larger than another.
SAMPLED = 20
#: Segments that multikey quicksort leaves to a plain sort.
_SMALL = 64
#: Bytes of a text, and places in it, that are in memory at a time.
_PART, _PLACES = 1 << 20, 100_000
_BASE = 0x9E3779B97F4A7C15
_TABLE = np.random.default_rng(20).integers(1, 2**63, 256, dtype=np.uint64)
_HIGH, _LOW = np.uint64(0xFFFFFFFF00000000), np.uint64(0xFFFFFFFF)

_TOKENS = "gram long, ctx long, h1 long, h2 long, first int, last int, n int, left int, right int"
_REACH = "gram long, ctx long, a int, b int"
#: Texts are told by two hashes of doc_id and text, so that copies are documents of their own.
_OWN = {"h1": F.xxhash64, "h2": lambda *cs: F.xxhash64(F.lit("second"), *reversed(cs))}


# --- tokens ----------------------------------------------------------------------------------------------
def gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A hash of the gram at each place, from those of half its length, and so on; it only orders grams."""
    out, have = _TABLE[data], 1
    while have < gram:
        out = out[:-have] + out[have:] * np.uint64(pow(_BASE, have, 2**64))
        have *= 2
    out = (out ^ (out >> np.uint64(31))) * np.uint64(_BASE)
    return out ^ (out >> np.uint64(29))


def places(data: np.ndarray, width: int = WIDTH, gram: int = GRAM) -> np.ndarray:
    """Where tokens begin: the place of the first smallest gram of each string of `width` bytes."""
    n, span = len(data) - gram + 1, width - gram + 1
    if len(data) < width:
        return np.zeros(0, np.int64)
    full = -(-n // span) * span
    keys = np.full(full, ~np.uint64(0))
    keys[:n] = (gram_hashes(data, gram) & _HIGH) | np.arange(n, dtype=np.uint64)
    grid = keys.reshape(-1, span)
    ahead = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    behind = np.minimum.accumulate(grid, axis=1).ravel()
    least = (np.minimum(ahead[: n - span + 1], behind[span - 1 : n]) & _LOW).astype(np.int64)
    return least[np.diff(least, prepend=-1) != 0]


def tokens_of(text: bytes, width: int, gram: int) -> Iterator[dict[str, np.ndarray]]:
    """gram, ctx (hashes), first, last, n, left and right of a text's tokens; neighbours with the same context are one row."""
    reach, before = width - gram, -1
    for k in range(0, max(len(text) - width + 1, 0), _PART):
        found = places(np.frombuffer(text, np.uint8, min(_PART + width - 1, len(text) - k), k), width, gram) + k
        found = found[found > before]
        for j in range(0, len(found), _PLACES):
            at = found[j : j + _PLACES]
            left, right = np.minimum(at, reach), np.minimum(len(text) - at, width)
            ctx = np.fromiter((xxhash.xxh3_64_intdigest(text[x - a : x + b], a * 65536 + b) for x, a, b in zip(at.tolist(), left.tolist(), right.tolist())), np.uint64, len(at)).view(np.int64)
            grams = np.fromiter((xxhash.xxh3_64_intdigest(text[x : x + gram]) for x in at.tolist()), np.uint64, len(at)).view(np.int64)
            starts = np.flatnonzero(np.append(True, (ctx[1:] != ctx[:-1]) | (grams[1:] != grams[:-1])))
            ends = np.append(starts[1:], len(at)) - 1
            yield {"gram": grams[starts], "ctx": ctx[starts], "first": at[starts], "last": at[ends], "n": ends - starts + 1, "left": left[starts], "right": right[starts]}
            before = int(at[-1])


def tokens(docs: DataFrame, width: int, gram: int) -> DataFrame:
    kinds = {"gram": np.int64, "ctx": np.int64, "h1": np.int64, "h2": np.int64} | dict.fromkeys(("first", "last", "n", "left", "right"), np.int32)

    def run(batches):
        for batch in batches:
            parts = [dict.fromkeys(kinds, np.zeros(0, np.int64))]
            for text, h1, h2 in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("h1").to_pylist(), batch.column("h2").to_pylist()):
                for found in tokens_of(text or b"", width, gram):
                    parts.append(found | {"h1": np.full(len(found["n"]), h1), "h2": np.full(len(found["n"]), h2)})
            yield pa.RecordBatch.from_pydict({c: np.concatenate([p[c] for p in parts]).astype(kind) for c, kind in kinds.items()})

    return docs.mapInArrow(run, _TOKENS)


# --- suffixes --------------------------------------------------------------------------------------------
def _chars(values: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of characters, 1 to 256 and 0 after the end, and their lengths."""
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    out = np.zeros((len(values), -(-width // 4) * 4), np.uint16)
    out[np.arange(out.shape[1]) < lengths[:, None]] = np.frombuffer(b"".join(values), np.uint8).astype(np.uint16) + 1
    return out, lengths


def _words(chars: np.ndarray) -> np.ndarray:
    """Four characters a word, so that words sort as their characters do."""
    return chars.astype(">u2").view(">u8").astype(np.uint64)


def multikey_quicksort(words: np.ndarray) -> np.ndarray:
    """The order of rows of words: split by a pivot's word in less, equal and more; the equal go on at the next word."""
    order = np.arange(len(words))
    todo = [(0, len(words), 0)]
    while todo:
        a, b, d = todo.pop()
        if b - a < 2 or d == words.shape[1]:
            continue
        own = order[a:b]
        if b - a <= _SMALL:
            order[a:b] = own[np.lexsort(words[own, d:].T[::-1])]
            continue
        word = words[own, d]
        pivot = np.sort(word[:: max(1, len(word) // 9)])[4]
        less, same, more = own[word < pivot], own[word == pivot], own[word > pivot]
        order[a:b] = np.concatenate([less, same, more])
        todo += [(a, a + len(less), d), (a + len(less), b - len(more), d + 1), (b - len(more), b, d)]
    return order


def _common(chars: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Characters that each row shares with the row before; 0 for the first."""
    if len(chars) < 2:
        return np.zeros(len(chars), np.int64)
    differ = chars[1:] != chars[:-1]
    first = np.where(differ.any(axis=1), differ.argmax(axis=1), chars.shape[1])
    return np.append(0, np.minimum(first, np.minimum(lengths[1:], lengths[:-1])))


def _most(common: np.ndarray) -> np.ndarray:
    """Characters that each row shares with either neighbour."""
    return np.maximum(common, np.append(common[1:], 0)) if len(common) else common


def repeated(after: list[bytes], before: list[bytes], width: int, gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each place, how far strings of `width` bytes around it that occur at another of the places too reach to the left and to the right
    (0 and 0: none does), and how many bytes after it may be shared with places beyond the first or last of these.

    before has the bytes before a place, from it backwards. A string that begins o bytes before a place is told by the group of its
    width - o bytes in the order of `after` and of its o bytes in the order of `before`.
    """
    m, reach = len(after), width - gram
    right, n_right = _chars(after, width)
    left, n_left = _chars(before, reach)
    words = _words(left)
    order = multikey_quicksort(np.hstack([_words(right), words]))
    other = multikey_quicksort(words)
    shared, shared_left = _common(right[order], n_right[order]), _common(left[other], n_left[other])
    most, most_left = np.zeros(m, np.int64), np.zeros(m, np.int64)
    most[order], most_left[other] = _most(shared), _most(shared_left)
    a, b = np.zeros(m, np.int64), np.zeros(m, np.int64)
    group, group_left = np.zeros(m, np.int64), np.zeros(m, np.int64)
    live = np.flatnonzero(most + most_left >= width)
    for o in range(reach + 1) if len(live) else ():
        here = live[(most[live] >= width - o) & (most_left[live] >= o)]
        if len(here) < 2:
            continue
        group[order], group_left[other] = np.cumsum(shared < width - o), np.cumsum(shared_left < o)
        _, which, count = np.unique(group[here] * (m + 1) + group_left[here], return_inverse=True, return_counts=True)
        twice = here[count[which] > 1]
        a[twice] = o
        b[twice] = np.maximum(b[twice], width - o)
    edge = np.zeros(m, np.int64)
    if m:
        shared[0] = width
        from_first = np.minimum.accumulate(shared)
        to_last = np.minimum.accumulate(np.append(shared[1:], width)[::-1])[::-1]
        edge[order] = np.minimum(np.maximum(from_first, to_last), n_right[order])
    return a, b, edge


def _whole(batches: Iterator[pa.RecordBatch]) -> dict[str, list]:
    got = list(batches)
    return {c: [x for batch in got for x in batch.column(c).to_pylist()] for c in got[0].schema.names} if got else {}


def _sorted_buckets(suffixes: DataFrame, width: int, gram: int) -> DataFrame:
    """gram, ctx, a, b of suffixes with a repeated string in their bucket; with `low`, also those that may share width - low bytes with another bucket."""

    def run(batches):
        x = _whole(batches)
        if not x:
            return
        a, b, edge = repeated(x["after"], x["before"], width, gram)
        found = np.flatnonzero(b)
        beyond = np.flatnonzero((edge >= gram) & (np.fromiter(map(len, x["before"]), np.int64, len(a)) + edge >= width))
        rows = lambda c, at: [x[c][k] for k in at.tolist()]
        none = lambda at: [None] * len(at)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(rows("gram", found) + rows("gram", beyond), pa.int64()), pa.array(rows("ctx", found) + rows("ctx", beyond), pa.int64()), pa.array(a[found].tolist() + none(beyond), pa.int32()), pa.array(b[found].tolist() + none(beyond), pa.int32()),
                pa.array(none(found) + (width - edge[beyond]).tolist(), pa.int32()), pa.array(none(found) + rows("after", beyond), pa.binary()), pa.array(none(found) + rows("before", beyond), pa.binary()),
            ],
            ["gram", "ctx", "a", "b", "low", "after", "before"],
        )

    return suffixes.mapInArrow(run, f"{_REACH}, low int, after binary, before binary")


def _across(edges: DataFrame, width: int, gram: int) -> DataFrame:
    """The strings of edge suffixes, range-partitioned by what stands before them: a string that occurs here twice gives gram, ctx, a, b; each string gives `string` and n once.

    A string lies around several tokens; it is held against those that have their token at the same offset, o, else it would meet itself.
    """

    def run(batches):
        x = _whole(batches)
        if not x:
            return
        left, n_left = _chars(x["before"], width - gram)
        head = (np.array(x["gram"], np.int64).view(np.uint64) ^ np.uint64(1 << 63))[:, None]  # sorts as Spark's long does
        order = multikey_quicksort(np.hstack([head, _words(left)]))
        shared = np.where(np.append(False, head[order][1:, 0] == head[order][:-1, 0]), _common(left[order], n_left[order]), 0)
        most = np.zeros(len(order), np.int64)
        most[order] = _most(shared)
        most[order[[0, -1]]] = n_left[order[[0, -1]]]
        seen: dict[bytes, list[int]] = {}
        for k, (before, after, low) in enumerate(zip(x["before"], x["after"], x["low"])):
            text = before[::-1] + after
            for o in range(max(low, width - len(after)), min(len(before), int(most[k])) + 1):
                at = len(before) - o
                seen.setdefault(xxhash.xxh3_128_digest(text[at : at + width], o), []).extend((k, o))
        a, b = np.zeros(len(order), np.int64), np.zeros(len(order), np.int64)
        for found in seen.values():
            if len(found) > 2:
                ks, os = found[::2], np.array(found[1::2])
                np.maximum.at(a, ks, os)
                np.maximum.at(b, ks, width - os)
        twice = np.flatnonzero(b).tolist()
        cols: list[list] = [[], [], [], [], [], []]
        for k in twice:
            for c, v in zip(cols, (x["gram"][k], x["ctx"][k], int(a[k]), int(b[k]), None, None)):
                c.append(v)
        for string, found in seen.items():
            k, o = found[:2]
            row = (x["gram"][k], x["ctx"][k], o, width - o, string, 1) if len(found) == 2 else (None, None, None, None, string, 2)
            for c, v in zip(cols, row):
                c.append(v)
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], ["gram", "ctx", "a", "b", "string", "n"])

    return edges.mapInArrow(run, f"{_REACH}, string binary, n int")


def _contexts(docs: DataFrame, needed: DataFrame, width: int, gram: int) -> DataFrame:
    """gram, ctx, after and before (backwards) of the places that are needed of each text."""

    def run(batches):
        for batch in batches:
            rows = [(p["gram"], p["ctx"], text[p["first"] : p["first"] + width], text[max(p["first"] - width + gram, 0) : p["first"]][::-1]) for text, at in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("places").to_pylist()) for p in at]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.binary(), pa.binary()))], ["gram", "ctx", "after", "before"])

    listed = needed.groupBy("h1", "h2").agg(F.collect_list(F.struct("gram", "ctx", "first")).alias("places"))
    once = docs.groupBy("h1", "h2").agg(F.first("text").alias("text"))
    return once.join(listed, ["h1", "h2"]).select("text", "places").mapInArrow(run, "gram long, ctx long, after binary, before binary")


@contextmanager
def _few_samples(spark: SparkSession) -> Iterator[None]:
    name = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SAMPLED))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _reaches(docs: DataFrame, kept: DataFrame, width: int, gram: int, bucket: int) -> DataFrame:
    """gram, ctx and how far repeated strings reach around places with this context: a bytes before the place, b from it on."""
    classes = written(kept.groupBy("gram", "ctx").agg(F.sum("n").alias("n"), F.min(F.struct("h1", "h2", "first")).alias("one"), F.first("left").alias("left"), F.first("right").alias("right")))
    whole = classes.where("n > 1").select("gram", "ctx", F.col("left").alias("a"), F.col("right").alias("b"))
    several = written(classes.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select("gram"))
    needed = classes.join(several, "gram").select("gram", "ctx", "one.*")
    suffixes = written(_contexts(docs, needed, width, gram), 500)
    dealt = lambda df, *by: df.repartitionByRange(max(1, -(-df.count() // bucket)), *by)
    with _few_samples(docs.sparkSession):
        found = written(_sorted_buckets(dealt(suffixes, "after", "before"), width, gram))
        edges = found.where("low IS NOT NULL")
        crossed = written(_across(dealt(edges, "gram", "before"), width, gram))
    strings = crossed.where("string IS NOT NULL").groupBy("string").agg(F.sum("n").alias("n"), F.collect_list(F.when(F.col("n") == 1, F.struct("gram", "ctx", "a", "b"))).alias("of"))
    met = strings.where("n > 1").select(F.explode("of").alias("x")).select("x.*")
    reach = whole.unionByName(found.where("low IS NULL").select("gram", "ctx", "a", "b")).unionByName(crossed.where("string IS NULL").select("gram", "ctx", "a", "b")).unionByName(met)
    return written(reach.groupBy("gram", "ctx").agg(F.max("a").alias("a"), F.max("b").alias("b")))


def remove(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET) -> DataFrame:
    """doc_id, n_bytes, spans (start, end of each run of bytes that repeated strings cover, in bytes) and kept (the other bytes) of each row.

    width: bytes of a string whose repeats count, above gram (a power of two). What is removed is settled on the input, not on what is left.
    """
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    own = own.withColumns({name: of(F.col("doc_id"), F.col("text")) for name, of in _OWN.items()})
    found = written(tokens(own.select("h1", "h2", "text"), width, gram), 500)
    often = written(found.groupBy("gram").agg(F.sum("n").alias("n")).where("n > 1").select("gram"))
    kept = written(found.join(often, "gram", "left_semi"))
    reach = _reaches(own.select("h1", "h2", "text"), kept, width, gram, bucket)
    covered = kept.join(reach, ["gram", "ctx"]).select("h1", "h2", F.struct((F.col("first") - F.col("a")).alias("start"), (F.col("last") + F.col("b")).alias("end")).alias("span"))
    covered = covered.groupBy("h1", "h2").agg(F.collect_set("span").alias("spans"))

    def run(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                part = batch.slice(k, 256)
                n, spans, left = [], [], []
                for text, some in zip(part.column("text").cast(pa.binary()).to_pylist(), part.column("spans").to_pylist()):
                    runs = merged(some or ())
                    cuts = [0, *[x for r in runs for x in r], len(text)]
                    n.append(len(text))
                    spans.append([{"start": a, "end": b} for a, b in runs])
                    left.append(b"".join(text[a:b] for a, b in zip(cuts[::2], cuts[1::2])))
                kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n, pa.int64()), pa.array(spans, kind), pa.array(left, pa.binary())], ["doc_id", "n_bytes", "spans", "kept"])

    return own.join(covered, ["h1", "h2"], "left").select("doc_id", "text", "spans").mapInArrow(run, "doc_id long, n_bytes long, spans array<struct<start: int, end: int>>, kept binary")


def merged(spans) -> list[tuple[int, int]]:
    """Spans put together where they touch, in order."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((s["start"], s["end"]) for s in spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out
