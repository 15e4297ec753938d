"""Language-model scoring with a log-frequency Bloom filter.

Training texts give counts of words, of word pairs and of word triples. A count c is quantised to the level 1 + floor(log2 c), and the
filter holds each n-gram at every level up to its own; a count is read back by probing the levels upwards until one is missing, so a
false positive can only raise it, by a level at a time. Triples that occur once are counted but not kept, as is usual for the longest
n-grams; the filter also holds, for each pair, how often kept triples begin with it.

A word's probability mixes its share among all words, then after the word before it, then after the two before it, each with a
pseudo-count for the shorter history. Counts of n-grams are read as the least that their level allows and counts of histories as the
most, and no n-gram counts more than its parts, so that the probabilities of all words after a history sum to at most 1; only false
positives (some 2 % of the n-grams asked for and not there) can add to it.

Building: triples are counted for each chunk of tokens and dealt to shards by the hash of their first pair, which gives that pair's count
too; words are dealt by their own hash. A shard merges its n-grams and sets the bits of its own segment of the filter, so that nobody
holds all n-grams. A segment has BITS_EACH bits for each entry, whatever the corpus. A filter of at most MAX_BITS is broadcast. A larger
one stays where it is: texts are put into chunks, a chunk's distinct n-grams go to the segments (a pair once, in 4 bytes, with 4 bytes for
each word that follows it), a byte for each level comes back, and the texts, kept compressed, are read again for the places of their
n-grams. The scores are the same.

The base score needs exact counts of every word. At most FREQUENT words, the most frequent ones, are broadcast; all other words of a
text are joined with the table of counts.

N-grams of a shard must fit in a task: there is a shard for every SHARD_BYTES of training text, and at least four for each of
spark.sql.shuffle.partitions. Within a shard pairs and triples go by 32 bits each of their hashes; that two share them is far rarer than
a false positive.

Defined cases: null and empty text is one end token; null ids count as training text; repeated rows are counted and scored each; an
empty table gives an empty result; with no training text counts are 0, N is 0 and V is 0. Very long texts are read whole, each as a
chunk of its own. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.shared import WordHashes, partitions, words_of, written

MAX_BITS, BITS_EACH, LEAST_BITS = 2**30, 8, 2**10
FREQUENT = 1_000_000
#: Pseudo-counts with which the shorter history weighs in after one word and after two.
AFTER_ONE, AFTER_TWO = 5.0, 1.0
CHUNK = 1_000_000
SHARD_BYTES = 2**24
ARROW_ROWS = 500
#: Characters of a chunk of texts whose n-grams are asked for together, and chunks of an Arrow batch.
CHUNK_CHARACTERS, CHUNK_ROWS = 2**22, 8
#: Rows of what chunks ask a shard for that are answered at a time.
ASKED_ROWS = 50
END = np.uint64(xxhash.xxh3_64_intdigest(b"\n"))  # no word holds a line feed
_M1, _M2, _PAIR = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_ONE, _LOW = np.uint64(1), np.uint64(0xFFFFFFFF)
_HALF = np.uint64(32)


_squeeze, _restore = zstandard.ZstdCompressor(level=1, write_checksum=False).compress, zstandard.ZstdDecompressor().decompress


def squeezed(x: np.ndarray, ascending: bool = False) -> bytes:
    """Integers as compressed bytes, those of equal weight together; ascending ones by their differences."""
    if not len(x):
        return b""
    if ascending:
        x = np.diff(x, prepend=x.dtype.type(0))
    return _squeeze(np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes())


def restored(data: bytes, kind: type, ascending: bool = False) -> np.ndarray:
    if not data:
        return np.zeros(0, kind)
    x = np.ascontiguousarray(np.frombuffer(_restore(data), np.uint8).reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()
    return np.cumsum(x, dtype=kind) if ascending else x


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


def pairs(history: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hashes of word pairs, other than those of words."""
    return mixed(history * _PAIR + word)


def singles(word: np.ndarray) -> np.ndarray:
    return mixed(word ^ _PAIR)


def tokens(text: str | None, hashes: WordHashes) -> np.ndarray:
    return np.append(hashes.of(words_of(text)), END)


def before(each: list[np.ndarray], flat: np.ndarray, first: np.uint64) -> np.ndarray:
    """What stands before each token; before a text's first, `first`."""
    out = np.empty_like(flat)
    out[1:] = flat[:-1]
    out[np.cumsum([0, *map(len, each[:-1])])] = first
    return out


#: The pair before a text's first token: no other, END after END is that of a text without words.
START = pairs(np.array([~END]), np.array([END]))[0]


def _bits(shards: int) -> int:
    return shards.bit_length() - 1


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - _bits(shards))).astype(np.int64) if shards > 1 else np.zeros(len(hashes), np.int64)


def pair_keys(pair: np.ndarray, shards: int) -> np.ndarray:
    """The 32 bits of pairs' hashes that follow those of their shard."""
    return (pair >> np.uint64(32 - _bits(shards))) & _LOW


def triple_keys(pair: np.ndarray, word: np.ndarray, shards: int) -> np.ndarray:
    """A pair's key and 32 bits for the word after it."""
    return (pair_keys(pair, shards) << _HALF) | (mixed(pair * _M2 + word) >> _HALF)


def pair_grams(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ _M1)


def history_grams(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ _M2)


def triple_grams(keys: np.ndarray) -> np.ndarray:
    return mixed(keys ^ _PAIR)


def _packer(shards: int):
    def packed(each):
        flat = np.concatenate(each)
        pair = pairs(before(each, flat, END), flat)
        # the pair before each token, and for each text's last pair one more triple that begins with it
        last = np.cumsum([len(x) for x in each]) - 1
        first = np.concatenate([before(each, pair, START), pair[last]])
        word = np.concatenate([flat, np.full(len(each), END)])
        made: dict[int, list] = {}
        for k, home, keys in ((0, shard_of(flat, shards), flat), (2, shard_of(first, shards), triple_keys(first, word, shards))):
            order = np.argsort(home, kind="stable")
            home, keys = home[order], keys[order]
            which, starts = np.unique(home, return_index=True)
            for shard, part in zip(which.tolist(), np.split(keys, starts[1:])):
                found, n = np.unique(part, return_counts=True)
                row = made.setdefault(shard, [b"", b"", b"", b""])
                row[k], row[k + 1] = squeezed(found, True), squeezed(n.astype(np.uint32))
        columns = zip(*made.values())
        return pa.RecordBatch.from_arrays([pa.array(list(made), pa.int32()), *[pa.array(list(c), pa.binary()) for c in columns]], ["shard", "words", "word_counts", "triples", "triple_counts"])

    def run(batches):
        hashes, each, size = WordHashes(), [], 0
        for batch in batches:
            for text in batch.column(0):
                each.append(tokens(text.as_py(), hashes))
                size += len(each[-1])
                if size >= CHUNK:
                    yield packed(each)
                    each, size = [], 0
        if each:
            yield packed(each)

    return run


def _merged(keys: pa.ChunkedArray, counts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    k = np.concatenate([restored(x.as_py(), np.uint64, True) for x in keys])
    n = np.concatenate([restored(x.as_py(), np.uint32) for x in counts])
    if not len(k):
        return k, n.astype(np.int64)
    order = np.argsort(k, kind="stable")
    k, n = k[order], n[order]
    starts = np.flatnonzero(np.append(True, k[1:] != k[:-1]))
    return k[starts], np.add.reduceat(n, starts, dtype=np.int64)


def levels(counts: np.ndarray) -> np.ndarray:
    return np.frexp(counts.astype(float))[1]  # 1 + floor(log2 c)


def least_at(level: np.ndarray) -> np.ndarray:
    """The least count that has a level."""
    return np.where(level > 0, np.exp2(level - 1.0), 0.0)


def most_at(level: np.ndarray) -> np.ndarray:
    """The largest count that has a level."""
    return np.exp2(level.astype(float)) - 1


def segment(grams: np.ndarray, counts: np.ndarray, most_bits: int | None = None) -> tuple[bytes, int, int]:
    """A shard's bits, their number (a multiple of 64) and the number of probes an entry has. Only a caller who says so gets fewer bits."""
    level = levels(counts)
    entries = int(level.sum())
    bits = max(LEAST_BITS, -(-BITS_EACH * entries // 64) * 64)
    if most_bits:
        bits = min(bits, most_bits)
    if bits >= 2**32:
        raise ValueError(f"{entries} entries are too many for one segment; make SHARD_BYTES smaller")
    probes = max(1, min(4, round(bits / max(entries, 1) * math.log(2))))
    held = np.zeros(bits, bool)
    for j in range(1, int(level.max(initial=0)) + 1):
        at = grams[level >= j]
        first, step = places(at, j)
        for _ in range(probes):
            held[_within(first, np.uint64(bits)).astype(np.int64)] = True
            first = first + step
    return np.packbits(held, bitorder="little").tobytes(), bits, probes


def places(grams: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
    """A hash for the first place of each n-gram at a level, and the step from probe to probe."""
    first = mixed(grams + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % 2**64))
    return first, (first << _HALF) | _ONE


def _within(hashes: np.ndarray, bits: np.ndarray | np.uint64) -> np.ndarray:
    """Hashes as places from 0 to bits - 1, by their upper halves."""
    return ((hashes >> _HALF) * bits) >> _HALF


def _made_shard(table: pa.Table) -> pa.Table:
    words, n = _merged(table.column("words"), table.column("word_counts"))
    triples, m = _merged(table.column("triples"), table.column("triple_counts"))
    starts = np.flatnonzero(np.append(True, triples[1:] >> _HALF != triples[:-1] >> _HALF)) if len(triples) else np.zeros(0, np.int64)
    begins = triples[starts] >> _HALF
    kept = m > 1
    read = np.where(kept, least_at(levels(m)), 0)
    in_pair, in_kept = (np.add.reduceat(x, starts) if len(starts) else np.zeros(0) for x in (m, read))
    grams = np.concatenate([singles(words), pair_grams(begins), history_grams(begins[in_kept > 0]), triple_grams(triples[kept])])
    held, bits, probes = segment(grams, np.concatenate([n, in_pair, in_kept[in_kept > 0], m[kept] // 2]))
    return pa.table({"shard": table.column("shard")[:1], "words": pa.array([words.tobytes()], pa.binary()), "counts": pa.array([n.tobytes()], pa.binary()), "n_words": pa.array([len(words)]), "n_tokens": pa.array([int(n.sum())]), "n_pairs": pa.array([len(begins)]), "bits": pa.array([bits]), "probes": pa.array([probes]), "held": pa.array([held], pa.binary())})


class Filter:
    """The shards' segments in one array. A shard holds the words, and the pairs with what begins with them, whose hash begins with its bits."""

    def __init__(self, parts: list[tuple[int, int, int, bytes]], shards: int):
        bits, self.probes, self.start = np.full(shards, LEAST_BITS, np.uint64), np.ones(shards, np.int64), np.zeros(shards, np.uint64)
        held, at = [], 0
        for shard, b, probes, data in sorted(parts):
            bits[shard], self.probes[shard], self.start[shard] = b, probes, at
            held.append(data)
            at += b
        held.append(bytes(LEAST_BITS // 8))
        for shard in set(range(shards)) - {p[0] for p in parts}:
            self.start[shard] = at
        self.bits, self.bytes, self.shards = bits, b"".join(held), shards

    def shard(self, hashes: np.ndarray) -> np.ndarray:
        return shard_of(hashes, self.shards)

    def level(self, grams: np.ndarray, shard: np.ndarray) -> np.ndarray:
        """The level of each n-gram: probes go up until one misses."""
        held = np.frombuffer(self.bytes, np.uint8)
        out = np.zeros(len(grams), np.int64)
        at = np.arange(len(grams))
        start, bits, probes = self.start[shard], self.bits[shard], self.probes[shard]
        for j in range(1, 63):
            first, step = places(grams, j)
            for i in range(int(probes.max(initial=0))):
                place = _within(first, bits) + start
                hit = ((held[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1).view(bool) | (probes <= i)
                if not hit.all():
                    at, grams, start, bits, probes, first, step = (x[hit] for x in (at, grams, start, bits, probes, first, step))
                first = first + step
            if not len(at):
                break
            out[at] = j
        return out


def _fit(docs: DataFrame) -> tuple[DataFrame, int]:
    """One row for each shard: its words with counts, and its segment of the filter."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = 1 << max(4, (max(4 * partitions(docs.sparkSession), -(-size // SHARD_BYTES)) - 1).bit_length())
    packed = docs.select("text").mapInArrow(_packer(shards), "shard int, words binary, word_counts binary, triples binary, triple_counts binary")
    return packed.groupBy("shard").applyInArrow(_made_shard, "shard int, words binary, counts binary, n_words long, n_tokens long, n_pairs long, bits long, probes long, held binary"), shards


def _unpacked(least: int):
    def run(batches):
        for batch in batches:
            for words, counts in zip(batch.column(0), batch.column(1)):
                w, n = np.frombuffer(words.as_py(), np.int64), np.frombuffer(counts.as_py(), np.int64)
                for k in range(0, len(w), 500_000):
                    fits = n[k : k + 500_000] >= least
                    yield pa.RecordBatch.from_arrays([pa.array(w[k : k + 500_000][fits]), pa.array(n[k : k + 500_000][fits])], ["word", "c"])

    return run


def _spread(batches):
    """How many words have each level of count."""
    for batch in batches:
        for counts in batch.column(0):
            level, n = np.unique(levels(np.frombuffer(counts.as_py(), np.int64)), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(level, pa.int32()), pa.array(n, pa.int64())], ["level", "n"])


def least_frequent(shards: DataFrame, most: int) -> int:
    """The least count (a power of two) that at most `most` words reach."""
    spread = shards.select("counts").mapInArrow(_spread, "level int, n long").groupBy("level").agg(F.sum("n").alias("n")).collect()
    total, least = 0, 2**62
    for level, n in sorted(map(tuple, spread), reverse=True):
        total += n
        if total > most:
            break
        least = 2 ** (level - 1)
    return least


_SCORED = "doc_id long, n_tokens long, n_known long, base_score double, score double, rare array<long>, rare_n array<long>"
_ASKED = ("words", "pairs", "followers", "followed")
_ASKED_AS = tuple(zip(_ASKED, (np.uint64, np.uint32, np.uint32, np.uint32), (True, True, False, False)))
_LEVELS = ("words", "pairs", "histories", "triples")


def _chunked(batches):
    """Rows of chunks: the ids, the sizes and, compressed, the texts of some documents."""

    def made(ids, texts):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        return pa.RecordBatch.from_arrays(
            [pa.array([ids], pa.list_(pa.int64())), pa.array([list(map(len, raw))], pa.list_(pa.int64())), pa.array([zstandard.compress(b"".join(raw))], pa.binary())], ["doc_ids", "sizes", "texts"]
        )

    ids, texts, size = [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0), batch.column(1)):
            ids.append(doc_id.as_py())
            texts.append(text.as_py() or "")
            size += len(texts[-1])
            if size >= CHUNK_CHARACTERS:
                yield made(ids, texts)
                ids, texts, size = [], [], 0
    if ids:
        yield made(ids, texts)


def _texts_of(sizes: list[int], texts: bytes) -> list[str]:
    raw, ends = zstandard.decompress(texts), np.cumsum(sizes).tolist()
    return [raw[end - n : end].decode("utf-8", "surrogatepass") for n, end in zip(sizes, ends)]


class Grams:
    """The distinct words, pairs and triples of a chunk, in the order of the hashes by which they are dealt, so that shards are runs; and
    for each token their places."""

    def __init__(self, each: list[np.ndarray]):
        flat = np.concatenate(each)
        self.words, self.word_at = np.unique(flat, return_inverse=True)
        pair = pairs(before(each, flat, END), flat)
        self.pairs, at = np.unique(np.append(pair, START), return_inverse=True)
        self.pair_at, start = at[:-1], at[-1]
        self.first_at = before(each, self.pair_at, start)
        word = mixed(self.pairs[self.first_at] * _M2 + flat) >> _HALF
        self.triples, self.triple_at = np.unique(self.first_at.astype(np.uint64) << _HALF | word, return_inverse=True)

    def asked(self, chunk: int, shards: int) -> pa.RecordBatch:
        """A row for each shard that has some of them: words, pairs, and for each pair how many words follow it, and which."""
        of_word, of_pair = shard_of(self.words, shards), shard_of(self.pairs, shards)
        found = np.union1d(of_word, of_pair)
        of_triple = (self.triples >> _HALF).astype(np.int64)
        followers = np.bincount(of_triple, minlength=len(self.pairs)).astype(np.uint32)
        cut = lambda x, at, ascending=False: [squeezed(part, ascending) for part in np.split(x, at[1:])]
        of_pairs = np.searchsorted(of_pair, found)
        parts = (cut(self.words, np.searchsorted(of_word, found), True), cut(pair_keys(self.pairs, shards).astype(np.uint32), of_pairs, True), cut(followers, of_pairs), cut((self.triples & _LOW).astype(np.uint32), np.searchsorted(of_triple, of_pairs)))
        return pa.RecordBatch.from_arrays([pa.array([chunk] * len(found), pa.int64()), pa.array(found, pa.int32()), *[pa.array(x, pa.binary()) for x in parts]], ["chunk", "shard", *_ASKED])


def _asker(shards: int):
    def run(batches):
        hashes = WordHashes()
        for batch in batches:
            for chunk, sizes, texts in zip(*map(batch.column, range(3))):
                each = [tokens(t, hashes) for t in _texts_of(sizes.as_py(), texts.as_py())]
                yield Grams(each).asked(chunk.as_py(), shards)

    return run


def _probed(asked: pa.Table, held: pa.Table) -> pa.Table:
    """The levels, a byte each, of the n-grams that chunks ask a shard for; 0 where the shard has no segment."""
    made = Filter([(0, held.column("bits")[0].as_py(), held.column("probes")[0].as_py(), held.column("held")[0].as_py())], 1) if held.num_rows else None
    level = lambda grams: (made.level(grams, np.zeros(len(grams), np.int64)) if made else np.zeros(len(grams))).astype(np.uint8)
    out: dict[str, list[bytes]] = {name: [] for name in _LEVELS}
    for k in range(0, asked.num_rows, ASKED_ROWS):  # many short arrays at a time
        each = [[restored(x.as_py(), kind, rises) for x in asked.column(name).slice(k, ASKED_ROWS)] for name, kind, rises in _ASKED_AS]
        words, key, followers, followed = map(np.concatenate, each)
        key = key.astype(np.uint64)
        both, history = level(pair_grams(key)), np.zeros(len(key), np.uint8)
        some = np.flatnonzero(both > 1)  # only a pair that occurs again begins a triple that is kept
        history[some] = level(history_grams(key[some]))
        of = np.repeat(np.arange(len(key)), followers)
        triple = np.zeros(len(of), np.uint8)
        some = np.flatnonzero(history[of] > 0)
        triple[some] = level(triple_grams(key[of[some]] << _HALF | followed[some].astype(np.uint64)))
        for name, x, like in zip(_LEVELS, (level(singles(words)), both, history, triple), (each[0], each[1], each[1], each[3])):
            out[name] += [squeezed(part) for part in np.split(x, np.cumsum(list(map(len, like)))[:-1])]
    return pa.table({"chunk": asked.column("chunk"), "shard": asked.column("shard"), **{name: pa.array(x, pa.binary()) for name, x in out.items()}})


def _by_levels(grams: Grams, found: pa.Table, below: float) -> np.ndarray:
    """log10 of each token's probability after the tokens before it, from the levels that came back."""
    found = found.sort_by("shard")
    word, both, history, triple = (np.concatenate([restored(x.as_py(), np.uint8) for x in found.column(name)]).astype(np.int64) for name in _LEVELS)
    word = word[grams.word_at]
    # the last token is END, which the first follows
    return log_probability(word, np.roll(word, 1), both[grams.pair_at], history[grams.first_at], triple[grams.triple_at], below)


def _rows(ids: pa.Array, each: list[np.ndarray], top_words: np.ndarray, top_counts: np.ndarray, below: float, model) -> pa.RecordBatch:
    """What is known of some texts from the frequent words, their rare words, and the sums of `model`, by token."""
    flat = np.concatenate(each)
    size = np.array(list(map(len, each)))
    doc = np.repeat(np.arange(len(each)), size)
    words, inverse = np.unique(flat, return_inverse=True)
    c = _counts_of(words, top_words, top_counts)
    log_c = np.log10((c + 0.5) / below)[inverse]
    seen = (c > 0)[inverse]
    base = np.bincount(doc[seen], log_c[seen], len(each)).astype(float)
    rare = [np.unique(flat[x:y][~seen[x:y]], return_counts=True) for x, y in zip(np.cumsum(size) - size, np.cumsum(size))]
    return pa.RecordBatch.from_pydict({
        "doc_id": ids, "n_tokens": pa.array(size, pa.int64()), "n_known": pa.array(np.bincount(doc[seen], minlength=len(each)), pa.int64()),
        "base_score": pa.array(base), "score": pa.array(np.bincount(doc, model(flat, words, inverse), len(each)), pa.float64()),
        "rare": pa.array([r.view(np.int64) for r, _ in rare], pa.list_(pa.int64())), "rare_n": pa.array([n for _, n in rare], pa.list_(pa.int64())),
    })


def score(docs: DataFrame, train=None, max_bits: int = MAX_BITS, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_tokens, n_known, train_tokens, base_score, score of each row; `train` says which rows to learn from (default all).

    A filter of more than `max_bits` is not broadcast; the scores do not depend on it."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    fitted, n_shards = _fit(docs if train is None else docs.where(train))
    shards = written(fitted, ARROW_ROWS)
    total, known, bits = shards.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("n_tokens", "n_words", "bits")]).first()
    least = least_frequent(shards, frequent)
    top = shards.select("words", "counts").mapInArrow(_unpacked(least), "word long, c long").toArrow()
    top_words, top_counts = top.column("word").to_numpy().view(np.uint64), top.column("c").to_numpy()
    order = np.argsort(top_words)
    segments = shards.select("shard", "bits", "probes", "held")
    made = Filter([tuple(r) for r in segments.toLocalIterator()], n_shards) if bits <= max_bits else None
    sent = spark.sparkContext.broadcast((top_words[order], top_counts[order], made))
    below = total + 0.5 * (known + 1)

    def run(batches):
        top_words, top_counts, made = sent.value
        hashes = WordHashes()
        for batch in batches:
            for a, b in _spans([len(t.as_py() or "") for t in batch.column(1)]):
                each = [tokens(t.as_py(), hashes) for t in batch.column(1).slice(a, b - a)]
                yield _rows(batch.column(0).slice(a, b - a), each, top_words, top_counts, below, lambda flat, words, inverse: _by_filter(made, each, flat, words, inverse, below))

    def summed(chunk: pa.Table, found: pa.Table) -> pa.Table:
        top_words, top_counts, _ = sent.value
        hashes = WordHashes()
        each = [tokens(t, hashes) for t in _texts_of(chunk.column("sizes")[0].as_py(), chunk.column("texts")[0].as_py())]
        ids = pa.array(chunk.column("doc_ids")[0].as_py(), pa.int64())
        return pa.Table.from_batches([_rows(ids, each, top_words, top_counts, below, lambda *_: _by_levels(Grams(each), found, below))])

    if made is not None:
        scored = docs.mapInArrow(run, _SCORED)
    else:
        chunks = docs.mapInArrow(_chunked, "doc_ids array<long>, sizes array<long>, texts binary").withColumn("chunk", F.monotonically_increasing_id())
        chunks = written(chunks, ARROW_ROWS)
        asked = chunks.select("chunk", "sizes", "texts").mapInArrow(_asker(n_shards), "chunk long, shard int, " + ", ".join(f"{x} binary" for x in _ASKED))
        found = asked.groupBy("shard").cogroup(segments.groupBy("shard")).applyInArrow(_probed, "chunk long, shard int, " + ", ".join(f"{x} binary" for x in _LEVELS))
        scored = chunks.groupBy("chunk").cogroup(found.groupBy("chunk")).applyInArrow(summed, _SCORED)
    scored = written(scored.withColumn("row", F.monotonically_increasing_id()), ARROW_ROWS if made is not None else CHUNK_ROWS)
    rare = scored.select("row", F.explode(F.arrays_zip("rare", "rare_n")).alias("x")).select("row", F.col("x.rare").alias("word"), F.col("x.rare_n").alias("n"))
    counts = shards.select("words", "counts").mapInArrow(_unpacked(0), "word long, c long").where(F.col("c") < least)
    each = rare.join(counts, "word", "left").select("row", "n", F.coalesce("c", F.lit(0)).alias("c"))
    more = each.groupBy("row").agg(F.sum(F.col("n") * F.log10((F.col("c") + 0.5) / F.lit(below))).alias("more"), F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more_known"))
    out = scored.select("row", "doc_id", "n_tokens", "n_known", "base_score", "score").join(more, "row", "left")
    return out.select("doc_id", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), "score")


def _by_filter(made: Filter, each: list[np.ndarray], flat: np.ndarray, words: np.ndarray, inverse: np.ndarray, below: float) -> np.ndarray:
    """log10 of each token's probability after the tokens before it, from the filter's levels."""
    single = made.level(singles(words), made.shard(words))
    last = before(each, inverse, np.searchsorted(words, END))
    pair = pairs(before(each, flat, END), flat)
    first = before(each, pair, START)
    both = made.level(pair_grams(pair_keys(pair, made.shards)), made.shard(pair))
    # only a pair that occurs again begins a triple that is kept, and only such a pair ends one
    start = made.level(pair_grams(pair_keys(np.array([START]), made.shards)), made.shard(np.array([START])))[0]
    history, triple = np.zeros(len(flat), np.int64), np.zeros(len(flat), np.int64)
    some = np.flatnonzero(before(each, both, start) > 1)
    history[some] = made.level(history_grams(pair_keys(first[some], made.shards)), made.shard(first[some]))
    some = np.flatnonzero((history > 0) & (both > 1))
    triple[some] = made.level(triple_grams(triple_keys(first[some], flat[some], made.shards)), made.shard(first[some]))
    return log_probability(single[inverse], single[last], both, history, triple, below)


def log_probability(word: np.ndarray, last: np.ndarray, both: np.ndarray, history: np.ndarray, triple: np.ndarray, below: float) -> np.ndarray:
    """log10 of probabilities from the levels of words, of the words before them, of both together, of what kept triples hold of the two words
    before (levels of a sum), and of the triples (levels of half their count)."""
    alone = (least_at(word) + 0.5) / below
    after = most_at(last)
    after_one = (np.minimum(least_at(both), after) + AFTER_ONE * alone) / (after + AFTER_ONE)
    held = np.where((history > 0) & (both > 1), 2 * least_at(triple), 0.0)
    held = np.minimum(held, most_at(history))
    return np.log10(np.where(history > 0, (held + AFTER_TWO * after_one) / (most_at(history) + AFTER_TWO), after_one))


def _spans(sizes: list[int], most: int = 2_000_000) -> list[tuple[int, int]]:
    """Runs of rows whose texts have about `most` characters together."""
    out, a, total = [], 0, 0
    for k, n in enumerate(sizes):
        total += n
        if total >= most:
            out.append((a, k + 1))
            a, total = k + 1, 0
    return out + ([(a, len(sizes))] if a < len(sizes) else [])


def _counts_of(words: np.ndarray, known: np.ndarray, counts: np.ndarray) -> np.ndarray:
    if not len(known):
        return np.zeros(len(words), np.int64)
    at = np.minimum(np.searchsorted(known, words), len(known) - 1)
    return np.where(known[at] == words, counts[at], 0)
