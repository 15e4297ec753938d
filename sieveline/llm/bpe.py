"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The library's vocabulary is made of characters, one for each byte; its merges are recovered from the ranks once on the driver and
sent to the workers as one serialised tokenizer (its size is that of the vocabulary). Each match of the pattern is merged apart from
the others. Texts are encoded in chunks of bounded size: a long text is cut where a blank follows a character that is no white
space, which is always a boundary between two matches, so the ids don't change.

Defined cases: null text counts as empty: no ids, decoded to nothing. Special tokens don't exist: their strings are ordinary text.
decode() gives bytes; characters split between tokens come together again, and a sequence that ends within one keeps its bytes.
Repeated rows and null ids give a row each.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Regex, Tokenizer, models, pre_tokenizers

_CHUNK = 200_000
#: Segments remembered by a worker, none of them longer than 64 characters.
_KNOWN = 600_000
_CUT = regex.compile(r"(?<=\S) ")
_CUTS = regex.compile(r"(?<=\S)(?= )", regex.V1)
_NO_CUT = regex.compile(r"\s ")


def byte_chars() -> list[str]:
    """The character that stands for each byte: itself if it prints, else one from U+0100 on, in order."""
    prints = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = iter(range(0x100, 0x200))
    return [chr(b if b in prints else next(others)) for b in range(256)]


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def _last_pair(token: bytes, ranks: dict[bytes, int]) -> tuple[bytes, bytes] | None:
    """The two parts that the merges below the token's own rank leave of it."""
    parts, limit = [token[i : i + 1] for i in range(len(token))], ranks[token]
    while len(parts) > 2:
        rank, k = min((ranks.get(a + b, limit), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank >= limit:
            return None
        parts[k : k + 2] = [parts[k] + parts[k + 1]]
    return (parts[0], parts[1]) if len(parts) == 2 else None


def tokenizer(ranks: dict[bytes, int], pattern: str) -> Tokenizer:
    chars = byte_chars()
    text = lambda token: "".join(chars[b] for b in token)
    pairs = [p for token in sorted(ranks, key=ranks.get) if len(token) > 1 and (p := _last_pair(token, ranks))]
    made = Tokenizer(models.BPE(vocab={text(t): r for t, r in ranks.items()}, merges=[(text(a), text(b)) for a, b in pairs], ignore_merges=True))
    made.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return made


def chunks(text: str, size: int = _CHUNK) -> Iterator[str]:
    """The text in pieces of about `size` characters, cut between matches of the pattern only."""
    at = 0
    while len(text) - at > size and (m := _CUT.search(text, at + size)):
        yield text[at : m.start()]
        at = m.start()
    yield text[at:]


def segments(text: str) -> list[str]:
    """The text cut before each blank that follows a character that is no white space."""
    if _NO_CUT.search(text):
        return _CUTS.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + s for s in rest]]


class Codec:
    def __init__(self, state: str):
        self.known: dict[str, bytes] = {}
        self.made = Tokenizer.from_str(state)
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        vocab = self.made.get_vocab()
        self.bytes_of: list[bytes] = [b""] * (max(vocab.values()) + 1)
        for token, k in vocab.items():
            self.bytes_of[k] = bytes(byte_of[c] for c in token)

    def encode_all(self, texts: list[str | None]) -> Iterator[bytes]:
        """Each text's ids, as little-endian unsigned 32-bit integers. Segments between safe cuts repeat; each is encoded once."""
        held, size = [], 0
        for text in texts:
            if text and len(text) > _CHUNK:
                yield from self._encode(held)
                held, size = [], 0
                yield b"".join(x for piece in chunks(text) for x in self._encode([piece]))
                continue
            held.append(text or "")
            size += len(held[-1])
            if size > _CHUNK:
                yield from self._encode(held)
                held, size = [], 0
        yield from self._encode(held)

    def _encode(self, texts: list[str]) -> list[bytes]:
        known, found = self.known, [segments(t) for t in texts]
        if len(known) > _KNOWN:
            known.clear()
        new = [s for s in dict.fromkeys(s for x in found for s in x) if s not in known]
        # Segments that a blank begins and no white space ends stay apart in one joined text.
        known |= self._apart([s for s in new if s[:1] == " " and not s[-1].isspace()])
        for s in new:
            if s not in known:
                known[s] = np.array(self.made.encode(s, add_special_tokens=False).ids, "<u4").tobytes()
        out = [b"".join(map(known.__getitem__, x)) for x in found]
        for s in new:
            if len(s) > 64:
                del known[s]
        return out

    def _apart(self, new: list[str]) -> dict[str, bytes]:
        made = self.made.encode("".join(new), add_special_tokens=False)
        ids = np.array(made.ids, "<u4")
        ends = np.cumsum([len(s) for s in new])
        starts = np.array([a for a, _ in made.offsets], np.int64)
        cuts = [0, *np.searchsorted(starts, ends).tolist()]
        return {s: ids[a:b].tobytes() for s, a, b in zip(new, cuts, cuts[1:])}

    def offsets(self, text: str | None) -> list[tuple[int, int]]:
        """For each id, the code points that its bytes lie in: start, end."""
        out, at = [], 0
        for piece in chunks(text or ""):
            out += [(a + at, b + at) for a, b in self.made.encode(piece, add_special_tokens=False).offsets]
            at += len(piece)
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.bytes_of.__getitem__, ids))


@lru_cache(1)
def _codec(state: str) -> Codec:
    """One for each worker, so that segments stay known from task to task."""
    return Codec(state)


def _sent(docs: DataFrame, path: str, pattern: str):
    return docs.sparkSession.sparkContext.broadcast(tokenizer(read_ranks(path), pattern).to_str())


def _small(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(0, batch.num_rows, 256):
            yield batch.slice(k, 256)


def encode(docs: DataFrame, path: str, pattern: str, offsets: bool = False) -> DataFrame:
    """doc_id, ids (array of int), and with `offsets` starts and ends in code points, for each row of docs."""
    sent = _sent(docs, path, pattern)

    def run(batches):
        codec = _codec(sent.value)
        for batch in _small(batches):
            texts = batch.column(1).to_pylist()
            cols = {"doc_id": batch.column(0), "ids": pa.array([np.frombuffer(ids, "<i4") for ids in codec.encode_all(texts)], pa.list_(pa.int32()))}
            if offsets:
                spans = [codec.offsets(t) for t in texts]
                cols |= {name: pa.array([[x[k] for x in s] for s in spans], pa.list_(pa.int32())) for k, name in enumerate(("starts", "ends"))}
            yield pa.RecordBatch.from_pydict(cols)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, ids array<int>" + ", starts array<int>, ends array<int>" * offsets)


def decode(encoded: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, bytes and text of each row's ids; in text, what is no UTF-8 becomes U+FFFD. Null ids count as none."""
    sent = _sent(encoded, path, pattern)

    def run(batches):
        codec = _codec(sent.value)
        for batch in _small(batches):
            raw = [codec.decode(ids or ()) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "bytes": pa.array(raw, pa.binary()), "text": pa.array([b.decode("utf-8", "replace") for b in raw], pa.string())})

    return encoded.select(F.col("doc_id").cast("long"), "ids").mapInArrow(run, "doc_id long, bytes binary, text string")


def round_trip(docs: DataFrame, path: str, pattern: str, ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256, same (the decoded bytes are the text's), and `ids` if asked for, in one pass."""
    sent = _sent(docs, path, pattern)
    with_ids = ids

    def run(batches):
        codec = _codec(sent.value)
        for batch in _small(batches):
            texts, n, ids_sha, text_sha, same, found = batch.column(1).to_pylist(), [], [], [], [], []
            for text, ids in zip(texts, codec.encode_all(texts)):
                raw = codec.decode(np.frombuffer(ids, "<u4").tolist())
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(raw).hexdigest())
                same.append(raw == (text or "").encode())
                found.append(np.frombuffer(ids, "<i4") if with_ids else None)
            cols = {"doc_id": batch.column(0), "n_tokens": pa.array(n, pa.int64()), "ids_sha256": ids_sha, "decoded_sha256": text_sha, "same": same}
            yield pa.RecordBatch.from_pydict(cols | ({"ids": pa.array(found, pa.list_(pa.int32()))} if with_ids else {}))

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string, same boolean" + ", ids array<int>" * with_ids)
