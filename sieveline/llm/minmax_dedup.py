"""MinHash near-dedup by min-max hashing.

Every hash evaluation gives two signature values, its minimum and its maximum over a document's shingles, so 64 evaluations make
128 values. They are banded 4 by 4 into 32 bands, minima and maxima apart: at similarity 0.75 a link is missed by all bands with
probability (1 - 0.75^4)^32, about 5 in a million, and less above. Candidates are then confirmed on full shingle sets.

Plan: one pass computes signatures; equal sets fold into one class (the copies leave the work here); class bands are dealt into
buckets by aggregation. A bucket compares its members with one member only, the one that shares most buckets with others; a family of
near copies is put together by that star, whose members are dealt into parts of bounded size, each with the pivot's set beside it.
Buckets that still hold several groups are looked at again: the sets that met around one pivot are dealt into blocks, each two blocks
meet in a task of bounded size, and only links between groups leave it, so that none is lost and no pairs are written out. Components of
all links are found by alternating stars. Keys that many rows share (buckets, pivots, hubs of stars) don't bring their rows together:
what belongs to such a key is broadcast.

Defined cases: null, empty or blank text has no shingle (n_shingles 0), is linked with nothing and is kept. Rows that share a doc_id
count as one document: they share a component, and `deduplicate` keeps the one whose columns have the smallest hash. A null doc_id takes
no part in linking: component_id null, kept true. An empty table gives an empty result. Columns beyond doc_id and text are ignored by
`components` and returned unchanged by `deduplicate`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sieveline.llm.shared import HOT, WordHashes, join_by_key, runs_hash, words_of, written
from sieveline.operators.extract import fresh

WIDTH, SIMILAR = 5, 75
HASHES, BAND = 64, 4
#: Sets of a block, and shingles that the sets of a block should have at most; two blocks meet in a task.
BLOCK, BLOCK_SHINGLES = 128, 2**20
#: Repeated ids that are broadcast; more of them are joined.
MOST_BROADCAST = 100_000
_CHUNK = 8192
ARROW_ROWS = 500
_draw = np.random.default_rng(20240607)
_A = _draw.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _draw.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2)


def shingles(text: str | None, hashes: WordHashes) -> np.ndarray:
    """The sorted distinct hashes of a text's shingles of WIDTH words; with fewer words, of the whole sequence."""
    words = hashes.of(words_of(text))
    return np.unique(runs_hash(words, min(WIDTH, len(words)))) if len(words) else words


def min_max(found: np.ndarray) -> np.ndarray:
    """HASHES minima, then HASHES maxima, over blocks so that memory is bounded."""
    low, high = np.full(HASHES, 2**64 - 1, np.uint64), np.zeros(HASHES, np.uint64)
    for k in range(0, len(found), _CHUNK):
        hashed = found[None, k : k + _CHUNK] * _A[:, None] + _B[:, None]
        np.minimum(low, hashed.min(axis=1), out=low)
        np.maximum(high, hashed.max(axis=1), out=high)
    return np.concatenate([low, high])


def band_keys(signature: np.ndarray) -> np.ndarray:
    rows = signature.reshape(-1, BAND)
    out = np.arange(len(rows), dtype=np.uint64)
    for j in range(BAND):
        out = runs_hash(np.concatenate([out[:, None], rows[:, j : j + 1]], axis=1).ravel(), 2)[::2]
    return out


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many shingles each two sets share: products of incidence matrices, some thousand shared shingles at a time."""
    owner = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    _, token, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    token, kept = token.ravel(), (often > 1)[token.ravel()]
    place = np.cumsum(often > 1) - 1
    owner, token = owner[kept], place[token[kept]]
    out = np.zeros((len(sets), len(sets)))
    for k in range(0, int((often > 1).sum()), 4096):
        here = (token >= k) & (token < k + 4096)
        held = np.zeros((len(sets), 4096), np.float32)
        held[owner[here], token[here] - k] = 1
        out += held @ held.T
    return out


def _joined_up(table: pa.Table) -> pa.Table:
    """Links between the groups (labels) of a block's sets; of several that join the same groups, one."""
    nodes, labels = table.column("node").to_pylist(), table.column("label").to_pylist()
    out: list[tuple[int, int]] = []
    if len(set(labels)) > 1:
        sets = [x.values.to_numpy() for x in table.column("shingles")]
        size, common = np.array(list(map(len, sets))), _overlaps(sets)
        group = {x: x for x in labels}

        def of(x):
            while group[x] != x:
                group[x] = x = group[group[x]]
            return x

        for i, j in zip(*np.nonzero(np.triu(100 * common >= SIMILAR * (size[:, None] + size[None, :] - common), 1))):
            a, b = of(labels[i]), of(labels[j])
            if a != b:
                group[max(a, b)] = min(a, b)
                out.append((nodes[i], nodes[j]))
    return pa.table({"u": pa.array([u for u, _ in out], pa.int64()), "v": pa.array([v for _, v in out], pa.int64())})


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        size, ident, bands = [], [], []
        for text in batch.column(1):
            found = shingles(text.as_py(), hashes)
            size.append(len(found))
            ident.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
            bands.append(band_keys(min_max(found)).view(np.int64) if len(found) else None)
        pa.default_memory_pool().release_unused()
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size, pa.int64()), pa.array(ident, pa.binary()), pa.array(bands, pa.list_(pa.int64()))], ["doc_id", "n_shingles", "set_id", "bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes = WordHashes()
    for batch in batches:
        for k in range(0, batch.num_rows, 500):
            part = batch.slice(k, 500)
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array([shingles(t.as_py(), hashes).view(np.int64) for t in part.column(1)], pa.list_(pa.int64()))], ["node", "shingles"])


def _near_pivot(members: pa.Table, pivots: pa.Table) -> pa.Table:
    """Links between a pivot and those of its members that are similar enough on full sets."""
    u, v = [], []
    if members.num_rows and pivots.num_rows:
        own = pivots.column("centre")[0].values.to_numpy()
        for node, held in zip(members.column("v").to_pylist(), members.column("shingles")):
            theirs = held.values.to_numpy()
            at = np.minimum(np.searchsorted(own, theirs), len(own) - 1)
            common = int((own[at] == theirs).sum())
            if 100 * common >= SIMILAR * (len(own) + len(theirs) - common):
                u.append(pivots.column("pivot")[0].as_py())
                v.append(node)
    return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})


def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for the nodes u, v of edges; root is the smallest node of the component. Alternates large and small stars."""
    edges, before = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v").distinct().checkpoint(), None
    while True:
        both = edges.union(edges.select("v", "u"))
        least = written(both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n"))
        large = join_by_key(both, least, ["u"], "n").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).checkpoint()
        least = written(large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")))
        small = join_by_key(large, least, ["u"], "n").select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        edges = small.where("u > v").distinct().checkpoint()
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def _shared(dealt: DataFrame) -> DataFrame:
    """key, rep, size, n of the buckets with several members; n is how many."""
    sizes = written(dealt.groupBy("key").agg(F.count("*").alias("n")).where("n > 1"))
    return join_by_key(dealt, sizes.withColumn("of", F.col("n")), ["key"], "n").withColumnRenamed("of", "n")


def _sets_of(nodes: DataFrame, docs: DataFrame, classes: DataFrame) -> DataFrame:
    """node, shingles of the class representatives `nodes`, made from their texts; the one pass that deals texts out anew."""
    sets = docs.join(nodes.select(F.col("node").alias("doc_id")), "doc_id", "left_semi").select("doc_id", "text").mapInArrow(_sets, "node long, shingles array<long>")
    # rows that share a doc_id may have other texts than the class has
    sets = sets.withColumn("set_size", F.size("shingles")).join(classes.select(F.col("rep").alias("node"), F.col("n_shingles").alias("n")), "node")
    return written(sets.where("set_size = n").select("node", "shingles").dropDuplicates(["node"]), ARROW_ROWS)


def _pivots(members: DataFrame) -> DataFrame:
    """key, pivot, pivot_size, parts, n: the middle of each bucket, the member that shares most buckets with others, as the text does that
    others were made from; and in how many parts its members meet it."""
    degree = members.groupBy("rep").agg(F.sum("n").alias("degree"))
    ranked = members.join(degree, "rep")
    middle = F.max(F.struct("degree", (-F.col("rep")).alias("low"), "size")).alias("p")
    found = ranked.groupBy("key").agg(middle, F.count("*").alias("n"), F.sum("size").alias("total"))
    found = found.select("key", (-F.col("p.low")).alias("pivot"), F.col("p.size").alias("pivot_size"), "n", "total")
    # a pivot is a member of few buckets, as many as there are bands
    most = found.groupBy("pivot").agg(F.ceil(F.greatest(F.max("n") / BLOCK, F.max("total") / BLOCK_SHINGLES)).cast("int").alias("parts"))
    return written(found.drop("total").join(most, "pivot").select("key", "pivot", "pivot_size", "parts", "n"))


def _star_links(members: DataFrame, pivots: DataFrame, sets: DataFrame) -> DataFrame:
    """Confirmed links between pivots and the members of their buckets."""
    met = join_by_key(members.select("key", "rep", "size"), pivots, ["key"], "n").where("rep != pivot")
    near = met.where(f"100 * least(size, pivot_size) >= {SIMILAR} * greatest(size, pivot_size)")
    star = near.select(F.col("pivot").alias("u"), F.col("rep").alias("v"), F.pmod(F.xxhash64("rep"), F.col("parts")).cast("int").alias("part")).distinct()
    star = written(star)
    asked = star.join(sets.withColumnRenamed("node", "v"), "v")
    own = sets.select(F.col("node").alias("u"), F.col("shingles").alias("centre"))
    centre = star.select("u", "part").distinct().join(own, "u").select(F.col("u").alias("pivot"), F.col("part").alias("pivot_part"), "centre")
    return asked.groupBy("u", "part").cogroup(centre.groupBy("pivot", "pivot_part")).applyInArrow(_near_pivot, "u long, v long")


def _links_of_open_buckets(members: DataFrame, pivots: DataFrame, links: DataFrame, sets: DataFrame) -> DataFrame:
    """Links between the groups that a bucket still holds after its star."""
    # What a star has put together: each member goes by the smallest pivot that it is linked with.
    together = links.groupBy("v").agg(F.min("u").alias("u")).select(F.col("v").alias("node"), F.least("u", "v").alias("label"))
    together = together.union(links.select(F.col("u").alias("node"), F.col("u").alias("label"))).groupBy("node").agg(F.min("label").alias("label"))
    labelled = members.select("key", "size", F.col("rep").alias("node")).join(together, "node", "left").select("key", "node", "size", F.coalesce("label", "node").alias("label"))
    open_ = labelled.groupBy("key").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a < b").join(pivots, "key").select("key", "pivot", "n")
    rest = written(join_by_key(labelled, written(open_), ["key"], "n").select("pivot", "node", "size", "label").distinct())
    n_blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("size") / BLOCK_SHINGLES)).cast("int")
    blocks = written(rest.groupBy("pivot").agg(n_blocks.alias("blocks"), F.count("*").alias("n")))
    own_block = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    dealt = join_by_key(rest, blocks, ["pivot"], "n").withColumn("own", own_block).withColumn("other", F.explode(F.expr("sequence(0, blocks - 1)"))).where("own != other or blocks = 1")
    dealt = dealt.select("pivot", "node", "label", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b")).join(sets, "node")
    return dealt.groupBy("pivot", "a", "b").applyInArrow(_joined_up, "u long, v long")


def components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row for each row of docs."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    signed = written(docs.mapInArrow(_signed, "doc_id long, n_shingles long, set_id binary, bands array<long>"), ARROW_ROWS)
    known = signed.where("doc_id is not null and set_id is not null")
    classes = written(known.groupBy("set_id").agg(F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.any_value("bands").alias("bands")))
    dealt = classes.select(F.explode("bands").alias("key"), "rep", F.col("n_shingles").alias("size"))
    members = written(_shared(dealt))
    sets = _sets_of(members.select(F.col("rep").alias("node")).distinct(), docs, classes)
    pivots = _pivots(members)
    star = _star_links(members, pivots, sets).checkpoint()
    links = star.union(_links_of_open_buckets(members, pivots, star, sets))
    # Rows of one doc_id with different texts are one document.
    own = known.select("doc_id", "set_id").join(classes.select("set_id", "rep"), "set_id")
    twice = own.groupBy("doc_id").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high")
    links = links.union(twice.join(own.select("doc_id", "rep"), "doc_id").where("low != rep").select(F.col("low").alias("u"), F.col("rep").alias("v")))
    roots = connected(links)
    known_as = classes.select("set_id", F.col("rep").alias("node")).join(roots, "node", "left").select("set_id", F.coalesce("root", "node").alias("component"))
    sized = known.groupBy("set_id").agg(F.count("*").alias("n"))
    table = written(known_as.join(sized, "set_id"))
    out = join_by_key(known.select("doc_id", "n_shingles", "set_id"), table, ["set_id"], "n")
    # rows without a set or without an id are linked with nothing
    alone = signed.where("doc_id is null or set_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component"))
    out = out.select("doc_id", "n_shingles", "component").union(alone)
    return out.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id")).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def deduplicate(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns; one of the rows that share a doc_id. Null ids stay."""
    kept_id, row = fresh(docs.columns, ["kept_id", "row"])
    found = components(docs).where("doc_id is not null").groupBy(F.col("doc_id").alias(kept_id)).agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    ids = written(found)
    total = ids.agg(F.sum("n")).first()[0] or 0
    own = docs.withColumn(kept_id, F.col("doc_id").cast("long"))
    names = [F.col(f"`{c}`") for c in docs.columns]
    hot = ids.where(F.col("n") * HOT > total).where("n > 1").select(kept_id)
    once = own.join(F.broadcast(hot), kept_id, "left_anti").join(ids.where("kept and n = 1").select(kept_id), kept_id, "left_semi").select(*names)
    repeated = ids.where("kept and n > 1").select(kept_id, "n")
    if not repeated.isEmpty():
        # each task keeps one row of an id before the rows of that id meet
        few = repeated.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        rows = own.join(F.broadcast(repeated.drop("n")), kept_id) if few else join_by_key(own, repeated, [kept_id], "n")
        first = F.min_by(F.struct(*names), F.struct(F.xxhash64(F.to_json(F.struct(*names))), F.col("text")))
        once = once.unionByName(rows.groupBy(kept_id).agg(first.alias(row)).select(f"{row}.*"))
    return once.union(docs.where("doc_id is null"))
