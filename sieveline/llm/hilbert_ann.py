"""Nearest neighbours by shifted space-filling curves.

Vectors are projected to a few dimensions, once for each of CURVES seeded rotations; each projection is shifted, cut into cells at
quantiles of a bounded sample and put in the order of a Hilbert curve. Each ordering is range-partitioned and cut into blocks of
neighbours; a query is compared with its own block and the two beside it, in every ordering, and the findings merge by exact cosine.

How wide a block must be depends on the data, so it is measured: PILOT queries, drawn by hash, are compared with every row, and a block
gets as many rows as bring their neighbours within its reach in RECALL of the cases, BLOCK at least. Where vectors form clusters blocks
stay small. Where they are spread evenly in many dimensions no ordering keeps neighbours together: blocks grow until the windows cost
about what comparing everything would.

The windows give each query a k-th best cosine so far. An exact check follows: ranges of the first ordering have a centre and a radius,
and only ranges that may hold something nearer than that are searched in full, so that what the windows miss is found whatever the data
are like. `windows_only` leaves this check out.

Equal vectors are one entry that knows its k + 1 smallest ids, all that an answer can need of them, so a vector that a third of all
rows share is one entry too. No task takes more than about TILE entries and TILE queries at once.

Defined cases: vectors that are null, zero, of another length than most, or hold a null, NaN or infinite component take no part, nor do
rows without id. Ties go to the smaller id; equal rows with one id count once. With fewer candidates than k all are returned. An empty
table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sieveline.llm.shared import join_by_key, partitions, written

CURVES, DIMS, BITS = 6, 5, 8
BLOCK, TILE = 512, 2**15
#: Queries whose neighbours are found by comparing them with every row, and the share of those neighbours that windows must reach.
PILOT, RECALL = 256, 0.95
#: Rows from which cell borders are learned, and ranges whose centres are sent to the workers.
SAMPLE, RANGES = 10_000, 2048
#: More than a quick cosine differs from the exact one, and numbers that exact cosines take at a time.
ROUNDING, EXACT_CELLS = 1e-9, 2**21
_SEED = 20240611


def hilbert_key(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of points given as cells (rows, dims) of `bits` bits each, by Skilling's transposed form."""
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(dims):
            set_ = (x[i] & q) != 0
            swap = np.where(set_, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(set_, x[0] ^ p, x[0] ^ swap)
            x[i] ^= swap
        q >>= 1
    for i in range(1, dims):
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = top
    while q > 1:
        t ^= np.where((x[-1] & q) != 0, q - 1, 0)
        q >>= 1
    x ^= t
    key = np.zeros_like(x[0])
    for b in range(bits - 1, -1, -1):
        for i in range(dims):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, width)


def in_order(products: np.ndarray) -> np.ndarray:
    """Sums along the last axis, added from first to last."""
    return np.cumsum(products, axis=-1)[..., -1]


def cosines(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Cosines of vectors along the last axis, in double precision and a fixed order of addition."""
    return in_order(a * b) / (np.sqrt(in_order(a * a)) * np.sqrt(in_order(b * b)))


def entries(vectors: DataFrame, k: int, every: int) -> tuple[DataFrame, DataFrame, int]:
    """entry, v, ids (the k + 1 smallest), asked (whether a query is among its rows) of each distinct vector; all rows; their length."""
    v = F.col("embedding").cast("array<double>")
    fine = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and v is not null and size(v) > 0")
    fine = fine.where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0))
    widths = fine.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).first()
    width = widths["width"] if widths else 0

    def named(batches):
        for batch in batches:
            m = _matrix(batch.column(1), width) if batch.num_rows else np.zeros((0, width))
            m = m + 0.0  # -0.0 is 0.0
            yield pa.RecordBatch.from_arrays([pa.array([xxhash.xxh3_128_digest(row.tobytes()) for row in m], pa.binary()), batch.column(0), batch.column(1)], ["entry", "vec_id", "v"])

    rows = fine.where(F.size("v") == width).mapInArrow(named, "entry binary, vec_id long, v array<double>")
    rows = written(rows)
    few = rows.groupBy("entry").agg(F.min("vec_id").alias("vec_id"), F.max((F.col("vec_id") % every == 0).cast("int")).alias("asked"), F.count_distinct("vec_id").alias("n"), F.count("*").alias("rows"))
    few = written(few)
    alone = few.where("n = 1").select("entry", F.array("vec_id").alias("ids"), "asked", "vec_id")
    # the smallest k + 1 ids of a shared vector: kept small within salted parts before they meet
    shared = join_by_key(rows.select("entry", "vec_id"), few.where("n > 1").select("entry", "rows"), ["entry"], "rows").distinct()
    part = Window.partitionBy("entry", "salt").orderBy("vec_id")
    least = shared.withColumn("salt", F.pmod(F.xxhash64("vec_id"), F.lit(64))).withColumn("nth", F.row_number().over(part)).where(F.col("nth") <= k + 1)
    several = least.groupBy("entry").agg(F.slice(F.array_sort(F.collect_list("vec_id")), 1, k + 1).alias("ids")).join(few.select("entry", "asked", "vec_id"), "entry")
    known = alone.union(several.select("entry", "ids", "asked", "vec_id"))
    found = rows.select("entry", "vec_id", "v").dropDuplicates(["entry", "vec_id"]).join(known, ["entry", "vec_id"]).select("entry", "v", "ids", "asked")
    return written(found), rows, width


def orderings(found: DataFrame, width: int) -> DataFrame:
    """curve, key, entry for every entry and curve."""
    rng = np.random.default_rng(_SEED)
    dims = min(DIMS, width)
    turns = [np.linalg.qr(rng.normal(size=(width, width)))[0][:, :dims] for _ in range(CURVES)]
    sample = found.orderBy("entry").limit(SAMPLE).select("v").toArrow().column("v").combine_chunks()
    m = _matrix(sample, width)
    m = m / np.linalg.norm(m, axis=1)[:, None]
    cells = 2**BITS
    borders = []
    for turn in turns:
        shift = rng.random(dims) / cells  # shifted cells: quantiles that start elsewhere on each curve
        p = m @ turn
        borders.append([np.quantile(p[:, d], np.clip(np.arange(1, cells) / cells + shift[d] - 0.5 / cells, 0, 1)) for d in range(dims)])

    def placed(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            v = _matrix(batch.column(1), width)
            v = v / np.linalg.norm(v, axis=1)[:, None]
            for c, turn in enumerate(turns):
                p = v @ turn
                key = hilbert_key(np.stack([np.searchsorted(borders[c][d], p[:, d]) for d in range(dims)], axis=1), BITS)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(key), c), pa.int32()), pa.array(key), batch.column(0)], ["curve", "key", "entry"])

    return found.select("entry", "v").mapInArrow(placed, "curve int, key long, entry binary")


def positions(placed: DataFrame) -> DataFrame:
    """curve, entry, pos: the place of each entry in each ordering, without bringing an ordering together in one task."""
    parts = max(partitions(placed.sparkSession), CURVES)
    dealt = written(placed.repartitionByRange(parts, "curve", "key", "entry").withColumn("part", F.spark_partition_id()))
    counts = dealt.groupBy("curve", "part").count()
    starts = counts.select("curve", "part", (F.sum("count").over(Window.partitionBy("curve").orderBy("part")) - F.col("count")).alias("start"))
    within = F.row_number().over(Window.partitionBy("curve", "part").orderBy("key", "entry")) - 1
    return dealt.withColumn("nth", within).join(F.broadcast(starts), ["curve", "part"]).select("curve", "entry", (F.col("start") + F.col("nth")).cast("long").alias("pos"))


def reach(placed: DataFrame, found: DataFrame, k: int, width: int) -> int:
    """The rows that a block must have for windows to hold RECALL of the neighbours of PILOT queries."""
    pilot = found.where("asked = 1").orderBy(F.xxhash64("entry"), "entry").limit(PILOT).select("entry", "v").toArrow()
    if not pilot.num_rows:
        return BLOCK
    ids, q = pilot.column("entry").to_pylist(), _matrix(pilot.column("v").combine_chunks(), width)
    sent = found.sparkSession.sparkContext.broadcast((ids, q / np.linalg.norm(q, axis=1)[:, None]))

    def near(batches):
        ids, q = sent.value
        for batch in batches:
            for a in range(0, batch.num_rows, TILE):
                part = batch.slice(a, TILE)
                m = _matrix(part.column(1), width)
                score = q @ (m / np.linalg.norm(m, axis=1)[:, None]).T
                take = min(k + 1, score.shape[1])
                which = np.argpartition(-score, take - 1, axis=1)[:, :take]
                rows = np.repeat(np.arange(len(ids)), take)
                yield pa.RecordBatch.from_arrays([pa.array([ids[r] for r in rows], pa.binary()), part.column(0).take(pa.array(which.ravel())), pa.array(score[rows, which.ravel()])], ["query", "entry", "score"])

    top = Window.partitionBy("query").orderBy(F.desc("score"), "entry")
    some = found.select("entry", "v").mapInArrow(near, "query binary, entry binary, score double").where("query != entry")
    some = some.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k).select("query", "entry")
    at = placed.select("curve", F.col("entry").alias("query"), F.col("pos").alias("query_pos"))
    gaps = some.join(placed, "entry").join(at, ["curve", "query"]).groupBy("query", "entry").agg(F.min(F.abs(F.col("pos") - F.col("query_pos"))).alias("gap"))
    return max(BLOCK, int(gaps.agg(F.percentile("gap", F.lit(RECALL))).first()[0] or 0))


def in_tiles(asked: DataFrame, members: DataFrame, at: list[str], most: int, k: int, width: int) -> DataFrame:
    """query, entry, least, score: the nearest of the members that stand where a query asks, at the columns `at`.

    At most `most` queries ask at one place; they are dealt into batches of about TILE, each with the place's members."""
    n = -(-most // TILE)
    if n > 1:
        asked = asked.withColumn("batch", F.pmod(F.xxhash64("query"), F.lit(n)).cast("int"))
        members = members.withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
        at = [*at, "batch"]
    there = members.select(*[F.col(c).alias(f"m_{c}") for c in at], "entry", "v", "least")
    return asked.groupBy(*at).cogroup(there.groupBy(*[f"m_{c}" for c in at])).applyInArrow(_compared(k, width), "query binary, entry binary, least long, score double")


def _compared(k: int, width: int):
    def run(asked: pa.Table, held: pa.Table) -> pa.Table:
        out = {"query": [], "entry": [], "least": [], "score": []}
        if asked.num_rows and held.num_rows:
            q, m = (_matrix(c.combine_chunks(), width) for c in (asked.column("qv"), held.column("v")))
            unit = m / np.linalg.norm(m, axis=1)[:, None]
            least = held.column("least").to_numpy()
            take = min(k + 1, len(m))
            for a in range(0, len(q), 256):
                near = q[a : a + 256] / np.linalg.norm(q[a : a + 256], axis=1)[:, None] @ unit.T
                # all that may reach the last place; exact scores and ids decide
                rows, which = np.nonzero(~(near < np.partition(near, len(m) - take, axis=1)[:, len(m) - take, None] - ROUNDING))
                step = max(1, EXACT_CELLS // width)
                score = np.concatenate([cosines(q[a + rows[i : i + step]], m[which[i : i + step]]) for i in range(0, len(rows), step)])
                order = np.lexsort((least[which], -score, rows))
                rows, which, score = rows[order], which[order], score[order]
                kept = np.arange(len(rows)) - np.searchsorted(rows, rows) < take
                rows, which, score = rows[kept] + a, which[kept], score[kept]
                out["query"].append(asked.column("query").take(pa.array(rows)))
                out["entry"].append(held.column("entry").take(pa.array(which)))
                out["least"].append(held.column("least").take(pa.array(which)))
                out["score"].append(pa.chunked_array([pa.array(score)]))
        schema = pa.schema([("query", pa.binary()), ("entry", pa.binary()), ("least", pa.int64()), ("score", pa.float64())])
        return pa.Table.from_arrays([pa.chunked_array([c for x in out[n] for c in x.chunks], schema.field(n).type) for n in schema.names], schema=schema)

    return run


def _best(found: DataFrame, k: int) -> DataFrame:
    """The k + 1 nearest entries of each query, each once; of equally near ones those with the smallest vec_id. No other can hold an answer."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "least")
    return found.groupBy("query", "entry", "least").agg(F.max("score").alias("score")).withColumn("nth", F.row_number().over(order)).where(F.col("nth") <= k + 1)


def _centred(m: np.ndarray) -> np.ndarray:
    centre = m.sum(axis=0)
    return centre / max(np.linalg.norm(centre), 1e-300)


def ranges(members: DataFrame, per_range: int, width: int) -> DataFrame:
    """range, centre, angle: a cap that holds all vectors of `per_range` neighbouring blocks; members: entry, v, block."""

    def of_block(held: pa.Table) -> pa.Table:
        m = _matrix(held.column("v").combine_chunks(), width)
        m = m / np.linalg.norm(m, axis=1)[:, None]
        centre = _centred(m)
        angle = float(np.arccos(np.clip((m @ centre).min(), -1, 1)))
        return pa.table({"range": pa.array([held.column("block")[0].as_py() // per_range], pa.int64()), "centre": pa.array([centre], pa.list_(pa.float64())), "angle": pa.array([angle])})

    def of_range(held: pa.Table) -> pa.Table:
        m = _matrix(held.column("centre").combine_chunks(), width)
        centre = _centred(m)
        angle = float((np.arccos(np.clip(m @ centre, -1, 1)) + held.column("angle").to_numpy()).max())
        return pa.table({"range": held.column("range")[:1], "centre": pa.array([centre], pa.list_(pa.float64())), "angle": pa.array([angle])})

    schema = "range long, centre array<double>, angle double"
    capped = members.groupBy("block").applyInArrow(of_block, schema)
    return capped if per_range == 1 else capped.groupBy("range").applyInArrow(of_range, schema)


def _may_hold(asked: DataFrame, caps: list, width: int) -> DataFrame:
    """query, range of all ranges that may hold a vector at least as near as `floor`; caps: their (range, centre, angle), RANGES at most."""
    sent = asked.sparkSession.sparkContext.broadcast((np.array([c[0] for c in caps]), np.array([c[1] for c in caps]).reshape(-1, width), np.array([c[2] for c in caps])))

    def run(batches):
        ids, centre, radius = sent.value
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                q = _matrix(part.column(1), width)
                q = q / np.linalg.norm(q, axis=1)[:, None]
                angle = np.arccos(np.clip(q @ centre.T, -1, 1)) - radius[None, :]
                near = np.cos(np.clip(angle, 0, np.pi)) + 1e-9 >= np.asarray(part.column(2))[:, None]
                rows, which = np.nonzero(near)
                yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(rows)), pa.array(ids[which])], ["query", "range"])

    return asked.select("query", "qv", "floor").mapInArrow(run, "query binary, range long")


def search(vectors: DataFrame, k: int = 5, every: int = 50, windows_only: bool = False) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest rows to each row whose vec_id is divisible by `every`."""
    spark = vectors.sparkSession
    found, rows, width = entries(vectors, k, every)
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    n = found.count()
    if not n:
        return empty
    placed = written(positions(orderings(found, width)))
    block = reach(placed, found, k, width)
    tile = min(block, TILE)
    members = placed.join(found.select("entry", "v", F.array_min("ids").alias("least")), "entry")
    asked = written(found.where("asked = 1").select(F.col("entry").alias("query"), F.col("v").alias("qv")))
    n_asked = asked.count()
    span = F.sequence(F.floor((F.col("pos") - block) / tile), F.floor((F.col("pos") + block) / tile))
    at = placed.withColumnRenamed("entry", "query").join(asked, "query").select("query", "qv", "curve", F.explode(span).alias("tile"))
    near = in_tiles(at, members.withColumn("tile", F.floor(F.col("pos") / tile)), ["curve", "tile"], min(n_asked, 2 * block + tile), k, width)
    best = written(_best(near, k))
    if not windows_only:
        per_range = -(-n // (BLOCK * RANGES))
        own = members.where("curve = 0").withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumn("range", F.floor(F.col("block") / per_range)).withColumn("tile", F.floor(F.col("pos") / TILE))
        caps = ranges(own.select("entry", "v", "block"), per_range, width).collect()
        floors = best.where(F.col("nth") == k + 1).select("query", F.col("score").alias("floor"))
        open_ = asked.join(floors, "query", "left").select("query", "qv", F.coalesce("floor", F.lit(-2.0)).alias("floor"))
        tiles = F.broadcast(own.select("range", "tile").distinct())
        visits = _may_hold(open_, caps, width).join(tiles, "range").join(asked, "query").select("query", "qv", "range", "tile")
        rest = in_tiles(visits, own, ["range", "tile"], n_asked, k, width)
        best = written(_best(best.select("query", "entry", "least", "score").union(rest), k))
    ids = found.select("entry", "ids")
    queries = written(rows.where(F.col("vec_id") % every == 0).select(F.col("vec_id").alias("query_id"), F.col("entry").alias("query")).distinct())
    answers = best.join(ids, "entry").select("query", "score", F.explode("ids").alias("vec_id"))
    top = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    answers = answers.withColumn("nth", F.row_number().over(top)).where(F.col("nth") <= k + 1).select("query", "score", "vec_id")
    # queries with one vector share its k + 1 answers and are not brought together for them
    each = answers.groupBy("query").agg(F.collect_list(F.struct("score", "vec_id")).alias("held")).join(queries.groupBy("query").count(), "query")
    paired = join_by_key(queries, written(each), ["query"], "count").select("query_id", F.inline("held")).where("query_id != vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return paired.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

