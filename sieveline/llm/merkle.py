"""Merkle manifest of a dataset: a digest of each row, of each group of rows and of the whole, and proofs that a row belongs to it.

Method: a radix-ranked trie. Rows are ranked within their group without a global sort: histograms of the digits of their keys, each a few digits
deeper where buckets are still large, give the number of rows before each bucket, and only within a bucket (at most LIMIT rows) a window counts.
The digits of a rank in base FANOUT are the row's place in a trie; nodes are reduced from the longest prefix of digits to the shortest. Subtrees
of FANOUT ** DIGITS nodes are one row each, an array for each of their levels, so that a level costs no shuffle of its own.
The roots of the groups are ranked and reduced in the same way.

Defined cases: nulls are values of their own in every column (a null group comes first, a null doc_id before all others of its group); rows with
the same doc_id in one group are ordered by their leaf, and equal rows follow each other; texts are hashed whole, whatever their length, and
empty ones are no nulls; an empty table gives an empty one; columns that are not asked for don't count, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sieveline.functions.text import named
from sieveline.llm.shared import lower_ascii, written

FANOUT = 8
#: Levels of a subtree that is one row.
DIGITS = 3
#: A bucket with more rows is split by further digits of its keys.
LIMIT = 256
#: Hexadecimal digits by which it is split.
STEP = 2
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_HEX = 16


def digest(fields: Sequence[Column]) -> Column:
    """SHA-256 of the fields in order: each its length in bytes, a colon and its value, or a dash if null."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def _padded(n: Column) -> Column:
    return F.lpad(F.hex(n), _HEX, "0")


def row_key(doc_id: Column, leaf: Column, tie: Column) -> Column:
    """Text that sorts as doc_id does (null first), then as the leaf; the tie parts equal rows, in whatever order."""
    number = _padded(doc_id.cast("long").bitwiseXOR(F.lit(-(2**63))))
    return F.concat(F.coalesce(number, F.lit("-" * _HEX)), F.substring(leaf, 1, _HEX), _padded(F.xxhash64(tie)))


def group_key(group: Column) -> Column:
    """Text that sorts as the group's UTF-8 bytes do, null first."""
    return F.coalesce(F.concat(F.lit("="), F.hex(F.encode(group.cast("string"), "UTF-8"))), F.lit("-"))


def ranked(rows: DataFrame, limit: int = LIMIT, step: int = STEP) -> DataFrame:
    """rows (grp, key and more; a table that is read several times) with rank, from 0 by key in each grp, and size, the grp's number of rows.

    A histogram counts the rows of each prefix of the keys. Where more than `limit` share a prefix, the next histogram takes `step` digits more
    than all keys of such a bucket have in common. A prefix has few others beside it under the prefix before, so that the sum over those
    which precede it is a small window; a row's rank is that sum, its parents' sums, and its place in the bucket.
    """
    depth, longest, above = 0, rows.agg(F.max(F.length("key"))).first()[0] or 0, None
    while True:
        counted = rows.groupBy("grp", F.substring("key", 1, depth).alias("prefix")).agg(F.count("*").alias("n"), F.min("key").alias("lo"), F.max("key").alias("hi"))
        if above is None:
            counted = counted.withColumns({"before": F.lit(0).cast("long"), "size": F.col("n")})
        else:
            earlier = Window.partitionBy("grp", "parent").orderBy("prefix").rowsBetween(Window.unboundedPreceding, -1)
            counted = counted.withColumn("parent", F.substring("prefix", 1, parents))
            counted = counted.withColumn("own", F.coalesce(F.sum("n").over(earlier), F.lit(0)))
            counted = counted.join(above, ["grp", "parent"]).select("grp", "prefix", "n", "lo", "hi", (F.col("own") + F.col("over")).alias("before"), "size")
        counted = written(counted)
        common = F.size(F.filter(F.sequence(F.lit(1), F.length("lo")), lambda i: F.substring("lo", F.lit(1), i) == F.substring("hi", F.lit(1), i)))
        shared = counted.where(F.col("n") > limit).agg(F.min(common)).first()[0]
        if shared is None or depth >= longest:
            break
        above = counted.select("grp", F.col("prefix").alias("parent"), F.col("before").alias("over"), "size")
        parents, depth = depth, max(shared, depth) + step
    within = Window.partitionBy("grp", "prefix").orderBy("key")
    found = rows.withColumn("prefix", F.substring("key", 1, depth)).join(counted.select("grp", "prefix", "before", "size"), ["grp", "prefix"])
    return found.withColumn("rank", F.col("before") + F.row_number().over(within) - 1).drop("prefix", "before")


def height(size: Column) -> Column:
    """How often nodes are reduced until one is left."""
    return sum(((size > FANOUT**j).cast("int") for j in range(1, 20)), (size > 1).cast("int"))


def _reduced(nodes: Column) -> Column:
    """The digests of every FANOUT consecutive nodes, the last of those that are left."""
    last = F.floor((F.size(nodes) - 1) / FANOUT).cast("int")
    return F.transform(F.sequence(F.lit(0), last), lambda k: F.sha2(F.array_join(F.slice(nodes, k * FANOUT + 1, FANOUT), ""), 256))


def _siblings(level: Column, at: Column) -> Column:
    """The nodes of a run before and after one of them, each as one text."""
    place = F.pmod(at, F.lit(FANOUT))
    before = F.slice(level, at - place + 1, place)
    after = F.slice(level, at + 2, FANOUT - 1 - place)
    return F.struct(F.array_join(before, "").alias("left"), F.array_join(after, "").alias("right"))


def _path(at: Column, steps: Column) -> Column:
    """The siblings of a subtree's node on its way to the subtree's root."""
    own = [F.when(steps > j, _siblings(F.col(f"level{j}"), F.floor(at / FANOUT**j).cast("int"))) for j in range(DIGITS)]
    return F.array_compact(F.array(*own))


@dataclass
class Forest:
    """The trees of all groups: `parts[s]` has the subtrees whose nodes are the roots of those in parts[s - 1], `roots` one root for each grp."""

    parts: list[DataFrame]
    roots: DataFrame

    def each(self, above: DataFrame, use: Callable[[Column, Column, Column], Column]) -> DataFrame:
        """use(node, path, more) of every node that the trees were made of, as columns.

        above has, for each grp, `path` from its root upwards and a struct `more`. path: the (left, right) siblings from the node upwards.
        """
        over = None
        for s in range(len(self.parts) - 1, -1, -1):
            part = self.parts[s]
            done = part.where(F.col("height") <= DIGITS * (s + 1)).select("grp", "at").join(above, "grp")
            over = done if over is None else done.unionByName(over)
            held = part.join(over, ["grp", "at"])
            numbers = F.sequence(F.lit(0), F.size("level0") - 1)
            full = lambda i: F.concat(_path(i, F.col("steps")), F.col("path"))
            if s:
                below = F.transform(numbers, lambda i: F.struct((F.col("at") * FANOUT**DIGITS + i).alias("at"), full(i).alias("path")))
                over = held.select("grp", F.explode(below).alias("x"), "more").select("grp", "x.at", "x.path", "more")
        return held.select(F.explode(F.transform(numbers, lambda i: named(full(i), lambda p: use(F.get("nodes", i), p, F.col("more"))))).alias("x")).select("x.*")


def forest(rows: DataFrame) -> Forest:
    """The trees over rows of grp, rank, size, leaf and more columns; `nodes` of the lowest subtrees keep all of a row."""
    rows = rows.withColumn("height", height(F.col("size"))).drop("size")
    rest = [c for c in rows.columns if c not in ("grp", "rank", "height")]
    parts, roots, s = [], None, 0
    while True:
        node = F.struct("rank", *rest)
        part = rows.groupBy("grp", F.floor(F.col("rank") / FANOUT**DIGITS).alias("at")).agg(F.array_sort(F.collect_list(node)).alias("nodes"), F.first("height").alias("height"))
        part = part.withColumn("steps", F.least(F.lit(DIGITS), F.col("height") - DIGITS * s)).withColumn("level0", F.transform("nodes", lambda x: x["leaf"]))
        for j in range(1, DIGITS + 1):
            part = part.withColumn(f"level{j}", F.when(F.col("steps") >= j, _reduced(F.col(f"level{j - 1}"))))
        top = F.coalesce(*[F.col(f"level{j}") for j in range(DIGITS, -1, -1)])
        part = part.withColumn("root", F.get(top, F.lit(0))).drop(f"level{DIGITS}", *["nodes"] * bool(s))
        parts.append(written(part))
        s += 1
        done = parts[-1].where(F.col("height") <= DIGITS * s).select("grp", "root")
        roots = done if roots is None else roots.unionByName(done)
        rows = parts[-1].where(F.col("height") > DIGITS * s).select("grp", F.col("at").alias("rank"), F.col("root").alias("leaf"), "height")
        rest = ["leaf"]
        if rows.isEmpty():
            return Forest(parts, roots)


@dataclass
class Manifest:
    groups: Forest
    whole: Forest

    def root(self) -> str | None:
        """The digest of all rows; none if there are none."""
        found = self.whole.roots.first()
        return found and found["root"]

    def subroots(self) -> DataFrame:
        """grp (a group's sort key) and the digest of its rows."""
        return self.groups.roots

    def each(self, use: Callable[[Column, Column, Column], Column]) -> DataFrame:
        """use(node, path, more) of each row, as columns: node has its leaf and what else was kept, path its siblings up to the root, more subroot and root."""
        no_path = F.expr("cast(array() as array<struct<left: string, right: string>>)")
        above = self.whole.roots.select("grp", no_path.alias("path"), F.struct("root").alias("more"))
        tops = self.whole.each(above, lambda node, path, more: F.struct(node["name"].alias("grp"), path.alias("path"), F.struct(node["leaf"].alias("subroot"), more["root"].alias("root")).alias("more")))
        return self.groups.each(written(tops), use)


def build(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id", kept: dict[str, Column] | None = None) -> Manifest:
    """The manifest of docs: leaves are digests of `fields`, one tree for each `group` with its rows by `order` (integers). `kept`: what nodes keep besides."""
    leaf = digest([F.col(f"`{c}`") for c in fields])
    own = {f"kept_{name}": c for name, c in (kept or {}).items()}
    rows = docs.select(group_key(F.col(f"`{group}`")).alias("grp"), F.col(f"`{order}`").cast("long").alias("number"), leaf.alias("leaf"), F.monotonically_increasing_id().alias("tie"), *[c.alias(n) for n, c in own.items()])
    rows = written(rows.select("grp", row_key(F.col("number"), F.col("leaf"), F.col("tie")).alias("key"), "number", "leaf", *own))
    groups = forest(ranked(rows).drop("key"))
    tops = written(groups.roots.select(F.lit("").alias("grp"), F.col("grp").alias("key"), F.col("root").alias("leaf")))
    return Manifest(groups, forest(ranked(tops).withColumnRenamed("key", "name")))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def verified(docs: DataFrame, fields: Sequence[str] = FIELDS, group: str = "lang", order: str = "doc_id") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, and folded_root and verified after every row whose crc32 of doc_id 3 divides had its text lower-cased."""
    changed = digest([lower_ascii(F.col("text")) if c == "text" else F.col(f"`{c}`") for c in fields])
    tampered = F.when(F.crc32(F.col(f"`{order}`").cast("string")) % 3 == 0, changed)

    def row(node: Column, path: Column, more: Column) -> Column:
        found = folded(F.coalesce(node["kept_tampered"], node["leaf"]), path)
        return F.struct(node["number"].alias("doc_id"), node["leaf"].alias("leaf"), more["subroot"].alias("subroot"), more["root"].alias("root"), proof_digest(path).alias("proof_sha256"), found.alias("folded_root"))

    done = build(docs, fields, group, order, {"tampered": tampered}).each(row)
    return done.withColumn("verified", F.col("folded_root") == F.col("root"))
