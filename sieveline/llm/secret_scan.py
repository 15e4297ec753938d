"""Secret scans with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query over trigrams is derived (any of some sets of trigrams that must all occur);
texts are folded to lower case for it. The index holds postings for the trigrams that the rules ask for. Intersecting the postings
of each set gives the candidates of each rule, which the regular expressions then verify with offsets. A rule for which no trigram
is mandatory scans every text.

Postings carry a hash of id and text, so equal rows share them; if two rows ever share a hash without being equal, both become
candidates and verification settles it. A bitmap of the candidates' hashes (SLOTS bits, whatever the corpus) is broadcast: rows that it
doesn't know stay where they are, and only the others are dealt out to meet their rules.

Rules are leftmost and non-overlapping within their kind; a match that fails the rule's length check is dropped.

Defined cases: null text counts as empty and has no span; null ids are kept; repeated rows give a row each; an empty table gives an
empty result; columns beyond doc_id and text are not read by `scan` and returned unchanged by `redact`, whatever their names.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sieveline.functions import text as T
from sieveline.llm.shared import join_by_key, with_puts, written
from sieveline.operators.extract import fresh


@dataclass(frozen=True)
class Rule:
    """pattern is written for both Java and RE2; at least `least` characters of group `group` make a match count."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_NAMES = "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key")))
#: The three base rules, in the order that breaks ties between spans.
BASE = (
    Rule("assign", rf"""({_NAMES})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
#: Well-known shapes of other credentials.
MORE = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,250}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,250}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
_MOST = 64


#: Bits of the candidates' bitmap, 8 MB.
SLOTS = 2**26
Ways = list[list[str | None]]  # ways to match, each a list of characters and None for what may be anything


class _Reader:
    """Reads the regular expressions of rules: what must stand in a match. What it doesn't know may be anything."""

    def __init__(self, pattern: str):
        self.pattern, self.at = pattern, 0

    def next(self, n: int = 1) -> str:
        self.at += n
        return self.pattern[self.at - n : self.at]

    def sees(self, *starts: str) -> bool:
        return self.pattern.startswith(starts, self.at)

    def choice(self) -> Ways:
        out = self.sequence()
        while self.sees("|"):
            self.next()
            out = out + self.sequence()
        return out

    def sequence(self) -> Ways:
        ways: Ways = [[]]
        while self.at < len(self.pattern) and not self.sees("|", ")"):
            step = self.repeated(self.atom())
            ways = [a + b for a, b in product(ways, step)] if len(ways) * len(step) <= _MOST else [w + [None] for w in ways]
        return ways

    def atom(self) -> Ways:
        c = self.next()
        if c == "(":
            return self.group()
        if c == "[":
            return self.characters()
        if c == "\\":
            return self.escaped()
        return [[]] if c in "^$" else [[None]] if c == "." else [[c.lower()]]

    def group(self) -> Ways:
        around = self.sees("?=", "?!", "?<=", "?<!")
        if self.sees("?"):
            while self.next() not in ":=!":
                pass
        found = self.choice()
        self.next()
        return [[]] if around else found

    def escaped(self) -> Ways:
        c = self.next()
        if c == "x":
            return [[chr(int(self.next(2), 16)).lower()]]
        return [[]] if c in "bBAzZG" else [[None]] if c.isalnum() else [[c]]

    def characters(self) -> Ways:
        listed, plain = set(), not self.sees("^")
        while not self.sees("]") or not listed and self.pattern[self.at - 1] == "[":
            c = self.next()
            if c == "\\" or self.sees("-") and not self.sees("-]"):
                plain = False
            listed.add(c.lower())
            if c == "\\":
                self.next()
        self.next()
        return [[c] for c in sorted(listed)] if plain and len(listed) <= 4 else [[None]]

    def repeated(self, once: Ways) -> Ways:
        if self.sees("{"):
            least, most = (self.next(self.pattern.index("}", self.at) - self.at + 1)[1:-1] + ",").split(",")[:2]
            low, one = int(least), most == "1"
        elif self.sees("*", "+", "?"):
            mark = self.next()
            low, one = int(mark == "+"), mark == "?"
        else:
            return once
        if self.sees("+", "?"):
            self.next()
        if low:
            return [[*w, None] for w in once]
        return [[], *once] if one else [[None]]


def trigram_query(pattern: str) -> list[list[str]] | None:
    """Sets of lower-case trigrams; a text that matches holds all of at least one set. None if a match may do without any."""
    sets = set()
    for way in _Reader(pattern).choice():
        runs = "".join("\x00" if x is None else x for x in way).split("\x00")
        found = frozenset(r[k : k + 3] for r in runs for k in range(len(r) - 2))
        if not found:
            return None
        sets.add(found)
    least = [s for s in sets if not any(t < s for t in sets)]
    return sorted(sorted(s) for s in least)


def _quoted(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def postings(texts: DataFrame, trigrams: Sequence[str]) -> DataFrame:
    """key, trigram: which of the texts (key, text) hold which of the trigrams, in lower case."""
    lowered = texts.select("key", F.lower("text").alias("text"))
    return lowered.select("key", F.explode(F.array_compact(F.array(*[F.when(F.contains("text", F.lit(t)), F.lit(t)) for t in trigrams]))).alias("trigram"))


def candidates(found: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """key, rules (those whose Boolean query the key's postings satisfy) and n, the number of rows with that key."""
    terms = [(k, n, len(part), t) for k, r in enumerate(rules) for n, part in enumerate(trigram_query(r.pattern) or ()) for t in part]
    asked = found.sparkSession.createDataFrame(terms, "rule int, part int, needed long, trigram string")
    counted = found.groupBy("key", "trigram").agg(F.count("*").alias("n"))
    met = counted.join(F.broadcast(asked), "trigram").groupBy("key", "rule", "part", "needed").agg(F.count("*").alias("held"), F.max("n").alias("n")).where("held = needed")
    return met.groupBy("key").agg(F.collect_set("rule").alias("rules"), F.max("n").alias("n"))


def _bitmap(keys: DataFrame) -> DataFrame:
    """bucket, bits: the slots of the keys, 32768 to a row."""
    slot = F.pmod("key", F.lit(SLOTS)) + 1
    return keys.groupBy(F.bitmap_bucket_number(slot).alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(slot)).alias("bits"))


def _in_bitmap(key: Column, bits: Column) -> Column:
    place = F.bitmap_bit_position(F.pmod(key, F.lit(SLOTS)) + 1)
    byte = F.conv(F.hex(F.substring(bits, F.floor(place / 8).cast("int") + 1, 1)), 16, 10).cast("int")
    return F.coalesce(F.call_function("getbit", byte, (place % 8).cast("int")) == 1, F.lit(False))


def spans_of(text: Column, rule: Rule, order: int) -> Column:
    """start, rank, kind, end of each of a rule's spans in a text; code points, end exclusive."""
    found = T.spans(text, rule.pattern)
    if rule.least:
        found = F.filter(found, lambda s: F.length(F.regexp_extract(s["value"], rule.pattern, rule.group)) >= rule.least)
    return F.transform(found, lambda s: F.struct(s["start"].alias("start"), F.lit(order).alias("rank"), F.lit(rule.kind).alias("kind"), s["end"].alias("end")))


def with_spans(docs: DataFrame, rules: Sequence[Rule] = RULES) -> tuple[DataFrame, str]:
    """docs and a column of spans (start, rank, kind, end) of each row's text, by start and then in the order of the rules; its name."""
    text, key, met, bucket, bits, spans = fresh([*docs.columns, "key", "rules"], ["text", "key", "rules", "bucket", "bits", "spans"])
    keyed = docs.withColumn(text, F.coalesce(F.col("text").cast("string"), F.lit("")))
    keyed = keyed.withColumn(key, F.xxhash64(F.col("doc_id").cast("long"), text))
    asked = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    if asked:
        trigrams = sorted({t for q in asked.values() for part in q for t in part})
        met_by = written(candidates(postings(keyed.select(F.col(key).alias("key"), F.col(text).alias("text")), trigrams), rules))
        slots = F.broadcast(_bitmap(met_by).toDF(bucket, bits))
        own_bucket = F.bitmap_bucket_number(F.pmod(key, F.lit(SLOTS)) + 1)
        probed = keyed.join(slots, own_bucket == F.col(bucket), "left")
        known = _in_bitmap(F.col(key), F.col(bits))
        away = probed.where(known).drop(bucket, bits)
        here = probed.where(~known).drop(bucket, bits).withColumn(met, F.lit(None).cast("array<int>"))
        keyed = here.unionByName(join_by_key(away, met_by.toDF(key, met, "n"), [key], "n", "left"))
    else:
        keyed = keyed.withColumn(met, F.lit(None).cast("array<int>"))
    each = []
    for k, rule in enumerate(rules):
        may = F.array_contains(met, F.lit(k)) if k in asked else F.col(text).rlike(rule.pattern)
        each.append(F.when(F.coalesce(may, F.lit(False)), spans_of(F.col(text), rule, k)).otherwise(F.expr("cast(array() as array<struct<start: int, rank: int, kind: string, end: int>>)")))
    return keyed.withColumn(spans, F.array_sort(F.concat(*each))).drop(text, key, met), spans


def scan(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """doc_id and spans of each row of docs."""
    found, spans = with_spans(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), rules)
    return found.select("doc_id", F.col(spans).alias("spans"))


def listed(spans: str) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.expr(f"array_join(transform({spans}, s -> concat(s.kind, ':', s.start, ':', s.end)), ',')")


def redact(docs: DataFrame, rules: Sequence[Rule] = RULES) -> DataFrame:
    """docs, whole and with all columns, where [kind] stands for each span of text; overlapping spans become one, named by the first."""
    found, spans = with_spans(docs, rules)
    puts = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.concat(F.lit("["), s["kind"], F.lit("]")).alias("put")))
    return found.withColumn("text", F.when(F.size(spans) > 0, with_puts(F.col("text"), puts)).otherwise(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])
