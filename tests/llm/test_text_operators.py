"""Quality rules, PII, near-duplicates, secrets, mixing and BPE against brute force, with the cases that their docstrings define."""

import hashlib
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from sieveline.llm import bpe, curriculum, minmax_dedup, pii, quality_rules, queries, secret_scan
from sieveline.llm.shared import WordHashes

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LONG = "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 400
CASES = [
    (1, "one two three four five six seven", "s", "x"), (1, "one two three four five six seven", "s", "x"), (2, None, None, "x"), (3, "", "s", "x"), (None, "no id here but words", "t", None),
    (4, " \t\n ", "t", "x"), (5, LONG, "s", "x"), (6, LONG + "tail", "t", "x"), (7, "two words", "s", "x"), (8, "TWO Words", "s", "x"), (9, "café naïve 😀  x", "s", "x"), (None, None, None, None),
]
SCHEMA = "doc_id long, text string, source string, kept string"


@pytest.fixture(scope="module")
def cases(spark):
    return spark.createDataFrame(CASES, SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def words(text):
    return WORD.findall(text or "")


def low(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def rule_counts(text):
    w, t = words(text), text or ""
    lines = [x for x in t.split("\n") if WORD.search(x)]
    windows = [tuple(w[k : k + 5]) for k in range(len(w) - 4)]
    often = Counter(windows)
    under = {k + j for k, x in enumerate(windows) if often[x] > 1 for j in range(5)}
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(under)


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_quality_rules(request, which):
    df = request.getfixturevalue(which)
    got = quality_rules.judge(df).collect()
    want = Counter((r.doc_id, *rule_counts(r.text)) for r in df.collect())
    assert Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.posterior >= quality_rules.KEEP)


def test_quality_rules_learn_chances():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.7
    chances = {"a": ((0.1, 0.7, 0.2), (0.7, 0.1, 0.2)), "b": ((0.02, 0.0, 0.98), (0.5, 0.0, 0.5)), "c": ((0.05, 0.9, 0.05), (0.6, 0.3, 0.1)), "d": ((0.03, 0.57, 0.4), (0.4, 0.2, 0.4))}
    rows = Counter()
    for g in good:
        vote = {n: [0, 1, None][rng.choice(3, p=c[0] if g else c[1])] for n, c in chances.items()}
        rows[tuple(vote.items())] += 1
    model = quality_rules.fit([dict(k) | {"n": n} for k, n in rows.items()], list(chances), rounds=60)
    assert abs(model.prior - 0.7) < 0.05
    assert all(abs(a - b) < 0.06 for n in chances for got, want in zip(model.chances[n], chances[n]) for a, b in zip(got, want))


def test_quality_rules_reject_defects(spark):
    prose = "The quick fox of the {} wood ran over some green hills and then it slept until noon near a stream, {} said."
    rows = [(k, (prose.format(f"w{k}", f"n{k}") + "\n") * 1 + f"Then {k} others came by the road to see what had been there before them.") for k in range(60)]
    rows += [(100 + k, " ".join(f"a{k}{j}###" for j in range(40))) for k in range(6)] + [(200 + k, " ".join(f"A{k}B{j}!!".upper() for j in range(40))) for k in range(6)]
    kept = {r.doc_id for r in quality_rules.judge(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r.kept}
    assert kept == set(range(60))


def shingle_set(text):
    w = words(low(text))
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_components(rows):
    sets = [(i, shingle_set(t)) for i, t in rows if i is not None]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, s) in enumerate(sets):
        for j, t in sets[:a]:
            both = len(s & t)
            if s and t and 100 * both >= 75 * (len(s) + len(t) - both):
                p, q = find(i), find(j)
                root[max(p, q)] = min(p, q)
    return {i: find(i) for i in root}


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_near_duplicates(request, which):
    df = request.getfixturevalue(which)
    rows = df.collect()
    want = brute_components([(r.doc_id, r.text) for r in rows])
    got = minmax_dedup.components(df).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == Counter((r.doc_id, len(shingle_set(r.text)), want.get(r.doc_id)) for r in rows)
    assert all(r.kept == (r.doc_id is None or r.doc_id == r.component_id) for r in got)


def test_near_duplicates_of_chains_and_one_id(spark):
    base = [f"w{k}" for k in range(100)]
    chain = [(k, " ".join([f"x{k}_{j}" for j in range(0)] + base[k * 4 :] + [f"n{j}" for j in range(k * 4)])) for k in range(12)]
    rows = [*chain, (50, " ".join(base)), (50, "quite another text of one two three"), (51, "quite another text of one two three"), *[(100 + k, " ".join(base)) for k in range(300)]]
    got = {(r.doc_id, r.component_id) for r in minmax_dedup.components(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    want = brute_components(rows)
    one = {find for i, find in want.items() if i in (50, 51)}
    assert {c for i, c in got if i not in (50, 51)} == {c for i, c in want.items() if i not in (50, 51)}
    assert {c for i, c in got if i in (50, 51)} == {min(one)}


def test_min_max_signature_is_unbiased():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(30):
        common, a, b = (rng.integers(0, 2**63, n, dtype=np.uint64) for n in (600, 100, 100))
        same = minmax_dedup.min_max(np.concatenate([common, a])) == minmax_dedup.min_max(np.concatenate([common, b]))
        errors.append(same.mean() - 0.75)
    assert abs(np.mean(errors)) < 0.02


def test_deduplicate_keeps_columns(cases):
    kept = minmax_dedup.deduplicate(cases)
    assert kept.columns == cases.columns
    ids = [r.doc_id for r in kept.collect()]
    assert Counter(ids) == Counter([1, 2, 3, None, 4, 5, 7, 9, None])


SECRETS = [
    (1, 'x password = "abcdefgh1" y'), (2, "password: token: abcdefghij"), (3, "AKIA1234567890AB AKIA12"), (4, "f" * 31 + " " + "0a" * 16), (5, "API_KEY=short apikey = longenough+/="), (6, None), (6, None), (7, ""),
    (None, "é token:'ééé' secret:abcdefgh"), (8, "ghp_" + "a" * 36 + " -----BEGIN RSA PRIVATE KEY-----"), (9, ("token=abcdefgh " + "b" * 40 + " ") * 300), (10, "passwd:passwd:passwd:passwd"),
]


def brute_spans(text):
    text, out = text or "", []
    for order, (kind, pattern, ok) in enumerate((
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 8),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 16), ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 32),
    )):
        out += [(m.start(), order, kind, m.end()) for m in re.finditer(pattern, text, re.ASCII) if ok(m)]
    return sorted(out)


@pytest.mark.parametrize("which", ["docs", "made"])
def test_secrets(request, spark, which):
    df = request.getfixturevalue("docs") if which == "docs" else spark.createDataFrame(SECRETS, "doc_id long, text string")
    got = Counter((r.doc_id, tuple((s.start, s.rank, s.kind, s.end) for s in r.spans if s.rank < 3)) for r in secret_scan.scan(df).collect())
    assert got == Counter((r.doc_id, tuple(brute_spans(r.text))) for r in df.collect())


def test_trigram_queries():
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == [["aki", "kia"]]
    assert secret_scan.trigram_query("[0-9a-f]{32,}") is None
    assert ["ken", "oke", "tok"] in secret_scan.trigram_query(secret_scan.BASE[0].pattern)
    assert secret_scan.trigram_query("ab?cde") == [["abc", "bcd", "cde"], ["acd", "cde"]]
    assert secret_scan.trigram_query("(abc|x)") is None


def test_other_secrets_and_redaction(spark):
    df = spark.createDataFrame([(8, "a ghp_" + "a" * 36 + " z", 1), (9, "clean", 2), (10, None, 3)], "doc_id long, text string, spans int")
    rows = {r.doc_id: r for r in secret_scan.redact(df).collect()}
    assert rows[8].text == "a [github] z" and rows[9].text == "clean" and rows[10].text is None and rows[8].spans == 1


def brute_targets(sizes):
    weights = {s: (5, 2, 1)[k % 3] for k, s in enumerate(sorted(sizes, key=lambda s: (s is None, s)))}
    total, open_, out = sum(sizes.values()), set(sizes), {}
    while open_:
        share = {s: total * weights[s] / sum(weights[x] for x in open_) for s in open_}
        full = {s for s in open_ if share[s] >= 3 * sizes[s]}
        if not full:
            return out | share
        for s in full:
            out[s] = 3 * sizes[s]
            total -= out[s]
        open_ -= full
    return out


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_mixing(request, which):
    df = request.getfixturevalue(which)
    sizes = Counter()
    for r in df.collect():
        sizes[r.source] += len(words(r.text))
    want, rows = brute_targets(sizes), curriculum.mix(df).collect()
    taken = Counter()
    for r in rows:
        taken[r.source] += r.taken
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and 0 <= r.taken <= 3 * r.size
        assert (r.position is None) == (r.passes == 0) and (r.position is None or 0 <= r.position <= 1)
    assert all(abs(taken[s] - want[s]) < 1 for s in sizes)
    assert Counter((r.doc_id, r.size) for r in rows) == Counter((r.doc_id, len(words(r.text))) for r in df.collect())
    assert Counter(map(tuple, rows)) == Counter(map(tuple, curriculum.mix(df.repartition(3)).collect()))


def test_positions_follow_schedules(spark, docs):
    at = curriculum.positions(curriculum.mix(docs)).collect()
    assert [r.position for r in at] == sorted(r.position for r in at)
    for k, knots in enumerate(curriculum.SCHEDULES):
        expr = curriculum.schedule_position(curriculum.SCHEDULES, str(k), "d")
        got = spark.range(101).select((F.col("id") / 100).alias("d")).select("d", F.expr(expr).alias("t")).collect()
        times, values = zip(*knots)
        grid = np.linspace(0, 1, 20001)
        area = np.concatenate([[0], np.cumsum((np.interp(grid[1:], times, values) + np.interp(grid[:-1], times, values)) / 2)])
        assert all(abs(np.interp(r.t, grid, area / area[-1]) - r.d) < 1e-3 for r in got)


def test_arrange(cases):
    done = curriculum.arrange(cases)
    assert done.columns == cases.columns and done.where("text is null").isEmpty()


PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.mark.parametrize("which", ["docs", "cases"])
def test_bpe(request, which):
    df = request.getfixturevalue(which)
    exact = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    want = Counter((r.doc_id, tuple(exact.encode_ordinary(r.text or ""))) for r in df.collect())
    encoded = bpe.encode(df, PATH, PATTERN, offsets=True)
    rows = encoded.collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == want
    assert all(len(r.starts) == len(r.ends) == len(r.ids) for r in rows)
    assert Counter((r.doc_id, r.text) for r in bpe.decode(encoded, PATH, PATTERN).collect()) == Counter((r.doc_id, r.text or "") for r in df.collect())
    done = bpe.round_trip(df, PATH, PATTERN).collect()
    assert Counter((r.doc_id, r.ids_sha256) for r in done) == Counter((i, hashlib.sha256(np.array(t, "<u4").tobytes()).hexdigest()) for i, t in want.elements())
    assert all(r.same for r in done)


def test_bpe_of_odd_texts():
    codec = bpe.Codec(bpe.tokenizer(bpe.read_ranks(PATH), PATTERN).to_str())
    exact = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=bpe.read_ranks(PATH), special_tokens={})
    rng = np.random.default_rng(5)
    pool = list("ab cZ  \t\n\r 　'sé日²½_-!?😀<|endoftext|>0123\x00᠎")
    texts = ["".join(rng.choice(pool, rng.integers(0, 60))) for _ in range(2000)] + ["x" * 50_000, "ab  cd \n e" * 60_000]
    assert [np.frombuffer(x, "<u4").tolist() for x in codec.encode_all(texts)] == [exact.encode_ordinary(t) for t in texts]
    ids = exact.encode_ordinary("😀é")
    assert b"".join(codec.decode([k]) for k in ids).decode() == "😀é"


PRIVATE = [
    (1, "mail Anna.Lee7@mail3.example.com or ANNA.LEE7@mail3.example.com", 0), (2, "anna.lee7@mail3.example.com", 0), (3, "call +1 (523) 555-1055 or +15235551055", 0), (4, "card 4111 1111 1111 1111, 4111111111111112", 0),
    (5, "ip 10.20.30.40 ssn 123-45-6789 iban GB82WEST12345698765432", 0), (6, "Mrs Anna Schmidt met Herr Schmidt and Г-жа Анна Иванова", 0), (7, "Dr Anna SCHMIDT", 0), (8, "clean words 12 and 3.4", 0), (9, None, 0), (10, "", 0),
    (1, "mail Anna.Lee7@mail3.example.com or ANNA.LEE7@mail3.example.com", 0), (None, "x@y.org", 0), (11, "ID12 4111 1111 1111 1111 AB12 CDEF 3456", 0),
]


def test_pii(spark):
    df = spark.createDataFrame(PRIVATE, "doc_id long, text string, __other int")
    done = pii.replace(df, "key")
    assert done.columns == [*df.columns, "__found"]
    got = {}
    for r in done.collect():
        got.setdefault(r.doc_id, r.text)
        assert got[r.doc_id] == r.text
    assert got[8] == "clean words 12 and 3.4" and got[9] is None and got[10] == ""
    mails = got[1].split(" ")
    assert mails[1] == mails[3] == got[2] and re.fullmatch(r"[a-z]{4}\.[a-z]{3}\d@[a-z]{4}\d\.[a-z]{7}\.com", got[2]) and got[2] != "anna.lee7@mail3.example.com"
    a, b = got[3].removeprefix("call ").split(" or ")
    assert re.fullmatch(r"\+1 \(\d{3}\) \d{3}-\d{4}", a) and re.sub(r"\D", "", a) == b[1:] and b != "+15235551055"
    card, account = got[4].removeprefix("card ").split(", ")
    luhn = lambda s: sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(int(c) for c in reversed(s))) % 10 == 0
    assert re.fullmatch(r"4\d{3} \d{4} \d{4} \d{4}", card) and luhn(card.replace(" ", "")) and not luhn(account) and account[0] == "4"
    ip, ssn, iban = re.fullmatch(r"ip (\S+) ssn (\S+) iban (\S+)", got[5]).groups()
    assert all(1 <= int(x) <= 254 for x in ip.split(".")) and re.fullmatch(r"\d{3}-\d{2}-\d{4}", ssn) and iban[:2] == "GB" and len(iban) == 22
    assert int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1
    m = re.fullmatch(r"Mrs (\w+) (\w+) met Herr (\w+) and Г-жа (\w+) (\w+)", got[6])
    assert m and m[2] == m[3] and m[1].endswith("na") and m[4].endswith("на") and m[5].endswith("сен")
    assert re.fullmatch(r"ID12 4\d{3} \d{4} \d{4} \d{4} AB12 CDEF 3456", got[11]) and "4111 1111" not in got[11]
    assert got[7].split()[2] == m[2].upper() and got[7].split()[1] == m[1]


def test_pii_is_distinct_and_keyed(spark):
    rows = [(k, f"u{k % 400}@m.org 10.0.{k % 250}.{k // 250}") for k in range(800)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = lambda key: {r.doc_id: [f.put for f in r["__found"]] for r in pii.replace(df, key).collect()}
    one, two = found("a"), found("b")
    assert one == found("a") and one != two
    pairs = {(old, new) for (k, t) in rows for old, new in zip(t.split(" "), one[k])}
    assert len(pairs) == len({o for o, _ in pairs}) == len({n for _, n in pairs})
    assert not {o for o, _ in pairs} & {n for _, n in pairs}


def luhn(digits):
    return sum(d if k % 2 == 0 else d * 2 - 9 * (d > 4) for k, d in enumerate(int(c) for c in reversed(digits))) % 10 == 0


def right_iban(value):
    v = value.replace(" ", "")
    return int("".join(str(int(c, 36)) for c in v[4:] + v[:4])) % 97 == 1


def brute_phone(value, digits):
    if value[0] != "+" and re.fullmatch(r"0\d \d{4} \d{4}", value):
        return "61" + digits[1:]
    return "1" + digits if value[0] != "+" and len(digits) == 10 and digits[0] != "0" else digits


def brute_mentions(text):
    """All matches of all rules, the earlier and then the more specific first, without overlaps."""
    found = []
    for rank, rule in enumerate(pii.RULES):
        found += [(m.start(), rank, rule.kind, m.end(), m[0]) for m in regex.finditer(rule.pattern, text) if rule.kind != "iban" or right_iban(m[0])]
    out, at = [], 0
    for start, _, kind, end, value in sorted(found):
        if start < at:
            continue
        at = end
        if kind != "person":
            digits = re.sub(r"[^0-9]", "", value)
            kind = ("card" if luhn(digits) else "account") if kind == "number" else kind
            norm = {"email": value.lower(), "iban": value.replace(" ", ""), "ip": value, "phone": brute_phone(value, digits)}.get(kind, digits)
            out.append((start, end, kind, norm))
            continue
        title, *names = value.split(" ")
        title = title.replace(".", "")
        at_name = start + len(value.split(" ")[0]) + 1
        for name in names:
            sex = "given_m" if title in pii.MALE else "given_f" if title in pii.FEMALE or name[-1] in "aаα" else "given_u"
            out.append((at_name, at_name + len(name), "surname" if at_name + len(name) == end else sex, name.lower()))
            at_name += len(name) + 1
    return out


PHONES = ["call (017) 555-7713 now", "555-123-4567 or 555.123.4567", "02 9000 0000", "+1 - 555 123 4567", "in 1999-2001 and 12-34-5678", "1.234.567-8901", "version 10.200.300-4000"]


def test_pii_detection_against_brute_force(spark, docs):
    made = [r[1] for r in PRIVATE] + PHONES + ["x@" + "a." * 4000, "a@b@c.de f@g.hi%j@k.lm", "4111111111111111 Mr Al Bo-Na, Dr Ω Αλφα Mrs. É Ñu", "Dear Ms Jane Mary Ann Doe, and Ms. Doe", "Herr Al Bo Ca De Efa"]
    df = docs.select("text").union(spark.createDataFrame([(t,) for t in made], "text string")).where("text is not null")
    for r in df.select("text", pii.mentions(F.col("text")).alias("m")).collect():
        assert [(s.start, s.end, s.kind, s.norm) for s in r.m] == brute_mentions(r.text)
        assert all(r.text[s.start : s.end] == s.value for s in r.m)


def test_pii_of_long_names_and_of_phones_in_two_forms(spark):
    """No part of a name stays, and mentions of one person or number get the same surrogate, in each one's own format."""
    rows = [(1, "Dear Ms Jane Mary Doe, and Ms. Doe met Dr JANE DOE"), (2, "(523) 555-1055 or +1 523 555 1055, 523-555-1055"), (3, "02 9000 1234, +61 2 9000 1234"), (4, "(017) 555-7713 and +17 555 7713 9")]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    m = re.fullmatch(r"Dear Ms (\w+) (\w+) (\w+), and Ms\. (\w+) met Dr (\w+) (\w+)", got[1])
    assert m and m[3] == m[4] == m[6].capitalize() and m[1] != m[2] and m[1].endswith("na") and m[2].endswith("na")
    assert not {"jane", "mary", "doe"} & set(re.findall(r"\w+", got[1].lower()))
    m = re.fullmatch(r"\((\d{3})\) (\d{3})-(\d{4}) or \+1 (\d{3}) (\d{3}) (\d{4}), (\d{3})-(\d{3})-(\d{4})", got[2])
    assert m and m.groups()[:3] == m.groups()[3:6] == m.groups()[6:] and m[1] + m[2] + m[3] != "5235551055"
    m = re.fullmatch(r"0(\d) (\d{4}) (\d{4}), \+61 (\d) (\d{4}) (\d{4})", got[3])
    assert m and m.groups()[:3] == m.groups()[3:] and m[2] + m[3] != "90001234"
    assert re.fullmatch(r"\(0\d\d\) \d{3}-\d{4} and \+1\d \d{3} \d{4} \d", got[4])


def test_pii_settles_where_a_shape_is_used_up(spark):
    letters = "abcdefghijklmnopqrstuvwxyz"
    mails = [f"{a}@{b}.co" for a in letters for b in letters]
    ips = [f"10.0.0.{k}" for k in range(256)]
    rows = [(k, x) for k, x in enumerate(mails + ips)] + [(10_000 + k, "a@b.co") for k in range(2000)]
    got = {r.doc_id: r.text for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), "key").collect()}
    new = [got[k] for k in range(len(mails) + len(ips))]
    assert len(set(new)) == len(new) and not set(new) & {*mails, *ips}
    assert all(re.fullmatch(r"[a-z]+@[a-z]\.co", x) for x in new[: len(mails)])
    assert {got[10_000 + k] for k in range(2000)} == {got[1 - 1 + mails.index("a@b.co")]}


def test_pii_surrogates_of_every_kind_grow(spark):
    norms = {"email": "a@b.co", "phone": "15235551055", "card": "4111111111111111", "account": "4111111111111112", "ssn": "123456789", "ip": "10.0.0.1", "iban": "GB82WEST12345698765432", "surname": "lee"}
    df = spark.createDataFrame([(k, n, a) for k, n in norms.items() for a in (0, 3, 4, 9)], "kind string, norm string, attempt int").withColumn("__key", F.lit("k"))
    got = {(r.kind, r.attempt): r.s for r in df.select("kind", "attempt", F.expr(pii.surrogate()).alias("s")).collect()}
    for kind, norm in norms.items():
        size = [len(got[kind, a].split(".")) if kind == "ip" else len(got[kind, a]) for a in (0, 3, 4, 9)]
        base = 4 if kind == "ip" else len(norm)
        assert size == sorted(size) and size[3] > size[2] > size[1] and (kind == "surname" or size[:2] == [base, base] and size[3] == base + 6)
    assert all(luhn(got["card", a]) and not luhn(got["account", a]) and right_iban(got["iban", a]) for a in (0, 3, 4, 9))


def test_very_long_texts_of_tokens_and_spans(spark):
    rows = [(0, "x@" + "a." * 4000), (1, "a" * 1_000_000), (2, "@" + "0123456789abcdef" * 60_000), (3, " ".join(f"token=abcdefgh{k}" for k in range(20_000))), (4, " ".join(f"é{k} u{k}@m.org" for k in range(5000)))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    spans = {r.doc_id: len(r.spans) for r in secret_scan.scan(df).collect()}
    assert spans == {0: 0, 1: 1, 2: 1, 3: 20_000, 4: 0}
    assert {r.doc_id: r.text for r in secret_scan.redact(df).collect()}[3] == " ".join(["[assign]"] * 20_000)
    done = {r.doc_id: r.text for r in pii.replace(df, "key").collect()}
    assert all(done[k] == t for k, t in rows if k < 4)
    old, new = rows[4][1].split(" "), done[4].split(" ")
    assert old[::2] == new[::2] and len(set(new[1::2])) == 5000 and not set(old[1::2]) & set(new[1::2])


CLASHES = ["key", "rules", "row", "n", "__text", "__key", "__rules", "__spans", "__found", "__row", "__mentions", "__id", "bits", "__bits", "attempt", "kind"]


@pytest.mark.parametrize("run", [secret_scan.redact, lambda d: pii.replace(d, "k").drop("___found")])
def test_clashing_names_are_kept(spark, run):
    df = spark.createDataFrame([(1, "token=abcdefgh1 a@b.org", *range(len(CLASHES))), (2, None, *range(len(CLASHES)))], "doc_id long, text string, " + ", ".join(f"`{n}` int" for n in CLASHES))
    done = run(df)
    assert done.columns == df.columns
    assert all([r[n] for n in CLASHES] == list(range(len(CLASHES))) for r in done.collect())


@pytest.mark.parametrize("run", [quality_rules.judge, minmax_dedup.components, secret_scan.scan, curriculum.mix, lambda d: bpe.encode(d, PATH, PATTERN), lambda d: pii.replace(d, "k")])
def test_empty_tables(spark, run):
    assert run(spark.createDataFrame([], SCHEMA)).collect() == []


def test_word_hashes_are_bounded(monkeypatch):
    from sieveline.llm import shared

    monkeypatch.setattr(shared, "_CACHE_WORDS", 10)
    hashes = WordHashes()
    many = [str(k).encode() for k in range(100)]
    assert len(set(hashes.of(many).tolist())) == 100 and len(hashes) <= 10


def test_thin_queries(spark):
    for name in ("op1", "op2", "op5", "op8", "op9", "op10"):
        q = next(f for k, f in queries.QUERIES.items() if k.startswith(name + "_"))
        assert q(spark, SF).count() == 200
